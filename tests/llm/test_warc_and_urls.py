"""WARC bundles (round trip, seek table, damage) and URL rules against brute force."""
import hashlib
import io
import re
from collections import defaultdict

import pytest
from pyspark.sql import functions as F
import zstandard

from marketlake.llm import url_filters, warc

PAGES = "page_id long, url string, html string"


def page_rows():
    big = "x" * 150
    rows = [(i, f"http://h{i}.org/p", big if i % 3 else f"own {i} " * 40) for i in range(30)]
    rows += [(100, None, None), (101, "u", ""), (102, "u\r\nv", "short"), (103, "u", "short"), (None, "n", big),
             (104, "é", "ü" * 60), (105, "é", "ü" * 60), (104, "é", "ü" * 60), (106, "l", "long " * 200_000)]
    return rows


def test_archive_round_trip_matches_brute_force(spark):
    rows = page_rows()
    first = defaultdict(list)
    for i, _, html in rows:
        if i is not None:
            first[html or ""].append(i)
    got = warc.read_bundles(warc.archive(spark.createDataFrame(rows, PAGES)), with_payload=True).collect()
    want = []
    for i, _, html in rows:
        data = (html or "").encode()
        low = min(first[html or ""], default=None)
        revisit = len(data) >= 100 and low is not None and i != low
        want.append((str(i) if i is not None else None, len(data), hashlib.sha256(data).hexdigest(),
                     "revisit" if revisit else "response", str(low) if revisit else None))
    key = repr
    assert sorted([(r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got],
                  key=key) == sorted(want, key=key)
    assert all(hashlib.sha256(r.payload).hexdigest() == r.payload_digest for r in got if r.record_type == "response")


def test_bundle_is_plain_zstandard_with_seek_table():
    w = warc.BundleWriter(frame_bytes=500)
    records = [warc.build_record(str(i), "u", "response", None, b"p%d" % i * 50, 100, "d") for i in range(20)]
    for i, r in enumerate(records):
        w.add(str(i), r)
    content = w.close()
    reader = warc.BundleReader(content)
    assert len(reader.frames) > 3
    for e, r in zip(w.entries, records):    # frame-relative offsets, one frame decompressed at a time
        assert reader.frame(e["frame"])[e["offset"]:e["offset"] + e["length"]] == r
    with zstandard.ZstdDecompressor().stream_reader(io.BytesIO(content), read_across_frames=True) as s:
        assert s.read() == b"".join(records)


def test_lookup_reads_only_wanted_records(spark):
    bundles = warc.archive(spark.createDataFrame(page_rows(), PAGES))
    ids = spark.createDataFrame([(warc.record_id("3"),), (warc.record_id("absent"),)], "record_id string")
    got = warc.lookup(bundles, ids).collect()
    assert [bytes(r.payload) for r in got] == [("own 3 " * 40).encode()]


def test_files_and_damage(spark, tmp_path):
    w = warc.BundleWriter()
    w.add("a", warc.build_record("1", "u", "response", None, b"abc", 3, hashlib.sha256(b"abc").hexdigest()))
    (tmp_path / "one.warc.zst").write_bytes(w.close())
    back = warc.read_bundles(warc.read_files(spark, str(tmp_path))).collect()
    assert [(r.page_id, r.payload_bytes) for r in back] == [("1", 3)]
    w = warc.BundleWriter()
    w.add("a", warc.build_record("1", "u", "response", None, b"abd", 3, hashlib.sha256(b"abc").hexdigest()))
    (tmp_path / "one.warc.zst").write_bytes(w.close())
    with pytest.raises(Exception, match="damaged"):
        warc.read_bundles(warc.read_files(spark, str(tmp_path))).collect()


def test_empty_archive(spark):
    assert warc.read_bundles(warc.archive(spark.createDataFrame([], PAGES))).collect() == []


URLS = ["http://A.Example.ORG/es/x", "http://example.org/en/123", "http://example.org/en/2", "https://x.com/fr/",
        "https://x.com/de/a?b#c", "http://notorg/", "http://xorg/a", "org/es/", None, "", "://", "http://", "ftp://org",
        "http://org?x=/es/", "http://example.org:80/es/", "http://a.ads.net/x", "http://ads.net/x/", "http://b.net/ads/",
        "http://b.net/Adclick/x", "http://b.net/?page=adclick", "http://ünï.org/é", "http://b.net/a\nb/adserve.js",
        "http://a.b.example.org/en/1", "http://fakeexample.org/es/", "http://x.com/FR/", "http://x.net/casino-bonus?x"]


def test_every_rule_by_brute_force(spark):
    rules = url_filters.BASE_RULES + url_filters.default_patterns()
    df = spark.createDataFrame([(i if i % 7 else None, u) for i, u in enumerate(URLS)] * 2, "page_id long, url string")
    got = url_filters.judge(df, rules).collect()
    assert len(got) == 2 * len(URLS)
    want = []
    for i, u in list(enumerate(URLS)) * 2:
        rest = u.split("://", 1)[1] if u and "://" in u else ""
        raw = re.match(r"[^/?#]*", rest).group()
        host = re.sub("[A-Z]", lambda m: m.group().lower(), raw)
        path = re.match(r"[^?#]*", rest[len(raw):]).group()
        fits = []
        for r in url_filters.BASE_RULES:
            h, p = r.text.split("/", 1)
            if (host == h or host.endswith("." + h)) and path.startswith("/" + p):
                fits.append(r)
        best = max(fits, key=lambda r: len(r.text), default=None)
        whole = re.sub("[A-Z]", lambda m: m.group().lower(), rest)
        hits = sorted(r.text for r in rules if not r.base and rest and re.search(r.regex, whole, re.DOTALL))
        verdict = best.action if best else "block" if hits else "allow"
        want.append((i if i % 7 else None, host, path, best and best.text, hits[0] if hits else None, verdict))
    assert sorted(map(repr, want)) == sorted(
        repr((r.page_id, r.host, r.path, r.rule, r.pattern, r.verdict)) for r in got)


def test_index_uses_rarest_token():
    rules = [url_filters.Rule("example.org/es/", "block", True), url_filters.Rule("*loose*", "block")]
    index, loose = url_filters.build_index(rules, {"example": 10, "org": 50, "es": 3})
    assert list(index) == ["es"] and [r.text for r in loose] == ["*loose*"]


def test_empty_urls(spark):
    df = spark.createDataFrame([], "page_id long, url string")
    assert url_filters.judge(df, url_filters.BASE_RULES).collect() == []


PAGE_EXTRA = ("payload", "row", "bundle", "digest", "first_id", "salt", "host", "path", "rule", "verdict", "tokens", "copies", "URL", "frame")


def test_text_ids_come_back_whole(spark):
    ids = ["", None, "a\r\nb: c", "50%", "%0A", "é 日", "x" * 300]
    rows = [(i, "http://h/", "same body " * 20) for i in ids]
    back = warc.read_bundles(warc.archive(spark.createDataFrame(rows, "page_id string, url string, html string"))).collect()
    assert sorted((r.page_id for r in back), key=str) == sorted(ids, key=str)
    assert {r.refers_to for r in back if r.record_type == "revisit"} == {""}


def test_columns_with_clashing_names(spark):
    rows = [(1, "http://a.example.org/x?y", "body " * 40), (2, "http://b.com/fr/z", "body " * 40), (3, None, None)]
    plain = spark.createDataFrame(rows, "page_id long, url string, html string")
    extra = plain.select("*", *[F.lit(f"extra {c}").alias(c) for c in PAGE_EXTRA])
    want = sorted(tuple(r)[3:] for r in warc.read_bundles(warc.archive(plain)).collect())
    assert sorted(tuple(r)[3:] for r in warc.read_bundles(warc.archive(extra)).collect()) == want
    rules = url_filters.BASE_RULES + url_filters.default_patterns()
    judge = lambda df: sorted(str(tuple(r)) for r in url_filters.judge(df, rules).select("page_id", "host", "path", "rule", "verdict").collect())
    assert judge(extra) == judge(plain)
