"""Periodic runs against brute force over all periods."""
import hashlib
import random
import zlib

import numpy as np
import pytest

from cases import SCHEMA, odd_rows, with_extra
from marketlake.llm import periodic_runs, queries


def brute(words, least=periodic_runs.MIN_WORDS):
    """Every period in turn: maximal stretches of equal words that far apart; the smallest period of a stretch."""
    found = {}
    for q in range(1, len(words) // 2 + 1):
        i = 0
        while i + q < len(words):
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            if j + q - i >= max(least, 2 * q):
                found.setdefault((i, j + q), q)
            i = j + 1
    return sorted((s, e - s, q) for (s, e), q in found.items())


def fibonacci(n):
    a, b = [0], [0, 1]
    while len(b) < n:
        a, b = b, b + a
    return b[:n]


def thue_morse(n):
    x = [0]
    while len(x) < n:
        x += [1 - v for v in x]
    return x[:n]


def cases(seed=5):
    rng = random.Random(seed)
    yield from (fibonacci(400), thue_morse(400), [0] * 300, [], [7], list(range(50)) * 3)
    for _ in range(60):
        n = rng.choice([12, 30, 80, 200, 400])
        yield [rng.randrange(2) for _ in range(n)]
        yield [int(rng.random() < 0.08) for _ in range(n)]
        unit = [rng.randrange(2) for _ in range(rng.randint(1, 90))]
        yield [8, 9] + (unit * 40)[:n] + [rng.randrange(9) for _ in range(rng.randint(0, 20))]
        deep = [0] * rng.randint(1, 40) + [1] * rng.randint(1, 4)
        yield ((deep * rng.randint(1, 4) + [rng.randrange(3)] * rng.randint(0, 30)) * rng.randint(2, 4))[:500]
        ab = list(range(rng.randint(1, 3))) * 60        # a period made of highly periodic regions only
        yield ab[:rng.randint(5, 90)] + ab[rng.randint(0, 2):rng.randint(20, 110)] + ab[:rng.randint(0, 60)]


@pytest.mark.parametrize("together", [1, 1000])
def test_runs_equal_brute_force(together):
    texts = [np.array(x, dtype=np.int64) for x in cases()]
    for at in range(0, len(texts), together):
        some = texts[at:at + together]
        for words, (start, end, period) in zip(some, periodic_runs.find(some), strict=True):
            got = list(zip(start.tolist(), (end - start).tolist(), period.tolist()))
            assert got == sorted(got, key=lambda r: (r[0], r[2])) and sorted(got) == brute(list(words))


def test_a_text_of_a_million_words():
    words = np.array(thue_morse(1 << 20), dtype=np.int64)
    words[500_000:1_000_000] = words[:500_000]
    (start, end, period), = periodic_runs.find([words])
    for s, e, q in zip(start, end, period):
        assert e - s >= max(12, 2 * q) and np.array_equal(words[s:e - q], words[s + q:e])
    assert any(q == 500_000 and e - s >= 1_000_000 for s, e, q in zip(start, end, period))


def test_prefix_hashes_are_those_of_a_prime_field():
    ids = np.array([3, 1, 4, 1, 5, 9, 2, 6], dtype=np.int64)
    words, prime = periodic_runs.Words(ids), int(periodic_runs._PRIME)
    value = [int(v) for v in periodic_runs._reduce(periodic_runs._mix(ids.astype(np.uint64) + np.uint64(1)))]
    for at in range(8):
        for n in range(9 - at):
            want = sum(v * pow(periodic_runs._BASE, k, prime) for k, v in enumerate(value[at:at + n])) % prime
            assert int(words.hashes(np.array([at]), n)[0]) == want


def words_of(doc_id, text):
    words = (text or "").encode().split()
    h = zlib.crc32(str(doc_id).encode())
    n, g = len(words), h // 10
    if doc_id is not None and h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    return words


def sha(data):
    return hashlib.sha256(data).hexdigest()


def test_query_equals_brute_force(spark, tmp_path):
    rng = random.Random(3)
    rows = [r for r in odd_rows() if len(r[1] or "") < 10_000]
    rows += [(100 + i, " ".join(rng.choice("ab c dd".split()[:2 + i % 2]) for _ in range(rng.randrange(90))), "en", "s", 1)
             for i in range(150)]
    with_extra(spark.createDataFrame(rows, SCHEMA)).write.parquet(str(tmp_path / "documents.parquet"))
    want = []
    for doc_id, text, *_ in rows:
        words = words_of(doc_id, text)
        runs = sorted(brute(words), key=lambda r: (r[0], r[2]))
        repeated = {i for s, n, q in runs for i in range(s + q, s + n)}
        best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=(None, None, None))
        milli = 1000 * best[1] // best[2] if runs else None
        want.append((doc_id, len(runs), *best, milli, sha("".join(f"{s},{n},{q}\n" for s, n, q in runs).encode()),
                     sha(b" ".join(w for i, w in enumerate(words) if i not in repeated))))
    got = [tuple(r) for r in queries.op12_periodic_runs(spark, str(tmp_path)).collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    assert sum(r[1] for r in want) > 50


def test_long_and_missing_texts(spark):
    rows = odd_rows()
    out = periodic_runs.periodic_runs(with_extra(spark.createDataFrame(rows, SCHEMA)), carry=True).collect()
    assert len(out) == len(rows)
    for r in out:
        if r.row._c1 and r.row._c1.startswith("word0"):     # 977 words again and again, then perhaps another one
            assert [tuple(x) for x in r.runs] == [(0, 30_000, 977)]
            assert r.collapsed.split() == r.row._c1.split()[:977] + r.row._c1.split()[30_000:]
        else:
            assert r.runs == [] and r.collapsed == " ".join(w.decode() for w in (r.row._c1 or "").encode().split())
    assert periodic_runs.periodic_runs(spark.createDataFrame([], SCHEMA)).collect() == []
