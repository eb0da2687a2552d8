"""WARC records in seekable Zstandard bundles.

**Bundle.**  Records are grouped into frames of about ``FRAME_BYTES``; each frame
is compressed on its own, so a reader decompresses only the frame it needs.  A
skippable frame at the end holds the seek table (compressed and full size of
every frame, frame count, magic number; the public Zstandard seekable format),
which a reader finds from the last nine bytes.  The index maps a record id to
(bundle, frame, offset inside the decompressed frame, length).

**Writing** is one Spark task per input partition: the task streams its rows,
closes a bundle at ``BUNDLE_BYTES`` and emits it as one binary row with its index
entries.  Spark's own writer and commit protocol put the rows in the shared
folder, so any file system that Spark can write to will do, and a lost or
repeated task leaves no half bundle.  ``read_files`` reads bundles that are
plain files, through Spark's ``binaryFile`` source.

**Revisits.**  Of records with equal payloads of at least ``MIN_REVISIT`` bytes, the
one with the smallest id is the response; the others become revisit records,
which refer to it and carry no payload.  Shorter payloads are all responses.

Null payloads count as empty.  Null ids are kept as records without an id (never
chosen as a response that others refer to; a group without any id has responses
only).  Rows that repeat the smallest id are all responses.  Empty tables give
empty archives and results.
"""

from __future__ import annotations

import hashlib
import struct
import uuid
from collections.abc import Iterator

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlake.llm._util import materialise, pick

FRAME_BYTES = 256 * 1024
BUNDLE_BYTES = 8 * 1024 * 1024
MIN_REVISIT = 100
LEVEL = 3
JOIN_SALTS = 16

# --- fixed values of the public formats --------------------------------------------------------
SKIPPABLE_MAGIC = 0x184D2A5E
SEEKABLE_MAGIC = 0x8F92EAB1
WARC_DATE = "2024-01-01T00:00:00Z"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP_HEAD = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
ID_SPACE = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")

BUNDLE_SCHEMA = ("bundle string, records long, content binary, "
                 "entries array<struct<record_id:string,frame:int,offset:long,length:long>>")


# --- one record --------------------------------------------------------------------------------

def record_id(page_id: str | None) -> str:
    return f"<urn:uuid:{uuid.uuid5(ID_SPACE, f'page:{page_id}')}>"


def _one_line(text: str | None) -> str:
    return "" if text is None else text.replace("\r", "%0D").replace("\n", "%0A")


def _escaped(text: str) -> str:
    """A header value of one line, from which ``_unescaped`` gets the text back."""
    return text.replace("%", "%25").replace("\r", "%0D").replace("\n", "%0A")


def _unescaped(value: str | None) -> str | None:
    return None if value is None else value.replace("%0A", "\n").replace("%0D", "\r").replace("%25", "%")


def build_record(page_id: str | None, url: str | None, kind: str, refers_to: str | None, payload: bytes,
                 n_bytes: int, digest: str) -> bytes:
    """A WARC/1.1 response (HTTP block) or revisit (HTTP head only)."""
    block = HTTP_HEAD + payload if kind == "response" else HTTP_HEAD
    head = [("WARC-Type", kind), ("WARC-Record-ID", record_id(page_id)), ("WARC-Date", WARC_DATE),
            ("WARC-Target-URI", _one_line(url)), ("WARC-Payload-Digest", f"sha256:{digest}"),
            ("X-Payload-Length", str(n_bytes))]
    if page_id is not None:
        head.append(("X-Page-Id", _escaped(page_id)))
    if kind == "revisit":
        head += [("WARC-Profile", REVISIT_PROFILE), ("WARC-Refers-To", record_id(refers_to)),
                 ("X-Refers-To-Page", _escaped(refers_to))]
    head += [("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block)))]
    lines = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in head) + "\r\n"
    return lines.encode() + block + b"\r\n\r\n"


def parse_record(data: bytes, at: int = 0) -> tuple[dict[str, str], bytes, int]:
    """(headers, payload, end) of the record that starts at ``at``."""
    split = data.index(b"\r\n\r\n", at)
    first, *lines = data[at:split].decode().split("\r\n")
    if first != "WARC/1.1":
        raise ValueError(f"no record at offset {at}")
    head = dict(line.split(": ", 1) for line in lines)
    begin, end = split + 4, split + 4 + int(head["Content-Length"])
    payload = data[data.index(b"\r\n\r\n", begin) + 4:end]
    if data[end:end + 4] != b"\r\n\r\n":
        raise ValueError("record is cut")
    return head, payload, end + 4


# --- one bundle --------------------------------------------------------------------------------

class BundleWriter:
    """Collects records into frames; ``close`` returns the bytes with the seek table."""

    def __init__(self, frame_bytes: int = FRAME_BYTES, level: int = LEVEL):
        import zstandard
        self._zstd = zstandard.ZstdCompressor(level=level)
        self._frame_bytes = frame_bytes
        self._frame, self._frames, self._sizes = bytearray(), [], []
        self.size = 0
        self.entries: list[dict] = []

    def add(self, rid: str, record: bytes) -> None:
        self.entries.append({"record_id": rid, "frame": len(self._sizes), "offset": len(self._frame),
                             "length": len(record)})
        self._frame += record
        if len(self._frame) >= self._frame_bytes:
            self._flush()

    def _flush(self) -> None:
        if self._frame:
            packed = self._zstd.compress(bytes(self._frame))
            self._frames.append(packed)
            self._sizes.append((len(packed), len(self._frame)))
            self.size += len(packed)
            self._frame = bytearray()

    def close(self) -> bytes:
        self._flush()
        table = b"".join(struct.pack("<II", *s) for s in self._sizes)
        table += struct.pack("<IBI", len(self._sizes), 0, SEEKABLE_MAGIC)
        return b"".join(self._frames) + struct.pack("<II", SKIPPABLE_MAGIC, len(table)) + table


class BundleReader:
    """Random access by frame."""

    def __init__(self, content: bytes):
        import zstandard
        self._content, self._zstd = content, zstandard.ZstdDecompressor()
        count, flags, magic = struct.unpack("<IBI", content[-9:])
        if magic != SEEKABLE_MAGIC or flags:
            raise ValueError("no seek table")
        table = content[-9 - 8 * count:-9]
        self.frames, at = [], 0
        for packed, full in struct.iter_unpack("<II", table):
            self.frames.append((at, packed, full))
            at += packed

    def frame(self, number: int) -> bytes:
        at, packed, full = self.frames[number]
        return self._zstd.decompress(self._content[at:at + packed], max_output_size=full)

    def record(self, frame: int, offset: int) -> tuple[dict[str, str], bytes]:
        return parse_record(self.frame(frame), offset)[:2]

    def records(self) -> Iterator[tuple[int, int, dict[str, str], bytes]]:
        for number in range(len(self.frames)):
            data, at = self.frame(number), 0
            while at < len(data):
                head, payload, end = parse_record(data, at)
                yield number, at, head, payload
                at = end


# --- Spark jobs --------------------------------------------------------------------------------

def classify(df: DataFrame, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html") -> DataFrame:
    """page_id, url, payload (binary), payload_bytes, payload_digest, record_type, refers_to.

    The first of a group is an aggregate over (digest, id), summed map-side; only
    groups of several are joined back, salted, so a payload that a third of the
    rows share is spread over many tasks.
    """
    src = pick(df, page_id=id_col, url=url_col, payload=payload_col).withColumn(
        "payload", F.coalesce(F.col("payload"), F.lit("")).cast("binary"))
    rows = src.select("page_id", "url", "payload", F.octet_length("payload").cast("long").alias("payload_bytes"),
                      F.sha2("payload", 256).alias("payload_digest"),
                      F.pmod(F.xxhash64("page_id"), F.lit(JOIN_SALTS)).cast("int").alias("salt"))
    first = (rows.filter(F.col("payload_bytes") >= MIN_REVISIT).groupBy("payload_digest")
             .agg(F.min("page_id").alias("first_id"), F.count(F.lit(1)).alias("copies"))
             .filter("copies > 1").select("payload_digest", "first_id")
             .select("*", F.explode(F.sequence(F.lit(0), F.lit(JOIN_SALTS - 1))).alias("salt")))
    revisit = F.col("first_id").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first_id"))
    # a sort-merge join: the repeated rows compress so well that they would pass for small
    return (rows.join(first.hint("merge"), ["payload_digest", "salt"], "left")
            .select("page_id", "url", F.when(~revisit, F.col("payload")).alias("payload"), "payload_bytes",
                    "payload_digest", F.when(revisit, "revisit").otherwise("response").alias("record_type"),
                    F.when(revisit, F.col("first_id")).alias("refers_to")))


def write_bundles(records: DataFrame, frame_bytes: int = FRAME_BYTES, bundle_bytes: int = BUNDLE_BYTES) -> DataFrame:
    """Bundles (BUNDLE_SCHEMA) of classified records; write the result with Spark."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        part, serial, out = TaskContext.get().partitionId(), 0, None

        def done(w: BundleWriter) -> pd.DataFrame:
            return pd.DataFrame({"bundle": [f"{part:06d}-{serial:05d}"], "records": [len(w.entries)],
                                 "content": [w.close()], "entries": [w.entries]})

        for pdf in batches:
            for r in pdf.itertuples(index=False):
                out = out or BundleWriter(frame_bytes)
                payload = b"" if r.payload is None else bytes(r.payload)
                out.add(record_id(r.page_id), build_record(r.page_id, r.url, r.record_type, r.refers_to, payload,
                                                           r.payload_bytes, r.payload_digest))
                if out.size >= bundle_bytes:
                    yield done(out)
                    out, serial = None, serial + 1
        if out is not None:
            yield done(out)

    text = records.select(F.col("page_id").cast("string").alias("page_id"), "url", "payload", "payload_bytes",
                          "payload_digest", "record_type", F.col("refers_to").cast("string").alias("refers_to"))
    return text.mapInPandas(run, BUNDLE_SCHEMA)


def read_bundles(bundles: DataFrame, with_payload: bool = False) -> DataFrame:
    """One row per record: bundle, frame, offset, page_id, url, record_type, refers_to,
    payload_bytes, payload_digest (and payload).

    The digest and length of a response are computed from the payload read back
    and must agree with its header; a damaged archive raises.  Those of a revisit
    stand in its header.
    """
    schema = ("bundle string, frame int, offset long, page_id string, url string, record_type string, "
              "refers_to string, payload_bytes long, payload_digest string") + ", payload binary" * with_payload

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for name, content in zip(pdf["bundle"], pdf["content"], strict=True):
                rows = []
                for number, at, head, payload in BundleReader(bytes(content)).records():
                    kind = head["WARC-Type"]
                    n, digest = int(head["X-Payload-Length"]), head["WARC-Payload-Digest"].removeprefix("sha256:")
                    if kind == "response" and (n, digest) != (len(payload), hashlib.sha256(payload).hexdigest()):
                        raise ValueError(f"record at frame {number}, offset {at} of {name} is damaged")
                    rows.append((name, number, at, _unescaped(head.get("X-Page-Id")), head["WARC-Target-URI"], kind,
                                 _unescaped(head.get("X-Refers-To-Page")), n, digest) + ((payload,) if with_payload else ()))
                yield pd.DataFrame(rows, columns=[c.split()[0] for c in schema.split(", ")])

    return bundles.select("bundle", "content").mapInPandas(run, schema)


def lookup(bundles: DataFrame, ids: DataFrame) -> DataFrame:
    """record_id, payload of the wanted ids (column ``record_id``): index entries joined, then
    only the frames that hold them are decompressed."""
    hits = (bundles.select("bundle", F.explode("entries").alias("e")).select("bundle", "e.*")
            .join(ids.select("record_id").distinct(), "record_id")
            .groupBy("bundle").agg(F.collect_list(F.struct("record_id", "frame", "offset")).alias("wanted")))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for content, wanted in zip(pdf["content"], pdf["wanted"], strict=True):
                reader = BundleReader(bytes(content))
                rows = [(w["record_id"], reader.record(w["frame"], w["offset"])[1]) for w in wanted]
                yield pd.DataFrame(rows, columns=["record_id", "payload"])

    joined = bundles.select("bundle", "content").join(hits, "bundle").select("content", "wanted")
    return joined.mapInPandas(run, "record_id string, payload binary")


def read_files(spark: SparkSession, path: str) -> DataFrame:
    """Bundles that are plain files, as (bundle, content)."""
    return (spark.read.format("binaryFile").load(path)
            .select(F.element_at(F.split("path", "/"), -1).alias("bundle"), "content"))


def archive(df: DataFrame, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html") -> DataFrame:
    """Write every row to bundles in the shared folder; returns the stored bundles."""
    return materialise(write_bundles(classify(df, id_col, url_col, payload_col)), "warc-bundles")
