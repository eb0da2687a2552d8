"""Near-duplicates by one-permutation MinHash, confirmed on full sets.

**Sets.**  A-Z are lower-cased; words are ``[^\\x20\\x09-\\x0D]+``; a document's set are
its distinct shingles of ``width`` consecutive words (all its words as one shingle
if it has fewer), as 64-bit hashes.  Documents with the same set form one class;
from here on a class counts once, however many copies it has.

**Signature.**  One hash per shingle; the leading bits choose one of ``BINS`` bins, a
bin keeps its smallest hash.  Empty bins are filled by optimal densification: each
bin has its own random order of donors and copies the first that is not empty.
``BANDS`` bands of ``ROWS`` bins give the bucket keys.

**Candidates.**  In a bucket all classes are paired with its smallest class only: a
star, so the number of pairs is bounded by the number of bucket entries.  Pairs
are confirmed on the full sets (threshold as a whole percentage, exact integer
arithmetic) and linked classes are joined to components.

**The rest, exactly.**  Two classes of a bucket may be linked with each other but
not with its centre.  A bucket that still holds several components is open; its
outsiders are the members outside its largest component.  Every open bucket takes
``CENTRES`` of its outsiders as new centres (by a hash of bucket and node) and confirms
their stars: that costs at most ``CENTRES`` rows per open entry, and an outsider that
was a centre is done, linked or not.  Outsiders that are left after that are compared with all members of other components, in blocks of
bounded bytes: only outsiders are dealt to chunks, and the others are sent to these
chunks alone.  So the rows follow a bucket's entries while its outsiders fit one
block, as they do in families of copies; a bucket of many texts that are all unlike
costs (entries x outsider blocks) rows.  Only links that join two components are
emitted.  No bucket is cut or left out.

Two sets at the threshold itself share no bucket with probability
(1 - 0.8 ** ROWS) ** BANDS = 5e-5 if hashes were independent; those of the bins of a
small set are not.  Measured on pairs at similarity 0.8 exactly: 3.5e-4 for sets of 4
and 5, 2.5e-4 for 9 and 9, 5e-5 for 18 and 18, 1e-4 for 180 and 180.  Sets of up to
``SMALL`` shingles therefore get the buckets of a second, independent signature
(none of 20,000 pairs missed at any of these sizes up to 45).

Null texts and texts without words have the empty set and are linked with nothing.
Repeated rows are copies.  A component is named by the smallest id of its rows;
ids that are null are ignored for that, and a component without any id has a null
name.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketlake.llm._components import connected, joined
from marketlake.llm._util import ROW, materialise, pick, release_memory, runs_of, salted_lookup

WIDTH = 5               # words in a shingle, unless the caller says otherwise
PERCENT = 80
ROWS, BANDS = 5, 25
BIN_BITS = 7
BINS = 1 << BIN_BITS
RUN_CHARS = 1_000_000   # characters of texts that are in work at once
PIECE_BYTES = 1 << 20   # a longer text is cut into words in pieces
BLOCK_BYTES = 2 << 20   # of sets: a piece of a star that one task confirms, one side of a block
CENTRES = 2             # further stars of open buckets before the search in blocks
SMALL = 80              # shingles; smaller sets have a second signature
SEED = 23

_ODD = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_MIX1, _MIX2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


# --- sets and signatures -------------------------------------------------------------------------

def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _MIX1
    x = (x ^ (x >> np.uint64(27))) * _MIX2
    return x ^ (x >> np.uint64(31))


def _powers(base: np.uint64, count: int) -> np.ndarray:
    out = np.full(count, base, dtype=np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


_WHITE = np.zeros(256, dtype=bool)
_WHITE[[0x20, 9, 10, 11, 12, 13]] = True
_GAP = re.compile(rb"[\x20\x09-\x0D]")
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def _word_hashes(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """(hash, first byte) of every word, from prefix sums of a polynomial over the bytes."""
    joined = _LOWER[np.frombuffer(text, dtype=np.uint8)]
    inner = np.r_[False, ~_WHITE[joined], False]
    edge = np.flatnonzero(inner[1:] != inner[:-1])
    start, end = edge[0::2], edge[1::2]
    n = len(joined) + 1
    prefix = np.zeros(n, dtype=np.uint64)
    np.cumsum((joined.astype(np.uint64) + np.uint64(1)) * _powers(_ODD, n - 1), out=prefix[1:])
    return _mix((prefix[end] - prefix[start]) * _powers(_INVERSE, n)[start] + (end - start).astype(np.uint64)), start


def _shingles(word: np.ndarray, width: int) -> np.ndarray:
    if not len(word):
        return np.zeros(0, dtype=np.uint64)
    if len(word) < width:
        return np.array([xxhash.xxh3_64_intdigest(word.tobytes())], dtype=np.uint64)
    run = word[:len(word) - width + 1].copy()
    for k in range(1, width):
        run = run * _ODD + word[k:len(word) - width + 1 + k]
    return np.unique(_mix(run))


def shingle_sets(texts: list[str | None], width: int = WIDTH) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text."""
    raw = [(t or "").encode() for t in texts]
    if len(raw) == 1 and len(raw[0]) > PIECE_BYTES:
        whole, at, parts = raw[0], 0, []
        while at < len(whole):
            cut = _GAP.search(whole, at + PIECE_BYTES)
            end = cut.end() if cut else len(whole)
            parts.append(_word_hashes(whole[at:end])[0])
            at = end
        return [_shingles(np.concatenate(parts), width)]
    word, start = _word_hashes(b"\n".join(raw))
    bounds = np.r_[0, np.searchsorted(start, np.cumsum([len(r) + 1 for r in raw]))]
    return [_shingles(word[a:b], width) for a, b in zip(bounds[:-1], bounds[1:], strict=True)]


def donor_order() -> np.ndarray:
    """For every bin a fixed random order of all bins (optimal densification)."""
    rng = np.random.default_rng(SEED)
    return np.stack([rng.permutation(BINS) for _ in range(BINS)])


def signatures(sets: list[np.ndarray], donors: np.ndarray) -> np.ndarray:
    """(sets, BINS) smallest hash per bin, densified.  All sets must have elements."""
    sizes = np.array([len(s) for s in sets])
    flat = np.concatenate(sets)
    cell = np.repeat(np.arange(len(sets)), sizes) * BINS + (flat >> np.uint64(64 - BIN_BITS)).astype(np.int64)
    first = np.flatnonzero(np.r_[True, cell[1:] != cell[:-1]])      # sets are sorted: the first is the smallest
    out = np.zeros(len(sets) * BINS, dtype=np.uint64)
    filled = np.zeros(len(sets) * BINS, dtype=bool)
    out[cell[first]], filled[cell[first]] = flat[first], True
    out, filled = out.reshape(-1, BINS), filled.reshape(-1, BINS)
    row, bin_ = np.nonzero(~filled)
    for turn in range(BINS):
        if not len(row):
            break
        donor = donors[bin_, turn]
        good = filled[row, donor]
        out[row[good], bin_[good]] = out[row[good], donor[good]]
        row, bin_ = row[~good], bin_[~good]
    return out


def band_keys(signature: np.ndarray) -> np.ndarray:
    """(sets, BANDS) bucket keys."""
    used = signature[:, :BANDS * ROWS].reshape(len(signature), BANDS, ROWS)
    key = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64) * _MIX1, used.shape[:2]).copy()
    for r in range(ROWS):
        key = _mix(key * _ODD + used[:, :, r])
    return key.view(np.int64)


_SECOND = np.uint64(0xD6E8FEB86659FD93)


def bucket_keys(sets: list[np.ndarray], donors: np.ndarray) -> list[np.ndarray]:
    """Bucket keys of sets that have elements."""
    keys = list(band_keys(signatures(sets, donors)))
    small = [i for i, s in enumerate(sets) if len(s) <= SMALL]
    if small:
        again = band_keys(signatures([np.sort(_mix(sets[i] ^ _SECOND)) for i in small], donors)) ^ _SECOND.view(np.int64)
        for i, more in zip(small, again, strict=True):
            keys[i] = np.concatenate([keys[i], more])
    return keys


def _digest(s: np.ndarray) -> bytes | None:
    return xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None


# --- comparing sets in a block -------------------------------------------------------------------

class Block:
    """Sets over a common vocabulary, for counting the intersections of one set with all."""

    def __init__(self, sets: list[np.ndarray]):
        self.sizes = np.array([len(s) for s in sets])
        self._ends = np.cumsum(self.sizes)
        vocabulary, self._ids = np.unique(np.concatenate(sets), return_inverse=True)
        self._mark = np.zeros(len(vocabulary), dtype=np.int32)

    def linked(self, one: int, percent: int) -> np.ndarray:
        """Whether each set is similar enough to set ``one``."""
        own = self._ids[self._ends[one] - self.sizes[one]:self._ends[one]]
        self._mark[own] = 1
        common = np.add.reduceat(self._mark[self._ids], self._ends - self.sizes)
        self._mark[own] = 0
        return 100 * common >= percent * (self.sizes[one] + self.sizes - common)


def _sets_of(pdf: pd.DataFrame) -> list[np.ndarray]:
    return [np.frombuffer(x, dtype=np.uint64) for x in pdf["elements"]]


def star_links(pdf: pd.DataFrame, percent: int) -> pd.DataFrame:
    """Members of one piece of a star that are linked with its centre."""
    centre = int(np.flatnonzero((pdf["node"] == pdf["hub"]).to_numpy())[0])
    hit = Block(_sets_of(pdf)).linked(centre, percent)
    hit[centre] = False
    return pd.DataFrame({"a": pdf["hub"][hit], "b": pdf["node"][hit]})


def joining_links(pdf: pd.DataFrame, percent: int) -> pd.DataFrame:
    """Links of a block's outsiders (``query``) with its other rows that join different components (a
    forest of them is enough).  An outsider may be among the other rows, too."""
    pdf = pdf.sort_values(["node", "query"]).reset_index(drop=True)
    block = Block(_sets_of(pdf))
    group, _ = pd.factorize(pdf["component"])
    group = group.astype(np.int64)
    query = pdf["query"].to_numpy()
    nodes = pdf["node"].to_numpy()
    out = []
    for q in np.flatnonzero(query):
        other = (group != group[q]) & ~query
        if not other.any():
            continue
        for hit in np.flatnonzero(block.linked(q, percent) & other):
            if group[hit] != group[q]:
                out.append((nodes[q], nodes[hit]))
                group[group == group[hit]] = group[q]
    return pd.DataFrame(out, columns=["a", "b"])


# --- Spark jobs ------------------------------------------------------------------------------------

def _signature_column(width: int):
    @F.arrow_udf("struct<n:long,node:binary,bands:array<long>>")
    def sign(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        donors = donor_order()
        for texts in batches:
            counts, nodes, bands, sizes = [], [], [], [0]
            for run in runs_of(texts, RUN_CHARS):
                sets = shingle_sets(run, width)
                counts += [len(s) for s in sets]
                nodes += [_digest(s) for s in sets]
                some = [s for s in sets if len(s)]
                keys = bucket_keys(some, donors) if some else []
                bands += keys
                size = iter(map(len, keys))
                sizes += [next(size) if len(s) else 0 for s in sets]
            keys = pa.array(np.concatenate(bands) if bands else np.zeros(0, np.int64), pa.int64())
            yield pa.StructArray.from_arrays(
                [pa.array(counts, pa.int64()), pa.array(nodes, pa.binary()),
                 pa.ListArray.from_arrays(pa.array(np.cumsum(sizes), pa.int32()), keys)], ["n", "node", "bands"])
        release_memory()

    return sign


def _elements_column(width: int):
    @F.arrow_udf("struct<node:binary,elements:binary>")
    def elements(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            nodes: list[bytes | None] = []
            out: list[bytes] = []
            for run in runs_of(texts, RUN_CHARS):
                sets = shingle_sets(run, width)
                nodes += [_digest(s) for s in sets]
                out += [s.tobytes() for s in sets]
            yield pa.StructArray.from_arrays([pa.array(nodes, pa.binary()), pa.array(out, pa.binary())],
                                             ["node", "elements"])
        release_memory()

    # the join's filter on the node must not go below it, or the sets are made twice, by two workers a task
    return elements.asNondeterministic()


def _pieces(bytes_: Column) -> Column:
    return F.greatest(F.lit(1), F.ceil(bytes_ / BLOCK_BYTES)).cast("int")


def _confirm_stars(stars: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Confirmed links (a, b) of star edges (hub, node, n); large stars are cut into pieces, each with
    its centre."""
    pieces = stars.groupBy("hub").agg(_pieces(F.sum("n") * 8).alias("pieces"))
    members = salted_lookup(stars, pieces, ["hub"], F.col("node")).select(
        "hub", F.pmod(F.xxhash64("node"), F.col("pieces")).cast("int").alias("piece"), "node")
    centres = pieces.select("hub", F.explode(F.sequence(F.lit(0), F.col("pieces") - 1)).alias("piece"),
                            F.col("hub").alias("node"))
    return (members.union(centres).join(sets, "node").groupBy("hub", "piece")
            .applyInPandas(lambda pdf: star_links(pdf, percent), "a binary, b binary"))


def _open_entries(entries: DataFrame, components: DataFrame) -> DataFrame:
    """Entries (bucket, node, n) of buckets with several components: with component, whether an outsider, and
    the pieces of the bucket (parts) and of its outsiders (chunks)."""
    named = entries.join(components, "node", "left").withColumn("component", F.coalesce("component", "node"))
    main = (named.groupBy("bucket", "component").agg(F.count(F.lit(1)).alias("members"), F.sum("n").alias("n"))
            .groupBy("bucket").agg(F.count(F.lit(1)).alias("components"), F.sum("n").alias("n"),
                                   F.max(F.struct("members", "component", "n")).alias("main"))
            .filter("components > 1")
            .select("bucket", F.col("main.component").alias("main"), _pieces(F.col("n") * 8).alias("parts"),
                    _pieces((F.col("n") - F.col("main.n")) * 8).alias("chunks")))
    return salted_lookup(named, main, ["bucket"], F.col("node")).select(
        "bucket", "node", "n", "component", (F.col("component") != F.col("main")).alias("outsider"), "parts", "chunks")


def _further_centres(open_: DataFrame) -> DataFrame:
    """Up to ``CENTRES`` outsiders of every open bucket: bucket, centre, own (its component).

    The smallest by hash of every residue class of the hash: minima, so they are taken map-side."""
    h = F.xxhash64("bucket", "node")
    least = F.min(F.struct(h.alias("h"), "node", "component")).alias("c")
    return (open_.filter("outsider").groupBy("bucket", F.pmod(h, F.lit(max(CENTRES, 1))).alias("turn")).agg(least)
            .select("bucket", F.col("c.node").alias("centre"), F.col("c.component").alias("own")))


def _dealt_blocks(open_: DataFrame) -> DataFrame:
    """Rows (bucket, i, j, node, component, query) of the blocks in which outsiders meet the members."""
    part = F.pmod(F.xxhash64("node"), F.col("parts")).cast("int")
    chunk = F.pmod(F.xxhash64("node", F.lit(1)), F.col("chunks")).cast("int")
    queries = open_.filter("outsider").select(
        "bucket", chunk.alias("i"), F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("j"), "node", "component",
        F.lit(True).alias("query"))
    others = open_.select("bucket", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("i"), part.alias("j"),
                         "node", "component", F.lit(False).alias("query"))
    return queries.union(others)


def _search_blocks(open_: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) of outsiders with members of other components, block by block."""
    return (_dealt_blocks(open_).join(sets, "node").groupBy("bucket", "i", "j")
            .applyInPandas(lambda pdf: joining_links(pdf, percent), "a binary, b binary"))


def _components(shared: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(node, component) of all links between classes that share a bucket (see the module's text).

    ``shared``: bucket, node, n, size, hub (the bucket's smallest node).
    """
    stars = shared.filter(F.col("node") != F.col("hub")).select("hub", "node", "n").distinct()
    components = connected(_confirm_stars(stars, sets, percent))
    # a bucket's centres need no further search; a pair is its own star
    left = shared.filter((F.col("size") > 2) & (F.col("node") != F.col("hub"))).select("bucket", "node", "n")
    open_ = materialise(_open_entries(left, components), "minhash-open")
    if open_.isEmpty():
        return components
    if CENTRES:
        centres = materialise(_further_centres(open_), "minhash-centres")
        lists = centres.groupBy("bucket").agg(F.collect_list(F.struct("centre", "own")).alias("centres"))
        met = salted_lookup(open_, lists, ["bucket"], F.col("node"))
        stars = met.select("node", "n", "component", F.explode("centres").alias("c")).filter("component <> c.own").select(
            F.col("c.centre").alias("hub"), "node", "n").distinct()
        components = joined(components, materialise(_confirm_stars(stars, sets, percent), "minhash-links"))
        done = centres.select("bucket", F.col("centre").alias("node")).hint("merge")
        left = open_.join(done, ["bucket", "node"], "left_anti")
        open_ = materialise(_open_entries(left.select("bucket", "node", "n"), components), "minhash-open")
        if open_.isEmpty():
            return components
    return joined(components, materialise(_search_blocks(open_, sets, percent), "minhash-links"))


def near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH,
                    percent: int = PERCENT, carry: bool = False) -> DataFrame:
    """Every row with doc_id, n_shingles, component_id (smallest id reachable) and kept."""
    src = pick(df, doc_id=id_col, text=text_col)
    signed = materialise(src.select("doc_id", _signature_column(width)(F.col("text")).alias("s"))
                         .select("doc_id", "s.*"), "minhash-signatures")
    classes = materialise(signed.filter("node is not null").groupBy("node")
                          .agg(F.min("doc_id").alias("low_id"), F.count(F.lit(1)).alias("copies"),
                               F.first("n").alias("n"), F.first("bands").alias("bands")), "minhash-classes")
    entries = classes.select("node", "n", F.explode("bands").alias("bucket"))
    # buckets with the same members count once
    buckets = (entries.groupBy("bucket")
               .agg(F.count(F.lit(1)).alias("size"), F.min("node").alias("hub"),
                    F.sum(F.xxhash64("node").cast("decimal(20,0)")).alias("print")).filter("size > 1")
               .groupBy("size", "print", "hub").agg(F.min("bucket").alias("bucket")))
    shared = materialise(salted_lookup(entries, buckets.select("bucket", "size", "hub"), ["bucket"], F.col("node")),
                         "minhash-buckets")
    # full sets of the classes that share a bucket, read from one document of each
    wanted = shared.select("node").distinct().join(classes.select("node", "low_id"), "node")
    sets = materialise(_full_sets(src, wanted, width), "minhash-sets")
    components = _components(shared, sets, percent)
    named = classes.join(components, "node", "left").withColumn("component", F.coalesce("component", "node"))
    names = named.groupBy("component").agg(F.min("low_id").alias("component_id"))
    lookup = salted_lookup(named.select("node", "component", "copies"), names, ["component"], F.col("node")).select(
        "node", "component_id")
    if carry:
        rows = pick(df, carry=True, doc_id=id_col, text=text_col)
        rows = rows.select("doc_id", ROW, _signature_column(width)(F.col("text")).alias("s")).select(
            "doc_id", ROW, F.col("s.n").alias("n"), F.col("s.node").alias("node"))
    else:
        rows = signed.select("doc_id", "n", "node")
    out = salted_lookup(rows, lookup, ["node"], F.col("doc_id"), "left")
    name = F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return out.select("doc_id", F.col("n").alias("n_shingles"), name.alias("component_id"),
                      F.col("doc_id").eqNullSafe(name).alias("kept"), *([ROW] if carry else []))


def _full_sets(src: DataFrame, wanted: DataFrame, width: int) -> DataFrame:
    """(node, elements) of the wanted classes (node, low_id), each from one of its rows.

    Classes whose rows all have null ids are found by their node instead of the id.
    """
    ids = wanted.filter("low_id is not null").select(F.col("low_id").alias("doc_id")).distinct()
    # written first: a filter on the sets must not move below the join and run over all texts
    texts = materialise(src.join(ids, "doc_id").select("text").union(src.filter("doc_id is null").select("text")),
                        "minhash-texts")
    found = texts.select(_elements_column(width)(F.col("text")).alias("s")).select("s.node", "s.elements")
    return (found.join(wanted.select("node"), "node", "left_semi").groupBy("node")
            .agg(F.first("elements").alias("elements")))
