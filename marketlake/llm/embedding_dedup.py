"""Near-duplicates of embeddings by collision-counting projections.

**Projections.**  Unit vectors are projected on ``PROJECTIONS`` (at most the dimension)
orthonormal directions, a seeded random rotation.  Along each direction the rows
are sorted, and every query counts the rows inside a window centred on its own
value: one collision for such a row.

**Calibrated count.**  Vectors with a cosine of at least c lie at most
sqrt(2 - 2c) apart, and the squares of their differences along orthonormal
directions add up to no more than the square of that.  With a half width of w at
most (2 - 2c) / w ** 2 directions can miss.  w is chosen so that a quarter of them
may, and pairs that collide in the other three quarters are verified by their
cosine in double precision.  The calibration is to a recall of 1: no link is lost,
in whatever way the vectors are distributed.

**Blocks.**  Vectors are compared only inside their label.  A label's vectors are
dealt to blocks of about ``BLOCK`` rows and each pair of blocks is one task, so a
label that holds a third of all rows is many tasks and no task holds a label.
Equal vectors of a label are one class with a number of copies; a class is
compared once.  Tasks emit no pairs: each emits, per class, the number of linked
vectors, and a forest of links for the components.  The work of a label grows with
the square of its distinct vectors.

Vectors that are null, empty or zero, or hold null or non-finite components, and
rows with a null label link with nothing; vectors of different dimension are never
linked.  Repeated rows are copies and link with each other.  A component's name is
the smallest of its ids that are not null (null if there is none); a row that links
with nothing is its own component.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlake.llm._components import connected
from marketlake.llm._util import ROW, materialise, pick, salted_lookup

COSINE = 0.93
PROJECTIONS = 32
MISSES = 4          # one in so many directions may miss
BLOCK = 400         # vectors of a label in one side of a block
SEED = 41


# --- numpy --------------------------------------------------------------------------------------

def rotation(dim: int, count: int = PROJECTIONS) -> np.ndarray:
    """(dim, min(dim, count)) orthonormal directions."""
    q, _ = np.linalg.qr(np.random.default_rng(SEED).standard_normal((dim, dim)))
    return q[:, :min(dim, count)]


def window(cosine: float, directions: int) -> tuple[float, int]:
    """(half width, collisions that a linked pair has at least)."""
    apart = 2 - 2 * cosine
    misses = max(directions // MISSES, 1)
    # the margin is far above rounding errors and far below the width
    return float(np.sqrt(apart / (misses + 0.5))) + 1e-9, directions - misses


def count_collisions(queries: np.ndarray, rows: np.ndarray, half: float) -> np.ndarray:
    """(queries, rows): number of directions in which the row lies in the query's window.

    Along a direction a window is a range of places in the sorted rows; whether a row's place lies
    in it takes one subtraction and one comparison (places wrap around below the range's start).
    """
    counts = np.zeros((len(queries), len(rows)), dtype=np.uint8)
    place = np.empty(len(rows), dtype=np.uint32)
    for d in range(queries.shape[1]):
        order = np.argsort(rows[:, d], kind="stable")
        place[order] = np.arange(len(rows), dtype=np.uint32)
        line = rows[order, d]
        low = np.searchsorted(line, queries[:, d] - half, "left").astype(np.uint32)
        width = np.searchsorted(line, queries[:, d] + half, "right").astype(np.uint32) - low
        counts += (place[None, :] - low[:, None]) < width[:, None]
    return counts


def links(left: np.ndarray, right: np.ndarray, cosine: float) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs (left, right) with at least the given cosine; rows are scaled vectors, not zero."""
    norm_l, norm_r = np.linalg.norm(left, axis=1), np.linalg.norm(right, axis=1)
    directions = rotation(left.shape[1])
    half, least = window(cosine, directions.shape[1])
    counts = count_collisions(left / norm_l[:, None] @ directions, right / norm_r[:, None] @ directions, half)
    a, b = np.nonzero(counts >= least)
    exact = np.einsum("ij,ij->i", left[a], right[b]) / (norm_l[a] * norm_r[b])
    return a[exact >= cosine], b[exact >= cosine]


def block_links(pdf: pd.DataFrame, cosine: float) -> pd.DataFrame:
    """Of one pair of blocks: (a, null, links) per class with links, and (a, b, 0) for a forest."""
    pdf = pdf.sort_values("node").reset_index(drop=True)
    vectors = np.stack([np.frombuffer(v, dtype=np.float64) for v in pdf["vector"]])
    side, copies, nodes = (pdf[c].to_numpy() for c in ("side", "copies", "node"))
    inside = bool((side == -1).all())
    low = np.arange(len(pdf)) if inside else np.flatnonzero(side == side.min())
    high = low if inside else np.flatnonzero(side != side.min())
    counts = np.zeros(len(pdf), dtype=np.int64)
    forest = []
    if len(low) and len(high):
        a, b = links(vectors[low], vectors[high], cosine)
        a, b = low[a], high[b]
        if inside:
            a, b = a[a < b], b[a < b]
        counts += np.bincount(a, weights=copies[b], minlength=len(pdf)).astype(np.int64)
        counts += np.bincount(b, weights=copies[a], minlength=len(pdf)).astype(np.int64)
        group = np.arange(len(pdf))
        for i, j in zip(a.tolist(), b.tolist(), strict=True):
            if group[i] != group[j]:
                forest.append((nodes[i], nodes[j], 0))
                group[group == group[j]] = group[i]
    some = np.flatnonzero(counts)
    rows = [(nodes[i], None, int(counts[i])) for i in some] + forest
    return pd.DataFrame(rows, columns=["a", "b", "links"])


def _prepare(vectors: pa.Array) -> pa.Array:
    """Per vector: its values in double precision, scaled by the largest (null: links with nothing)."""
    out = []
    for v in vectors:
        x = v.values if v.is_valid else None
        if x is None or not len(x) or x.null_count:
            out.append(None)
            continue
        y = x.to_numpy(zero_copy_only=False).astype(np.float64)
        top = np.abs(y).max()
        out.append((y / top).tobytes() if np.isfinite(top) and top > 0 else None)
    return pa.array(out, pa.binary())


def _digests(vectors: pa.Array) -> pa.Array:
    return pa.array([None if v is None else xxhash.xxh3_128_digest(v) for v in vectors.to_pylist()], pa.binary())


# --- Spark jobs -----------------------------------------------------------------------------------

def near_duplicates(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding",
                    label_col: str = "label", cosine: float = COSINE, carry: bool = False) -> DataFrame:
    """Every row with vec_id, n_links, component_id and kept (and ``row`` if ``carry``)."""
    src = pick(df, carry=carry, vec_id=id_col, vector=vector_col, label=label_col)
    scaled, digest = F.arrow_udf(_prepare, "binary"), F.arrow_udf(_digests, "binary")
    rows = src.select("vec_id", "label", scaled(F.col("vector")).alias("vector"), *([ROW] if carry else []))
    key = F.concat_ws(":", F.col("label").cast("string"), F.hex(digest(F.col("vector"))))
    rows = materialise(rows.withColumn("node", F.when(
        F.col("label").isNotNull() & F.col("vector").isNotNull(), key)), "embedding-rows")
    classes = materialise(
        rows.filter("node is not null").groupBy("node")
        .agg(F.min("vec_id").alias("low_id"), F.count(F.lit(1)).alias("copies"),
             F.first("label").alias("label"), F.first("vector").alias("vector"))
        .withColumn("part", F.struct("label", F.octet_length("vector").alias("bytes"))), "embedding-classes")
    parts = classes.groupBy("part").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("blocks"))
    dealt = salted_lookup(classes.select("part", "node", "copies", "vector"), parts, ["part"], F.col("node"))
    dealt = (dealt.withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
             .withColumn("with", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))))
    pairs = dealt.select("part", F.least("block", "with").alias("i"), F.greatest("block", "with").alias("j"),
                         F.when(F.col("block") == F.col("with"), -1).otherwise(F.col("block")).alias("side"),
                         "node", "copies", "vector")
    # the task (i, i) compares inside block i, the task (i, j) only across
    found = materialise(pairs.groupBy("part", "i", "j").applyInPandas(
        lambda pdf: block_links(pdf[["side", "node", "copies", "vector"]], cosine),
        "a string, b string, links long"), "embedding-links")
    counts = found.filter("b is null").groupBy(F.col("a").alias("node")).agg(F.sum("links").alias("links"))
    components = connected(found.filter("b is not null"))
    named = (classes.select("node", "low_id", "copies").join(components, "node", "left").join(counts, "node", "left")
             .withColumn("component", F.coalesce("component", "node")))
    names = named.groupBy("component").agg(F.min("low_id").alias("name"))
    lookup = salted_lookup(named, names, ["component"], F.col("node")).select(
        "node", "name", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).cast("long").alias("n_links"))
    out = salted_lookup(rows.drop("vector", "label"), lookup, ["node"], F.col("vec_id"), "left")
    name = F.when(F.col("node").isNull(), F.col("vec_id")).otherwise(F.col("name"))
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                      name.alias("component_id"), F.col("vec_id").eqNullSafe(name).alias("kept"),
                      *([ROW] if carry else []))
