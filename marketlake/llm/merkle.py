"""Merkle manifest of a dataset: one tree per group, one tree over the groups' roots.

**Digests.**  H is the lower-case hex SHA-256 of its inputs, concatenated; digests go in
as hex text.  A leaf is H of a row's fields, each ``-`` if null, else its UTF-8 length in
bytes, ``:`` and the value.  In a group the leaves ascend by id (null ids first, equal ids
by leaf).  While a tree has several nodes, every ``FANOUT`` consecutive ones become their
H (the last run may be shorter, even one).  What remains is the group's subroot; the
subroots, by group (null first, else bytewise), make one more tree: the root.

**Checkpoint and recompute.**  Only every ``STEP``-th level is stored (``materialise``).
The nodes of a stored level under one node of the next are an aligned subtree of at most
``FANOUT ** STEP`` nodes.  A proof needs siblings of the levels between, too: a subtree is
read from its stored descendants, its interior nodes are made again, the siblings of every
node are emitted, and the interior nodes are gone with the row.  Proofs are put together
from the top: a subtree is joined with the one path of its parent.

**Scale.**  Positions come from a range partitioning on (group, id), so a group that holds
a third of the rows spreads over many tasks, and per-(group, partition) counts give the
offsets.  No task sees more of a tree than one subtree.

A proof is an array of (left, right), from the leaf to the root: the siblings' digests of
one run before and after the node, concatenated.  ``fold`` climbs it.  Empty tables give
empty results; rows that repeat are leaves of their own; texts of any length are one leaf.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marketlake.llm._util import materialise, pick

FANOUT = 16
STEP = 2            # levels from one stored level to the next
SUBTREE = FANOUT ** STEP


def h(*parts: Column) -> Column:
    return F.sha2(F.concat(*parts), 256)


def leaf(*fields: Column) -> Column:
    """H of the fields of a row."""
    texts = [f.cast("string") for f in fields]
    return h(*[F.when(t.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t))
               for t in texts])


def proof_digest(proof: Column) -> Column:
    """H of all siblings of a proof, level by level, left to right."""
    return F.sha2(F.array_join(F.transform(proof, lambda p: F.concat(p["left"], p["right"])), ""), 256)


def fold(digest: Column, proof: Column) -> Column:
    """The root that a leaf's digest and its proof lead to."""
    return F.aggregate(proof, digest, lambda acc, p: h(p["left"], acc, p["right"]))


# --- trees -----------------------------------------------------------------------------------------

def _up(n: Column) -> Column:
    """Nodes of a tree one level higher."""
    return F.ceil(n / FANOUT).cast("long")


def _numbered(rows: DataFrame, order: Sequence[str]) -> DataFrame:
    """``rows`` (key, ...) with idx, their place under (key, order), and n, the rows of their key."""
    by = ["key", *order]
    low = F.lit((1 << 33) - 1)
    placed = materialise(rows.repartitionByRange(*by).sortWithinPartitions(*by).select(
        "*", F.spark_partition_id().alias("part"), F.monotonically_increasing_id().bitwiseAND(low).alias("at")),
        "merkle-order")
    counts = placed.groupBy("key", "part").agg(F.count(F.lit(1)).alias("size"), F.min("at").alias("first"))
    key = Window.partitionBy("key")
    ahead = F.sum("size").over(key.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    starts = counts.select("key", "part", (F.coalesce(ahead, F.lit(0)) - F.col("first")).alias("shift"),
                           F.sum("size").over(key).alias("n"))
    return (placed.join(starts.hint("merge"), ["key", "part"])
            .withColumn("idx", F.col("at") + F.col("shift")).drop("part", "at", "shift"))


def _subtrees(level: DataFrame, *carried: str) -> DataFrame:
    """One row per aligned subtree of a stored level: key, n, block, nodes (in order), runs (made again)."""
    node = F.struct("idx", "digest", *carried)
    rows = (level.filter("n > 1").groupBy("key", "n", F.floor(F.col("idx") / SUBTREE).cast("long").alias("block"))
            .agg(F.array_sort(F.collect_list(node)).alias("nodes")))
    digests = F.transform("nodes", lambda x: x["digest"])
    return rows.withColumn("digests", digests).withColumn("runs", F.transform(
        F.sequence(F.lit(0), F.floor((F.size("digests") - 1) / FANOUT).cast("int")),
        lambda r: h(F.array_join(F.slice("digests", r * FANOUT + 1, FANOUT), ""))))


def _parents(level: DataFrame) -> DataFrame:
    """The next stored level: key, idx, n, digest."""
    one = F.col("n") <= FANOUT      # the tree ends one level up
    return _subtrees(level).select(
        "key", F.col("block").alias("idx"), F.when(one, F.lit(1)).otherwise(_up(_up(F.col("n")))).cast("long").alias("n"),
        F.when(one, F.col("runs")[0]).otherwise(h(F.array_join("runs", ""))).alias("digest"))


def grow(leaves: DataFrame) -> list[DataFrame]:
    """Stored levels of the trees over ``leaves`` (key, idx, n, digest, ...); a tree's last node has n = 1."""
    levels = [leaves]
    while (levels[-1].agg(F.max("n")).first()[0] or 1) > 1:
        levels.append(materialise(_parents(levels[-1]), "merkle-level"))
    return levels


def tops(levels: Sequence[DataFrame]) -> DataFrame:
    """key, digest of every tree's last node."""
    out = levels[0].filter("n = 1").select("key", "digest")
    for level in levels[1:]:
        out = out.union(level.filter("n = 1").select("key", "digest"))
    return out


def _segment(node: Column) -> Column:
    """Siblings of a node inside its subtree: of its run and, if the tree goes on, of the run's run."""
    place = (node["idx"] - F.col("block") * SUBTREE).cast("int")
    run = F.floor(place / FANOUT).cast("int")
    inside = place - run * FANOUT

    def pair(items: str, start: Column, before: Column) -> Column:
        return F.struct(F.array_join(F.slice(items, start + 1, before), "").alias("left"),
                        F.array_join(F.slice(items, start + before + 2, F.lit(FANOUT - 1) - before), "").alias("right"))

    lower = pair("digests", run * FANOUT, inside)
    upper = pair("runs", F.lit(0), run)
    return F.when(F.col("n") <= FANOUT, F.array(lower)).otherwise(F.array(lower, upper))


def extract(levels: Sequence[DataFrame], above: DataFrame, carried: Sequence[str] = ()) -> DataFrame:
    """key, idx, digest, ``carried``, subroot, root and proof of every node of the lowest level.

    ``above``: key, subroot, root, proof, one row per tree, from the tree's last node on.
    """
    paths: DataFrame | None = None
    for k in range(len(levels) - 1, -1, -1):
        level, extra = levels[k], carried if k == 0 else ()
        ends = level.filter("n = 1").join(above.hint("merge"), "key").select("key", "idx", "digest", *extra, "subroot", "root", "proof")
        if paths is not None:
            parents = paths.select("key", F.col("idx").alias("block"), "subroot", "root", "proof")
            rows = _subtrees(level, *extra).join(parents.hint("merge"), ["key", "block"])
            inner = rows.select("key", "subroot", "root", F.explode(F.transform("nodes", lambda x: F.struct(
                x.alias("node"), F.concat(_segment(x), F.col("proof")).alias("proof")))).alias("x"))
            ends = ends.unionByName(inner.select("key", "x.node.*", "subroot", "root", "x.proof"))
        # upper levels are small next to the lowest; their paths are stored for the next one down
        paths = ends if k == 0 else materialise(ends, "merkle-paths")
    return paths


def manifest(df: DataFrame, group_col: str = "source", id_col: str = "doc_id",
             fields: Sequence[str] = ("doc_id", "source", "lang", "n_chars", "text"),
             claim: dict[str, Column] | None = None) -> DataFrame:
    """Every row with doc_id, leaf, claimed, subroot, root and proof.

    ``claimed`` is the leaf of the row with the fields in ``claim`` replaced: expressions over
    the names ``f_<field>`` and ``doc_id`` (none: the leaf itself).
    """
    names = {f"f_{f}": f for f in fields}
    src = pick(df, doc_id=id_col, source=group_col, **names)
    other = [claim[f] if claim and f in claim else F.col(f"f_{f}") for f in fields]
    own = leaf(*[F.col(f"f_{f}") for f in fields])
    rows = src.select(F.coalesce(F.concat(F.lit("="), F.col("source").cast("string")), F.lit("")).alias("key"),
                      "doc_id", own.alias("digest"), (leaf(*other) if claim else own).alias("claimed"))
    # texts are read once; placing the leaves samples and sorts a narrow table
    leaves = materialise(_numbered(materialise(rows, "merkle-leaves"), ["doc_id", "digest", "claimed"]), "merkle-level")
    levels = grow(leaves)
    subroots = materialise(tops(levels), "merkle-tops").select(F.lit("").alias("key"), F.col("key").alias("tree"), "digest")
    top = grow(materialise(_numbered(subroots, ["tree"]), "merkle-level"))
    root = tops(top).select("key", F.col("digest").alias("subroot"), F.col("digest").alias("root"),
                            F.expr("cast(array() as array<struct<left:string,right:string>>)").alias("proof"))
    above = extract(top, root, ["tree"]).select(
        F.col("tree").alias("key"), F.col("digest").alias("subroot"), "root", "proof")
    proofs = extract(levels, materialise(above, "merkle-paths"), ["doc_id", "claimed"])
    return proofs.select("doc_id", F.col("digest").alias("leaf"), "claimed", "subroot", "root", "proof")
