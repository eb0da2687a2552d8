"""Merkle manifest against a plain in-memory tree."""
import hashlib

import pytest
from pyspark.sql import functions as F

from cases import SCHEMA, odd_rows, with_extra
from marketlake.llm import merkle


def digest(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row):
    i, text, lang, source, n = row
    return digest(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in (i, source, lang, n, text)])


def tree(nodes):
    """(root, siblings of every leaf from leaf to root)."""
    proofs, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for leaf_no, place in enumerate(at):
            run = place // 16 * 16
            proofs[leaf_no] += nodes[run:place] + nodes[place + 1:run + 16]
            at[leaf_no] = place // 16
        nodes = [digest(*nodes[k:k + 16]) for k in range(0, len(nodes), 16)]
    return (nodes[0] if nodes else None), proofs


def brute(rows):
    sources = sorted({r[3] for r in rows}, key=lambda s: (s is not None, (s or "").encode()))
    groups = [sorted(((r[0] is not None, r[0] or 0, leaf(r)) for r in rows if r[3] == s)) for s in sources]
    trees = [tree([x[2] for x in g]) for g in groups]
    root, upper = tree([t[0] for t in trees])
    out = []
    for g, (subroot, proofs), up in zip(groups, trees, upper):
        out += [(x[1] if x[0] else None, x[2], subroot, root, digest(*p, *up)) for x, p in zip(g, proofs)]
    return sorted(out, key=repr)


def result(df, **kw):
    m = merkle.manifest(df, **kw)
    return m.select("doc_id", "leaf", "subroot", "root", merkle.proof_digest(F.col("proof")).alias("p"),
                    merkle.fold(F.col("claimed"), F.col("proof")).alias("folded"))


def sized(n, source):
    return [(1000 + i, f"text {i}", None, source, i) for i in range(n)]


@pytest.mark.parametrize("rows", [
    odd_rows(), sized(1, None), sized(16, "a") + sized(17, "b") + sized(256, None), sized(257, "ä") + sized(1, "z"),
    sized(600, "hot") + [(i, "t", "en", f"s{i}", 1) for i in range(40)]],
    ids=["odd", "one", "full runs", "one more than a subtree", "many sources"])
def test_equals_a_plain_tree(spark, rows):
    df = with_extra(spark.createDataFrame(rows, SCHEMA)).repartition(3)
    got = [tuple(r) for r in result(df).collect()]
    assert sorted((r[:5] for r in got), key=repr) == brute(rows)
    assert all(r[5] == r[3] for r in got)


def test_a_changed_field_does_not_fold_to_the_root(spark):
    rows = sized(300, "a") + odd_rows()
    upper = F.when(F.col("doc_id") % 3 == 0, F.upper("f_text")).otherwise(F.col("f_text"))
    got = result(spark.createDataFrame(rows, SCHEMA), claim={"text": upper}).collect()
    changed = {i for i, t, *_ in rows if i is not None and i % 3 == 0 and t and t != t.upper()}
    assert changed and {r.doc_id for r in got if r.folded != r.root} == changed


def test_only_every_second_level_is_stored(spark):
    leaves = spark.range(70_000).select(F.lit("").alias("key"), F.col("id").alias("idx"), F.lit(70_000).cast("long").alias("n"),
                                        merkle.h(F.col("id").cast("string")).alias("digest"))
    assert [x.count() for x in merkle.grow(leaves)] == [70_000, 274, 2, 1]


def test_no_rows(spark):
    assert result(spark.createDataFrame([], SCHEMA)).collect() == []
