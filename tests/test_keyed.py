"""Upsert laws (K01, K03, K10) on a persisted keyed table."""
import datetime as dt
import re

import pytest
from pyspark.sql import functions as F

from marketlake.session import scratch_path
from marketlake.sinks.keyed import KeyedTable, insert_ignore, merge_frames

DDL = "d date, k string, v long, note string"


def snap(spark, path):
    return sorted(tuple(r) for r in spark.read.parquet(path).select("d", "k", "v", "note").collect())


def batch(spark, rows):
    return spark.createDataFrame(rows, DDL)


D1, D2 = dt.date(2024, 1, 1), dt.date(2024, 1, 2)


def test_upsert_insert_update_idempotent(spark):
    path = scratch_path(spark, "t-upsert")
    t = KeyedTable(spark, path, ["d", "k"], ["d"])
    t.upsert(batch(spark, [(D1, "a", 1, "x"), (D1, "b", 2, "y"), (D2, "a", 3, "z")]), as_of=dt.datetime(2024, 1, 5))
    b2 = batch(spark, [(D1, "a", 10, None), (D2, "c", 4, "w")])
    t.upsert(b2, as_of=dt.datetime(2024, 1, 6))
    once = snap(spark, path)
    assert once == sorted([(D1, "a", 10, None), (D1, "b", 2, "y"), (D2, "a", 3, "z"), (D2, "c", 4, "w")])
    t.upsert(b2, as_of=dt.datetime(2024, 1, 6))
    assert snap(spark, path) == once  # idempotent
    r = spark.read.parquet(path).where("k = 'a' and d = date'2024-01-01'").first()
    assert r["created_at"] == dt.datetime(2024, 1, 5) and r["updated_at"] == dt.datetime(2024, 1, 6)


def test_disjoint_batches_commute(spark):
    a = [(D1, "a", 1, "x")]
    b = [(D2, "b", 2, "y")]
    p1, p2 = scratch_path(spark, "t-c1"), scratch_path(spark, "t-c2")
    for path, order in ((p1, (a, b)), (p2, (b, a))):
        t = KeyedTable(spark, path, ["d", "k"], ["d"], audit=False)
        for rows in order:
            t.upsert(batch(spark, rows))
    assert snap(spark, p1) == snap(spark, p2)


def test_duplicate_keys_and_null_keys(spark):
    path = scratch_path(spark, "t-dup")
    t = KeyedTable(spark, path, ["d", "k"], ["d"], audit=False)
    with pytest.raises(ValueError):
        t.upsert(batch(spark, [(D1, "a", 1, "x"), (D1, "a", 2, "y")]))
    rejects = t.upsert(batch(spark, [(D1, "a", 1, "x"), (D1, "a", 2, "y"), (D1, None, 3, "n")]), order_by=["v desc"])
    assert rejects.count() == 1
    assert snap(spark, path) == [(D1, "a", 2, "y")]


def test_missing_columns_modes(spark):
    cur = batch(spark, [(D1, "a", 1, "keep me")])
    b = spark.createDataFrame([(D1, "a", 5)], "d date, k string, v long")
    assert merge_frames(cur, b, ["d", "k"], missing="null").first()["note"] is None
    assert merge_frames(cur, b, ["d", "k"], missing="keep").first()["note"] == "keep me"


def test_insert_ignore(spark):
    cur = batch(spark, [(D1, "a", 1, "old")])
    b = batch(spark, [(D1, "a", 9, "new"), (D1, "b", 2, "new")])
    got = sorted(tuple(r) for r in insert_ignore(cur, b, ["d", "k"]).collect())
    assert got == [(D1, "a", 1, "old"), (D1, "b", 2, "new")]
    path = scratch_path(spark, "t-ii")
    t = KeyedTable(spark, path, ["d", "k"], ["d"], audit=False)
    t.upsert(cur)
    t.insert_ignore(b)
    assert snap(spark, path) == [(D1, "a", 1, "old"), (D1, "b", 2, "new")]


def test_text_keys_keep_their_type_and_cleaning(spark):
    t = KeyedTable(spark, scratch_path(spark, "t-types"), ["code"], ["code"], audit=False)
    t.upsert(spark.createDataFrame([("007", 1.0, "x"), ("1E2", 2.0, "")], "code string, rate double, note string"))
    t.upsert(spark.createDataFrame([("007", "12.5%", "y")], "Code string, Rate string, Note string"))
    got = sorted(tuple(r) for r in t.read().select("code", "rate", "note").collect())
    assert got == [("007", 0.125, "y"), ("1E2", 2.0, None)]
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        t.upsert(spark.createDataFrame([("8", "junk")], "code string, rate string"))


def _dies(*_, **__):
    raise OSError("killed")


@pytest.mark.parametrize("partition_cols", [["d"], []])
def test_cut_replacement_is_finished_or_never_begun(spark, monkeypatch, partition_cols):
    from marketlake.sinks import keyed, tables
    path = scratch_path(spark, "t-cut")
    t = KeyedTable(spark, path, ["d", "k"], partition_cols, audit=False)
    t.upsert(batch(spark, [(D1, "a", 1, "x"), (D2, "b", 2, "y")]))
    old = snap(spark, path)
    # dies before the copy is complete: the old table stays
    with monkeypatch.context() as m:
        m.setattr(KeyedTable, "_replace", _dies)
        with pytest.raises(OSError):
            t.upsert(batch(spark, [(D1, "a", 9, "new")]))
    assert snap(spark, path) == old == sorted(tuple(r) for r in t.read().select("d", "k", "v", "note").collect())
    # dies with the copy complete, before or after the partitions are replaced: the next read does it again
    new = [(D1, "a", 9, "new"), (D2, "b", 2, "y")]
    with monkeypatch.context() as m:
        m.setattr(keyed, "replace_from_stage", lambda *a: None)
        t.upsert(batch(spark, [(D1, "a", 9, "new")]))
    assert snap(spark, path) == old and t._folder.exists() and tables.Folder(spark, tables.staged_path(path)).exists()
    assert sorted(tuple(r) for r in t.read().select("d", "k", "v", "note").collect()) == new
    with monkeypatch.context() as m:
        m.setattr(tables.Folder, "delete", _dies)
        with pytest.raises(OSError):
            t.upsert(batch(spark, [(D1, "a", 10, "newer")]))
    assert sorted(tuple(r) for r in t.read().select("d", "k", "v", "note").collect()) == [(D1, "a", 10, "newer"), new[1]]
    assert not tables.Folder(spark, tables.staged_path(path)).exists()


def _files(path):
    """Data files with their times of change."""
    import os
    return {os.path.join(at, n): os.stat(os.path.join(at, n)).st_mtime_ns
            for at, _, names in os.walk(path) for n in names if n.endswith(".parquet")}


def test_an_upsert_rewrites_only_touched_buckets(spark):
    path = scratch_path(spark, "t-buckets")
    t = KeyedTable(spark, path, ["k"], audit=False, buckets=16)
    rows = spark.range(1000).select(F.col("id").cast("string").alias("k"), F.col("id").alias("v"), F.lit("n").alias("note"))
    t.upsert(rows)
    before = _files(path)
    assert len({f.split("__bucket=")[1].split("/")[0] for f in before}) == 16
    t.upsert(rows.where("k in ('7', '11')").withColumn("v", -F.col("v")).union(
        spark.createDataFrame([("new", 5, "n")], "k string, v long, note string")))
    after = _files(path)
    changed = {f.split("__bucket=")[1].split("/")[0] for f, _ in set(before.items()) ^ set(after.items())}
    assert 1 <= len(changed) <= 3
    got = {r.k: r.v for r in t.read().collect()}
    assert got == {**{str(i): i for i in range(1000)}, "7": -7, "11": -11, "new": 5}
    # inserts that ignore conflicts leave every stored file as it is
    t.insert_ignore(spark.createDataFrame([("7", 1, "n"), ("other", 6, "n")], "k string, v long, note string"))
    assert set(after.items()) <= set(_files(path).items()) and {r.k: r.v for r in t.read().collect()} == {**got, "other": 6}
    assert t.read().columns == ["k", "v", "note"]


def test_upserts_read_only_touched_buckets(spark):
    t = KeyedTable(spark, scratch_path(spark, "t-pruned"), ["k"], audit=False, buckets=64)
    t.upsert(spark.range(500).select(F.col("id").alias("k"), F.lit("x").alias("v")))
    plan = t._touched(spark.createDataFrame([(3, "y")], "k long, v string"))
    scan = plan._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^]]*__bucket#\d+ = \d+", scan)


def test_untouched_partitions_and_stages(spark):
    import os
    path = scratch_path(spark, "t-part")
    t = KeyedTable(spark, path, ["d", "k"], ["d"], audit=False)
    t.upsert(batch(spark, [(D1, "a", 1, "x"), (D2, "b", 2, "y")]))
    before = sorted(os.listdir(f"{path}/d=2024-01-02"))
    t.upsert(batch(spark, [(D1, "c", 1, "x")]))
    t.fix_values("v", 1, 100, F.col("k") == "c")
    assert sorted(os.listdir(f"{path}/d=2024-01-02")) == before
    assert {x for x in os.listdir(path) if x.startswith("_")} == {"_schema.json", "_SUCCESS"}
    assert not os.path.exists(f"{path}__next")
    assert snap(spark, path) == [(D1, "a", 1, "x"), (D1, "c", 100, "x"), (D2, "b", 2, "y")]


def test_foreign_keys_are_enforced_at_load(spark):
    from marketlake.operators.constraints import ForeignKey, enforce
    orders = spark.createDataFrame([("o1",), ("o2",), ("o2",), (None,)], "id string")
    pairs = spark.createDataFrame([(1, "x"), (2, None)], "a int, b string")
    keys = [ForeignKey("items_order_fk", ["order_id"], orders, ["id"]), ForeignKey("pair_fk", ["a", "b"], pairs)]
    items = spark.createDataFrame([(1, "o1", 1, "x"), (2, "o9", 1, "x"), (3, "o2", 2, "x"), (4, "o9", 7, "y"),
                                   (5, None, 2, None), (None, "o1", 1, "x")], "item int, order_id string, a int, b string")
    good, bad = enforce(items, keys)
    assert sorted(r.item or 0 for r in good.collect()) == [0, 1, 5]
    assert {r.item: r._violated for r in bad.collect()} == {
        2: ["items_order_fk"], 3: ["pair_fk"], 4: ["items_order_fk", "pair_fk"]}
    t = KeyedTable(spark, scratch_path(spark, "t-fk"), ["item"], audit=False, foreign_keys=keys)
    rejects = t.upsert(items)
    assert {r.item: r._violated for r in rejects.collect()} == {
        None: [], 2: ["items_order_fk"], 3: ["pair_fk"], 4: ["items_order_fk", "pair_fk"]}
    assert t.read().columns == items.columns and sorted(r.item for r in t.read().collect()) == [1, 5]
    t.insert_ignore(spark.createDataFrame([(6, "o2", 1, "x"), (7, "none", 1, "x")], items.schema))
    assert sorted(r.item for r in t.read().collect()) == [1, 5, 6]


def test_ledger_of_loaded_files(spark, tmp_path):
    import os
    from marketlake.operators.incremental import load_unloaded
    land, ledger, path = tmp_path / "land [1]", str(tmp_path / "ledger"), scratch_path(spark, "t-ledger")
    land.mkdir()
    t = KeyedTable(spark, path, ["k"], audit=False)
    schema = "k int, v string"

    def run():
        files = load_unloaded(spark, str(land).replace("[", "\\[").replace("]", "\\]"), "*.csv", ledger,
                              lambda paths: spark.read.schema(schema).csv(paths), lambda df: t.upsert(df, order_by=["v desc"]))
        return [os.path.basename(f) for f in files]

    (land / "1 a.csv").write_text("1,a\n2,b\n")
    assert len(run()) == 1 and run() == []
    (land / "late.csv").write_text("3,late\n")
    os.utime(land / "late.csv", (1, 1))                       # older than everything that was loaded
    (land / "1 a.csv").write_text("1,changed\n")
    with pytest.raises(ZeroDivisionError):                   # a load that dies is done again
        load_unloaded(spark, str(land).replace("[", "\\[").replace("]", "\\]"), "*.csv", ledger, lambda p: None, lambda d: 1 / 0)
    assert len(run()) == 2 and run() == []
    assert sorted(tuple(r) for r in t.read().collect()) == [(1, "changed"), (2, "b"), (3, "late")]
