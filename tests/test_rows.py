"""De-duplication, joins, set operations (W*, A09, F06, J*, U*)."""
import datetime as dt

from pyspark.sql import functions as F

from marketlake.operators import dedupe as dd
from marketlake.operators import joins as jn
from marketlake.operators import setops as so


def rows(df, *cols):
    return sorted(tuple(r) for r in df.select(*cols).collect())


def test_latest_per_key_nulls_first_and_ties(spark):
    df = spark.createDataFrame([(1, None, "a"), (1, dt.date(2024, 1, 2), "b"), (2, dt.date(2024, 1, 1), "c"),
                                (2, dt.date(2024, 1, 1), "a"), (3, dt.date(2024, 1, 5), "z")], "k int, d date, v string")
    # PostgreSQL "d DESC" puts NULLs first; default ties run in the order's direction (largest v)
    assert rows(dd.latest_per_key(df, ["k"], ["d desc"]), "k", "v") == [(1, "a"), (2, "c"), (3, "z")]
    assert rows(dd.latest_per_key(df, ["k"], ["d desc nulls last"]), "k", "v") == [(1, "b"), (2, "c"), (3, "z")]
    # explicit ascending ties (mixed directions: window path) give the smallest v
    assert rows(dd.latest_per_key(df, ["k"], ["d desc"], ties=["v"]), "k", "v") == [(1, "a"), (2, "a"), (3, "z")]
    # both paths agree on the same spec
    for order in (["d"], ["d desc"], ["d asc nulls first"], ["d desc nulls last"]):
        agg = dd._pick_by_aggregate(df, ["k"], order, None, reverse=False)
        from pyspark.sql import Window
        w = Window.partitionBy("k").orderBy(*dd.total_order(df, ["k"], order))
        win = df.withColumn("rn", F.row_number().over(w)).where("rn = 1").drop("rn")
        assert rows(agg, "k", "d", "v") == rows(win, "k", "d", "v"), order


def test_latest_per_key_plans(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("k"), F.col("id").alias("v"), F.lit("x").alias("s"))
    # mixed directions: row_number() = 1 with a partial WindowGroupLimit before the shuffle
    plan = dd.latest_per_key(df, ["k"], ["v desc"], ties=["s"])._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan
    # one direction, narrow payload: a max_by aggregate with a partial (map-side) step
    plan = dd.latest_values(df, ["k"], ["v desc"], ["s"])._jdf.queryExecution().executedPlan().toString()
    assert "partial_max_by" in plan


def test_dedupe_first_last(spark):
    df = spark.createDataFrame([("kw", "A", 1, 10), ("kw", "A", 2, 20), ("kw", "B", 1, 30)], "k string, m string, d int, v int")
    assert rows(dd.dedupe(df, ["k", "m"], ["d"], keep="first"), "m", "v") == [("A", 10), ("B", 30)]
    assert rows(dd.dedupe(df, ["k", "m"], ["d"], keep="last"), "m", "v") == [("A", 20), ("B", 30)]


def test_duplicate_rows_null_keys_equal(spark):
    df = spark.createDataFrame([(None, 1), (None, 2), ("a", 3), ("b", 4), ("b", 5)], "k string, v int")
    assert rows(dd.duplicate_rows(df, ["k"]), "v", "dup_count") == [(1, 2), (2, 2), (4, 2), (5, 2)]


def test_last_non_null_per_column(spark):
    df = spark.createDataFrame([(1, 1, "x", None), (1, 2, None, 5.0), (1, 3, None, None), (2, 1, None, None)],
                               "k int, pos int, a string, b double")
    assert rows(dd.last_non_null(df, ["k"], ["pos"]), "k", "a", "b") == [(1, "x", 5.0), (2, None, None)]


def test_assert_unique(spark):
    import pytest
    df = spark.createDataFrame([(1,), (1,)], "k int")
    with pytest.raises(ValueError):
        dd.assert_unique(df, ["k"])
    dd.assert_unique(df.distinct(), ["k"])


def test_latest_snapshot(spark):
    df = spark.createDataFrame([("US", 1), ("US", 2), ("CA", 1), ("CA", 1)], "m string, d int")
    assert rows(dd.latest_snapshot(df, "d"), "m", "d") == [("US", 2)]
    assert rows(dd.latest_snapshot(df, "d", by=["m"]), "m", "d") == [("CA", 1), ("CA", 1), ("US", 2)]


def test_not_in_null_semantics(spark):
    p = spark.createDataFrame([(1,), (2,), (None,)], "k int")
    o = spark.createDataFrame([(1,)], "k int")
    assert rows(jn.not_in(p, "k", o, "k"), "k") == [(2,)]
    o2 = spark.createDataFrame([(1,), (None,)], "k int")
    assert jn.not_in(p, "k", o2, "k").count() == 0


def test_missing_children_orphans(spark):
    parent = spark.createDataFrame([(1,), (2,)], "id int")
    child = spark.createDataFrame([(1, 1), (9, 2), (None, 3)], "pid int, c int")
    assert rows(jn.missing_children(parent, child, ["id"], ["pid"]), "id") == [(2,)]
    assert rows(jn.orphans(child, parent, ["pid"], ["id"]), "c") == [(2,)]
    plan = jn.missing_children(parent, child, ["id"], ["pid"])._jdf.queryExecution().executedPlan().toString()
    assert "LeftAnti" in plan


def test_map_lookup_never_fans_out(spark):
    df = spark.createDataFrame([("p1",), ("p2",)], "name string")
    m = spark.createDataFrame([("p1", 10), ("p1", 11), ("p2", None)], "name string, id int")
    assert rows(jn.map_lookup(df, "name", m, "name", "id"), "name", "id") == [("p1", 10), ("p2", None)]


def test_outer_merge_null_equal(spark):
    a = spark.createDataFrame([(None, 1)], "k string, x int")
    b = spark.createDataFrame([(None, 2)], "k2 string, y int")
    assert jn.outer_merge(a, b, ["k"], ["k2"]).count() == 1
    assert jn.outer_merge(a, b, ["k"], ["k2"], null_equal=False).count() == 2


def _many(spark, seed, names):
    import random
    rng = random.Random(seed)
    data = [(rng.choice([None, "hot", "hot", *"abcdef"]), rng.choice([None, 1, 2]), i) for i in range(60)]
    return data, spark.createDataFrame(data, f"{names[0]} string, {names[1]} int, {names[2]} int")


def test_full_joins_equal_pandas(spark):
    import pandas as pd
    a, left = _many(spark, 1, ["k", "n", "x"])
    b, right = _many(spark, 2, ["k", "n", "y"])
    pa_, pb = (pd.DataFrame(v, columns=c).astype(object) for v, c in ((a, ["k", "n", "x"]), (b, ["k", "n", "y"])))

    def clean(frame):
        return sorted((tuple(None if pd.isna(v) else v for v in r) for r in frame.itertuples(index=False)), key=str)

    for keys in (["k"], ["k", "n"]):
        l2, r2 = left.drop("n") if keys == ["k"] else left, right.drop("n") if keys == ["k"] else right
        p1, p2 = (pa_.drop(columns="n"), pb.drop(columns="n")) if keys == ["k"] else (pa_, pb)
        named = r2.toDF(*[f"{c}2" if c in keys else c for c in r2.columns])
        want = p1.merge(p2.rename(columns={c: f"{c}2" for c in keys}), how="outer", left_on=keys, right_on=[f"{c}2" for c in keys])
        got = jn.outer_merge(l2, named, keys, [f"{c}2" for c in keys])
        assert sorted((tuple(r) for r in got.collect()), key=str) == clean(want[got.columns])
        # SQL: NULL keys match nothing
        plain = jn.full_join_coalesced(l2, r2, keys)
        assert plain.columns == [*keys, "x", "y"]
        expect = l2.join(r2, keys, "full").select(*plain.columns)
        assert sorted((tuple(r) for r in plain.collect()), key=str) == sorted((tuple(r) for r in expect.collect()), key=str)
        off = jn.outer_merge(l2, named, keys, named.columns[:len(keys)], null_equal=False)
        assert sorted(str((r.x, r.y)) for r in off.collect()) == sorted(str((r.x, r.y)) for r in expect.collect())


def test_full_join_of_a_frame_with_itself(spark):
    df = spark.createDataFrame([(1, 10), (2, 20), (None, 30)], "k int, x int")
    got = jn.full_join_coalesced(df.where("x <> 20"), df.where("x <> 10").withColumnRenamed("x", "y"), ["k"])
    assert sorted((tuple(r) for r in got.collect()), key=str) == [(1, 10, None), (2, None, 20), (None, 30, None), (None, None, 30)]


def test_full_join_reuses_exchanges_and_spreads_a_hot_key(spark, tmp_path):
    """Each side's rows are shuffled once, and no join of the plan is a full one."""
    left = spark.range(30_000).select(F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id")).alias("k"), F.col("id").alias("x"))
    right = spark.range(0, 30_000, 2).select(F.col("id").alias("k"), F.col("id").alias("y"))
    left.write.parquet(str(tmp_path / "l")), right.write.parquet(str(tmp_path / "r"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes", "16k")
    spark.conf.set("spark.sql.adaptive.skewJoin.skewedPartitionFactor", "1.5")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "16k")
    try:
        out = jn.full_join_coalesced(spark.read.parquet(str(tmp_path / "l")), spark.read.parquet(str(tmp_path / "r")), ["k"])
        assert out.count() == 30_000 + 15_000 - out.where("x is not null and y is not null").select("y").distinct().count()
        out.collect()
        plan = out._jdf.queryExecution().executedPlan().toString()
        plan = plan[:plan.index("== Initial Plan ==")]
        assert "FullOuter" not in plan and plan.count("ReusedExchange") >= 2 and "skew=true" in plan
    finally:
        for k in ("autoBroadcastJoinThreshold", "adaptive.skewJoin.skewedPartitionThresholdInBytes",
                  "adaptive.skewJoin.skewedPartitionFactor", "adaptive.advisoryPartitionSizeInBytes"):
            spark.conf.unset(f"spark.sql.{k}")


def test_union_ops(spark):
    a = spark.createDataFrame([(1, "x"), (1, "x")], "a int, b string")
    b = spark.createDataFrame([(1, "x"), (2, "y")], "a int, b string")
    assert rows(so.union_distinct(a, b), "a", "b") == [(1, "x"), (2, "y")]
    c = spark.createDataFrame([(3,)], "a int")
    u = so.union_by_name(a, c)
    assert rows(u, "a", "b") == [(1, "x"), (1, "x"), (3, None)]
    cal = spark.createDataFrame([(dt.date(2024, 1, d),) for d in (1, 2, 3)], "d date")
    have = spark.createDataFrame([(dt.datetime(2024, 1, 2, 5),)], "t timestamp_ntz")
    assert rows(so.missing_dates(cal, have, "d", "t"), "d") == [(dt.date(2024, 1, 1),), (dt.date(2024, 1, 3),)]


def test_broadcast_guard_uses_estimate(spark):
    small = spark.read.parquet("/root/testdata/sf0.001/supplier.parquet")
    big = spark.read.parquet("/root/testdata/sf0.1/lineitem.parquet")
    assert 0 < jn.estimated_bytes(small) < 10 ** 6 < jn.estimated_bytes(big)
    assert "ResolvedHint" in jn.broadcast_if_small(small, 10 ** 6)._jdf.queryExecution().analyzed().toString()
    assert "ResolvedHint" not in jn.broadcast_if_small(big, 10 ** 6)._jdf.queryExecution().analyzed().toString()


def test_ties_on_nested_columns_are_deterministic(spark):
    df = spark.createDataFrame([(1, {"b": 2}, [2]), (1, {"a": 1}, [1])], "k int, m map<string,int>, a array<int>")
    assert dd.latest_per_key(df, ["k"], None).first()["a"] == [1]
    assert dd.dedupe(df, ["k"], None, keep="last").first()["a"] == [2]


def test_percent_text_and_bool(spark):
    from marketlake.operators.shape import percent_text_columns, text_to_bool
    df = spark.createDataFrame([("12.5%", "10", "false"), ("50", "20", None), (None, "x", "yes")],
                               "a string, b string, c string")
    out = percent_text_columns(df, ["a", "b"]).select("a", "b", text_to_bool("c").alias("c")).collect()
    assert [tuple(r) for r in out] == [(0.125, 10.0, False), (0.5, 20.0, None), (None, None, True)]
