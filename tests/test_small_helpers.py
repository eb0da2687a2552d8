"""Helpers that no mart needs: schema look-ups, samples, work lists, small filters."""
import datetime as dt

import pytest
from pyspark.sql import types as T

from marketlake.operators.aggregates import any_rows
from marketlake.operators.dedupe import top_n_per_key
from marketlake.operators.shape import schema_diff
from marketlake.plans import ingest, marts
from marketlake.sinks.tables import empty_like
from marketlake.sources import catalog, dimensions

D, TS = dt.date, dt.datetime


def test_schema_introspection(spark, tmp_path):
    df = spark.createDataFrame([(1, "a")], "k int, v string")
    diff = schema_diff(T.StructType.fromDDL("k BIGINT, w STRING"), df)
    assert (diff["missing"], diff["extra"], list(diff["type_mismatch"])) == (["w"], ["v"], ["k"])
    spark.sql(f"create database introspect location '{tmp_path}/db'")
    df.write.option("path", f"{tmp_path}/facts").saveAsTable("introspect.facts")
    df.write.option("path", f"{tmp_path}/console").saveAsTable("introspect.facts_console")
    df.createOrReplaceTempView("some_view")
    try:
        assert dimensions.table_columns(spark, "introspect.facts") == ["k", "v"]
        got = {(r["table_name"], r["column_name"]) for r in dimensions.schema_columns(spark, "introspect").collect()}
        assert got == {("facts", "k"), ("facts", "v")}
    finally:
        spark.catalog.dropTempView("some_view")
        spark.sql("drop database introspect cascade")


def test_samples_and_top_n(spark):
    df = spark.createDataFrame([(i % 2, i) for i in range(10)], "k int, v int")
    assert any_rows(df, 3).count() == 3 and empty_like(df).count() == 0
    assert sorted(tuple(r) for r in top_n_per_key(df, ["k"], ["v desc"], 2).collect()) == [(0, 6), (0, 8), (1, 7), (1, 9)]


def test_register_report_declares_its_types():
    with pytest.raises(KeyError):
        catalog.report_schema("date, brandNewMetric")
    catalog.register_report("X", "xReport", "['x']", "x", {"brandNewMetric": T.LongType()})
    assert catalog.lookup("X", "xReport", "['x']") == "x"
    assert catalog.report_schema("date, brandNewMetric").names == ["date", "brandNewMetric"]
    catalog.REPORTS.pop(), catalog._DECLARED.clear()


def test_worklist_listings_and_prices(spark):
    orders = spark.createDataFrame([("o1", TS(2024, 1, 1)), ("o2", TS(2024, 1, 2)), ("o3", TS(2024, 1, 3))],
                                   "amazon_order_id string, purchase_date timestamp")
    items = spark.createDataFrame([("o3",)], "amazon_order_id string")
    assert [r[0] for r in ingest.backfill_worklist(orders, items, 1).collect()] == ["o2"]
    t = {"listings_items.summaries": spark.createDataFrame([("A", ["DISCOVERABLE", "BUYABLE"]), ("B", ["BUYABLE"])],
                                                           "asin string, status array<string>"),
         "product_pricing.competitive_pricing": spark.createDataFrame([("A", "[]"), ("B", "[1]"), ("C", None)],
                                                                      "asin string, prices_json string")}
    assert [r["asin"] for r in marts.active_listings(t).collect()] == ["A"]
    assert [r["asin"] for r in marts.non_empty_prices(t).collect()] == ["B"]
    rec = spark.createDataFrame([("P", 3, "f")], "parentAsin string, sessionsB2B int, source_file string")
    r = ingest.business_report_batch(rec, 1, "US", D(2024, 1, 1)).first()
    assert (r["parent_asin"], r["sessions_b2b"], r["date"]) == ("P", 3, D(2024, 1, 1))
