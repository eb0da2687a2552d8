import datetime as dt

import pytest
from pyspark.sql import functions as F

from marketlake import functions as mf


def one(spark, expr, value, ddl="v string"):
    return spark.createDataFrame([(value,)], ddl).select(expr.alias("r")).first()["r"]


def col(spark, expr, values, ddl="v string"):
    return [r["r"] for r in spark.createDataFrame([(v,) for v in values], ddl).select(expr.alias("r")).collect()]


def test_product_code(spark):
    got = col(spark, mf.product_code(F.col("v"), all_code="ALL"), ["ABC-Red-Large", "NoDash", "ALL", None, "-x"])
    assert got == ["ABC", None, "ALL", None, ""]


def test_campaign_key(spark):
    got = col(spark, mf.campaign_key(F.col("v")), [
        "SP | Brand | Exact | extra [old] {ARCHIVE}",
        "SP | AU | Exact | extra",
        "  Short name [x]  ",
        None])
    assert got == ["SP | Brand | Exact |", "SP | AU | Exact | extra", "Short name", None]


def test_canonical_targeting_and_match_type(spark):
    got = col(spark, mf.canonical_targeting(F.col("v")), ["[Close Match]", "B0abc12", "keyword text", None])
    assert got == ["close-match", 'asin="B0ABC12"', "keyword text", None]
    df = spark.createDataFrame([("asin=\"B0X\"", "exact"), ("loose-match", "broad"), ("kw", "phrase")], "t string, m string")
    r = [x[0] for x in df.select(mf.match_type("t", "m")).collect()]
    assert r == ["TARGETING_EXPRESSION", "TARGETING_EXPRESSION_PREDEFINED", "PHRASE"]


def test_placement_and_tokens(spark):
    got = col(spark, mf.placement_label(F.col("v")), ["Top of Search", "Product Pages", "Rest of Search", "Other"])
    assert got == ["Top of Search on-Amazon", "Detail Page on-Amazon", "Other on-Amazon", "Other"]
    got = col(spark, mf.null_if_token(F.col("v")), ["--", "", "-", "nan", "NaN", "None", "x"])
    assert got == [None] * 6 + ["x"]


def test_money_numbers(spark):
    got = col(spark, mf.clean_money(F.col("v"), strict=False), ["$1,234.50", "(3.00)", None, "junk", "$1.5k"])
    assert got == [1234.5, 3.0, 0.0, None, None]    # only NULL is 0
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        col(spark, mf.clean_money(F.col("v")), ["n/a"])
    assert col(spark, mf.clean_money(F.col("v"), signed=True), ["($3.00)"]) == [-3.0]
    assert col(spark, mf.clean_number(F.col("v"), percent=True), ["12.5%", "(50)"]) == [0.125, 0.5]
    assert col(spark, mf.percent_ratio(F.col("v")), ["12.5%"]) == [0.125]
    assert col(spark, mf.bounded_int(F.col("v")), [">306", "<5", "-", "17", None]) == [306, 5, None, 17, None]
    assert col(spark, mf.digits_only(F.col("v")), ["+1 (555) 010-9999", "n/a"]) == ["15550109999", None]


def test_ratios(spark):
    df = spark.createDataFrame([(1, 0), (1, 4), (None, 2)], "a long, b long")
    assert [r[0] for r in df.select(mf.ratio("a", "b")).collect()] == [None, 0.25, None]
    assert [r[0] for r in df.select(mf.ratio("a", "b", 0.0)).collect()] == [0.0, 0.25, 0.0]
    assert [r[0] for r in df.select(mf.int_ratio("a", "b")).collect()] == [None, 0, None]
    # banker's rounding: 2.5 -> 2, 3.5 -> 4
    df = spark.createDataFrame([(25.0, 100.0, 10.0), (35.0, 100.0, 10.0)], "c double, t double, i double")
    assert [r[0] for r in df.select(mf.allocate("c", "t", "i")).collect()] == [2.0, 4.0]


def test_dates(spark):
    ts = dt.datetime(2024, 1, 2, 5, 0, 0)
    df = spark.createDataFrame([(ts,)], "v timestamp_ntz")
    r = df.select(mf.local_date("v").alias("pdt"), mf.to_utc("v").alias("utc")).first()
    assert r["pdt"] == dt.date(2024, 1, 1)  # 05:00 UTC is the previous day at -07:00
    assert r["utc"] == dt.datetime(2024, 1, 1, 21, 0, 0)
    days = [dt.date(2024, 12, 28), dt.date(2024, 12, 29), dt.date(2024, 12, 30), dt.date(2021, 1, 3)]
    df = spark.createDataFrame([(d,) for d in days], "v date")
    got = df.select(mf.iso_saturday("v"), mf.closest_weekday("v", "Saturday"), mf.iso_week("v")).collect()
    assert [tuple(r) for r in got] == [
        (dt.date(2024, 12, 28), dt.date(2024, 12, 28), 52),
        (dt.date(2024, 12, 28), dt.date(2025, 1, 4), 52),  # a Sunday maps to the day before
        (dt.date(2025, 1, 4), dt.date(2025, 1, 4), 1),
        (dt.date(2021, 1, 2), dt.date(2021, 1, 9), 53),
    ]
    got = col(spark, mf.parse_two_formats(F.col("v")), ["2024-03-05", "03-05-2024", "bad"])
    assert got == [dt.date(2024, 3, 5), dt.date(2024, 3, 5), None]
    assert col(spark, mf.long_date(F.col("v")), ["January 5, 2024"]) == [dt.date(2024, 1, 5)]


def test_nested(spark):
    df = spark.createDataFrame([(["DISCOVERABLE", "BUYABLE", "X"],), (["BUYABLE"],), (None,)], "s array<string>")
    assert [r[0] for r in df.select(mf.contains_all("s", ["DISCOVERABLE", "BUYABLE"])).collect()] == [True, False, None]
    df = spark.createDataFrame([([(1, "a"), (None, "b"), (3, None)],), ([],)], "l array<struct<k:int,v:string>>")
    assert [r[0] for r in df.select(mf.last_with("l", "k")).collect()] == [3, None]
    assert [r[0] for r in df.select(mf.last_with("l", "v")).collect()] == ["b", None]
    df = spark.createDataFrame([('[{"Price": {"ListingPrice": {"CurrencyCode": "USD"}}}]',)], "j string")
    assert df.select(mf.json_path("j", "$[0].Price.ListingPrice.CurrencyCode")).first()[0] == "USD"
    df = spark.createDataFrame([([(1,), (None,), (5,)],)], "a array<struct<quantity:int>>")
    assert df.select(mf.sum_ints("a", "quantity")).first()[0] == 6


def test_last_matches_is_one_pass(spark):
    """Every name's last match, a match with a NULL value included; the list is folded once."""
    ddl = "id int, l array<struct<t: string, v: int>>"
    df = spark.createDataFrame([(1, [("a", 1), ("b", 2), ("a", None)]), (2, []), (3, None), (4, [None, ("b", 5)])], ddl)
    picks = {n: (lambda x, n=n: x["t"] == n, lambda x: x["v"]) for n in ("a", "b", "c")}
    picks["any"] = (lambda x: x["v"].isNotNull(), lambda x: x["v"])
    out = df.withColumn("s", mf.last_matches("l", picks)).select("id", *[F.col(f"s.{n}").alias(n) for n in picks])
    assert sorted((tuple(r) for r in out.collect())) == [(1, None, 2, None, 2), (2, None, None, None, None),
                                                         (3, None, None, None, None), (4, None, 5, None, 5)]
    from marketlake.operators.shape import last_of_list
    plan = last_of_list(df)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("aggregate(") == 1
