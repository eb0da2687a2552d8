import datetime as dt

from marketlake.operators.planning import clamp_retention, date_windows, lookback_plan, lookback_plan_v2, weekly_windows


def reference_windows(s, e, max_days=31):
    """The loop the report planner runs (start < end, strict)."""
    out, cs = [], s
    ce = min(e, cs + dt.timedelta(days=max_days))
    while cs < e:
        out.append((cs, ce))
        cs = ce + dt.timedelta(days=1)
        ce = min(e, ce + dt.timedelta(days=max_days))
    return out


def test_date_windows_equal_loop(spark):
    spans = [(dt.date(2024, 1, 1), dt.date(2024, 1, 1)), (dt.date(2024, 1, 1), dt.date(2024, 1, 2)),
             (dt.date(2024, 1, 1), dt.date(2024, 2, 1)), (dt.date(2024, 1, 1), dt.date(2024, 2, 2)),
             (dt.date(2024, 1, 1), dt.date(2024, 4, 30)), (dt.date(2023, 12, 1), dt.date(2024, 3, 3))]
    df = spark.createDataFrame([(i, s, e) for i, (s, e) in enumerate(spans)], "i int, s date, e date")
    got = {}
    for r in date_windows(df, "s", "e").collect():
        got.setdefault(r["i"], []).append((r["window_start"], r["window_end"]))
    for i, (s, e) in enumerate(spans):
        assert sorted(got.get(i, [])) == reference_windows(s, e), (s, e)


def test_retention_and_lookback(spark):
    df = spark.createDataFrame([("SPONSORED_BRANDS", dt.date(2023, 1, 1))], "p string, s date")
    r = df.select(clamp_retention("s", "p", dt.date(2024, 3, 1))).first()[0]
    assert r == dt.date(2024, 3, 1) - dt.timedelta(days=60)
    assert lookback_plan(spark, dt.datetime(2024, 3, 1, 1)).count() == 3
    assert lookback_plan(spark, dt.datetime(2024, 3, 15, 1)).count() == 1
    assert lookback_plan(spark, dt.datetime(2024, 3, 9, 5)).first()["products"] == "SPONSORED_PRODUCTS"


def test_weekly_windows(spark):
    df = spark.createDataFrame([(dt.date(2024, 1, 1), dt.date(2024, 1, 31))], "s date, e date")
    w = [(r["week_start"], r["week_end"]) for r in weekly_windows(df, "s", "e").orderBy("week_end").collect()]
    assert w[0] == (dt.date(2023, 12, 31), dt.date(2024, 1, 6)) and w[-1][1] == dt.date(2024, 1, 27)


def test_finance_windows(spark):
    from marketlake.operators.planning import finance_windows
    t = spark.createDataFrame([(1, "US"), (1, "CA")], "tenant_id int, marketplace string")
    sunday = finance_windows(t, dt.datetime(2024, 3, 10, 5)).first()
    assert sunday["lookback"] == "weekly" and (sunday["posted_before"] - sunday["posted_after"]).days == 730
    other = finance_windows(t, dt.datetime(2024, 3, 11, 3)).first()
    assert other["lookback"] == "daily" and (other["posted_before"] - other["posted_after"]).days == 180


def test_lookback_plan_of_version_2(spark):
    def plan(*at):
        rows = lookback_plan_v2(spark, dt.datetime(2024, 3, *at)).collect()
        return [(r.scope, r.products, (dt.date(2024, 3, at[0]) - r.start_date).days,
                 (dt.date(2024, 3, at[0]) - r.end_date).days) for r in rows]

    both = "SPONSORED_BRANDS,SPONSORED_DISPLAY"
    assert plan(1, 1) == [("all_tables", both, 60, 30), ("all_tables", both, 30, 0)]
    assert plan(15, 1) == [("all_tables", both, 30, 0)] and plan(9, 1) == [("all_tables", both, 7, 0)]
    assert plan(9, 5) == [("campaigns", "SPONSORED_BRANDS", 1, 0), ("campaigns", "SPONSORED_DISPLAY", 1, 0)]
    assert plan(1, 5) == plan(15, 0) == []
