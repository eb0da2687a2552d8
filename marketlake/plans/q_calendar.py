"""Calendar and load-planning queries on the driver tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from marketlake.functions import dates as fd
from marketlake.operators.planning import date_windows as _date_windows
from marketlake.operators.setops import missing_dates as _missing_dates
from marketlake.plans.registry import register
from marketlake.plans.tables import Tables


@register("week_columns", """
select o_orderkey, cast(date_trunc('week', cast(o_orderdate as date)) as date) + 5 as reporting_date,
       cast(date_trunc('week', cast(o_orderdate as date)) as date) + 5 - 6 as start_date,
       cast(weekofyear(cast(date_trunc('week', cast(o_orderdate as date)) as date) + 5) as integer) as week
from orders
""")
def week_columns(spark, d):
    """D04 + D05: Saturday of the ISO week as reporting date, start = end − 6, ISO week no."""
    o = Tables(spark, d).orders.select("o_orderkey", fd.iso_saturday("o_orderdate").alias("reporting_date"))
    return o.select("o_orderkey", "reporting_date", fd.week_start("reporting_date").alias("start_date"),
                    fd.iso_week("reporting_date").alias("week"))


@register("closest_weekday", """
select o_orderkey, cast(o_orderdate as date) + cast((6 - isodow(o_orderdate) + 7) % 7 as integer) as next_saturday,
       cast(o_orderdate as date) + cast((1 - isodow(o_orderdate) + 7) % 7 as integer) as next_monday
from orders
""")
def closest_weekday(spark, d):
    """The same day when it is the wanted weekday, else the next one."""
    o = Tables(spark, d).orders
    return o.select("o_orderkey", fd.closest_weekday("o_orderdate", "Saturday").alias("next_saturday"),
                    fd.closest_weekday("o_orderdate", "Monday").alias("next_monday"))


@register("parse_two_formats", """
select o_orderkey, cast(o_orderdate as date) as order_date from orders
""")
def parse_two_formats(spark, d):
    """Dates written as ``yyyy-MM-dd`` or ``MM-dd-yyyy`` parsed back."""
    o = Tables(spark, d).orders
    text = F.when(F.col("o_orderstatus") == "F", F.date_format("o_orderdate", "yyyy-MM-dd")) \
            .otherwise(F.date_format("o_orderdate", "MM-dd-yyyy"))
    return o.select("o_orderkey", fd.parse_two_formats(text).alias("order_date"))


@register("to_utc", """
select o_orderkey, o_orderdate - interval 8 hour as order_ts_utc,
       cast(o_orderdate - interval 7 hour as date) as order_date_pdt
from orders
""")
def to_utc(spark, d):
    """D03 + D01: Manila wall-clock → UTC; UTC → date at fixed −07:00."""
    o = Tables(spark, d).orders
    return o.select("o_orderkey", fd.to_utc("o_orderdate", "Asia/Manila").alias("order_ts_utc"),
                    fd.local_date("o_orderdate", "-07:00").alias("order_date_pdt"))


@register("date_series", """
with b as (select o_orderpriority, cast(min(o_orderdate) as date) as s, cast(max(o_orderdate) as date) as e
           from orders group by o_orderpriority)
select o_orderpriority, cast(g.d as date) as week_date, cast(date_trunc('month', cast(g.d as date)) as date) as month_first,
       cast(last_day(cast(g.d as date)) as date) as month_last
from b cross join lateral (select unnest(generate_series(b.s, b.e, interval 7 day)) as d) g
""")
def date_series(spark, d):
    """7-day date series between each group's first and last date, with month bounds."""
    from marketlake.operators.planning import month_bounds
    o = Tables(spark, d).orders
    b = o.groupBy("o_orderpriority").agg(F.to_date(F.min("o_orderdate")).alias("s"),
                                         F.to_date(F.max("o_orderdate")).alias("e"))
    x = b.select("o_orderpriority", F.explode(fd.date_series("s", "e", 7)).alias("week_date"))
    first, last = month_bounds("week_date")
    return x.select("o_orderpriority", "week_date", first.alias("month_first"), last.alias("month_last"))


@register("date_windows", """
with b as (select o_custkey, cast(min(o_orderdate) as date) as s, cast(max(o_orderdate) as date) as e
           from orders group by o_custkey),
w as (select o_custkey, s, e, g.i as window_no from b
      cross join lateral (select unnest(range(0, cast(floor(date_diff('day', b.s, b.e) / 31) as bigint) + 2)) as i) g),
x as (select o_custkey, cast(window_no as integer) as window_no,
             case when window_no = 0 then s else s + cast(window_no * 31 + 1 as integer) end as window_start,
             least(e, s + cast((window_no + 1) * 31 as integer)) as window_end, e from w)
select o_custkey, window_no, window_start, window_end from x
where window_start < e and window_start <= window_end
""")
def date_windows(spark, d):
    """Each customer's order-date span cut into ≤31-day report windows."""
    o = Tables(spark, d).orders
    b = o.groupBy("o_custkey").agg(F.to_date(F.min("o_orderdate")).alias("s"), F.to_date(F.max("o_orderdate")).alias("e"))
    return _date_windows(b, "s", "e").select("o_custkey", "window_no", "window_start", "window_end")


@register("missing_dates", """
with b as (select cast(min(o_orderdate) as date) as s, cast(max(o_orderdate) as date) as e from orders),
cal as (select cast(unnest(generate_series(b.s, b.e, interval 1 day)) as date) as d from b)
select d as missing_date from cal
where d not in (select distinct cast(l_shipdate as date) from lineitem where l_shipdate is not null)
""")
def missing_dates(spark, d):
    """Requested calendar days (the order-date span) with no shipment loaded."""
    t = Tables(spark, d)
    b = t.orders.agg(F.to_date(F.min("o_orderdate")).alias("s"), F.to_date(F.max("o_orderdate")).alias("e"))
    cal = b.select(F.explode(fd.date_series("s", "e", 1)).alias("missing_date"))
    return _missing_dates(cal, t.lineitem, "missing_date", "l_shipdate")
