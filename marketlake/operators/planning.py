"""Load planning as DataFrames.

Windows are generated per input row with ``sequence`` + ``explode`` (a Generate
node, narrow, no join), so planning thousands of tenants × marketplaces × report
types is one distributed projection.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlake.functions._util import as_col

# --- fixed values that must equal the reference's ---------------------------
MAX_WINDOW_DAYS = 31
RETENTION_DAYS = {"SPONSORED_PRODUCTS": 95, "SPONSORED_BRANDS": 60, "SPONSORED_DISPLAY": 65}
FINANCE_LOOKBACK_DAYS = {"daily": 180, "weekly": 730}
# -----------------------------------------------------------------------------


def clamp_retention(start, product, as_of, retention: Mapping[str, int] = RETENTION_DAYS) -> Column:
    """``greatest(start, as_of − retention[product])`` (unknown product: no clamp)."""
    m = F.create_map(*[F.lit(x) for kv in retention.items() for x in kv])
    limit = F.date_sub(F.to_date(as_col(as_of)), F.coalesce(F.try_element_at(m, as_col(product)), F.lit(None)))
    return F.when(limit.isNull(), F.to_date(as_col(start))).otherwise(F.greatest(F.to_date(as_col(start)), limit))


def date_windows(df: DataFrame, start: str, end: str, max_days: int = MAX_WINDOW_DAYS,
                 include_tail: bool = False) -> DataFrame:
    """Cut each row's ``[start, end]`` into report windows.

    First window ``[s, min(e, s + max_days)]``; each next one starts the day after
    the previous end and ends ``max_days`` later (capped at ``e``); windows are
    emitted while ``start < e``.  So the first window spans ``max_days + 1`` days,
    the others ``max_days``, and a one-day tail (start = e) is skipped as in the
    source unless ``include_tail``.  Output adds ``window_no, window_start, window_end``.
    """
    s, e = F.to_date(F.col(start)), F.to_date(F.col(end))
    n = F.greatest(F.floor(F.datediff(e, s) / F.lit(max_days)).cast("int") + 1, F.lit(0))
    out = df.withColumn("window_no", F.explode(F.sequence(F.lit(0), n)))
    i = F.col("window_no")
    w_end = F.least(e, F.date_add(s, (i + 1) * max_days))
    w_start = F.when(i == 0, s).otherwise(F.date_add(s, i * max_days + 1))
    out = out.withColumns({"window_start": w_start, "window_end": w_end})
    keep = (F.col("window_start") <= e) if include_tail else (F.col("window_start") < e)
    return out.where(keep & (F.col("window_start") <= F.col("window_end")))


def lookback_plan(spark: SparkSession, as_of: dt.datetime) -> DataFrame:
    """Which windows a scheduled run re-loads, as a small DataFrame
    ``(scope, products, start_date, end_date)``.

    1st of the month at 01h: SP 90→60 days back, all 60→30, all 30→0; 15th at 01h:
    all 30 days; other days at 01h: 7 days; other hours: campaign and product
    tables for 1 day.
    """
    today = as_of.date()
    d = dt.timedelta
    all_p = ",".join(RETENTION_DAYS)
    if as_of.day == 1 and as_of.hour == 1:
        rows = [("all_tables", "SPONSORED_PRODUCTS", today - d(90), today - d(60)),
                ("all_tables", all_p, today - d(60), today - d(30)),
                ("all_tables", all_p, today - d(30), today)]
    elif as_of.day == 15 and as_of.hour == 1:
        rows = [("all_tables", all_p, today - d(30), today)]
    elif as_of.hour == 1:
        rows = [("all_tables", all_p, today - d(7), today)]
    else:
        rows = [("spCampaigns,spAdvertisedProduct", "SPONSORED_PRODUCTS", today - d(1), today)]
    return spark.createDataFrame(rows, "scope string, products string, start_date date, end_date date")


V2_PRODUCTS = ("SPONSORED_BRANDS", "SPONSORED_DISPLAY")


def lookback_plan_v2(spark: SparkSession, as_of: dt.datetime) -> DataFrame:
    """G08 for version 2 reports (Brands and Display), as ``lookback_plan``: ``(scope, products, start_date,
    end_date)``.

    1st of the month at 01h: 60→30 days back, then 30→0; 15th at 01h: 30 days; other days at 01h: 7 days;
    other hours of other days: campaigns for 1 day, one window per product.  Other hours of the 1st and the
    15th have no window.
    """
    today = as_of.date()

    def back(days: int) -> dt.date:
        return today - dt.timedelta(days=days)

    both = ",".join(V2_PRODUCTS)
    special = as_of.day in (1, 15)
    if as_of.hour != 1:
        rows = [] if special else [("campaigns", p, back(1), today) for p in V2_PRODUCTS]
    elif as_of.day == 1:
        rows = [("all_tables", both, back(60), back(30)), ("all_tables", both, back(30), today)]
    else:
        rows = [("all_tables", both, back(30 if as_of.day == 15 else 7), today)]
    return spark.createDataFrame(rows, "scope string, products string, start_date date, end_date date")


def weekly_windows(df: DataFrame, start: str, end: str, week_end_day: str = "Saturday") -> DataFrame:
    """Sunday–Saturday weeks covering ``[start, end]``: the first week ends on
    the first ``week_end_day`` on/after ``start``; 7-day steps."""
    first_end = F.next_day(F.date_sub(F.to_date(F.col(start)), 1), week_end_day[:3])
    out = df.withColumn("week_end", F.explode(F.sequence(first_end, F.greatest(first_end, F.to_date(F.col(end))),
                                                         F.expr("INTERVAL 7 DAYS"))))
    return out.withColumn("week_start", F.date_sub("week_end", 6)).where(F.col("week_end") <= F.to_date(F.col(end)))


def month_bounds(d) -> tuple[Column, Column]:
    """First and last day of the month of ``d``."""
    d = F.to_date(as_col(d))
    return F.trunc(d, "month"), F.last_day(d)


def finance_windows(targets: DataFrame, as_of: dt.datetime) -> DataFrame:
    """G08 finances: every (tenant, marketplace) row of ``targets`` gets its
    posted-after / posted-before window: 730 days on Sundays at 05h (weekly
    catch-up), otherwise 180 days, both ending today."""
    weekly = as_of.weekday() == 6 and as_of.hour == 5
    days = FINANCE_LOOKBACK_DAYS["weekly" if weekly else "daily"]
    today = as_of.date()
    return targets.withColumns({"posted_after": F.lit(today - dt.timedelta(days=days)).cast("date"),
                                "posted_before": F.lit(today).cast("date"),
                                "lookback": F.lit("weekly" if weekly else "daily")})
