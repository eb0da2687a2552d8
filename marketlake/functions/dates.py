"""Calendar functions as Column expressions.

All work on DATE or TIMESTAMP_NTZ values and do not depend on the session time
zone: zone shifts use ``convert_timezone`` on wall-clock values.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from marketlake.functions._util import as_col

DAYS = ["Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday"]


def ntz(c) -> Column:
    """D02 ``::TIMESTAMP`` cast (wall clock, no zone)."""
    return as_col(c).cast("timestamp_ntz")


def local_date(ts, offset: str = "-07:00") -> Column:
    """Calendar date of a UTC wall-clock timestamp in a *fixed* offset zone
    (``PDT`` in PostgreSQL is −07:00 all year)."""
    return F.to_date(F.convert_timezone(F.lit("UTC"), F.lit(offset), ntz(ts)))


def to_utc(ts, zone: str = "Asia/Manila") -> Column:
    """Wall-clock time in ``zone`` → UTC wall-clock time."""
    return F.convert_timezone(F.lit(zone), F.lit("UTC"), ntz(ts))


def week_start(end_date) -> Column:
    """Start of a 7-day reporting week that ends on ``end_date``."""
    return F.date_sub(F.to_date(as_col(end_date)), 6)


def iso_week(d) -> Column:
    """ISO week number."""
    return F.weekofyear(F.to_date(as_col(d)))


def iso_saturday(d) -> Column:
    """Saturday of the ISO (Monday-first) week of ``d``."""
    return F.date_add(F.to_date(F.date_trunc("week", F.to_date(as_col(d)).cast("timestamp_ntz"))), 5)


def closest_weekday(d, day: str) -> Column:
    """``d`` itself when it is ``day``, else the next ``day``."""
    if day not in DAYS:
        raise ValueError(f"{day!r} is not one of {DAYS}")
    return F.next_day(F.date_sub(F.to_date(as_col(d)), 1), day[:3])


def parse_two_formats(c) -> Column:
    """``yyyy-MM-dd`` when the first ``-`` token has 4 characters, else ``MM-dd-yyyy``."""
    c = as_col(c).cast("string")
    first = F.split_part(c, F.lit("-"), F.lit(1))
    return F.when(F.length(first) == 4, F.try_to_date(c, "yyyy-MM-dd")).otherwise(F.try_to_date(c, "MM-dd-yyyy"))


def long_date(c) -> Column:
    """``January 5, 2024`` style dates."""
    return F.try_to_date(as_col(c), "MMMM d, yyyy")


def day_bounds(d):
    """Half-open day range ``[start, next start)`` as two NTZ columns."""
    start = F.to_date(as_col(d)).cast("timestamp_ntz")
    return start, start + F.expr("INTERVAL 1 DAY")


def date_series(start, end, step_days: int = 1) -> Column:
    """Array of dates from ``start`` to ``end`` inclusive, ``step_days`` apart."""
    return F.sequence(F.to_date(as_col(start)), F.to_date(as_col(end)),
                      F.expr(f"INTERVAL {int(step_days)} DAYS"))


def within_age(later, earlier, days: int) -> Column:
    """``later − earlier < days`` (date − timestamp day-time interval), NULL ages drop."""
    diff = ntz(later) - ntz(earlier)
    return as_col(earlier).isNotNull() & (diff < F.expr(f"INTERVAL {int(days)} DAYS"))
