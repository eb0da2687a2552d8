from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_col(c) -> Column:
    """Column stays; a string names a column; any other value is a literal."""
    if isinstance(c, Column):
        return c
    if isinstance(c, str):
        return F.col(c)
    return F.lit(c)


def ts_lit(value, ntz: bool = False) -> Column:
    """A timestamp literal (an explicit ``as_of`` instead of "now"), read as
    wall-clock text in the session time zone.

    ``F.lit(naive_datetime)`` converts through the *Python process's* local zone;
    going through text keeps a stamp identical whatever the machine's zone is."""
    import datetime as _dt
    if isinstance(value, Column):
        return value.cast("timestamp_ntz" if ntz else "timestamp")
    if isinstance(value, _dt.datetime):
        value = value.isoformat(sep=" ")
    elif isinstance(value, _dt.date):
        value = value.isoformat()
    return F.lit(value).cast("timestamp_ntz" if ntz else "timestamp")
