"""Number cleaning and ratios as Column expressions.

Raw report text goes through ``try_cast``/``try_divide`` so that one bad value
gives NULL instead of failing a 100 TB job under ANSI mode.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from marketlake.functions._util import as_col


def clean_money(c, signed: bool = False, default=0.0, strict: bool = True) -> Column:
    """Money text → double.  NULL → ``default`` and nothing else: text that is
    no amount raises, or with ``strict=False`` becomes NULL (never 0).  ``$``, commas
    and parentheses are stripped; ``signed=False`` drops the sign of ``(3.00)`` like
    the source does, ``signed=True`` reads it as -3.00."""
    c = as_col(c).cast("string")
    body = F.trim(F.regexp_replace(c, r"[$(),]", ""))
    num = body.cast("double") if strict else body.try_cast("double")
    if signed:
        num = F.when(F.trim(c).startswith("(") & F.trim(c).endswith(")"), -num).otherwise(num)
    return F.when(c.isNull(), F.lit(default)).otherwise(num) if default is not None else num


def clean_number(c, percent: bool = False) -> Column:
    """Strip ``$ % , ( )`` and read as double; ``percent=True`` divides by 100."""
    num = F.regexp_replace(as_col(c).cast("string"), r"[$%,()]", "").try_cast("double")
    return num / F.lit(100.0) if percent else num


def percent_ratio(c) -> Column:
    """``'12.5%'`` → 0.125 (text without ``%`` is also divided)."""
    return F.replace(as_col(c).cast("string"), F.lit("%"), F.lit("")).try_cast("double") / F.lit(100.0)


def bounded_int(c) -> Column:
    """Rank text such as ``>306`` / ``<5`` → 306 / 5; ``-`` and junk → NULL."""
    return F.regexp_replace(as_col(c).cast("string"), r"[<>]", "").try_cast("bigint")


def ratio(num, den, default=None) -> Column:
    """``num / den`` with zero or NULL denominators → ``default`` (NULL)."""
    r = F.try_divide(as_col(num).cast("double"), as_col(den).cast("double"))
    return F.coalesce(r, F.lit(default)) if default is not None else r


def int_ratio(num, den) -> Column:
    """M03 legacy: integer division as PostgreSQL does for two integers (truncates)."""
    return F.try_divide(as_col(num).cast("bigint"), as_col(den).cast("bigint")).cast("bigint")


def allocate(part, total, amount) -> Column:
    """``round_half_even(part / total * amount)``."""
    return F.bround(F.try_divide(as_col(part).cast("double"), as_col(total).cast("double"))
                    * as_col(amount).cast("double"), 0)


def price_fallback(price, unit_price, qty, use_fallback) -> Column:
    """When ``price`` is NULL and ``use_fallback`` holds, ``unit_price * qty``."""
    return F.when(as_col(price).isNull() & use_fallback,
                  as_col(unit_price) * as_col(qty)).otherwise(as_col(price))


def money(c, scale: int = 2) -> Column:
    """Exact money for sums: decimal(18, scale)."""
    return as_col(c).cast(f"decimal(18,{scale})")
