"""Arrays, maps and JSON as Column expressions (higher-order functions, no UDFs)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from marketlake.functions._util import as_col


def json_path(c, path: str) -> Column:
    """JSON path on text (``$[0].Price.ListingPrice.CurrencyCode``)."""
    return F.get_json_object(as_col(c), path)


def contains_all(arr, values) -> Column:
    """PostgreSQL ``arr @> ARRAY[values]``; NULL array → NULL (dropped by filters)."""
    arr = as_col(arr)
    return F.forall(F.array(*[F.lit(v) for v in values]), lambda x: F.array_contains(arr, x))


def json_nonempty(c) -> Column:
    """JSON text that is not an empty array."""
    return F.coalesce(F.json_array_length(as_col(c)), F.lit(0)) > 0


def last_with(arr, field: str) -> Column:
    """``field`` of the last element whose ``field`` is not NULL."""
    kept = F.filter(as_col(arr), lambda x: x[field].isNotNull())
    return F.try_element_at(kept, F.lit(-1))[field]


def last_where(arr, pred, value) -> Column:
    """``value(x)`` of the last element with ``pred(x)`` true (NULL when none)."""
    kept = F.filter(as_col(arr), pred)
    return value(F.try_element_at(kept, F.lit(-1)))


def last_matches(arr, picks) -> Column:
    """A struct with ``value(x)`` of the last element with ``pred(x)`` true, for every
    ``name: (pred, value)`` in ``picks`` (NULL when none, and for a NULL array), in one pass over the
    array, however many names there are.  Take its fields in a later projection, so the pass is not
    repeated per field."""
    a = as_col(arr)
    never = F.lit(False)        # gives a NULL its type
    zero = F.struct(*[F.when(never, value(F.try_element_at(a, F.lit(1)))).alias(n) for n, (_, value) in picks.items()])

    def step(acc: Column, x: Column) -> Column:
        return F.struct(*[F.when(pred(x), value(x)).otherwise(acc[n]).alias(n) for n, (pred, value) in picks.items()])

    return F.aggregate(a, zero, step)


def first_of(arr) -> Column:
    """1-based first element, NULL for empty or NULL arrays."""
    return F.try_element_at(as_col(arr), F.lit(1))


def sum_ints(arr, field: str | None = None) -> Column:
    """Sum of an integer array (or of one integer field of an array of structs)."""
    a = as_col(arr)
    if field is not None:
        a = F.transform(a, lambda x: x[field])
    return F.aggregate(a, F.lit(0).cast("bigint"),
                       lambda acc, x: acc + F.coalesce(x.cast("bigint"), F.lit(0).cast("bigint")))


def flatten_lists(c) -> Column:
    """List of lists → one list."""
    return F.flatten(as_col(c))
