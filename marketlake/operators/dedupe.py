"""De-duplication and latest-row operators.

Scale notes
-----------
* ``latest_per_key`` filters ``row_number() = 1`` directly, so Catalyst plans a
  *partial* ``WindowGroupLimit`` before the shuffle: every map task keeps at most
  one row per key, so a key holding a third of all rows ships at most one row
  per input partition.  The final window then sees ≤ #partitions rows per key.
* ``last_non_null`` and ``duplicate_rows`` are aggregates (map-side partial
  aggregation), not unbounded windows, so a hot key never lands in one task.
* Every order is made total with explicit tie-breakers, so results do not depend
  on task scheduling and survive task retries after executor loss.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_RN = "__ml_rn"


def parse_order(order) -> list[tuple[str, bool, bool]]:
    """O01 order spec → ``[(column, descending, nulls_first)]``.

    Items are strings ``"c"``, ``"c desc"``, ``"c asc nulls first"`` … with
    PostgreSQL defaults (ASC → NULLS LAST, DESC → NULLS FIRST), or tuples.
    """
    if order is None:
        return []
    if isinstance(order, (str, tuple)):
        order = [order]
    out = []
    for o in order:
        if isinstance(o, tuple):
            out.append((o[0], bool(o[1]), bool(o[2])))
            continue
        parts = o.split()
        low = [p.lower() for p in parts]
        desc = "desc" in low
        if "nulls" in low:
            nulls_first = low[low.index("nulls") + 1] == "first"
        else:
            nulls_first = desc
        n = len(parts)
        for w in ("asc", "desc", "nulls", "first", "last"):
            if w in low:
                n = min(n, low.index(w))
        out.append((" ".join(parts[:n]), desc, nulls_first))
    return out


def sort_exprs(spec: list[tuple[str | Column, bool, bool]]) -> list[Column]:
    out = []
    for name, desc, nf in spec:
        c = F.col(name) if isinstance(name, str) else name
        out.append((c.desc_nulls_first() if nf else c.desc_nulls_last()) if desc
                   else (c.asc_nulls_first() if nf else c.asc_nulls_last()))
    return out


def total_order(df: DataFrame, keys: Sequence[str], order=None, ties: Sequence[str] | None = None,
                reverse: bool = False) -> list[Column]:
    """``order`` extended with tie-breakers so the order is total (see ``total_spec``)."""
    return sort_exprs(total_spec(df, keys, order, ties, reverse))


def total_spec(df: DataFrame, keys: Sequence[str], order=None, ties: Sequence[str] | None = None,
               reverse: bool = False) -> list[tuple[str | Column, bool, bool]]:
    """The total order as ``[(column, descending, nulls_first)]``.

    ``ties`` defaults to every other non-key column (ascending), which makes the
    survivor of exact ties deterministic.  Complex-typed columns are left out of
    the default tie-break.  ``reverse`` flips every direction and NULL placement.
    """
    spec = parse_order(order)
    tie_desc = bool(spec) and spec[-1][1]  # default ties run in the order's own direction
    nested: list[str] = []
    default_ties = ties is None
    if ties is None:
        complex_types = {"array", "map", "struct"}
        used = set(keys) | {s[0] for s in spec}
        rest = [f for f in df.schema.fields if f.name not in used and f.dataType.typeName() != "variant"]
        ties = [f.name for f in rest if f.dataType.typeName() not in complex_types]
        # nested values are compared through their JSON text (maps are not orderable)
        nested = [f.name for f in rest if f.dataType.typeName() in complex_types]
    spec += [(t, tie_desc if default_ties else False, not (tie_desc and default_ties)) for t in ties]
    if reverse:
        spec = [(n, not d, not nf) for n, d, nf in spec]
    nested_desc = (tie_desc and default_ties) != reverse
    return [*spec, *[(F.to_json(F.col(n)), nested_desc, not nested_desc) for n in nested]]


def _pick_by_aggregate(df: DataFrame, keys: Sequence[str], order, ties, reverse: bool,
                       values: Sequence[str] | None = None) -> DataFrame | None:
    """One survivor per key as an aggregate: ``max_by``/``min_by`` of the row (or of
    just ``values``) over an ordering struct.  Possible when every sort key runs in
    one direction; returns None otherwise.  Each NULL placement is encoded as a
    flag field before its value, so the struct order equals the SQL order.  A
    partial aggregate runs map-side, like the window's partial limit.

    Measured at sf0.1, it is 2x faster than the window when the payload is narrow
    (one column: 1.1 s vs 2.3 s) but slower when it carries whole wide rows over
    near-unique keys (3.3 s vs 1.9 s).  So ``latest_values`` uses it and whole-row
    de-dup keeps the window unless asked."""
    spec = parse_order(order)
    tie_desc = bool(spec) and spec[-1][1]
    if ties is None:
        used = set(keys) | {s[0] for s in spec}
        rest = [f for f in df.schema.fields if f.name not in used and f.dataType.typeName() != "variant"]
        complex_types = {"array", "map", "struct"}
        tie_cols = [F.col(f.name) if f.dataType.typeName() not in complex_types else F.to_json(F.col(f.name))
                    for f in rest]
        spec_cols = [(F.col(n), d, nf) for n, d, nf in spec] + [(c, tie_desc, not tie_desc) for c in tie_cols]
    else:
        spec_cols = [(F.col(n), d, nf) for n, d, nf in spec] + [(F.col(t), False, True) for t in ties]
    if reverse:
        spec_cols = [(c, not d, not nf) for c, d, nf in spec_cols]
    if not spec_cols:
        return None
    directions = {d for _, d, _ in spec_cols}
    if len(directions) != 1:
        return None
    pick_max = directions.pop()
    fields = []
    for i, (c, _, nf) in enumerate(spec_cols):
        null_preferred = nf if pick_max else nf
        # max: larger wins, so a preferred NULL gets flag true; min: smaller wins, so it gets false
        flag = c.isNull() if (null_preferred == pick_max) else c.isNotNull()
        fields += [flag.alias(f"f{i}"), c.alias(f"v{i}")]
    ordering = F.struct(*fields)
    others = list(values) if values is not None else [c for c in df.columns if c not in set(keys)]
    row = F.struct(*[F.col(f"`{c}`") for c in others])
    pick = F.max_by(row, ordering) if pick_max else F.min_by(row, ordering)
    out = df.groupBy(*keys).agg(pick.alias("__row"))
    cols = [*keys, *others] if values is not None else df.columns
    return out.select(*[F.col(f"`{c}`") if c in set(keys) else F.col("__row")[c].alias(c) for c in cols])


def latest_values(df: DataFrame, keys: Sequence[str], order, values: Sequence[str],
                  ties: Sequence[str] | None = None) -> DataFrame:
    """W02 for a dimension look-up: per key, only ``values`` of the first row under
    ``order`` (e.g. the latest portfolio of a campaign).  A ``max_by``/``min_by``
    aggregate with a narrow payload when the sort keys share a direction, else the
    windowed ``latest_per_key``."""
    agg = _pick_by_aggregate(df, keys, order, ties, reverse=False, values=values)
    if agg is not None:
        return agg
    return latest_per_key(df, keys, order, ties).select(*keys, *values)


def latest_per_key(df: DataFrame, keys: Sequence[str], order, ties: Sequence[str] | None = None,
                   method: str = "window") -> DataFrame:
    """First row per key under ``order`` (``DISTINCT ON (keys) … ORDER BY``).

    ``order`` uses PostgreSQL defaults: ``"d desc"`` puts NULLs first.  Default
    tie-breakers (every other column) run in the order's direction.  The plan is
    ``row_number() = 1`` with Catalyst's partial ``WindowGroupLimit``;
    ``method="aggregate"`` uses ``max_by``/``min_by`` when the sort keys share a direction.
    """
    agg = _pick_by_aggregate(df, keys, order, ties, reverse=False) if method == "aggregate" else None
    if agg is not None:
        return agg
    w = Window.partitionBy(*keys).orderBy(*total_order(df, keys, order, ties))
    return df.withColumn(_RN, F.row_number().over(w)).where(F.col(_RN) == 1).drop(_RN)


def top_n_per_key(df: DataFrame, keys: Sequence[str], order, n: int, ties=None) -> DataFrame:
    """First ``n`` rows per key (same partial-limit plan as ``latest_per_key``)."""
    w = Window.partitionBy(*keys).orderBy(*total_order(df, keys, order, ties))
    return df.withColumn(_RN, F.row_number().over(w)).where(F.col(_RN) <= n).drop(_RN)


def dedupe(df: DataFrame, keys: Sequence[str], order, keep: str = "first", ties=None,
           method: str = "window") -> DataFrame:
    """One row per key subset, the first (or last) under ``order``.

    Spark has no input order, so the order is always explicit; ``keep='last'``
    reverses it (``sort_values(order).drop_duplicates(keys, keep='last')``).
    """
    if keep not in ("first", "last"):
        raise ValueError("keep must be 'first' or 'last'")
    agg = _pick_by_aggregate(df, keys, order, ties, reverse=keep == "last") if method == "aggregate" else None
    if agg is not None:
        return agg
    w = Window.partitionBy(*keys).orderBy(*total_order(df, keys, order, ties, reverse=keep == "last"))
    return df.withColumn(_RN, F.row_number().over(w)).where(F.col(_RN) == 1).drop(_RN)


def duplicate_rows(df: DataFrame, keys: Sequence[str], count_col: str = "dup_count") -> DataFrame:
    """Every row whose key occurs more than once (``duplicated(keep=False)``).

    Counted with a partially aggregated ``groupBy`` and joined back null-safely
    (pandas treats NULL keys as equal); AQE splits a skewed key on the big side.
    """
    counts = (df.groupBy(*keys).agg(F.count(F.lit(1)).alias(count_col))
              .where(F.col(count_col) > 1))
    renamed = counts.select(*[F.col(k).alias(f"__k_{i}") for i, k in enumerate(keys)], count_col)
    cond = [df[k].eqNullSafe(renamed[f"__k_{i}"]) for i, k in enumerate(keys)]
    return df.join(renamed, cond, "inner").drop(*[f"__k_{i}" for i in range(len(keys))])


def assert_unique(df: DataFrame, keys: Sequence[str]) -> None:
    """Raise when a key occurs twice.  One small action (``limit(1)``)."""
    bad = df.groupBy(*keys).count().where(F.col("count") > 1).limit(1).collect()
    if bad:
        raise ValueError(f"duplicate key {bad[0].asDict()} on {list(keys)}")


def full_row_distinct(df: DataFrame) -> DataFrame:
    """All columns equal, NULLs equal."""
    return df.distinct()


def last_non_null(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Per key, for each other column its last non-NULL value under ``order``
    (``groupby(keys).last()``).  ``max_by`` ignores NULL orderings, so the order is
    nulled where the value is NULL; aggregates combine map-side."""
    ordering = F.struct(*[F.col(o) for o in order]) if len(order) > 1 else F.col(order[0])
    aggs = [F.max_by(F.col(c), F.when(F.col(c).isNotNull(), ordering)).alias(c)
            for c in df.columns if c not in set(keys)]
    return df.groupBy(*keys).agg(*aggs)


def latest_snapshot(df: DataFrame, date_col: str, by: Sequence[str] = ()) -> DataFrame:
    """rows on the latest ``date_col`` (overall, or per ``by`` group).

    Overall: a scalar subquery (executed once, reused).  Per group: a small
    aggregate joined back on ``by`` + date (no unbounded window per group).
    """
    if not by:
        return df.where(F.col(date_col) == df.select(F.max(date_col)).scalar())
    mx = df.groupBy(*by).agg(F.max(date_col).alias(date_col))
    return df.join(mx, [*by, date_col], "left_semi")


def latest_load_only(df: DataFrame, keys: Sequence[str], loaded_at: str) -> DataFrame:
    """Of repeated appends, keep each key's row from the newest load."""
    return latest_per_key(df, keys, [f"{loaded_at} desc nulls last"])
