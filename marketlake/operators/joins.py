"""Join operators.

Broadcast policy: a side is hinted for broadcast only when its *estimated* size
is under a bound (``broadcast_if_small``) or its size is fixed by construction
(literal dimensions).  Everything else is left to Catalyst + AQE, which switches
a sort-merge join to a broadcast join at run time from *measured* shuffle sizes
and splits skewed partitions (``spark.sql.adaptive.skewJoin.enabled``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketlake.operators.dedupe import latest_per_key

DEFAULT_BROADCAST_BYTES = 16 * 1024 * 1024  # of the optimizer estimate (compressed Parquet bytes)


def estimated_bytes(df: DataFrame) -> int | None:
    """Optimizer size estimate of a plan (no job is run), or None if unknown."""
    try:
        size = df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
        return int(size if isinstance(size, int) else size.toString())  # py4j may hand back a Python int
    except Exception:  # Spark Connect or an unexpected plan: no estimate
        return None


def broadcast_if_small(df: DataFrame, max_bytes: int = DEFAULT_BROADCAST_BYTES) -> DataFrame:
    """Hint a broadcast only when the estimate proves the side is small.

    Beyond the bound (or with no estimate) the plain frame is returned and the
    join shuffles on its keys; AQE may still broadcast it from measured sizes.
    """
    size = estimated_bytes(df)
    return F.broadcast(df) if size is not None and size <= max_bytes else df


def left_join_latest(fact: DataFrame, dim: DataFrame, keys: Sequence[str], order,
                     ties: Sequence[str] | None = None, fact_keys: Sequence[str] | None = None) -> DataFrame:
    """Left join to the latest row per key of a dimension
    (``LEFT JOIN (SELECT DISTINCT ON (k) … ORDER BY k, d DESC)``)."""
    latest = latest_per_key(dim, keys, order, ties)
    if fact_keys is None or list(fact_keys) == list(keys):
        return fact.join(latest, list(keys), "left")
    cond = [fact[fk] == latest[k] for fk, k in zip(fact_keys, keys)]
    return fact.join(latest, cond, "left")


def left_join_aggregated(fact: DataFrame, child: DataFrame, keys: Sequence[str],
                         aggs: Sequence[Column]) -> DataFrame:
    """Aggregate the child per key first (one row per key, partial
    aggregation map-side), then left join: no fan-out, small join input."""
    return fact.join(child.groupBy(*keys).agg(*aggs), list(keys), "left")


def left_join_known(left: DataFrame, right: DataFrame, keys: Sequence[str], spread: Sequence[str]) -> DataFrame:
    """Left join on ``keys`` when a third of the left rows may have a NULL among them.

    Such rows match nothing, but a plain left join sends them all to one task.  They are spread by a
    further key, the hash of the left columns ``spread``; it is 0 for all rows with a key, on both sides."""
    def part(df: DataFrame, of: Sequence[str]) -> DataFrame:
        known = _known(df, keys)
        return df.withColumn("__spread", F.when(known, F.lit(0)).otherwise(F.xxhash64(*of)))

    return part(left, spread).join(part(right, keys), [*keys, "__spread"], "left").drop("__spread")


def left_join_exploded(fact: DataFrame, child: DataFrame, array_col: str, element_key: str | None,
                       key: str, on: str) -> DataFrame:
    """Explode the child's array (empty arrays drop out, like
    ``jsonb_array_elements``), take ``element_key`` of each element as ``key``,
    then left join the fact on ``on == key``."""
    el = F.col("__el")
    exploded = child.select("*", F.explode(array_col).alias("__el"))
    exploded = exploded.withColumn(key, el[element_key] if element_key else el).drop("__el", array_col)
    return fact.join(exploded, fact[on] == exploded[key], "left")


def _known(df: DataFrame, cols: Sequence[str]) -> Column:
    cond = F.lit(True)
    for c in cols:
        cond = cond & df[c].isNotNull()
    return cond


def _nulls(df: DataFrame) -> list[Column]:
    return [F.lit(None).cast(f.dataType).alias(f.name) for f in df.schema.fields]


def _outer_parts(left: DataFrame, right: DataFrame, left_on: Sequence[str], right_on: Sequence[str],
                 null_equal: bool) -> DataFrame:
    """``left FULL JOIN right`` as matches ∪ left rows without one ∪ right rows without one.

    AQE splits a skewed partition of an inner join on both sides, of an outer join on none that is
    padded, and of a full join not at all.  The side that only decides whether there is a match is
    reduced to its distinct keys, map-side first.  A side's rows are shuffled by the same exchange
    for its matches and its rest, which Spark reuses."""
    def same(l: DataFrame, r: DataFrame, a: Sequence[str], b: Sequence[str]) -> list[Column]:
        return [l[x].eqNullSafe(r[y]) if null_equal else l[x] == r[y] for x, y in zip(a, b, strict=True)]

    def without(side: DataFrame, on: Sequence[str], other: DataFrame, other_on: Sequence[str]) -> DataFrame:
        keys = other.select(*[F.col(c).alias(f"__k{i}") for i, c in enumerate(other_on)]).distinct()
        return side.join(keys, same(side, keys, on, keys.columns), "left_anti")

    matched = left.join(right, same(left, right, left_on, right_on), "inner")
    alone = without(left, left_on, right, right_on).select("*", *_nulls(right))
    rest = without(right, right_on, left, left_on).select(*_nulls(left), "*")
    return matched.union(alone).union(rest)


def full_join_coalesced(left: DataFrame, right: DataFrame, keys: Sequence[str], unique_keys: bool = False) -> DataFrame:
    """Full outer join on ``keys`` with the keys coalesced into one column.

    Any key may hold a third of the rows of either side (see ``_outer_parts``); rows with a NULL key
    match nothing and are not shuffled.  ``unique_keys`` says that both sides have one row per key:
    then one plain full join, with an exchange per side, is all it takes."""
    keys = list(keys)
    if unique_keys:
        return left.join(right, keys, "full")
    if _share_columns(left, right):     # two frames of one origin: the join could not tell their columns apart
        names = right.columns
        right = right.toDF(*[f"__r{i}" for i in range(len(names))])
        out = _outer_keys(left, right, keys, [f"__r{names.index(k)}" for k in keys])
    else:
        names, out = right.columns, _outer_keys(left, right, keys, keys)
    at = {c: i for i, c in enumerate(left.columns)}
    other = {c: len(at) + i for i, c in enumerate(names)}
    flat = out.toDF(*[f"__p{i}" for i in range(len(out.columns))])
    return flat.select(*[F.coalesce(F.col(f"__p{at[k]}"), F.col(f"__p{other[k]}")).alias(k) for k in keys],
                       *[F.col(f"__p{i}").alias(c) for c, i in at.items() if c not in keys],
                       *[F.col(f"__p{i}").alias(c) for c, i in other.items() if c not in keys])


def _outer_keys(left: DataFrame, right: DataFrame, left_on: Sequence[str], right_on: Sequence[str]) -> DataFrame:
    """Full join on plain equality; rows with a NULL key match nothing and are not shuffled."""
    known, known_right = _known(left, left_on), _known(right, right_on)
    return (_outer_parts(left.where(known), right.where(known_right), left_on, right_on, False)
            .union(left.where(~known).select("*", *_nulls(right)))
            .union(right.where(~known_right).select(*_nulls(left), "*")))


def _share_columns(left: DataFrame, right: DataFrame) -> bool:
    def ids(df: DataFrame) -> set[int]:
        out = df._jdf.queryExecution().analyzed().output()
        return {out.apply(i).exprId().id() for i in range(out.size())}

    return bool(ids(left) & ids(right))


def outer_merge(left: DataFrame, right: DataFrame, left_on: Sequence[str], right_on: Sequence[str],
                null_equal: bool = True) -> DataFrame:
    """Full outer merge on differently named keys; ``null_equal`` reproduces
    pandas, which matches NULL keys to NULL keys.

    Rows with a NULL among their keys are a branch of their own, so they meet only each other
    (``null_equal``) or nothing; the others join on plain equality (see ``_outer_parts``)."""
    if not null_equal:
        return _outer_keys(left, right, left_on, right_on)
    known, known_right = _known(left, left_on), _known(right, right_on)
    return (_outer_parts(left.where(known), right.where(known_right), left_on, right_on, False)
            .union(_outer_parts(left.where(~known), right.where(~known_right), left_on, right_on, True)))


def missing_children(parent: DataFrame, child: DataFrame, keys: Sequence[str],
                     child_keys: Sequence[str] | None = None) -> DataFrame:
    """Parents without children (``NOT EXISTS`` → left anti join).

    The child side is reduced to its distinct keys first (partial distinct on the
    map side, in the same exchange the join needs), so a parent with a third of
    all children ships one row per map partition instead of all its children."""
    if child_keys is None or list(child_keys) == list(keys):
        return parent.join(child.select(*keys).distinct(), list(keys), "left_anti")
    c = child.select(*[F.col(b).alias(f"__c{i}") for i, b in enumerate(child_keys)]).distinct()
    cond = [parent[a] == c[f"__c{i}"] for i, a in enumerate(keys)]
    return parent.join(c, cond, "left_anti")


def with_children(parent: DataFrame, child: DataFrame, keys: Sequence[str],
                  child_keys: Sequence[str] | None = None) -> DataFrame:
    """J01 for one-to-many ``parent ⟕ child`` when a parent key may be hot.

    AQE can split a skewed partition only on the side that is not NULL-padded;
    in ``parent LEFT JOIN child`` the many-rows side (child) is the padded one.
    So this is written as ``child ⋈ parent`` (inner: both sides splittable) plus
    the parents without children (anti join on distinct child keys), padded with
    NULL child columns.  Same rows as the left join.  Both branches filter out NULL
    keys first, so they shuffle the very same parent rows and Spark reuses that
    exchange; parents with a NULL key have no children and need no shuffle."""
    child_keys = list(child_keys or keys)
    p, c = parent.where(_known(parent, keys)), child.where(_known(child, child_keys))
    matched = p.join(c, [p[a] == c[b] for a, b in zip(keys, child_keys)], "inner")
    lonely = missing_children(p, c, keys, child_keys)
    no_key = parent.where(~_known(parent, keys))
    pad = _nulls(child)
    return matched.unionByName(lonely.select("*", *pad)).unionByName(no_key.select("*", *pad))


def not_in(df: DataFrame, col: str, other: DataFrame, other_col: str) -> DataFrame:
    """SQL ``col NOT IN (SELECT other_col …)`` with its NULL rules: a NULL in
    ``other`` empties the result; a NULL ``col`` is never kept.  The NULL check is
    a scalar subquery over the plain column (one boolean per task); the membership
    test a left anti join."""
    o = other.select(F.col(other_col).alias("__v"))
    has_null = o.select(F.max(F.col("__v").isNull())).scalar()
    o = o.where(F.col("__v").isNotNull()).distinct()
    kept = df.where(F.col(col).isNotNull()).join(o, F.col(col) == F.col("__v"), "left_anti")
    return kept.where(~F.coalesce(has_null, F.lit(False)))


def orphans(child: DataFrame, parent: DataFrame, child_keys: Sequence[str],
            parent_keys: Sequence[str] | None = None) -> DataFrame:
    """Child rows whose non-NULL foreign key has no parent."""
    parent_keys = list(parent_keys or child_keys)
    p = parent.select(*[F.col(b).alias(f"__p{i}") for i, b in enumerate(parent_keys)])
    cond = [child[a] == p[f"__p{i}"] for i, a in enumerate(child_keys)]
    nonnull = child.where(F.greatest(*[F.col(a).isNull() for a in child_keys]) == F.lit(False)) \
        if len(child_keys) > 1 else child.where(F.col(child_keys[0]).isNotNull())
    return nonnull.join(p, cond, "left_anti")


def map_lookup(df: DataFrame, col: str, mapping: DataFrame, key: str, value: str, out: str | None = None,
               order=None) -> DataFrame:
    """``series.map(mapping)``: left join to a mapping made unique per key
    (first value under ``order``, deterministic), so the lookup never fans out."""
    m = mapping.where(F.col(key).isNotNull() & F.col(value).isNotNull()).select(key, value)
    m = latest_per_key(m, [key], order or [value])
    m = m.select(F.col(key).alias("__mk"), F.col(value).alias(out or value))
    return df.join(m, df[col] == m["__mk"], "left").drop("__mk")


def cleaned_key_join(left: DataFrame, right: DataFrame, cols: Sequence[str], cleaner,
                     right_cols: Sequence[str] | None = None) -> DataFrame:
    """Clean text keys on both sides with ``cleaner`` (a Column function),
    join on the cleaned values, drop the helper columns.  The right side is made
    distinct after cleaning, so spellings that clean to one key match once (J12)."""
    right_cols = list(right_cols or cols)
    lk = [f"__lk{i}" for i in range(len(cols))]
    rk = [f"__rk{i}" for i in range(len(cols))]
    l2 = left.withColumns({n: cleaner(F.col(c)) for n, c in zip(lk, cols)})
    r2 = right.withColumns({n: cleaner(F.col(c)) for n, c in zip(rk, right_cols)}).drop(*right_cols).distinct()
    cond = [l2[a] == r2[b] for a, b in zip(lk, rk)]
    return l2.join(r2, cond, "left").drop(*lk, *rk)
