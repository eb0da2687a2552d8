"""Shaping operators.

All are projections decided from the schema on the driver (metadata only) and
executed as one ``select`` per call: narrow, no shuffle, inside whole-stage codegen.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketlake.functions.nested import last_matches
from marketlake.functions.text import NULL_TOKENS


def _q(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def flatten(df: DataFrame, sep: str = "_", keep_arrays: bool = True) -> DataFrame:
    """``json_normalize(sep='_')``: nested struct fields become ``parent_child``
    columns, recursively; arrays stay typed array columns (N06: no ``{a, b}`` text form)."""
    cols: list[Column] = []

    def walk(path: list[str], dtype: T.DataType, expr: Column):
        if isinstance(dtype, T.StructType):
            for f in dtype.fields:
                walk(path + [f.name], f.dataType, expr[f.name])
        else:
            cols.append(expr.alias(sep.join(path)))

    for f in df.schema.fields:
        walk([f.name], f.dataType, F.col(_q(f.name)))
    return df.select(*cols)


def explode_records(df: DataFrame, record_path: str, keep: Sequence[str] = (), outer: bool = False,
                    prefix: str | None = None) -> DataFrame:
    """One row per element of the array at ``record_path``, the
    element's fields as columns (``explode`` drops empty lists; ``outer=True``
    keeps them as one NULL row).  ``keep`` carries parent columns along."""
    gen = F.explode_outer if outer else F.explode
    rec = df.select(*[F.col(_q(k)) for k in keep], gen(F.col(record_path)).alias("__rec"))
    el = rec.schema["__rec"].dataType
    if isinstance(el, T.StructType):
        fields = [F.col("__rec")[f.name].alias(f"{prefix}{f.name}" if prefix else f.name) for f in el.fields]
        return rec.select(*[F.col(_q(k)) for k in keep], *fields)
    return rec.withColumnRenamed("__rec", prefix or record_path.split(".")[-1])


def last_of_list(df: DataFrame, cols: Sequence[str] | None = None, sep: str = "_") -> DataFrame:
    """For each array-of-struct column, add ``col_field`` = that field of the
    last element that has it (non-NULL); the list column itself is dropped."""
    def has(name: str):
        return lambda x: x[name].isNotNull(), lambda x: x[name]

    out: list[Column] = []
    lasts: dict[str, Column] = {}
    for i, f in enumerate(df.schema.fields):
        dt = f.dataType
        take = (cols is None or f.name in cols) and isinstance(dt, T.ArrayType) \
            and isinstance(dt.elementType, T.StructType)
        if not take:
            out.append(F.col(_q(f.name)))
            continue
        # one pass over each list for all of its fields
        names = [sub.name for sub in dt.elementType.fields]
        lasts[f"__last{i}"] = last_matches(F.col(_q(f.name)), {f"v{k}": has(n) for k, n in enumerate(names)})
        out += [F.col(f"__last{i}")[f"v{k}"].alias(f"{f.name}{sep}{n}") for k, n in enumerate(names)]
    return df.withColumns(lasts).select(*out) if lasts else df.select(*out)


def reposition(df: DataFrame, positions: Mapping[str, int]) -> DataFrame:
    """Move columns to indexes, applied in mapping order; a missing column
    leaves the frame unchanged (as the source does)."""
    if not positions or any(c not in df.columns for c in positions):
        return df
    order = list(df.columns)
    for c, i in positions.items():
        order.remove(c)
        order.insert(i, c)
    return df.select(*[_q(c) for c in order])


def conform(df: DataFrame, schema: T.StructType, missing: str = "null", reject_col: str | None = None):
    """P10: make ``df`` match ``schema``: missing columns → NULL, extras dropped,
    order = schema's, values ``try_cast`` to the target types.

    With ``reject_col`` set, returns ``(ok, rejects)``: rows where a non-NULL input
    failed to cast go to ``rejects`` with the failing column names.
    ``missing='keep'`` returns the present columns only (the keyed merge then keeps
    stored values for absent columns instead of overwriting them with NULL).
    """
    have = set(df.columns)
    sel, checks = [], []
    for f in schema.fields:
        if f.name in have:
            src = F.col(_q(f.name))
            cast = src if df.schema[f.name].dataType == f.dataType else src.try_cast(f.dataType)
            sel.append(cast.alias(f.name))
            checks.append(F.when(src.isNotNull() & cast.isNull(), F.lit(f.name)))
        elif missing == "null":
            sel.append(F.lit(None).cast(f.dataType).alias(f.name))
    out = df.select(*sel, F.concat_ws(",", *checks).alias("__bad")) if checks else df.select(*sel, F.lit("").alias("__bad"))
    if reject_col is None:
        return out.drop("__bad")
    ok = out.where(F.col("__bad") == "").drop("__bad")
    bad = out.where(F.col("__bad") != "").withColumnRenamed("__bad", reject_col)
    return ok, bad


def tag(df: DataFrame, **values) -> DataFrame:
    """Provenance literals (tenant, marketplace, date, recorded_at …)."""
    return df.withColumns({k: (v if isinstance(v, Column) else F.lit(v)) for k, v in values.items()})


# Columns a report carries only for one time unit (fixed values of the report API).
TIME_UNIT_COLUMNS = {"DAILY": ["date"], "SUMMARY": ["startDate", "endDate"]}


def report_columns(columns: Sequence[str], time_unit: str, drop: Sequence[str] = ()) -> list[str]:
    """Metric set of a report for a time unit: DAILY has ``date`` but not
    ``startDate/endDate``; SUMMARY the reverse; ``drop`` removes more."""
    other = "SUMMARY" if time_unit == "DAILY" else "DAILY"
    gone = set(TIME_UNIT_COLUMNS[other]) | set(drop)
    return [c for c in columns if c not in gone]


def percent_to_ratio(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Divide percentage columns by 100 (in place)."""
    return df.withColumns({c: F.col(_q(c)) / F.lit(100.0) for c in cols})


def fill_defaults(df: DataFrame, values: Mapping[str, object]) -> DataFrame:
    """NULL → default for the named columns that exist."""
    return df.withColumns({c: F.coalesce(F.col(_q(c)), F.lit(v)) for c, v in values.items() if c in df.columns})


def null_tokens(df: DataFrame, tokens: Sequence[str] = NULL_TOKENS, cols: Sequence[str] | None = None) -> DataFrame:
    """Textual missing-value spellings → NULL on string columns."""
    targets = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)
               and (cols is None or f.name in cols)]
    return df.withColumns({c: F.when(F.col(_q(c)).isin(list(tokens)), F.lit(None)).otherwise(F.col(_q(c)))
                           for c in targets})


def schema_diff(expected: T.StructType, df: DataFrame) -> dict:
    """Which expected columns are absent, which are extra, which differ in type."""
    have = {f.name: f.dataType for f in df.schema.fields}
    want = {f.name: f.dataType for f in expected.fields}
    return {
        "missing": [c for c in want if c not in have],
        "extra": [c for c in have if c not in want],
        "type_mismatch": {c: (str(want[c]), str(have[c])) for c in want if c in have and want[c] != have[c]},
    }


def percent_text_columns(df: DataFrame, cols: Sequence[str], strict: bool = False) -> DataFrame:
    """K01 step 4: a text column bound for a float column is read as a number; when
    *any* of its values carries ``%`` (decided per column over the whole batch by one
    scalar subquery for all columns, not on the driver), every value is divided by
    100.  Text that is no number is NULL, or raises with ``strict``."""
    if not cols:
        return df
    has_pct = df.select(F.struct(*[F.max(F.col(_q(c)).contains("%")).alias(f"p{i}")
                                   for i, c in enumerate(cols)])).scalar()

    def number(i: int, c: str) -> Column:
        text = F.replace(F.col(_q(c)).cast("string"), F.lit("%"), F.lit(""))
        num = text.cast("double") if strict else text.try_cast("double")
        return F.when(F.coalesce(has_pct[f"p{i}"], F.lit(False)), num / F.lit(100.0)).otherwise(num)

    return df.withColumns({c: number(i, c) for i, c in enumerate(cols)})


def text_to_bool(c) -> Column:
    """K01 step 5 without its defect: 'False'/'false'/'0' → false, other non-empty
    text → true, NULL stays NULL (the source turned NULL into true, E8)."""
    c = F.col(_q(c)) if isinstance(c, str) else c
    s = F.trim(c.cast("string"))
    return F.when(s.isNull() | (s == ""), F.lit(None).cast("boolean")) \
            .when(s.isin("False", "false", "0"), F.lit(False)).otherwise(F.lit(True))
