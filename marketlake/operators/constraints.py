"""Foreign keys that a load enforces.

A constraint names its columns and the table that must hold their values.  ``enforce``
looks every constraint up in one left join to the parent's distinct keys (partial
distinct map-side; a sort-merge left join is split by AQE where a key of the batch is
hot) and splits the batch into rows that may be stored and rejects that name the
constraints they violate.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

VIOLATED = "_violated"


@dataclass(frozen=True)
class ForeignKey:
    """``CONSTRAINT name FOREIGN KEY (columns) REFERENCES parent (parent_columns)``."""

    name: str
    columns: Sequence[str]
    parent: DataFrame
    parent_columns: Sequence[str] | None = None


def checked(batch: DataFrame, keys: Sequence[ForeignKey]) -> DataFrame:
    """The batch with ``_violated``: names of the constraints a row violates, in their order.  As in SQL, a row
    with a NULL among a constraint's columns does not violate it."""
    out, names = batch, []
    for n, key in enumerate(keys):
        at = [f"__fk{n}_{i}" for i in range(len(key.columns))]
        parent = key.parent.select(*[F.col(f"`{c}`").alias(a) for c, a in
                                     zip(key.parent_columns or key.columns, at, strict=True)]).dropna().distinct()
        parent = parent.withColumn(f"__has{n}", F.lit(True))
        same = [F.col(f"`{c}`") == F.col(a) for c, a in zip(key.columns, at, strict=True)]
        out = out.join(parent, same, "left").drop(*at)
        known: Column = F.lit(True)
        for c in key.columns:
            known = known & F.col(f"`{c}`").isNotNull()
        names.append(F.when(known & F.col(f"__has{n}").isNull(), F.lit(key.name)))
    violated = F.array_compact(F.array(*names)) if names else F.array().cast("array<string>")
    return out.withColumn(VIOLATED, violated).drop(*[f"__has{n}" for n in range(len(keys))])


def enforce(batch: DataFrame, keys: Sequence[ForeignKey]) -> tuple[DataFrame, DataFrame]:
    """(rows that violate nothing, rejects with ``_violated``)."""
    rows = checked(batch, keys)
    bad = F.size(VIOLATED) > 0
    return rows.where(~bad).drop(VIOLATED), rows.where(bad)
