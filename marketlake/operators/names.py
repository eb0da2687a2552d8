"""Column-name normalisation.

Names are schema metadata: this is the only Python that runs on the driver, and
it touches no data.  ``df.toDF(*names)`` is a projection, free at any scale.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame

# A name is split into words at separators and, inside a chunk, where the kind of character
# changes; each alternative is one kind of word, tried in this order.  Letters outside ASCII
# (``ö``, ``É``) never start a word, they belong to the one before them.  Upper-case runs are
# taken greedily, which gives "eCPAddToCart" → "e_cpa_dd_to_cart", the spelling that stored
# tables already use.
_O = r"[^\W\dA-Za-z_]"                      # a letter outside ASCII
_LOWER = rf"(?:[a-z]|{_O})"
_WORD = re.compile(
    rf"(?P<run>[A-Z][0-9][A-Z]|[A-Z]{{2,}})"   # B2B, SKU, ASIN, CPA
    rf"|[A-Z]{_LOWER}*"                         # Sold, Views, D
    rf"|{_LOWER}+"                              # units
    rf"|[0-9]+{_LOWER}*"                        # 7d, 14d, 5
)
_SPACED = re.compile(r"(?<= )[0-9]+[A-Z](?= )")  # "2D" between spaces is one word


def _words(chunk: str, after_underscore: bool) -> list[str]:
    """Words of a run of word characters; ``after_underscore``: the run follows one."""
    words, at, glued = [], 0, after_underscore
    while at < len(chunk):
        one = re.match(rf"[a-z][0-9]+{_LOWER}*", chunk[at:]) if glued else None
        m = one or _WORD.match(chunk, at)
        if m is None:
            at += 1
            continue
        at += len(m.group())
        words.append(m.group().lower())
        # after a run of capitals, too, a single letter with digits stays whole
        glued = one is None and m.lastgroup == "run"
    return words


def normalise_name(name: str, drop_parens: bool = True, drop_extension: bool = False) -> str:
    """Report header / camelCase → snake_case SQL name; normalising twice changes nothing
    (names that start with a digit excepted).

    >>> normalise_name("unitsSoldClicks7d"), normalise_name("amount_b2b"), normalise_name("Größe")
    ('units_sold_clicks_7d', 'amount_b2b', 'größe')
    """
    if drop_extension:
        name = re.sub(r"\..+", "", name)
    if drop_parens:
        name = re.sub(r"\(.+\)", "", name)
    name = _SPACED.sub(lambda m: m.group().lower(), name)
    words = []
    for m in re.finditer(r"[^\W_]+", name):
        words += _words(m.group(), name[m.start() - 1:m.start()] == "_")
    return "_".join(w for w in words if w)


def normalise_names(df: DataFrame, drop_parens: bool = True) -> DataFrame:
    """P01 on every column."""
    return df.toDF(*[normalise_name(c, drop_parens) for c in df.columns])


def rename(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Rename by mapping; names not present are ignored."""
    return df.withColumnsRenamed({k: v for k, v in mapping.items() if k in df.columns})


def strip_prefix(df: DataFrame, prefix: str | None = None, first_segment: bool = False,
                 dots: bool = True) -> DataFrame:
    """Drop a literal prefix, or the first ``_`` segment; ``.`` → ``_``."""
    def one(c: str) -> str:
        if prefix and c.startswith(prefix):
            c = c[len(prefix):]
        if first_segment and "_" in c:
            c = c.split("_", 1)[1]
        return c.replace(".", "_") if dots else c
    return df.toDF(*[one(c) for c in df.columns])


def select_until(df: DataFrame, last: str) -> DataFrame:
    """Keep the columns up to and including ``last``."""
    return df.select(*[f"`{c}`" for c in df.columns[: df.columns.index(last) + 1]])


def drop_where(df: DataFrame, pred: Callable[[str], bool] | None = None,
               names: Sequence[str] = ()) -> DataFrame:
    """Drop columns by predicate on the name (e.g. contains ``Total``) or list."""
    gone = {c for c in df.columns if (pred and pred(c)) or c in set(names)}
    return df.select(*[f"`{c}`" for c in df.columns if c not in gone])
