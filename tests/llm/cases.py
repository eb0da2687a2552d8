"""Small tables with every odd case, shared by the tests of the operators."""

from __future__ import annotations

import random

LONG = " ".join(f"word{i % 977}" for i in range(30_000))
ODD_TEXTS = [None, "", " \t\n", "a", "A", "a b", "x\x00y \x1f z", "Füße naïve ŒUVRE 日本語 😀 K", "0 1 2 3", "...", LONG, LONG + " end"]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
# further columns named like results and internals, also in another case
EXTRA = ("row", "keep_id", "size", "score", "node", "h", "kept", "component_id", "taken", "bytes", "words", "s", "p")


def odd_rows() -> list[tuple]:
    rows = [(i, t, "en" if i % 2 else None, f"s{i % 3}" if i % 4 else None, i) for i, t in enumerate(ODD_TEXTS)]
    rows += [(None, "no id here", "en", "s1", None), (None, None, None, None, None)]
    rows += [rows[5], rows[5], rows[10], (5, "same id, another text", "en", "s1", 1)]
    return rows


def with_extra(df):
    from pyspark.sql import functions as F
    return df.select("*", *[F.lit(f"extra {c}").alias(c) for c in EXTRA])


def sentences(n: int, seed: int, words: int = 40, vocabulary: int = 500) -> list[str]:
    rng = random.Random(seed)
    return [" ".join(f"w{rng.randrange(vocabulary)}" for _ in range(words)) for _ in range(n)]
