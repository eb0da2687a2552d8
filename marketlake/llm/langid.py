"""Language identification by interpolated Kneser-Ney character models.

**Model.**  For each language, an interpolated Kneser-Ney model of order ``ORDER``
over the characters of words (runs of letters, lower-cased, with a mark at both
ends).  Lower orders use continuation counts; the lowest interpolates with a
uniform distribution.  All models share sorted arrays of n-gram hashes, one per
order, with one column per language: the interpolated probability of the n-gram
and, for contexts, the weight that passes to the order below.

**Prediction.**  Every position of a word is looked up from the highest order
down (binary search in the sorted hashes).  A text's cross-entropy per character
is the sum over its words divided by their characters; the language with the
lowest wins (ties: the first by name).  ``score`` is that language's share in the
softmax of the negative cross-entropies over at most ``EVIDENCE`` characters.

**Rejection.**  A calibration part of the training sample (never counted into the
models) gives each language the ``REJECT_QUANTILE`` of its cross-entropies;
``rejected`` marks texts above it.

**Learning** uses at most ``SAMPLE_DOCS`` documents per language, in the order of
length class and then a seeded hash of the id: texts of up to ``SAMPLE_CHARS``
characters, then of up to twice as many, and so on.  The sample ends before the
text that would bring it over ``SAMPLE_DOCS * SAMPLE_CHARS`` characters, but the
first text is always taken, whole, so every language that has a text with a letter
gets a model.  The models of all languages are one dense table (n-grams x languages)
on the driver and in every worker; with many languages the characters of each are
fewer, so that languages x languages x characters stays within ``MAX_CELLS`` (a
table of about 1 GB at most).  Of more than ``MAX_LANGUAGES`` values (labels that are
not clean) those with the most documents are learned, and a warning says so.  One
task counts one language's sample.  Prediction reads every whole text.

Null texts and texts without a letter are ``und`` with score 0.  Rows with a null
language or id are not learned from.  Without any row to learn from, all are
``und``.
"""

from __future__ import annotations

import warnings
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from marketlake.llm._util import ROW, by_size, hash_order, pick, release_memory, smallest_hashes
from marketlake.llm._words import WordSums, flat, gram_hashes

ORDER = 4
DISCOUNT = 0.75
ALPHABET = 5000             # size of the uniform distribution under the unigrams
SAMPLE_DOCS = 500
SAMPLE_CHARS = 20_000
CALIBRATION = 5             # one in so many sampled documents calibrates
REJECT_QUANTILE = 0.995
MAX_LANGUAGES = 100
MAX_CELLS = 160_000_000      # languages x languages x characters learned per language
MAX_CLASSES = 18            # length classes: Spark's longest string has fewer than 2 ** 31 characters
EVIDENCE = 40
RUN_CHARS = 2_000_000       # characters of texts that are in work at once
UNDETERMINED = "und"
HEAD, TAIL = "\x02", "\x03"


# --- counting and estimating -------------------------------------------------------------------

def count_grams(counted: dict[str, int]) -> list[tuple[np.ndarray, ...]]:
    """Per order: sorted distinct hashes with count, hash of the context, hash of the n-gram
    without its first character, and whether it starts a word."""
    items = [*counted]
    code, word, pos = flat(items, HEAD, TAIL)
    weight = np.array([counted[w] for w in items], dtype=np.float64)
    hashes = {n: gram_hashes(code, n) for n in range(1, ORDER + 1)}
    out = []
    for n in range(1, ORDER + 1):
        at = np.flatnonzero(pos >= max(n - 1, 1))       # the head mark itself is never predicted
        key, first, inverse = np.unique(hashes[n][at], return_index=True, return_inverse=True)
        where = at[first]
        context = hashes[n - 1][where - 1] if n > 1 else np.zeros(len(where), dtype=np.uint64)
        suffix = hashes[n - 1][where] if n > 1 else np.zeros(len(where), dtype=np.uint64)
        out.append((key, np.bincount(inverse, weights=weight[word[at]]), context, suffix, pos[where] == n - 1))
    return out


@dataclass
class Grams:
    """One order of all languages: sorted hashes, and a column per language."""
    keys: np.ndarray
    values: np.ndarray

    def find(self, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if not len(self.keys):
            return np.zeros(len(wanted), dtype=np.int64), np.zeros(len(wanted), dtype=bool)
        at = np.searchsorted(self.keys, wanted)
        at[at == len(self.keys)] = 0
        return at, self.keys[at] == wanted


@dataclass
class Model:
    languages: list[str]
    logs: list[Grams]           # order 1 .. ORDER: -log probability of known n-grams
    backoffs: list[Grams]       # order 2 .. ORDER, by context: -log of the weight passed down
    limits: np.ndarray          # rejection limit per language

    def costs(self, items: list[str]) -> np.ndarray:
        """(words, languages + 1): nats of each word, and its characters (end mark included)."""
        if not self.languages:
            return np.array([[len(w) + 1.0] for w in items])
        code, word, pos = flat(items, HEAD, TAIL)
        hashes = {n: gram_hashes(code, n) for n in range(1, ORDER + 1)}
        cost = np.zeros((len(code), len(self.languages)))
        todo = np.flatnonzero(pos > 0)
        for n in range(ORDER, 0, -1):
            here = todo[pos[todo] >= n - 1] if n > 1 else todo
            at, hit = self.logs[n - 1].find(hashes[n][here])
            cost[here[hit]] += self.logs[n - 1].values[at[hit]]
            missed = here[~hit]
            if n > 1:
                at, hit = self.backoffs[n - 2].find(hashes[n - 1][missed - 1])
                cost[missed[hit]] += self.backoffs[n - 2].values[at[hit]]
                todo = np.concatenate([todo[pos[todo] < n - 1], missed])
            else:
                # a character no language knows: the uniform share of the lowest order
                cost[missed] += self.backoffs[-1].values[0] + np.log(ALPHABET)
        out = np.zeros((len(items), len(self.languages) + 1))
        for k in range(len(self.languages)):
            out[:, k] = np.bincount(word, weights=cost[:, k], minlength=len(items))
        out[:, -1] = np.bincount(word, minlength=len(items)) - 1
        return out

    def predict(self, sums: np.ndarray) -> tuple[list[str], np.ndarray, np.ndarray, np.ndarray]:
        """Languages, scores, cross-entropies and rejections for summed costs."""
        n = sums[:, -1]
        some = n > 0
        if not self.languages:
            return [UNDETERMINED] * len(sums), np.zeros(len(sums)), np.zeros(len(sums)), np.ones(len(sums), bool)
        entropy = sums[:, :-1] / np.maximum(n, 1)[:, None]
        best = entropy.argmin(axis=1)
        low = entropy[np.arange(len(sums)), best]
        share = 1 / np.exp(np.maximum((low[:, None] - entropy) * np.minimum(n, EVIDENCE)[:, None], -700)).sum(axis=1)
        names = [self.languages[b] if s else UNDETERMINED for b, s in zip(best, some, strict=True)]
        return names, np.where(some, share, 0.0), np.where(some, low, 0.0), ~some | (low > self.limits[best])


def estimate(languages: list[str], counts: list[list[tuple[np.ndarray, ...]]]) -> Model:
    """Kneser-Ney estimates from the counts of every language (``count_grams``)."""
    width = len(languages)
    keys = [np.unique(np.concatenate([c[n][0] for c in counts])) if counts else np.zeros(0, np.uint64)
            for n in range(ORDER)]
    # every n-gram has one context and one suffix, whatever the language
    context = [np.zeros(len(k), dtype=np.uint64) for k in keys]
    suffix = [np.zeros(len(k), dtype=np.uint64) for k in keys]
    amount = [np.zeros((len(k), width)) for k in keys]
    for lang, c in enumerate(counts):
        for n in range(ORDER):
            at = np.searchsorted(keys[n], c[n][0])
            context[n][at], suffix[n][at] = c[n][2], c[n][3]
            if n == ORDER - 1:
                amount[n][at, lang] = c[n][1]
            else:       # continuation count, but the raw one where a word starts
                left = np.bincount(np.searchsorted(c[n][0], c[n + 1][3]), minlength=len(c[n][0]))
                amount[n][at, lang] = np.where(c[n][4] & (n > 0), c[n][1], left)
    probability, logs, backoffs = None, [], []
    for n in range(ORDER):
        holders, group = np.unique(context[n], return_inverse=True)
        total, kinds = np.zeros((len(holders), width)), np.zeros((len(holders), width))
        for lang in range(width):
            total[:, lang] = np.bincount(group, weights=amount[n][:, lang], minlength=len(holders))
            kinds[:, lang] = np.bincount(group, weights=amount[n][:, lang] > 0, minlength=len(holders))
        passed = np.where(total > 0, DISCOUNT * kinds / np.maximum(total, 1), 1.0)
        lower = (np.full(amount[n].shape, 1 / ALPHABET) if n == 0
                 else probability[np.searchsorted(keys[n - 1], suffix[n])])
        own = np.where(total[group] > 0, np.maximum(amount[n] - DISCOUNT, 0) / np.maximum(total[group], 1), 0)
        probability = own + passed[group] * lower
        logs.append(Grams(keys[n], -np.log(probability)))
        backoffs.append(Grams(holders, -np.log(np.maximum(passed, 1e-12))))
    return Model(languages, logs, backoffs[1:] + backoffs[:1], np.full(width, np.inf))


# --- Spark jobs --------------------------------------------------------------------------------

def learnable(id_col: Column) -> Column:
    """Rows that the registered query learns from: crc32 of the id's text, modulo 4, is not 2."""
    return F.pmod(F.crc32(id_col.cast("string").cast("binary")), F.lit(4)) != 2


def draw(rows: DataFrame, by: str, count: int, seed: int = 3) -> DataFrame:
    """(``by``, h, text): at most ``count`` rows per value of ``by``, and ``count * SAMPLE_CHARS`` characters, or
    the share of ``MAX_CELLS`` if there are many values, unless the first text alone has more: those with the smallest ``h``, which is the length class of ``text`` (0: up to
    ``SAMPLE_CHARS`` characters, 1: up to twice as many, ...) before a seeded hash of doc_id.

    Distinct ids are counted per value and class first, so that the ranking and the fetch see a bounded
    number of rows, however many rows a value has."""
    size = F.length("text")
    # classes by doublings, counted with whole numbers
    kind = F.lit(0)
    for k in range(MAX_CLASSES - 1):
        kind = kind + (size > SAMPLE_CHARS * 2 ** k).cast("int")
    hashed = (rows.withColumn("size", size).withColumn("class", F.lpad(kind.cast("string"), 2, "0"))
              .withColumn("h", F.concat("class", hash_order(F.col("doc_id"), seed))))
    sizes = (hashed.groupBy(by, "class").agg(F.approx_count_distinct("h").alias("n")).groupBy(by)
             .agg(F.sum("n").alias("n"), F.collect_list(F.struct("class", "n")).alias("classes"))
             .orderBy(F.desc("n"), by).limit(MAX_LANGUAGES + 1).collect())
    if len(sizes) > MAX_LANGUAGES:
        warnings.warn(f"langid: more than {MAX_LANGUAGES} values of {by}; those with the most documents are learned",
                      stacklevel=3)
        sizes = sizes[:MAX_LANGUAGES]
    if not sizes:
        return hashed.limit(0)
    chars = min(count * SAMPLE_CHARS, MAX_CELLS // len(sizes) ** 2)

    def below(limits: dict[str, str], key: Column) -> Column:
        return F.col("h") <= F.try_element_at(F.create_map(*[F.lit(x) for pair in limits.items() for x in pair]), key)

    bounds, found = {}, {}
    for r in sizes:
        for k in sorted(r["classes"], key=lambda k: k["class"]):
            if found.get(r[by], 0) < 2 * count:     # twice, for the counts are approximate
                bounds[k["class"] + r[by]] = k["class"] + smallest_hashes(k["n"], count)
            found[r[by]] = found.get(r[by], 0) + k["n"]
    few = hashed.filter(below(bounds, F.concat(F.col("class"), F.col(by))))
    order = Window.partitionBy(by).orderBy("h")
    last = (few.groupBy(by, "h").agg(F.max("size").cast("long").alias("size"))
            .withColumn("rank", F.row_number().over(order)).withColumn("held", F.sum("size").over(order))
            .filter((F.col("rank") <= count) & ((F.col("rank") == 1) | (F.col("held") <= chars)))
            .groupBy(by).agg(F.max("h").alias("limit")).collect())
    few = few.filter(below({r[by]: r["limit"] for r in last} or {"": ""}, F.col(by)))
    # of several texts of one id the first in order, so that reruns learn from the same
    return few.groupBy(by, "h").agg(F.min("text").alias("text"))


def train(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
          where: Column | None = None) -> Model:
    """Learn from the rows of ``df`` (with a text, a language and an id) that ``where`` admits;
    ``where`` may use doc_id, text and lang."""
    rows = pick(df, doc_id=id_col, text=text_col, lang=lang_col)
    rows = rows.filter((F.lit(True) if where is None else where) & F.col("lang").isNotNull()
                       & F.col("doc_id").isNotNull() & F.col("text").rlike(r"\p{L}"))
    sample = draw(rows, "lang", SAMPLE_DOCS).select("lang", "h", "text")

    def count(pdf: pd.DataFrame) -> pd.DataFrame:
        from collections import Counter
        from marketlake.llm._words import words
        pdf = pdf.sort_values("h")
        held = pdf["text"].iloc[::CALIBRATION].tolist() if len(pdf) >= 2 * CALIBRATION else []
        kept = pdf["text"].drop(pdf.index[::CALIBRATION] if held else []).tolist()
        counted = Counter(w for t in kept for w in words(t))
        if not counted:
            return pd.DataFrame(columns=["lang", "calibration", "grams"])
        grams = [[a.tobytes() for a in order] for order in count_grams(dict(sorted(counted.items())))]
        return pd.DataFrame({"lang": [pdf["lang"].iloc[0]], "calibration": [held], "grams": [grams]})

    got = (sample.groupBy("lang").applyInPandas(
        count, "lang string, calibration array<string>, grams array<array<binary>>").collect())
    got.sort(key=lambda r: r["lang"])
    kinds = (np.uint64, np.float64, np.uint64, np.uint64, np.bool_)
    counts = [[tuple(np.frombuffer(b, dtype=k) for b, k in zip(order, kinds, strict=True)) for order in r["grams"]]
              for r in got]
    model = estimate([r["lang"] for r in got], counts)
    sums = WordSums(model.costs, len(model.languages) + 1)
    for lang, r in enumerate(got):
        s = sums(r["calibration"])
        s = s[s[:, -1] > 0]
        if len(s):
            model.limits[lang] = np.quantile(s[:, lang] / s[:, -1], REJECT_QUANTILE)
    return model


def predict(df: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", carry: bool = False,
            reject: bool = False) -> DataFrame:
    """Every row with doc_id, lang_pred, score, cross_entropy (nats a character) and rejected.
    With ``reject`` rejected texts are ``und``."""
    src = pick(df, carry=carry, doc_id=id_col, text=text_col)
    shared = df.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("lang_pred string, score double, cross_entropy double, rejected boolean")
    def label(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        own: Model = shared.value
        sums = WordSums(own.costs, len(own.languages) + 1)
        for texts in batches:
            parts = []
            for run in by_size(texts.tolist(), RUN_CHARS):
                names, score, entropy, rejected = own.predict(sums(run))
                if reject:
                    names = [UNDETERMINED if r else n for n, r in zip(names, rejected, strict=True)]
                parts.append(pd.DataFrame({"lang_pred": names, "score": score, "cross_entropy": entropy,
                                           "rejected": rejected}))
            yield pd.concat(parts) if parts else pd.DataFrame(
                {"lang_pred": [], "score": [], "cross_entropy": [], "rejected": []})
        del sums
        release_memory()

    out = src.select("doc_id", label(F.col("text")).alias("p"), *([ROW] if carry else []))
    return out.select("doc_id", "p.*", *([ROW] if carry else []))
