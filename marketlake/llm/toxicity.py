"""Toxicity by non-negative positive-unlabelled learning.

**Model.**  Every word has a toxic degree, the logistic function of the sum of its
features' weights (the whole word and its character 3- to 5-grams, hashed into
``2 ** BITS`` cells).  A text's raw score is the mean degree of all its words, so it
grows with the share of toxic words and not with length; words that mean nothing
add almost nothing, whatever their number.

**Learning.**  Confirmed toxic texts are the positives; texts drawn without regard
to labels are the unlabelled part, in which a share ``prior`` is toxic.  With the
logistic loss l, the class-prior-corrected risk is

    prior * E_P[l(+g)] + max(0, E_U[l(-g)] - prior * E_P[l(-g)])

with g = ``GAIN`` * raw score + bias.  The second term estimates the risk on clean
texts, which cannot be negative; when the estimate is, the classifier has begun to
learn the unlabelled sample by heart, and the step goes up that term instead of
down (non-negative correction).  The prior is the toxic share of the labelled rows
that may be learned from.  Optimised by gradient descent with momentum on the whole
sample at once, in numpy, in one task; a feature's step shrinks with the number of
texts that have it.

**Calibration.**  A logistic map from the logarithm of raw scores to probabilities
is fitted on labelled clean texts and on positives that were not learned from
(every ``CALIBRATION``-th), both classes weighted alike, so ``predicted`` (score >=
``THRESHOLD``) has a fixed meaning.

**Bounds.**  The sample holds at most ``SAMPLE_TOXIC`` positives, ``SAMPLE_UNLABELLED``
unlabelled and ``SAMPLE_CLEAN`` labelled clean texts (the smallest of a seeded hash
of the id, among the ids that have a text; the length of a text does not matter).
Whole texts become counts of their words before they meet in the learning task, so
its memory follows the distinct words of each text.  Scoring reads every whole text.

Null texts and texts without words have raw score 0.  Ids with several label rows
count as toxic if one says so; null labels are no labels.  Without positives, or
without clean labelled texts, nothing can be learned: a warning says so, and every
score is the prior (0 without labels).
"""

from __future__ import annotations

import warnings
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketlake.llm._util import ROW, by_size, hash_order, pick, release_memory, smallest_hashes
from marketlake.llm._words import WordSums, flat, gram_hashes, word_hash, words

BITS = 18
GRAMS = (3, 4, 5)
SAMPLE_TOXIC = 1500
SAMPLE_UNLABELLED = 2500
SAMPLE_CLEAN = 1200
STEPS = 120
RATE = 300.0                # step size; with the momentum, and the decay of weights
MOMENTUM = 0.9
LIMIT = 0.1                 # most that one step adds to a feature's part of a word's degree
DECAY = 1e-6
GAIN = 200.0                # raw scores are shares of words, a few hundredths at most
START = -4.0                # degree (before the logistic function) of a word without weights
RARE = 3                    # features of fewer texts' words get no weight
SPREAD = 10.0               # softens the steps of rare features
FLOOR = 1e-3                # added to raw scores before the logarithm
CALIBRATION = 5
THRESHOLD = 0.7
RUN_CHARS = 2_000_000       # characters of texts that are in work at once
RUN_WORDS = 20_000          # words whose features are made at once
RUN_ENTRIES = 1 << 18       # numbers that are summed at once
TOXIC, UNLABELLED, CLEAN = 1, 0, -1


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * x))


# --- features ----------------------------------------------------------------------------------

def features(items: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(cell, word number) of every feature: those of all words, then their 3-grams, 4-grams, 5-grams."""
    mask = np.uint64((1 << BITS) - 1)
    size = np.array([len(w) + 2 for w in items], dtype=np.int64)
    counts = [len(items)] + [int(np.maximum(size - (n - 1), 0).sum()) for n in GRAMS]
    cell, owner = np.empty(sum(counts), dtype=np.int32), np.empty(sum(counts), dtype=np.int32)
    free = (np.cumsum(counts) - counts).tolist()    # the next place of each kind

    def put(kind: int, cells: np.ndarray, owners: np.ndarray) -> None:
        place = slice(free[kind], free[kind] + len(cells))
        cell[place], owner[place] = cells & mask, owners
        free[kind] += len(cells)

    for low in range(0, len(items), RUN_WORDS):
        some = items[low:low + RUN_WORDS]
        code, word, pos = flat(some, "<", ">")
        put(0, np.array([word_hash(w) for w in some], dtype=np.uint64), np.arange(low, low + len(some)))
        for kind, n in enumerate(GRAMS, 1):
            at = np.flatnonzero(pos >= n - 1)
            put(kind, gram_hashes(code, n)[at] >> np.uint64(20), word[at] + low)
    return cell, owner


def word_degrees(weights: np.ndarray, items: list[str]) -> np.ndarray:
    out = np.zeros(len(items))
    for low in range(0, len(items), RUN_WORDS):
        cell, owner = features(items[low:low + RUN_WORDS])
        out[low:low + RUN_WORDS] = np.bincount(owner, weights=weights[cell])
    return _sigmoid(out + START)


def _sums(index: np.ndarray, values: Callable[[slice], np.ndarray], size: int) -> np.ndarray:
    """``np.bincount`` of the index with the values as weights, added in the same order, but made and
    added a stretch at a time: learning holds no further arrays as long as the features."""
    out = np.zeros(size)
    for low in range(0, len(index), RUN_ENTRIES):
        part = slice(low, low + RUN_ENTRIES)
        np.add.at(out, index[part].astype(np.intp), values(part))
    return out


# --- learning ----------------------------------------------------------------------------------

@dataclass
class Model:
    weights: np.ndarray | None      # None: nothing could be learned
    slope: float = 1.0              # calibration: sigmoid(slope * log(raw + FLOOR) + shift)
    shift: float = 0.0
    prior: float = 0.0

    def word_rows(self, items: list[str]) -> np.ndarray:
        """(words, 2): degree and 1, so that sums give a text's total degree and length."""
        return np.column_stack([word_degrees(self.weights, items), np.ones(len(items))])

    def scores(self, sums: np.ndarray) -> np.ndarray:
        raw = sums[:, 0] / np.maximum(sums[:, 1], 1)
        return _sigmoid(self.slope * np.log(raw + FLOOR) + self.shift)


def _logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """Slope (not negative) and shift of a one-feature logistic regression: gradient steps on the
    standardised feature, with a small penalty that keeps separable samples finite."""
    middle, scale = float(x.mean()), max(float(x.std()), 1e-9)
    design = np.column_stack([(x - middle) / scale, np.ones(len(x))])
    weight = weight / weight.sum()
    beta = np.zeros(2)

    def loss(b: np.ndarray) -> float:
        z = design @ b
        return float(weight @ (np.logaddexp(0, z) - y * z) + 5e-4 * b[0] ** 2)

    for _ in range(100):
        p = _sigmoid(design @ beta)
        grad = design.T @ (weight * (p - y)) + np.array([1e-3 * beta[0], 0.0])
        hess = (design * (weight * p * (1 - p))[:, None]).T @ design + np.diag([1e-3, 1e-9])
        step = np.linalg.solve(hess, grad)
        size = 1.0
        while size > 1e-6 and loss(beta - size * step) > loss(beta):
            size /= 2
        beta = beta - size * step
        if np.abs(size * step).max() < 1e-9:
            break
    slope = max(float(beta[0]) / scale, 0.0)
    return slope, float(beta[1]) - slope * middle


def fit(texts: list[str], roles: np.ndarray, prior: float, steps: int = STEPS) -> Model:
    """nnPU training on (text, role) rows; CLEAN and every CALIBRATION-th TOXIC row calibrate."""
    cut = [Counter(words(t)) for t in texts]
    return fit_counts(pa.array([[*c] for c in cut], pa.list_(pa.string())),
                      pa.array([[*c.values()] for c in cut], pa.list_(pa.int32())), roles, prior, steps)


def fit_counts(items: pa.ListArray, amounts: pa.ListArray, roles: np.ndarray, prior: float,
               steps: int = STEPS) -> Model:
    """``fit`` on each text's distinct words and how often it has them."""
    n_texts = len(items)
    doc = np.repeat(np.arange(n_texts, dtype=np.int32), items.value_lengths().to_numpy(zero_copy_only=False))
    coded = items.flatten().dictionary_encode()
    number = coded.indices.to_numpy()
    amount = amounts.flatten().to_numpy().astype(np.float64)
    order = np.lexsort((number, doc))
    number, amount = number[order], amount[order]
    size = np.bincount(doc, weights=amount, minlength=n_texts)
    share = amount / np.maximum(size, 1)[doc]
    n_words = len(coded.dictionary)
    cell, owner = features(coded.dictionary.to_pylist())
    del coded, order, amount
    texts_of = np.bincount(number, minlength=n_words)
    seen = _sums(cell, lambda part: texts_of[owner[part]].astype(np.float64), 1 << BITS)
    pace = (seen >= RARE) / np.sqrt(seen + SPREAD)
    toxic = np.flatnonzero(roles == TOXIC)
    aside = np.zeros(n_texts, dtype=bool)
    if len(toxic) >= 2 * CALIBRATION:
        aside[toxic[::CALIBRATION]] = True
    positive, unlabelled = (roles == TOXIC) & ~aside, roles == UNLABELLED
    n_p, n_u = max(int(positive.sum()), 1), max(int(unlabelled.sum()), 1)
    weights, bias = np.zeros(1 << BITS), -2.0
    speed, bias_speed = np.zeros_like(weights), 0.0

    def degrees(own: np.ndarray) -> np.ndarray:
        return _sigmoid(_sums(owner, lambda part: own[cell[part]].astype(np.float64), n_words) + START)

    def raw_scores(degree: np.ndarray) -> np.ndarray:
        return _sums(doc, lambda part: share[part] * degree[number[part]], n_texts)

    for _ in range(steps):
        degree = degrees(weights * pace)
        g = GAIN * raw_scores(degree) + bias
        up, down = _sigmoid(g), _sigmoid(-g)        # d l(-g) = up, d l(+g) = -down
        clean_risk = (np.logaddexp(0, g[unlabelled]).sum() / n_u
                      - prior * np.logaddexp(0, g[positive]).sum() / n_p)
        d_clean = np.where(unlabelled, up / n_u, 0) - prior * np.where(positive, up / n_p, 0)
        d_g = -d_clean if clean_risk < 0 else d_clean - prior * np.where(positive, down / n_p, 0)
        d_degree = _sums(number, lambda part, d=d_g: share[part] * d[doc[part]], n_words)
        d_word = GAIN * degree * (1 - degree) * d_degree
        d_w = _sums(cell, lambda part, d=d_word: d[owner[part]], len(weights)) * pace + DECAY * weights
        speed = np.clip(MOMENTUM * speed - RATE * d_w, -LIMIT / np.maximum(pace, 1e-9), LIMIT / np.maximum(pace, 1e-9))
        bias_speed = MOMENTUM * bias_speed - 0.2 * d_g.sum()
        weights, bias = weights + speed, bias + bias_speed
    model = Model((weights * pace).astype(np.float32), prior=prior)
    raw = raw_scores(degrees(model.weights))
    known = roles == CLEAN
    marked = aside if aside.any() else roles == TOXIC
    known |= marked
    weight = np.where(marked, 1 / max(int(marked.sum()), 1), 1 / max(int((known & ~marked).sum()), 1))[known]
    model.slope, model.shift = _logistic(np.log(raw[known] + FLOOR), marked[known].astype(float), weight)
    return model


# --- Spark jobs --------------------------------------------------------------------------------

def learnable(id_col: Column) -> Column:
    """Rows that the registered query learns from: crc32 of the id's text, modulo 3, is not 1."""
    return F.pmod(F.crc32(id_col.cast("string").cast("binary")), F.lit(3)) != 1


def _smallest(ids: DataFrame, count: int, role: int) -> DataFrame:
    """At most ``count`` ids, those with the smallest hash: a top-k over the few ids below a bound that
    the number of distinct ids gives."""
    h = hash_order(F.col("doc_id"), 5)
    n = ids.agg(F.approx_count_distinct("doc_id")).first()[0]
    few = ids.filter(h <= smallest_hashes(n, count)).select("doc_id").distinct()
    return few.orderBy(h, "doc_id").limit(count).select("doc_id", F.lit(role).alias("role"))


def _word_counts(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
    """Distinct words of each text, in the order of their first place, and how often it has them."""
    for texts in batches:
        counted = [Counter(words(t)) for t in texts]
        yield pd.DataFrame({"words": [[*c] for c in counted], "amounts": [[*c.values()] for c in counted]})
    release_memory()


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          toxic_col: str = "toxic", where: Column | None = None) -> Model:
    """Learn from the rows of documents with a text that ``where`` (on doc_id) admits."""
    where = F.lit(True) if where is None else where
    marks = (pick(labels, doc_id=id_col, toxic=toxic_col).filter(where)
             .filter(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull())
             .groupBy("doc_id").agg(F.max("toxic").alias("toxic")))
    texts = pick(docs, doc_id=id_col, text=text_col).filter(where)
    texts = texts.filter(F.col("doc_id").isNotNull() & F.col("text").isNotNull())
    counts = marks.agg(F.count(F.lit(1)).alias("n"), F.sum((F.col("toxic") == 1).cast("int")).alias("p")).first()
    prior = (counts["p"] or 0) / counts["n"] if counts["n"] else 0.0

    def nothing(missing: str) -> Model:
        warnings.warn(f"toxicity: no {missing} to learn from; every score is the prior, {prior:.4f}", stacklevel=3)
        return Model(None, prior=prior)

    if not 0 < prior < 1:
        return nothing("clean labels" if prior else "toxic labels")
    usable = marks.join(texts.select("doc_id").distinct(), "doc_id", "left_semi")
    wanted = (_smallest(usable.filter("toxic = 1").select("doc_id"), SAMPLE_TOXIC, TOXIC)
              .union(_smallest(usable.filter("toxic = 0").select("doc_id"), SAMPLE_CLEAN, CLEAN))
              .union(_smallest(texts.select("doc_id"), SAMPLE_UNLABELLED, UNLABELLED)))
    count_words = F.pandas_udf(_word_counts, "words array<string>, amounts array<int>")
    # bounded by the three sample sizes
    # of several texts of one id the first in order, so that reruns learn from the same
    sample = (texts.join(F.broadcast(wanted), "doc_id").groupBy("doc_id", "role").agg(F.min("text").alias("text"))
              .select("doc_id", "role", count_words("text").alias("w")).select("doc_id", "role", "w.*"))

    def learn(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by([("role", "ascending"), ("doc_id", "ascending")]).combine_chunks()
        roles = rows["role"].to_numpy()
        has = [int((roles == r).sum()) for r in (TOXIC, CLEAN)]
        weights, slope, shift = None, 0.0, 0.0
        if all(has):
            items, amounts = (pa.concat_arrays(rows[c].chunks) for c in ("words", "amounts"))
            m = fit_counts(items, amounts, roles, prior)
            weights, slope, shift = m.weights.tobytes(), m.slope, m.shift
            del items, amounts
        del rows
        release_memory()
        return pa.table({"weights": pa.array([weights], pa.binary()), "slope": pa.array([slope], pa.float64()),
                         "shift": pa.array([shift], pa.float64()), "toxic": pa.array(has[:1], pa.int32())})

    got = sample.groupBy().applyInArrow(learn, "weights binary, slope double, shift double, toxic int").collect()
    if not got or got[0]["weights"] is None:
        return nothing("clean labelled texts" if got and got[0]["toxic"] else "toxic labelled texts")
    m = got[0]
    return Model(np.frombuffer(m["weights"], dtype=np.float32), m["slope"], m["shift"], prior)


def score(df: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text",
          carry: bool = False) -> DataFrame:
    """Every row with doc_id, score and predicted (and ``row`` if ``carry``)."""
    src = pick(df, carry=carry, doc_id=id_col, text=text_col)
    shared = df.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def rate(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        own: Model = shared.value
        sums = None if own.weights is None else WordSums(own.word_rows, 2)
        for texts in batches:
            if sums is None:
                yield pd.Series(np.full(len(texts), own.prior))
                continue
            parts = [own.scores(sums(run)) for run in by_size(texts.tolist(), RUN_CHARS)]
            yield pd.Series(np.concatenate(parts) if parts else np.zeros(0))
        del sums
        release_memory()

    out = src.select("doc_id", rate(F.col("text")).alias("score"), *([ROW] if carry else []))
    return out.select("doc_id", "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
                      *([ROW] if carry else []))
