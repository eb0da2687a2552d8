"""Periodic runs of words, found through string synchronising sets.

Words are ``[^\\x20\\x09-\\x0D]+``, numbered from 0.  A run is a stretch of consecutive words
with smallest period q (words q apart are identical), of at least max(``MIN_WORDS``, 2 q)
words, that no neighbouring word extends.

**Small periods** (below ``DIRECT``) come from comparing the words with themselves shifted by
each period.

**Synchronising sets** give the others, one dyadic scale t for the periods from 4 t up to 8 t.
A position is selected when a hash of its next t words, or of the t words t further on, is the
smallest among the t + 1 windows that start there; windows with a period of at most t / 3 do
not compete.  The choice depends on the next 2 t words only, so two places of a run one period
apart are selected together.  Selected positions with equal contexts of 2 t words and a
distance in the scale's range propose that distance as a period.  A context is not highly
periodic, so few lie within that range of each other.

**Highly periodic regions** have no selected positions, and a period may consist of nothing
else.  Such a run lies over two adjacent regions of one small period p.  The regions are
known from the scales below; for every pair the offset between the two sides is looked up and
every period that it allows is proposed.

**Check.**  A proposal (place, period) is extended both ways by binary search on prefix hashes
modulo a prime of the words; the result is compared word by word before it counts, and one
that fails is replaced by a plain scan.  Of several periods with one stretch the smallest is
the run's.

Each text is worked on whole; texts meet in one array, the longest first, with a word of its
own after each.  Memory follows the longest text.  Null and empty texts have no words and no
runs; rows that repeat are worked on each for itself; empty tables give empty results.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlake.llm._util import ROW, pick, release_memory, runs_of

MIN_WORDS = 12
DIRECT = 16             # periods below are compared directly; 4 * the smallest scale
RUN_CHARS = 2_000_000   # characters of texts that are in work at once

_PRIME = np.uint64((1 << 61) - 1)
_BASE = 0x9E3779B97F4A7C15 % ((1 << 61) - 1)
_NONE = np.uint64((1 << 64) - 1)
_LOW32, _LOW29 = np.uint64((1 << 32) - 1), np.uint64((1 << 29) - 1)

Stretches = tuple[np.ndarray, np.ndarray, np.ndarray]       # start, end, period


def _reduce(x: np.ndarray) -> np.ndarray:
    x = (x & _PRIME) + (x >> np.uint64(61))
    return np.where(x >= _PRIME, x - _PRIME, x)


def _times(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """a * b modulo 2 ** 61 - 1, of values below it."""
    a1, a0, b1, b0 = a >> np.uint64(32), a & _LOW32, b >> np.uint64(32), b & _LOW32
    mid, low = a1 * b0 + a0 * b1, a0 * b0
    return _reduce(((a1 * b1) << np.uint64(3)) + (mid >> np.uint64(29)) + ((mid & _LOW29) << np.uint64(32))
                   + (low >> np.uint64(61)) + (low & _PRIME))


def _powers(base: int, count: int) -> np.ndarray:
    """base ** 0, base ** 1, ... modulo the prime, by doubling."""
    out = np.ones(1, dtype=np.uint64)
    while len(out) < count:
        step = np.uint64(pow(base, len(out), int(_PRIME)))
        out = np.concatenate([out, _times(out, np.broadcast_to(step, out.shape))])
    return out[:count]


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _window_min(x: np.ndarray, width: int) -> np.ndarray:
    """Smallest of every ``width`` consecutive values."""
    have = 1
    while have * 2 <= width:
        x = np.minimum(x[:-have], x[have:])
        have *= 2
    return np.minimum(x[:len(x) - (width - have)], x[width - have:]) if have < width else x


class Words:
    """Word numbers of several texts, with prefix hashes; ``ids`` has a word of its own after each text."""

    def __init__(self, ids: np.ndarray):
        self.ids = ids
        n = len(ids)
        term = _times(_reduce(_mix(ids.astype(np.uint64) + np.uint64(1))), _powers(_BASE, n))
        high = _reduce(np.cumsum(term >> np.uint64(32)))    # sums of halves do not overflow
        low = _reduce(np.cumsum(term & _LOW32))
        shift = np.broadcast_to(np.uint64(1 << 32), high.shape)
        self._prefix = np.r_[np.zeros(1, dtype=np.uint64), _reduce(_times(high, shift) + low)]
        self._unpower = _powers(pow(_BASE, -1, int(_PRIME)), n + 1)

    def hashes(self, at: np.ndarray, length: np.ndarray | int) -> np.ndarray:
        """Hash of ``length`` words from ``at``."""
        return _times(_reduce(self._prefix[at + length] + _PRIME - self._prefix[at]), self._unpower[at])

    def windows(self, length: int, limit: int) -> np.ndarray:
        """Hash of every window of ``length`` of the first ``limit`` words."""
        n = max(0, limit - length + 1)
        return _times(_reduce(self._prefix[length:length + n] + _PRIME - self._prefix[:n]), self._unpower[:n])

    def _agree(self, at: np.ndarray, period: np.ndarray, most: np.ndarray, forward: bool) -> np.ndarray:
        """How far the words from ``at`` on (or before it) equal those ``period`` later."""
        low, high = np.zeros_like(at), most.copy()
        while True:
            open_ = np.flatnonzero(low < high)
            if not len(open_):
                return low
            a, q, k = at[open_], period[open_], (low[open_] + high[open_] + 1) // 2
            a = a if forward else a - k
            same = self.hashes(a, k) == self.hashes(a + q, k)
            low[open_[same]] = k[same]
            high[open_[~same]] = k[~same] - 1

    def _true(self, start: int, end: int, period: int) -> bool:
        ids = self.ids
        return (np.array_equal(ids[start:end - period], ids[start + period:end])
                and (start == 0 or ids[start - 1] != ids[start - 1 + period])
                and (end == len(ids) or ids[end] != ids[end - period]))

    def _scan(self, at: int, period: int) -> tuple[int, int]:
        """The stretch around ``at`` by plain comparison."""
        apart = np.flatnonzero(self.ids[:-period] != self.ids[period:])
        k = np.searchsorted(apart, at)
        if k < len(apart) and apart[k] == at:
            return at, at
        start = apart[k - 1] + 1 if k else 0
        end = apart[k] if k < len(apart) else len(self.ids) - period
        return int(start), int(end) + period

    def stretches(self, at: np.ndarray, period: np.ndarray) -> Stretches:
        """Maximal stretches of ``period`` around the proposals, those of two periods or more, each once."""
        order = np.lexsort((at, period))
        at, period = at[order], period[order]
        # a proposal in the stretch of the one before it adds nothing
        near = np.flatnonzero((period[1:] == period[:-1]))
        gap = at[near + 1] - at[near]
        same = self.hashes(at[near], gap + 1) == self.hashes(at[near] + period[near], gap + 1)
        fresh = np.ones(len(at), dtype=bool)
        fresh[near[same] + 1] = False
        at, period = at[fresh], period[fresh]
        after = self._agree(at, period, len(self.ids) - period - at, True)
        before = self._agree(at, period, at, False)
        start, end = at - before, at + after + period
        good = (after + before >= period)
        start, end, period, at = start[good], end[good], period[good], at[good]
        if not len(start):
            return start, end, period
        _, first = np.unique(np.stack([start, end, period], axis=1), axis=0, return_index=True)
        start, end, period, at = start[first], end[first], period[first], at[first]
        for i in range(len(start)):
            if not self._true(start[i], end[i], period[i]):
                start[i], end[i] = self._scan(at[i], int(period[i]))
        good = end - start >= 2 * period
        return start[good], end[good], period[good]


def _direct(ids: np.ndarray, period: int, least: int) -> Stretches:
    """Stretches of a small period with at least ``least`` words, by comparison with the shifted words."""
    same = np.r_[False, ids[:-period] == ids[period:], False] if len(ids) > period else np.zeros(1, dtype=bool)
    edge = np.flatnonzero(same[1:] != same[:-1])
    start, end = edge[0::2], edge[1::2] + period
    good = end - start >= least
    return start[good], end[good], np.full(int(good.sum()), period)


def _joined(parts: list[Stretches]) -> Stretches:
    """All stretches; where several periods have one stretch, the smallest."""
    start, end, period = (np.concatenate([p[k] for p in parts]).astype(np.int64) for k in range(3))
    order = np.lexsort((period, end, start))
    start, end, period = start[order], end[order], period[order]
    if len(start):
        first = np.r_[True, (start[1:] != start[:-1]) | (end[1:] != end[:-1])]
        start, end, period = start[first], end[first], period[first]
    return start, end, period


def _selected(words: Words, t: int, periodic: Stretches, limit: int) -> np.ndarray:
    """The synchronising set of scale t in the first ``limit`` words."""
    value = _mix(words.windows(t, limit))
    change = np.zeros(len(value) + 1, dtype=np.int64)
    start, end, period = periodic
    use = (3 * period <= t) & (end - start >= t) & (end <= limit)
    np.add.at(change, start[use], 1)
    np.add.at(change, end[use] - t + 1, -1)
    value[np.cumsum(change[:-1]) > 0] = _NONE
    if len(value) <= t:
        return np.zeros(0, dtype=np.int64)
    least = _window_min(value, t + 1)
    n = len(least)
    return np.flatnonzero((least != _NONE) & ((value[:n] == least) | (value[t:t + n] == least)))


def _equal_contexts(words: Words, t: int, selected: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(place, distance) of selected positions with equal contexts, 4 t to 8 t apart."""
    context = words.hashes(selected, 2 * t)
    order = np.argsort(context, kind="stable")
    context, place = context[order], selected[order]
    at, apart = [], []
    for lag in range(1, len(place)):
        gap = place[lag:] - place[:-lag]
        near = (context[lag:] == context[:-lag]) & (gap < 8 * t)
        if not near.any():
            break
        hit = np.flatnonzero(near & (gap >= 4 * t))
        at.append(place[hit])
        apart.append(gap[hit])
    if not at:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    return np.concatenate(at), np.concatenate(apart)


def _across_regions(words: Words, t: int, regions: Stretches) -> tuple[np.ndarray, np.ndarray]:
    """(place, period) that adjacent highly periodic regions of one period allow in the scale's range."""
    start, end, period = regions
    use = (3 * period <= t) & (end - start >= 4 * t)
    start, end, period = start[use], end[use], period[use]
    order = np.lexsort((start, period))
    start, end, period = start[order], end[order], period[order]
    at, found = [], []
    for k in np.flatnonzero((period[1:] == period[:-1]) & (start[1:] <= end[:-1])):
        p, left, right = int(period[k]), int(end[k]), int(start[k + 1])
        # the p words at the end of the left side, at every offset in the right side
        offset = np.arange(p)
        own = words.hashes(np.array([left - p]), p)
        same = np.flatnonzero(words.hashes(right + offset, p) == own)
        if not len(same):
            continue
        lead = (right + int(same[0]) - (left - p)) % p
        low, high = 4 * t, min(8 * t - 1, left - int(start[k]), int(end[k + 1]) - right)
        q = np.arange(low + (lead - low) % p, high + 1, p)
        found.append(q)
        at.append(np.maximum(right - q, start[k]))
    if not at:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    return np.concatenate(at), np.concatenate(found)


def find(texts: list[np.ndarray], min_words: int = MIN_WORDS) -> list[Stretches]:
    """Runs (start, end, period) of every text, given as arrays of word numbers, by start and period."""
    sizes = np.array([len(x) for x in texts], dtype=np.int64)
    order = np.argsort(-sizes, kind="stable")       # at every scale the texts that are long enough come first
    sizes = sizes[order]
    own = max((int(x.max()) + 1 for x in texts if len(x)), default=0)
    ids = np.concatenate([np.r_[texts[i], own + k] for k, i in enumerate(order)]) if len(texts) else np.zeros(0, int)
    base = np.cumsum(sizes + 1) - sizes - 1
    # stretches of three small periods and four words serve as highly periodic regions, too
    known = _joined([_direct(ids, q, max(2 * q, 4)) for q in range(1, DIRECT)])
    t, words = DIRECT // 4, None
    while len(sizes) and sizes[0] >= 8 * t:
        words = words or Words(ids)
        last = np.searchsorted(-sizes, -8 * t, side="right") - 1
        limit = int(base[last] + sizes[last] + 1)
        some = [_equal_contexts(words, t, _selected(words, t, known, limit)), _across_regions(words, t, known)]
        known = _joined([words.stretches(*[np.concatenate([x[k] for x in some]) for k in range(2)]), known])
        t *= 2
    start, end, period = known
    good = end - start >= np.maximum(min_words, 2 * period)
    start, end, period = start[good], end[good], period[good]
    by = np.lexsort((period, start))
    start, end, period = start[by], end[by], period[by]
    owner = np.searchsorted(base, start, side="right") - 1
    cut = np.searchsorted(owner, np.arange(len(texts) + 1))
    out: list[Stretches] = [None] * len(texts)  # type: ignore[list-item]
    for k, i in enumerate(order):
        part = slice(cut[k], cut[k + 1])
        out[i] = (start[part] - base[k], end[part] - base[k], period[part])
    return out


# --- texts -----------------------------------------------------------------------------------------

def _runs_and_rest(texts: list[str | None], min_words: int) -> tuple[list[Stretches], list[str]]:
    """Runs of every text, and its words without those that a run's first period already has."""
    number: dict[bytes, int] = {}
    # bytes are split at exactly the white space of the definition
    cut = [(t or "").encode("utf-8", "surrogatepass").split() for t in texts]
    runs = find([np.fromiter((number.setdefault(w, len(number)) for w in c), dtype=np.int64, count=len(c)) for c in cut],
                min_words)
    rest = []
    for c, (start, end, period) in zip(cut, runs, strict=True):
        if len(start):
            change = np.zeros(len(c) + 1, dtype=np.int64)
            np.add.at(change, start + period, 1)
            np.add.at(change, end, -1)
            c = [c[i] for i in np.flatnonzero(np.cumsum(change[:-1]) == 0)]
        rest.append(b" ".join(c).decode("utf-8", "surrogatepass"))
    return runs, rest


def _column(min_words: int):
    kind = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])

    @F.arrow_udf("struct<runs:array<struct<start:long,length:long,period:long>>,collapsed:string>")
    def runs_column(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            sizes, rows, rest = [0], [], []
            for some in runs_of(texts, RUN_CHARS):
                runs, kept = _runs_and_rest(some, min_words)
                sizes += [len(s) for s, _, _ in runs]
                rows += [np.stack([s, e - s, q], axis=1) for s, e, q in runs]
                rest.append(pa.array(kept, pa.string()))
            flat = np.concatenate(rows) if rows else np.zeros((0, 3), dtype=np.int64)
            items = pa.StructArray.from_arrays([pa.array(flat[:, k]) for k in range(3)], fields=list(kind))
            yield pa.StructArray.from_arrays(
                [pa.ListArray.from_arrays(pa.array(np.cumsum(sizes), pa.int32()), items),
                 pa.concat_arrays(rest) if rest else pa.array([], pa.string())], ["runs", "collapsed"])
        release_memory()

    return runs_column


def periodic_runs(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS,
                  carry: bool = False) -> DataFrame:
    """Every row with doc_id, runs (start, length, period; by start, then period) and collapsed.

    ``collapsed``: the words that no run repeats, joined by one space.
    """
    src = pick(df, carry=carry, doc_id=id_col, text=text_col)
    rest = [ROW] if carry else []
    return (src.select("doc_id", _column(min_words)(F.col("text")).alias("found"), *rest)
            .select("doc_id", "found.runs", "found.collapsed", *rest))
