"""SentencePiece BPE encoding and decoding in vectorised merge rounds.

The vocabulary comes from a SentencePiece model file (BPE with byte fallback,
identity normalisation and a dummy prefix); its path is a parameter.  The driver
reads the file and makes the tables once; the workers get them as arrays (the number
of pieces is bounded and checked), so executors need no file and build nothing.

**Words.**  No symbol can span two neighbouring characters that stand together in
no piece; the text is cut there, which changes no result and leaves short words.
Distinct words of a batch are encoded once; a cache of bounded size keeps them
between batches.

**Merge rounds** over all words at once, on flat numpy arrays:

1. look up the rank of every neighbouring pair (a hash table probed for whole arrays);
2. take the smallest rank of each word (segmented minimum);
3. merge all its non-overlapping occurrences, leftmost first, and close the gaps;
4. words without any pair are done and leave the arrays.

The library merges one pair at a time.  Merging several at once gives the same
result unless a merge makes a new pair of the same or a better rank; the round
looks for that and merges only the leftmost pair of such a word.

Characters without a piece become their UTF-8 bytes' pieces.  Null and empty texts
give no ids and decode to the empty text.
"""

from __future__ import annotations

import codecs
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketlake.llm._util import by_size, release_memory, runs_of

SPACE = "▁"             # stands for U+0020 in pieces
MAX_PIECES = 1_000_000      # bound of the vocabulary whose tables are sent to every worker
CACHE_WORDS = 100_000       # words a task remembers
CACHE_CHARS = 64            # longer words are not remembered
RUN_CHARS = 500_000         # characters of texts that are in work at once
ROUND_CHARS = 100_000       # characters of new words that are merged at once
NONE = np.iinfo(np.int64).max
ID_SHIFT = 2_200_000        # above every symbol number


@dataclass(frozen=True)
class Vocabulary:
    """Pieces of a model: texts, scores, and which are bytes or carry no text."""
    pieces: tuple[str, ...]
    scores: tuple[float, ...]
    byte_ids: tuple[int, ...]        # of the bytes 0 .. 255
    no_text: frozenset[int] = field(default_factory=frozenset)   # control, unknown and byte pieces
    unknown: int = 0

    @staticmethod
    def load(path: str) -> Vocabulary:
        import sentencepiece
        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        n = sp.get_piece_size()
        if n > MAX_PIECES:
            raise ValueError(f"{n} pieces; the vocabulary is sent to every worker and holds {MAX_PIECES} at most")
        by_byte = {int(sp.id_to_piece(i)[1:-1], 16): i for i in range(n) if sp.is_byte(i)}
        if sorted(by_byte) != list(range(256)):
            raise ValueError("the model has no byte fallback")
        quiet = frozenset(i for i in range(n) if sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i))
        return Vocabulary(tuple(sp.id_to_piece(i) for i in range(n)), tuple(sp.get_score(i) for i in range(n)),
                          tuple(by_byte[b] for b in range(256)), quiet, sp.unk_id())


def _one_byte(error: UnicodeError) -> tuple[str, int]:
    return "�", error.start + 1


codecs.register_error("piece-bytes", _one_byte)


class PairTable:
    """Numbers of known (left, right) symbol pairs: open addressing, probed for whole arrays at once."""

    def __init__(self, left: np.ndarray, right: np.ndarray):
        self._bits = max(4, int(len(left)).bit_length() + 2)
        size = 1 << self._bits
        self._keys = np.full(size, -1, dtype=np.int64)
        self._numbers = np.zeros(size, dtype=np.int32)
        keys = left * ID_SHIFT + right
        todo, slot = np.arange(len(keys)), self._slot(keys)
        while len(todo):
            # of the pairs that want a free slot one gets it; the others go on to the next slot
            free = self._keys[slot[todo]] < 0
            self._keys[slot[todo[free]]] = keys[todo[free]]
            got = self._keys[slot[todo]] == keys[todo]
            self._numbers[slot[todo[got]]] = todo[got]
            todo = todo[~got]
            slot[todo] = (slot[todo] + 1) & (size - 1)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        mixed = keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return (mixed >> np.uint64(64 - self._bits)).astype(np.int64)

    def find(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(positions of the known pairs, their numbers)."""
        keys = left * ID_SHIFT + right
        slot = self._slot(keys)
        held = self._keys[slot]
        hit = held == keys
        at = np.flatnonzero(~hit & (held >= 0))
        while len(at):
            slot[at] = (slot[at] + 1) & (len(self._keys) - 1)
            held = self._keys[slot[at]]
            same = held == keys[at]
            hit[at[same]] = True
            at = at[~same & (held >= 0)]
        found = np.flatnonzero(hit)
        return found, self._numbers[slot[found]]


class Codec:
    """Encoder and decoder of one vocabulary (made on the driver; the workers get its tables)."""

    def __init__(self, vocabulary: Vocabulary):
        v = vocabulary
        normal = {p: i for i, p in enumerate(v.pieces) if i not in v.no_text}
        self._n_pieces = n = len(v.pieces)
        self._byte_ids = v.byte_ids
        # symbols: the pieces' ids, then characters that occur in pieces without being one
        chars = sorted({c for p in normal for c in p})
        symbol = {c: normal.get(c, n + k) for k, c in enumerate(chars)} | normal
        self._unknown_base = n + len(chars)     # + code point: a character that no piece contains
        self._symbol_of = np.arange(0x110000, dtype=np.int32) + np.int32(self._unknown_base)
        self._symbol_of[[ord(c) for c in chars]] = [symbol[c] for c in chars]
        self._char_of = {symbol[c]: c for c in chars if symbol[c] >= n}
        level = {s: r for r, s in enumerate(sorted({v.scores[i] for i in normal.values()}, reverse=True))}
        pairs, inside = {}, {}
        for p, i in normal.items():
            for k in range(1, len(p)):
                inside[symbol[p[k - 1]], symbol[p[k]]] = 0
                a, b = symbol.get(p[:k]), symbol.get(p[k:])
                if a is not None and b is not None:
                    pairs[a, b] = (level[v.scores[i]], i)
        self._pairs = PairTable(*np.array([*pairs], dtype=np.int64).reshape(-1, 2).T)
        self._pair_ranks, self._pair_ids = np.array([*pairs.values()], dtype=np.int64).reshape(-1, 2).T.copy()
        self._inside = PairTable(*np.array([*inside], dtype=np.int64).reshape(-1, 2).T)
        self._split = self._cutter([*normal])
        self._bytes = [b"" if i in v.no_text else p.replace(SPACE, " ").encode() for i, p in enumerate(v.pieces)]
        self._bytes[v.unknown] = " ⁇ ".encode()
        for b, i in enumerate(v.byte_ids):
            self._bytes[i] = bytes([b])
        self._first = [x[1:] if x[:1] == b" " and i not in v.no_text else x for i, x in enumerate(self._bytes)]
        self._cache: dict[str, bytes] = {}

    @staticmethod
    def _cutter(pieces: list[str]) -> re.Pattern:
        """Cuts a text into words that no piece crosses; read off the pieces themselves.

        Words begin with their spaces if no piece has a space after another character.  Characters
        that never share a piece, not even through others, with the most common letter (the usual
        punctuation) form words of their own.
        """
        if any(re.search(f"[^{SPACE}]{SPACE}", p) for p in pieces):
            return re.compile(".+", re.DOTALL)
        group: dict[str, str] = {}

        def top(c: str) -> str:
            while group.setdefault(c, c) != c:
                c = group[c]
            return c

        for p in pieces:
            for a, b in zip(p, p[1:]):
                if a != SPACE:
                    group[top(a)] = top(b)
        letters = top("e")
        other = {top(c) for c in map(chr, range(9, 127)) if c != " "} - {letters}
        apart = re.escape("".join(sorted(c for c in [*group] if top(c) in other)))
        if not apart:
            return re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+")
        return re.compile(f"{SPACE}*[^{SPACE}{apart}]+|{SPACE}*[{apart}]+|{SPACE}+")

    def _ranks(self, sym: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and merged id of the pair that starts at each symbol (NONE: no pair)."""
        rank, merged = np.full(len(sym), NONE), np.zeros(len(sym), dtype=np.int64)
        at = np.flatnonzero(word[:-1] == word[1:])
        found, number = self._pairs.find(sym[at], sym[at + 1])
        rank[at[found]], merged[at[found]] = self._pair_ranks[number], self._pair_ids[number]
        return rank, merged

    def _symbols(self, text: str) -> np.ndarray:
        return self._symbol_of[np.frombuffer(text.encode("utf-32-le"), dtype=np.uint32)].astype(np.int64)

    def merge_rounds(self, sym: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Final symbols with the number of their word, words in order."""
        done: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        place = np.arange(len(sym))
        while len(sym):
            rank, merged = self._ranks(sym, word)
            start = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
            length = np.diff(np.r_[start, len(sym)])
            best = np.repeat(np.minimum.reduceat(rank, start), length)
            over = best == NONE
            if over.any():
                done.append((place[over], sym[over], word[over]))
                live = ~over
                sym, word, place, rank, merged, best = (x[live] for x in (sym, word, place, rank, merged, best))
                if not len(sym):
                    break
            take = rank == best
            # of overlapping occurrences (a run of candidates) every second one, from the left
            index = np.arange(len(sym))
            fresh = take & ~np.r_[False, take[:-1]]
            take &= (index - np.maximum.accumulate(np.where(fresh, index, 0))) % 2 == 0
            new_sym, new_word, new_place, made = self._merge(sym, word, place, take, merged)
            # a new pair of the same or a better rank comes before the merges further right
            early = self._early(sym, word, take, merged, best, new_sym, new_word, made)
            if len(early):
                first = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
                so_far = np.cumsum(take)
                nth = so_far - np.repeat((so_far - take)[first], np.diff(np.r_[first, len(word)]))
                take &= ~(np.isin(word, early) & (nth > 1))
                new_sym, new_word, new_place, _ = self._merge(sym, word, place, take, merged)
            sym, word, place = new_sym, new_word, new_place
        if not done:
            return sym, word
        place, sym, word = (np.concatenate(x) for x in zip(*done, strict=True))
        order = np.argsort(place, kind="stable")
        return sym[order], word[order]

    def _early(self, sym, word, take, merged, best, new_sym, new_word, made) -> np.ndarray:
        """Words in which a merge makes a pair that is due at once, next to symbols as they were
        before this round or as they are after it."""
        at = np.flatnonzero(take)
        right = at[at + 2 < len(sym)]
        right = right[word[right] == word[right + 2]]
        left = at[at > 0]
        left = left[word[left] == word[left - 1]]
        both = np.flatnonzero(made[:-1] & made[1:] & (new_word[:-1] == new_word[1:]))
        limit = best[self._kept(take)]
        found, number = self._pairs.find(np.concatenate([merged[right], sym[left - 1], new_sym[both]]),
                                         np.concatenate([sym[right + 2], merged[left], new_sym[both + 1]]))
        words = np.concatenate([word[right], word[left], new_word[both]])
        limits = np.concatenate([best[right], best[left], limit[both]])
        return np.unique(words[found[self._pair_ranks[number] <= limits[found]]])

    @staticmethod
    def _kept(take: np.ndarray) -> np.ndarray:
        return ~np.r_[False, take[:-1]]

    def _merge(self, sym, word, place, take, merged):
        keep = self._kept(take)
        return np.where(take, merged, sym)[keep], word[keep], place[keep], take[keep]

    def encode_words(self, words: list[str]) -> list[bytes]:
        """Ids of each word as little-endian int32."""
        if not words:
            return []
        lengths = np.array([len(w) for w in words])
        sym = self._symbols("".join(words))
        chunk = np.repeat(np.arange(len(words)), lengths)
        cut = np.ones(len(sym), dtype=bool)
        same = np.flatnonzero(chunk[1:] == chunk[:-1])
        cut[1 + same[self._inside.find(sym[same], sym[same + 1])[0]]] = False
        segment = np.cumsum(cut) - 1
        owner = chunk[cut]
        out, segments = self.merge_rounds(sym, segment)
        whose = owner[segments]
        n = self._n_pieces
        odd = np.flatnonzero(out >= n)
        if len(odd):
            parts, at = [], 0
            ids: list[np.ndarray] = []
            for k in odd:
                s = int(out[k])
                raw = (chr(s - self._unknown_base) if s >= self._unknown_base else self._char_of[s]).encode()
                ids += [out[at:k], np.array([self._byte_ids[b] for b in raw])]
                parts += [whose[at:k], np.full(len(raw), whose[k])]
                at = k + 1
            out, whose = np.concatenate([*ids, out[at:]]), np.concatenate([*parts, whose[at:]])
        ends = np.searchsorted(whose, np.arange(len(words) + 1))
        raw = out.astype("<i4").tobytes()
        return [raw[4 * a:4 * b] for a, b in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)]

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Ids of each text as little-endian int32."""
        cut = []
        for t in texts:
            whole = SPACE + t.replace(" ", SPACE) if t else ""
            cut.append(self._split.findall(whole))
        cache = self._cache
        if len(cache) > CACHE_WORDS:
            cache.clear()
        new = list(set().union(*cut).difference(cache))
        for some in by_size(new, ROUND_CHARS):
            cache.update(zip(some, self.encode_words(some), strict=True))
        out = [b"".join(map(cache.__getitem__, words)) for words in cut]
        for w in new:
            if len(w) > CACHE_CHARS:
                del cache[w]
        return out

    def forget(self) -> None:
        """Empty the cache at the end of a task: idle workers would hold it through the next stages."""
        self._cache = {}

    def decode(self, ids: list[int]) -> str:
        if not ids:
            return ""
        table = self._bytes
        raw = self._first[ids[0]] + b"".join([table[i] for i in ids[1:]])
        return raw.decode("utf-8", errors="piece-bytes")


def _encode_array(codec: Codec, texts: pa.Array) -> pa.ListArray:
    parts: list[bytes] = []
    sizes = [0]
    for run in runs_of(texts, RUN_CHARS):
        got = codec.encode(run)
        sizes += [len(x) // 4 for x in got]
        parts.append(b"".join(got))
    values = pa.Array.from_buffers(pa.int32(), sum(sizes), [None, pa.py_buffer(b"".join(parts))])
    return pa.ListArray.from_arrays(pa.array(np.cumsum(sizes), pa.int32()), values)


def _decode_array(codec: Codec, ids: pa.ListArray) -> pa.Array:
    values, ends = ids.values.to_numpy(zero_copy_only=False), ids.offsets.to_numpy()
    null = ids.is_null().to_numpy(zero_copy_only=False)
    return pa.array(["" if n else codec.decode(values[a:b].tolist())
                     for a, b, n in zip(ends[:-1], ends[1:], null, strict=True)], pa.string())


class Tokenizer:
    """Column functions of one model: ``encode(text)``, ``decode(ids)``, ``round_trip(text)``."""

    def __init__(self, spark, path: str):
        shared = spark.sparkContext.broadcast(Codec(Vocabulary.load(path)))

        @F.arrow_udf("array<int>")
        def encode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
            for texts in batches:
                yield _encode_array(shared.value, texts)
            shared.value.forget()
            release_memory()

        @F.arrow_udf("string")
        def decode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
            for ids in batches:
                yield _decode_array(shared.value, ids)
            release_memory()

        @F.arrow_udf("struct<ids:array<int>,decoded:string>")
        def round_trip(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
            codec = shared.value
            for texts in batches:
                ids = _encode_array(codec, texts)
                yield pa.StructArray.from_arrays([ids, _decode_array(codec, ids)], ["ids", "decoded"])
            codec.forget()
            release_memory()

        self.encode, self.decode, self.round_trip = encode, decode, round_trip


def encode_decode(df: DataFrame, path: str, text_col: str | Column = "text") -> DataFrame:
    """``df`` (doc_id and text under its own names) with the struct ``piece``: ids and decoded text.

    One pass of one worker: ids are computed from the text, the decoded text from the ids alone.
    """
    tokenizer = Tokenizer(df.sparkSession, path)
    return df.withColumn("piece", tokenizer.round_trip(text_col))


def digests(encoded: DataFrame, with_ids: bool = False) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and decoded_sha256 of an encoded table (and ids)."""
    ids = F.col("piece.ids")
    return encoded.select("doc_id", *([ids.alias("ids")] if with_ids else []),
                          F.size(ids).cast("long").alias("n_tokens"),
                          F.sha2(F.array_join(ids.cast("array<string>"), ","), 256).alias("ids_sha256"),
                          F.sha2(F.col("piece.decoded"), 256).alias("decoded_sha256"))
