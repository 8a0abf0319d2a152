"""Periodic runs of words by internal pattern matching."""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator, Sequence

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollmill.llm.common import map_texts, texts

# A run: a stretch with period q, of max(LEAST, TIMES * q) words or more.
LEAST, TIMES = 6, 4
#: Blocks of four words find all periods up to four: LEAST leaves room for them. Longer periods take blocks of 8, 16, ...
FIRST_BLOCK = 4
#: Words whose blocks are sorted together (a longer document is taken alone), and cells of one comparison.
POOL, CELLS = 1 << 19, 1 << 20


class Successors:
    """A wavelet matrix: the smallest value >= x in a slice of an array, for many slices at once.

    One packed bit per value and level, with a count for every 64 of them.
    """

    def __init__(self, values: np.ndarray, bits: int):
        self.levels = []
        for b in range(bits - 1, -1, -1):
            ones = (values >> b & 1).astype(bool)
            packed = np.packbits(ones, bitorder="little")
            words = np.zeros(len(values) // 64 + 1, "<u8")
            words.view(np.uint8)[: len(packed)] = packed
            before = np.concatenate([[0], np.cumsum(np.bitwise_count(words), dtype=np.int64)])
            zeros = len(values) - int(before[-1])
            self.levels.append((b, words, before, zeros))
            values = np.concatenate([values[~ones], values[ones]])

    @staticmethod
    def _ones(words: np.ndarray, before: np.ndarray, at: np.ndarray) -> np.ndarray:
        inside = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
        return before[at >> 6] + np.bitwise_count(words[at >> 6] & inside)

    def __call__(self, lo: np.ndarray, hi: np.ndarray, x: np.ndarray) -> np.ndarray:
        """-1 where the slice [lo, hi) has no such value."""
        a, b, rank = lo, hi, np.zeros(len(lo), np.int64)  # rank: how many values of the slice are below x
        for bit, words, before, zeros in self.levels:
            a1, b1 = self._ones(words, before, a), self._ones(words, before, b)
            one = (x >> bit & 1).astype(bool)
            rank += np.where(one, (b - b1) - (a - a1), 0)
            a, b = np.where(one, zeros + a1, a - a1), np.where(one, zeros + b1, b - b1)
        found = np.where(rank < hi - lo, 0, -1)
        a, b = lo, hi
        for bit, words, before, zeros in self.levels:
            a1, b1 = self._ones(words, before, a), self._ones(words, before, b)
            low = (b - b1) - (a - a1)
            one = rank >= low
            rank = np.where(one, rank - low, rank)
            found = np.where((found >= 0) & one, found | 1 << bit, found)
            a, b = np.where(one, zeros + a1, a - a1), np.where(one, zeros + b1, b - b1)
        return found


def candidates(symbols: np.ndarray, ends: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, int]]:
    """(block starts, distances to their next occurrence, block length) where that distance can be a run's period.

    `ends[i]` is the end of position i's document; documents share no symbol.

    Suffixes are sorted by their first 4, 8, 16, ... words; every block that starts at a multiple of half its
    length is then a slice of the suffix array, and its next occurrence the slice's range successor. A run of
    period q holds such a block of a length in [q, 2q), all of it a period before the run's end, and as a root of
    q words equals none of its rotations, that occurrence lies q words on.
    """
    n = len(symbols)
    rank = np.unique(symbols, return_inverse=True)[1].astype(np.int64)
    first = np.concatenate([[0], np.cumsum(np.bincount(rank))[:-1]])
    rank = first[rank]  # the place of a position's class in the suffix array
    order, size = np.arange(n), ends - np.arange(n)
    room = ends - np.concatenate([[0], np.flatnonzero(np.diff(ends)) + 1])[np.cumsum(np.concatenate([[0], np.diff(ends) != 0]))]
    active, length, kept, queries = np.arange(n), 1, None, []
    while active.size:
        # refine the classes of the active positions by what follows `length` words on
        after = np.where(size[active] > length, rank[np.minimum(active + length, n - 1)], -1)
        by = np.lexsort((after, rank[active]))
        at, own, nxt = active[by], rank[active[by]], after[by]
        new_own = np.concatenate([[True], own[1:] != own[:-1]])
        new = new_own | np.concatenate([[True], nxt[1:] != nxt[:-1]])
        places, index = np.arange(len(at)), np.cumsum(new) - 1
        head = np.maximum.accumulate(np.where(new_own, places, 0))
        start = np.maximum.accumulate(np.where(new, places, 0))
        rank[at] = own + start - head
        order[own + places - head] = at
        length *= 2
        many = np.bincount(index)[index]
        # a run of period q <= length has 4 * q > 2 * length words, if the block is not of the first length
        some = (many > 1) & (size[at] >= length) & (length == 2 or (room[at] >= 2 * length) | (length == FIRST_BLOCK))
        active, many = at[some], many[some]
        if length >= FIRST_BLOCK:
            if kept is None:
                kept = np.zeros(n, bool)
                kept[rank[at] + places - start] = some
            block = active % (length // 2) == 0
            queries.append((active[block], rank[active[block]], many[block], length))
        back = np.argsort(active)
        active = active[back]
    if kept is None or not kept.any():
        return
    place = np.concatenate([[0], np.cumsum(kept)])
    held = order[kept]
    successor = Successors(held, int(held.max()).bit_length() or 1)
    for starts, lo, many, length in queries:
        if starts.size:
            found = successor(place[lo], place[lo + many], starts + 1)
            gap = found - starts
            good = (found >= 0) & (gap <= length) & ((gap > length // 2) | (length == FIRST_BLOCK))
            yield starts[good], gap[good], length


def stretch(symbols: np.ndarray, at: np.ndarray, gap: np.ndarray, step: int) -> np.ndarray:
    """How many positions from `at` on, in direction `step`, equal the one `gap` words later."""
    total, going, width = np.zeros(len(at), np.int64), np.arange(len(at)), 8
    while going.size:
        still = []
        for part in np.array_split(going, -(-going.size * width // CELLS)):
            j = (at[part] + step * total[part])[:, None] + step * np.arange(width)
            inside = (j >= 0) & (j + gap[part][:, None] < len(symbols))
            j = np.where(inside, j, 0)
            same = inside & (symbols[j] == symbols[np.where(inside, j + gap[part][:, None], 0)])
            whole = same.all(axis=1)
            total[part] += np.where(whole, width, same.argmin(axis=1))
            still.append(part[whole])
        going, width = np.concatenate(still), min(2 * width, CELLS)
    return total


def runs_of(symbols: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Rows (start, length, period) of all runs, by start and then period."""
    found = [np.zeros((0, 3), np.int64)]
    for starts, gap, length in candidates(symbols, ends):
        by = np.lexsort((starts, gap))
        starts, gap = starts[by], gap[by]
        # occurrences that overlap by a period belong to one progression: its first block stands for it
        lone = np.ones(len(starts), bool)
        lone[1:] = (gap[1:] != gap[:-1]) | (starts[1:] > starts[:-1] + length)
        starts, gap = starts[lone], gap[lone]
        left = stretch(symbols, starts - 1, gap, -1)
        right = stretch(symbols, starts, gap, 1)
        rows = np.stack([starts - left, left + right + gap, gap], axis=1)
        found.append(rows[rows[:, 1] >= np.maximum(LEAST, TIMES * gap)])
    rows = np.unique(np.concatenate(found), axis=0)
    return rows[np.lexsort((rows[:, 2], rows[:, 0]))]


def pooled(pairs: list[list[bytes]]) -> Iterator[range]:
    """Neighbouring documents, POOL words or one document at a time."""
    at, words = 0, 0
    for i, doc in enumerate(pairs):
        if words and words + len(doc) > POOL:
            yield range(at, i)
            at, words = i, 0
        words += len(doc)
    if at < len(pairs):
        yield range(at, len(pairs))


def document_runs(docs: list[list[bytes]]) -> list[np.ndarray]:
    """The runs of each document."""
    out = []
    for some in pooled(docs):
        symbols, known = [], 0
        for i in some:
            ids: dict[bytes, int] = {}
            symbols.append(np.fromiter((ids.setdefault(w, len(ids)) for w in docs[i]), np.int64, len(docs[i])) + known)
            known += len(ids)
        sizes = np.array([len(s) for s in symbols], np.int64)
        bounds = np.concatenate([[0], np.cumsum(sizes)])
        rows = runs_of(np.concatenate(symbols), np.repeat(bounds[1:], sizes)) if bounds[-1] else np.zeros((0, 3), np.int64)
        cut = np.searchsorted(rows[:, 0], bounds)
        out += [rows[a:b] - [s, 0, 0] for a, b, s in zip(cut[:-1], cut[1:], bounds[:-1], strict=True)]
    return out


def collapsed(words: Sequence[bytes], rows: np.ndarray) -> str:
    """Words joined by one space, of each run only the first period."""
    if len(rows):
        depth = np.zeros(len(words) + 1, np.int64)
        np.add.at(depth, rows[:, 0] + rows[:, 2], 1)
        np.add.at(depth, rows[:, 0] + rows[:, 1], -1)
        words = [words[i] for i in np.flatnonzero(np.cumsum(depth[:-1]) == 0)]
    return b" ".join(words).decode()


def rotated(doc_id: int | None, words: list[bytes]) -> list[bytes]:
    """One document in ten with a period from word a on: the rule of the registered query."""
    h, n = zlib.crc32(str(doc_id).encode()), len(words)
    if doc_id is None or h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + (words[a : a + p] * ((n - a) // p + 1))[: n - a]


def find_runs(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    rewrite: Callable[[int | None, list[bytes]], list[bytes]] | None = None,
) -> DataFrame:
    """Columns doc_id, runs (array of start, length, period; by start, then period), collapsed; one row per input row.

    Words are cut at ASCII white space and compared as they are. A run is a stretch of max(6, 4 * q) words or more
    with smallest period q that neither neighbour prolongs; `collapsed` keeps the words that no run holds after its
    first q. `rewrite` may change a document's words first. NULL, empty and blank texts have no words and no
    runs; NULL and repeated ids are rows like any other. Other columns are not read. Empty tables give no rows.

    A document is worked on by itself, so nothing is shuffled; memory grows with the longest document, about 200 bytes a word.
    """

    def work(batches):
        for ids, found in batches:
            words = [(t or "").encode().split() for t in found]
            if rewrite:
                words = [rewrite(i, w) for i, w in zip(ids, words, strict=True)]
            runs = document_runs(words)
            yield {
                "doc_id": ids,
                "runs": [[dict(zip(("start", "length", "period"), r, strict=True)) for r in x.tolist()] for x in runs],
                "collapsed": [collapsed(w, x) for w, x in zip(words, runs, strict=True)],
            }

    schema = "doc_id bigint, runs array<struct<start:bigint,length:bigint,period:bigint>>, collapsed string"
    return map_texts(texts(docs, id_col, text_col), work, schema)


def run_digests(found: DataFrame) -> DataFrame:
    """The longest run of each row of `find_runs` (ties: smallest start, then period) and digests of runs and text."""
    best = F.expr(
        "array_max(transform(runs, r -> struct(r.length as length, -r.start as back, -r.period as small, r.start as start, r.period as period)))"
    )
    lines = F.expr("array_join(transform(runs, r -> concat(r.start, ',', r.length, ',', r.period, '\\n')), '')")
    return found.withColumn("best", best).select(
        "doc_id",
        F.size("runs").cast("bigint").alias("n_runs"),
        F.col("best.start").alias("start"),
        F.col("best.length").alias("length"),
        F.col("best.period").alias("period"),
        F.expr("(1000 * best.length) div best.period").alias("exponent_milli"),
        F.sha2(lines.cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )
