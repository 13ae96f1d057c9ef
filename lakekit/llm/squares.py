"""Periodic runs of words, from squares caught online over dyadic blocks.

The stream of words is read at levels; level ``P`` (a power of two) sees periods from ``P`` to
``2 * P - 1``. Every completed block of ``P / 2`` words there is a catcher: it waits for its own
words to come back between ``P`` and ``2 * P - 1`` words later, which is what the first half of
a square does that holds the block. Blocks that come back in a row at the same distance
are one growing suffix comparison. Once it spans what the shortest wanted run has
to span, its ends are settled word by word, and it stays open while appended words go on
to match: its squares have merged into one run. Catchers inside a run that a lower level knows see multiples of
its period only and are let go, so the work is a few steps a word and level, however repetitive the text.

Blocks are compared by 64-bit hashes, many catchers at a time; runs are settled on the words themselves.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from numpy.lib.stride_tricks import sliding_window_view
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakekit.llm.encoding import slices, small_batches
from lakekit.llm.words import mix

REPEATS = 4
SHORTEST = 6
# A stretch of three periods, each of two blocks or more, holds five whole blocks wherever it starts.
CHAIN = 5
# Words appended at a time; bounds what a level holds besides the words themselves.
APPENDED = 1 << 20
# Up to this period a level's comparisons are laid out by distance, beyond it by block.
NARROW = 64
_LEFT, _RIGHT = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)


class _Level:
    """The catchers of one range of periods, their open runs and the runs that have ended."""

    def __init__(self, period: int):
        self.period, self.block = period, max(1, period // 2)
        self.row = 0  # the first block that has not yet met all its distances
        self.last = np.zeros((CHAIN, period), dtype=bool)  # what the blocks before it have met
        self.open: list[list[int]] = []
        self.ended: list[tuple[int, int, int]] = []

    def matches(self, hashes: np.ndarray, base: int, rows: int) -> np.ndarray:
        """For the next ``rows`` blocks, whether each comes back at each distance."""
        p, s = self.period, self.block
        at = self.row * s - base
        own = hashes[at : at + rows * s : s]
        if p <= NARROW:
            found = np.empty((p, rows), dtype=bool)
            for d in range(p):
                np.equal(hashes[at + p + d : at + p + d + rows * s : s][:rows], own, out=found[d])
            return found.T
        return sliding_window_view(hashes[at + p :], p)[::s][:rows] == own[:, None]

    def caught(self, hashes: np.ndarray, base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Starts and periods of the chains that have become long enough."""
        p, s = self.period, self.block
        rows = (n - s - 2 * p + 1) // s + 1 - self.row
        if rows <= 0:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        met = np.concatenate([self.last, self.matches(hashes, base, rows)])
        chain = met[1:-4] & met[2:-3] & met[3:-2] & met[4:-1] & met[5:]
        chain &= ~met[:-5]
        row, distance = np.nonzero(chain)
        start = (row + self.row - CHAIN + 1) * s
        self.row += rows
        self.last = np.ascontiguousarray(met[-CHAIN:])
        return start, distance + p

    def runs(self) -> list[tuple[int, int, int]]:
        """Known runs as (start, first word after it, period), those still open included."""
        return self.ended + [(x, z + q, q) for x, q, z in self.open if z - x >= 3 * q]


def _equal_until(words: np.ndarray, z: int, q: int) -> int:
    """The first place from ``z`` on whose word is not repeated ``q`` later, or the last known."""
    step, stop = 256, len(words) - q
    while z < stop:
        upto = min(z + step, stop)
        differs = words[z:upto] != words[z + q : upto + q]
        first = int(differs.argmax())
        if differs[first]:
            return z + first
        z, step = upto, step * 2
    return z


class SquareCatchers:
    """All maximal runs of at least ``repeats`` periods and ``shortest`` words in a stream.

    ``append`` takes the next numbers in pieces of any length, ``finish`` gives ``(start, length,
    period)`` of every run in any order. Periods above ``longest_period`` are not looked for.
    """

    def __init__(self, longest_period: int, repeats: int = REPEATS, shortest: int = SHORTEST):
        if repeats < REPEATS or shortest < SHORTEST:
            raise ValueError(f"runs need {REPEATS} periods and {SHORTEST} words at least")
        self._levels = [_Level(1 << k) for k in range(max(longest_period, 1).bit_length())]
        self._longest, self._repeats, self._shortest = longest_period, repeats, shortest
        self._words = np.zeros(0, dtype=np.int64)
        # Hashes of the windows of each block length, from a first place on.
        self._hashes = {level.block: (0, np.zeros(0, np.uint64)) for level in self._levels}

    def append(self, codes: np.ndarray) -> None:
        for a in range(0, len(codes), APPENDED):
            self._append(codes[a : a + APPENDED])

    def _append(self, codes: np.ndarray) -> None:
        self._words = np.concatenate([self._words, codes]) if len(self._words) else codes
        self._hash_windows(codes)
        below: list[tuple[int, int, int]] = []
        for level in self._levels:
            still = []
            for run in level.open:
                self._follow(level, run, still)
            level.open = still
            base, hashes = self._hashes[level.block]
            start, period = level.caught(hashes, base, len(self._words))
            for x, q in self._outside(start, period, level.block, below):
                self._settle(level, x, q)
            below += level.runs()
        self._forget()

    def _hash_windows(self, codes: np.ndarray) -> None:
        base, hashes = self._hashes[1]
        self._hashes[1] = base, np.concatenate([hashes, mix(codes.astype(np.uint64))])
        for s in sorted(self._hashes)[1:]:
            base, hashes = self._hashes[s]
            below, half = self._hashes[s // 2]
            a, b = base + len(hashes) - below, len(half) - s // 2
            if a < b:
                new = half[a:b] * _LEFT
                new += half[a + s // 2 : b + s // 2] * _RIGHT
                new ^= new >> np.uint64(29)
                self._hashes[s] = base, np.concatenate([hashes, new])

    def _forget(self) -> None:
        """Drop the hashes that no level comes back to."""
        for s, (base, hashes) in self._hashes.items():
            needed = [level.row * s for level in self._levels if level.block == s]
            if 2 * s in self._hashes:
                needed.append(self._hashes[2 * s][0] + len(self._hashes[2 * s][1]))
            first = min(min(needed), base + len(hashes))
            self._hashes[s] = first, hashes[first - base :].copy()

    @staticmethod
    def _outside(start: np.ndarray, period: np.ndarray, block: int, below: list) -> Iterator[tuple[int, int]]:
        """The chains that do not lie within one run of a lower level."""
        if len(start) and below:
            known = np.array(sorted(below), dtype=np.int64)
            reach = np.maximum.accumulate(known[:, 1])
            last = np.searchsorted(known[:, 0], start, side="right") - 1
            inside = (last >= 0) & (reach[last] >= start + period + CHAIN * block)
            start, period = start[~inside], period[~inside]
        return zip(start.tolist(), period.tolist(), strict=True)

    def _settle(self, level: _Level, b: int, q: int) -> None:
        """Extend a chain to the left, as far as its first block can miss, then to the right."""
        low = max(b - level.block, 0)
        differs = np.flatnonzero(self._words[low:b] != self._words[low + q : b + q])
        x = low + int(differs[-1]) + 1 if len(differs) else low
        self._follow(level, [x, q, x], level.open)

    def _follow(self, level: _Level, run: list[int], still: list[list[int]]) -> None:
        x, q, z = run
        z = _equal_until(self._words, z, q)
        if z + q == len(self._words):
            still.append([x, q, z])
        elif z - x >= self._needed(q):
            level.ended.append((x, z + q, q))

    def _needed(self, q: int) -> int:
        return max((self._repeats - 1) * q, self._shortest - q)

    def finish(self) -> np.ndarray:
        """Close the stream with numbers that equal nothing."""
        n = len(self._words)
        self._append(np.arange(-(1 << 62), -(1 << 62) + self._levels[-1].period + 1, dtype=np.int64))
        found = [(x, end - x, q) for level in self._levels for x, end, q in level.ended]
        found = [run for run in found if run[2] <= self._longest and run[0] + run[1] <= n]
        return np.array(found, dtype=np.int64).reshape(-1, 3)


def runs_of_texts(codes: np.ndarray, counts: np.ndarray, **wanted) -> tuple[np.ndarray, np.ndarray]:
    """Runs inside each of many sequences laid end to end: the sequence of each run, and
    ``(start in it, length, period)``, by sequence, start and period.

    Sequences of about the same length make one stream, with a number of its own between
    every two, so that no run reaches from one into the next.
    """
    repeats = wanted.get("repeats", REPEATS)
    firsts = np.cumsum(counts) - counts
    tops = np.where(counts >= wanted.get("shortest", SHORTEST), counts // repeats, 0)
    kinds = np.array([int(t).bit_length() for t in tops], dtype=np.int64)
    owners, runs = [np.zeros(0, np.int64)], [np.zeros((0, 3), np.int64)]
    for kind in np.unique(kinds[kinds > 0]):
        chosen = np.flatnonzero(kinds == kind)
        lengths = counts[chosen]
        starts = np.cumsum(lengths + 1) - lengths - 1
        stream = np.empty(int((lengths + 1).sum()), dtype=np.int64)
        stream[starts + lengths] = -1 - np.arange(len(chosen))
        place = np.arange(int(lengths.sum())) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        stream[place + np.repeat(starts, lengths)] = codes[place + np.repeat(firsts[chosen], lengths)]
        catchers = SquareCatchers(int(tops[chosen].max()), **wanted)
        catchers.append(stream)
        found = catchers.finish()
        which = np.searchsorted(starts, found[:, 0], side="right") - 1
        found[:, 0] -= starts[which]
        owners.append(chosen[which])
        runs.append(found)
    owner, run = np.concatenate(owners), np.concatenate(runs)
    order = np.lexsort((run[:, 2], run[:, 0], owner))
    return owner[order], run[order]


def text_words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The words of all texts in a row, and how many each has; null has none."""
    texts = pc.fill_null(texts.cast(pa.string()), "")
    lists = pc.ascii_split_whitespace(pc.ascii_trim_whitespace(texts))
    counts = np.asarray(pc.list_value_length(lists)).astype(np.int64)
    words = lists.flatten()
    blank = np.asarray(pc.equal(pc.binary_length(words), 0))
    if blank.any():
        # A blank text is split into one empty word.
        firsts = np.cumsum(counts) - counts
        counts[blank[firsts]] = 0
        words = words.filter(pa.array(~blank))
    return words, counts


def collapsed_texts(words: pa.Array, counts: np.ndarray, owner: np.ndarray, runs: np.ndarray) -> pa.Array:
    """Each text's words joined by single spaces, of every run its first period only."""
    firsts = np.cumsum(counts) - counts
    begins = firsts[owner] + runs[:, 0]
    cover = np.zeros(len(words) + 1, dtype=np.int64)
    np.add.at(cover, begins + runs[:, 2], 1)
    np.add.at(cover, begins + runs[:, 1], -1)
    kept = np.cumsum(cover[:-1]) == 0
    left = np.concatenate([[0], np.cumsum(kept)])[np.concatenate([firsts, [len(words)]])]
    lists = pa.ListArray.from_arrays(pa.array(left, pa.int32()), words.filter(pa.array(kept)))
    return pc.binary_join(lists, " ")


def longest_by_period(runs: np.ndarray) -> tuple[int, int, int]:
    """The run with the greatest length in periods; ties to the smaller start, then period."""
    share = runs[:, 1] / runs[:, 2]
    near = runs[share >= share.max() * (1 - 1e-12)].tolist()
    return tuple(max(near, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2])))


RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def _run_array(rows: Sequence | np.ndarray, mask: np.ndarray | None = None) -> pa.Array:
    columns = np.asarray(rows, dtype=np.int64).reshape(-1, 3)
    arrays = [pa.array(columns[:, i]) for i in range(3)]
    return pa.StructArray.from_arrays(arrays, fields=list(RUN), mask=None if mask is None else pa.array(mask))


def found_runs(texts: pa.Array, **wanted) -> tuple[pa.Array, pa.Array, pa.Array]:
    """Runs, best run and collapsed text of each text."""
    words, counts = text_words(texts)
    codes = np.asarray(words.dictionary_encode().indices).astype(np.int64)
    owner, runs = runs_of_texts(codes, counts, **wanted)
    bounds = np.searchsorted(owner, np.arange(len(counts) + 1))
    lists = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), _run_array(runs))
    none = np.diff(bounds) == 0
    best = np.zeros((len(counts), 3), dtype=np.int64)
    for i in np.flatnonzero(~none):
        best[i] = longest_by_period(runs[bounds[i] : bounds[i + 1]])
    return lists, _run_array(best, none), collapsed_texts(words, counts, owner, runs)


def periodic_runs(
    docs: DataFrame,
    *,
    text: str = "text",
    keep: Sequence[str] = ("doc_id",),
    repeats: int = REPEATS,
    shortest: int = SHORTEST,
) -> DataFrame:
    """``runs``, ``best`` and ``collapsed`` of every document, after the columns to ``keep``.

    ``runs`` holds start (word number), length and period of every stretch of words with a
    smallest period ``q`` and at least ``max(shortest, repeats * q)`` words that no
    neighbouring word extends, by start, then period. ``best`` is the one of most periods,
    null if there is none. ``collapsed`` is the text without the words that follow the first
    period of a run, its words joined by single spaces.

    A document is worked on where it is read, whole at any length; nothing is shuffled.
    Null, empty and blank texts have no words, no runs and an empty ``collapsed``. Repeated
    rows are treated alike, no rows give none, and other columns are left out.
    """
    small_batches(docs.sparkSession)
    wanted = {"repeats": repeats, "shortest": shortest}

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in slices(whole, "_text")):
            runs, best, collapsed = found_runs(batch.column("_text"), **wanted)
            columns = [*(batch.column(c) for c in keep), runs, best, collapsed]
            yield pa.RecordBatch.from_arrays(columns, names=[*keep, "runs", "best", "collapsed"])

    kept = docs.select(*keep)
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema)
    run = "struct<start: long, length: long, period: long>"
    schema = f"{fields}, runs array<{run}>, best {run}, collapsed string"
    return docs.select(*keep, F.col(text).alias("_text")).mapInArrow(find, schema)


def repeated_tail(
    text: Column, first: Callable[[Column], Column], period: Callable[[Column], Column]
) -> Column:
    """The words of a text joined by spaces, from word ``first`` on the next ``period`` over and over.

    Both are functions of the number of words. The list of words is bound to a lambda's variable, so
    that it is not split again for each word. Null gives null, a blank text the empty text.
    """
    words = F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != "")

    def repeat(w: Column) -> Column:
        a, p = first(F.size(w)), period(F.size(w))
        place = F.sequence(F.lit(0), F.size(w) - 1)
        bound = F.array(F.struct(w.alias("w"), a.cast("int").alias("a"), p.cast("int").alias("p")))

        def tail(b: Column) -> Column:
            at = lambda i: F.when(i < b["a"], i).otherwise(b["a"] + F.pmod(i - b["a"], b["p"]))
            return F.transform(place, lambda i: F.get(b["w"], at(i)))

        return F.array_join(F.element_at(F.transform(bound, tail), 1), " ")

    joined = F.transform(F.array(words), lambda w: F.when(F.size(w) > 0, repeat(w)).otherwise(F.lit("")))
    return F.element_at(joined, 1)
