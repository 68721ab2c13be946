"""Periodic runs of words by internal pattern matching (Kociumaka, Radoszewski,
Rytter and Walen, 2015).

A run is a stretch of words with smallest period q, at least ``max(SHORTEST,
POWER * q)`` words long, that no neighbouring word extends. Texts are read many
at a time as one array of word numbers in which different texts share none:

1. Prefix doubling names the dyadic blocks: two positions have one name of level
   k if the same ``2 ** k`` words start there. Groups of one name are intervals
   of the suffix array; only groups of two and more are sorted further.
2. A wavelet tree over the suffix array answers range successor: the first
   occurrence of a block at or after a position.
3. For every level, B = ``2 ** k``, each aligned block asks for its occurrences
   that start B to 2 B - 1 words later. A run of period B <= q < 2 B holds an
   aligned block and that block q words later, so q is among the distances. One
   or two occurrences are tried as they are. Three and more form a progression
   of difference d, the block's period; then d-periodic stretches around the
   block and around its occurrences end q words apart if the run has smallest
   period q (otherwise it would have period d or a common divisor), so that the
   distance of their ends is the one period to try.
4. Every candidate is stretched both ways by longest common extensions, down
   the levels of the names. Stretches of one start and end are one run with the
   least of their periods.

Candidates are at most three for a block, so the work is n log n in the words,
whatever they repeat. Whole texts are processed, each in one task; memory is in
proportion to a batch of ``BATCH`` words or the longest text.

Cases: null and empty texts have no words, no runs and an empty collapsed text;
rows are each on their own, so repeated rows or ids give repeated results; a null
id stays null; other columns are ignored, whatever their names. An empty table
gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from credence.llm.common import as_bytes

SHORTEST, POWER = 6, 4
BATCH = 1 << 18
WORD_SPACE = "[\\x20\\x09-\\x0D]+"


class Names:
    """Dyadic names and the suffix array of texts laid end to end."""

    def __init__(self, words: np.ndarray, begin: np.ndarray, end: np.ndarray) -> None:
        """words: numbers; begin, end: of the text that each word is in."""
        n = len(words)
        self.begin, self.end = begin, end
        key = begin.astype(np.int64) * (int(words.max()) + 1) + words
        order = np.argsort(key, kind="stable")
        fresh = np.ones(n, bool)
        fresh[1:] = np.diff(key[order]) != 0
        place = np.arange(n)
        starts = np.maximum.accumulate(np.where(fresh, place, 0))
        name = np.full(n + 1, -1, np.int32)
        name[order] = starts
        self.levels, self.sizes = [], []
        half = 1
        while True:
            first = np.flatnonzero(fresh)
            size = np.zeros(n, np.int32)
            size[first] = np.diff(first, append=n)
            self.levels.append(name)
            self.sizes.append(size)
            active = np.flatnonzero(size[starts] > 1)
            if not len(active):
                break
            here = order[active]
            ahead = here + half
            after = np.where(ahead < end[here], name[np.minimum(ahead, n)], -1).astype(np.int64)
            key = starts[active] * (n + 1) + after + 1
            by = np.argsort(key, kind="stable")
            order[active] = here[by]
            fresh[active[1:]] |= np.diff(key[by]) != 0
            starts = np.maximum.accumulate(np.where(fresh, place, 0))
            name = name.copy()
            name[order[active]] = starts[active]
            half *= 2
        self.order = order

    def ahead(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """How many words are the same from i and from j on, i < j in one text."""
        i, j = i.copy(), j.copy()
        begin = i.copy()
        for k in range(len(self.levels) - 1, -1, -1):
            step = (self.levels[k][i] == self.levels[k][j]).astype(np.int64) << k
            i += step
            j += step
        return i - begin

    def behind(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """How many words are the same before i and before j, i < j in one text."""
        i, j = i.copy(), j.copy()
        end, low = i.copy(), self.begin[i]
        for k in range(len(self.levels) - 1, -1, -1):
            back = i - (1 << k)
            step = ((back >= low) & (self.levels[k][np.maximum(back, 0)] == self.levels[k][np.maximum(j - (1 << k), 0)]))
            i -= step.astype(np.int64) << k
            j -= step.astype(np.int64) << k
        return end - i


class WaveletTree:
    """Levels of bits of a permutation, highest bit first, zeros before ones;
    of each level the number of zeros before every place is kept."""

    def __init__(self, values: np.ndarray) -> None:
        self.zeros: list[np.ndarray] = []
        self.bits = max(1, int(len(values) - 1).bit_length())
        values = values.astype(np.int32)
        for b in range(self.bits - 1, -1, -1):
            zero = (values >> b) & 1 == 0
            before = np.zeros(len(values) + 1, np.int32)
            np.cumsum(zero, out=before[1:])
            self.zeros.append(before)
            values = np.concatenate([values[zero], values[~zero]])

    def smaller(self, low: np.ndarray, high: np.ndarray, than: np.ndarray) -> np.ndarray:
        """How many values at places low to high - 1 are below ``than``."""
        count = np.zeros(len(low), np.int64)
        over = than >= 1 << self.bits
        total = high - low
        for b, before in zip(range(self.bits - 1, -1, -1), self.zeros, strict=True):
            lo, hi, all_zeros = before[low], before[high], before[-1]
            one = (than >> b) & 1 == 1
            count += np.where(one, hi - lo, 0)
            low = np.where(one, all_zeros + low - lo, lo)
            high = np.where(one, all_zeros + high - hi, hi)
        return np.where(over, total, count)

    def kth(self, low: np.ndarray, high: np.ndarray, k: np.ndarray) -> np.ndarray:
        """The k-th smallest (from 0) of the values at places low to high - 1."""
        value = np.zeros(len(low), np.int64)
        for b, before in zip(range(self.bits - 1, -1, -1), self.zeros, strict=True):
            lo, hi, all_zeros = before[low], before[high], before[-1]
            one = k >= hi - lo
            k = np.where(one, k - (hi - lo), k)
            low = np.where(one, all_zeros + low - lo, lo)
            high = np.where(one, all_zeros + high - hi, hi)
            value += one.astype(np.int64) << b
        return value

    def successors(self, low: np.ndarray, high: np.ndarray, at: np.ndarray, below: np.ndarray, n: int) -> list[np.ndarray]:
        """The first n values from ``at`` to ``below`` - 1 at places low to high
        - 1, ascending; -1 where there are fewer."""
        rank = self.smaller(low, high, at)
        out = []
        left = np.arange(len(low))
        for _ in range(n):
            left = left[rank[left] < (high - low)[left]]
            found = np.full(len(low), -1, np.int64)
            got = self.kth(low[left], high[left], rank[left])
            good = got < below[left]
            left = left[good]
            found[left] = got[good]
            rank[left] += 1
            out.append(found)
        return out


def find_runs(words: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, length, period) of all runs of texts laid end to end, sorted;
    words: numbers, lengths: words of each text."""
    none = np.zeros(0, np.int64)
    if not len(words):
        return none, none, none
    ends = np.cumsum(lengths)
    begin, end = np.repeat(ends - lengths, lengths), np.repeat(ends, lengths)
    names = Names(words, begin, end)
    tree = WaveletTree(names.order)
    place = np.arange(len(words)) - begin
    found: list[tuple[np.ndarray, np.ndarray]] = []
    longest = int(lengths.max())
    for k, (name, size) in enumerate(zip(names.levels, names.sizes, strict=True)):
        block = 1 << k
        if POWER * block > longest:
            break
        # of periods 1 to 3 every other aligned block is enough
        at = np.flatnonzero(place & (max(block, 4) - 1) == 0)
        at = at[(size[name[at]] > 1) & (at + 2 * block <= end[at])]
        if not len(at):
            continue
        low = name[at].astype(np.int64)
        one, two, three = tree.successors(low, low + size[low], at + block, at + 2 * block, 3)
        few = three < 0
        for other in (one, two):
            good = few & (other >= 0)
            found.append((at[good], other[good] - at[good]))
        at, one, d = at[~few], one[~few], (two - one)[~few]
        period = one + names.ahead(one, one + d) - at - names.ahead(at, at + d)
        good = (period >= block) & (period < 2 * block) & (at + period < end[at])
        found.append((at[good], period[good]))
    if not found:
        return none, none, none
    at, period = (np.concatenate(x) for x in zip(*found, strict=True))
    back = names.behind(at, at + period)
    start, length = at - back, back + period + names.ahead(at, at + period)
    good = length >= np.maximum(SHORTEST, POWER * period)
    start, length, period = start[good], length[good], period[good]
    by = np.lexsort((period, length, start))
    start, length, period = start[by], length[by], period[by]
    first = np.ones(len(start), bool)
    first[1:] = (np.diff(start) != 0) | (np.diff(length) != 0)
    start, length, period = start[first], length[first], period[first]
    by = np.lexsort((period, start))
    return start[by], length[by], period[by]


_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def _of_texts(texts: list[bytes]) -> tuple[pa.Array, pa.Array]:
    """(runs, collapsed text) of every text."""
    split = [t.split() for t in texts]
    lengths = np.array([len(w) for w in split], np.int64)
    flat = [w for ws in split for w in ws]
    numbers = pa.array(flat, pa.large_binary()).dictionary_encode().indices.to_numpy().astype(np.int64)
    start, length, period = find_runs(numbers, lengths)
    drop = np.zeros(len(flat) + 1, np.int32)
    np.add.at(drop, start + period, 1)
    np.add.at(drop, start + length, -1)
    keep = np.cumsum(drop[:-1]) == 0
    ends = np.cumsum(lengths)
    begins = ends - lengths
    cut = np.searchsorted(start, np.append(begins, len(flat)))
    texts_out = []
    for ws, lo, hi, a, b in zip(split, begins, ends, cut[:-1], cut[1:], strict=True):
        texts_out.append(b" ".join(ws if a == b else compress(ws, keep[lo:hi].tolist())))
    of = np.searchsorted(ends, start, side="right")
    values = pa.StructArray.from_arrays([pa.array(start - begins[of]), pa.array(length), pa.array(period)], fields=list(_RUN))
    runs = pa.ListArray.from_arrays(pa.array(cut, pa.int32()), values)
    return runs, pa.array(texts_out, pa.binary()).cast(pa.string())


def _batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids, texts = batch.column(0), as_bytes(batch.column(1))
        at = 0
        while at < len(texts):
            to, size = at, 0
            while to < len(texts) and (to == at or size + len(texts[to]) // 5 <= BATCH):
                size += len(texts[to]) // 5
                to += 1
            runs, collapsed = _of_texts(texts[at:to])
            yield pa.record_batch([ids.slice(at, to - at), runs, collapsed], names=["doc_id", "runs", "collapsed"])
            at = to


def periodic_runs(docs: DataFrame) -> DataFrame:
    """Per row of docs: doc_id, runs (start, length, period; by start, then
    period), collapsed (the words joined by one space, of every run only the
    first period)."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(
        _batches, "doc_id long, runs array<struct<start:long,length:long,period:long>>, collapsed string")


def longest(runs: Column) -> Column:
    """The longest run (ties: smallest start, then period); null if there is none."""
    return F.reduce(runs, F.lit(None).cast("struct<start:long,length:long,period:long>"),
                    lambda best, r: F.when(best.isNull() | (r["length"] > best["length"]), r).otherwise(best))
