"""Stretches of words that repeat with a period, by recursive frequency splitting and a lag scan of what is left.

A word of a run is found in it once in every period, so a word that is found too rarely within a segment can't belong to
a run there and splits it; the pieces are looked at again until none changes. The segments that survive are scanned lag
by lag: equal neighbouring blocks show the periods, common extensions the ends.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import text_slices

# Splitting may look at so many times as many words as there are; segments that still change then are scanned as they are.
SPLIT_EFFORT = 64
# Pairs of blocks that one step of the lag scan compares.
PAIRS_AT_ONCE = 1 << 20


def split_segments(codes: np.ndarray, edges: np.ndarray, times: int, least: int) -> np.ndarray:
    """(begin, end) of the segments within [edges[k], edges[k+1]) in which every word is found `times` times or more, of `least` words or more.

    All segments of a round are split side by side. The scan that follows is exact on any segment, so effort is bounded
    for texts that lose a few words a round without losing results.
    """
    segments = np.stack((edges[:-1], edges[1:]), axis=1)
    span, effort = int(codes.max(initial=0)) + 1, SPLIT_EFFORT * max(1, len(codes))
    done = [np.zeros((0, 2), np.int64)]
    while True:
        segments = segments[segments[:, 1] - segments[:, 0] >= least]
        size = segments[:, 1] - segments[:, 0]
        total = int(size.sum())
        if not total or effort < total:
            return np.concatenate([*done, segments])
        effort -= total
        owner = np.repeat(np.arange(len(size)), size)
        place = np.arange(total) - np.repeat(np.cumsum(size) - size, size) + np.repeat(segments[:, 0], size)
        _, same, counts = np.unique(owner * span + codes[place], return_inverse=True, return_counts=True)
        rare = counts[same] < times
        changed = np.bincount(owner[rare], minlength=len(size)) > 0
        done.append(segments[~changed])
        left = ~rare & changed[owner]
        place, owner = place[left], owner[left]
        if not len(place):
            return np.concatenate(done)
        starts = np.concatenate(([True], (np.diff(place) != 1) | (np.diff(owner) != 0)))
        ends = np.concatenate((starts[1:], [True]))
        segments = np.stack((place[starts], place[ends] + 1), axis=1)


class Blocks:
    """Equality of any two runs of a sequence: the runs of 1, 2, 4, ... items have numbers, equal for equal runs."""

    def __init__(self, codes: np.ndarray):
        self.n = len(codes)
        rank = np.unique(codes, return_inverse=True)[1].astype(np.int64)
        self.levels = max(1, self.n.bit_length())
        self.rank = np.zeros((self.levels, self.n), np.int32)
        self.rank[0] = rank
        for k in range(1, self.levels):
            half = 1 << (k - 1)
            rank = np.unique(rank[:-half] * self.n + rank[half:], return_inverse=True)[1].astype(np.int64)
            self.rank[k, : len(rank)] = rank

    def same(self, i: np.ndarray, j: np.ndarray, size: np.ndarray) -> np.ndarray:
        """Whether the runs of `size` (1 or more) items at i and at j are equal; two overlapping halves cover a run."""
        level = np.frexp(size.astype(np.float64))[1] - 1
        rest = size - (1 << level.astype(np.int64))
        return (self.rank[level, i] == self.rank[level, j]) & (self.rank[level, i + rest] == self.rank[level, j + rest])

    def forward(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """For how many items the sequence agrees from i and from j > i on."""
        out = np.zeros(len(i), np.int64)
        for k in range(self.levels - 1, -1, -1):
            fits = np.flatnonzero(j + out + (1 << k) <= self.n)
            agree = fits[self.rank[k, i[fits] + out[fits]] == self.rank[k, j[fits] + out[fits]]]
            out[agree] += 1 << k
        return out

    def backward(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """For how many items the sequence agrees before i and before j > i."""
        out = np.zeros(len(i), np.int64)
        for k in range(self.levels - 1, -1, -1):
            fits = np.flatnonzero(i - out - (1 << k) >= 0)
            a, b = i[fits] - out[fits] - (1 << k), j[fits] - out[fits] - (1 << k)
            out[fits[self.rank[k, a] == self.rank[k, b]]] += 1 << k
        return out


def prime_factors(n: int) -> np.ndarray:
    """A prime factor of each number up to n."""
    out = np.arange(n + 1)
    for p in range(2, int(n**0.5) + 1):
        if out[p] == p:
            out[p * p :: p] = p
    return out


def lag_scan(codes: np.ndarray, times: int, least: int) -> np.ndarray:
    """(start, length, period) of the runs of a segment: longest stretches with smallest period q, of max(least, times * q) items or more.

    A run holds times - 1 whole blocks of q items that begin at multiples of q, so for each lag only those are compared:
    m ln m pairs for m items. Of equal blocks that follow each other the first stands for its stretch. A block that has
    itself a period that divides q belongs to a shorter lag.
    """
    m = len(codes)
    longest = m // times
    if longest < 1 or m < least:
        return np.zeros((0, 3), np.int64)
    blocks, factor = Blocks(codes), prime_factors(longest)
    lags = np.arange(1, longest + 1)
    n_pairs = np.maximum(0, m // lags - (times - 1) + 1)
    step = np.searchsorted(np.cumsum(n_pairs), np.arange(0, int(n_pairs.sum()) + PAIRS_AT_ONCE, PAIRS_AT_ONCE), "left")
    found = [np.zeros((0, 3), np.int64)]
    for lo, hi in zip(step[:-1], [*step[1:-1], longest], strict=True):
        q = np.repeat(lags[lo:hi], n_pairs[lo:hi])
        b = np.arange(len(q)) - np.repeat(np.cumsum(n_pairs[lo:hi]) - n_pairs[lo:hi], n_pairs[lo:hi])
        hit = np.flatnonzero(blocks.same(b * q, (b + 1) * q, (times - 2) * q))
        q, b = q[hit], b[hit]
        leads = np.ones(len(q), bool)
        leads[1:] = (q[1:] != q[:-1]) | (b[1:] != b[:-1] + 1)
        q, i = q[leads], (b * q)[leads]
        rest, whole = q.copy(), np.ones(len(q), bool)
        while (open_ := np.flatnonzero(whole & (rest > 1))).size:
            p = factor[rest[open_]]
            period = q[open_] // p
            whole[open_] = ~blocks.same(i[open_], i[open_] + period, q[open_] - period)
            rest[open_] //= p
        q, i = q[whole], i[whole]
        back, on = blocks.backward(i, i + q), blocks.forward(i, i + q)
        length = back + on + q
        long_enough = length >= np.maximum(least, times * q)
        found.append(np.stack((i - back, length, q), axis=1)[long_enough])
    return np.unique(np.concatenate(found), axis=0)


def runs_of(texts: list[list[bytes]], times: int, least: int) -> list[np.ndarray]:
    """The runs of each of a few texts, given as words, in the order of start and period."""
    codes, edges, known = [np.zeros(0, np.int64)], [0], 0
    for words in texts:
        number = {w: k for k, w in enumerate(dict.fromkeys(words), known)}
        codes.append(np.fromiter(map(number.__getitem__, words), np.int64, len(words)))
        edges.append(edges[-1] + len(words))
        known += len(number)
    code, edge = np.concatenate(codes), np.array(edges)
    out: list[list[np.ndarray]] = [[] for _ in texts]
    for lo, hi in split_segments(code, edge, times, least):
        found = lag_scan(code[lo:hi], times, least)
        if len(found):
            k = int(np.searchsorted(edge, lo, "right")) - 1
            out[k].append(found + np.array([lo - edge[k], 0, 0]))
    order = lambda runs: runs[np.lexsort((runs[:, 2], runs[:, 0]))]
    return [order(np.concatenate(runs)) if runs else np.zeros((0, 3), np.int64) for runs in out]


def collapsed(words: list[bytes], runs: np.ndarray) -> bytes:
    """The words joined by one space, without those that a run holds after its first period."""
    if not len(runs):
        return b" ".join(words)
    keep = np.ones(len(words), bool)
    for start, length, period in runs.tolist():
        keep[start + period : start + length] = False
    return b" ".join(compress(words, keep.tolist()))


RUNS = "n_words long, runs array<struct<start:bigint,length:bigint,period:bigint>>, collapsed string"


def find_runs(docs: DataFrame, min_times: int = 4, min_length: int = 6, rewrite: Callable[[object, list[bytes]], list[bytes]] | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, n_words, runs and collapsed text of every row.

    A run is a stretch of words `[^\\x20\\x09-\\x0D]+` with smallest period q that no neighbouring word extends keeping q,
    of max(min_length, min_times * q) words or more (min_times is 3 or more); runs of different periods may overlap.
    collapsed keeps the first period of each run. `rewrite` may change the words of a row (given its id) before. Null and
    empty texts have no words and no runs. Texts are taken whole, however long: the work grows with n log n also where a
    text repeats one word. Rows that repeat, and rows with null ids, give a row each; an empty table gives none. Columns
    besides id and text are ignored, whatever their names.
    """
    if min_times < 3:
        raise ValueError("a run has three periods or more")
    kind = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))

    def per_batch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, data, at in text_slices(batch.column(1)):
                ids = batch.column(0).slice(first, len(at) - 1)
                # bytes.split() parts at exactly the six characters of white space.
                texts = [data[i:j].tobytes().split() for i, j in zip(at[:-1], at[1:], strict=True)]
                if rewrite:
                    texts = [rewrite(i, words) for i, words in zip(ids.to_pylist(), texts, strict=True)]
                found = runs_of(texts, min_times, min_length)
                rows = [[{"start": s, "length": n, "period": q} for s, n, q in runs.tolist()] for runs in found]
                short = pa.array([collapsed(words, runs) for words, runs in zip(texts, found, strict=True)], pa.large_binary()).view(pa.large_string())
                yield pa.RecordBatch.from_arrays([ids, pa.array([len(w) for w in texts], pa.int64()), pa.array(rows, kind), short.cast(pa.string())], names=[id_col, "n_words", "runs", "collapsed"])

    return docs.select(id_col, text_col).mapInArrow(per_batch, f"{id_col} {docs.schema[id_col].dataType.simpleString()}, {RUNS}")
