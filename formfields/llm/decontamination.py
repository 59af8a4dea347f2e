"""Benchmark decontamination by greedy string tiling.

Documents and benchmark items that share a seed (a run of `min_tile` words) are tiled: the longest
non-overlapping common runs are marked again and again, found by rolling hashes, until none of
`min_tile` words is left. The share of an item's words under tiles decides, in whatever order they occur.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import LOWER, STEP, mix, span_hashes, text_slices, window_hashes

# Benchmarks up to this many bytes of text go to every task; larger ones are joined by seed.
BROADCAST_BYTES = 32 << 20
# ASCII letters and digits, and every byte of a multi-byte character, belong to words here: punctuation doesn't hide a copy.
WORD = np.zeros(256, bool)
WORD[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True


def words_of(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of case-folded (A-Z) words without punctuation, and the text number of each."""
    inside = WORD[data]
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    edge = at[(at > 0) & (at < len(data))]
    first[edge], last[edge - 1] = inside[edge], inside[edge - 1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    return span_hashes(LOWER[data], starts, ends), np.searchsorted(at, starts, "right") - 1


def text_words(text: str | None) -> np.ndarray:
    data = np.frombuffer((text or "").encode("utf-8", "surrogatepass"), np.uint8)
    return words_of(data, np.array([0, len(data)]))[0] if len(data) else np.zeros(0, np.uint64)


def tile(left: np.ndarray, right: np.ndarray, min_tile: int) -> np.ndarray:
    """Greedy string tiling of two word sequences: (start in left, start in right, length) of each tile.

    The wanted length starts at the shorter sequence's and is halved down to min_tile while nothing that long is
    left; a hash hit is extended as far as unmarked words agree, and longer finds are marked first.
    """
    a_free, b_free = np.ones(len(left), bool), np.ones(len(right), bool)
    tiles: list[tuple[int, int, int]] = []
    wanted = max(min(len(left), len(right)), 1)
    while wanted >= min_tile:
        i_hits, j_hits = unmarked_hits(left, right, a_free, b_free, wanted)
        sizes = reaches(left, right, a_free, b_free, i_hits, j_hits, wanted)
        found = np.lexsort((j_hits, i_hits, -sizes)).tolist()
        for i, j, n in zip(i_hits[found].tolist(), j_hits[found].tolist(), sizes[found].tolist(), strict=True):
            if not (a_free[i] and b_free[j] and a_free[i + n - 1] and b_free[j + n - 1]):
                continue
            if a_free[i : i + n].all() and b_free[j : j + n].all() and (left[i : i + n] == right[j : j + n]).all():
                a_free[i : i + n] = b_free[j : j + n] = False
                tiles.append((i, j, n))
                if min(a_free.sum(), b_free.sum()) < wanted:
                    break
        if found and len(unmarked_hits(left, right, a_free, b_free, wanted)[0]):
            continue
        if wanted == min_tile:
            break
        wanted = max(min_tile, wanted // 2)
    return np.array(tiles, np.int64).reshape(-1, 3)


def run_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """Hashes of all runs of n words, put together from those of 1, 2, 4, ... words."""
    count, size, at = len(words) - n + 1, 1, 0
    doubled, out = words, np.zeros(count, np.uint64)
    while size <= n:
        if n & size:
            out = mix(out * STEP + doubled[at : at + count])
            at += size
        if 2 * size <= n:
            doubled = mix(doubled[:-size] * STEP + doubled[size:])
        size *= 2
    return out


def reaches(left: np.ndarray, right: np.ndarray, a_free: np.ndarray, b_free: np.ndarray, i: np.ndarray, j: np.ndarray, n: int) -> np.ndarray:
    """How many words each hit of n words goes on for, as far as unmarked words agree; all hits grow side by side."""
    sizes = np.full(len(i), n, np.int64)
    growing = np.arange(len(i))
    while len(growing):
        x, y = i[growing] + sizes[growing], j[growing] + sizes[growing]
        within = (x < len(left)) & (y < len(right))
        growing, x, y = growing[within], x[within], y[within]
        growing = growing[a_free[x] & b_free[y] & (left[x] == right[y])]
        sizes[growing] += 1
    return sizes


def unmarked_hits(left: np.ndarray, right: np.ndarray, a_free: np.ndarray, b_free: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts of equal unmarked runs of n words (Karp-Rabin), without those that only continue another hit.

    A hit continues another where the unmarked words before it are equal. Starts are sorted by hash and word before, so
    such pairs are passed over as a range: texts that repeat a word don't give all pairs of their places.
    """
    none = np.zeros(0, np.int64)
    if len(left) < n or len(right) < n:
        return none, none

    def open_runs(free: np.ndarray) -> np.ndarray:
        marked = np.concatenate(([0], np.cumsum(~free)))
        return np.flatnonzero(marked[n:] == marked[:-n])

    def before(words: np.ndarray, free: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The unmarked word before each place, and whether there is one."""
        there = (at > 0) & free[np.maximum(at - 1, 0)]
        return np.where(there, words[np.maximum(at - 1, 0)], np.uint64(0)), there

    ia, ib = open_runs(a_free), open_runs(b_free)
    if not len(ia) or not len(ib):
        return none, none
    ha, hb = run_hashes(left, n)[ia], run_hashes(right, n)[ib]
    known = np.isin(ha, hb)
    ia, ha = ia[known], ha[known]
    if not len(ia):
        return none, none
    (pa, ta), (pb, tb) = before(left, a_free, ia), before(right, b_free, ib)
    hashes, number = np.unique(np.concatenate((ha, hb)), return_inverse=True)
    words, word = np.unique(np.concatenate((pa, pb)), return_inverse=True)
    width = len(words) + 1
    key = number * width + np.where(np.concatenate((ta, tb)), word + 1, 0)
    mine, theirs, own = key[: len(ia)], key[len(ia) :], number[: len(ia)]
    order = np.argsort(theirs, kind="stable")
    theirs = theirs[order]
    lo, hi = np.searchsorted(theirs, own * width), np.searchsorted(theirs, (own + 1) * width)
    # Places with the same word before; a start without one continues nothing.
    skip_lo = np.where(ta, np.searchsorted(theirs, mine, "left"), lo)
    skip_hi = np.where(ta, np.searchsorted(theirs, mine, "right"), lo)

    def spread(first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        size = last - first
        at = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size) + np.repeat(first, size)
        return np.repeat(ia, size), ib[order[at]]

    parts = [spread(lo, skip_lo), spread(skip_hi, hi)]
    return np.concatenate([i for i, _ in parts]), np.concatenate([j for _, j in parts])


PAIR = "item_id long, item_words int, n_tiles int, longest_tile int, covered int, coverage double, tiles array<struct<doc_start:int,item_start:int,words:int>>"


def judged(item: np.ndarray, doc: np.ndarray, min_tile: int) -> tuple:
    tiles = tile(doc, item, min_tile)
    covered = int(tiles[:, 2].sum())
    return len(item), len(tiles), int(tiles[:, 2].max(initial=0)), covered, covered / max(1, len(item)), [{"doc_start": int(i), "item_start": int(j), "words": int(n)} for i, j, n in tiles]


def near_seeds(doc: np.ndarray, at: np.ndarray, reach: int) -> np.ndarray:
    """The document's words around its seeds; runs that lie apart are parted by a word that matches nothing.

    A tile holds a seed in all its places, so words farther than an item's length from every seed are in no tile.
    """
    keep = np.zeros(len(doc), bool)
    for i in at:
        keep[max(0, i - reach) : i + reach] = True
    return keep


def known_items(benchmark: DataFrame) -> tuple[DataFrame, int]:
    """item_id and text of the items that have both, and the bytes of their texts."""
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text").where("item_id IS NOT NULL AND text IS NOT NULL")
    return items, items.agg(F.sum(F.octet_length("text"))).first()[0] or 0


def contaminated(docs: DataFrame, benchmark: DataFrame, min_tile: int = 5, threshold: float = 0.5, max_item_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Pairs of documents and benchmark items whose words lie under tiles to `threshold` or more.

    docs needs doc_id and text, benchmark item_id and text. Null ids and null or empty texts have no pairs; an item
    shorter than min_tile words is looked for as a whole. Repeated rows give repeated pairs; of tiles that tie in length
    the one that starts first in the document, then in the item, is marked first. Texts are tiled whole, however long.
    An empty table on either side gives no pairs. Other columns are ignored, whatever their names.
    """
    items, size = known_items(benchmark)
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").where("doc_id IS NOT NULL AND text IS NOT NULL")
    if size <= max_item_bytes:
        return tiled_in_scan(source, items, min_tile, threshold)
    return tiled_by_join(source, items, min_tile, threshold)


def rows_out(ids: list, kind: pa.DataType, rows: list[tuple], threshold: float) -> Iterator[pa.RecordBatch]:
    """Rows (place of the document in ids, item, and what `judged` found) that reach the threshold."""
    rows = [(ids[r[0]], *r[1:]) for r in rows if r[6] >= threshold]
    if rows:
        names = ["doc_id", "item_id", "item_words", "n_tiles", "longest_tile", "covered", "coverage", "tiles"]
        struct = pa.struct([("doc_start", pa.int32()), ("item_start", pa.int32()), ("words", pa.int32())])
        kinds = [kind, pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int32(), pa.float64(), pa.list_(struct)]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)


class Seeds:
    """The seeds of a small benchmark, by their number of words."""

    def __init__(self, items: list[tuple[int, np.ndarray]], min_tile: int):
        self.items = items
        self.by_width: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for width in {min(min_tile, len(w)) for _, w in items}:
            mine = [(k, window_hashes(w, width)) for k, (_, w) in enumerate(items) if min(min_tile, len(w)) == width]
            seeds = np.concatenate([h for _, h in mine])
            owner = np.concatenate([np.full(len(h), k) for k, h in mine])
            order = np.argsort(seeds, kind="stable")
            self.by_width[width] = seeds[order], owner[order]

    def tiled(self, column: pa.Array) -> Iterator[tuple]:
        """(row, item_id, and what `judged` finds) of every text and item that share a seed."""
        for first, data, at in text_slices(column):
            hashes, text_no = words_of(data, at)
            for width, (seeds, owner) in self.by_width.items():
                windows = window_hashes(hashes, width)
                if not len(windows):
                    continue
                windows_in = text_no[: len(windows)] == text_no[width - 1 :]
                lo = np.searchsorted(seeds, windows)
                hit = np.flatnonzero((seeds[np.minimum(lo, len(seeds) - 1)] == windows) & windows_in)
                for d in np.unique(text_no[hit]):
                    begin, end = np.searchsorted(text_no, [d, d + 1])
                    own = hit[(hit >= begin) & (hit < end)]
                    doc = hashes[begin:end]
                    shared = np.unique(windows[own])
                    for k in np.unique(owner[np.isin(seeds, shared)]):
                        item_id, item = self.items[k]
                        mine = own[np.isin(windows[own], seeds[owner == k])] - begin
                        kept = near_seeds(doc, mine, len(item) + width)
                        # A stretch between two kept ones becomes one word that is in no item.
                        gap = ~kept & np.concatenate(([True], kept[:-1]))
                        place = np.flatnonzero(kept | gap)
                        short = np.where(kept[place], doc[place], np.uint64(0))
                        n, t, longest, covered, share, tiles = judged(item, short, width)
                        for x in tiles:
                            x["doc_start"] = int(place[x["doc_start"]])
                        yield first + int(d), item_id, n, t, longest, covered, share, tiles


def sent_items(items: DataFrame) -> Broadcast:
    """The words of a small benchmark (its size is checked by the caller), for every task."""
    return items.sparkSession.sparkContext.broadcast([(i, w) for i, t in items.collect() if len(w := text_words(t))])


def tiled_in_scan(docs: DataFrame, items: DataFrame, min_tile: int, threshold: float) -> DataFrame:
    """The benchmark is small: its seeds go to every task, and only documents that share one are tiled."""
    held = sent_items(items)

    def per_batch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seeds = Seeds(held.value, min_tile)
        for batch in batches:
            yield from rows_out(batch.column(0).to_pylist(), pa.int64(), list(seeds.tiled(batch.column(1))), threshold)

    return docs.mapInArrow(per_batch, f"doc_id long, {PAIR}")


def tiled_by_join(docs: DataFrame, items: DataFrame, min_tile: int, threshold: float) -> DataFrame:
    """A benchmark of any size: seeds of both sides meet in a shuffle, then texts of the pairs that share one."""
    counted = items.mapInArrow(lambda batches: (pa.RecordBatch.from_arrays([pa.array([min(min_tile, len(text_words(t.as_py()))) for t in b.column(1)], pa.int32())], names=["width"]) for b in batches), "width int")
    # A handful of widths: min_tile, and the lengths of items that have fewer words.
    used = sorted(r["width"] for r in counted.where("width > 0").distinct().collect())

    def seeds(df: DataFrame, name: str) -> DataFrame:
        def per_batch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for first, data, at in text_slices(batch.column(1)):
                    hashes, text_no = words_of(data, at)
                    for d in range(len(at) - 1):
                        begin, end = np.searchsorted(text_no, [d, d + 1])
                        words = hashes[begin:end]
                        widths = used if name == "doc_id" else [min(min_tile, max(1, len(words)))]
                        found = np.unique(np.concatenate([np.zeros(0, np.uint64), *(window_hashes(words, w) for w in widths)]))
                        yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(np.full(len(found), first + d))), pa.array(found.view(np.int64))], names=[name, "seed"])

        return df.mapInArrow(per_batch, f"{name} {df.schema[name].dataType.simpleString()}, seed long")

    pairs = seeds(docs, "doc_id").join(seeds(items, "item_id"), "seed").select("doc_id", "item_id").distinct()
    both = pairs.join(items.withColumnRenamed("text", "item_text"), "item_id").join(docs, "doc_id")

    def tiled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for k, (i, item_text, text) in enumerate(zip(*(batch.column(c).to_pylist() for c in ("item_id", "item_text", "text")), strict=True)):
                item = text_words(item_text)
                if len(item):
                    rows.append((k, i, *judged(item, text_words(text), min(min_tile, len(item)))))
            yield from rows_out(batch.column(0).to_pylist(), batch.column(0).type, rows, threshold)

    return both.select("doc_id", "item_id", "item_text", "text").mapInArrow(tiled, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, {PAIR}")


def decontaminate(docs: DataFrame, benchmark: DataFrame, min_tile: int = 5, threshold: float = 0.5, max_item_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """The rows of docs that hold no benchmark item, columns as they were.

    Each row is judged by its own text, whatever its id: rows with a null id or an id that others share are no exception.
    Rows with null or empty texts stay; with an empty benchmark all do.
    """
    items, size = known_items(benchmark)
    if size <= max_item_bytes:
        held, names = sent_items(items), docs.columns

        def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            seeds = Seeds(held.value, min_tile)
            for batch in batches:
                bad = {row for row, *found in seeds.tiled(batch.column(batch.num_columns - 1)) if found[5] >= threshold}
                mask = np.ones(batch.num_rows, bool)
                mask[list(bad)] = False
                yield pa.RecordBatch.from_arrays([c.filter(pa.array(mask)) for c in batch.columns[:-1]], names=names)

        return docs.select("*", F.col("text").alias("text to read")).mapInArrow(clean, docs.schema)
    # Equal texts are judged once: their hash stands for the document.
    texts = docs.where("text IS NOT NULL").select(F.md5("text").alias("doc_id"), "text").dropDuplicates(["doc_id"])
    bad = tiled_by_join(texts, items, min_tile, threshold).select(F.col("doc_id").alias("bad text")).distinct()
    return docs.join(bad, F.md5(docs["text"]) == bad["bad text"], "left_anti")
