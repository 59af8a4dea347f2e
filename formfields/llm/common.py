"""What the operators of this subpackage share: tables, the shared folder, hashed words of Arrow text columns."""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..scratch import clear_written, dropped, scratch, shared_dir, written

__all__ = ["clear_written", "dropped", "scratch", "shared_dir", "written"]
# Bytes of text that one pass of the numpy code holds; a longer single text is taken whole.
SLICE_BYTES = 1 << 21
# Partitions of a shuffle whose groups (blocks, fragments) grow with the corpus; a partition of more takes them one by one.
MOST_PARTITIONS = 20_000
M1, M2, STEP = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB), np.uint64(0x9E3779B97F4A7C15)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fitted_in_task(sample: DataFrame, fit: Callable[[pd.DataFrame], object]) -> object:
    """What `fit` makes of a sample with a stated bound, in one task rather than on the driver; None of an empty one."""
    made = sample.groupBy(F.lit(0).alias("all")).applyInPandas(lambda rows: pd.DataFrame({"model": [pickle.dumps(fit(rows))]}), "model binary").first()
    return pickle.loads(made["model"]) if made else None  # noqa: S301


def held_texts(rows: pd.DataFrame, most_bytes: dict[int, int] | int, by: str) -> pd.DataFrame:
    """Rows (draw, lid, text, ...) in the order of their draw while they fit into the bytes, of each class of `by` apart where a dict gives them.

    A text that doesn't fit is passed over and smaller ones after it still come in, so long documents are drawn less.
    """
    ordered = rows.sort_values(["draw", "lid"], kind="stable")
    used: dict[int, int] = {}
    keep = []
    for text, kind in zip(ordered["text"], ordered[by], strict=True):
        bound, slot = (most_bytes[kind], kind) if isinstance(most_bytes, dict) else (most_bytes, 0)
        size = len(text.encode("utf-8", "surrogatepass"))
        keep.append(used.get(slot, 0) + size <= bound)
        used[slot] = used.get(slot, 0) + size * keep[-1]
    return ordered[keep]


def mix(x: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64, over a uint64 array."""
    x = (x ^ (x >> np.uint64(30))) * M1
    x = (x ^ (x >> np.uint64(27))) * M2
    return x ^ (x >> np.uint64(31))


BYTE_CODES = mix((np.arange(256, dtype=np.uint64) + np.uint64(1)) * STEP)
_POWERS = np.ones(1, np.uint64)
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def powers(n: int) -> np.ndarray:
    global _POWERS
    if len(_POWERS) < n:
        steps = np.full(max(n, 64), STEP | np.uint64(1))
        steps[0] = 1
        _POWERS = np.multiply.accumulate(steps)
    return _POWERS[:n]


def text_slices(column: pa.Array, slice_bytes: int = SLICE_BYTES) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, bytes, offsets) of runs of whole texts of a string column; null is an empty text."""
    column = pc.fill_null(column, "").cast(pa.large_binary())
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    n = len(column)
    if not n:
        return
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset : column.offset + n + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    lo = 0
    while lo < n:
        hi = min(n, max(lo + 1, int(np.searchsorted(at, at[lo] + slice_bytes, "right")) - 1))
        yield lo, raw[at[lo] : at[hi]], at[lo : hi + 1] - at[lo]
        lo = hi


def word_spans(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and text numbers of the runs of bytes that are not white space."""
    inside = ~SPACE[data]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    last = inside.copy()
    last[:-1] &= ~inside[1:]
    edge = at[(at > 0) & (at < len(data))]
    first[edge] = inside[edge]
    last[edge - 1] = inside[edge - 1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    return starts, ends, np.searchsorted(at, starts, "right") - 1


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each span of bytes: a polynomial of byte codes, then mixed with the length."""
    sizes = ends - starts
    if not len(sizes):
        return np.zeros(0, np.uint64)
    begin = np.concatenate(([0], np.cumsum(sizes)[:-1]))
    position = np.arange(int(sizes.sum())) - np.repeat(begin, sizes)
    # In place: these arrays have eight bytes for each byte of text.
    terms = BYTE_CODES[data[position + np.repeat(starts, sizes)]]
    terms *= powers(int(sizes.max()))[position]
    return mix(np.add.reduceat(terms, begin) ^ (sizes.astype(np.uint64) * STEP))


def hashed_words(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words `[^\\x20\\x09-\\x0D]+` after A-Z are lower-cased, and the text number of each."""
    starts, ends, owner = word_spans(data, at)
    return span_hashes(LOWER[data], starts, ends), owner


def window_hashes(words: np.ndarray, width: int) -> np.ndarray:
    """Hashes of all runs of `width` items; the caller drops those that cross texts."""
    n = len(words) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = words[:n].copy()
    for k in range(1, width):
        out = mix(out * (STEP | np.uint64(1)) + words[k : k + n])
    return out


def hash_word(word: str) -> int:
    data = np.frombuffer(word.encode(), np.uint8)
    return int(span_hashes(LOWER[data], np.array([0]), np.array([len(data)]))[0])
