"""Importance resampling towards a target distribution, over hashed features found by prefix CRCs.

A text is normalised to its words with one separator between them and read once: the CRC of every prefix that ends or
begins at a word is kept. The CRC of any run of words then follows from two prefixes, because over GF(2)
crc(AB) = shift(crc(A), length of B) xor crc(B), whatever the run's width. Features are counted by the remainder of
their CRC, documents are weighted by the log ratio of target and corpus, and a seeded Gumbel draw takes a share of them.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import LOWER, text_slices, written

# Words are ASCII letters and digits and every byte of a multi-byte character.
WORD = np.zeros(256, bool)
WORD[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True
# Bytes of a row of the grid in which running CRCs are made.
ROW = 2048


def _byte_table() -> np.ndarray:
    """What one byte does to an empty register (the reflected polynomial of CRC-32)."""
    c = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        c = np.where(c & np.uint32(1), (c >> np.uint32(1)) ^ np.uint32(0xEDB88320), c >> np.uint32(1))
    return c


def applied(operator: np.ndarray, c: np.ndarray) -> np.ndarray:
    """A linear operator on registers, given by what it makes of each value of each of the four bytes."""
    return operator[0][c & 255] ^ operator[1][(c >> 8) & 255] ^ operator[2][(c >> 16) & 255] ^ operator[3][c >> 24]


def _shifts() -> list[np.ndarray]:
    """Operators that pass 1, 2, 4, ... 2^39 zero bytes."""
    values = np.arange(256, dtype=np.uint32)
    parts = [values << np.uint32(8 * k) for k in range(4)]
    one = np.stack([TABLE[c & 255] ^ (c >> np.uint32(8)) for c in parts])
    out = [one]
    while len(out) < 40:
        out.append(np.stack([applied(out[-1], part) for part in out[-1]]))
    return out


TABLE = _byte_table()
SHIFTS = _shifts()


def shifted(crcs: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Registers after `sizes` zero bytes, by the binary digits of the sizes."""
    out = crcs.copy()
    for bit in range(int(sizes.max(initial=0)).bit_length()):
        on = (sizes >> bit) & 1 == 1
        out[on] = applied(SHIFTS[bit], out[on])
    return out


def running_crcs(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """CRC-32 of data[:k] for every k of `at`. One pass over the bytes, all rows of a grid side by side; then the rows are chained."""
    rows = len(data) // ROW + 1
    grid = np.zeros(rows * ROW, np.uint8)
    grid[: len(data)] = data
    grid = np.ascontiguousarray(grid.reshape(rows, ROW).T)
    local = np.zeros((ROW + 1, rows), np.uint32)
    for k in range(min(ROW, len(data))):
        c = local[k]
        local[k + 1] = TABLE[(c ^ grid[k]) & 255] ^ (c >> np.uint32(8))
    head = np.empty(rows, np.uint32)
    passed = [part.tolist() for part in SHIFTS[ROW.bit_length() - 1]]
    register = 0xFFFFFFFF
    for k, end in enumerate(local[ROW].tolist()):
        head[k] = register
        register = passed[0][register & 255] ^ passed[1][(register >> 8) & 255] ^ passed[2][(register >> 16) & 255] ^ passed[3][register >> 24] ^ end
    row, column = at // ROW, at % ROW
    return shifted(head[row], column) ^ local[column, row] ^ np.uint32(0xFFFFFFFF)


def features(data: np.ndarray, at: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """CRC and text number of every run of 1 to `width` words of the texts data[at[k]:at[k+1]], and each text's number of words."""
    inside = WORD[data]
    after = np.zeros(len(data), bool)
    after[1:] = inside[:-1]
    edge = at[(at > 0) & (at < len(data))]
    begins = inside & ~after
    begins[edge] = inside[edge]
    ends = np.zeros(len(data) + 1, bool)
    ends[1:-1] = inside[:-1] & ~inside[1:]
    ends[-1] = inside[-1] if len(inside) else False
    ends[edge] |= inside[edge - 1]
    # Words, and one separator after each where the text goes on.
    keep = inside | after
    place = np.concatenate(([0], np.cumsum(keep)))
    text = np.where(inside, LOWER[data], np.uint8(32))[keep]
    first = np.flatnonzero(begins)
    start, end = place[first], place[np.flatnonzero(ends)]
    owner = np.searchsorted(at, first, "right") - 1
    n_words = np.bincount(owner, minlength=len(at) - 1)
    prefix = running_crcs(text, np.concatenate((start, end)))
    before, behind = prefix[: len(start)], prefix[len(start) :]
    crcs, owners = [np.zeros(0, np.uint32)], [np.zeros(0, np.int64)]
    for n in range(1, width + 1):
        m = len(start) - n + 1
        if m <= 0:
            break
        whole = owner[:m] == owner[n - 1 :]
        crcs.append((behind[n - 1 :] ^ shifted(before[:m], end[n - 1 :] - start[:m]))[whole])
        owners.append(owner[:m][whole])
    return np.concatenate(crcs), np.concatenate(owners), n_words


def bucket_counts(df: DataFrame, width: int, buckets: int, text_col: str = "text") -> np.ndarray:
    """Features of all texts by bucket: added up within each partition, then by one shuffle of at most `buckets` rows a partition."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for _, data, at in text_slices(batch.column(0)):
                crcs, _, _ = features(data, at, width)
                total += np.bincount(crcs % np.uint32(buckets), minlength=buckets)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], names=["bucket", "n"])

    found = np.zeros(buckets, np.int64)
    # One row a bucket, whatever the size of the corpus.
    for row in df.select(text_col).mapInArrow(counted, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        found[row["bucket"]] = row["n"]
    return found


def gains_of(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 ln) of the smoothed ratio of target and corpus, by bucket."""
    all_source, all_target, k = float(source.sum()), float(target.sum()), len(source)
    ratio = lambda s, t: (t + 1.0) * (all_source + k) / ((s + 1.0) * (all_target + k))
    return np.array([math.floor(1000 * math.log(ratio(float(s), float(t)))) for s, t in zip(source, target, strict=True)], np.int64)


def weighted(docs: DataFrame, gains: np.ndarray, width: int, id_col: str, text_col: str) -> DataFrame:
    """id, n_words, n_features and the floored mean gain of every row."""
    buckets = len(gains)

    def per_batch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, data, at in text_slices(batch.column(1)):
                crcs, owner, n_words = features(data, at, width)
                n = np.bincount(owner, minlength=len(n_words))
                total = np.zeros(len(n_words), np.int64)
                np.add.at(total, owner, gains[crcs % np.uint32(buckets)])
                mean = np.where(n > 0, total // np.maximum(n, 1), 0)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, len(n_words)), pa.array(n_words), pa.array(n), pa.array(mean)], names=[id_col, "n_words", "n_features", "weight"])

    return docs.select(id_col, text_col).mapInArrow(per_batch, f"{id_col} {docs.schema[id_col].dataType.simpleString()}, n_words long, n_features long, weight long")


def ranked(rows: DataFrame, id_col: str) -> DataFrame:
    """rows with their place (from 1) by falling score, then rising id; ids and scores that repeat take places next to each other.

    Rows are dealt out by range and sorted there; a row's place is that within its range plus the sizes of the ranges before.
    """
    order = [F.col("score").desc(), F.col(id_col).asc_nulls_last(), F.col("tie")]
    dealt = rows.withColumn("tie", F.monotonically_increasing_id()).repartitionByRange(*order).sortWithinPartitions(*order)
    # The row number that this function gives is the partition in the upper bits and the place in it in the lower 33.
    placed = written(dealt.drop("tie").withColumn("at", F.monotonically_increasing_id()), "ranges")
    ranges = placed.groupBy(F.shiftright("at", 33).alias("range")).agg(F.count("*").alias("n")).orderBy("range").collect()
    offset, before = [], 0
    for r in ranges:  # one row a partition
        offset.append((r["range"], before))
        before += r["n"]
    offsets = rows.sparkSession.createDataFrame(offset, "range long, before long")
    at = placed.withColumn("range", F.shiftright("at", 33)).join(F.broadcast(offsets), "range")
    return at.withColumn("rank", F.col("before") + F.col("at").bitwiseAND((1 << 33) - 1) + 1).drop("range", "before", "at")


def resample(docs: DataFrame, target: DataFrame, percent: int = 25, min_words: int = 20, seed: int = 7, width: int = 2, buckets: int = 10000, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, n_features, weight, score and rank of every row of docs; rank is null for rows that are not drawn.

    Of the rows with min_words words or more, `percent` hundredths (rounded down) are drawn without replacement: those
    with the highest score, which is the weight plus Gumbel noise that depends on seed and id alone. Features are the
    runs of 1 to `width` words, repeats counted. Null and empty texts have none (weight 0) and are never drawn; texts are
    read whole, however long, those beyond 2 MB one at a time. Rows that repeat give a row each, and draw the same noise;
    a null id counts as an empty one and comes last among ties. With an empty target all features are equally likely
    there; an empty docs gives no rows. Columns besides id and text are ignored, whatever their names.
    """
    gains = gains_of(bucket_counts(docs, width, buckets, text_col), bucket_counts(target.select(F.col(text_col)), width, buckets, text_col))
    noise = f"(CAST(conv(substr(sha2(concat('{int(seed)}:', coalesce(CAST(`{id_col}` AS string), '')), 256), 1, 8), 16, 10) AS double) + 0.5) / 4294967296"
    scores = weighted(docs, gains, width, id_col, text_col).withColumn("score", F.expr(f"weight + CAST(floor(-1000 * ln(-ln({noise}))) AS long)"))
    held = written(scores, "scores")
    able = F.col("n_words") >= min_words
    n = percent * held.where(able).count() // 100
    places = ranked(held.where(able), id_col)
    drawn = places.withColumn("rank", F.when(F.col("rank") <= n, F.col("rank")))
    every = drawn.unionByName(held.where(~able).withColumn("rank", F.lit(None).cast("long")))
    return every.select(id_col, "n_features", "weight", "score", "rank")
