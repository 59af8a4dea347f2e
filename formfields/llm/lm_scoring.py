"""Language-model scores by deleted interpolation of unigram and bigram estimates.

Documents lie in blocks (pieces of file splits). Each block sends its distinct n-grams with their counts, once per
fragment of hashes; a fragment sums them over the corpus and returns each block's counts in the order in which they
came, so a hot n-gram is one entry per block. Mixture weights, one set for each bucket of context frequency, are
learned by expectation-maximisation on a part of the training documents whose own counts are taken out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import MOST_PARTITIONS, hashed_words, mix, text_slices, window_hashes, written

END, BEGIN = np.uint64(0x1F83D9ABFB41BD6B), np.uint64(0x5BE0CD19137E2179)
# Bytes of text in a block, and distinct n-grams in a fragment, on average.
BLOCK_BYTES, FRAGMENT_ROWS = 8 << 20, 2_000_000
# Tokens of a block that wait to be folded into its distinct n-grams.
FOLD_TOKENS = 1 << 19
BUCKETS = 24
# Steps of a factor of two in the histogram that expectation-maximisation reads.
STEPS = 4
PARTS = ("train", "tune", "held_out")


def token_hashes(column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """(first row, token hashes with an end after each text, bigram hashes, text number)."""
    for first, data, at in text_slices(column):
        words, owner = hashed_words(data, at)
        n = len(at) - 1
        sizes = np.bincount(owner, minlength=n) if len(owner) else np.zeros(n, np.int64)
        ends = np.cumsum(sizes)
        tokens = np.insert(words, ends, END)
        number = np.repeat(np.arange(n), sizes + 1)
        before = np.empty_like(tokens)
        before[1:] = tokens[:-1]
        before[np.concatenate(([0], np.cumsum(sizes + 1)[:-1]))] = BEGIN
        pairs = mix(before * np.uint64(0x9E3779B97F4A7C15) + mix(tokens))
        yield first, tokens, pairs, number


class Keys:
    """The distinct n-grams of a block in fragment order, unigrams apart from bigrams."""

    def __init__(self, hashes: np.ndarray, fragments: int):
        self.unique, self.inverse = np.unique(hashes, return_inverse=True)
        place = (self.unique >> np.uint64(40)) % np.uint64(fragments)
        self.order = np.argsort(place, kind="stable")
        # The fragments that are there, and where each begins and ends: a block's work doesn't grow with all fragments.
        self.fragments, begin = np.unique(place[self.order], return_index=True)
        self.bounds = np.append(begin, len(self.unique))

    def per_token(self, in_order: np.ndarray) -> np.ndarray:
        values = np.empty(len(self.unique), np.int64)
        values[self.order] = in_order
        return values[self.inverse]


def blocks(docs: DataFrame, id_col: str, text_col: str, pieces: int, heldout: int, tune: int, modulus: int) -> DataFrame:
    """rid, text, part and block. A block holds documents of one file split, and tuning documents apart."""
    source = docs.select(
        F.col(id_col).cast("long").alias("rid"), F.coalesce(F.col(text_col), F.lit("")).alias("text"),
        F.xxhash64(F.input_file_name(), F.input_file_block_start()).alias("split"),
    )
    rest = F.crc32(F.coalesce(F.col("rid").cast("string"), F.lit("")).cast("binary")) % modulus
    part = F.when(rest == heldout, 2).when(rest == tune, 1).otherwise(0)
    piece = F.pmod(F.xxhash64("rid"), F.lit(pieces))
    return source.withColumn("part", part.cast("int")).select("rid", "text", "part", F.xxhash64("split", piece, F.col("part") == 1).alias("block"))


def sent_counts(docs: DataFrame, uni: int, bi: int) -> DataFrame:
    """block, tuning, fragment, keys and counts: what each block sends to each fragment (unigrams first)."""

    def folded(parts: list[tuple[np.ndarray, np.ndarray]]) -> list[tuple[np.ndarray, np.ndarray]]:
        """One part: the distinct hashes of all with their summed counts."""
        keys, which = np.unique(np.concatenate([k for k, _ in parts]), return_inverse=True)
        return [(keys, np.bincount(which, weights=np.concatenate([n for _, n in parts]), minlength=len(keys)))]

    def per_partition(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Of each block its distinct n-grams so far; tokens are folded into them as they come, so a task holds no text.
        held: dict[tuple[int, bool], tuple[list, list]] = {}
        for batch in batches:
            block, part = np.asarray(batch.column(2)), np.asarray(batch.column(1))
            for first, tokens, pairs, number in token_hashes(batch.column(0)):
                b, p = block[first + number], part[first + number]
                for key in np.unique(b):
                    mine = b == key
                    own = held.setdefault((int(key), bool((p[mine] == 1).any())), ([], []))
                    for parts, hashes in zip(own, (tokens, pairs), strict=True):
                        parts.append((hashes[mine], (p[mine] != 2).astype(np.float64)))
                        if len(parts) > 1 and sum(len(k) for k, _ in parts[1:]) > FOLD_TOKENS:
                            parts[:] = folded(parts)
        for (key, tuning), found in held.items():
            for parts, fragments, base in ((found[0], uni, 0), (found[1], bi, uni)):
                unique, n = folded(parts)[0]
                keys = Keys(unique, fragments)
                counts, ordered = n.astype(np.uint32)[keys.order], keys.unique[keys.order]
                rows = keys.fragments.tolist()
                cuts = [slice(a, b) for a, b in zip(keys.bounds[:-1], keys.bounds[1:], strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([key] * len(rows), pa.int64()), pa.array([tuning] * len(rows)), pa.array([base + k for k in rows], pa.int32()),
                     pa.array([ordered[c].tobytes() for c in cuts], pa.binary()), pa.array([counts[c].tobytes() for c in cuts], pa.binary())],
                    names=["block", "tuning", "fragment", "keys", "counts"],
                )

    return docs.select("text", "part", "block").mapInArrow(per_partition, "block long, tuning boolean, fragment int, keys binary, counts binary")


def summed(sent: DataFrame, fragments: int) -> DataFrame:
    """For each row sent: total counts, and for tuning blocks the counts without any tuning document.

    One more row for each fragment (block null) has its training types and tokens, all and without tuning.
    """

    def add(group: pd.DataFrame) -> pd.DataFrame:
        keys = np.concatenate([np.frombuffer(x, np.uint64) for x in group["keys"]])
        counts = np.concatenate([np.frombuffer(x, np.uint32) for x in group["counts"]]).astype(np.int64)
        sizes = group["keys"].map(len).to_numpy() // 8
        tuning = np.repeat(group["tuning"].to_numpy(bool), sizes)
        order = np.argsort(keys)
        ordered = keys[order]
        begin = np.flatnonzero(np.concatenate(([True], ordered[1:] != ordered[:-1])))
        lengths = np.diff(np.append(begin, len(keys)))
        total = np.add.reduceat(counts[order], begin)
        out = np.empty(len(keys), np.uint32)
        out[order] = np.repeat(total, lengths)
        rest = None
        spare = total - np.add.reduceat(np.where(tuning, counts, 0)[order], begin)
        rest = np.empty(len(keys), np.uint32)
        rest[order] = np.repeat(spare, lengths)
        ends = np.cumsum(sizes)
        fragment = int(group["fragment"].iloc[0])
        rows = pd.DataFrame({
            "block": group["block"].astype("Int64"), "fragment": fragment, "tuning": group["tuning"],
            "total": [out[e - s : e].tobytes() for s, e in zip(sizes, ends, strict=True)],
            "rest": [rest[e - s : e].tobytes() if t else None for s, e, t in zip(sizes, ends, group["tuning"], strict=True)],
            "types": 0, "tokens": 0, "rest_types": 0, "rest_tokens": 0,
        })
        last = pd.DataFrame({"block": pd.array([None], "Int64"), "fragment": [fragment], "tuning": [False], "total": [None], "rest": [None], "types": [int((total > 0).sum())], "tokens": [int(total.sum())], "rest_types": [int((spare > 0).sum())], "rest_tokens": [int(spare.sum())]})
        return pd.concat([rows, last], ignore_index=True)

    return sent.repartition(min(fragments, MOST_PARTITIONS), "fragment").groupBy("fragment").applyInPandas(add, "block long, fragment int, tuning boolean, total binary, rest binary, types long, tokens long, rest_types long, rest_tokens long")


def bucket_of(context: np.ndarray) -> np.ndarray:
    """0 for a context never seen, else one more than the base-2 logarithm of its count."""
    return np.where(context > 0, np.minimum(BUCKETS - 1, np.floor(np.log2(np.maximum(context, 1))).astype(np.int64) + 1), 0)


def counted(texts: pd.Series, returned: pd.DataFrame, column: str, uni: int, bi: int, docs_of: str | None = None) -> tuple[np.ndarray, ...]:
    """Text number, count of each token, of its context and of its bigram, in a block.

    The context before a text's first word is counted as often as texts end.
    """
    found = list(token_hashes(pa.array(texts, pa.string())))
    number = np.concatenate([first + n for first, _, _, n in found])
    tokens, pairs = np.concatenate([f[1] for f in found]), np.concatenate([f[2] for f in found])
    held = returned.sort_values("fragment")
    is_uni = held["fragment"].to_numpy() < uni
    joined = lambda mask: np.frombuffer(b"".join(held[column][mask]), np.uint32).astype(np.int64)
    own = Keys(tokens, uni).per_token(joined(is_uni))
    pair = Keys(pairs, bi).per_token(joined(~is_uni))
    begins = np.concatenate(([True], number[1:] != number[:-1]))
    context = np.empty_like(own)
    context[1:] = own[:-1]
    context[begins] = own[np.flatnonzero(tokens == END)[0]]
    return number, own, context, pair


HISTOGRAM = "bucket int, q2 int, q1 int, n long"


def tuning_histogram(docs: DataFrame, returned: DataFrame, uni: int, bi: int, tokens: int) -> DataFrame:
    """How many tuning tokens have which context bucket and which (rounded) estimates; its size doesn't grow with the corpus."""

    def cells(_key: tuple, texts: pd.DataFrame, back: pd.DataFrame) -> pd.DataFrame:
        if not len(texts) or not len(back):
            return pd.DataFrame({"bucket": [], "q2": [], "q1": [], "n": []})
        _, own, context, pair = counted(texts["text"], back, "rest", uni, bi)
        rounded = lambda p: np.where(p > 0, np.rint(-np.log2(np.maximum(p, 1e-300)) * STEPS), -1).astype(np.int64)
        q2 = rounded(pair / np.maximum(context, 1))
        q1 = rounded(own / max(tokens, 1))
        cell, n = np.unique((bucket_of(context) * 1024 + q2 + 1) * 1024 + q1 + 1, return_counts=True)
        return pd.DataFrame({"bucket": cell >> 20, "q2": (cell >> 10 & 1023) - 1, "q1": (cell & 1023) - 1, "n": n})

    both = docs.where("part = 1").select("block", "text").groupBy("block").cogroup(returned.where("tuning").select("block", "fragment", "rest").groupBy("block"))
    return both.applyInPandas(cells, HISTOGRAM).groupBy("bucket", "q2", "q1").agg(F.sum("n").alias("n"))


def learned_weights(histogram: pd.DataFrame, types: int, rounds: int = 60) -> np.ndarray:
    """Weights of bigram, unigram and uniform estimates for each bucket, by expectation-maximisation."""
    weights = np.tile([0.0, 0.9, 0.1], (BUCKETS, 1))
    estimate = lambda q: np.where(q < 0, 0.0, 2.0 ** (-q / STEPS))
    for k, own in histogram.groupby("bucket"):
        parts = np.stack([estimate(own["q2"].to_numpy(float)), estimate(own["q1"].to_numpy(float)), np.full(len(own), 1 / (types + 1))], 1)
        n = own["n"].to_numpy(float)
        w = np.array([0.4, 0.4, 0.2]) if k else np.array([0.0, 0.6, 0.4])
        for _ in range(rounds):
            share = parts * w
            share *= (n / share.sum(1))[:, None]
            w = share.sum(0) / n.sum()
        # Every token keeps some probability, whatever the tuning part held.
        w = (w + [0, 0, 1e-6]) / (1 + 1e-6)
        weights[int(k)] = w
    seen = sorted(int(k) for k in histogram["bucket"].unique() if k > 0)
    for k in range(1, BUCKETS):
        if seen and k not in seen:
            weights[k] = weights[min(seen, key=lambda s: abs(s - k))]
    return weights


def score_texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", modulus: int = 7, heldout: int = 2, tune: int = 6, scan: bool = False) -> DataFrame:
    """id, held_out, n_tokens, n_known, train_tokens, base_score and score (base-10 logarithms) of every row.

    Counts come from all rows but those whose crc32(id as text) mod `modulus` is `heldout`. Weights are learned on
    the rows where it is `tune`, against counts without them; the final counts have them. Null texts are empty (one
    token, the end) and taken whole, however long; a null id counts as the text ''. Rows that repeat give a row each; an
    empty table gives none. Other columns are ignored, whatever their names. N-grams are known by 64-bit hashes: of
    n distinct ones about n^2 / 2^65 pairs are taken for one. scan: docs is a plain scan of
    files; else it is written first, since blocks are pieces of file splits.
    """
    source = docs.select(id_col, text_col) if scan else written(docs.select(id_col, text_col), "lm-texts")
    size = source.agg(F.sum(F.octet_length(text_col))).first()[0] or 0
    splits = max(1, source.rdd.getNumPartitions())
    pieces = int(max(1, round(size / splits / BLOCK_BYTES)))
    bi = int(max(1, -(-size // (6 * FRAGMENT_ROWS))))
    uni = max(1, bi // 4)
    placed = blocks(source, id_col, text_col, pieces, heldout, tune, modulus)
    returned = written(summed(sent_counts(placed, uni, bi), uni + bi), "lm-counts")
    stats = returned.where(f"block IS NULL AND fragment < {uni}").agg(F.sum("types"), F.sum("tokens"), F.sum("rest_types"), F.sum("rest_tokens")).first()
    types, tokens, rest_types, rest_tokens = (int(x or 0) for x in stats)
    back = returned.where("block IS NOT NULL")
    weights = learned_weights(tuning_histogram(placed, back, uni, bi, rest_tokens).toPandas(), rest_types)

    def score(_key: tuple, texts: pd.DataFrame, found: pd.DataFrame) -> pd.DataFrame:
        if not len(texts):
            return pd.DataFrame({"rid": [], "held_out": [], "n_tokens": [], "n_known": [], "base_score": [], "score": []})
        number, own, context, pair = counted(texts["text"], found, "total", uni, bi)
        w = weights[bucket_of(context)]
        p = w[:, 0] * pair / np.maximum(context, 1) + w[:, 1] * own / max(tokens, 1) + w[:, 2] / (types + 1)
        add = lambda x: np.bincount(number, weights=x, minlength=len(texts))
        return pd.DataFrame({
            "rid": texts["rid"], "held_out": texts["part"] == 2, "n_tokens": np.bincount(number, minlength=len(texts)), "n_known": add(own > 0).astype(np.int64),
            "base_score": add(np.log10((own + 1) / (tokens + types + 1))), "score": add(np.log10(p)),
        })

    # As many partitions as blocks, up to what a driver can schedule; beyond, a partition takes several blocks one after the other.
    n_blocks = min(2 * splits * pieces, MOST_PARTITIONS)
    dealt = back.select("block", "fragment", "total").repartition(n_blocks, "block")
    both = placed.repartition(n_blocks, "block").groupBy("block").cogroup(dealt.groupBy("block"))
    out = both.applyInPandas(score, "rid long, held_out boolean, n_tokens long, n_known long, base_score double, score double")
    return out.select(F.col("rid").alias(id_col), "held_out", "n_tokens", "n_known", F.lit(tokens).cast("long").alias("train_tokens"), "base_score", "score")
