"""Token counts of texts under a byte-level BPE vocabulary, by rank-synchronous merging of ragged arrays.

Pre-tokens of a batch lie end to end in one array of symbol ids. Each round finds every sequence's
lowest-rank pair and applies all its occurrences in that sequence at once, for all sequences together;
sequences without a mergeable pair leave. What is left is counted.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed value: the byte-level split pattern that the tokenizer files are made for.
BYTE_LEVEL_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
CACHE_ENTRIES = 300_000
NONE = np.iinfo(np.int64).max


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    spare = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(spare)) for b in range(256)]


class MergeTable:
    """Merge ranks of a tokenizers .json file, as sorted arrays."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab = spec["model"]["vocab"]
        pairs = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
        self.width = max(vocab.values()) + 1
        keys = np.array([vocab[a] * self.width + vocab[b] for a, b in pairs], np.int64)
        order = np.argsort(keys, kind="stable")
        self.keys, self.ranks = keys[order], order.astype(np.int64)
        self.merged = np.array([vocab[a + b] for a, b in pairs], np.int64)
        self.bytes = np.array([vocab[s] for s in byte_symbols()], np.int64)
        special = [a["content"] for a in spec.get("added_tokens") or []]
        self.special = regex.compile("|".join(regex.escape(s) for s in sorted(special, key=len, reverse=True))) if special else None
        self.split = regex.compile(BYTE_LEVEL_SPLIT)
        self.seen: dict[str, int] = {}

    def rank_of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        wanted = left * self.width + right
        at = np.minimum(np.searchsorted(self.keys, wanted), len(self.keys) - 1)
        return np.where(self.keys[at] == wanted, self.ranks[at], NONE)

    def count(self, pieces: list[str]) -> np.ndarray:
        """Surviving symbols of each pre-token (not empty)."""
        raw = [p.encode("utf-8", "surrogatepass") for p in pieces]
        sizes = np.fromiter(map(len, raw), np.int64, len(raw))
        symbols = self.bytes[np.frombuffer(b"".join(raw), np.uint8)]
        owner = np.repeat(np.arange(len(raw)), sizes)
        left = sizes.copy()
        while len(symbols) > 1:
            rank = np.full(len(symbols), NONE)
            inner = owner[:-1] == owner[1:]
            rank[:-1][inner] = self.rank_of(symbols[:-1][inner], symbols[1:][inner])
            begin = np.flatnonzero(np.concatenate(([True], ~inner)))
            lowest = np.minimum.reduceat(rank, begin)
            lengths = np.diff(np.append(begin, len(symbols)))
            best = np.repeat(lowest, lengths)
            hit = (rank == best) & (best != NONE)
            if not hit.any():
                break
            # Overlapping hits only come from a run of one symbol: take every other one from the run's start.
            at = np.flatnonzero(hit)
            fresh = np.concatenate(([True], np.diff(at) > 1))
            run_start = at[np.maximum.accumulate(np.where(fresh, np.arange(len(at)), 0))]
            take = at[(at - run_start) % 2 == 0]
            symbols[take] = self.merged[rank[take]]
            keep = np.ones(len(symbols), bool)
            keep[take + 1] = False
            np.subtract.at(left, owner[take], 1)
            keep &= best != NONE
            symbols, owner = symbols[keep], owner[keep]
        return left

    def totals(self, texts: list[str]) -> list[int]:
        """Tokens of each text. A special string in a text is one token, as is the library's default."""
        bag, fixed = [], []
        for text in texts:
            parts = [text]
            specials = 0
            if self.special is not None and self.special.search(text):
                parts = self.special.split(text)
                specials = len(parts) - 1
            bag.append([p for part in parts for p in self.split.findall(part)])
            fixed.append(specials)
        new = list({p for pieces in bag for p in pieces if p not in self.seen})
        if new:
            if len(self.seen) + len(new) > CACHE_ENTRIES:
                self.seen = {}
                new = list({p for pieces in bag for p in pieces})
            self.seen.update(zip(new, self.count(new).tolist(), strict=True))
        seen = self.seen
        return [n + sum(map(seen.__getitem__, pieces)) for pieces, n in zip(bag, fixed, strict=True)]


def runs(texts: list[str], chars: int = 1 << 19) -> Iterator[list[str]]:
    part, size = [], 0
    for t in texts:
        part.append(t)
        size += len(t)
        if size >= chars:
            yield part
            part, size = [], 0
    if part:
        yield part


def token_counts(docs: DataFrame, vocabulary: str, limit: int = 512, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, n_bytes, n_tokens and over_limit of every row.

    vocabulary: path of a tokenizers .json file that exists on every executor. Null texts count as empty
    (0 bytes, 0 tokens); rows with a null id or repeated rows give a row each; other columns are ignored.
    """
    kind = docs.schema[id_col].dataType

    def per_batch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        merges = MergeTable(vocabulary)
        for batch in batches:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            tokens = [n for part in runs(texts) for n in merges.totals(part)]
            sizes = [len(t.encode("utf-8", "surrogatepass")) for t in texts]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes, pa.int64()), pa.array(tokens, pa.int64())], names=[id_col, "n_bytes", "n_tokens"])

    schema = f"{id_col} {kind.simpleString()}, n_bytes long, n_tokens long"
    out = docs.select(id_col, text_col).mapInArrow(per_batch, schema)
    return out.withColumn("over_limit", F.col("n_tokens") > F.lit(limit))
