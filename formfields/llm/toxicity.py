"""Toxic spans and document scores by a linear-chain conditional random field.

Labels are given for documents; token labels come from them: a token of a toxic document is toxic where one of its
features occurs in toxic documents far more often than in others. A two-state chain is fitted to those sequences by
gradient ascent on the conditional likelihood (forward-backward), on a bounded sample of labelled rows. A document's
score is the calibrated probability that its chain visits the toxic state, from the marginals.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import LOWER, fitted_in_task, held_texts, span_hashes, text_slices, word_spans

BITS = 20
# Bounds of the fitted sample: labelled rows of each class, and bytes of text in all.
CLASS_ROWS, CLASS_BYTES = 2500, 6 << 20
# Longer documents are fitted in pieces of so many tokens; scoring takes them whole.
PIECE = 256
PREFIXES = (4, 5)
TRIM = np.zeros(256, bool)
TRIM[[ord(c) for c in ".,;:!?\"'()[]{}*#$%&|<>-_"]] = True


def features(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hashed features (tokens x features), text number, start and end of each token.

    A token is a word without punctuation at its ends, A-Z lower-cased; its features are itself, its first bytes
    (stems that inflect) and its last ones.
    """
    low = LOWER[data]
    starts, ends, owner = word_spans(data, at)
    for _ in range(3):
        wide = ends - starts > 1
        starts = starts + (wide & TRIM[low[starts]])
        wide = ends - starts > 1
        ends = ends - (wide & TRIM[low[ends - 1]])
    columns = [span_hashes(low, starts, ends)]
    for k in PREFIXES:
        columns.append(span_hashes(low, starts, np.minimum(ends, starts + k)) + np.uint64(k))
    columns.append(span_hashes(low, np.maximum(starts, ends - 4), ends) + np.uint64(11))
    return (np.stack(columns, 1) & np.uint64((1 << BITS) - 1)).astype(np.int32), owner, starts, ends


class Chain:
    """Two states (clean, toxic): a weight for each feature (toxic against clean), a bias and transitions."""

    def __init__(self, weights: np.ndarray, bias: float, transitions: np.ndarray, calibration: np.ndarray):
        self.weights, self.bias, self.transitions, self.calibration = weights, bias, transitions, calibration

    def emissions(self, x: np.ndarray) -> np.ndarray:
        return self.weights[x].sum(1) + self.bias


def forward_backward(e: np.ndarray, t: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Toxic marginal of every token, expected transitions (2 x 2), and each sequence's log-probability of no toxic token.

    e: toxic-against-clean scores of all tokens; sequences lie end to end. All sequences advance together, the
    longest ones alone at the end.
    """
    n = len(e)
    order = np.argsort(-sizes, kind="stable")
    s, z = starts[order], sizes[order]
    active = np.searchsorted(-z, -np.arange(1, (z[0] if len(z) else 0) + 1), "right")
    a = np.exp(t)
    odds = np.exp(np.clip(e, -30, 30))
    alpha = np.empty((n, 2))
    scale = np.empty(n)
    previous = None
    for k, m in enumerate(active):
        at = s[:m] + k
        now = np.ones((m, 2))
        now[:, 1] = odds[at]
        if previous is not None:
            now *= previous[:m] @ a
        c = now.sum(1)
        now /= c[:, None]
        alpha[at], scale[at] = now, c
        previous = now
    beta = np.ones((n, 2))
    expected = np.zeros((2, 2))
    for k in range(len(active) - 1, 0, -1):
        at = s[: active[k]] + k
        step = np.stack([np.ones(len(at)), odds[at]], 1) * beta[at] / scale[at][:, None]
        beta[at - 1] = step @ a.T
        expected += np.einsum("ni,ij,nj->ij", alpha[at - 1], a, step)
    marginal = (alpha * beta)[:, 1]
    clean = np.add.reduceat(-np.log(scale), starts) + t[0, 0] * (sizes - 1) if len(starts) else np.zeros(0)
    return marginal, expected, clean


def sequences(owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    starts = np.flatnonzero(np.concatenate(([True], owner[1:] != owner[:-1]))) if len(owner) else np.zeros(0, np.int64)
    return starts, np.diff(np.append(starts, len(owner)))


def summary(marginal: np.ndarray, clean: np.ndarray, owner: np.ndarray, n: int) -> np.ndarray:
    """What documents are scored by: log-odds of a visit to the toxic state, and the two largest marginals."""
    out = np.zeros((n, 3))
    if len(owner):
        starts, _ = sequences(owner)
        who = owner[starts]
        visit = np.clip(1 - np.exp(np.minimum(clean, 0)), 1e-9, 1 - 1e-9)
        out[who, 0] = np.log(visit / (1 - visit)) / 10
        out[who, 1] = np.maximum.reduceat(marginal, starts)
        out[who, 2] = np.log1p(np.add.reduceat(marginal, starts))
    silent = np.setdiff1d(np.arange(n), owner)
    out[silent, 0] = -2
    return out


def calibrated(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x @ c[:-1] + c[-1], -30, 30)))


def fit_chain(texts: list[str], labels: np.ndarray, rounds: int = 30) -> Chain:
    """Fit on documents and their labels; without one class the chain scores everything by the other."""
    column = pa.array(texts, pa.string())
    parts = [(f, *features(data, at)) for f, data, at in text_slices(column)]
    if not parts or labels.min(initial=1) == labels.max(initial=0):
        return Chain(np.zeros(1 << BITS), 0.0, np.zeros((2, 2)), np.array([0, 0, 0, 5.0 if len(labels) and labels.all() else -5.0]))
    x = np.concatenate([p[1] for p in parts])
    owner = np.concatenate([p[0] + p[2] for p in parts])
    size = 1 << BITS
    # In how many documents of each class a feature occurs.
    width = x.shape[1]
    seen = np.unique(np.repeat(owner, width) * size + x.ravel())
    doc, feature = seen // size, seen % size
    toxic_docs, clean_docs = labels.sum(), len(labels) - labels.sum()
    toxic = np.bincount(feature, weights=labels[doc], minlength=size)
    clean = np.bincount(feature, minlength=size) - toxic
    gain = np.log((toxic + 0.1) / (toxic_docs + 1)) - np.log((clean + 0.1) / (clean_docs + 1))
    # Telling: ten times as frequent, and by a likelihood ratio that no feature reaches by chance among so many.
    share, both = toxic_docs / len(labels), toxic + clean
    term = lambda found, expected: np.where(found > 0, found * np.log(np.maximum(found, 1) / np.maximum(expected, 1e-9)), 0)
    ratio = 2 * (term(toxic, both * share) + term(clean, both * (1 - share)))
    telling = (gain > np.log(10)) & (ratio > 2 * np.log(max(2, np.count_nonzero(both)))) & (toxic >= 3)
    y = telling[x].any(1) & labels[owner].astype(bool)
    # Maximum conditional likelihood of the token labels, by AdaGrad over the whole sample.
    whole, lengths = sequences(owner)
    place = np.arange(len(owner)) - np.repeat(whole, lengths)
    starts, sizes = sequences(owner.astype(np.int64) * (1 << 32) + place // PIECE)
    weights, bias, t = np.where(telling, 1.0, 0.0), -3.0, np.array([[1.0, -1.0], [0.0, 0.0]])
    squares, bias_square, t_square = np.full(size, 1e-8), 1e-8, np.full((2, 2), 1e-8)
    inner = np.ones(len(owner) - 1, bool)
    inner[starts[1:] - 1] = False
    observed = np.zeros((2, 2))
    np.add.at(observed, (y[:-1][inner].astype(int), y[1:][inner].astype(int)), 1)
    n = len(labels)
    for _ in range(rounds):
        marginal, expected, _ = forward_backward(weights[x].sum(1) + bias, t, starts, sizes)
        error = (y - marginal) / n
        grad = np.bincount(x.ravel(), weights=np.repeat(error, width), minlength=size) - 1e-6 * weights
        squares += grad**2
        # Only telling features have weights: rare words of the sample would else be learnt by heart.
        weights += np.where(telling, 0.5 * grad / np.sqrt(squares), 0)
        g = error.sum()
        bias_square += g**2
        bias += 0.2 * g / np.sqrt(bias_square)
        gt = (observed - expected) / n
        gt[0, 0] = gt[1, 1] = 0
        t_square += gt**2
        t = t + 0.1 * gt / np.sqrt(t_square)
        t[0, 0] = t[1, 1] = 0
        weights[np.abs(weights) < 1e-3] = 0
    marginal, _, clean_path = forward_backward(weights[x].sum(1) + bias, t, whole, lengths)
    z = summary(marginal, clean_path, owner, n)
    # Calibration: logistic regression of the document label on the summary, classes as the sample has them.
    c = np.zeros(4)
    z1 = np.hstack([z, np.ones((n, 1))])
    for _ in range(25):
        p = 1 / (1 + np.exp(-np.clip(z1 @ c, -30, 30)))
        h = (z1 * (p * (1 - p))[:, None]).T @ z1 + np.diag([0.05, 0.05, 0.05, 0.01])
        c = c + np.linalg.solve(h, z1.T @ (labels - p) - np.array([0.05, 0.05, 0.05, 0.01]) * c)
    return Chain(weights.astype(np.float32), bias, t, c)


def fitted_chain(docs: DataFrame, labels: DataFrame, learn: str, class_rows: int = CLASS_ROWS, class_bytes: int = CLASS_BYTES) -> Chain:
    """The chain fitted on labelled rows that `learn` selects: of each class at most class_rows, in an order that hashes the id, and half of class_bytes of text.

    A task fits it. A text beyond what is left of its class's bytes is passed over, so long documents are drawn less.
    """
    known = labels.select(F.col("doc_id").alias("lid"), F.col("toxic").cast("int").alias("toxic")).where(f"lid IS NOT NULL AND toxic IN (0, 1) AND {learn.replace('doc_id', 'lid')}")
    known = known.groupBy("lid").agg(F.max("toxic").alias("toxic")).withColumn("draw", F.xxhash64("lid"))
    taken = known.where("toxic = 1").orderBy("draw", "lid").limit(class_rows).unionByName(known.where("toxic = 0").orderBy("draw", "lid").limit(class_rows))
    found = docs.select("doc_id", "text").where(F.octet_length("text") <= class_bytes // 2).join(F.broadcast(taken), F.col("doc_id") == F.col("lid")).select("lid", "toxic", "draw", "text")

    def fit(sample: pd.DataFrame) -> Chain:
        held = held_texts(sample, {0: class_bytes // 2, 1: class_bytes // 2}, "toxic")
        return fit_chain(held["text"].tolist(), held["toxic"].to_numpy(np.int64))

    return fitted_in_task(found, fit) or fit_chain([], np.zeros(0, np.int64))


def tag_documents(docs: DataFrame, chain: Chain, cut: float = 0.3, id_col: str = "doc_id", text_col: str = "text", tagged: float = 0.5) -> DataFrame:
    """id, score, predicted, n_toxic and spans (of tokens whose toxic marginal is `tagged` or more: code points, ends exclusive).

    Null and empty texts have a score too. Rows that repeat give a row each; other columns are ignored.
    """
    held = docs.sparkSession.sparkContext.broadcast(chain)
    kind = docs.schema[id_col].dataType.simpleString()

    def per_batch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = held.value
        for batch in batches:
            for first, data, at in text_slices(batch.column(1)):
                x, owner, begin, end = features(data, at)
                n = len(at) - 1
                starts, sizes = sequences(owner)
                marginal, _, clean = forward_backward(own.emissions(x), own.transitions, starts, sizes) if len(owner) else (np.zeros(0), None, np.zeros(0))
                score = calibrated(summary(marginal, clean, owner, n), own.calibration)
                hot = np.flatnonzero(marginal >= tagged)
                spans: list[list] = [[] for _ in range(n)]
                # Code points before each byte: bytes that don't continue a character.
                points = np.concatenate(([0], np.cumsum((data & 0xC0) != 0x80))) if len(hot) else np.zeros(1, np.int64)
                for k in hot.tolist():
                    d = int(owner[k])
                    spans[d].append({"s": int(points[begin[k]] - points[at[d]]), "e": int(points[end[k]] - points[at[d]])})
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, n), pa.array(score), pa.array((score >= cut).astype(np.int32)), pa.array([len(s) for s in spans], pa.int64()), pa.array(spans, pa.list_(pa.struct([("s", pa.int32()), ("e", pa.int32())])))],
                    names=[id_col, "score", "predicted", "n_toxic", "spans"],
                )

    return docs.select(id_col, text_col).mapInArrow(per_batch, f"{id_col} {kind}, score double, predicted int, n_toxic long, spans array<struct<s:int,e:int>>")


def score_toxicity(docs: DataFrame, labels: DataFrame, modulus: int = 4, heldout: int = 2, cut: float = 0.3) -> DataFrame:
    """tag_documents with a chain fitted on the labelled rows whose crc32(doc_id as text) mod `modulus` is not `heldout`.

    Null labels and labels of null ids are not learnt from; of labels that repeat an id the toxic one counts. Without
    labels, or with one class only, every document scores by that class (without any: clean). Rows that repeat, share an
    id or have a null id (never held out) give a row each; null and empty texts have the score of a text without toxic
    tokens; an empty table gives no rows. Texts are read whole, however long. Other columns are ignored, whatever their
    names.
    """
    rest = "crc32(CAST(CAST(doc_id AS string) AS binary)) % {}"
    chain = fitted_chain(docs, labels, f"{rest.format(modulus)} <> {heldout}")
    out = tag_documents(docs, chain, cut)
    held = F.coalesce(F.expr(f"{rest.format(modulus)} = {heldout}"), F.lit(False))
    return out.select("doc_id", held.alias("held_out"), "score", "predicted", "n_toxic", "spans")
