"""Mixing sources to target weights by soft membership.

A classifier fitted on the labelled table predicts each document's domain posteriors. Nonnegative document rates are
then fitted by projected-gradient least squares: the expected token totals of the domains, under the rates, shall
match their targets within a tolerance, while rates stay near one. A step needs only the domain totals and their
curvature, one small aggregate.
"""

from __future__ import annotations

import warnings
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import dropped, fitted_in_task, hashed_words, held_texts, text_slices, written

BITS = 18
# Bounds of the fitted sample of labelled rows.
SAMPLE_ROWS, SAMPLE_BYTES = 6000, 24 << 20
DOMAINS = ("good", "poor", "toxic")
# Shares of the mixed tokens that each domain shall have.
TARGETS = {"good": 0.90, "poor": 0.08, "toxic": 0.02}


def document_features(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashed distinct words (document number, feature) and the number of words of each document."""
    words, owner = hashed_words(data, at)
    n = len(at) - 1
    keys = np.unique((owner.astype(np.uint64) << np.uint64(BITS)) | (words >> np.uint64(64 - BITS)))
    sizes = np.bincount(owner, minlength=n) if len(owner) else np.zeros(n, np.int64)
    return (keys >> np.uint64(BITS)).astype(np.int64), (keys & np.uint64((1 << BITS) - 1)).astype(np.int64), sizes


class Domains:
    """Multinomial logistic regression over hashed words, with each document's weights divided by the root of its distinct words."""

    def __init__(self, weights: np.ndarray, bias: np.ndarray):
        self.weights, self.bias = weights, bias

    def posteriors(self, doc: np.ndarray, feature: np.ndarray, n: int) -> np.ndarray:
        k = len(self.bias)
        logits = np.tile(self.bias, (n, 1))
        if len(doc):
            held = np.bincount(doc, minlength=n)
            scale = 1 / np.sqrt(np.maximum(held, 1))
            for c in range(k):
                logits[:, c] += np.bincount(doc, weights=self.weights[feature, c], minlength=n) * scale
        logits -= logits.max(1, keepdims=True)
        p = np.exp(logits)
        return p / p.sum(1, keepdims=True)


def fit_domains(texts: list[str], classes: np.ndarray, k: int = len(DOMAINS), rounds: int = 60) -> Domains:
    """AdaGrad on the sample's likelihood. Without rows, all domains are equally likely."""
    weights, bias = np.zeros((1 << BITS, k)), np.zeros(k)
    n = len(texts)
    if not n:
        return Domains(weights, bias)
    docs, features = [], []
    for first, data, at in text_slices(pa.array(texts, pa.string())):
        d, f, _ = document_features(data, at)
        docs.append(first + d)
        features.append(f)
    doc, feature = np.concatenate(docs), np.concatenate(features)
    used, slot = np.unique(feature, return_inverse=True)
    scale = 1 / np.sqrt(np.maximum(np.bincount(doc, minlength=n), 1))
    w, squares, bias_squares = np.zeros((len(used), k)), np.full((len(used), k), 1e-6), np.full(k, 1e-6)
    truth = np.eye(k)[classes]
    bias = np.log((truth.sum(0) + 0.5) / (n + 0.5 * k))
    for _ in range(rounds):
        logits = np.stack([np.bincount(doc, weights=w[slot, c], minlength=n) * scale + bias[c] for c in range(k)], 1)
        logits -= logits.max(1, keepdims=True)
        p = np.exp(logits)
        p /= p.sum(1, keepdims=True)
        error = truth - p
        for c in range(k):
            g = np.bincount(slot, weights=(error[:, c] * scale)[doc], minlength=len(used)) / n - 1e-6 * w[:, c]
            squares[:, c] += g**2
            w[:, c] += 0.3 * g / np.sqrt(squares[:, c])
            bias_squares[c] += error[:, c].mean() ** 2
            bias[c] += 0.1 * error[:, c].mean() / np.sqrt(bias_squares[c])
    weights[used] = w
    return Domains(weights.astype(np.float32), bias)


def fitted_domains(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS, most_bytes: int = SAMPLE_BYTES) -> Domains:
    """The classifier fitted on at most `rows` labelled rows and `most_bytes` of text, drawn by a hash of the id; a task fits it.

    A text beyond what is left of the bytes is passed over, so long documents are drawn less.
    """
    known = labels.where("doc_id IS NOT NULL AND quality IN (0, 1) AND toxic IN (0, 1)").groupBy(F.col("doc_id").alias("lid")).agg(F.max("toxic").alias("toxic"), F.min("quality").alias("quality"))
    domain = F.when(F.col("toxic") == 1, 2).when(F.col("quality") == 0, 1).otherwise(0)
    taken = known.select("lid", domain.alias("domain"), F.xxhash64("lid").alias("draw")).orderBy("draw", "lid").limit(rows)
    found = docs.select("doc_id", "text").where(F.octet_length("text") <= most_bytes).join(F.broadcast(taken), F.col("doc_id") == F.col("lid")).select("lid", "domain", "draw", "text")

    def fit(sample: pd.DataFrame) -> Domains:
        held = held_texts(sample, most_bytes, "domain")
        return fit_domains(held["text"].tolist(), held["domain"].to_numpy(np.int64))

    return fitted_in_task(found, fit) or fit_domains([], np.zeros(0, np.int64))


def posteriors(docs: DataFrame, model: Domains, domains: tuple[str, ...] = DOMAINS, keep: list[str] | None = None) -> DataFrame:
    """The columns `keep` (doc_id), n_tokens and p_<domain> of every row; a null or empty text has no tokens and the model's prior."""
    held = docs.sparkSession.sparkContext.broadcast(model)
    names = [f"p_{d}" for d in domains]
    kept = [c for c in keep or ["doc_id"] if c not in ("n_tokens", *names)]
    schema = T.StructType([docs.schema[c] for c in kept])
    for name, kind in (("n_tokens", T.LongType()), *((n, T.DoubleType()) for n in names)):
        schema = schema.add(name, kind)

    def per_batch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = held.value
        for batch in batches:
            for first, data, at in text_slices(batch.column(0)):
                doc, feature, sizes = document_features(data, at)
                p = own.posteriors(doc, feature, len(sizes))
                yield pa.RecordBatch.from_arrays([*(c.slice(first, len(sizes)) for c in batch.columns[1:]), pa.array(sizes.astype(np.int64)), *(pa.array(p[:, c].astype(np.float64)) for c in range(len(names)))], names=schema.names)

    return docs.select(F.col("text").alias("text to read"), *[F.col(f"`{c}`") for c in kept]).mapInArrow(per_batch, schema)


def rate_of(multipliers: np.ndarray, domains: tuple[str, ...]) -> str:
    """SQL for a row's rate under the domains' multipliers: the row's gradient step from one, projected on rate >= 0."""
    pulled = " + ".join(f"p_{d} * {float(m)!r}D" for d, m in zip(domains, multipliers, strict=True))
    return f"greatest(0.0D, 1.0D - ({pulled}))"


def fit_multipliers(members: DataFrame, targets: dict[str, float], budget: float | None = None, rounds: int = 50, ridge: float = 1e-7, tolerance: float = 1e-4) -> tuple[np.ndarray, list[np.ndarray]]:
    """The domains' multipliers, and the residuals of every round: expected domain token totals under the rates match targets * budget (default: all tokens).

    Minimises half the sum over domains of (total / budget - target)^2, plus the ridge times half the token-weighted mean
    of (rate - 1)^2. At the minimum a rate is the projection of 1 - p . m, where m is the residuals divided by the ridge.
    So m is what is fitted: a round is a gradient step on the dual, scaled by the curvature of the rows whose rate is above
    zero, and halved until the dual falls. Rounds end when every residual is within `tolerance` or the minimum is reached.
    Only the totals, the curvature (both of the number of domains) and the value come to the driver in each round.
    """
    domains = tuple(targets)
    k = len(domains)
    shares = np.array([targets[d] for d in domains])
    shares = shares / shares.sum()
    whole = members.agg(F.sum("n_tokens")).first()[0] or 0
    budget = float(budget or whole or 1)
    pairs = [(a, b) for a in range(k) for b in range(a, k)]

    def at(m: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
        """The dual's value, the residuals and the curvature."""
        p = [F.col(f"p_{d}") for d in domains]
        n = F.col("n_tokens")
        rated = members.select("n_tokens", *[f"p_{d}" for d in domains], F.expr(rate_of(m, domains)).alias("r"))
        free = F.when(F.col("r") > 0, n).otherwise(0)
        sums = rated.agg(F.sum(n * F.col("r") * F.col("r")), *[F.sum(n * F.col("r") * x) for x in p], *[F.sum(free * p[a] * p[b]) for a, b in pairs]).first()
        found = np.array([float(x or 0) for x in sums]) / budget
        curvature = ridge * np.eye(k)
        for (a, b), x in zip(pairs, found[1 + k :], strict=True):
            curvature[a, b] += x
            if a != b:
                curvature[b, a] += x
        return found[0] / 2 + float(shares @ m) + ridge / 2 * float(m @ m), found[1 : 1 + k] - shares, curvature

    multipliers = np.zeros(k)
    value, residual, curvature = at(multipliers)
    residuals = [residual]
    for _ in range(rounds):
        uphill = residual - ridge * multipliers
        if np.abs(residual).max() <= tolerance or np.abs(uphill).max() <= tolerance * 1e-3:
            break
        step = np.linalg.solve(curvature, uphill)
        size = 1.0
        while True:
            tried = at(multipliers + size * step)
            if tried[0] <= value - 1e-4 * size * float(uphill @ step) or size < 1e-6:
                break
            size /= 2
        multipliers = multipliers + size * step
        value, residual, curvature = tried
        residuals.append(residual)
    if whole and np.abs(residual).max() > tolerance:
        warnings.warn(f"domain totals miss their targets by {dict(zip(domains, residual.tolist(), strict=True))} of the budget", stacklevel=2)
    return multipliers, residuals


def fit_rates(members: DataFrame, targets: dict[str, float], **options: float) -> tuple[DataFrame, list[np.ndarray]]:
    """members (n_tokens, p_<domain>) with `rate`, and the residuals of every round of fit_multipliers."""
    multipliers, residuals = fit_multipliers(members, targets, **options)
    return members.withColumn("rate", F.expr(rate_of(multipliers, tuple(targets)))), residuals


def mix_sources(docs: DataFrame, labels: DataFrame, targets: dict[str, float] | None = None, rounds: int = 50) -> DataFrame:
    """doc_id, n_tokens, p_good, p_poor, p_toxic and rate (copies to take, 0 or more) of every row.

    A row's rate depends on its own text and on the totals of all rows. Rows that repeat, or share an id, give a row each;
    a null id gives a row too. Null or empty texts have rates but carry no tokens; texts are read whole, however long.
    Without labelled rows all domains are equally likely; of labels that repeat an id the toxic and the poor one count; an
    empty table gives no rows. Other columns are ignored, whatever their names.
    """
    members = written(posteriors(docs, fitted_domains(docs, labels)), "posteriors")
    return fit_rates(members, targets or TARGETS, rounds=rounds)[0]


def with_rates(docs: DataFrame, labels: DataFrame, targets: dict[str, float] | None = None, rounds: int = 50) -> DataFrame:
    """The rows with n_tokens, p_good, p_poor, p_toxic and rate as mix_sources has them, beside their own columns.

    Columns of docs that have those names give way. Each row is rated by its own text, whatever its id; no shuffle of texts.
    """
    targets = targets or TARGETS
    model = fitted_domains(docs, labels)
    members = written(posteriors(docs, model, keep=["doc_id"]), "posteriors")
    multipliers, _ = fit_multipliers(members, targets, rounds=rounds)
    dropped(members)
    rated = posteriors(docs, model, keep=[c for c in docs.columns if c != "rate"])
    return rated.withColumn("rate", F.expr(rate_of(multipliers, tuple(targets))))
