"""Deleted interpolation against a plain-Python model, and the empty and odd cases."""

import math
import re
import zlib
from collections import Counter

import numpy as np
import pandas as pd
import pytest

from formfields.llm import lm_scoring as L

SCHEMA = "doc_id long, text string, rid string, part string, block string, score double"


def table(spark, rows):
    return spark.createDataFrame([(i, t, "x", "y", "z", 0.5) for i, t in rows], SCHEMA)


def rest(doc_id, modulus=7):
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % modulus


def tokens_of(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall("[^\x20\x09-\x0d]+", low) + ["END"]


def brute_force(rows):
    """(doc_id, n_tokens, n_known, train_tokens, base_score, score) by dictionaries, one document after the other."""
    def counts(wanted):
        uni, bi = Counter(), Counter()
        for i, t in rows:
            if rest(i) in wanted:
                ts = tokens_of(t)
                uni.update(ts)
                bi.update(zip(["BEGIN", *ts], ts, strict=False))
        return uni, bi

    def looked_up(text, uni, bi):
        ts = tokens_of(text)
        own = np.array([uni[t] for t in ts])
        context = np.array([uni["END"], *own[:-1]])
        pair = np.array([bi[p] for p in zip(["BEGIN", *ts], ts, strict=False)])
        return own, context, pair

    uni, bi = counts({0, 1, 3, 4, 5, 6})
    fewer = counts({0, 1, 3, 4, 5})
    n_rest, types_rest = sum(fewer[0].values()), len(fewer[0])
    cells = Counter()
    rounded = lambda p: int(np.rint(-np.log2(p) * L.STEPS)) if p > 0 else -1
    for i, t in rows:
        if rest(i) == 6:
            for own, context, pair in zip(*looked_up(t, *fewer), strict=True):
                cells[int(L.bucket_of(np.array([context]))[0]), rounded(pair / max(context, 1)), rounded(own / max(n_rest, 1))] += 1
    histogram = pd.DataFrame([(*k, n) for k, n in cells.items()], columns=["bucket", "q2", "q1", "n"])
    weights = L.learned_weights(histogram, types_rest)
    n, v = sum(uni.values()), len(uni)
    out = []
    for i, t in rows:
        own, context, pair = looked_up(t, uni, bi)
        w = weights[L.bucket_of(context)]
        p = w[:, 0] * pair / np.maximum(context, 1) + w[:, 1] * own / max(n, 1) + w[:, 2] / (v + 1)
        out.append((i, len(own), int((own > 0).sum()), n, sum(math.log10((c + 1) / (n + v + 1)) for c in own), float(np.log10(p).sum())))
    return out


def test_scores_by_brute_force(spark, monkeypatch):
    rng = np.random.default_rng(7)
    words = [f"Word{k}" for k in range(60)] + ["É", "naïve", "x y"]
    rows = [(int(k), " ".join(rng.choice(words, rng.integers(0, 40)))) for k in range(120)]
    rows += [(500, None), (501, ""), (502, " \t\n"), (None, "Word1 word2"), (3, rows[3][1]), (3, "another text"), (504, "long " * 30000)]
    # Small pieces, so that blocks, fragments and folds are many.
    monkeypatch.setattr(L, "BLOCK_BYTES", 2000)
    monkeypatch.setattr(L, "FRAGMENT_ROWS", 3000)
    monkeypatch.setattr(L, "FOLD_TOKENS", 50)
    found = [(r.doc_id, r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score) for r in L.score_texts(table(spark, rows)).collect()]
    wanted = brute_force(rows)
    order = lambda r: (str(r[0]), r[1], r[4])
    assert len(found) == len(wanted)
    for a, b in zip(sorted(found, key=order), sorted(wanted, key=order), strict=True):
        assert a[:4] == b[:4] and a[4:] == pytest.approx(b[4:], rel=1e-9)


def test_held_out_rows_teach_nothing(spark):
    held = next(k for k in range(100) if rest(k) == 2)
    own = next(k for k in range(100) if rest(k) == 0)
    found = {r.doc_id: r for r in L.score_texts(table(spark, [(held, "rare"), (own, "plain")])).collect()}
    assert found[held].held_out and found[held].n_known == 1 and found[own].n_known == 2 and found[own].train_tokens == 2


def test_an_empty_table(spark):
    assert L.score_texts(table(spark, [])).count() == 0
