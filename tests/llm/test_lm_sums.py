"""Op 1's sums over contexts: each context once, and right where the tables are far apart."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from sparkloom.llm import lm


def made(words, spread):
    counts = np.concatenate([[50.0], np.arange(words, 0, -1.0)])
    known = lm.Words([f"w{k}".encode() for k in range(words)], counts, int(counts.sum()) + 9, words + 4)
    lay = lm.lay_out(known)
    rng = np.random.default_rng(5)
    return lay, len(counts), rng.normal(scale=spread, size=(sum(lay.tables), lm.CLASSES)).astype(np.float32)


def tokens(rng, known):
    ids = [np.append(rng.integers(1, known + 7, rng.integers(0, 60)), 0) for _ in range(300)]
    return np.concatenate(ids), np.array([len(x) for x in ids])


@pytest.mark.parametrize("spread", [0.3, 30.0])
def test_sums_against_plain_ones(spread):
    lay, known, weights = made(600, spread)
    model = lm.Model(lay, known, weights)
    ids, lens = tokens(np.random.default_rng(6), known)
    head, at, cls, one, two, _ = model._placed(ids, lens)
    edge = np.cumsum((0,) + lay.tables)
    rows = np.array([one, two, lm._pair(one, two, lay.tables[2], 1)]) + edge[:3, None]
    x = lay.start + weights.astype(np.float64)[rows].sum(0)
    x -= x.max(1, keepdims=True)
    share = np.exp(x) / np.exp(x).sum(1, keepdims=True)
    want = np.zeros((edge[-1], lm.CLASSES))
    for r in rows:
        np.add.at(want, r, share)
    got = np.zeros_like(want)
    model.expect(model.contexts(ids, lens), got)
    assert np.allclose(got, want, rtol=1e-4, atol=1e-4)
    inside = np.zeros(len(ids))
    for here, row, to in model._branches(head, at, one):
        inside[here] += model.logs[row, to]
    want = x[np.arange(len(ids)), cls] - np.log(np.exp(x).sum(1)) + inside - np.where(head, 0, model.floor)
    assert np.allclose(model.block(ids, lens), want, rtol=1e-5, atol=1e-4)


def test_a_context_is_weighed_once(monkeypatch):
    """However often it occurs, and in however many blocks."""
    lay, known, weights = made(40, 0.3)
    model = lm.Model(lay, known, weights)
    blocks = [tokens(np.random.default_rng(k), known) for k in range(4)]
    held = np.concatenate([model.contexts(*b) for b in blocks])
    seen, plain = [], lm.Model._logz
    monkeypatch.setattr(lm.Model, "_logz", lambda self, *three: (seen.append(len(three[0])), plain(self, *three))[1])
    got, want = np.zeros_like(weights, np.float64), np.zeros_like(weights, np.float64)
    model.expect(held, got)
    assert seen == [len(np.unique(held))] and seen[0] < len(held) / 5
    for ids, lens in blocks:
        model.block(ids, lens, want)
    assert np.allclose(got, want, rtol=1e-5, atol=1e-4)


def test_training_takes_contexts_of_few_or_many_blocks(spark, monkeypatch):
    rng = np.random.default_rng(7)
    texts = [(k, " ".join(f"w{x}" for x in rng.zipf(1.5, 40) if x < 500)) for k in range(60)]
    df = spark.createDataFrame(texts, "doc_id long, text string").coalesce(1)
    words, _ = lm.known_words(lm.count_words(df.select(F.col("text").alias("_t"))))
    encoded = lm.encode(df.selectExpr("doc_id _id", "false _held", "text _t"), words).checkpoint()
    weights = []
    for block, contexts in ((50, 1), (50, 400), (lm.BLOCK, lm.CONTEXTS)):
        monkeypatch.setattr(lm, "BLOCK", block)
        monkeypatch.setattr(lm, "CONTEXTS", contexts)
        weights.append(lm.train(encoded, words, lm.lay_out(words))[0])
    assert np.allclose(weights[0], weights[2], atol=1e-5) and np.allclose(weights[1], weights[2], atol=1e-5)
