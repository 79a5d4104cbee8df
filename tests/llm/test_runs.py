"""Runs side by side, and what they leave in the shared folder."""

import os
from concurrent.futures import ThreadPoolExecutor

import corpus_pipeline as pipeline
import numpy as np
import pytest

from sparkloom.llm import lm, near, queries


def folders(spark):
    at = spark.conf.get("spark.checkpoint.dir").removeprefix("file:")
    return {f"{d}/{n}" for d, _, names in os.walk(at) for n in names if n.startswith("part-")}, {n for n in os.listdir(at) if n.startswith("sparkloom-")}


def test_two_pipelines_in_one_process(spark, sf):
    before = folders(spark)[1]
    with ThreadPoolExecutor(2) as pool:
        one, two = pool.map(lambda _: pipeline.run(spark, sf), range(2))
    left = folders(spark)[1] - before
    assert len(left) == 2  # the last tables, which the results read
    rows = [sorted((r.doc_id, bytes(r.ids)) for r in df.collect()) for df in (one, two)]
    assert rows[0] == rows[1] and rows[0]


@pytest.mark.parametrize(("name", "tables"), [("op6_toxicity", 0), ("op1_lm_scoring", 2), ("op5_simhash", 0)])
def test_what_is_left(spark, sf, name, tables):
    before = folders(spark)[1]
    queries.QUERIES[name](spark, sf).count()
    assert len(folders(spark)[1] - before) <= tables


def test_pairs_are_counted_by_blocks_and_leave_nothing(spark, monkeypatch):
    """The table of sums goes when pairs are read, and few or many blocks counted at a time give the same."""
    encoded = spark.createDataFrame([(False, np.array([k % 3 + 1, 2, 3, 0], "<i4").tobytes()) for k in range(40)], "_held boolean, ids binary").coalesce(1).checkpoint()
    before, made = folders(spark)[1], []
    for block, together in ((8, 1), (8, 3), (lm.BLOCK, lm.TOGETHER)):
        monkeypatch.setattr(lm, "BLOCK", block)
        monkeypatch.setattr(lm, "TOGETHER", together)
        made.append(sorted(zip(*(x.tolist() for x in lm.count_pairs(encoded, 4)), strict=True)))
    assert made[0] == made[1] == made[2] and sum(c for _, _, c in made[0]) == 160
    assert folders(spark)[1] == before


def test_sketches_never_say_more_than_the_sets():
    rng = np.random.default_rng(1)
    for n, m, shared in [(0, 0, 0), (0, 5, 0), (1, 1, 1), (40, 45, 38), (300, 280, 250), (33, 31, 30), (5000, 4200, 4100), (70, 60, 0)]:
        pool = np.unique(rng.integers(-(2**63), 2**63 - 1, n + m - shared + 50))
        rng.shuffle(pool)
        a, b = pool[:n], pool[n - shared : n - shared + m]
        apart = len(set(a.tolist()) ^ set(b.tolist()))
        told = near.differ(near.sketch(np.sort(a)), near.sketch(np.sort(b)))
        assert told <= apart and (apart == 0) == (told == 0) and told % 2 == apart % 2
        if apart > 50:
            assert told > apart / 3


def test_templates(spark):
    """Pages made of six of twelve paragraphs: many pairs meet, and sketches let few of them through to the sets."""
    rng = np.random.default_rng(2)
    paragraphs = [" ".join(f"p{k}w{j}" for j in range(50)) for k in range(12)]
    texts = ["\n".join(paragraphs[k] for k in rng.permutation(12)[:6]) for _ in range(300)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").checkpoint()
    from .test_near import groups

    seen, plain_ = [], near._unlike
    try:
        near._unlike = lambda pairs, sketches: (made := plain_(pairs, sketches), seen.append((pairs.count(), made.count())))[0]
        got = {r._id: r.component_id for r in near.group_by_shingles(df).collect()}
    finally:
        near._unlike = plain_
    assert got == groups(dict(enumerate(texts)))
    assert sum(n for n, _ in seen) > 20 * sum(k for _, k in seen)
