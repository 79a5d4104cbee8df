"""The near-copy stage of the pipeline against all pairs' Jaccard similarities."""

import random

import corpus_pipeline as pipeline
import pytest

from sparkloom.llm import near

from . import plain


def shingles(text, n=5):
    w = plain.words(plain.lower(text or ""))
    return {" ".join(w[k : k + n]) for k in range(max(len(w) - n + 1, 1))} if w else set()


def groups(docs):
    """docs: id -> text. id -> the least id that is reached over pairs of 0.8 or more, of all pairs."""
    sets, up = {i: shingles(t) for i, t in docs.items()}, {i: i for i in docs}

    def top(i):
        while up[i] != i:
            i = up[i]
        return i

    ids = sorted(sets)
    for k, i in enumerate(ids):
        for j in ids[k + 1 :]:
            x, y = sets[i], sets[j]
            if 9 * len(x & y) >= 4 * (len(x) + len(y)):
                a, b = sorted((top(i), top(j)))
                up[b] = a
    return {i: top(i) for i in ids}


def changed(words, n, rng):
    out = list(words)
    for k in rng.sample(range(len(out)), n):
        out[k] = f"x{rng.randrange(10**6)}"
    return out


@pytest.fixture(scope="module")
def copies():
    """Families with none to a few words changed, one large family, and texts that share a passage alone."""
    rng = random.Random(5)
    texts = [None, "", " \t", "one two", "One  TWO", "a b c d e", "a b c d e f"]
    for size in (8, 30, 60, 150, 400):
        for _ in range(4):
            base = [f"w{rng.randrange(3000)}" for _ in range(size)]
            texts += [" ".join(changed(base, rng.randrange(1 + size // 20), rng)) for _ in range(6)]
    base = [f"w{rng.randrange(3000)}" for _ in range(120)]
    texts += [" ".join(changed(base, rng.randrange(5), rng)) for _ in range(60)]
    passage = [f"p{k}" for k in range(30)]
    texts += [" ".join([f"w{rng.randrange(3000)}" for _ in range(40)] + passage) for _ in range(40)]
    rng.shuffle(texts)
    return dict(enumerate(texts))


def test_near_copies_against_all_pairs(spark, sf, copies):
    want = groups(copies)
    df = spark.createDataFrame(list(copies.items()), "doc_id long, text string").checkpoint()
    assert {r._id: r.component_id for r in near.group_by_shingles(df).collect()} == want
    kept = pipeline.near_copies(spark, df, sf)
    assert sorted(r.doc_id for r in kept.collect()) == sorted(set(want.values()))
    thin = plain.groups({i: plain.fingerprint(t) for i, t in copies.items()})
    assert len(set(want.values())) < len(set(thin.values()))


def test_near_copies_of_documents(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    want = groups({r.doc_id: r.text for r in docs.collect()})
    assert {r.doc_id for r in pipeline.near_copies(spark, docs, sf).collect()} == set(want.values())


def test_odd_rows(spark, sf):
    rows = [(None, "a b c d e f"), (3, "a b c d e f"), (None, None), (7, "A b c\td e f"), (7, "other words"), (9, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string").checkpoint()
    left = pipeline.near_copies(spark, df, sf).collect()
    assert sorted((r.doc_id or 0, r.text) for r in left if r.text is not None) == [(0, "a b c d e f"), (3, "a b c d e f"), (7, "other words"), (9, "")]
    assert sum(r.doc_id is None for r in left) == 2
    assert pipeline.near_copies(spark, df.limit(0).checkpoint(), sf).count() == 0
