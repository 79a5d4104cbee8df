"""Operators 11 to 13 against plain versions, on odd rows too."""

import math
import random
import re
from itertools import permutations

import numpy as np
import pyspark.sql.functions as F
import pytest
import xxhash

from sparkloom.llm import audit, fingerprints, negatives

from . import plain

# ---- 11: hard negatives


def mined(rows, anchors, positives=5, negatives_=10, low=30, high=90):
    """rows: (id, label, vector). The operator's rows, by sorting everything; scores in whole numbers."""

    def good(r):
        return None not in r and all(x is not None and math.isfinite(x) for x in r[2])

    quant = lambda r: (r[0], r[1], [math.floor(256 * x) for x in r[2]])
    each = [quant(r) for r in rows if good(r)]
    out = []
    for a in [quant(r) for r in anchors if good(r)]:
        scored, left = [], True
        for b in each:
            if left and b == a:
                left = False  # the anchor itself, once
            elif len(b[2]) == len(a[2]):
                s = sum(x * y for x, y in zip(a[2], b[2], strict=True))
                if -(1 << 63) <= s < 1 << 63:
                    scored.append((-s, b[0], b[1]))
        scored.sort()
        for p in [s for s in scored if s[2] == a[1]][:positives]:
            fit = [s for s in scored if s[2] != a[1] and low * -p[0] <= 100 * -s[0] <= high * -p[0]]
            out += [(a[0], p[1], k + 1, s[1], -p[0], -s[0]) for k, s in enumerate(fit[:negatives_])]
    return sorted(out)


def vectors(seed, n, size=8, scale=1.0):
    rng = random.Random(seed)
    return [(k, rng.randrange(3), [round(rng.gauss(0.3, 1), 2) * scale for _ in range(size)]) for k in range(n)]


def as_table(spark, rows):
    return spark.createDataFrame([(r[0], r[2], r[1], "x") for r in rows], "vec_id long, embedding array<float>, label int, VEC_ID2 string")


def told(df):
    return sorted(map(tuple, df.collect()))


def as_floats(rows):
    """Values as a table of floats holds them."""
    f = lambda x: None if x is None else float(np.float32(x))
    return [(r[0], r[1], None if r[2] is None else [f(x) for x in r[2]]) for r in rows]


def test_mined(spark, monkeypatch):
    monkeypatch.setattr(negatives, "ROWS", 4)
    monkeypatch.setattr(negatives, "COLUMNS", 16)
    rows = vectors(1, 150)
    rows += [(200 + k, k % 2, [1.0] * 8) for k in range(40)]  # ties
    rows += [(None, 1, [1.0] * 8), (5, None, [1.0] * 8), (6, 1, None), (7, 1, [None] + [1.0] * 7), (8, 1, [math.nan] * 8), (9, 0, [math.inf] * 8), (300, 1, [1.0] * 3), (301, 1, [2.0] * 3), (302, 0, [1.5] * 3), (303, 1, [])]
    rows += [rows[20], rows[20], rows[3]]  # repeated, anchors and not
    rows = as_floats(rows)
    df = as_table(spark, rows).repartition(3).cache()
    anchors = [r for r in rows if r[0] is not None and r[0] % 20 == 0 or r[0] == 301]
    want = mined(rows, anchors)
    assert len(want) > 300 and told(negatives.mine(df, df.where("vec_id % 20 = 0 or vec_id = 301"))) == want
    small = negatives.mine(df, df.where("vec_id % 20 = 0 or vec_id = 301"), broadcast=3 * 8 * 8)  # blocks of three anchors
    assert told(small) == want
    assert negatives.mine(df, df.limit(0)).count() == 0 and negatives.mine(df.limit(0), df).count() == 0


def test_scores_beyond_float64(spark):
    rows = as_floats(vectors(2, 40, 4, 3e6) + vectors(3, 10, 4, 1e16))
    rows = [(k, *r[1:]) for k, r in enumerate(rows)]
    df = as_table(spark, rows)
    assert told(negatives.mine(df, df.where("vec_id % 5 = 0"))) == mined(rows, rows[::5])


def test_lists_merge():
    rng = np.random.default_rng(4)
    one, two, both = (negatives.Best(7, 3) for _ in range(3))
    for held in (one, two) * 5:
        slots, scores, ids = rng.integers(0, 7, 20), rng.integers(-3, 3, 20), rng.integers(0, 50, 20)
        held.add(slots, scores, ids)
        both.add(slots, scores, ids)
    at, place = np.nonzero(np.arange(3)[None, :] < two.n[:, None])
    one.add(at, two.scores[at, place], two.ids[at, place])
    assert (one.scores == both.scores).all() and (one.ids == both.ids).all()


# ---- 12: fingerprints


def vector(text):
    """The sum of the paragraphs' vectors, lane by lane."""
    chain = lambda words: [h := 42] and [h := xxhash.xxh64_intdigest(w.encode(), h) for w in words][-1]
    out = [0] * (fingerprints.EXACT + fingerprints.LIKE)
    for line in filter(None, (text or "").split("\n")):
        for k in range(4):
            h = chain([str(k), line])
            out[2 * k] += h & 0xFFFFFFFF
            out[2 * k + 1] += h >> 32
        w = plain.words(line)
        for run in [w[i : i + 3] for i in range(len(w) - 2)] or ([w] if w else []):
            one = chain(run)
            two = xxhash.xxh64_intdigest(one.to_bytes(8, "little"), 42)
            for b in range(64):
                out[8 + b] += 1 if one >> b & 1 else -1
                out[72 + b] += 1 if two >> b & 1 else -1
    return [x % (1 << 32) for x in out]


def like(a, b):
    x, y = ([v - (1 << 32) if v >> 31 else v for v in z[8:]] for z in (a, b))
    n = math.sqrt(sum(v * v for v in x) * sum(v * v for v in y))
    return 1.0 if a == b else 0.0 if not n else max(0.0, min(1.0, sum(p * q for p, q in zip(x, y, strict=True)) / n))


def edited(docs):
    """docs: distinct (id, text), in order. (id, text) -> (edited text, next text)."""
    out = {}
    for k, (i, t) in enumerate(docs):
        after = docs[(k + 1) % len(docs)][1]
        q = len(t) // 4
        out[i, t] = (t[: len(t) - q] + after[:q], after)
    return out


def hexed(lanes):
    return "".join(f"{x:08x}" for x in lanes)


@pytest.fixture(scope="module")
def edits(spark):
    rng = random.Random(3)
    line = lambda: " ".join(f"w{rng.randrange(60)}" for _ in range(rng.randrange(12)))
    texts = ["\n".join(line() for _ in range(rng.randrange(1, 9))) for _ in range(60)]
    texts += ["", "a", "ab cd", "näïve 😀 " * 9, "\n\n", " \n\t", "x\n" * 50, " ".join(f"v{k}" for k in range(4000)), texts[5], texts[5]]
    rng.shuffle(texts)
    return list(enumerate(texts))


def test_edits(spark, edits):
    rows = [(i, t) for i, t in edits]
    df = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, _k string").repartition(5)
    want = edited(rows)
    got = fingerprints.edits(df).select("*", fingerprints.likeness(F.col("_lanes"), F.col("_edited_lanes")).alias("near"), fingerprints.likeness(F.col("_lanes"), F.col("_next_lanes")).alias("next")).collect()
    assert len(got) == len(rows)
    by = dict(rows)
    for r in got:
        new, after = want[r._id, by[r._id]]
        assert r.n_chars == len(by[r._id]) and r.edited_sha256 == plain.sha(new)
        assert (r._lanes, r._edited_lanes, r._next_lanes) == (vector(by[r._id]), vector(new), vector(after))
        assert abs(r.near - like(vector(by[r._id]), vector(new))) < 1e-9 and abs(r.next - like(vector(by[r._id]), vector(after))) < 1e-9


def test_edits_of_odd_rows(spark):
    rows = [(None, "no id here at all"), (3, None), (3, "tied id, four words"), (7, "same row twice"), (7, "same row twice"), (9, "the end")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((r._id is None, r._id, r.n_chars, r.edited_sha256) for r in fingerprints.edits(df).collect())
    known = [(i, t or "") for i, t in dict.fromkeys(rows)]
    for tied in permutations([(3, ""), (3, "tied id, four words")]):
        order = [*tied, *[x for x in known if x[0] in (7, 9)], known[0]]
        want = edited(order)
        if got == sorted((i is None, i, len(t or ""), plain.sha(want[i, t or ""][0])) for i, t in rows):
            break
    else:
        raise AssertionError(got)
    assert fingerprints.edits(df.limit(0)).count() == 0
    one = fingerprints.edits(df.where("doc_id = 9")).first()
    assert one.edited_sha256 == plain.sha("the ent") and one._next_lanes == one._lanes


def test_fingerprints(spark, edits):
    df = spark.createDataFrame([*edits, (None, None)], "doc_id long, text string")
    want = {i: vector(t) for i, t in [*edits, (None, None)]}
    assert {r._id: r._lanes for r in fingerprints.fingerprints(df).collect()} == want
    by = dict(edits)
    pieces = spark.createDataFrame([(1, "one two three four\nfive six", "five six\n\none two three four")], "id int, a string, b string")
    made = [fingerprints.fingerprints(pieces, text=c, doc_id="id").first()._lanes for c in ("a", "b")]
    assert made[0] == made[1] != vector("one two three four")
    row = spark.createDataFrame([(made[0], vector("five six"), vector("more"))], "a array<bigint>, b array<bigint>, c array<bigint>")
    less, back, more, none = row.select(fingerprints.minus(F.col("a"), F.col("b")), fingerprints.plus(fingerprints.minus(F.col("a"), F.col("b")), F.col("b")), fingerprints.plus(F.col("a"), F.col("c")), fingerprints.minus(F.col("a"), F.col("a")) == fingerprints.nothing()).first()
    assert less == vector("one two three four") and back == made[0] and more == vector("one two three four\nfive six\nmore") and none
    assert fingerprints.fingerprints(df.limit(0)).count() == 0 and len(by) == len(edits)


def test_likeness_follows_what_is_shared(spark):
    rng = random.Random(8)
    word = lambda: f"w{rng.randrange(5000)}"
    base = [" ".join(word() for _ in range(20)) for _ in range(20)]
    texts = ["\n".join(base[:k] + [" ".join(word() for _ in range(20)) for _ in range(20 - k)]) for k in range(0, 21, 2)]
    rows = spark.createDataFrame([(vector("\n".join(base)), vector(t), k / 10) for k, t in enumerate(texts)], "a array<bigint>, b array<bigint>, want double")
    for r in rows.select("want", fingerprints.likeness(F.col("a"), F.col("b")).alias("got")).collect():
        assert abs(r.want - r.got) < 0.2


# ---- 13: audit


def audited(docs, labels):
    """docs: (id, text, source). A dictionary (part, order, step) -> the seven counts."""

    def failed(i, t):
        w = plain.words(t)
        out = "A" if len(w) < 50 else ""
        out += "B" if 100 * len(set(w)) < 65 * len(w) else ""
        out += "C" if 100 * len(re.findall("[A-Z]", t)) > 5 * len(t) else ""
        out += "D" if re.search(r"[#$%&*|]", t) else ""
        return out + ("E" if i is not None and any(j is not None and j < i and (u or "") == t for j, u, _ in docs) else "")

    each = [(s or "", failed(i, t or ""), any(a == i and q == 1 for a, q, _ in labels if a is not None), any(a == i and x == 1 for a, _, x in labels if a is not None)) for i, t, s in docs]
    out = {}
    for p in {e[0] for e in each}:
        mine, total = [e for e in each if e[0] == p], dict.fromkeys("ABCDE", 0)
        for order in map("".join, permutations("ABCDE")):
            for k, f in enumerate(order):
                removed = [e for e in mine if f in e[1] and not set(e[1]) & set(order[:k])]
                total[f] += len(removed)
                kept = sum(not set(e[1]) & set(order[: k + 1]) for e in mine)
                redundant = sum(f in e[1] for e in mine) - len(removed)
                out[p, order, k + 1] = [kept, len(removed), redundant, sum(e[1] == f for e in mine), sum(e[2] for e in removed), sum(e[3] for e in removed)]
        for key, v in out.items():
            if key[0] == p:
                v.append(total[key[1][key[2] - 1]])
    return {k: tuple(v) for k, v in out.items()}


@pytest.mark.parametrize("hot", [1000, 4])
def test_audit(spark, monkeypatch, hot):
    monkeypatch.setattr(audit, "HOT", hot)  # with 4 the large group of copies is looked up by broadcast
    rng = random.Random(7)
    word = lambda: rng.choice(["a", "b", "Cc", "DDD", "e#", "$", *[f"w{rng.randrange(200)}"] * 6])
    docs = [(k, " ".join(word() for _ in range(rng.choice([0, 5, 49, 50, 80, 200]))), rng.choice(["s", "t", "", None])) for k in range(80)]
    docs += [(100 + k, "a copy of this", "s") for k in range(60)] + [(5, docs[5][1], "t"), (5, "another", "u"), (None, "a copy of this", "s"), (None, None, None), (200, None, "s"), (201, "", "s")]
    labels = [(k, rng.choice([0, 1, None]), rng.choice([0, 1, None])) for k in range(0, 202, 2)] + [(4, 1, 0), (4, 0, 1), (None, 1, 1)]
    df = spark.createDataFrame([(*d, "x") for d in docs], "doc_id long, text string, source string, part string")
    got = audit.audit_filters(df, spark.createDataFrame(labels, "doc_id long, quality int, toxic int")).collect()
    assert {(r.part, r.filter_order, r.step): tuple(r[m] for m in (*audit.MEASURES, "shapley")) for r in got} == audited(docs, labels)
    assert len(got) == 600 * len({d[2] or "" for d in docs})
    assert audit.audit_filters(df.limit(0), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")).count() == 0
