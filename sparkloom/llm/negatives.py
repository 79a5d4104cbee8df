"""Hard negatives: for each anchor and each of its positives, rows of other labels that score almost as high."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import land, only, table

#: Anchors that are multiplied at a time, and candidates: a product is a matrix of this many rows and columns.
ROWS, COLUMNS = 512, 2048
#: Bytes of anchors' vectors that are broadcast at a time, and anchors in such a block at most. More anchors mean more blocks, one after another.
BROADCAST, MOST = 32 << 20, 1 << 15
#: Whole numbers up to here are exact in float64, sums and all.
EXACT = float(1 << 53)
LEAST = -(1 << 63)
POSITIVES, NEGATIVES = 5, 10


def quantised(vectors: pa.Array, scale: int = 256) -> tuple[np.ndarray, np.ndarray]:
    """Which of the vectors (lists of floats, all of one length) are finite, and floor(scale * x) of those, a row each."""
    flat, n = vectors.flatten(), len(vectors)
    x = flat.to_numpy(zero_copy_only=False).astype(np.float64).reshape(n, -1)  # a null is NaN here
    fine = np.isfinite(x).all(1)
    return fine, np.floor(scale * x[fine])


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of a's rows with b's, exactly: in float64, or where that could round, in Python's whole numbers, -inf beyond 64 bits."""
    with np.errstate(over="ignore"):
        most = np.sqrt(np.square(a).sum(1).max(initial=0)) * np.sqrt(np.square(b).sum(1).max(initial=0))
    if most < EXACT:  # by Cauchy and Schwarz no sum on the way is beyond it either
        return a @ b.T
    whole = lambda m: np.array([[int(x) for x in r] for r in m.tolist()], object).reshape(m.shape)
    exact = whole(a).dot(whole(b).T)
    return np.array([[x if LEAST <= x < -LEAST else None for x in r] for r in exact.tolist()], object).reshape(exact.shape)


def best(x: np.ndarray, fit: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows and columns of the k highest of each row of x among those that fit, in falling order; of equal ones the first columns."""
    rows, columns = np.nonzero(fit)
    if x.dtype != object and len(rows) > 4 * k * len(x) and x.shape[1] > k:
        told = np.where(fit, x, -np.inf)
        fit = fit & (x >= np.partition(told, -k, axis=1)[:, -k, None])
        rows, columns = np.nonzero(fit)
    if x.dtype == object:
        order = np.array(sorted(range(len(rows)), key=lambda i: (rows[i], -x[rows[i], columns[i]], columns[i])), np.int64)
    else:
        order = np.lexsort((columns, -x[rows, columns], rows))
    rows, columns = rows[order], columns[order]
    place = np.arange(len(rows)) - np.searchsorted(rows, rows)
    return rows[place < k], columns[place < k]


class Best:
    """The k highest (score, id) of each slot so far; of equal scores the smaller ids. Two of them merge by adding one's rows to the other."""

    def __init__(self, slots: int, k: int):
        self.k, self.n = k, np.zeros(slots, np.int64)
        self.scores, self.ids = np.full((slots, k), LEAST, np.int64), np.zeros((slots, k), np.int64)

    @property
    def floor(self) -> np.ndarray:
        """What a row must reach to count, by slot."""
        return np.where(self.n == self.k, self.scores[:, -1], LEAST)

    def add(self, slots: np.ndarray, scores: np.ndarray, ids: np.ndarray) -> None:
        if not len(slots):
            return
        touched, at = np.unique(slots, return_inverse=True)
        old = np.arange(self.k)[None, :] < self.n[touched][:, None]
        slot = np.concatenate([at, np.nonzero(old)[0]])
        score, id_ = np.concatenate([scores, self.scores[touched][old]]), np.concatenate([ids, self.ids[touched][old]])
        order = np.lexsort((id_, ~score, slot))  # ~score falls as score rises, and cannot overflow
        slot, score, id_ = slot[order], score[order], id_[order]
        place = np.arange(len(slot)) - np.searchsorted(slot, slot)
        kept = place < self.k
        self.scores[touched[slot[kept]], place[kept]] = score[kept]
        self.ids[touched[slot[kept]], place[kept]] = id_[kept]
        self.n[touched] = np.bincount(slot[kept], minlength=len(touched))


def _blocks(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """ids, labels and vectors of candidates with vectors of `size` numbers, COLUMNS at a time, by rising id."""
    for batch in batches:
        for k in range(0, batch.num_rows, COLUMNS):
            b = batch.slice(k, COLUMNS)
            b = b.filter(pc.equal(pc.list_value_length(b.column(2)), size))
            if b.num_rows:
                fine, x = quantised(b.column(2))
                ids, labels = (b.column(c).to_numpy(zero_copy_only=False)[fine] for c in (0, 1))
                order = np.argsort(ids, kind="stable")
                yield ids[order], labels[order], x[order]


def _searched(candidates: DataFrame, anchors: list[tuple], size: int, slots: int, k: int, choose: Callable) -> DataFrame:
    """slot, score and id: each task's best k of each slot, then the best of all tasks. choose(anchor rows, labels, scores, own) yields slots' first number and what fits."""
    spark = candidates.sparkSession
    shared = spark.sparkContext.broadcast(anchors)
    tasks = 3 * spark.sparkContext.defaultParallelism

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, labels, vectors, *own = shared.value
        held = Best(slots, k)
        for id_, label, x in _blocks(batches, size):
            for lo in range(0, len(ids), ROWS):
                hi = min(lo + ROWS, len(ids))
                scores = products(vectors[lo:hi], x)
                known = scores != None if scores.dtype == object else None  # noqa: E711
                for slot, fit in choose(lo, hi, labels[lo:hi, None] == label[None, :], scores, own, held.floor):
                    rows, columns = best(scores, fit if known is None else fit & known, k)
                    held.add(slot[rows], scores[rows, columns].astype(np.int64), id_[columns])
        slot = np.repeat(np.arange(slots), held.n)
        there = np.arange(k)[None, :] < held.n[:, None]
        for at in range(0, max(len(slot), 1), 100_000):
            end = at + 100_000
            yield pa.RecordBatch.from_arrays([pa.array(slot[at:end]), pa.array(held.scores[there][at:end]), pa.array(held.ids[there][at:end])], names=["slot", "score", "id"])

    merged = candidates.coalesce(tasks).mapInArrow(run, "slot bigint, score bigint, id bigint")
    order = Window.partitionBy("slot").orderBy(F.desc("score"), "id")
    return merged.withColumn("place", F.row_number().over(order)).where(F.col("place") <= k)


def _above(scores: np.ndarray, floor: np.ndarray) -> np.ndarray:
    if scores.dtype == object:
        return np.array([[x is not None and x >= f for x in r] for r, f in zip(scores.tolist(), floor.tolist(), strict=True)], bool).reshape(scores.shape)
    return scores >= floor[:, None]


def _positive(lo, hi, same, scores, own, floor):
    yield np.arange(lo, hi), same & _above(scores, floor[lo:hi])


def _negative(low: int, high: int, each: int) -> Callable:
    def choose(lo, hi, same, scores, own, floor):
        bounds, apart = own[0], ~same
        for j in range(each):
            slot = np.arange(lo, hi) * each + j
            least, most = np.maximum(bounds[lo:hi, j, 0], floor[slot]), bounds[lo:hi, j, 1]
            if (least <= most).any():
                yield slot, apart & _above(scores, least) & ~_above(scores, np.minimum(most, -LEAST - 2) + 1)

    return choose


def windows(scores: np.ndarray, low: int, high: int) -> tuple[np.ndarray, np.ndarray]:
    """The least and the greatest whole s with low * score <= 100 * s <= high * score; exact, and an empty window for scores below 0."""
    each = [(-(-low * int(s) // 100), high * int(s) // 100) for s in scores]
    return np.array([a for a, _ in each], np.int64), np.array([b for _, b in each], np.int64)


def mine(
    df: DataFrame, anchors: DataFrame, *, vec_id: str = "vec_id", vector: str = "embedding", label: str = "label",
    positives: int = POSITIVES, negatives: int = NEGATIVES, low: int = 30, high: int = 90, broadcast: int = BROADCAST,
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score and negative_score; both tables have vec_id, vector and label.

    Components count as floor(256 * x). A row's score is its inner product with the anchor's vector: blocks of
    anchors, bounded in bytes, are broadcast, and every task multiplies them in float64 with its candidates
    block by block, exactly. A first pass keeps each anchor's best `positives` other rows of its label, a
    second one, for each of these, the best `negatives` rows of other labels with low * p <= 100 * n <=
    high * p. Tasks keep what is best so far, which merges; so no task holds more than a block of candidates
    and these lists, and of each task at most so many rows an anchor are exchanged. Every candidate meets
    every anchor. Results of a block of anchors are written to the shared folder before the next one begins.

    Equal scores are in the order of ids. Rows with a null id, label, vector or component, or a component
    that is not finite, take no part; rows whose vectors differ in length have no score, nor have those
    whose product is beyond 64 bits. Repeated rows are rows like any other: of an anchor's own id the
    anchor itself alone, one row, is left out, so a copy of it can be its positive, and an anchor that is
    there n times has its results n times. An anchor without positives, or with none in a window, has no
    rows; an empty table gives an empty result. Other columns are not read, so their names cannot clash.
    """
    spark = df.sparkSession

    def of(rows: DataFrame) -> DataFrame:
        given = only(rows, id=vec_id, label=label, v=vector).select(F.col("id").cast("long"), F.col("label").cast("long"), F.col("v").cast("array<double>"))
        return given.where("id IS NOT NULL AND label IS NOT NULL AND v IS NOT NULL")

    candidates = of(df)
    finite = ~F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    distinct = land(of(anchors).where(finite).groupBy("id", "label", "v").agg(F.count(F.lit(1)).alias("times")).withColumn("size", F.size("v")))
    sizes = distinct.groupBy("size").agg(F.count(F.lit(1)).alias("n")).orderBy("size").collect()  # one row for each length of vectors
    schema = "anchor_id bigint, positive_id bigint, rank int, negative_id bigint, positive_score bigint, negative_score bigint"
    out = spark.createDataFrame([], schema)
    for size, n in sizes:
        most = max(1, min(MOST, broadcast // (8 * max(size, 1))))
        blocks = -(-2 * n // most) if n > most else 1  # by hash, so that a block is half of the most on average
        number = F.pmod(F.xxhash64("id", "label", "v"), F.lit(blocks))
        for block in range(blocks):
            got = distinct.where((F.col("size") == size) & (number == block)).orderBy("id", "label", "v").toPandas()
            ids, labels = got["id"].to_numpy(np.int64), got["label"].to_numpy(np.int64)
            vectors = np.floor(256 * np.array(got["v"].tolist(), np.float64).reshape(len(got), size))
            # The anchor itself is among the best of its own label or beaten by all of them: one more is kept, and it is taken out.
            first = _searched(candidates, (ids, labels, vectors), size, len(ids), positives + 1, _positive).toPandas().sort_values(["slot", "place"])
            own = [products(vectors[k : k + 1], vectors[k : k + 1])[0, 0] for k in range(len(ids))]
            slot, score, id_ = (first[c].to_numpy(np.int64) for c in ("slot", "score", "id"))
            self_ = np.array([i == ids[s] and x == own[s] for s, x, i in zip(slot, score, id_, strict=True)], bool)
            gone, at = np.zeros(len(slot), bool), np.flatnonzero(self_)
            gone[at[np.unique(slot[at], return_index=True)[1]]] = True
            slot, score, id_ = slot[~gone], score[~gone], id_[~gone]
            place = np.arange(len(slot)) - np.searchsorted(slot, slot)
            slot, score, id_, place = (x[place < positives] for x in (slot, score, id_, place))
            bounds = np.zeros((len(ids), positives, 2), np.int64)
            bounds[..., 0], bounds[..., 1] = -LEAST - 1, LEAST + 1  # nothing fits
            bounds[slot, place, 0], bounds[slot, place, 1] = windows(score, low, high)
            told = spark.createDataFrame(
                pa.table({"slot": slot * positives + place, "anchor_id": ids[slot], "positive_id": id_, "positive_score": score, "times": got["times"].to_numpy(np.int64)[slot]})
            )
            second = _searched(candidates, (ids, labels, vectors, bounds), size, len(ids) * positives, negatives, _negative(low, high, positives))
            rows = second.join(F.broadcast(told), "slot").select(
                "anchor_id", "positive_id", F.col("place").cast("int").alias("rank"), F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"), "times"
            )
            again = rows.withColumn("_again", F.explode(F.sequence(F.lit(1), F.col("times").cast("int")))) if (got["times"] > 1).any() else rows
            out = out.unionByName(land(again.select(*out.columns)))
    return out


def op11_hard_negatives(spark, sf_dir):
    rows = table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label").cast("long") + 1) % 10).otherwise(F.col("label"))
    rows = rows.withColumn("label", label)
    return mine(rows, rows.where(F.col("vec_id") % 100 == 0))


OP11_SQL = """
WITH e AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, embedding FROM embeddings
           WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len([1 FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
v AS (SELECT vec_id, label, [floor(256 * CAST(x AS DOUBLE)) FOR x IN embedding] AS v FROM e),
s AS (SELECT a.vec_id AS anchor_id, b.vec_id AS id, a.label = b.label AS same, CAST(list_inner_product(a.v, b.v) AS BIGINT) AS score
      FROM v a, v b WHERE a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
p AS (SELECT anchor_id, id AS positive_id, score AS positive_score FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5)
SELECT anchor_id, positive_id, CAST(row_number() OVER w AS INT) AS rank, id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s USING (anchor_id) WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
WINDOW w AS (PARTITION BY anchor_id, positive_id ORDER BY score DESC, id) QUALIFY row_number() OVER w <= 10
"""
