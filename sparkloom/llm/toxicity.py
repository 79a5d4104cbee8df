"""Toxicity by logistic regression over hashed word n-grams, learned with FTRL-proximal steps."""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import chain
from multiprocessing.pool import ThreadPool
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.shared import Scratch
from .common import few, land, only, scratch, short_batches, table, tidy, whole

BITS = 22
#: Labelled documents that the model is fitted on at most: the first in the order of a hash of their ids.
MOST_LABELLED = 24_000
#: Of these, one in FOLDS only sets the slope and the threshold of the score.
FOLDS = 5
#: Parts of the others that learn side by side, times that their states are averaged and taken up again, and times that a part reads its documents between.
SHARDS, ROUNDS, EPOCHS = 4, 3, 3
#: Chosen by fourfold cross-validation over training rows of the smallest tables alone, with SEEN, ROUNDS, EPOCHS and BEGINNINGS.
ALPHA, BETA, L1, L2 = 2.0, 1.0, 3.0, 1.0
#: Documents of the sample that must have a feature before it gets a weight: what one text and its copies have tells nothing of others.
SEEN = 4
#: Characters of the beginnings of words that are features too, for languages that put words together.
BEGINNINGS = (2, 3, 4, 5, 6)
#: Words that a worker remembers, and characters that it takes features of at a time (a longer text alone).
REMEMBERED, AT_ONCE = 250_000, 1 << 20
_SPACED = bytes(c if chr(c).isalnum() or c >= 128 else 32 for c in range(256))
_MIX = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5, 0x85EBCA77C2B2AE63)]


class Words(dict):
    """Numbers of words, and by these their hashes and the buckets of their beginnings. kept: a flag for each bucket, if only some are of use."""

    def __init__(self, kept: np.ndarray | None = None):
        self.kept = kept
        self.forget()

    def forget(self) -> None:
        self.clear()
        self.new: list[bytes] = []
        self.hashes, self.starts, self.ends = np.zeros(0, np.uint64), np.zeros(0, np.int32), np.zeros(1, np.int64)

    def __missing__(self, word: bytes) -> int:
        self[word] = k = len(self)
        self.new.append(word)
        return k

    def numbers(self, words: list[bytes]) -> np.ndarray:
        """The words' numbers, valid until the next call: then a worker that remembers too many starts anew."""
        if len(self) > REMEMBERED:
            self.forget()
        found = np.fromiter(map(self.__getitem__, words), np.int64, len(words))
        if self.new:
            own = [beginnings(w) for w in self.new]
            starts = np.fromiter(chain.from_iterable(own), np.int32)
            sizes = np.fromiter(map(len, own), np.int64, len(own))
            if self.kept is not None:
                use = self.kept[starts]
                sizes = np.bincount(np.repeat(np.arange(len(own)), sizes)[use], minlength=len(own))
                starts = starts[use]
            self.hashes = np.concatenate([self.hashes, np.fromiter((xxhash.xxh64_intdigest(w, 0) for w in self.new), np.uint64, len(own))])
            self.starts = np.concatenate([self.starts, starts])
            self.ends = np.concatenate([self.ends, self.ends[-1] + np.cumsum(sizes)])
            self.new = []
        return found


def beginnings(word: bytes) -> list[int]:
    """The buckets of a word's beginnings that are shorter than the word."""
    start = word[:64].decode("utf-8", "replace")
    return [xxhash.xxh64_intdigest(start[:n].encode(), n) >> (64 - BITS) for n in BEGINNINGS if len(start) > n]


def features(texts: list[str], known: Words) -> tuple[np.ndarray, np.ndarray]:
    """Places of texts and buckets, each pair once and in order: words, pairs of neighbours, pairs with one word between, beginnings of words."""
    words = [t.encode().lower().translate(_SPACED).split() for t in texts]
    doc = np.repeat(np.arange(len(texts)), np.fromiter(map(len, words), np.int64, len(words)))
    number = known.numbers(list(chain.from_iterable(words)))
    h = known.hashes[number]
    two, three = doc[1:] == doc[:-1], doc[2:] == doc[:-2]
    each = [(doc, h * _MIX[0]), (doc[1:][two], (h[:-1] * _MIX[1] + h[1:] * _MIX[2])[two]), (doc[2:][three], (h[:-2] * _MIX[3] + h[2:] * _MIX[4])[three])]
    found = []
    for d, x in each:
        at = (x >> np.uint64(64 - BITS)).astype(np.int64)
        if known.kept is not None:
            use = known.kept[at]
            d, at = d[use], at[use]
        found.append(d << BITS | at)
    begun = known.ends[number + 1] > known.ends[number]
    once = np.unique(doc[begun] * len(known) + number[begun])
    if len(once):
        d, number = np.divmod(once, len(known))
        n = known.ends[number + 1] - known.ends[number]
        at = np.arange(n.sum()) + np.repeat(known.ends[number] - np.cumsum(n) + n, n)
        found.append(np.repeat(d, n) << BITS | known.starts[at])
    pairs = np.unique(np.concatenate(found))
    return pairs >> BITS, (pairs & ((1 << BITS) - 1)).astype(np.int32)


def _some(texts: pa.Array) -> Iterator[list[str]]:
    """The texts in turn, so many at a time that they have AT_ONCE characters or one is longer."""
    held, size = [], 0
    for t in texts.to_pylist():
        if held and size + len(t) > AT_ONCE:
            yield held
            held, size = [], 0
        held.append(t)
        size += len(t)
    if held:
        yield held


class Model(NamedTuple):
    offset: float
    a: float
    b: float
    at: np.ndarray
    weights: np.ndarray


class Ftrl:
    """FTRL-proximal over some coordinates: each has its own rate, and L1 leaves most weights at zero. The last coordinate is the intercept, in every text."""

    def __init__(self, offset: float, z: np.ndarray, n: np.ndarray):
        self.offset, self.z, self.n = offset, z, n

    def weights(self, at: np.ndarray) -> np.ndarray:
        z, l1 = self.z[at], np.where(at == len(self.z) - 1, 0.0, L1)
        return np.where(np.abs(z) <= l1, 0.0, (np.sign(z) * l1 - z) / ((BETA + np.sqrt(self.n[at])) / ALPHA + L2))

    def learn(self, x: np.ndarray, y: float) -> None:
        at = np.append(x, len(self.z) - 1)
        w = self.weights(at)
        g = 1 / (1 + math.exp(-max(-35.0, min(35.0, self.offset + w.sum())))) - y
        n = self.n[at]
        self.z[at] += g - (np.sqrt(n + g * g) - np.sqrt(n)) / ALPHA * w
        self.n[at] = n + g * g


def _learner(offset: float, state, epochs: int):
    """What a shard's documents add to the state (buckets, z, n), by bucket. Buckets are numbered anew, so that a task holds those of its own documents alone."""

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pa.default_memory_pool().release_unused()  # what the worker's tasks before left there
        held = [b for b in batches if b.num_rows]
        if not held:
            return
        rows = pa.Table.from_batches(held)
        turn = pc.sort_indices(rows.select(["_order", "_id"]), sort_keys=[("_order", "ascending"), ("_id", "ascending")]).to_numpy()
        x = rows.column("_x").combine_chunks()
        ends = np.cumsum(x.value_lengths().to_numpy(zero_copy_only=False))
        x, y = x.flatten().to_numpy(), rows.column("toxic").to_numpy()[turn].tolist()
        number = np.full((1 << BITS) + 1, -1, np.int32)
        number[x] = number[1 << BITS] = 0
        own = np.flatnonzero(number == 0).astype(np.int32)
        number[own] = np.arange(len(own), dtype=np.int32)
        x = number[x]
        each = [x[(ends[k - 1] if k else 0) : ends[k]] for k in turn.tolist()]
        z, n = np.zeros(len(own)), np.zeros(len(own))
        at, z0, n0 = state.value
        here = number[at]
        there = here >= 0
        z[here[there]], n[here[there]] = z0[there], n0[there]
        del held, rows, number, here, there
        model = Ftrl(offset, z.copy(), n.copy())
        for _ in range(epochs):
            for one, label in zip(each, y, strict=True):
                model.learn(one, float(label))
        out = pa.RecordBatch.from_arrays([pa.array(own), pa.array(model.z - z), pa.array(model.n - n)], names=["at", "z", "n"])
        yield from few([out], 100_000)

    return learn


def learned(parts: DataFrame, marks: np.ndarray, offset: float, *, shards: int, rounds: int, epochs: int) -> tuple[np.ndarray, np.ndarray]:
    """Buckets and weights that are not zero, of rows _id, _order, toxic, _x, whose buckets have a bit in marks.

    A round's shards all start from one state and each reads its own documents `epochs` times, in the order of
    a hash; what they add to z and n is averaged by bucket. A mean has a shard's worth of gradients, so L1 is
    half of what suits one learner of all. Documents are dealt to shards once, into folders that their tasks
    write without an exchange, and each round reads every shard where it lies. What the shards add comes back
    to the driver one shard after another, 20 bytes for each of its buckets, so that the driver holds one of them
    at a time, and the same rows give the same weights. The driver holds the buckets in marks alone, 2**BITS at most.
    """
    spark = parts.sparkSession
    buckets = np.append(np.flatnonzero(np.unpackbits(marks, bitorder="little")), 1 << BITS).astype(np.int32)
    z, n = np.zeros(len(buckets)), np.zeros(len(buckets))
    dealt = land(parts.withColumn("shard", F.pmod("_order", F.lit(shards)).cast("int")), "shard")
    for _ in range(rounds):
        at = np.flatnonzero(n)
        state = spark.sparkContext.broadcast((buckets[at], z[at], n[at]))
        learn = _learner(offset, state, epochs)

        def one(k: int) -> DataFrame:
            return made.land(dealt.where(F.col("shard") == k).drop("shard").coalesce(1).mapInArrow(learn, "at int, z double, n double"))  # noqa: B023

        with Scratch(spark) as made:
            with ThreadPool(shards) as pool:  # a job for each shard: a union of single partitions would be one task
                tables = pool.map(inheritable_thread_target(spark)(one), range(shards))
            for table_ in tables:
                added = table_.toArrow()
                own = np.searchsorted(buckets, added.column("at").to_numpy())
                z[own] += added.column("z").to_numpy() / shards
                n[own] += added.column("n").to_numpy() / shards
                del added, own
        state.destroy()
        tidy(spark)
    at = np.flatnonzero(n)
    w = Ftrl(offset, z, n).weights(at)
    return buckets[at[w != 0]], w[w != 0]


def _hashed(labelled: DataFrame) -> DataFrame:
    """_id, _order, toxic and _x, the buckets of the text: where texts are read, so that only numbers are exchanged."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Words()
        for b in few(batches, 200):
            made, sizes = [np.zeros(0, np.int32)], []
            for texts in _some(b.column(3)):
                doc, at = features(texts, known)
                made.append(at)
                sizes.append(np.bincount(doc, minlength=len(texts)))
            ends = np.concatenate([[0], np.cumsum(np.concatenate(sizes))]).astype(np.int32)
            yield pa.RecordBatch.from_arrays([*b.columns[:3], pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(made)))], names=["_id", "_order", "toxic", "_x"])

    given = labelled.select(F.col("doc_id").alias("_id"), F.xxhash64("doc_id").alias("_order"), "toxic", whole("text").alias("_t"))
    kind = given.schema["_id"].dataType.simpleString()
    return given.mapInArrow(run, f"_id {kind}, _order bigint, toxic int, _x array<int>")


def _counted(rows: DataFrame) -> DataFrame:
    """at and n: how many rows have each bucket in _x. Each task counts into one table of 2**BITS numbers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = np.zeros(1 << BITS, np.int32)
        for b in few(batches, 200):
            for x in b.column(0):
                if x.is_valid:
                    n[np.asarray(x.values, np.int32)] += 1  # a row has a bucket once
        at = np.flatnonzero(n).astype(np.int32)
        for k in range(0, len(at), 100_000):
            some = at[k : k + 100_000]
            yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(n[some])], names=["at", "n"])

    return rows.select("_x").mapInArrow(run, "at int, n int").groupBy("at").agg(F.sum("n").alias("n"))


def _marks(buckets: DataFrame) -> np.ndarray:
    """A bit for each of the 2**BITS buckets, set for those in `at`."""
    words = buckets.groupBy(F.shiftright("at", 6).alias("k")).agg(F.bit_or(F.expr("shiftleft(1L, at & 63)")).alias("bits"))
    got = words.select(F.collect_list("k").alias("k"), F.collect_list("bits").alias("bits")).first()  # 2**BITS / 64 at most
    marks = np.zeros(1 << (BITS - 6), np.int64)
    marks[np.array(got.k, np.int64)] = np.array(got.bits, np.int64)
    return marks.astype("<i8").view(np.uint8)


def _pruned(rows: DataFrame, marks: np.ndarray) -> DataFrame:
    """rows with the buckets of _x that are marked alone. Of buckets there are 2**BITS, so a bit for each is broadcast."""
    shared = rows.sparkSession.sparkContext.broadcast(marks)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = np.unpackbits(shared.value, bitorder="little").astype(bool)
        for b in few(batches, 200):
            made = [x[kept[x]] for x in (np.asarray(y.values, np.int32) if y.is_valid else np.zeros(0, np.int32) for y in b.column(3))]
            yield pa.RecordBatch.from_arrays([*b.columns[:3], pa.array(made, pa.list_(pa.int32()))], names=["_id", "_order", "toxic", "_x"])

    return rows.mapInArrow(run, rows.schema)


def slope(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """a and b of the logistic curve a * x + b that fits labels y best, by Newton steps with a weak pull to 1 and 0."""
    a, b = 1.0, 0.0
    for _ in range(40):
        p = 1 / (1 + np.exp(-np.clip(a * x + b, -35, 35)))
        v, g = np.maximum(p * (1 - p), 1e-9), p - y
        down = np.linalg.solve([[(v * x * x).sum() + 0.01, (v * x).sum()], [(v * x).sum(), v.sum() + 0.001]], [(g * x).sum() + 0.01 * (a - 1), g.sum() + 0.001 * b])
        a, b = a - float(np.clip(down[0], -1, 1)), b - float(np.clip(down[1], -1, 1))
    return a, b


def fit(labelled: DataFrame, *, shards: int = SHARDS, rounds: int = ROUNDS, epochs: int = EPOCHS) -> Model:
    """The model of labelled (doc_id, text, toxic): a bounded sample, read once.

    The offset is the log odds of the share of label 1, shrunk towards a tenth. Buckets that fewer than SEEN
    documents of the learning folds have are left out; see `learned` for the rest. Buckets, not documents, come
    back to the driver, 2**BITS at most. A fold that has taken no part then sets slope and threshold; without
    both labels there they stay 1 and 0. Repeated rows count each; an empty table gives the model of a tenth.
    A long text costs its length where it is read and 2**BITS buckets at most where it is learned from. Other
    columns are not read.
    """
    short_batches(labelled.sparkSession)
    rows = land(_hashed(labelled))
    n, k = rows.agg(F.count(F.lit(1)), F.coalesce(F.sum("toxic"), F.lit(0))).first()
    rate = (k + 0.5) / (n + 5)
    offset = math.log(rate / (1 - rate))
    if not n:
        return Model(offset, 1.0, 0.0, np.zeros(0, np.int64), np.zeros(0))
    fold = F.pmod(F.shiftright("_order", 20), F.lit(FOLDS)) == 0
    learning = rows.where(~fold)
    marks = _marks(_counted(learning).where(F.col("n") >= SEEN).select("at"))
    tidy(labelled.sparkSession)
    plain = Model(offset, 1.0, 0.0, *learned(_pruned(learning, marks), marks, offset, shards=shards, rounds=rounds, epochs=epochs))
    told = _told(rows.where(fold), plain).orderBy("_m", "toxic").toArrow()
    m, toxic = (told.column(k).to_numpy().astype(float) for k in ("_m", "toxic"))
    if len(np.unique(toxic)) < 2:
        return plain
    return plain._replace(**dict(zip("ab", slope(m, toxic), strict=True)))


def _told(rows: DataFrame, model: Model) -> DataFrame:
    """_m, the log odds by a plain model, and toxic of rows with buckets _x."""
    shared = rows.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        dense, base = weighed(shared.value)
        for b in few(batches, 200):
            m = [base + float(dense[np.asarray(x.values, np.int32)].sum(dtype=np.float64)) if x.is_valid else base for x in b.column(0)]
            yield pa.RecordBatch.from_arrays([pa.array(m, pa.float64()), b.column(1)], names=["_m", "toxic"])

    return rows.select("_x", "toxic").mapInArrow(run, "_m double, toxic int")


def weighed(model: Model) -> tuple[np.ndarray, float]:
    """A weight for each bucket, and what every text has."""
    dense = np.zeros((1 << BITS) + 1, np.float32)
    dense[model.at] = model.weights
    return dense, model.offset + float(dense[-1])


def labelled_sample(docs: DataFrame, labels: DataFrame, *, most: int = MOST_LABELLED, text: str = "text", doc_id: str = "doc_id", label: str = "toxic") -> DataFrame:
    """doc_id, text and toxic of at most `most` documents that have a label: those whose ids hash lowest.

    An id that several labels have is toxic if one says so; one that several documents have lends its least
    text, and so do repeated rows. Null ids and null labels teach nothing; a null text is an empty one. A long
    text costs its length; of an empty table, or without labels, nothing is left. Other columns are not read,
    so their names cannot clash.
    """
    known = only(labels, _id=doc_id, _l=label).where("_l IS NOT NULL AND _id IS NOT NULL").groupBy("_id").agg((F.max("_l") > 0).cast("int").alias("toxic"))
    rows = only(docs, doc_id=doc_id, text=text).select("doc_id", whole("text").alias("text"))
    ids = rows.select(F.col("doc_id").alias("_id")).join(known, "_id").groupBy("_id").agg(F.max("toxic").alias("toxic"))
    chosen = ids.orderBy(F.xxhash64("_id"), "_id").limit(most)  # at most `most` pairs of numbers: broadcast
    return rows.join(F.broadcast(chosen), F.col("doc_id") == F.col("_id")).groupBy("doc_id").agg(F.min("text").alias("text"), F.max("toxic").alias("toxic"))


def margins(df: DataFrame, model: Model, *, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """_id and _x, the log odds, for each row, repeated ones too. A null or empty text has the intercept's.

    An empty table gives an empty result, a long text costs its length, and there is no exchange. Other
    columns are not read, so their names cannot clash.
    """
    shared = df.sparkSession.sparkContext.broadcast(model)
    given = only(df, _id=doc_id, _t=text).select("_id", whole("_t").alias("_t"))
    kind = given.schema["_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        dense, base = weighed(m)
        known = Words(dense != 0)
        for b in few(batches):
            each = [np.zeros(0)]
            for texts in _some(b.column(1)):
                doc, at = features(texts, known)
                each.append(np.bincount(doc, weights=dense[at], minlength=len(texts)))
            x = base + np.concatenate(each)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(m.a * x + m.b)], names=["_id", "_x"])

    return given.mapInArrow(run, f"_id {kind}, _x double")


def score(df: DataFrame, model: Model, *, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """_id and score, 0 to 1, for each row of df."""
    return margins(df, model, text=text, doc_id=doc_id).select("_id", (1 / (1 + F.exp(-F.greatest(F.least("_x", F.lit(35.0)), F.lit(-35.0))))).alias("score"))


def op6_toxicity(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    part = lambda c: F.coalesce(F.crc32(c.cast("string").cast("binary")) % 5, F.lit(0))
    labels = table(spark, sf_dir, "labels").select("doc_id", "toxic").where(part(F.col("doc_id")) != 0)
    with scratch(spark):  # the model alone comes out of it
        model = fit(labelled_sample(docs, labels))
    return score(docs, model).select(F.col("_id").alias("doc_id"), (part(F.col("_id")) == 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
