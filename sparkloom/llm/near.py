"""Groups of texts whose sets of word shingles are alike, found without loss."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut, few, if_small, land, only, opened, scratch, short_batches, whole
from .simhash import SEED, connected, first_of_groups, majority
from .simhash import links as simhash_links

#: Shingles that a task counts at a time, and how many of the most frequent all tasks are told.
AT_ONCE, MOST_OFTEN = 1 << 21, 1 << 18
#: Keys that several sets have, 8 bytes each, which are broadcast at most.
MOST_SHARED = 1 << 22
#: Rounds in which texts are compared with one text of each key before all that are still apart are.
HUBS = 2


def hashes(text: bytes, words: int = 5) -> np.ndarray:
    """The hashes of the text's runs of `words` words, repeats included; a shorter text is one run. No words: none."""
    tokens = text.lower().split()  # of bytes, as fingerprints take them
    if not tokens:
        return np.zeros(0, np.uint64)
    joined = b" ".join(tokens)
    ends = np.cumsum(np.fromiter(map(len, tokens), np.int64, len(tokens)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    n = max(len(tokens) - words + 1, 1)
    h = xxhash.xxh64_intdigest
    return np.fromiter((h(joined[a:b], SEED) for a, b in zip(starts[:n].tolist(), ends[-n:].tolist(), strict=True)), np.uint64, n)


def shingles(text: bytes, words: int = 5) -> np.ndarray:
    """The distinct hashes, sorted."""
    return np.unique(hashes(text, words).view(np.int64))


def prefix(own: np.ndarray, often: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """The first n - ceil(0.8 n) + 1 of n shingles, frequent ones last: sets with a similarity of 0.8 share one of these."""
    n = len(own)
    if len(often):
        at = np.minimum(np.searchsorted(often, own), len(often) - 1)
        late = often[at] == own
        own = np.concatenate([own[~late], own[late][np.argsort(rank[at[late]])]])
    return own[: n - (4 * n + 4) // 5 + 1]


def alike(shared: Column, n: Column, m: Column) -> Column:
    """Whether sets of n and m shingles, of which they share some, have a Jaccard similarity of 0.8 or more, in whole numbers."""
    return 9 * shared >= 4 * (n + m)


def sketch(own: np.ndarray) -> bytes:
    """A set of hashes as parities: bit k is that of the number of hashes that end in k, two bits or more for each hash."""
    size = max(64, 1 << (2 * len(own) - 1).bit_length()) if len(own) else 64
    return np.packbits((np.bincount(own.view(np.uint64).astype(np.int64) & (size - 1), minlength=size) & 1).astype(np.uint8), bitorder="little").tobytes()


def differ(a: bytes, b: bytes) -> int:
    """A number that at least as many hashes are in one of two sets alone: each of them turns one bit of the sketches, the larger folded to the smaller's size."""
    x, y, m, n = int.from_bytes(a, "little"), int.from_bytes(b, "little"), 8 * len(a), 8 * len(b)
    while m != n:
        if m < n:
            x, y, m, n = y, x, n, m
        m //= 2
        x = (x >> m) ^ (x & ((1 << m) - 1))
    return (x ^ y).bit_count()


def _unlike(pairs: DataFrame, sketches: DataFrame) -> DataFrame:
    """pairs _a, _b without those whose sketches alone rule 0.8 out: then more than a ninth of n + m shingles differ."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            each = zip(*[b.column(k).to_pylist() for k in range(2, 6)], strict=True)
            yield b.select([0, 1]).filter(pa.array([9 * differ(x, y) <= n + m for n, m, x, y in each], pa.bool_()))

    named = lambda k: sketches.select(F.col("_node").alias(f"_{k}"), F.col("_n").alias(f"_n{k}"), F.col("_sketch").alias(f"_s{k}"))
    both = pairs.join(named("a"), "_a").join(named("b"), "_b")
    return both.select("_a", "_b", "_na", "_nb", "_sa", "_sb").mapInArrow(run, "_a bigint, _b bigint")


def _frequent(docs: DataFrame, words: int) -> tuple[np.ndarray, np.ndarray]:
    """Shingles that many texts hold, sorted, and their ranks by counts. They only order what is compared, and leave nothing out.

    All texts are counted, by blocks of about AT_ONCE shingles; of a block only what several texts hold goes on,
    so what the counts miss are shingles that are rare everywhere.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out() -> pa.RecordBatch:
            found, n = np.unique(np.concatenate(held), return_counts=True)
            return pa.RecordBatch.from_arrays([pa.array(found[n > 1]), pa.array(n[n > 1].astype(np.int64))], names=["h", "n"])

        held, size = [np.zeros(0, np.int64)], 0
        for b in few(batches):
            for t in b.column(0).to_pylist():
                held.append(shingles(t.encode(), words))
                size += len(held[-1])
                if size >= AT_ONCE:
                    yield out()
                    held, size = [np.zeros(0, np.int64)], 0
        yield out()

    counts = docs.select("_t").mapInArrow(run, "h bigint, n bigint").groupBy("h").agg(F.sum("n").alias("n"))
    got = counts.orderBy(F.desc("n"), "h").limit(MOST_OFTEN).toPandas()
    h = got["h"].to_numpy(np.int64)
    order = np.argsort(h)
    return h[order], (len(h) - order).astype(np.int64)


def group_by_shingles(df: DataFrame, *, text: str = "text", doc_id: str = "doc_id", words: int = 5, radius: int = 4) -> DataFrame:
    """_id, _th and component_id, the smallest id reached over pairs with a Jaccard similarity of 0.8 or more, for each row.

    SimHash fingerprints of the shingles, `radius` bits apart, name the first pairs to compare; most pairs of 0.8
    are further apart than that (their cosine of 0.89 leaves ten of 64 bits to differ), so a way without loss
    handles the rest. Exact but for collisions of 64-bit hashes of shingles and of sets: texts with equal sets are one node; nodes meet
    by the keys of their prefixes, which any pair of 0.8 shares. Of the pairs that meet, those go on whose
    sketches, two bits for each shingle, leave 0.8 possible, and only of what is left whole sets are read and compared.
    So that a key with many nodes does not make all their pairs, its nodes are first compared with one of
    them, the smallest and then any, in HUBS rounds; then pairs of nodes that share a key and do not hang
    together yet. A pair counts at a key only if what follows it in both prefixes, and behind them, can
    still make up 0.8: at the first key that two sets share, that leaves all pairs of 0.8 or more.
    Null and texts without words have equal sets, the empty one. Repeated rows stay. A null id never names a
    component. A long text costs its length, and an empty table gives an empty result. Other columns are not
    read, so their names cannot clash. df is read several times and so should be a table. All tables on the
    way are in one folder, which is gone in the end; the result is a table in the caller's scratch, if there is one.
    """
    out = opened(df.sparkSession)
    with scratch(df.sparkSession):
        return out.land(_grouped(only(df, _id=doc_id, _t=text).select("_id", whole("_t").alias("_t")), words, radius))


def _grouped(docs: DataFrame, words: int, radius: int) -> DataFrame:
    spark, kind = docs.sparkSession, docs.schema["_id"].dataType.simpleString()
    short_batches(spark)
    docs = docs.select("_id", "_t", F.xxhash64("_t").alias("_th"))
    often = spark.sparkContext.broadcast(_frequent(docs, words))

    def node(own: np.ndarray) -> int:
        return xxhash.xxh64_intdigest(own.tobytes(), len(own))

    def marked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in few(batches, 200):
            every = [hashes(t.encode(), words) for t in b.column(1).to_pylist()]
            own = [np.unique(x.view(np.int64)) for x in every]
            prints, nodes = (pa.array(np.array(x, np.uint64).view(np.int64)) for x in ([majority(x) for x in every], [node(x) for x in own]))
            keys = pa.array([prefix(x, *often.value) for x in own], pa.list_(pa.int64()))
            sketches = pa.array([sketch(x) for x in own], pa.binary())
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(2), nodes, pa.array([len(x) for x in own], pa.int32()), prints, keys, sketches], names=["_id", "_th", "_node", "_n", "_fp", "_keys", "_sketch"])

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in few(batches, 200):
            own = [shingles(t.encode(), words) for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(np.array([node(x) for x in own], np.uint64).view(np.int64)), pa.array([len(x) for x in own], pa.int32()), pa.array(own, pa.list_(pa.int64()))], names=["_node", "_n", "_set"])

    made = docs.mapInArrow(marked, f"_id {kind}, _th bigint, _node bigint, _n int, _fp bigint, _keys array<bigint>, _sketch binary")
    made = land(made.withColumn("_row", F.monotonically_increasing_id()))
    marks = made.select("_id", "_th", "_node")
    nodes = land(made.groupBy("_node").agg(F.min("_id").alias("_least"), F.min(F.struct("_row", "_id", "_th")).alias("_one"), F.max("_n").alias("_n"), F.min("_fp").alias("_fp"), F.any_value("_sketch").alias("_sketch"), F.count(F.lit(1)).alias("_times")))
    one = nodes.select(F.col("_one._id").alias("_id3"), F.col("_one._th").alias("_th3"), F.col("_node").alias("_node3"))
    # Keys go on once for each set: where several rows have one, from the first of them.
    again = nodes.where("_times > 1").select(F.col("_node").alias("_node2"), F.col("_one._row").alias("_row2"))
    rows = made.join(if_small(again), F.col("_node") == F.col("_node2"), "left").where("_node2 IS NULL OR _row = _row2")
    keys = rows.select("_node", "_n", F.posexplode("_keys").alias("_p", "_h"))
    # A set has a key once, so a key that is there twice has two sets. Hashes alone are exchanged for that.
    several = land(keys.groupBy("_h").agg(F.count(F.lit(1)).alias("_c")).where("_c > 1").select("_h"))
    shared = land(keys.join(if_small(several, MOST_SHARED), "_h", "left_semi"))

    def found(pairs: DataFrame) -> DataFrame:
        """Of pairs _a, _b the links."""
        close = land(_unlike(pairs, nodes.select("_node", "_n", "_sketch")))
        names = close.select(F.col("_a").alias("_node")).unionByName(close.select(F.col("_b").alias("_node"))).distinct()
        wanted = land(one.join(names, F.col("_node3") == F.col("_node"), "left_semi").select("_id3", "_th3"))
        own = docs.join(if_small(wanted), F.col("_id").eqNullSafe(F.col("_id3")) & (F.col("_th") == F.col("_th3")), "left_semi")
        sets = land(own.mapInArrow(listed, "_node bigint, _n int, _set array<bigint>").dropDuplicates(["_node"]))
        named = lambda k: sets.select(F.col("_node").alias(f"_{k}"), F.col("_n").alias(f"_n{k}"), F.col("_set").alias(f"_s{k}"))
        both = close.join(named("a"), "_a").join(named("b"), "_b")
        return both.where(alike(F.size(F.array_intersect("_sa", "_sb")), F.col("_na"), F.col("_nb"))).select("_a", "_b")

    def relabelled(labels: DataFrame) -> DataFrame:
        """shared with _l, what each node hangs together with so far. It is not kept: there are as many rows as keys of texts."""
        root = if_small(labels.select(F.col("_node").alias("_node2"), "_root"))
        return shared.join(root, F.col("_node") == F.col("_node2"), "left").select("_h", "_p", "_node", "_n", F.coalesce("_root", "_node").alias("_l"))

    def ordered(rows: DataFrame) -> DataFrame:
        """Pairs _a, _b, each once, that sizes and the key's places in both allow to be alike."""
        fit = (5 * F.least("_na", "_nb") >= 4 * F.greatest("_na", "_nb")) & (F.col("_la") != F.col("_lb"))
        left = F.least(F.col("_na") - F.col("_pa"), F.col("_nb") - F.col("_pb"))
        return rows.where(fit & alike(left, F.col("_na"), F.col("_nb"))).select(F.least("_a", "_b").alias("_a"), F.greatest("_a", "_b").alias("_b")).distinct()

    def by_fingerprint() -> DataFrame:
        """Pairs _a, _b that the fingerprints name: each node of a fingerprint with one of them, and these over the fingerprints' links."""
        known = cut(nodes.groupBy("_fp").agg(F.min(F.struct("_n", "_node")).alias("_one")).select("_fp", F.col("_one._node").alias("_b"), F.col("_one._n").alias("_nb")))
        same = nodes.select("_fp", F.col("_node").alias("_a"), F.col("_n").alias("_na")).join(known, "_fp").where("_a <> _b")
        near = simhash_links(known.select("_fp"), radius=radius).withColumnsRenamed({"_a": "_x", "_b": "_y"})
        first = known.select(F.col("_fp").alias("_x"), F.col("_b").alias("_a"), F.col("_nb").alias("_na"))
        apart = near.join(first, "_x").join(known.withColumnRenamed("_fp", "_y"), "_y")
        both = same.select("_a", "_b", "_na", "_nb").unionByName(apart.select("_a", "_b", "_na", "_nb"))
        return both.where(5 * F.least("_na", "_nb") >= 4 * F.greatest("_na", "_nb")).select(F.least("_a", "_b").alias("_a"), F.greatest("_a", "_b").alias("_b")).distinct()

    links = cut(found(cut(by_fingerprint())))
    labels = connected(links)
    labelled = relabelled(labels)
    for turn in range(HUBS + 1):
        left = labelled.select("_h", F.col("_node").alias("_a"), F.col("_n").alias("_na"), F.col("_l").alias("_la"), F.col("_p").alias("_pa"))
        if turn < HUBS:
            hub = F.min_by(F.struct("_node", "_n", "_l", "_p"), F.struct(F.when(F.lit(turn == 0), F.col("_n")), F.xxhash64("_node", F.lit(turn))))
            hubs = labelled.groupBy("_h").agg(hub.alias("_hub"))
            right = hubs.select("_h", *[F.col(f"_hub.{c}").alias(f"_{k}b") for c, k in (("_n", "n"), ("_l", "l"), ("_p", "p"))], F.col("_hub._node").alias("_b"))
            pairs = left.join(right, "_h")
        else:
            apart = labelled.groupBy("_h").agg(F.min("_l").alias("_first"), F.max("_l").alias("_final")).where("_first <> _final").select("_h")
            open_ = left.join(if_small(cut(apart)), "_h")
            # Sets of 0.8 or more are at most one step of sizes apart.
            step = lambda n: F.floor(F.log(F.col(n) + 1) / F.lit(math.log(1.25)))
            right = open_.select("_h", *[F.col(c).alias(c[:-1] + "b") for c in ("_a", "_na", "_la", "_pa")]).withColumn("_s", step("_nb"))
            near = open_.withColumn("_s", F.explode(F.sequence(step("_na") - 1, step("_na") + 1)))
            pairs = near.join(right, ["_h", "_s"]).where("_a < _b")
        new = cut(found(cut(ordered(pairs))))
        if new.isEmpty():
            continue
        links = links.unionByName(new)
        labels = connected(links)
        labelled = relabelled(labels)
    root = labels.select(F.col("_node").alias("_node2"), "_root")
    rooted = nodes.join(root, F.col("_node") == F.col("_node2"), "left").select("_node", "_least", F.coalesce("_root", "_node").alias("_root"))
    named = rooted.groupBy("_root").agg(F.min("_least").alias("component_id"))
    known = rooted.join(named, "_root").select(F.col("_node").alias("_node2"), "component_id")
    return marks.join(known, F.col("_node") == F.col("_node2")).select("_id", "_th", "component_id")


def drop_alike(df: DataFrame, *, text: str = "text", doc_id: str = "doc_id", words: int = 5) -> DataFrame:
    """The rows of df whose id is the smallest of their group, one row for each id; rows without an id stay.

    Columns stay as they are, under whatever names; all else is as group_by_shingles and first_of_groups say.
    """
    return first_of_groups(df, group_by_shingles(df, text=text, doc_id=doc_id, words=words), text=text, doc_id=doc_id)
