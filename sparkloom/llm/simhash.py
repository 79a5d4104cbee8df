"""SimHash fingerprints, and the groups that fingerprints a few bits apart form."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Aside, cut, few, if_small, only, parts, table, whole

SEED = 42
WIDTH = 64
#: Distinct fingerprints that one shard of a tree may have before it is divided by shells.
LEAF = 4096


def fingerprint(text: bytes, words: int = 4) -> int:
    """A bit is 1 if it is set in over half the hashes of the text's shingles. No words: zero."""
    tokens = text.lower().split()  # of bytes: A-Z alone change, and white space is ASCII's
    if not tokens:
        return 0
    joined = b" ".join(tokens)
    ends = np.cumsum(np.fromiter(map(len, tokens), np.int64, len(tokens)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    h = xxhash.xxh64_intdigest
    if len(tokens) <= words:
        return h(joined, SEED)
    n = len(tokens) - words + 1
    return majority(np.array([h(joined[a:b], SEED) for a, b in zip(starts[:n].tolist(), ends[words - 1 :].tolist(), strict=True)], np.uint64))


def majority(hashes: np.ndarray) -> int:
    """A bit is 1 if it is set in over half the hashes; of none, zero."""
    counts, n = np.zeros(WIDTH, np.int64), len(hashes)
    for k in range(0, n, 1 << 16):
        counts += np.unpackbits(hashes[k : k + (1 << 16)].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.uint32)
    return int.from_bytes(np.packbits(2 * counts > n, bitorder="little").tobytes(), "little")


def fingerprints(df: DataFrame, *, text: str = "text", doc_id: str = "doc_id", words: int = 4) -> DataFrame:
    """_id, _th (a hash of the text) and _fp, the 64 bits as a signed long, for each row. No exchange; only the id and the text are read.

    Null and empty texts, and texts without words, have the fingerprint zero. Repeated rows and null ids are rows
    like any other, a long text costs its length, and an empty table gives an empty result.
    """
    given = only(df, _id=doc_id, _t=text)
    kind = given.schema["_id"].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in few(batches):
            made = np.fromiter((fingerprint(t.encode(), words) for t in b.column(1).to_pylist()), np.uint64, b.num_rows)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(2), pa.array(made.view(np.int64))], names=["_id", "_th", "_fp"])

    given = given.select("_id", whole("_t").alias("_t"))
    return given.select("_id", "_t", F.xxhash64("_t").alias("_th")).mapInArrow(run, f"_id {kind.simpleString()}, _th bigint, _fp bigint")


def components(n: int, a: np.ndarray, b: np.ndarray, labels: np.ndarray | None = None) -> np.ndarray:
    """The least member of each of n nodes' components, by the links a-b and the labels so far."""
    labels = np.arange(n) if labels is None else labels
    while True:
        new, low = labels.copy(), np.minimum(labels[a], labels[b])
        np.minimum.at(new, labels[a], low)
        np.minimum.at(new, labels[b], low)
        while not np.array_equal(new, shorter := new[new]):
            new = shorter
        if np.array_equal(new, labels):
            return labels
        labels = new


def leaf_links(shard: np.ndarray, fp: np.ndarray, side: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Links that hold together what lies within radius in a shard; rows of a shard are adjacent.

    Each shard is searched by the distance d to its first member, its vantage point: by the triangle bound
    a pair within the radius has |d - d'| <= radius, so in the order of d every row meets only those that
    follow it that closely. Rows of sides 1 and 2 (two overlapping shells) meet only each other.
    Pairs that already hang together are not kept: the links are each row's with its component's first.
    """
    n = len(fp)
    if n < 2:
        return fp[:0], fp[:0]
    first = np.flatnonzero(np.concatenate([[True], shard[1:] != shard[:-1]]))
    group = np.repeat(np.arange(len(first)), np.diff(np.append(first, n)))
    d = np.bitwise_count(fp ^ fp[first][group]).astype(np.int16)
    order = np.lexsort((d, group))
    fp, d, group, side = fp[order], d[order], group[order], side[order]
    labels, a, b, held = np.arange(n), [], [], 0
    i, k = np.arange(n), 0
    while len(i):
        k += 1
        i = i[i + k < n]
        j = i + k
        near = (group[i] == group[j]) & (d[j] - d[i] <= radius)
        i, j = i[near], j[near]
        hit = (np.bitwise_count(fp[i] ^ fp[j]) <= radius) & ((side[i] == 0) | (side[i] != side[j])) & (labels[i] != labels[j])
        a.append(i[hit])
        b.append(j[hit])
        held += int(hit.sum())
        if held > 1 << 18:
            labels, a, b, held = components(n, np.concatenate(a), np.concatenate(b), labels), [], [], 0
    if a:
        labels = components(n, np.concatenate(a), np.concatenate(b), labels)
    tied = np.flatnonzero(labels != np.arange(n))
    return fp[tied], fp[labels[tied]]


def _linked(rows: DataFrame, radius: int) -> DataFrame:
    """rows: _shard (string), _fp, _side, dealt and sorted by shard. Links _a, _b. A shard that a batch cuts waits for the next."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(shard, fp, side):
            a, b = leaf_links(shard, fp.view(np.uint64), side, radius)
            return pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], names=["_a", "_b"])

        held: list[np.ndarray] | None = None
        for batch in batches:
            new = [batch.column(k).to_numpy(zero_copy_only=False) for k in range(3)]
            own = [np.concatenate(x) for x in zip(held, new, strict=True)] if held is not None else new
            if not len(own[0]):
                continue
            at = int(np.searchsorted(own[0], own[0][-1]))
            if at:
                yield out(*[x[:at] for x in own])
            held = [x[at:] for x in own]
        if held is not None:
            yield out(*held)

    return rows.mapInArrow(run, "_a bigint, _b bigint").distinct()


def blocks_of(n: int, radius: int) -> list[int]:
    """Masks of bits of which one is the same in any two fingerprints within radius bits, so many that n fingerprints fall into small shards.

    Of radius + k blocks of bits, k are the same; k grows until a shard has 256 of n evenly spread fingerprints.
    """
    k = 1
    while k < 4 and n >> (k * (WIDTH // (radius + k))) > 256:
        k += 1
    edges = [i * WIDTH // (radius + k) for i in range(radius + k + 1)]
    each = [(1 << b) - (1 << a) for a, b in zip(edges, edges[1:], strict=False)]
    return [sum(chosen) for chosen in combinations(each, k)]


def links(nodes: DataFrame, *, radius: int = 4, leaf: int = LEAF) -> DataFrame:
    """Links _a, _b between distinct fingerprints (column _fp of nodes) that tie together all within radius bits.

    The first level deals fingerprints into shards by blocks of bits: any two within the radius are the same in
    one of the masks of blocks_of, and shards stay small whatever the number of fingerprints. Within a shard
    the search is by distance to a vantage point, see leaf_links. A shard of over `leaf` fingerprints (many
    alike in a mask's bits) is divided by shells, the distances to a vantage point of its own, and shells by
    hash into chunks of `leaf` at most. By the triangle bound each chunk meets those of the shells up to
    `radius` further out, its boundary overlap, as shards of two chunks each. Nothing is left out, and no task
    holds more than two chunks a shard.
    """
    masks = [m - (1 << WIDTH) if m >> (WIDTH - 1) else m for m in blocks_of(nodes.count(), radius)]
    shards = F.array(*[F.xxhash64(F.col("_fp").bitwiseAND(F.lit(m)), F.lit(k)) for k, m in enumerate(masks)])
    rows = nodes.select("_fp", F.explode(shards).alias("_shard"))
    sizes = rows.groupBy("_shard").agg(F.count(F.lit(1)).alias("_n"), F.min("_fp").alias("_vantage"))
    large = cut(sizes.where(F.col("_n") > leaf))
    n = parts(nodes.sparkSession)
    plain = rows if large.isEmpty() else rows.join(large, "_shard", "left_anti")
    out = _linked(plain.select("_shard", "_fp", F.lit(0).alias("_side")).repartition(n, "_shard").sortWithinPartitions("_shard"), radius)
    if large.isEmpty():
        return out
    far = F.bit_count(F.col("_fp").bitwiseXOR(F.col("_vantage")))
    shelled = cut(rows.join(large.select("_shard", "_vantage"), "_shard").select("_shard", "_fp", far.alias("_shell")))
    chunks = shelled.groupBy("_shard", "_shell").agg(F.ceil(2 * F.count(F.lit(1)) / leaf).alias("_chunks"))
    chunked = shelled.join(chunks, ["_shard", "_shell"]).withColumn("_chunk", F.pmod(F.xxhash64("_fp"), F.col("_chunks")))
    # For each chunk all that it meets: itself, later ones of its shell, those of the next shells.
    near = chunks.select("_shard", F.col("_shell").alias("_shell2"), F.col("_chunks").alias("_chunks2"))
    each = chunks.select("_shard", "_shell", F.explode(F.expr("sequence(0, _chunks - 1)")).alias("_chunk"))
    met = (
        each.join(near, (each["_shard"] == near["_shard"]) & F.col("_shell2").between(F.col("_shell"), F.col("_shell") + radius))
        .select(each["_shard"], "_shell", "_chunk", "_shell2", F.explode(F.expr("sequence(0, _chunks2 - 1)")).alias("_chunk2"))
        .where((F.col("_shell2") > F.col("_shell")) | (F.col("_chunk2") >= F.col("_chunk")))
        .withColumn("_pair", F.xxhash64("_shard", "_shell", "_chunk", "_shell2", "_chunk2"))
    )
    met = cut(met)
    alone = (F.col("_shell") == F.col("_shell2")) & (F.col("_chunk") == F.col("_chunk2"))
    one = chunked.join(met, ["_shard", "_shell", "_chunk"]).select(F.col("_pair").alias("_shard"), "_fp", F.when(alone, 0).otherwise(1).alias("_side"))
    other = met.where(~alone).select("_shard", F.col("_shell2").alias("_shell"), F.col("_chunk2").alias("_chunk"), "_pair")
    two = chunked.join(other, ["_shard", "_shell", "_chunk"]).select(F.col("_pair").alias("_shard"), "_fp", F.lit(2).alias("_side"))
    dealt = one.unionByName(two).repartition(n, "_shard").sortWithinPartitions("_shard")
    return out.unionByName(_linked(dealt, radius)).distinct()


def connected(edges: DataFrame) -> DataFrame:
    """_node and _root, the least node of its component, for each node of the links _a, _b except the roots.

    Alternates large stars (each node's larger neighbours move to its least neighbour) and small stars (its
    smaller neighbours do), until the links are stars, however many rounds that takes: each but the last
    brings links closer to a root. Each round is kept in the shared folder.
    """
    now = cut(edges.where("_a <> _b").select(F.greatest("_a", "_b").alias("_a"), F.least("_a", "_b").alias("_b")).distinct())

    def state(df: DataFrame):
        return df.agg(F.count(F.lit(1)), F.sum(F.xxhash64("_a", "_b").cast("decimal(38,0)"))).first()

    before, after = None, state(now)
    while after != before:
        both = now.select("_a", "_b").unionByName(now.select(F.col("_b").alias("_a"), F.col("_a").alias("_b")))
        least = both.groupBy("_a").agg(F.least(F.min("_b"), F.col("_a")).alias("_m"))
        large = both.where("_b > _a").join(least, "_a").select(F.col("_b").alias("_a"), F.col("_m").alias("_b"))
        large = large.distinct()
        down = large.groupBy("_a").agg(F.min("_b").alias("_m"))
        small = large.join(down, "_a").where("_b <> _m").select(F.col("_b").alias("_a"), F.col("_m").alias("_b"))
        now = cut(small.unionByName(down.select("_a", F.col("_m").alias("_b"))).distinct())
        before, after = after, state(now)
    return now.select(F.col("_a").alias("_node"), F.col("_b").alias("_root"))


def group_by_simhash(df: DataFrame, *, text: str = "text", doc_id: str = "doc_id", words: int = 4, radius: int = 4) -> DataFrame:
    """_id, _th, _fp and component_id, the smallest id that is reached over links of at most radius bits, for each row.

    Null and texts without words have the fingerprint zero, and link like any other. A null id never names a
    component; a component of null ids alone has a null name. Repeated rows stay. An empty table gives an
    empty result, a long text costs its length. Other columns are not read, so their names cannot clash.
    """
    marks = cut(fingerprints(df, text=text, doc_id=doc_id, words=words))
    nodes = cut(marks.groupBy("_fp").agg(F.min("_id").alias("_least")))
    labels = connected(links(nodes.select("_fp"), radius=radius))
    rooted = nodes.join(labels, F.col("_fp") == F.col("_node"), "left").select("_fp", "_least", F.coalesce("_root", "_fp").alias("_root"))
    named = rooted.groupBy("_root").agg(F.min("_least").alias("component_id"))
    known = rooted.join(named, "_root").select(F.col("_fp").alias("_fp2"), "component_id")
    return marks.join(known, F.col("_fp") == F.col("_fp2")).select("_id", "_th", "_fp", "component_id")


def hexadecimal(fp: str | Column) -> Column:
    return F.lpad(F.lower(F.hex(fp)), 16, "0")


def drop_near_copies(df: DataFrame, *, text: str = "text", doc_id: str = "doc_id", words: int = 4, radius: int = 4) -> DataFrame:
    """The rows of df whose id is the smallest of their group, one row for each id; rows without an id stay.

    Columns stay as they are, under whatever names. Null and empty texts are one group; of rows that share
    the smallest id the one stays whose text links to the group, and of repeated rows one. A long text costs
    its length; an empty table gives an empty result. df is read twice and so should be a table. The ids that go are broadcast if they
    are counted as few; otherwise, and for ids that several rows have, texts are exchanged by id.
    """
    return first_of_groups(df, group_by_simhash(df, text=text, doc_id=doc_id, words=words, radius=radius), text=text, doc_id=doc_id)


def first_of_groups(df: DataFrame, grouped: DataFrame, *, text: str, doc_id: str) -> DataFrame:
    """The rows of df whose id names their group; grouped has _id, _th and component_id of each row."""
    best = F.min(F.when(F.col("_id") == F.col("component_id"), F.col("_th"))).alias("_best")
    ids = cut(grouped.where("_id IS NOT NULL").groupBy("_id").agg(best, F.count(F.lit(1)).alias("_n")))
    plain = ids.where("_n = 1 AND _best IS NULL").select("_id")
    again = ids.where("_n > 1")
    given = Aside(df)
    own = given.of(doc_id)
    if again.isEmpty():
        return given.df.join(if_small(plain), own == F.col("_id"), "left_anti").select(*given.back())
    out = given.df.join(if_small(plain.unionByName(again.select("_id"))), own == F.col("_id"), "left_anti")
    chosen = given.df.withColumn("_own", own).join(again, (F.col("_own") == F.col("_id")) & (F.xxhash64(whole(given.of(text))) == F.col("_best")), "left_semi")
    return out.unionByName(chosen.dropDuplicates(["_own"]).drop("_own")).select(*given.back())


def op5_simhash(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return group_by_simhash(docs).select(F.col("_id").alias("doc_id"), hexadecimal("_fp").alias("fingerprint"), "component_id")
