"""Sharding by a histogram sort: splitters first, then one exchange."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import Aside, cut, if_small, parts, table, whole

#: Right shifts of a 64-bit key, one for each round of probes: 4096 candidate boundaries in each bracket.
SHIFTS = (52, 40, 28, 16, 4, 0)
TOP = 1 << 63
ADDED = ("size", "text_crc32", "law", "shard", "slot", "grown_shard")


def _keyed(given: Aside, text: str, doc_id: str) -> DataFrame:
    """Sort key (_k1, _k2): hash of the text, so that equal texts lie side by side, then hash of the id."""
    t = whole(given.of(text))
    return given.df.select(
        "*",
        t.alias("_t"),
        F.xxhash64(t).alias("_k1"),
        F.xxhash64(given.of(doc_id)).alias("_k2"),
        (F.octet_length(t) + F.lit(16)).cast("long").alias("_size"),
    )


def splitters(keys: DataFrame, shards: int, tolerance: float) -> list[tuple[int, int]]:
    """shards - 1 boundaries (k1, k2), rising; a row belongs after each boundary that is not above its key.

    Each round counts the exact bytes of every child interval of the brackets that still hold a wanted
    boundary, over all partitions, and takes the boundary or narrows the bracket. A round returns at most
    4096 counts a bracket. A boundary that falls among equal texts moves to their edge if that costs no more
    than the tolerance or one and a half of them; otherwise the second key divides them.
    """
    total = keys.agg(F.sum("_size")).first()[0] or 0
    if not total:
        return []
    near = tolerance * total / shards
    # bracket -> (bytes below it, the targets inside). A bracket is (k1 prefix,) or (k1, k2 prefix).
    open_: dict[tuple, tuple[int, list[float]]] = {(): (0, [total * j / shards for j in range(1, shards)])}
    found: list[tuple[int, int]] = []
    rounds = [(0, s) for s in SHIFTS] + [(1, s) for s in SHIFTS]
    for depth, (which, shift) in enumerate(rounds):
        last = depth == len(rounds) - 1
        child = F.shiftright(F.col(("_k1", "_k2")[which]), shift)
        head = F.col("_k1") if which else F.lit(0)
        if depth == 0:
            inside, parent = F.lit(True), F.lit(0)
        else:
            above = rounds[depth - 1]
            if shift == SHIFTS[0]:  # the second key's first round: the bracket is a single first key
                parent, inside = F.lit(0), F.col("_k1").isin([b[0] for b in open_])
            else:
                parent = F.shiftright(F.col(("_k1", "_k2")[above[0]]), above[1])
                inside = parent.isin([b[-1] for b in open_])
                if which:
                    inside &= F.col("_k1").isin([b[0] for b in open_])
        counted = (
            keys.where(inside)
            .groupBy(head.alias("h"), parent.alias("p"), child.alias("c"))
            .agg(F.sum("_size").alias("b"), F.count(F.lit(1)).alias("n"))
            .collect()
        )
        children: dict[tuple, list] = {}
        for r in counted:
            if depth == 0:
                at: tuple = ()
            elif not which:
                at = (r.p,)
            else:
                at = (r.h,) if shift == SHIFTS[0] else (r.h, r.p)
            children.setdefault(at, []).append((r.c, r.b, r.n))
        narrower: dict[tuple, tuple[int, list[float]]] = {}
        for at, (below, targets) in open_.items():
            for c, size, n in sorted(children[at]):
                mine = [t for t in targets if below <= t < below + size]
                for t in mine:
                    start = ((c << shift), -TOP) if not which else (at[0], c << shift)
                    end = (((c + 1) << shift), -TOP) if not which else (at[0], (c + 1) << shift)
                    alike = not which and not shift  # all of one text
                    if min(t - below, below + size - t) <= (max(near, 1.5 * size / n) if alike else near) or n == 1 or last:
                        found.append(start if t - below <= below + size - t else end)
                    else:
                        key = (c,) if not which else (at[0], c)
                        narrower.setdefault(key, (below, []))[1].append(t)
                below += size
        open_ = narrower
        if not open_:
            break
    return sorted(found)


def shard_by_bytes(
    df: DataFrame, *, shards: int = 40, tolerance: float = 0.001, text: str = "text", doc_id: str = "doc_id", slice_rows: int = 100_000
) -> DataFrame:
    """Each row of df with its shard; the shards' sizes (UTF-8 bytes of the text and 16) are near equal.

    Adds size, text_crc32, law ('bytes'), shard, slot (gapless from 0 in each shard) and grown_shard (null:
    a new shard moves the boundaries, so this law makes no promise for one more). A column of df under one
    of these names is replaced; other names cannot clash. Equal texts share a shard unless a boundary falls
    well among them. A null text counts as no bytes, a null id is an id like any other, repeated rows are
    rows of their own, and an empty table gives an empty result. A boundary is within the tolerance, or one
    and a half documents, of its place; but rows alike in both id and text have one key, and so stay
    together in one shard and one task, however many they are.

    Each shard is numbered in slices of about slice_rows rows, so that no task holds a whole shard.
    """
    given = Aside(df)
    keys = cut(_keyed(given, text, doc_id).select("_k1", "_k2", "_size"))
    ends = splitters(keys, shards, tolerance)
    slices = max(keys.count() // (shards * slice_rows), parts(df.sparkSession) // shards, 1)

    def after(k1: int, k2: int):
        if k1 >= TOP:
            return F.lit(0)
        beyond = F.col("_k1") > F.lit(k1)
        if k2 < TOP:
            beyond |= (F.col("_k1") == F.lit(k1)) & (F.col("_k2") >= F.lit(k2))
        return beyond.cast("int")

    shard = reduce(lambda a, b: a + b, [after(*e) for e in ends], F.lit(0))
    slice_ = F.pmod(F.col("_k2"), F.lit(slices)).cast("int")
    counts = keys.groupBy(shard.alias("_shard"), slice_.alias("_slice")).agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy("_shard").orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("_shard", "_slice", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    rows = _keyed(given, text, doc_id).select(
        *[F.col(c) for c in given.own], "_k1", "_k2", "_size", F.crc32(F.col("_t").cast("binary")).alias("_crc"), shard.alias("_shard"), slice_.alias("_slice")
    )
    order = Window.partitionBy("_shard", "_slice").orderBy("_k1", "_k2", "_size", "_crc")
    numbered = rows.withColumn("_row", F.row_number().over(order))
    placed = numbered.join(if_small(cut(starts)), ["_shard", "_slice"])
    return placed.select(
        *given.back(*ADDED),
        F.col("_size").alias("size"),
        F.col("_crc").alias("text_crc32"),
        F.lit("bytes").alias("law"),
        F.col("_shard").alias("shard"),
        (F.col("_row") - 1 + F.col("_start")).cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op10_sharding(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return shard_by_bytes(docs).drop("text")
