"""Cubes with exact counts of distinct values, from bitmaps that merge from level to level."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..sources.shared import Scratch


def dense_ids(rows: DataFrame, value: str, scratch: Scratch) -> DataFrame:
    """value and id, from 0 without gaps, for each distinct value but null. Values are sorted by ranges, and ids run on over their borders."""
    sorted_ = scratch.land(rows.select(value).where(F.col(value).isNotNull()).distinct().orderBy(value).withColumn("pos", F.monotonically_increasing_id()))
    part = F.shiftright("pos", 33)
    counts = sorted_.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n"))  # a row for each range
    starts = counts.select("part", F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("start"))
    return sorted_.join(F.broadcast(starts), part == F.col("part")).select(value, (F.col("start") + F.col("pos").bitwiseAND((1 << 33) - 1)).alias("id"))


def cube_distinct(rows: DataFrame, dims: Sequence[str], value: str, scratch: Scratch) -> DataFrame:
    """dims, grouping_id, n_rows and n_distinct for each group of each subset of dims, as a cube has them; grouping_id has a bit for each dim that is summed up, the first dim's highest.

    rows are read once for the cube: its finest level has, for each group and each 32,768 ids of value, a bitmap
    of 4 KB at most and a count of rows. Every coarser level merges the bitmaps of a level with one dim more,
    so its cost is that level's bitmaps, not rows. Ids are dense, so a bitmap is as full as it can be. Nulls in
    dims are values like others, nulls in value are rows that count for n_rows alone. Of no rows there is the
    grand total, zeros. Levels that are merged from are written to scratch.
    """
    ids = dense_ids(rows, value, scratch)
    given = rows.select(*[F.col(d).alias(f"d{k}") for k, d in enumerate(dims)], F.col(value).alias("_v"))
    known = given.join(ids.withColumnRenamed(value, "_v2"), F.col("_v") == F.col("_v2"), "left")
    all_ = [f"d{k}" for k in range(len(dims))]
    bucket = F.when(F.col("id").isNotNull(), F.bitmap_bucket_number("id"))
    bits = F.bitmap_construct_agg(F.bitmap_bit_position("id")).alias("bits")
    levels = {tuple(all_): scratch.land(known.groupBy(*all_, bucket.alias("bucket")).agg(bits, F.count(F.lit(1)).alias("n")))}
    for size in range(len(dims) - 1, -1, -1):
        for kept in combinations(all_, size):
            finer = next(levels[c] for c in combinations(all_, size + 1) if set(kept) <= set(c))
            merged = finer.groupBy(*kept, "bucket").agg(F.bitmap_or_agg("bits").alias("bits"), F.sum("n").alias("n"))
            levels[kept] = scratch.land(merged) if size > 1 else merged
    out = None
    for kept, level in levels.items():
        counted = level.groupBy(*kept).agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n_rows"), F.coalesce(F.sum(F.when(F.col("bucket").isNotNull(), F.bitmap_count("bits"))), F.lit(0)).alias("n_distinct"))
        gid = sum(1 << (len(dims) - 1 - k) for k, d in enumerate(all_) if d not in kept)
        columns = [(F.col(d) if d in kept else F.lit(None).cast(given.schema[d].dataType)).alias(name) for d, name in zip(all_, dims, strict=True)]
        one = counted.select(*columns, F.lit(gid).cast("long").alias("grouping_id"), F.col("n_rows").cast("long").alias("n_rows"), F.col("n_distinct").cast("long").alias("n_distinct"))
        out = one if out is None else out.unionByName(one)
    return out
