"""Sessions by event time: rows of a user that are close together, merged as they come, closed by the watermark."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def sessions(rows: DataFrame, *, user: Column, at: Column, gap: str, delay: str, **counts: Column) -> DataFrame:
    """user, start, last (microseconds of the first and the last row), rows and the sums of counts, for each session of a stream or a table.

    Two rows of a user are in one session if they are less than `gap` apart, or others between them are. In
    a stream a session is handed on once the watermark, `delay` behind the latest row, has passed its end;
    until then rows that come late are merged in, and may join two sessions. A row whose own window the
    watermark has passed before its batch is late and left out; late_by_user tells how many. Rows without a
    time are left out, rows without a user are one user.
    """
    given = rows.select(user.alias("user"), at.cast("timestamp").alias("at"), *[c.cast("long").alias(n) for n, c in counts.items()]).where("at IS NOT NULL")
    micros = F.unix_micros("at")
    made = given.withWatermark("at", delay).groupBy("user", F.session_window("at", gap).alias("window"))
    got = made.agg(F.min(micros).alias("start"), F.max(micros).alias("last"), F.count(F.lit(1)).alias("rows"), *[F.sum(n).alias(n) for n in counts])
    return got.drop("window")


def late_by_user(rows: DataFrame, closed: DataFrame, *, user: Column, at: Column) -> DataFrame:
    """user and late: the rows with a time that no session of closed has. For tables, once all sessions are closed."""
    all_ = rows.where(at.isNotNull()).groupBy(user.alias("user")).agg(F.count(F.lit(1)).alias("all"))
    told = closed.groupBy(F.col("user").alias("_user")).agg(F.sum("rows").alias("told"))
    return all_.join(told, F.col("user").eqNullSafe(F.col("_user")), "left").select("user", (F.col("all") - F.coalesce("told", F.lit(0))).alias("late"))
