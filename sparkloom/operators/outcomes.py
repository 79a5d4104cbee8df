"""What became of each target, and of all of them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.variants import counter, parsed
from .config import SAID_TOTALS


def accepted(status: Column, body: Column) -> Column:
    """Never null: a fetch counts if its status is 200 and its text holds a '<'; it need be no XML."""
    return F.coalesce((status == 200) & F.contains(body, F.lit("<")), F.lit(False))


def envelope(feed_id: Column, xml: Column) -> Column:
    """The request that hands one text on. feed_id keeps its type, as VARIANT too."""
    one = F.struct(feed_id.alias("feed_id"), xml.alias("xml"))
    return F.to_json(F.struct(F.array(one).alias("relay_results")), {"ignoreNullFields": "false"})


def increments(rows: DataFrame, *, processed: str = "processed", added: str = "added") -> DataFrame:
    """rows with synced_inc, added_inc and failed_inc. rows: fetch_status, fetch_body, fetch_error, post_status, post_body, post_error.

    The counters are read one after the other, so a first one that counts stays counted when the second one
    does not, and the row fails as well.
    """
    taken = accepted(F.col("fetch_status"), F.col("fetch_body")) & F.col("fetch_error").isNull()
    answered = F.coalesce(taken & (F.col("post_status") == 200) & F.col("post_error").isNull(), F.lit(False))
    document = F.when(answered, parsed("post_body"))
    first, second = counter(document, processed), counter(document, added)
    both = first.isNotNull() & second.isNotNull()
    zero = F.lit(0).cast("decimal(38,6)")
    return rows.select(
        "*",
        F.coalesce(first, zero).alias("synced_inc"),
        F.when(both, second).otherwise(zero).alias("added_inc"),
        F.when(both, 0).otherwise(1).cast("long").alias("failed_inc"),
    )


def totals(outcomes: DataFrame) -> DataFrame:
    """One row: discovered, eligible, total_synced, total_added, failed_count. outcomes: every target, with a boolean `eligible`.

    Sums are exact beyond 64 bits and cut to whole numbers; of no rows they are 0. Partial sums go to one task.
    """
    on = F.col("eligible")

    def total(name: str) -> Column:
        return F.coalesce(F.sum(F.when(on, F.col(name))), F.lit(0)).cast("long")

    return outcomes.agg(
        F.count(F.lit(1)).alias("discovered"),
        F.count_if(on).alias("eligible"),
        total("synced_inc").alias("total_synced"),
        total("added_inc").alias("total_added"),
        total("failed_inc").alias("failed_count"),
    )


def summary_line(totals: DataFrame) -> DataFrame:
    line = F.format_string(SAID_TOTALS, "total_synced", "total_added", "failed_count")
    return totals.select(line.alias("line"))
