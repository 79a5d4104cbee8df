"""A write-ahead log of posts: what is to be sent, under which key, and what came of it."""

from __future__ import annotations

import time
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .responses import ask_each

#: The header that carries a post's key; a service that honours it acts on a key once, however often it comes.
KEY_HEADER = "Idempotency-Key"
OUTCOME = "key string, ord bigint, status int, body string, error string, attempt string"
ANSWERED, REFUSED, UNKNOWN, OPEN = "answered", "refused", "unknown", "open"
SAID_OPEN = "open: it may have been sent, and nothing tells"


def idempotency_key(scope: str | Column, ord_: Column, url: Column, data: Column) -> Column:
    """The same for the same post of the same batch, in any run and on any machine; posts of other batches or places in it have others."""
    scope = F.lit(scope) if isinstance(scope, str) else scope
    return F.sha2(F.concat_ws("\n", scope, ord_.cast("string"), url, F.sha2(data, 256)), 256)


def settled(outcomes: DataFrame) -> DataFrame:
    """One row for each key of outcomes (key, ord, status, body, error, attempt), and recorded, how many there were.

    A task that is run again, or committed twice, leaves several: of those with a status the first attempt
    counts, without any the first attempt's error. Partial results are exchanged, one for each key and task.
    """
    first = F.struct(F.col("status").isNull().alias("none"), F.col("attempt"), F.col("ord"), F.col("status"), F.col("body"), F.col("error"))
    got = outcomes.groupBy("key").agg(F.min(first).alias("o"), F.count(F.lit(1)).alias("recorded"))
    return got.select("key", "o.ord", "o.status", "o.body", "o.error", "recorded")


def states(intents: DataFrame, outcomes: DataFrame) -> DataFrame:
    """intents (key and others) with state, status and recorded: answered (200), refused (another status), unknown (errors alone), open (nothing is known)."""
    known = settled(outcomes).select(F.col("key").alias("_key"), "status", "recorded")
    state = F.when(F.col("_key").isNull(), OPEN).when(F.col("status").isNull(), UNKNOWN).when(F.col("status") == 200, ANSWERED).otherwise(REFUSED)
    return intents.join(known, F.col("key") == F.col("_key"), "left").select(*intents.columns, state.alias("state"), "status", F.coalesce("recorded", F.lit(0)).cast("long").alias("recorded"))


class Ledger:
    """The log of one batch, in a folder that the driver and all executors reach.

    intents/ is written, and marked complete, before the first post. Each attempt then writes what came of
    its posts, task by task: a task's outcomes are there as soon as the task has ended, even if the driver
    dies before its job has. A run that comes later joins intents with outcomes and knows what is left.
    """

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def _there(self, path: str) -> bool:
        at = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return at.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(at)

    @property
    def intents(self) -> DataFrame:
        """key and ord of all posts of the batch."""
        return self.spark.read.schema("key string, ord bigint").parquet(f"{self.folder}/intents")

    @property
    def outcomes(self) -> DataFrame:
        """What is recorded, attempt by attempt; see settled."""
        at = f"{self.folder}/outcomes"
        return self.spark.read.schema(OUTCOME).parquet(at) if self._there(at) else self.spark.createDataFrame([], OUTCOME)

    def state(self) -> DataFrame:
        return states(self.intents, self.outcomes)

    def open(self) -> DataFrame:
        """The posts of which nothing is recorded: not sent yet, or sent by a task that did not live to tell."""
        return self.intents.join(self.outcomes.select("key").distinct(), "key", "left_anti")

    def post(self, sent: DataFrame, transport, headers: dict[str, str], seconds: float, *, scope: str, honoured: bool = True, side_by_side: int | None = None) -> DataFrame:
        """ord, status, body and error for each row of sent (ord, url, data), which must be the same in each run of the batch; scope names it.

        Posts with an outcome are not sent again, whatever it was. In a first run all others are sent. In a
        later one those are open, and whether they went out cannot be known: where the service honours keys
        they are sent again under the same one, and so take effect once; otherwise they are left alone and
        come back with the error SAID_OPEN, to be counted as failures and looked into.
        """
        key = idempotency_key(scope, F.col("ord"), F.col("url"), F.col("data"))
        keyed = sent.select("ord", "url", "data", key.alias("key"))
        again = self._there(f"{self.folder}/intents/_SUCCESS")
        if not again:
            keyed.select("key", "ord").write.mode("overwrite").parquet(f"{self.folder}/intents")
        if honoured or not again:
            left = keyed.join(self.open().select("key"), "key", "left_semi")
            made = ask_each(left, transport, headers, seconds, side_by_side=side_by_side, per_host=None, key_header=KEY_HEADER)
            made = made.select("key", "ord", "status", "body", "error")
            # Version 2 of the committer puts a task's file in place when the task ends.
            made.write.option("mapreduce.fileoutputcommitter.algorithm.version", "2").parquet(f"{self.folder}/outcomes/attempt={time.time_ns():020d}-{uuid.uuid4().hex}")
        known = settled(self.outcomes).select("key", "status", "body", "error")
        untold = F.when(F.col("_known").isNull(), SAID_OPEN).otherwise(F.col("error"))
        return self.intents.join(known.withColumn("_known", F.lit(True)), "key", "left").select("ord", "status", "body", untold.alias("error"))
