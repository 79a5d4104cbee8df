"""Streams that run until their input is used up, and go on from there the next time."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

#: Settings of a session that streams start from.
_KEPT = ("spark.sql.shuffle.partitions", "spark.sql.session.timeZone")
_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def state_session(spark: SparkSession) -> SparkSession:
    """A session of the same application whose streams keep keyed state in RocksDB, as transformWithState needs it."""
    made = spark.newSession()
    for name in _KEPT:
        made.conf.set(name, spark.conf.get(name))
    made.conf.set("spark.sql.streaming.stateStore.providerClass", _ROCKSDB)
    return made


def run_to_end(rows: DataFrame, out: str, checkpoint: str) -> list[dict]:
    """Appends what rows, a stream, makes of all input that is there to the Parquet table out; the progress of each batch.

    What the checkpoint says was read is not read again, so a second run takes what has come since.
    """
    query = rows.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start()
    query.awaitTermination()
    return list(query.recentProgress)
