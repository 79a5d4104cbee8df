"""Small helpers that the text operators share."""

from __future__ import annotations

import gc
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.shared import NoSharedFolderError, Scratch, shared_folder

#: The white space of the contracts: space and the characters 9 to 13.
WS = " \t\n\x0b\x0c\r"
WS_RUN = r"[\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def whole(text: str | Column) -> Column:
    """The text, with null as the empty text."""
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))


def ascii_lower(c: Column) -> Column:
    """A-Z in lower case and nothing else changed. lower() does that, and faster, where all is ASCII."""
    return F.when(F.octet_length(c) == F.length(c), F.lower(c)).otherwise(F.translate(c, UPPER, LOWER))


def words(c: Column) -> Column:
    """Runs of anything but white space; an empty array if there is none."""
    trimmed = F.btrim(c, F.lit(WS))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, WS_RUN))


#: The folder that land and cut write to: that of the innermost `scratch` of this thread, if there is one.
_OPEN: ContextVar[Scratch | None] = ContextVar("scratch", default=None)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[Scratch]:
    """What land and cut write inside goes away at the end, all of it and nothing else. What is returned from inside must not read it."""
    made = Scratch(spark)
    before = _OPEN.set(made)
    try:
        yield made
    finally:
        _OPEN.reset(before)
        made.remove()


def opened(spark: SparkSession) -> Scratch:
    """The folder of the innermost `scratch` of this thread, or else a new one."""
    return _OPEN.get() or Scratch(spark)


def cut(df: DataFrame) -> DataFrame:
    """df computed once and kept in the shared folder, where it outlives executors. For narrow rows."""
    if _OPEN.get():
        return land(df)
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def land(df: DataFrame, *by: str) -> DataFrame:
    """df written as a Parquet table in the shared folder, in folders by some columns if they are named, and read again. For rows that hold texts."""
    return opened(df.sparkSession).land(df, *by)


def tidy(spark: SparkSession) -> None:
    """Lets go of shuffle files that nothing reads any more. Spark removes them when the driver has collected its garbage, for which it asks itself every half an hour alone."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def short_batches(spark: SparkSession) -> None:
    """Sets how many rows Spark hands to a Python worker at a time to 1000, if it is left at its 10,000.

    Spark and the worker each hold a batch of whole texts once or twice, outside the heap.
    """
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if int(spark.conf.get(name)) == 10_000:
        spark.conf.set(name, 1000)


def few(batches: Iterator[pa.RecordBatch], rows: int = 1000) -> Iterator[pa.RecordBatch]:
    """The batches in shorter ones, so that what a worker holds of texts at a time is little."""
    for b in batches:
        for k in range(0, b.num_rows, rows):
            yield b.slice(k, rows)


def only(df: DataFrame, **names: str) -> DataFrame:
    """Some of df's columns under other names: only(df, _id="doc_id"). A column whose name differs in case alone does not matter."""
    kept = Aside(df)
    return kept.df.select(*[kept.of(n).alias(k) for k, n in names.items()])


def if_small(df: DataFrame, rows: int = 500_000) -> DataFrame:
    """df, a table or checkpoint of narrow rows, marked for broadcast if it is counted to have no more rows than that."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def parts(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def col(name: str) -> Column:
    """A column by its exact name, dots and all."""
    return F.col("`" + name.replace("`", "``") + "`")


class Aside:
    """df's columns under numbers (c0, c1, ...), so that no name that an operator makes can clash with one of them."""

    def __init__(self, df: DataFrame):
        self.names = df.columns
        self.own = [f"c{k}" for k in range(len(self.names))]
        self.df = df.toDF(*self.own)

    def at(self, name: str) -> int:
        """The place of the column that df calls so: by its exact name, or else by one that differs in case alone."""
        same = [k for k, n in enumerate(self.names) if n == name] or [k for k, n in enumerate(self.names) if n.lower() == name.lower()]
        if len(same) != 1:
            raise ValueError(f"no single column {name} among {self.names}")
        return same[0]

    def of(self, name: str) -> Column:
        """That column."""
        return F.col(self.own[self.at(name)])

    def back(self, *replaced: str) -> list[Column]:
        """df's columns under their names, but those that the operator adds itself: its own take their place."""
        taken = {n.lower() for n in replaced}
        return [F.col(c).alias(n) for c, n in zip(self.own, self.names, strict=True) if n.lower() not in taken]
