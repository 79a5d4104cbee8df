"""Requests as a relation: a row for each, with what came back."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


#: Bytes of answers, as text, and answers that a task holds before it hands them on; the last may go beyond.
AT_ONCE_BYTES, AT_ONCE = 16 << 20, 1000
ANSWER = "ord bigint, status int, body string, error string"


class SpeculationError(RuntimeError):
    """Speculative tasks would send requests twice."""


def ask_each(requests: DataFrame, transport, headers: dict[str, str], seconds: float, *, side_by_side: int | None = None, per_host: int | None = 1, key_header: str | None = None) -> DataFrame:
    """ord, status, body, error for each row of requests (ord, url, data or null).

    With key_header, requests have a column key as well, which goes out in that header and comes back with
    the answer. At most side_by_side requests run at once (None: as many as the cluster has cores), and
    per_host to one host; with None rows are dealt without regard to hosts. A task hands its answers on
    when they reach AT_ONCE_BYTES, so it holds one body beyond that at most. The result is not stable: each
    action asks anew. Use land() once and go on from there.
    """
    if requests.sparkSession.conf.get("spark.speculation", "false").lower() == "true":
        raise SpeculationError("turn spark.speculation off: requests must not be sent twice")

    def frame(rows: list[tuple]) -> pd.DataFrame:
        names = ["ord", "status", "body", "error", "key"]
        made = pd.DataFrame(rows, columns=names).astype({"status": "Int32"})
        return made if key_header else made.drop(columns="key")

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, size = [], 0
        for df in frames:
            for number, url, data, key in df.itertuples(index=False):
                own = headers | {key_header: key} if key_header else headers
                status, body, error = transport.ask(url, own, seconds, data) if isinstance(url, str) else (None, None, "no address")
                held.append((number, status, body, error, key))
                size += len(body or "")
                if size >= AT_ONCE_BYTES or len(held) >= AT_ONCE:
                    yield frame(held)
                    held, size = [], 0
        if held:
            yield frame(held)

    side_by_side = side_by_side or requests.sparkSession.sparkContext.defaultParallelism
    host = F.coalesce(F.try_parse_url("url", F.lit("HOST")), F.lit(""))
    keys = [F.xxhash64("ord")] if per_host is None else [host, F.pmod(F.xxhash64("ord"), F.lit(per_host))]
    key = F.col("key") if key_header else F.lit(None).cast("string").alias("key")
    dealt = requests.select("ord", "url", F.col("data").cast("string").alias("data"), key).repartition(side_by_side, *keys)
    return dealt.mapInPandas(run, ANSWER + (", key string" if key_header else ""))


def land(responses: DataFrame, path: str, *, repeatable: bool = True) -> DataFrame:
    """Written to path and read from there, so that no later action asks again. What is there already is taken as it is.

    path must be one that all executors reach. A folder without Spark's mark of a complete write, which a run
    that died leaves, is written anew if that is harmless, as it is for targets and fetches. Otherwise, for
    posts, it is an error: some may have been sent. To go on, remove the folder, which sends all of its
    batch again, or move the batch's other folders to a new landing.
    """
    spark = responses.sparkSession
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = at.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(spark._jvm.org.apache.hadoop.fs.Path(path, "_SUCCESS")):
        responses.write.mode("overwrite" if repeatable else "errorifexists").parquet(path)
    return spark.read.schema(responses.schema).parquet(path)
