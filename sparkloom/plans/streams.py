"""Registered queries that run events as streams, in parts: each part is a run of its own that goes on from the one before."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.shared import Scratch
from ..streaming import feeds
from ..streaming.runs import run_to_end, state_session
from ..streaming.sessions import late_by_user, sessions

GAP_HOURS, DELAY_HOURS = 6, 12
#: One event in so many comes with the second part, though it is of the first part's time.
DELAYED = 20
COLUMNS = ("event_id", "ts", "user_id", "event_type")


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/events.parquet").select(*COLUMNS)


def _middle(events: DataFrame) -> int:
    """Microseconds of the middle between the first and the last event."""
    micros = F.unix_micros(F.col("ts").cast("timestamp"))
    first, last = events.agg(F.min(micros), F.max(micros)).first()
    return ((first or 0) + (last or 0)) // 2


def feed_backoff(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event as an attempt to reach the feed of its user: half of them in a first run, the others after a restart."""
    events = _events(spark, sf_dir)
    middle, at = _middle(events), F.unix_micros(F.col("ts").cast("timestamp"))
    folder, own = Scratch(spark), state_session(spark)
    came, out, mark = folder.new(), folder.new(), folder.new()
    for part in (events.where(at <= middle), events.where(at > middle)):
        part.write.mode("append").parquet(came)
        stream = own.readStream.schema(events.schema).parquet(came)
        run_to_end(feeds.back_off(stream, feed=F.col("user_id"), attempt=F.col("event_id"), at=F.col("ts"), failed=F.col("event_type") == "error"), out, mark)
    return spark.read.schema(feeds.SCHEMA).parquet(out)


def event_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sessions of each user, and how many of the user's events came too late for any.

    The first run has the first half, but for some events; the second has these and the second half. Those
    of them that the watermark has passed are late. A last run has one row alone, much later than all, that
    closes what is open.
    """
    events = _events(spark, sf_dir)
    hour, at = feeds.HOUR, F.unix_micros(F.col("ts").cast("timestamp"))
    middle = _middle(events)
    early = (at <= middle) & (F.col("event_id") % DELAYED != 0)
    most, last = events.agg(F.max(F.when(early, at)), F.max(at)).first()
    mark = (most or 0) // 1000 * 1000 - DELAY_HOURS * hour
    delayed = (at <= middle) & (F.col("event_id") % DELAYED == 0) & ((at + GAP_HOURS * hour <= mark) | (at > mark + GAP_HOURS * hour))
    end = spark.range(1).select(F.lit(None).cast("long").alias("event_id"), F.timestamp_micros(F.lit((last or 0) + (GAP_HOURS + DELAY_HOURS + 1) * hour)).cast("timestamp_ntz").alias("ts"), F.lit(None).cast("long").alias("user_id"), F.lit(None).cast("string").alias("event_type"))
    folder = Scratch(spark)
    came, out, checkpoint = folder.new(), folder.new(), folder.new()
    for part in (events.where((at <= middle) & ~delayed), events.where((at > middle) | delayed), end):
        part.write.mode("append").parquet(came)
        stream = spark.readStream.schema(events.schema).parquet(came)
        made = sessions(stream, user=F.col("user_id"), at=F.col("ts"), gap=f"{GAP_HOURS} hours", delay=f"{DELAY_HOURS} hours", errors=(F.col("event_type") == "error").cast("int"))
        run_to_end(made, out, checkpoint)
    closed = spark.read.schema("user bigint, start bigint, last bigint, rows bigint, errors bigint").parquet(out)
    late = late_by_user(events, closed, user=F.col("user_id"), at=F.col("ts")).withColumnRenamed("user", "_u")
    return closed.join(late, F.col("user").eqNullSafe(F.col("_u")), "left").select(F.col("user").alias("user_id"), "start", "last", "rows", "errors", "late")


QUERIES = {"feed_backoff": feed_backoff, "event_sessions": event_sessions}

_HOUR = feeds.HOUR
ORACLE_SQL = {
    "feed_backoff": f"""
WITH RECURSIVE e AS (SELECT user_id, event_id, epoch_us(ts) AS us, coalesce(event_type = 'error', false) AS bad, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS k FROM events WHERE ts IS NOT NULL),
s AS (
  SELECT user_id, event_id, k, CASE WHEN bad THEN 'failed' ELSE 'ok' END AS action, CASE WHEN bad THEN 1 ELSE 0 END AS failures, CASE WHEN bad THEN us + {feeds.WAIT} ELSE 0 END AS until, us FROM e WHERE k = 1
  UNION ALL
  SELECT user_id, event_id, k, CASE WHEN us < u THEN 'held' WHEN bad THEN 'failed' ELSE 'ok' END,
         CASE WHEN us < u THEN f WHEN bad THEN f + 1 ELSE 0 END, CASE WHEN us < u THEN u WHEN bad THEN us + {feeds.WAIT} * CAST(pow(2, least(f, {feeds.DOUBLINGS})) AS BIGINT) ELSE 0 END, us
  FROM (SELECT e.*, CASE WHEN e.us - s.us > {feeds.FORGET} THEN 0 ELSE s.failures END AS f, CASE WHEN e.us - s.us > {feeds.FORGET} THEN 0 ELSE s.until END AS u
        FROM s JOIN e ON e.user_id IS NOT DISTINCT FROM s.user_id AND e.k = s.k + 1))
SELECT user_id AS feed, event_id AS attempt, action, failures, until AS wait_until FROM s""",
    "event_sessions": f"""
WITH e AS (SELECT *, epoch_us(ts) AS us FROM events WHERE ts IS NOT NULL),
b AS (SELECT (min(us) + max(us)) // 2 AS middle FROM e),
w AS (SELECT max(us) // 1000 * 1000 - {DELAY_HOURS * _HOUR} AS mark FROM e, b WHERE us <= middle AND event_id % {DELAYED} <> 0),
l AS (SELECT e.*, us <= middle AND event_id % {DELAYED} = 0 AND us + {GAP_HOURS * _HOUR} <= mark AS late FROM e, b, w),
g AS (SELECT *, CASE WHEN us - lag(us) OVER o < {GAP_HOURS * _HOUR} THEN 0 ELSE 1 END AS new FROM l WHERE NOT late WINDOW o AS (PARTITION BY user_id ORDER BY us)),
i AS (SELECT *, sum(new) OVER (PARTITION BY user_id ORDER BY us, event_id) AS island FROM g),
n AS (SELECT user_id, count(*) FILTER (late) AS late FROM l GROUP BY 1)
SELECT i.user_id, min(us) AS start, max(us) AS last, count(*) AS rows, count(*) FILTER (event_type = 'error') AS errors, any_value(n.late) AS late
FROM i JOIN n ON i.user_id IS NOT DISTINCT FROM n.user_id GROUP BY i.user_id, island""",
}
