"""A whole run: list the targets, fetch, hand on, add up. `python -m sparkloom.plans.relay` runs it with the settings of the environment."""

from __future__ import annotations

import os
import sys
import tempfile
import uuid
import warnings
from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import targets as T
from ..operators.config import DISCOVERY_SECONDS, FETCH_SECONDS, INGEST_SECONDS, SAID_DISCOVERED, SAID_NOTHING, SAID_REFUSED, SAID_UNREADABLE, Config, ConfigurationError
from ..operators.outcomes import accepted, envelope, increments, summary_line, totals
from ..sources.ledger import Ledger
from ..sources.responses import ask_each, land
from ..sources.transports import Http


class DiscoveryError(RuntimeError):
    """The targets could not be listed; nothing was fetched or sent."""


def relay_batch(targets: DataFrame, config: Config, transport, landing: str, *, side_by_side: int | None = None, keys: bool | None = None) -> DataFrame:
    """Fetches and posts for targets (ord, feed_id and feed_url as VARIANT), each once; the totals as one row.

    The responses are kept under landing, which must be new for each batch: a second call with the same one
    sends nothing and adds up what is there. With keys (not None) posts go through a ledger, under keys of
    their own: a batch that died goes on where it was. True says that the service honours keys, so posts of
    which nothing is known are sent again; False, that it may not, so they are left and count as failures.
    """
    known = targets.select("ord", "feed_id", "feed_url", T.eligible(F.col("feed_id"), F.col("feed_url"), variant=True).alias("eligible"))
    known = land(known, f"{landing}/targets")
    # An address that is no text stays in the plan without one, so that it fails as a row.
    url = F.when(F.schema_of_variant("feed_url") == "STRING", F.try_variant_get(F.col("feed_url"), "$", "string"))
    asked = known.where("eligible").select("ord", url.alias("url"), F.lit(None).alias("data"))
    fetches = land(ask_each(asked, transport, config.feed_headers(), FETCH_SECONDS, side_by_side=side_by_side), f"{landing}/fetches")
    good = fetches.where(accepted(F.col("status"), F.col("body"))).join(known.select("ord", "feed_id"), "ord")
    sent = good.select("ord", F.lit(config.ingest_url).alias("url"), envelope(F.col("feed_id"), F.col("body")).alias("data"))
    if keys is None:
        posts = ask_each(sent, transport, config.service_headers(), INGEST_SECONDS, side_by_side=side_by_side, per_host=None)
        posts = land(posts, f"{landing}/posts", repeatable=False)
    else:
        ledger = Ledger(known.sparkSession, f"{landing}/ledger")
        posts = ledger.post(sent, transport, config.service_headers(), INGEST_SECONDS, scope=landing, honoured=keys, side_by_side=side_by_side)

    def named(df: DataFrame, what: str, body: Column) -> DataFrame:
        return df.select("ord", F.col("status").alias(f"{what}_status"), body.alias(f"{what}_body"), F.col("error").alias(f"{what}_error"))

    # Of a fetched text only whether it was accepted matters now, and that is one character.
    mark = F.when(accepted(F.col("status"), F.col("body")), F.lit("<"))
    rows = known.select("ord", "eligible").join(named(fetches, "fetch", mark), "ord", "left").join(named(posts, "post", F.col("body")), "ord", "left")
    return totals(increments(rows))


def run_relay(spark: SparkSession, config: Config, transport, landing: str, *, say: Callable[[str], None] = print, side_by_side: int | None = None, keys: bool | None = None) -> DataFrame | None:
    """The whole of it, with its messages; None if there is nothing to do. All targets are checked before any request to them."""
    if config.endpoint.startswith("http://"):
        warnings.warn("the token is sent without encryption", stacklevel=2)
    status, body, error = transport.ask(config.discovery_url, config.service_headers(), DISCOVERY_SECONDS)
    answer = spark.createDataFrame([(status, body)], "status int, body string")
    state = T.UNREADABLE if error else answer.select(T.discovery_state(F.col("status"), F.col("body"))).first()[0]
    if state == T.REFUSED:
        say(SAID_REFUSED.format(status))
    elif state == T.UNREADABLE:
        say(SAID_UNREADABLE)
    if state not in (T.LISTED, T.NOTHING):
        raise DiscoveryError(state)
    listed = T.listed_targets(answer)
    n = 0 if state == T.NOTHING else listed.count()
    say(SAID_DISCOVERED.format(n))
    if not n:
        say(SAID_NOTHING)
        return None
    made = relay_batch(listed, config, transport, landing, side_by_side=side_by_side, keys=keys)
    say(summary_line(made).first()[0])
    return made


def main(settings: Mapping[str, str] = os.environ, *, transport=None, say: Callable[[str], None] = print) -> int:
    """One run, and its exit code: 0 whatever became of single targets, 1 if settings are missing or the targets could not be listed.

    A list that is none, or whose members are none, is an error of its own and is raised. Besides the two
    settings of Config: RELAY_LANDING, a folder that all executors reach (one of its own for each run; the
    default is a new folder under spark.checkpoint.dir, and on one machine a temporary one), RELAY_HOSTS,
    the hosts that may be asked, with commas, and RELAY_KEYS=honoured if the service honours idempotency keys.
    """
    try:
        config = Config.of(settings)
    except ConfigurationError as e:
        say(str(e))
        return 1
    spark = SparkSession.builder.getOrCreate()
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared and not settings.get("RELAY_LANDING") and not spark.sparkContext.master.startswith("local"):
        raise ConfigurationError("set RELAY_LANDING or spark.checkpoint.dir to a folder that the driver and all executors share")
    landing = settings.get("RELAY_LANDING") or f"{shared or tempfile.mkdtemp(prefix='relay-')}/relay-{uuid.uuid4().hex}"
    transport = transport or Http(tuple(h for h in settings.get("RELAY_HOSTS", "").split(",") if h))
    try:
        run_relay(spark, config, transport, landing, say=say, keys=True if settings.get("RELAY_KEYS") == "honoured" else None)
    except DiscoveryError as e:
        if e.args[0] in (T.REFUSED, T.UNREADABLE):
            return 1
        raise
    return 0


if __name__ == "__main__":
    sys.exit(main())
