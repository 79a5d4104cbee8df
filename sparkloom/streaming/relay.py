"""The relay over targets that keep coming: a batch of requests for each micro-batch."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql.streaming.query import StreamingQuery

from ..operators.config import Config
from ..plans.relay import relay_batch
from ..sources.responses import land


def relay_stream(targets: DataFrame, config: Config, transport, landing: str, checkpoint: str, *, done: Callable[[DataFrame, int], None] | None = None, **trigger) -> StreamingQuery:
    """Starts the query. targets: ord, feed_id and feed_url (VARIANT). Each micro-batch lands under its number.

    A micro-batch that is run again after a failure finds the responses that it landed and does not send
    those again; totals by micro-batch are under totals/.
    """

    def each(batch: DataFrame, number: int) -> None:
        at = f"{landing}/batch={number}"
        made = land(relay_batch(batch, config, transport, at), f"{at}/totals")
        if done is not None:
            done(made, number)

    return targets.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()
