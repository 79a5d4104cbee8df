"""Targets: what the service lists, and which of it is worth a request."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.variants import is_array, is_object, member, parsed, truthy

#: What a discovery response may amount to. The last two end a run before anything is sent.
LISTED, NOTHING, REFUSED, UNREADABLE, WRONG_TYPE, WRONG_TARGET = "listed", "nothing", "refused", "unreadable", "wrong_type", "wrong_target"


def discovery_state(status: Column, body: Column) -> Column:
    """One of the states above. A missing list is an empty one; a null, a number or a boolean in its place is not."""
    document = parsed(body)
    listed = member(document, "targets")
    members = F.try_variant_get(listed, "$", "array<variant>")
    return (
        F.when(F.coalesce(status != 200, F.lit(True)), REFUSED)
        .when(~is_object(document), UNREADABLE)
        .when(listed.isNull(), NOTHING)
        .when(is_array(listed) & (F.size(members) == 0), NOTHING)
        .when(is_array(listed), F.when(F.forall(members, is_object), LISTED).otherwise(WRONG_TARGET))
        .when((F.to_json(listed) == '""') | (F.to_json(listed) == "{}"), NOTHING)
        .when(is_object(listed) | (F.schema_of_variant(listed) == "STRING"), WRONG_TARGET)
        .otherwise(WRONG_TYPE)
    )


def listed_targets(discovery: DataFrame, body: str = "body", keep: tuple[str, ...] = ()) -> DataFrame:
    """ord, feed_id and feed_url (VARIANT) of each listed target, in the order of the list; ord is their identity.

    keep: columns of discovery that come along.
    """
    members = F.try_variant_get(member(parsed(body), "targets"), "$", "array<variant>")
    rows = discovery.select(*keep, F.posexplode(members).alias("ord", "target"))
    return rows.select(*keep, F.col("ord").cast("long").alias("ord"), member(F.col("target"), "id").alias("feed_id"), member(F.col("target"), "feed_url").alias("feed_url"))


def typed_targets(rows: DataFrame, feed_id: str, feed_url: str) -> DataFrame:
    """feed_id and feed_url of a table whose types are known."""
    return rows.select(F.col(feed_id).alias("feed_id"), F.col(feed_url).alias("feed_url"))


def eligible(feed_id: Column, feed_url: Column, *, variant: bool = False) -> Column:
    """Never null: whether both values count. For typed columns this is a filter that a Parquet scan can take over."""
    if variant:
        return truthy(feed_id) & truthy(feed_url)
    return feed_id.isNotNull() & (feed_id != 0) & feed_url.isNotNull() & (feed_url != "")


def discovered(targets: DataFrame) -> DataFrame:
    return targets.agg(F.count(F.lit(1)).alias("discovered"))
