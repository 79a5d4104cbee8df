"""Columns over VARIANT values, for documents whose types are only known as they come."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def parsed(text: str | Column) -> Column:
    """The document; null where the text is none."""
    return F.try_parse_json(F.col(text) if isinstance(text, str) else text)


def member(v: Column, key: str) -> Column:
    """The value at a key; null if there is none, which an explicit null is not."""
    return F.try_variant_get(v, f"$.{key}", "variant")


def is_object(v: Column) -> Column:
    return F.coalesce(F.schema_of_variant(v).startswith("OBJECT"), F.lit(False))


def is_array(v: Column) -> Column:
    return F.coalesce(F.schema_of_variant(v).startswith("ARRAY"), F.lit(False))


def truthy(v: Column) -> Column:
    """Whether a value counts as one: not missing, null, false, zero, or an empty text, list or object."""
    kind = F.schema_of_variant(v)
    told = (
        F.when(v.isNull() | F.is_variant_null(v), False)
        .when(kind == "BOOLEAN", F.try_variant_get(v, "$", "boolean"))
        .when(kind == "STRING", F.try_variant_get(v, "$", "string") != "")
        .when(kind.startswith("ARRAY"), F.to_json(v) != "[]")
        .when(kind.startswith("OBJECT"), kind != "OBJECT<>")
        .otherwise(F.try_variant_get(v, "$", "double") != 0)
    )
    return F.coalesce(told, F.lit(True))


def counter(document: Column, key: str) -> Column:
    """A counter of a response: 0 if the key is missing, null if its value cannot be added up.

    Numbers count as they are and booleans as 0 or 1. Texts, lists, objects, explicit nulls, and documents
    that are no objects give null.
    """
    v = member(document, key)
    kind = F.schema_of_variant(v)
    number = (
        F.when(v.isNull(), F.lit(0).cast("decimal(38,6)"))
        .when(kind == "BOOLEAN", F.try_variant_get(v, "$", "boolean").cast("int").cast("decimal(38,6)"))
        .when((kind == "BIGINT") | kind.startswith("DECIMAL") | (kind == "DOUBLE"), F.try_variant_get(v, "$", "decimal(38,6)"))
    )
    return F.when(is_object(document), number)
