"""Trigger events in, update events out."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def value_at(document: Column, path: str) -> Column:
    return F.try_variant_get(document, path, "variant")


def text_of(value: Column) -> Column:
    """A JSON string's text; any other JSON value is null."""
    return F.when(F.schema_of_variant(value) == "STRING", value.cast("string"))


def name_of(value: Column) -> Column:
    """A JSON value as a name; null, empty, zero and false name nothing."""
    kind, text = F.schema_of_variant(value), value.cast("string")
    empty = (
        F.when(kind == "STRING", text == "")
        .when(kind == "BOOLEAN", text == "false")
        .when(kind.rlike("^(ARRAY|OBJECT)"), text.isin("[]", "{}"))
        .otherwise(text.try_cast("double") == 0)
    )
    return F.when(~F.coalesce(empty, text.isNull()), text)


def update_event(dataset_id: Column, version: Column, bucket: Column) -> Column:
    """The five fields that announce a new projection."""
    base = F.concat(F.lit("datasets/"), dataset_id)
    return F.struct(
        F.lit("projection_update").alias("event"),
        dataset_id.alias("dataset_id"),
        bucket.alias("bucket"),
        F.concat(base, F.lit("/versions/"), version, F.lit("/manifest.json")).alias(
            "version_manifest_path"
        ),
        F.concat(base, F.lit("/projections/")).alias("projections_path"),
    )


def update_subject(dataset_id: Column) -> Column:
    return F.concat(F.lit("projection_update:"), dataset_id)
