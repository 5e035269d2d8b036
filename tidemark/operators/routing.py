"""Trigger events to the datasets they ask for."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.events import name_of, text_of, value_at


def route_events(
    events: DataFrame, column: str = "event_json", default: str | None = None
) -> DataFrame:
    """Add ``dataset_id``: named directly, else in ``detail``, else by the first queue record.

    A record body is JSON text, possibly encoded twice; a body that is not text, or not JSON,
    is passed over.  Null (without a default) marks an event nobody claims.  Works on a batch
    or a stream.  Each document is parsed in a projection of its own, hence once per row.
    """
    own = events.columns
    names = ["_direct", "_detail", "_body", "_inner"]
    documents = (
        events.withColumn("_doc", F.try_parse_json(column))
        .withColumn("_value", value_at(F.col("_doc"), "$.Records[0].body"))
        .withColumn("_body_doc", F.try_parse_json(text_of(F.col("_value"))))
        .withColumn("_inner_doc", F.try_parse_json(text_of(F.col("_body_doc"))))
    )
    values = documents.select(
        *own,
        value_at(F.col("_doc"), "$.dataset_id").alias("_direct"),
        value_at(F.col("_doc"), "$.detail.dataset_id").alias("_detail"),
        value_at(F.col("_body_doc"), "$.dataset_id").alias("_body"),
        value_at(F.col("_inner_doc"), "$.dataset_id").alias("_inner"),
    )
    found = F.coalesce(*[name_of(F.col(name)) for name in names], F.lit(default or None))
    return values.select(*own, found.alias("dataset_id"))


def accepted(routed: DataFrame) -> DataFrame:
    return routed.where(F.col("dataset_id").isNotNull())


def rejected(routed: DataFrame) -> DataFrame:
    """The side output: events that name no dataset."""
    return routed.where(F.col("dataset_id").isNull())


def requested_datasets(routed: DataFrame) -> DataFrame:
    """Each dataset to run, once."""
    return accepted(routed).select("dataset_id").distinct()
