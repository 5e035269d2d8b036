"""Mixing sources to target weights by Poisson replication."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.exact import unused
from tidemark.operators.lookup import lookup_join
from tidemark.session import staged

# Added columns; a column of the documents with such a name is replaced.
ADDED = ("rate", "copies", "copy", "shuffle_key")


def poisson_mix(
    docs: DataFrame,
    weights: dict[str | None, float] | None = None,
    power: float = 0.5,
    epochs: float = 1.0,
    seed: int = 17,
    source: str = "source",
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """Every document repeated by a Poisson draw, in global random order.

    A source's target share is its entry in ``weights`` (others get none) or, without weights,
    its characters to ``power``.  Its documents are repeated at the mean rate that brings its
    share of ``epochs`` times all characters; a source without characters is repeated at
    ``epochs``.  The draw inverts the Poisson distribution at a uniform number hashed from seed
    and id, so it is the same on every run, and rows with one id are repeated alike.  A null
    source is a source; a null id is hashed as such; a null text has no characters; whole texts
    are counted.  An empty table stays empty.

    Returns all columns of ``docs`` and ``rate, copies, copy, shuffle_key``; rows are dealt to
    partitions by the key and ordered by it within.
    """
    drawn, names = _drawn(docs, weights, power, epochs, seed, source, doc_id, text)
    own = [c for c in docs.columns if c.lower() not in ADDED]
    return drawn.select(*own, *[F.col(name).alias(added) for added, name in zip(ADDED, names, strict=True)])


def mixed_documents(docs: DataFrame, **how) -> DataFrame:
    """The rows of ``poisson_mix`` with the columns of ``docs`` alone, all as they were."""
    defaults = {"weights": None, "power": 0.5, "epochs": 1.0, "seed": 17}
    drawn, _ = _drawn(docs, *(defaults | how).values(), "source", "doc_id", "text")
    return drawn.select(*docs.columns)


def _drawn(docs, weights, power, epochs, seed, source, doc_id, text) -> tuple[DataFrame, list[str]]:
    """``docs`` repeated, and the names that its four added columns have here."""
    rate, copies, copy, key, chance, own, cdf = names = [
        unused(docs, f"{name}_") for name in (*ADDED, "chance", "own", "cdf")
    ]
    rates = staged(source_rates(docs, weights, power, epochs, source, text), "rates")
    table = rates.select(F.col("_source").alias(own), F.col("rate").alias(rate), F.col("_cdf").alias(cdf))
    uniform = hashed_uniform(F.lit(f"{seed}:"), F.col(doc_id))
    rows = docs.withColumns({chance: uniform, own: named(F.col(source))})
    drawn = lookup_join(rows, table, [own], "inner", [F.col(chance)])
    number = F.size(F.filter(cdf, lambda reached: reached < F.col(chance))).cast("long")
    counted = drawn.withColumn(copies, number).drop(cdf, chance, own).where(F.col(copies) > 0)
    repeated = counted.withColumn(copy, F.explode(F.sequence(F.lit(1).cast("long"), F.col(copies))))
    text_key = F.md5(F.concat(F.lit(f"{seed}:"), shown(F.col(doc_id)), F.lit(":"), F.col(copy).cast("string")))
    dealt = repeated.withColumn(key, text_key).repartition(key).sortWithinPartitions(key)
    return dealt, names[:4]


def source_rates(
    docs: DataFrame,
    weights: dict[str | None, float] | None,
    power: float,
    epochs: float,
    source: str,
    text: str,
) -> DataFrame:
    """``_source, size, rate, _cdf``: one row per source, with its distribution function."""
    length = F.length(F.coalesce(F.col(text), F.lit(""))).cast("long")
    sizes = docs.groupBy(named(F.col(source)).alias("_source")).agg(F.sum(length).alias("size"))
    if weights is None:
        weighed = sizes.withColumn("weight", F.pow(F.col("size").cast("double"), F.lit(float(power))))
    else:
        given = docs.sparkSession.createDataFrame(
            [(k, float(w)) for k, w in weights.items()], "source string, weight double"
        ).select(named(F.col("source")).alias("_source"), "weight")
        weighed = sizes.join(F.broadcast(given), "_source")
    weighed = staged(weighed, "sizes")
    total = weighed.agg(F.sum("size"), F.sum("weight")).first()
    characters = sizes.agg(F.sum("size")).first()[0] if weights is not None else total[0]
    scale = float(epochs) * float(characters or 0) / float(total[1] or 1)
    rate = F.when(F.col("size") > 0, F.lit(scale) * F.col("weight") / F.col("size")).otherwise(
        F.lit(float(epochs))
    )
    return weighed.select("_source", "size", rate.alias("rate")).mapInPandas(
        _distributions, "_source string, size long, rate double, _cdf array<double>"
    )


def _distributions(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for frame in frames:
        yield frame.assign(_cdf=[poisson_cdf(rate) for rate in frame["rate"]])


def poisson_cdf(rate: float) -> np.ndarray:
    """P(N <= k) for k = 0, 1, ... until nothing is left to tell from 1."""
    if rate <= 0:
        return np.ones(1)
    last = int(rate + 12 * np.sqrt(rate) + 40)
    k = np.arange(1, last + 1)
    logs = np.concatenate([[-rate], -rate + np.cumsum(np.log(rate) - np.log(k))])
    return np.minimum(np.cumsum(np.exp(logs)), 1.0)


def hashed_uniform(prefix: Column, doc_id: Column) -> Column:
    """A number strictly between 0 and 1 from the first 52 bits of a digest."""
    digits = F.substring(F.md5(F.concat(prefix, shown(doc_id))), 1, 13)
    return (F.conv(digits, 16, 10).cast("double") + F.lit(0.5)) / F.lit(float(1 << 52))


def shown(doc_id: Column) -> Column:
    return F.coalesce(doc_id.cast("string"), F.lit("null"))


def named(source: Column) -> Column:
    """Sources with a mark before them, so that a null source has a name of its own."""
    return F.coalesce(F.concat(F.lit("="), source.cast("string")), F.lit("null"))


# The query's rows; ln(rate) instead of powers keeps large rates from overflowing.
MIX_SQL = """
WITH sizes AS (
    SELECT source, sum(length(coalesce(text, ''))) AS size FROM documents GROUP BY source
), rates AS (
    SELECT source, CASE WHEN size > 0 THEN (SELECT sum(size) FROM sizes)
        / (SELECT sum(sqrt(size)) FROM sizes) * sqrt(size) / size ELSE 1.0 END AS rate
    FROM sizes
), pmf AS (
    SELECT source, rate, k, exp(k * ln(rate) - rate - lgamma(k + 1)) AS p
    FROM rates, (SELECT unnest(range(0, 400)) AS k)
), cdf AS (
    SELECT source, rate, k, sum(p) OVER (PARTITION BY source ORDER BY k) AS reached FROM pmf
), drawn AS (
    SELECT d.doc_id, d.source, d.text,
        (('0x' || substr(md5('17:' || coalesce(CAST(d.doc_id AS VARCHAR), 'null')), 1, 13))::BIGINT
            + 0.5::DOUBLE) / 4503599627370496.0::DOUBLE AS u
    FROM documents d
), counted AS (
    SELECT d.doc_id, d.source, d.text, any_value(c.rate) AS rate, count(*) FILTER (c.reached < d.u) AS copies
    FROM drawn d JOIN cdf c ON d.source IS NOT DISTINCT FROM c.source
    GROUP BY d.doc_id, d.source, d.text, d.u
)
SELECT doc_id, source, round(rate, 9) AS rate, CAST(copies AS BIGINT) AS copies, CAST(copy AS BIGINT) AS copy,
    md5('17:' || coalesce(CAST(doc_id AS VARCHAR), 'null') || ':' || CAST(copy AS VARCHAR)) AS shuffle_key,
    text
FROM (SELECT *, unnest(range(1, copies + 1)) AS copy FROM counted WHERE copies > 0)
"""
