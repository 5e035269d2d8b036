"""High-water marks: which observations are new, and where each series stands."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.times import drop_zone
from tidemark.operators.lookup import lookup_join
from tidemark.sources.series import SeriesMap

CODE = "internal_series_code"
MARK = "last_obs_local"


def high_water_marks(observations: DataFrame) -> DataFrame:
    """Latest wall-clock observation per series; rows without code or time do not count."""
    return (
        observations.where((F.col(CODE) != "") & F.col("obs_local").isNotNull())
        .groupBy(CODE)
        .agg(F.max("obs_local").alias(MARK))
    )


def marks_for(state: DataFrame, series: SeriesMap) -> DataFrame:
    """The known marks of the configured series; series without a mark are absent."""
    configured = series.frame.where(F.col(CODE) != "").select(CODE).distinct()
    return lookup_join(
        state.where(F.col(MARK).isNotNull()),
        configured,
        [CODE],
        "left_semi",
        [MARK],
        series.small,
    )


def only_new(
    points: DataFrame,
    marks: DataFrame,
    time: str = "obs_ts",
    spread: list[str] | None = None,
    small: bool | None = None,
) -> DataFrame:
    """Drop points at or before their series' mark; no mark or no date means keep."""
    known = marks.select(CODE, F.col(MARK).alias("_mark"))
    joined = lookup_join(points, known, [CODE], "left", spread or [time], small)
    old = F.coalesce(F.col(time) <= F.col("_mark"), F.lit(False))
    return joined.where(~old).drop("_mark")


def scan_floor(marks: DataFrame, series: SeriesMap) -> datetime | None:
    """The time at or before which every configured series is done; None if one has no mark.

    A literal bound lets a scan skip files and row groups, which the join with the marks
    cannot.
    """
    codes = {entry[CODE] for entry in series.entries if entry[CODE]}
    known = marks.agg(F.count_distinct(CODE).alias("codes"), F.min(MARK).alias("floor")).first()
    return known["floor"] if codes and known["codes"] == len(codes) else None


def merge_state(old: DataFrame, batch: DataFrame, monotonic: bool = False) -> DataFrame:
    """New state: the batch's marks replace those of its series, the rest stay.

    Marks may move back unless ``monotonic``.  One grouping instead of an outer join.
    """
    keys = ["dataset_id", CODE]
    both = old.select(*keys, MARK, F.lit(0).alias("turn")).unionByName(
        batch.select(*keys, MARK, F.lit(1).alias("turn"))
    )
    mark = F.max(MARK) if monotonic else F.max_by(MARK, "turn")
    return both.groupBy(*keys).agg(mark.alias(MARK))


def latest_state(state_log: DataFrame) -> DataFrame:
    """The last saved mark per dataset and series of an append-only log.

    The order is that of saving (``seq``), not of the clocks of those who saved; logs without
    it are ordered by ``saved_at``.
    """
    return latest_state_rows(state_log).select("dataset_id", CODE, MARK)


def latest_state_rows(state_log: DataFrame) -> DataFrame:
    """The whole log row of each series' last mark."""
    order = F.struct(*[c for c in ("seq", "saved_at") if c in state_log.columns])
    rest = [c for c in state_log.columns if c not in ("dataset_id", CODE)]
    last = F.max_by(F.struct(*rest), order).alias("_last")
    rows = state_log.groupBy("dataset_id", CODE).agg(last).select("dataset_id", CODE, "_last.*")
    return rows.select(*state_log.columns)


def state_to_json(state: DataFrame) -> DataFrame:
    """``dataset_id, state_json``: the marks as one JSON object per dataset, codes in order.

    It is the form ``state_from_json`` reads, for systems that keep marks in such a file; its
    length is that of the list of series.  Series without a mark are left out.
    """
    entry = F.struct(F.col(CODE), F.date_format(MARK, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("iso"))
    known = state.where(F.col(CODE).isNotNull() & F.col(MARK).isNotNull())
    entries = F.array_sort(F.collect_list(entry))
    return known.groupBy("dataset_id").agg(
        F.to_json(F.map_from_entries(entries)).alias("state_json")
    )


def state_from_json(documents: DataFrame, text: str = "state_json") -> DataFrame:
    """State kept as a JSON object of code -> ISO time, one document per ``dataset_id``.

    Offsets are dropped, not converted.  A blank or broken document is an empty state, and
    an unreadable time is no mark for its series alone.
    """
    marks = F.from_json(F.col(text), "map<string,string>")
    return (
        documents.select("dataset_id", F.explode(marks).alias(CODE, "iso"))
        .select("dataset_id", CODE, drop_zone(F.col("iso")).alias(MARK))
        .where(F.col(MARK).isNotNull())
    )
