"""Schemas of the tables that travel between stages."""

from __future__ import annotations

from pyspark.sql.types import (
    BooleanType,
    DataType,
    DecimalType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
    TimestampType,
)

PARTITION_COLUMNS = ["internal_series_code", "year", "month"]
POINT_ORDER = ["source_id", "series_ord", "pos"]

_TEXT, _INT, _LONG, _DOUBLE = StringType(), IntegerType(), LongType(), DoubleType()
_INSTANT, _CLOCK, _FLAG = TimestampType(), TimestampNTZType(), BooleanType()


def _table(**columns: DataType) -> StructType:
    return StructType([StructField(name, kind) for name, kind in columns.items()])


# One row per worksheet cell; at most one of ts / num / str is set.
CELLS = _table(
    source_id=_TEXT, sheet=_TEXT, row=_INT, col=_INT, ts=_CLOCK, num=_DOUBLE, str=_TEXT
)

SERIES_MAP = _table(
    ord=_INT,
    internal_series_code=_TEXT,
    unit=_TEXT,
    frequency=_TEXT,
    sheet=_TEXT,
    layout=_TEXT,
    header_row=_INT,
    skip_rows_after_header=_INT,
    date_col=_TEXT,
    value_col=_TEXT,
    fecha_row=_INT,
    fecha_start_col=_TEXT,
    valor_row=_INT,
    valor_start_col=_TEXT,
    drop_na=_FLAG,
)

# `pos` is the worksheet row (vertical layout) or the offset (horizontal layout).
POINTS = _table(
    source_id=_TEXT,
    series_ord=_INT,
    pos=_LONG,
    internal_series_code=_TEXT,
    unit=_TEXT,
    frequency=_TEXT,
    obs_ts=_CLOCK,
    obs_str=_TEXT,
    value_num=_DOUBLE,
    value_str=_TEXT,
)

# obs_time is the instant, obs_local the wall clock in the dataset's zone.  `ord` is only set
# when rows were not de-duplicated, so that "first" stays defined in later merges.
OBSERVATIONS = _table(
    obs_time=_INSTANT,
    obs_local=_CLOCK,
    internal_series_code=_TEXT,
    value=_DOUBLE,
    unit=_TEXT,
    frequency=_TEXT,
    collection_date=_INSTANT,
    ord=_table(source_id=_TEXT, series_ord=_INT, pos=_LONG),
)

STORED_OBSERVATIONS = StructType(OBSERVATIONS.fields + _table(year=_INT, month=_TEXT).fields)

# The same observations in the text form of published JSON files.
PUBLISHED = _table(
    obs_time=_TEXT,
    internal_series_code=_TEXT,
    value=_DOUBLE,
    unit=_TEXT,
    frequency=_TEXT,
    collection_date=_TEXT,
)

STATE = _table(dataset_id=_TEXT, internal_series_code=_TEXT, last_obs_local=_CLOCK)
STATE_LOG = StructType(STATE.fields + _table(saved_at=_INSTANT, seq=_LONG).fields)

COMMIT_LOG = _table(commit_seq=_LONG, dataset_id=_TEXT, version_id=_TEXT, committed_at=_INSTANT)

PROJECTED_VERSIONS = _table(
    dataset_id=_TEXT, version_id=_TEXT, projected_at=_INSTANT, commit_seq=_LONG
)

PUBLISH_LOG = _table(version_id=_TEXT, staging=_TEXT, step=_TEXT, noted_at=_INSTANT)

# What a run of a dataset has reached: `started` before its commit, `saved` after its marks.
RUN_JOURNAL = _table(version_id=_TEXT, phase=_TEXT, project=_FLAG, noted_at=_INSTANT)

# What lies in the files of a projection, per series and month: `change` is 1 in the record of the
# merge that brought the file and -1 in that of the one that took it away.  A row with `change` 0
# names a version that the merge brought in.
FILE_RECORDS = _table(
    turn=_LONG,
    change=_INT,
    merged_id=_TEXT,
    file=_TEXT,
    internal_series_code=_TEXT,
    year=_INT,
    month=_TEXT,
    points=_LONG,
    min_obs_time=_INSTANT,
    max_obs_time=_INSTANT,
    key_sum=DecimalType(38, 0),
    row_sum=DecimalType(38, 0),
)

# Rows of a stream that are not after their series' mark at its start.
LATE_ROWS = StructType(
    OBSERVATIONS.fields[:4] + _table(last_obs_local=_CLOCK, batch=_TEXT).fields
)

# Rows that a merge did not take, since their key had another value.
REFUSED = _table(
    obs_time=_INSTANT,
    internal_series_code=_TEXT,
    stored_value=_DOUBLE,
    refused_value=_DOUBLE,
    batch_rows=_LONG,
    least_value=_DOUBLE,
    largest_value=_DOUBLE,
    is_stored=_FLAG,
)

# One row per data file of a version: everything a manifest says is derived from it.
FILE_INDEX = _table(
    internal_series_code=_TEXT,
    year=_INT,
    month=_TEXT,
    file_name=_TEXT,
    points=_LONG,
    min_obs_local=_CLOCK,
    max_obs_local=_CLOCK,
    min_obs_time=_INSTANT,
    max_obs_time=_INSTANT,
    collection_date=_INSTANT,
)

_RANGE = _table(min_obs_time=_TEXT, max_obs_time=_TEXT)

MANIFEST = _table(
    version_id=_TEXT,
    dataset_id=_TEXT,
    created_at=_TEXT,
    collection_date=_TEXT,
    data_points_count=_LONG,
    series_count=_LONG,
    date_range=_RANGE,
    date_range_utc=_RANGE,
    partition_strategy=_TEXT,
    file_count=_LONG,
    partition_count=_LONG,
    unique_keys=_FLAG,
)
