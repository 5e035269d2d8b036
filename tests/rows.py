"""Builders for small inputs."""

from datetime import datetime

from pyspark.sql import functions as F

from tidemark.schemas import CELLS

CODE = "internal_series_code"


def clock(text):
    return datetime.fromisoformat(text)


def grid_cells(spark, sheet, rows, source="book"):
    """{row: [values from column A]} -> cells; None leaves the cell out."""
    out = []
    for number, values in rows.items():
        for column, value in enumerate(values):
            if value is None:
                continue
            ts = value if isinstance(value, datetime) else None
            text = value if isinstance(value, str) else None
            num = float(value) if isinstance(value, (int, float)) else None
            out.append((source, sheet, number, column, ts, num, text))
    return spark.createDataFrame(out, CELLS)


def points(spark, rows):
    """(code, obs_ts text or None, value number or text) in input order."""
    out = [
        (
            n,
            code,
            clock(at) if at else None,
            float(value) if isinstance(value, (int, float)) else None,
            value if isinstance(value, str) else None,
        )
        for n, (code, at, value) in enumerate(rows)
    ]
    return spark.createDataFrame(
        out,
        "ord bigint, internal_series_code string, obs_ts timestamp_ntz, "
        "value_num double, value_str string",
    )


def observations(spark, rows, **extra):
    """(code, UTC time text or None, value) as observations."""
    out = [
        (code, clock(at) if at else None, None if value is None else float(value), n)
        for n, (code, at, value) in enumerate(rows)
    ]
    frame = spark.createDataFrame(
        out, "internal_series_code string, obs_local timestamp_ntz, value double, ord bigint"
    ).withColumn("obs_time", F.col("obs_local").cast("timestamp"))
    for name, value in extra.items():
        frame = frame.withColumn(name, value)
    return frame


def tuples(frame, *columns):
    return sorted(tuple(row) for row in frame.select(*columns).collect())
