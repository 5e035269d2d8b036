"""The series dimension of a dataset's configuration."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.lookup import BROADCAST_BYTES, BROADCAST_ROWS
from tidemark.schemas import SERIES_MAP


@dataclass(frozen=True)
class SeriesMap:
    """Configured series as a table, with the entries it came from (a file, so small)."""

    frame: DataFrame
    entries: tuple[dict, ...]

    @property
    def size(self) -> int:
        return len(self.entries)

    @property
    def small(self) -> bool:
        """Whether the table may be broadcast: both its rows and its texts are counted."""
        width = sum(16 + len(str(v).encode()) for e in self.entries for v in e.values())
        return self.size <= BROADCAST_ROWS and width <= BROADCAST_BYTES

    def of_layout(self, layout: str) -> SeriesMap:
        kept = tuple(e for e in self.entries if e["layout"] == layout)
        return SeriesMap(self.frame.where(F.col("layout") == layout), kept)

    @property
    def sheets(self) -> list[str]:
        return sorted({e["sheet"] for e in self.entries if e["sheet"] is not None})


def series_map(spark: SparkSession, config: dict) -> SeriesMap:
    """``config["parse_config"]["series_map"]`` in its order.

    A series is horizontal when it names a date row, else vertical.
    """
    listed = config.get("parse_config", {}).get("series_map", [])
    entries = []
    for number, item in enumerate(listed):
        entry = {name: item.get(name) for name in SERIES_MAP.fieldNames()}
        entry["ord"] = number
        code = item.get("internal_series_code")
        entry["internal_series_code"] = "" if code is None else str(code)
        entry["layout"] = "vertical" if item.get("fecha_row") is None else "horizontal"
        entry["drop_na"] = bool(item.get("drop_na", False))
        if entry["skip_rows_after_header"] is None:
            entry["skip_rows_after_header"] = 1
        entries.append(entry)
    names = SERIES_MAP.fieldNames()
    rows = [tuple(entry[name] for name in names) for entry in entries]
    return SeriesMap(spark.createDataFrame(rows, SERIES_MAP), tuple(entries))
