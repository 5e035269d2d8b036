"""Partition paths and object keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the shape of a partition path.
_PARTITION = r"([^/]+)/year=(\d+)/month=(\d+)/"


def month_text(wall: Column) -> Column:
    return F.lpad(F.month(wall).cast("string"), 2, "0")


def checked_code(code: Column, wall: Column) -> Column:
    """The series code, or an error in the task when a row has no partition."""
    usable = (F.coalesce(code, F.lit("")) != "") & wall.isNotNull()
    return F.when(usable, code).otherwise(
        F.raise_error(F.lit("an observation needs a series code and an observation time"))
    )


def partition_path(code: Column, wall: Column) -> Column:
    """``{code}/year={Y}/month={MM}/`` by wall clock; a row without code or time is an error."""
    return partition_path_of(
        checked_code(code, wall), F.year(wall).cast("string"), month_text(wall)
    )


def partition_path_of(code: Column, year: Column, month: Column) -> Column:
    return F.concat(code, F.lit("/year="), year, F.lit("/month="), month, F.lit("/"))


def partition_folder(columns: Sequence[str]) -> Column:
    """Path of the partition made by ``columns``: the bare code, ``name=value`` for the others."""
    parts = [
        F.col(name) if name == "internal_series_code"
        else F.concat(F.lit(f"{name}="), F.col(name).cast("string"))
        for name in columns
    ]
    return F.concat(F.concat_ws("/", *parts), F.lit("/"))


def partition_parts(path: Column, strict: bool = True) -> Column:
    """Struct of the three text parts; a malformed path is an error (null if not strict)."""
    pattern = "^" + _PARTITION + "?"
    parts = F.struct(
        F.regexp_extract(path, pattern, 1).alias("internal_series_code"),
        F.regexp_extract(path, pattern, 2).alias("year"),
        F.regexp_extract(path, pattern, 3).alias("month"),
    )
    found = F.when(path.rlike(pattern), parts)
    if not strict:
        return found
    return F.coalesce(
        found,
        F.raise_error(F.concat(F.lit("not a partition path: "), F.coalesce(path, F.lit("null")))),
    )


def partition_in(path: Column) -> Column:
    """The partition inside a longer object path (trailing slash required), else ''."""
    return F.regexp_extract(path, _PARTITION, 0)


def swap_prefix(key: Column, old: str, new: str) -> Column:
    """``old`` + rest -> ``new`` + rest."""
    return F.concat(F.lit(new), F.substring(key, len(old) + 1, 1 << 30))


def data_key(dataset_id: Column, area: str, partition: Column) -> Column:
    """Key of a partition's data file in ``staging`` or ``projections``."""
    inner = F.regexp_replace(partition, "/+$", "")
    return F.concat(
        F.lit("datasets/"), dataset_id, F.lit(f"/{area}/"), inner, F.lit("/data.json")
    )


def version_key(dataset_id: Column, version: Column, relative: Column) -> Column:
    """Key of one data file of a version."""
    return F.concat(
        F.lit("datasets/"), dataset_id, F.lit("/versions/"), version, F.lit("/data/"), relative
    )
