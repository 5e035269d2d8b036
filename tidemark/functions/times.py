"""Wall clocks (timestamp_ntz), instants (timestamp) and their text forms.

The session time zone must be UTC (see ``session.configure``).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_VERSION_PATTERN = "yyyyMMdd_HHmmss_SSSSSS"
_SECONDS_PATTERN = "yyyy-MM-dd'T'HH:mm:ss"
UTC_NAMES = {"UTC", "Etc/UTC", "GMT", "Z"}


def to_instant(wall: Column, zone: str) -> Column:
    """Read a wall clock in ``zone``; an hour that occurs twice means standard time."""
    clock = wall.cast("timestamp")
    if zone in UTC_NAMES:
        return clock
    day = F.make_dt_interval(days=F.lit(1))
    earlier = F.to_utc_timestamp(clock, zone)
    # The offset of the same clock time one day later is the one after the clock went back.
    later = F.to_utc_timestamp(clock + day, zone) - day
    return F.when(F.from_utc_timestamp(later, zone) == clock, later).otherwise(earlier)


def to_wall_clock(instant: Column, zone: str) -> Column:
    """The clock reading in ``zone`` at an instant."""
    moved = instant if zone in UTC_NAMES else F.from_utc_timestamp(instant, zone)
    return moved.cast("timestamp_ntz")


def drop_zone(iso_text: Column) -> Column:
    """ISO text with any offset (or none) -> its wall clock, without converting it."""
    bare = F.regexp_replace(iso_text, r"(Z|[+-]\d{2}:?\d{2})$", "")
    return bare.try_cast("timestamp_ntz")


def parse_date_text(text: Column, formats: tuple[str, ...] = ()) -> Column:
    """ISO-like date text, else the first of ``formats`` that fits, else null."""
    tries = [F.trim(text).try_cast("timestamp_ntz")]
    tries += [F.try_to_timestamp(F.trim(text), F.lit(f)).cast("timestamp_ntz") for f in formats]
    return F.coalesce(*tries)


def iso_text(wall: Column, instant: Column) -> Column:
    """ISO-8601 with the zone's own offset; microseconds only when there are any."""
    offset = F.timestamp_diff("MINUTE", instant, wall.cast("timestamp"))
    size = F.abs(offset)
    micros = F.date_format(wall, "SSSSSS")
    return F.concat(
        F.date_format(wall, _SECONDS_PATTERN),
        F.when(micros == "000000", "").otherwise(F.concat(F.lit("."), micros)),
        F.when(offset < 0, "-").otherwise("+"),
        F.lpad(F.floor(size / 60).cast("string"), 2, "0"),
        F.lit(":"),
        F.lpad((size % 60).cast("string"), 2, "0"),
    )


def manifest_text(clock: Column) -> Column:
    """Seconds with a literal ``Z`` whatever the zone: the manifest's own convention."""
    return F.date_format(clock, _SECONDS_PATTERN + "'Z'")


def version_id(clock: Column) -> Column:
    """``vYYYYMMDD_HHMMSS_ffffff``: sorts by time as text."""
    return F.concat(F.lit("v"), F.date_format(clock, _VERSION_PATTERN))
