"""Locale decimals and spreadsheet column letters."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The text forms a decimal may take (underscores between digits are legal).
_NUMBER = (
    r"(?i)^[+-]?(\d+(_\d+)*\.?(\d+(_\d+)*)?|\.\d+(_\d+)*)(e[+-]?\d+(_\d+)*)?$"
)
_INFINITY = r"(?i)^[+-]?inf(inity)?$"
_NOT_A_NUMBER = r"(?i)^[+-]?nan$"
_OUTER_SPACE = r"(?U)^[\s\x1c-\x1f]+|[\s\x1c-\x1f]+$"


def _to_double(text: Column) -> Column:
    # A plain cast would take "1d" and refuse "1_000", so the accepted forms are spelled out.
    return (
        F.when(text.rlike(_NUMBER), F.replace(text, F.lit("_"), F.lit("")).try_cast("double"))
        .when(text.rlike(_INFINITY), text.try_cast("double"))
        .when(text.rlike(_NOT_A_NUMBER), F.lit(float("nan")))
    )


def parse_decimal(text: Column) -> Column:
    """``'1,5'`` -> 1.5, ``'1 234'`` -> 1234.0; anything else that is not one number -> null."""
    dotted = F.replace(text, F.lit(","), F.lit("."))
    packed = F.replace(dotted, F.lit(" "), F.lit(""))
    return _to_double(F.regexp_replace(packed, _OUTER_SPACE, ""))


def parse_grid_decimal(text: Column) -> Column:
    """The stricter form used while reading grids: inner spaces and NaN give null."""
    dotted = F.replace(text, F.lit(","), F.lit("."))
    return not_nan(_to_double(F.regexp_replace(dotted, _OUTER_SPACE, "")))


def not_nan(number: Column) -> Column:
    return F.when(~F.isnan(number), number)


def column_index(letters: Column) -> Column:
    """Spreadsheet column letters to a 0-based index: A -> 0, Z -> 25, AA -> 26."""
    characters = F.filter(F.split(F.upper(letters), ""), lambda c: c != "")
    return (
        F.aggregate(
            characters, F.lit(0), lambda total, c: total * 26 + F.ascii(c) - F.ascii(F.lit("A")) + 1
        )
        - 1
    )
