import math
from datetime import datetime, timedelta, timezone
from zoneinfo import ZoneInfo

import pytest
from pyspark.sql import functions as F

from tidemark.functions import numbers, paths, times
from tidemark.operators.routing import route_events

NUMBERS = [
    "1,5", "1.234,56", "1,234", "1 234", "", "   ", ",", "100.5", "nan", "-nan", "+NaN", "inf",
    "-Infinity", "1d", "1f", "1_000", "1__0", "_1", "1_", "1e5", "1E-3", "1e", ".5", "5.", "+7",
    "--7", "0x10", "\t12\n", " 12 ", "1 234", "1 2 , 5", "abc", "1e5_0", "١٢", "\x1c3",
]


def as_float(text):
    """What the decimal rule is: commas to dots, no ASCII spaces, then a float or nothing."""
    try:
        return float(text.replace(",", ".").replace(" ", "").strip())
    except ValueError:
        return None


def as_grid_float(text):
    try:
        number = float(text.replace(",", ".").strip())
    except ValueError:
        return None
    return None if math.isnan(number) else number


def column(spark, values, expression, kind="string"):
    frame = spark.createDataFrame([(n, v) for n, v in enumerate(values)], f"n int, v {kind}")
    rows = frame.select("n", expression(F.col("v")).alias("out")).collect()
    return [row["out"] for row in sorted(rows, key=lambda row: row["n"])]


@pytest.mark.parametrize(
    "expression, rule",
    [(numbers.parse_decimal, as_float), (numbers.parse_grid_decimal, as_grid_float)],
)
def test_decimals_follow_the_rule(spark, expression, rule):
    ascii_only = [v for v in NUMBERS if v != "١٢"]  # other digits than ASCII are not read
    got = column(spark, ascii_only, expression)
    want = [rule(v) for v in ascii_only]
    assert [repr(v) for v in got] == [repr(v) for v in want]


def test_column_letters(spark):
    letters = ["A", "Z", "AA", "AD", "AAA", "aa", "XFD"]
    assert column(spark, letters, numbers.column_index) == [0, 25, 26, 29, 702, 26, 16383]


@pytest.mark.parametrize(
    "zone", ["America/Argentina/Buenos_Aires", "America/New_York", "Europe/Madrid", "Asia/Kolkata"]
)
def test_ambiguous_hours_are_standard_time(spark, zone):
    start = datetime(2007, 12, 29)
    clocks = [start + timedelta(minutes=30 * n) for n in range(48 * 330)]
    zone_info = ZoneInfo(zone)

    def expected(clock):
        first = clock.replace(tzinfo=zone_info)
        second = first.replace(fold=1)
        # Of two readings take the one without daylight saving (they differ when ambiguous).
        chosen = first if not first.dst() else second if not second.dst() else first
        if first.astimezone(timezone.utc).astimezone(zone_info).replace(tzinfo=None) != clock:
            chosen = first  # an hour the clock skips: the offset before the jump
        return chosen.astimezone(timezone.utc).replace(tzinfo=None)

    got = column(
        spark, clocks, lambda c: times.to_instant(c, zone).cast("timestamp_ntz"), "timestamp_ntz"
    )
    assert got == [expected(clock) for clock in clocks]


def test_iso_text_keeps_offset_and_trims_micros(spark):
    values = [datetime(2024, 1, 15, 10, 30), datetime(2024, 1, 15, 10, 30, 0, 1500)]

    def text(zone):
        return column(
            spark, values, lambda c: times.iso_text(c, times.to_instant(c, zone)), "timestamp_ntz"
        )

    for zone in ("America/Argentina/Buenos_Aires", "Asia/Kolkata", "UTC"):
        assert text(zone) == [v.replace(tzinfo=ZoneInfo(zone)).isoformat() for v in values]


def test_zone_is_dropped_without_converting(spark):
    texts = ["2025-01-15T10:30:00-03:00", "2025-01-15T10:30:00", "2025-01-15T10:30:00Z", "x"]
    got = column(spark, texts, times.drop_zone)
    assert got == [datetime(2025, 1, 15, 10, 30)] * 3 + [None]


def test_date_text(spark):
    texts = ["2024-03-01", "2024-03-01 10:00:00", " 01/03/2024 ", "nota", ""]
    got = column(spark, texts, lambda c: times.parse_date_text(c, ("dd/MM/yyyy",)))
    first = datetime(2024, 3, 1)
    assert got == [first, datetime(2024, 3, 1, 10), first, None, None]


def test_partition_path_and_errors(spark):
    frame = spark.createDataFrame(
        [("TEST_SERIES", datetime(2024, 1, 15, 10, 30))], "c string, t timestamp_ntz"
    )
    path = paths.partition_path(F.col("c"), F.col("t"))
    assert frame.select(path).first()[0] == "TEST_SERIES/year=2024/month=01/"
    for row in [(None, datetime(2024, 1, 1)), ("", datetime(2024, 1, 1)), ("A", None)]:
        bad = spark.createDataFrame([row], "c string, t timestamp_ntz")
        with pytest.raises(Exception, match="needs a series code"):
            bad.select(path).collect()


def test_partition_parts(spark):
    good = ["A/year=2024/month=01/", "A/year=2024/month=01"]
    got = column(spark, good, paths.partition_parts)
    assert [tuple(row) for row in got] == [("A", "2024", "01")] * 2
    assert column(spark, ["invalid/path"], lambda c: paths.partition_parts(c, False)) == [None]
    with pytest.raises(Exception, match="not a partition path"):
        column(spark, ["invalid/path"], paths.partition_parts)


def test_keys(spark):
    one = spark.range(1)
    part = F.lit("A/year=2024/month=01/")
    row = one.select(
        paths.data_key(F.lit("d"), "staging", part),
        paths.version_key(F.lit("d"), F.lit("v1"), F.concat(part, F.lit("data.json"))),
        paths.swap_prefix(F.lit("datasets/d/staging/x/y"), "datasets/d/staging/", "p/"),
    ).first()
    assert tuple(row) == (
        "datasets/d/staging/A/year=2024/month=01/data.json",
        "datasets/d/versions/v1/data/A/year=2024/month=01/data.json",
        "p/x/y",
    )


ENVELOPES = [
    ('{"dataset_id":"a"}', "a"),
    ('{"detail":{"dataset_id":"b"}}', "b"),
    ('{"Records":[{"body":"{\\"dataset_id\\":\\"c\\"}"}]}', "c"),
    ('{"Records":[{"body":"\\"{\\\\\\"dataset_id\\\\\\":\\\\\\"c\\\\\\"}\\""}]}', "c"),
    ('{"dataset_id":""}', None),
    ("{}", None),
    ("not json", None),
    (None, None),
    ('{"dataset_id":"","detail":{"dataset_id":"b"}}', "b"),
    ('{"dataset_id":null,"Records":[{"body":"x"}]}', None),
    ('{"detail":"text"}', None),
    ('{"Records":[]}', None),
    ('{"Records":[{"body":{"dataset_id":"c"}}]}', None),  # a body must be text
    ('{"dataset_id":0}', None),
    ('{"dataset_id":"0"}', "0"),
    ('{"dataset_id":7}', "7"),
    ('{"dataset_id":[]}', None),
    ('{"dataset_id":false,"detail":{"dataset_id":"b"}}', "b"),
]


def test_events_name_their_dataset(spark):
    frame = spark.createDataFrame(list(enumerate(e for e, _ in ENVELOPES)), "n int, event_json string")
    got = {r["n"]: r["dataset_id"] for r in route_events(frame).collect()}
    assert got == {n: want for n, (_, want) in enumerate(ENVELOPES)}
    kept = route_events(frame, default="fallback")
    assert kept.columns == ["n", "event_json", "dataset_id"]
    assert kept.where("dataset_id is null").count() == 0
