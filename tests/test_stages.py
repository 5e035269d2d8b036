from datetime import datetime, timedelta, timezone

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from rows import CODE, observations, points, tuples

from tidemark.operators.dedup import keep_first
from tidemark.operators.enrich import enrich, within_window
from tidemark.operators.incremental import (
    high_water_marks,
    latest_state,
    marks_for,
    merge_state,
    scan_floor,
    state_from_json,
)
from tidemark.operators.merge import merge_as_published, merge_first_wins, unseen_rows
from tidemark.operators.normalize import normalize, valid_points
from tidemark.operators.partitions import (
    distinct_partitions,
    partition_counts,
    partition_statistics,
    with_partition_columns,
)
from tidemark.operators.routing import accepted, rejected, requested_datasets, route_events
from tidemark.operators.summary import run_difference, run_summary
from tidemark.plans.versions import manifest_of
from tidemark.sources.series import series_map

ZONE = "America/Argentina/Buenos_Aires"
RUN = datetime(2024, 1, 15, 14, 25)


def values(frame):
    return sorted(r["value"] for r in frame.collect())


def test_points_without_code_or_date_are_dropped(spark):
    frame = points(spark, [
        (None, "2025-01-15", 1), ("", "2025-01-15", 2), ("A", None, 3), ("A", "2025-01-15", 300.5),
    ])
    assert values(valid_points(frame)) == [300.5]


def test_validity_comes_before_deduplication(spark):
    frame = points(spark, [
        ("A", "2025-01-15", None), ("A", "2025-01-15", "invalid"), ("A", "2025-01-15", 100.5),
    ])
    assert values(normalize(frame, order=["ord"])) == [100.5]


def test_value_forms(spark):
    frame = points(spark, [
        ("A", f"2025-01-{n:02d}", value)
        for n, value in enumerate([100, 200.5, "300.5", "1234.56", "   ", ","], 1)
    ])
    assert values(normalize(frame, order=["ord"])) == [100.0, 200.5, 300.5, 1234.56]


def test_deduplication_keeps_the_first_or_is_off(spark):
    frame = points(spark, [
        ("A", "2025-01-15", 100.5), ("A", "2025-01-15", 200.5), ("A", "2025-01-16", 300.5),
    ])
    assert values(normalize(frame, order=["ord"])) == [100.5, 300.5]
    plain = normalize(frame, dedup=False, order=["ord"])
    assert values(plain) == [100.5, 200.5, 300.5]
    assert sorted(r["ord"]["pos"] for r in plain.collect()) == [0, 1, 2]


def test_zones(spark):
    naive = normalize(points(spark, [("A", "2025-01-15 10:30", 1)]), ZONE, order=["ord"])
    assert tuples(naive.withColumn("u", F.col("obs_time").cast("string")), "u", "obs_local") == [
        ("2025-01-15 13:30:00", datetime(2025, 1, 15, 10, 30))
    ]
    aware = points(spark, [("A", "2025-01-15 15:00", 1)]).withColumn(
        "obs_ts", F.col("obs_ts").cast("timestamp")
    )
    assert tuples(normalize(aware, ZONE, order=["ord"]), "obs_local") == [
        (datetime(2025, 1, 15, 12),)
    ]


def test_keep_first_with_text_payload_and_null_keys(spark):
    frame = spark.createDataFrame(
        [(None, "b", 2), (None, "a", 1), ("k", None, 5), ("k", "x", 6)], "k string, v string, o int"
    )
    got = sorted(map(str, (tuple(r) for r in keep_first(frame, ["k"], ["o"]).collect())))
    assert got == ["('k', None, 5)", "(None, 'a', 1)"]
    numeric = frame.select("k", "o", (F.col("o") * 2).alias("p"))
    assert sorted(r["p"] for r in keep_first(numeric, ["k"], ["o"], keep=["p"]).collect()) == [2, 10]


CONFIG = {"parse_config": {"series_map": [
    {CODE: "TEST", "unit": "old", "frequency": "M"},
    {CODE: "OTHER", "unit": "another_unit", "frequency": "M"},
    {CODE: "", "unit": "none"},
    {CODE: "TEST", "unit": "test_unit", "frequency": "D"},
]}}


def test_configuration_wins_and_unknown_codes_stay(spark):
    rows = observations(
        spark, [("TEST", "2025-01-01", 1), ("UNKNOWN", "2025-01-01", 2)], unit=F.lit("wrong")
    )
    got = enrich(rows, series_map(spark, CONFIG), RUN)
    assert [tuple(r) for r in got.orderBy(CODE).select(CODE, "unit", "frequency").collect()] == [
        ("TEST", "test_unit", "D"), ("UNKNOWN", None, None)
    ]
    assert tuples(got.select("collection_date").distinct(), "collection_date") == [
        (RUN.replace(tzinfo=timezone.utc).astimezone().replace(tzinfo=None),)
    ]


def test_window_bounds(spark):
    edge = RUN - timedelta(days=7)
    rows = observations(spark, [
        ("A", edge.isoformat(), 1), ("A", (edge - timedelta(microseconds=1)).isoformat(), 2),
        ("A", None, 3),
    ])
    assert values(within_window(rows, 7, RUN)) == [1.0]
    assert within_window(rows, None, RUN).count() == 3


def test_marks(spark):
    rows = observations(spark, [
        ("S1", "2025-01-10", 1), ("S1", "2025-01-15", 1), ("S2", "2025-01-12", 1),
        (None, "2025-02-01", 1), ("", "2025-02-01", 1), ("S3", None, 1),
    ])
    assert tuples(high_water_marks(rows), CODE, "last_obs_local") == [
        ("S1", datetime(2025, 1, 15)), ("S2", datetime(2025, 1, 12)),
    ]


def state(spark, rows):
    return spark.createDataFrame(
        [("d", code, datetime.fromisoformat(at) if at else None) for code, at in rows],
        f"dataset_id string, {CODE} string, last_obs_local timestamp_ntz",
    )


def test_state_merges_and_may_move_back(spark):
    old = state(spark, [("A", "2025-01-10"), ("B", "2025-01-01")])
    batch = state(spark, [("A", "2025-01-05"), ("C", "2025-01-02")])
    assert tuples(merge_state(old, batch), CODE, "last_obs_local") == [
        ("A", datetime(2025, 1, 5)), ("B", datetime(2025, 1, 1)), ("C", datetime(2025, 1, 2)),
    ]
    assert tuples(merge_state(old, batch, monotonic=True), CODE, "last_obs_local")[0] == (
        "A", datetime(2025, 1, 10)
    )
    log = old.withColumn("saved_at", F.lit("2025-01-01").cast("timestamp")).unionByName(
        batch.withColumn("saved_at", F.lit("2025-01-02").cast("timestamp"))
    )
    assert tuples(latest_state(log), CODE)[0] == ("A",)
    assert latest_state(log).where(f"{CODE} = 'A'").first()["last_obs_local"] == datetime(2025, 1, 5)


def test_state_documents(spark):
    text = '{"A": "2025-01-15T10:30:00-03:00", "B": "2025-01-15", "C": "soon", "D": null}'
    documents = spark.createDataFrame(
        [("d", text), ("e", ""), ("f", "{broken"), ("g", None)], "dataset_id string, state_json string"
    )
    assert tuples(state_from_json(documents), "dataset_id", CODE, "last_obs_local") == [
        ("d", "A", datetime(2025, 1, 15, 10, 30)), ("d", "B", datetime(2025, 1, 15)),
    ]


def test_scan_floor_needs_a_mark_for_every_series(spark):
    series = series_map(spark, CONFIG)
    one = state(spark, [("TEST", "2025-01-10")])
    assert scan_floor(one, series) is None
    both = one.unionByName(state(spark, [("OTHER", "2025-01-03")]))
    assert scan_floor(both, series) == datetime(2025, 1, 3)
    assert scan_floor(both, series_map(spark, {})) is None


def test_only_configured_series_are_looked_up(spark):
    known = state(spark, [("TEST", "2025-01-10"), ("STRANGER", "2025-01-01"), ("OTHER", None)])
    assert tuples(marks_for(known, series_map(spark, CONFIG)), CODE) == [("TEST",)]


def test_partition_counts_and_paths(spark):
    rows = observations(spark, [
        ("A", "2024-01-15", 1), ("A", "2024-01-20", 1), ("A", "2024-02-10", 1), ("B", "2024-01-15", 1),
    ])
    assert tuples(partition_counts(rows), CODE, "year", "month", "points") == [
        ("A", 2024, "01", 2), ("A", 2024, "02", 1), ("B", 2024, "01", 1),
    ]
    paths = spark.createDataFrame(
        [("data/A/year=2024/month=01/1.json",), ("data/A/year=2024/month=01/2.json",),
         ("data/A/year=2024/month=02/1.json",), ("B/year=2024/month=01/x",),
         ("some/other/path/file.txt",), ("A/year=2024/month=03",)], "path string")
    assert [r[0] for r in distinct_partitions(paths, "path").collect()] == [
        "A/year=2024/month=01/", "A/year=2024/month=02/", "B/year=2024/month=01/",
    ]


def manifest(spark, rows):
    frame = observations(spark, rows, collection_date=F.lit(RUN.isoformat(" ")).cast("timestamp"))
    index = partition_statistics(with_partition_columns(frame))
    return manifest_of(index, "v1", "d", RUN).first().asDict(recursive=True)


def test_manifest_statistics(spark):
    got = manifest(spark, [
        ("SERIES_2", "2024-02-01T12:00", 200), ("SERIES_1", "2024-01-15T12:00", 100),
        ("SERIES_1", "2024-01-16T12:00", 101),
    ])
    assert got["data_points_count"] == 3
    assert got["series_count"] == 2
    assert got["date_range"] == {
        "min_obs_time": "2024-01-15T12:00:00Z", "max_obs_time": "2024-02-01T12:00:00Z"
    }
    assert got["collection_date"] == "2024-01-15T14:25:00Z"
    assert got["partition_count"] >= 2


def test_manifest_of_nothing(spark):
    got = manifest(spark, [])
    assert (got["data_points_count"], got["series_count"], got["partition_count"]) == (0, 0, 0)
    assert got["date_range"] == {"min_obs_time": None, "max_obs_time": None}
    assert got["collection_date"] is None


PROJECTION = [("S", "2024-01-14", 99.0)]
STAGING = [("S", "2024-01-15", 100), ("S", "2024-01-16", 101), ("S", "2024-01-14", 999.0)]


def test_stored_rows_win(spark):
    old, new = observations(spark, PROJECTION), observations(spark, STAGING)
    assert values(merge_first_wins(old, new, order="ord")) == [99.0, 100.0, 101.0]
    assert values(unseen_rows(old, new, order="ord")) == [100.0, 101.0]
    assert values(unseen_rows(old, new, order="ord", unique=True, null_keys=False)) == [100.0, 101.0]


def test_one_sided_merges(spark):
    none = observations(spark, [])
    some = observations(spark, PROJECTION)
    assert values(merge_first_wins(none, some)) == [99.0]
    assert values(merge_first_wins(some, none)) == [99.0]
    assert values(merge_first_wins(none, none)) == []


def test_new_partitions_keep_duplicates_only_in_parity_mode(spark):
    none = observations(spark, [], day=F.to_date("obs_local"))
    twice = observations(
        spark, [("S", "2024-01-14", 1), ("S", "2024-01-14", 2)], day=F.to_date("obs_local")
    )
    assert values(merge_as_published(none, twice, [CODE, "day"], order="ord")) == [1.0, 2.0]
    assert values(merge_first_wins(none, twice, order="ord")) == [1.0]
    old = observations(spark, [("S", "2024-01-14", 7)], day=F.to_date("obs_local"))
    assert values(merge_as_published(old, twice, [CODE, "day"], order="ord")) == [7.0]


ROWS = st.lists(
    st.tuples(
        st.sampled_from(["A", "B", None]),
        st.sampled_from(["2024-01-01", "2024-01-02", "2024-02-01", None]),
        st.integers(0, 99),
    ),
    max_size=12,
)


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(ROWS, ROWS)
def test_merge_is_first_write_wins_and_idempotent(spark, old, new):
    expected = {}
    for code, at, value in old + new:
        expected.setdefault((code, at), float(value))
    left, right = observations(spark, old), observations(spark, new)
    merged = merge_first_wins(left, right, order="ord")

    def by_key(frame):
        return {
            (r[CODE], r["obs_local"].strftime("%Y-%m-%d") if r["obs_local"] else None): r["value"]
            for r in frame.collect()
        }

    assert by_key(merged) == expected
    again = merge_first_wins(merged, right, order="ord")
    assert by_key(again) == expected and again.count() == len(expected)
    added = by_key(unseen_rows(left, right, order="ord"))
    assert added == {k: v for k, v in expected.items() if k not in {(c, a) for c, a, _ in old}}


def test_summaries(spark):
    first = observations(spark, [("A", "2024-01-01", 1), ("A", "2024-01-02", 1), ("B", "2024-01-01", 1)])
    second = observations(spark, [("A", "2024-01-02", 1), ("C", "2024-01-01", 1)])
    assert tuples(run_summary(first), CODE, "points") == [("A", 2), ("B", 1)]
    assert tuples(run_difference(first, second), CODE, "points_before", "points_after", "filtered") == [
        ("A", 2, 1, 1), ("C", 0, 1, -1),
    ]


def test_routing_sides(spark):
    events = spark.createDataFrame(
        [('{"dataset_id":"a"}',), ('{"dataset_id":"a"}',), ("{}",)], "event_json string"
    )
    routed = route_events(events)
    assert accepted(routed).count() == 2 and rejected(routed).count() == 1
    assert tuples(requested_datasets(routed), "dataset_id") == [("a",)]


@pytest.mark.parametrize("code, at", [(None, "2024-01-01"), ("", "2024-01-01"), ("A", None)])
def test_rows_without_a_partition_fail_the_write(spark, folder, code, at):
    from tidemark.operators.partitions import write_partitioned

    with pytest.raises(Exception, match="needs a series code"):
        write_partitioned(observations(spark, [(code, at, 1)]), folder + "/out")


def test_state_is_ordered_by_saving_not_by_clock(spark):
    rows = [("d", "S", datetime(2024, 1, 2), datetime(2024, 5, 1), 1), ("d", "S", datetime(2024, 1, 1), datetime(2024, 4, 1), 2)]
    log = spark.createDataFrame(
        rows, "dataset_id string, internal_series_code string, last_obs_local timestamp_ntz, saved_at timestamp, seq long"
    )
    from tidemark.operators.incremental import latest_state

    assert latest_state(log).first()["last_obs_local"] == datetime(2024, 1, 1)


def test_repeated_keys_in_an_event(spark):
    from tidemark.operators.routing import route_events

    events = spark.createDataFrame([('{"x": 1, "x": 2, "dataset_id": "a", "dataset_id": "b"}',)], "event_json string")
    assert route_events(events).first()["dataset_id"] == "b"
