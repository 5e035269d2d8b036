from datetime import datetime, timedelta
from pathlib import Path

import pytest
from pyspark.sql import functions as F
from rows import CODE, grid_cells, observations, points, tuples

from tidemark.plans import projection, refresh, versions
from tidemark.plans.layout import DatasetLayout
from tidemark.plans.logs import compact_logs
from tidemark.schemas import COMMIT_LOG, PROJECTED_VERSIONS
from tidemark.operators.partitions import write_partitioned
from tidemark.session import read_table, settings
from tidemark.sources.series import series_map
from tidemark.streaming.refresh_stream import refresh_stream

RUN = datetime(2024, 2, 1, 12)
FIRST = [("S/1", "2024-01-14", 99.0), ("S/1", "2024-01-20", 5), ("T", "2024-02-03", 7)]
SECOND = [("S/1", "2024-01-14", 999.0), ("S/1", "2024-01-15", 100), ("U", "2024-03-01", 1)]


@pytest.fixture
def layout(folder):
    return DatasetLayout(folder, "d")


def commit(spark, layout, rows, hours=0, **how):
    run_ts = RUN + timedelta(hours=hours)
    frame = observations(spark, rows, collection_date=F.lit(run_ts.isoformat(" ")).cast("timestamp"))
    version_id = versions.new_version_id(run_ts)
    done = versions.commit_version(frame.drop("ord"), layout, version_id, run_ts, **how)
    return version_id if done else None


def stored(spark, layout):
    return tuples(projection.read_projection(spark, layout), CODE, "obs_local", "value")


MERGED = [
    ("S/1", datetime(2024, 1, 14), 99.0), ("S/1", datetime(2024, 1, 15), 100.0),
    ("S/1", datetime(2024, 1, 20), 5.0), ("T", datetime(2024, 2, 3), 7.0),
    ("U", datetime(2024, 3, 1), 1.0),
]


def test_version_ids():
    assert versions.new_version_id(datetime(2024, 1, 15, 14, 30, 22, 123456)) == (
        "v20240115_143022_123456"
    )


def test_commit_and_read_back(spark, layout):
    assert versions.current_version(spark, layout) is None
    version_id = commit(spark, layout, FIRST)
    assert versions.current_version(spark, layout) == version_id
    assert versions.read_version(spark, layout, version_id).count() == 3
    manifest = versions.load_manifest(spark, layout, version_id).first()
    assert manifest["data_points_count"] == 3 and manifest["file_count"] == 2
    index = versions.read_file_index(spark, layout, version_id)
    assert {r[0] for r in versions.version_partitions(index).collect()} == {
        "S/1/year=2024/month=01/", "T/year=2024/month=02/",
    }
    assert {r[0] for r in versions.version_series(index).collect()} == {"S/1", "T"}
    assert versions.version_files(index).count() == 2
    later = commit(spark, layout, SECOND, 1)
    assert versions.current_version(spark, layout) == later
    log = read_table(spark, layout.commit_log, COMMIT_LOG)
    assert [r["commit_seq"] for r in log.orderBy("commit_seq").collect()] == [1, 2]
    known = [r["version_id"] for r in versions.committed_versions(spark, layout).collect()]
    assert known == [later, version_id]
    # What an event announces is what lies there.
    path = f"datasets/{layout.dataset_id}/versions/{later}/manifest.json"
    assert layout.manifest(later).endswith(path)
    stored = spark.createDataFrame([(f"{path}/part-0.json",)], "path string")
    assert [r["version_id"] for r in versions.list_versions(stored).collect()] == [later]


def test_nothing_to_commit_makes_no_version(spark, layout):
    assert commit(spark, layout, []) is None
    assert versions.current_version(spark, layout) is None


def test_committing_again_changes_nothing(spark, layout):
    version_id = commit(spark, layout, FIRST)
    assert commit(spark, layout, SECOND) == version_id  # same run time, so the same version
    assert versions.read_version(spark, layout, version_id).count() == 3


def test_files_outside_the_index_are_not_read(spark, layout):
    version_id = commit(spark, layout, FIRST)
    stray = observations(spark, [("T", "2024-02-04", 1)], year=F.lit(2024), month=F.lit("02"))
    stray.drop("ord").write.mode("append").partitionBy(CODE, "year", "month").parquet(
        layout.data(version_id)
    )
    assert versions.read_version(spark, layout, version_id).count() == 3
    assert versions.read_version(spark, layout, version_id, small_index=False).count() == 3


def test_missing_manifest(spark, layout):
    assert versions.load_manifest(spark, layout, "v1") is None
    with pytest.raises(ValueError, match="no manifest"):
        projection.project_version(spark, layout, "v1", RUN)


def test_list_versions(spark):
    ids = ["v20240113_100000", "v20240114_120000", "v20240115_143022"]
    paths = [(f"datasets/d/versions/{v}/manifest.json",) for v in ids] + [
        (f"datasets/d/versions/{ids[0]}/data/A/data.json",),
        ("datasets/d/versions/draft/manifest.json",),
        ("datasets/d/projections/manifest.json",),
        ("manifest.json",),
    ]
    got = versions.list_versions(spark.createDataFrame(paths, "path string")).collect()
    assert [r["version_id"] for r in got] == ids[::-1]


@pytest.mark.parametrize("how", ["append", "rewrite"])
def test_two_versions_are_merged_once(spark, layout, how):
    first = commit(spark, layout, FIRST)
    assert projection.project_version(spark, layout, first, RUN, publish=how, bucket="b")
    second = commit(spark, layout, SECOND, 1)
    assert projection.project_current(spark, layout, RUN, publish=how)
    assert stored(spark, layout) == MERGED
    assert not projection.project_version(spark, layout, second, RUN, publish=how, bucket="b")
    assert stored(spark, layout) == MERGED
    events = spark.read.json(layout.update_events).collect()
    assert len(events) == 1 and events[0]["subject"] == "projection_update:d"


@pytest.mark.parametrize("how", ["append", "rewrite"])
def test_repeating_an_unrecorded_projection_adds_nothing(spark, layout, how, monkeypatch):
    commit(spark, layout, FIRST)
    projection.project_current(spark, layout, RUN, publish=how)
    commit(spark, layout, SECOND, 1)
    with monkeypatch.context() as broken:
        broken.setattr(projection, "_record", lambda *a: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            projection.project_current(spark, layout, RUN, publish=how)
    assert projection.project_current(spark, layout, RUN, publish=how)
    assert stored(spark, layout) == MERGED


def test_a_broken_rewrite_is_finished_from_staging(spark, layout, monkeypatch):
    commit(spark, layout, FIRST)
    projection.project_current(spark, layout, RUN, publish="rewrite")
    before = stored(spark, layout)
    commit(spark, layout, SECOND, 1)
    with monkeypatch.context() as broken:
        broken.setattr(
            projection, "_publish_staging", lambda *a: (_ for _ in ()).throw(OSError("lost"))
        )
        with pytest.raises(OSError):
            projection.project_current(spark, layout, RUN, publish="rewrite")
    assert stored(spark, layout) == before  # nothing is deleted on failure
    projection.finish_interrupted(spark, layout, RUN)
    assert stored(spark, layout) == MERGED
    assert projection.project_current(spark, layout, RUN, publish="append")
    assert stored(spark, layout) == MERGED


def test_rewrite_touches_only_its_partitions(spark, layout):
    commit(spark, layout, FIRST)
    projection.project_current(spark, layout, RUN)
    files = {p: p.stat().st_mtime_ns for p in Path(layout.projections).rglob("*.parquet")}
    commit(spark, layout, [("T", "2024-02-09", 8)], 1)
    projection.project_current(spark, layout, RUN, publish="rewrite")
    kept = {p for p in files if p.exists()}
    assert {p for p in files if f"{CODE}=T" not in str(p)} == kept


def test_duplicates_of_new_partitions_in_parity_mode(spark, layout):
    commit(spark, layout, [("A", "2024-01-01", 1), ("A", "2024-01-01", 2)])
    projection.project_current(
        spark, layout, RUN, publish="rewrite", dedup_new_partitions=False
    )
    assert len(stored(spark, layout)) == 2


def test_pending_versions_oldest_first(spark, layout):
    commit(spark, layout, FIRST)
    commit(spark, layout, SECOND, 1)
    assert projection.project_pending(spark, layout, RUN) == 2
    assert stored(spark, layout) == MERGED
    assert projection.project_pending(spark, layout, RUN) == 0
    done = read_table(spark, layout.projected_versions, PROJECTED_VERSIONS)
    status = projection.projection_status(done.unionByName(done)).first()
    assert status["projected_versions"] == 2


@pytest.mark.parametrize("at_once, passes", [(32, 1), (2, 2)])
def test_pending_versions_are_merged_together(spark, layout, monkeypatch, at_once, passes):
    for hours, value in enumerate((1.0, 2.0, 3.0)):
        commit(spark, layout, [("A", "2024-01-01", value), ("A", f"2024-01-0{hours + 2}", value)], hours)
    written = []
    write = projection.write_partitioned
    monkeypatch.setattr(
        projection, "write_partitioned", lambda *a, **k: written.append(a[1]) or write(*a, **k)
    )
    monkeypatch.setattr(projection, "PENDING_AT_ONCE", at_once)
    assert projection.project_pending(spark, layout, RUN, bucket="b") == 3
    assert written == [layout.projections] * passes
    assert [r[2] for r in stored(spark, layout)] == [1.0, 1.0, 2.0, 3.0]
    assert spark.read.json(layout.update_events).count() == 3
    done = read_table(spark, layout.projected_versions, PROJECTED_VERSIONS)
    last = versions.current_version(spark, layout)
    assert projection.projection_status(done).first()["last_projected_version"] == last


@pytest.mark.parametrize("how", ["append", "rewrite"])
@pytest.mark.parametrize("columns", [("year",), (CODE, "year"), ("year", "month")])
def test_partition_columns_are_a_choice(spark, folder, how, columns):
    layout = DatasetLayout(folder, "d", columns)
    first = commit(spark, layout, FIRST)
    assert projection.project_version(spark, layout, first, RUN, publish=how)
    commit(spark, layout, SECOND, 1)
    projection.project_current(spark, layout, RUN, publish=how)
    assert stored(spark, layout) == MERGED
    folders = [p.parent.relative_to(layout.projections) for p in Path(layout.projections).rglob("*.parquet")]
    assert all([part.split("=")[0] for part in f.parts] == list(columns) for f in folders)
    manifest = versions.load_manifest(spark, layout, first).first()
    index = versions.read_file_index(spark, layout, first)
    named = {r[0] for r in versions.version_files(index, columns).collect()}
    assert manifest["file_count"] == len(named)
    assert manifest["partition_count"] == versions.version_partitions(index, columns).count()
    assert manifest["partition_strategy"] == layout.partition_strategy
    with pytest.raises(ValueError, match="partition columns"):
        DatasetLayout(folder, "d", ("day",))


def test_a_rewrite_leaves_no_staging(spark, layout):
    commit(spark, layout, FIRST)
    projection.project_current(spark, layout, RUN, publish="rewrite")
    assert not list(Path(layout.base, "staging").glob("*"))
    assert len(stored(spark, layout)) == 3


def test_compacted_logs_say_the_same(spark, layout):
    for hours in range(3):
        commit(spark, layout, [("A", f"2024-01-0{hours + 1}", hours)], hours)
        projection.project_current(spark, layout, RUN, publish="rewrite")
        marks = spark.createDataFrame(
            [("A", RUN + timedelta(days=hours))], f"{CODE} string, last_obs_local timestamp_ntz"
        )
        refresh.save_state(marks, layout, RUN - timedelta(days=hours))

    def facts():
        return (
            [r["version_id"] for r in versions.committed_versions(spark, layout).collect()],
            versions.current_version(spark, layout),
            tuples(refresh.load_state(spark, layout), CODE, "last_obs_local"),
            stored(spark, layout),
            projection.project_pending(spark, layout, RUN),
        )

    before = facts()
    assert compact_logs(spark, layout) == 0  # short ones stay as they are
    assert compact_logs(spark, layout, most_files=1) == 4
    assert facts() == before
    for log in (layout.commit_log, layout.state_log, layout.projected_versions, layout.publish_log):
        assert len(list(Path(log).glob("*.parquet"))) == 1
    # A break between writing the new file and removing the old ones: rows are there twice.
    twice = spark.read.parquet(layout.commit_log).collect()
    spark.createDataFrame(twice, COMMIT_LOG).write.mode("append").parquet(layout.commit_log)
    assert facts() == before
    assert commit(spark, layout, [("A", "2024-01-09", 9)], 9)
    assert read_table(spark, layout.commit_log, COMMIT_LOG).agg(F.max("commit_seq")).first()[0] == 4


def test_projection_scan_is_pruned_to_touched_partitions(spark, layout, monkeypatch):
    commit(spark, layout, FIRST, unique_keys=True)
    projection.project_current(spark, layout, RUN)
    plans = []
    write = projection.write_partitioned

    def spy(rows, *args, **options):
        plans.append(rows._jdf.queryExecution().toString())
        return write(rows, *args, **options)

    monkeypatch.setattr(projection, "write_partitioned", spy)
    commit(spark, layout, SECOND, 1, unique_keys=True)
    projection.project_current(spark, layout, RUN)
    assert "dynamicpruning" in plans[0]


def test_a_partition_with_most_rows_is_split_over_files(spark, folder):
    rows = spark.range(0, 400_000, 1, 8).selectExpr(
        f"if(id % 50 = 0, concat('S', id % 20), 'HOT') AS {CODE}",
        "timestamp_ntz'2024-01-01' AS obs_local",
        "rand(1) AS value",
    )
    with settings(spark, spark__sql__adaptive__advisoryPartitionSizeInBytes="200KB"):
        write_partitioned(rows, folder + "/out")
    files = [str(p) for p in Path(folder).rglob("*.parquet")]
    assert sum("HOT" in f for f in files) > 3
    small = [f for f in files if "HOT" not in f]
    assert len(small) == 2  # one file for each small partition (S0 and S10)
    assert spark.conf.get("spark.sql.adaptive.coalescePartitions.minPartitionSize") != "64KB"


# ---- whole runs -------------------------------------------------------------------------

DAYS = [datetime(2025, 1, 1) + timedelta(days=n) for n in range(10)]
SHEET = {1: ["Date", "Value"], **{n + 2: [day, 10.5 * (n + 1)] for n, day in enumerate(DAYS)}}
CONFIG = {
    "dataset_id": "d",
    "normalize": {"timezone": "UTC", "primary_keys": ["obs_time", CODE]},
    "parse_config": {"series_map": [
        {CODE: "TEST", "unit": "u", "frequency": "D", "sheet": "S", "header_row": 1,
         "skip_rows_after_header": 0, "date_col": "A", "value_col": "B", "drop_na": True},
    ]},
}


def run(spark, folder, sheet=SHEET, hours=0, config=CONFIG, **how):
    cells = grid_cells(spark, "S", sheet)
    return refresh.run_refresh(cells, config, folder, RUN + timedelta(hours=hours), **how)


def state(spark, folder):
    return tuples(refresh.load_state(spark, DatasetLayout(folder, "d")), CODE, "last_obs_local")


def test_second_run_takes_only_what_is_new(spark, folder):
    first = run(spark, folder)
    assert first.projected and state(spark, folder) == [("TEST", DAYS[-1])]
    nothing = run(spark, folder, hours=1)
    assert nothing.version_id is None and not nothing.projected
    grown = {**SHEET, 20: [datetime(2025, 1, 11), 1.0], 21: [DAYS[0], -1.0]}
    third = run(spark, folder, grown, hours=2)
    layout = DatasetLayout(folder, "d")
    assert versions.read_version(spark, layout, third.version_id).count() == 1
    assert len(stored(spark, layout)) == 11


def test_a_run_leaves_no_staged_tables(spark, folder, monkeypatch):
    staged = []
    write = refresh.staged
    monkeypatch.setattr(
        refresh, "staged", lambda *a: staged.append(write(*a)) or staged[-1]
    )
    run(spark, folder, config={**CONFIG, "windowInDays": 3}, as_of=DAYS[7])
    paths = [Path(f.removeprefix("file:")) for frame in staged for f in frame.inputFiles()]
    assert len(staged) == 2 and paths and not any(p.exists() for p in paths)


def test_marks_may_be_moved_back(spark, folder):
    run(spark, folder)
    layout = DatasetLayout(folder, "d")
    back = spark.createDataFrame([("TEST", DAYS[4])], f"{CODE} string, last_obs_local timestamp_ntz")
    refresh.save_state(back, layout, RUN + timedelta(minutes=1), monotonic=True)
    assert state(spark, folder) == [("TEST", DAYS[-1])]
    refresh.save_state(back, layout, RUN + timedelta(minutes=2))
    again = run(spark, folder, hours=1)
    got = versions.read_version(spark, layout, again.version_id)
    assert sorted(r["obs_local"] for r in got.collect()) == DAYS[5:]


def test_window_limits_the_version_but_not_the_state(spark, folder):
    config = {**CONFIG, "windowInDays": 3}
    result = run(spark, folder, config=config, as_of=DAYS[7])
    layout = DatasetLayout(folder, "d")
    got = versions.read_version(spark, layout, result.version_id)
    assert sorted(r["obs_local"] for r in got.collect()) == DAYS[4:]
    assert state(spark, folder) == [("TEST", DAYS[-1])]
    late = run(spark, folder + "/other", config=config, as_of=datetime(2030, 1, 1))
    assert late.version_id is None
    assert state(spark, folder + "/other") == [("TEST", DAYS[-1])]


def test_failed_commit_saves_no_state(spark, folder, monkeypatch):
    monkeypatch.setattr(
        versions, "append_commit", lambda *a: (_ for _ in ()).throw(OSError("lost"))
    )
    with pytest.raises(OSError):
        run(spark, folder)
    assert state(spark, folder) == []
    monkeypatch.undo()
    assert run(spark, folder).version_id  # the same run again overwrites the orphan
    assert len(stored(spark, DatasetLayout(folder, "d"))) == 10


def test_custom_and_missing_stages(spark, folder):
    empty = run(spark, folder, stages=refresh.Stages())
    assert empty.version_id is None and not empty.projected
    default = refresh.grid_stages(series_map(spark, CONFIG), CONFIG, RUN)
    doubled = refresh.Stages(
        default.parse,
        default.normalize,
        lambda rows: rows.withColumn("value", F.expr("value * 2")),
    )
    result = run(spark, folder, hours=1, stages=doubled, project=False)
    layout = DatasetLayout(folder, "d")
    got = versions.read_version(spark, layout, result.version_id)
    assert got.agg(F.sum("value")).first()[0] == 2 * 10.5 * 55
    assert projection.read_projection(spark, layout).count() == 0


def test_duplicates_without_primary_keys(spark, folder):
    config = {**CONFIG, "normalize": {"timezone": "UTC"}}
    sheet = {1: ["Date", "Value"], 2: [DAYS[0], 2.0], 3: [DAYS[0], 1.0]}
    result = run(spark, folder, sheet, config=config)
    layout = DatasetLayout(folder, "d")
    assert versions.read_version(spark, layout, result.version_id).count() == 2
    # Projection keeps the one that came first in the sheet.
    assert stored(spark, layout) == [("TEST", DAYS[0], 2.0)]


def test_configured_series_bound_the_scan(spark, folder):
    series = series_map(spark, CONFIG)
    old = [("TEST", "2024-01-01", 1), ("STRANGER", "2024-01-01", 2)]
    new = [("TEST", "2024-01-02", 3), ("STRANGER", "2024-01-03", 4)]
    for number, rows in enumerate((old, old + new)):
        ts = RUN + timedelta(hours=number)
        stages = refresh.table_stages(series, CONFIG, ts, ["ord"], configured_only=True)
        refresh.run_refresh(points(spark, rows), CONFIG, folder, ts, stages)
    assert stored(spark, DatasetLayout(folder, "d")) == [
        ("TEST", datetime(2024, 1, 1), 1.0), ("TEST", datetime(2024, 1, 2), 3.0),
    ]
    parquet = f"{folder}/points"
    points(spark, old + new).write.parquet(parquet)
    marks = spark.createDataFrame(
        [("TEST", datetime(2024, 1, 1))], f"{CODE} string, last_obs_local timestamp_ntz"
    )
    with settings(spark, spark__sql__maxMetadataStringLength="10000"):
        rows = stages.parse(spark.read.parquet(parquet), marks)
        plan = rows._jdf.queryExecution().toString()
    assert "GreaterThan(obs_ts,2024-01-01T00:00)" in plan


# ---- stream -----------------------------------------------------------------------------


def stream(spark, folder, source_dir):
    series = series_map(spark, CONFIG)
    source = (
        spark.readStream.schema(
            f"ord bigint, {CODE} string, obs_ts timestamp_ntz, value_num double, value_str string"
        )
        .option("maxFilesPerTrigger", 1)
        .parquet(source_dir)
    )
    refresh_stream(
        source, CONFIG, folder, RUN, f"{folder}/checkpoint",
        lambda ts: refresh.table_stages(series, CONFIG, ts, ["ord"]),
    ).awaitTermination()


def drop_file(spark, rows, source_dir):
    points(spark, rows).coalesce(1).write.mode("append").parquet(source_dir)


def test_stream_batches_and_restart(spark, folder):
    source_dir = f"{folder}/in"
    drop_file(spark, [("A", "2024-01-01", 1), ("A", "2024-01-01", 2), ("B", "2024-01-02", 3)], source_dir)
    stream(spark, folder, source_dir)
    drop_file(spark, [("A", "2024-01-01", 9), ("A", "2024-01-03", 4)], source_dir)  # one is late
    stream(spark, folder, source_dir)
    layout = DatasetLayout(folder, "d")
    assert stored(spark, layout) == [
        ("A", datetime(2024, 1, 1), 1.0), ("A", datetime(2024, 1, 3), 4.0),
        ("B", datetime(2024, 1, 2), 3.0),
    ]
    log = read_table(spark, layout.commit_log, COMMIT_LOG)
    assert log.count() == 2


def test_a_repeated_batch_takes_effect_once(spark, folder, monkeypatch):
    source_dir = f"{folder}/in"
    drop_file(spark, [("A", "2024-01-01", 1)], source_dir)
    with monkeypatch.context() as broken:
        broken.setattr(refresh, "save_state", lambda *a: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(Exception, match="lost"):
            stream(spark, folder, source_dir)
    stream(spark, folder, source_dir)
    layout = DatasetLayout(folder, "d")
    assert stored(spark, layout) == [("A", datetime(2024, 1, 1), 1.0)]
    assert read_table(spark, layout.commit_log, COMMIT_LOG).count() == 1
    assert state(spark, folder) == [("A", datetime(2024, 1, 1))]
