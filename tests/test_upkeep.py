"""Files that merges leave closed, notes on files, audits, and what broken runs leave."""

from datetime import timedelta
from pathlib import Path

import pytest
from pyspark.sql import functions as F
from rows import CODE, tuples
from test_recovery import CONFIG, DAY, RUN, commit, lost, run, rows_of

from tidemark.plans import files, projection, upkeep, versions
from tidemark.plans.layout import DatasetLayout


@pytest.fixture
def layout(folder):
    return DatasetLayout(folder, "d", ("year",), track_files=True)


def days(code, *numbers, add=0):
    return [(code, DAY.format(n), n + add) for n in numbers]


def merged(spark, layout, rows, hours, **how):
    version_id = commit(spark, layout, rows, hours)
    assert projection.project_version(spark, layout, version_id, RUN + timedelta(hours=hours), **how)
    return version_id


def paths(layout):
    return {str(p.relative_to(layout.projections)): p for p in Path(layout.projections).rglob("*.parquet")}


def values(spark, layout):
    return sorted((r[CODE], r.obs_time.day, r.value) for r in projection.read_projection(spark, layout).collect())


@pytest.mark.parametrize("named", [10_000, 0])
def test_a_merge_opens_only_files_that_overlap(spark, layout, monkeypatch, named):
    """A file outside the batch's times may even be broken: nobody opens it."""
    merged(spark, layout, days("A", 1, 2, 3) + days("B", 20), 0)
    first = set(paths(layout))
    merged(spark, layout, days("A", 10, 11, 12), 1)
    broken = {one: paths(layout)[one].read_bytes() for one in first} if named else {}
    for one in broken:
        paths(layout)[one].write_bytes(b"broken")
    monkeypatch.setattr(files, "NAMED_FILES", named)  # 0: picked by a join, which opens them all
    merged(spark, layout, days("A", 11, 12, 13, add=100) + days("B", 5), 2)
    for one, data in broken.items():
        Path(layout.projections, one).write_bytes(data)
    got = values(spark, layout)
    assert got == sorted([("A", n, float(n)) for n in (1, 2, 3, 10, 11, 12)] + [("A", 13, 113.0), ("B", 5, 5.0), ("B", 20, 20.0)])


def test_ranges_that_touch_overlap_and_files_without_a_record_stay(spark, layout):
    first = merged(spark, layout, days("A", 1, 2) + days("C", 9), 0)
    unnoted = DatasetLayout(layout.root, "d", ("year",))
    second = commit(spark, unnoted, days("A", 20), 1)
    projection.project_version(spark, unnoted, second, RUN)
    merged(spark, layout, days("B", 1, 30), 2)  # notes the file nobody noted, too
    index = versions.read_file_index(spark, layout, commit(spark, layout, days("A", 2, 3), 3))
    assert {r.file for r in files.overlapping_files(spark, layout, index).collect()} == {
        r.file for r in files.file_records(spark, layout).where(F.col("version_id") == first).where("change = 1").collect()
    }
    other = commit(spark, unnoted, days("A", 25), 4)
    projection.project_version(spark, unnoted, other, RUN)
    assert files.overlapping_files(spark, layout, index).count() == 2
    assert files.overlapping_files(spark, DatasetLayout(layout.root, "none"), index) is None


def test_a_hot_series_gives_one_row_per_recorded_cell(spark, layout):
    """Many files of one series against many of a version: as many joined rows as recorded cells."""
    for hours in range(4):
        merged(spark, layout, days("A", 1 + hours, 10 + hours, 20), hours)
    version_id = commit(spark, layout, days("A", 1, 5, 25), 9)
    index = versions.read_file_index(spark, layout, version_id)
    many = index.withColumn("copy", F.explode(F.sequence(F.lit(1), F.lit(50)))).drop("copy")
    assert files.overlapping_files(spark, layout, many).count() == 4
    assert files.recorded_files(files.file_records(spark, layout)).count() == 4


@pytest.mark.parametrize("publish", ["append", "rewrite"])
def test_totals_equal_a_recount(spark, layout, publish):
    merged(spark, layout, days("A", 1, 2, 3), 0, publish=publish)
    merged(spark, layout, days("A", 3, 4, add=7) + [("B", "2024-02-01", 1)], 1, publish=publish)
    merged(spark, layout, days("A", 1, 4), 2, publish=publish)  # brings nothing new
    rows = {r.turn: r for r in files.projection_totals(spark, layout).collect()}
    assert [(r.points_added, r.partitions_added, r.series_added) for _, r in sorted(rows.items())] == [(3, 1, 1), (2, 1, 1), (0, 0, 0)]
    stored = projection.read_projection(spark, layout)
    assert sum(r.points_added for r in rows.values()) == stored.count() == 5
    there = sum(r.files_added - r.files_removed for r in rows.values())
    assert there == len(paths(layout)) == files.recorded_files(files.file_records(spark, layout)).select("file").distinct().count()
    assert tuples(upkeep.audit_merges(spark, layout), "turn", "rows_in", "repeated", "known", "added", "whole") == [
        (1, 3, 0, 0, 3, True), (2, 3, 0, 1, 2, True), (3, 2, 0, 2, 0, True)
    ]
    assert upkeep.damaged_files(spark, layout).count() == 0


def test_audit_of_pending_versions_and_copies(spark, layout, monkeypatch):
    """Copies of a key, versions merged together, and more versions than one plan reads."""
    hot = [("A", DAY.format(1), 5)] * 200 + days("A", 2)
    commit(spark, layout, hot, 0)
    commit(spark, layout, days("A", 2, 3), 1)
    last = commit(spark, layout, days("A", 3, 4), 2)
    assert projection.project_pending(spark, layout, RUN) == 3
    merged(spark, layout, days("A", 4, 5) + days("B", 1), 3)
    monkeypatch.setattr(upkeep, "AT_ONCE", 2)
    found = {r.turn: tuple(r)[2:] for r in upkeep.audit_merges(spark, layout).collect()}
    assert found == {1: (3, 205, 201, 0, 4, True), 2: (1, 3, 0, 1, 2, True)}
    assert files.projection_totals(spark, layout).where("turn = 1").first().version_id == last


def test_a_repeated_merge_notes_its_files_once(spark, layout, monkeypatch):
    merged(spark, layout, days("A", 1), 0)
    version_id = commit(spark, layout, days("A", 2, 3), 1)
    for step in ("record_files", "_record"):  # before and after the note
        with monkeypatch.context() as broken:
            broken.setattr(projection, step, lost)
            with pytest.raises(OSError):
                projection.project_version(spark, layout, version_id, RUN)
    assert projection.project_version(spark, layout, version_id, RUN)
    assert upkeep.audit_merges(spark, layout).where("whole").count() == 2
    assert files.projection_totals(spark, layout).agg(F.sum("points_added")).first()[0] == 3
    assert upkeep.damaged_files(spark, layout).count() == 0


def test_damage_is_found(spark, layout):
    for hours in range(3):
        merged(spark, layout, days("A", 1 + hours), hours)
    order = {r.turn: r.file for r in files.file_records(spark, layout).where("change = 1").collect()}
    own = paths(layout)
    good = own[order[1]].read_bytes()
    for crc in Path(layout.projections).rglob("*.crc"):
        crc.unlink()
    own[order[1]].unlink()
    own[order[2]].write_bytes(b"no parquet")
    own[order[3]].write_bytes(good)  # as many rows, others
    own[order[1]].with_name("part-stray.parquet").write_bytes(good)
    found = {r.file.rsplit("/", 1)[1]: r.damage for r in upkeep.damaged_files(spark, layout).collect()}
    names = {turn: file.rsplit("/", 1)[1] for turn, file in order.items()}
    assert found == {names[1]: "missing", names[2]: "changed", names[3]: "changed", "part-stray.parquet": "unrecorded"}


def test_audit_of_a_dataset_noted_too_late(spark, layout):
    early = DatasetLayout(layout.root, "d", ("year",))
    projection.project_version(spark, early, commit(spark, early, days("A", 1, 2), 0), RUN)
    merged(spark, layout, days("A", 2, 3), 1)
    assert [r.whole for r in upkeep.audit_merges(spark, layout).collect()] == [False]
    empty = DatasetLayout(layout.root, "nothing", track_files=True)
    assert upkeep.audit_merges(spark, empty).count() == 0
    assert files.projection_totals(spark, empty).count() == 0
    assert upkeep.damaged_files(spark, empty).count() == 0
    assert upkeep.orphan_versions(spark, empty, RUN).count() == 0


def test_orphans_go_and_committed_versions_stay(spark, layout, monkeypatch):
    kept = commit(spark, layout, days("A", 1), 0)
    with monkeypatch.context() as broken:
        broken.setattr(versions, "append_commit", lost)
        for hours in (1, 30):
            with pytest.raises(OSError):
                commit(spark, layout, days("A", 2), hours)
    hidden = Path(layout.version("v20240131_000000_000000"), "data", "_temporary", "0")
    hidden.mkdir(parents=True)
    (hidden / "part-0").write_bytes(b"x")
    Path(layout.versions, "notes").mkdir()
    limit = RUN + timedelta(hours=24)
    found = {r.version_id: r.files for r in upkeep.orphan_versions(spark, layout, limit).collect()}
    broken_id, young = (versions.new_version_id(RUN + timedelta(hours=h)) for h in (1, 30))
    assert set(found) == {broken_id, "v20240131_000000_000000"} and found[broken_id] > 0
    assert found["v20240131_000000_000000"] == 0
    # Committed between the listing and the removal: it stays.
    given = upkeep.orphan_versions

    def late(*args):
        rows = upkeep.staged(given(*args), "late")
        versions.append_commit(spark, layout, broken_id, RUN, 9)
        return rows

    monkeypatch.setattr(upkeep, "orphan_versions", late)
    assert upkeep.remove_orphans(spark, layout, limit) == ["v20240131_000000_000000"]
    assert {p.name for p in Path(layout.versions).iterdir()} == {kept, broken_id, young, "notes"}


def test_events_lead_to_manifests(spark, layout):
    first = merged(spark, layout, days("A", 1), 0, bucket="b")
    second = merged(spark, layout, days("A", 2, 3), 1, bucket="b")
    assert Path(layout.manifest(first)).is_file()
    events = projection.read_events(spark, layout)
    junk = spark.createDataFrame([("s", "no json"), ("s", '{"version_manifest_path": "x"}'), ("s", None)], events.schema)
    found = projection.announced_manifests(events.unionAll(events).unionAll(junk), layout.root)
    assert tuples(found, "version_id", "data_points_count", "bucket") == [(first, 1, "b"), (second, 2, "b")]
    assert projection.announced_manifests(events.limit(0), layout.root).count() == 0
    Path(layout.manifest(first)).unlink()
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        projection.announced_manifests(events, layout.root).count()


def test_runs_note_files_if_told_to(spark, folder):
    config = {**CONFIG, "partition_columns": ["year"], "track_files": True}
    run(spark, folder, [1, 2], 0, config)
    run(spark, folder, [1, 2, 3], 1, config)
    layout = DatasetLayout(folder, "d", ("year",))
    assert tuples(files.projection_totals(spark, layout), "turn", "points_added") == [(1, 2), (2, 1)]
