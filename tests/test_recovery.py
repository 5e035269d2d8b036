"""Changelogs, refused values, late rows, and runs that break at any step."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F
from rows import CODE, observations, points, tuples

from tidemark.operators.lookup import fits_broadcast
from tidemark.operators.merge import added_rows, merge_outcome, refused_rows
from tidemark.plans import changelog, projection, refresh, versions
from tidemark.plans.layout import DatasetLayout
from tidemark.schemas import COMMIT_LOG
from tidemark.session import read_table
from tidemark.sources.series import series_map
from tidemark.streaming.refresh_stream import refresh_stream

RUN = datetime(2024, 2, 1, 12)
KEYS = ["obs_time", CODE]
DAY = "2024-01-{:02d}"


def rows_of(spark, rows, unit="u"):
    return observations(spark, rows, unit=F.lit(unit), frequency=F.lit(None).cast("string"))


def test_changelog(spark):
    nan = float("nan")
    old = rows_of(spark, [("A", DAY.format(1), 1), ("A", DAY.format(2), 2), ("A", DAY.format(3), nan), ("B", DAY.format(1), None),
                          ("C", DAY.format(1), 5), (None, DAY.format(1), 1), ("D", DAY.format(1), 7), ("D", DAY.format(1), 8)])
    new = rows_of(spark, [("A", DAY.format(1), 1), ("A", DAY.format(2), 3), ("A", DAY.format(3), nan), ("B", DAY.format(1), 4),
                          ("E", DAY.format(1), 6), (None, DAY.format(1), 2), ("D", DAY.format(1), 7), ("D", DAY.format(1), 9)])
    changes = changelog.changelog(old, new, order="ord")
    got = {(r[CODE], r.obs_time.day): (r.change, r.old_value, r.new_value, r.facts_changed) for r in changes.collect()}
    assert got == {
        ("A", 2): ("changed", 2.0, 3.0, False), ("B", 1): ("changed", None, 4.0, False), ("C", 1): ("removed", 5.0, None, False),
        ("E", 1): ("added", None, 6.0, False), (None, 1): ("changed", 1.0, 2.0, False),
    }
    counts = {r[CODE]: (r.added, r.removed, r.changed) for r in changelog.change_counts(changes).collect()}
    assert counts == {"A": (0, 0, 1), "B": (0, 0, 1), "C": (0, 1, 0), "E": (1, 0, 0), None: (0, 0, 1)}
    assert changelog.changelog(old, old.withColumn("unit", F.lit("")), order="ord").where("facts_changed").count() == 7
    assert changelog.changelog(old, old.limit(0), order="ord").where("change = 'removed'").count() == 7
    with pytest.raises(ValueError):
        changelog.changelog(old.drop("unit"), new)


def test_changelog_of_a_hot_key(spark):
    """A key with most of the rows is reduced before it is shuffled, and nothing is sorted if keys are unique."""
    rows = spark.range(0, 200_000, 1, 8).selectExpr(
        "timestamp'2024-01-01' + make_interval(0, 0, 0, if(id % 3 = 0, 0, int(id))) AS obs_time",
        f"'S' AS {CODE}", "double(id) AS value", "id AS ord", "'u' AS unit", "'D' AS frequency",
    )
    found = changelog.changelog(rows, rows.where("id % 3 <> 1"), order="ord")
    assert [tuple(r) for r in found.groupBy("change").count().collect()] == [("removed", 66_667)]
    plan = changelog.changelog(rows, rows, unique=True)._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan and plan.count("Exchange hashpartitioning") == 1


def commit(spark, layout, rows, hours, **how):
    run_ts = RUN + timedelta(hours=hours)
    frame = rows_of(spark, rows).drop("ord").withColumn("collection_date", F.lit(run_ts.isoformat(" ")).cast("timestamp"))
    version_id = versions.new_version_id(run_ts)
    versions.commit_version(frame, layout, version_id, run_ts, **how)
    return version_id


def test_changes_of_versions(spark, folder):
    layout = DatasetLayout(folder, "d")
    first = commit(spark, layout, [("A", DAY.format(1), 1), ("A", DAY.format(2), 2)], 0, unique_keys=True)
    second = commit(spark, layout, [("A", DAY.format(2), 3)], 1)
    third = commit(spark, layout, [("A", DAY.format(2), 3)], 2)
    assert changelog.previous_version(spark, layout, third) == second
    assert changelog.previous_version(spark, layout, first) is None
    kinds = lambda *ids: sorted(r.change for r in changelog.version_changelog(spark, layout, *ids).collect())
    assert kinds(first) == ["added", "added"] and kinds(second) == ["changed", "removed"]
    assert kinds(third) == [] and kinds(third, first) == ["changed", "removed"]


def test_merge_outcome(spark):
    base = rows_of(spark, [("A", DAY.format(1), 1), ("A", DAY.format(2), None), ("A", DAY.format(3), 3), ("A", DAY.format(5), 5)])
    news = rows_of(spark, [("A", DAY.format(1), 1), ("A", DAY.format(2), 2), ("A", DAY.format(3), 30), ("A", DAY.format(3), 3),
                           ("A", DAY.format(4), 4), ("A", DAY.format(4), 40), ("B", DAY.format(1), 6), ("B", DAY.format(1), 6)])
    outcome = merge_outcome(base, news, order="ord")
    assert tuples(added_rows(outcome), CODE, "value") == [("A", 4.0), ("B", 6.0)]
    assert set(added_rows(outcome).columns) == set(news.columns)
    refused = {(r[CODE], r.obs_time.day): tuple(r)[2:] for r in refused_rows(outcome).collect()}
    assert refused == {
        ("A", 2): (None, 2.0, 1, 2.0, 2.0, True), ("A", 3): (3.0, 30.0, 2, 3.0, 30.0, True), ("A", 4): (4.0, None, 2, 4.0, 40.0, False),
    }
    assert refused_rows(merge_outcome(base, base, order="ord")).count() == 0
    assert added_rows(merge_outcome(base.limit(0), base, order="ord")).count() == 4


def test_refused_values_of_versions(spark, folder, monkeypatch):
    layout = DatasetLayout(folder, "d")
    first = commit(spark, layout, [("A", DAY.format(1), 1), ("A", DAY.format(2), 2)], 0)
    second = commit(spark, layout, [("A", DAY.format(2), 3), ("A", DAY.format(3), 4)], 1)
    projection.project_version(spark, layout, first, RUN, report_refused=True)
    record = projection._record
    monkeypatch.setattr(projection, "_record", lambda *a: (_ for _ in ()).throw(OSError("lost")))
    with pytest.raises(OSError):
        projection.project_version(spark, layout, second, RUN, report_refused=True)
    monkeypatch.setattr(projection, "_record", record)
    projection.project_version(spark, layout, second, RUN, report_refused=True)  # again: the same conflicts
    found = [(r[CODE], r.stored_value, r.refused_value, r.version_id) for r in projection.read_refused(spark, layout).collect()]
    assert found == [("A", 2.0, 3.0, second)]
    assert tuples(projection.read_projection(spark, layout), "value") == [(1.0,), (2.0,), (4.0,)]
    with pytest.raises(ValueError):
        projection.project_version(spark, layout, second, RUN, publish="rewrite", report_refused=True)


CONFIG = {
    "dataset_id": "d",
    "normalize": {"timezone": "UTC", "primary_keys": KEYS},
    "parse_config": {"series_map": [{CODE: "A", "unit": "u", "frequency": "D"}]},
}


def run(spark, folder, days, hours, config=CONFIG, drops=False):
    run_ts = RUN + timedelta(hours=hours)
    series = series_map(spark, config)
    source = points(spark, [("A", DAY.format(d), d) for d in days]).withColumnRenamed("value_num", "value").drop("value_str")
    stages = refresh.table_stages(series, config, run_ts, ["ord"])
    if drops:
        given = stages.transform
        stages = refresh.Stages(stages.parse, stages.normalize, lambda r: given(r).where("value % 2 = 0"), True)
    return refresh.run_refresh(source, config, folder, run_ts, stages)


def lost(*args, **how):
    raise OSError("lost")


@pytest.mark.parametrize(
    "step, kind",
    [("commit_version", "plain"), ("project_current", "plain"), ("save_state", "plain"), ("after_marks", "drops"),
     ("save_state", "drops"), ("project_current", "window"), ("save_state", "window")],
)
def test_a_broken_run_is_finished_by_the_next(spark, folder, monkeypatch, step, kind):
    config = {**CONFIG, "windowInDays": 40} if kind == "window" else CONFIG
    how = {"config": config, "drops": kind == "drops"}
    with monkeypatch.context() as broken:
        if step == "after_marks":  # everything is done but the last row of the journal
            note = refresh._note
            broken.setattr(refresh, "_note", lambda *a: lost() if a[3] == "saved" else note(*a))
        else:
            broken.setattr(refresh, step, lost)
        with pytest.raises(OSError):
            run(spark, folder, [1, 2, 3, 4], 0, **how)
    layout = DatasetLayout(folder, "d")
    assert refresh.unfinished_runs(spark, layout).count() == (step != "commit_version")
    run(spark, folder, [1, 2, 3, 4, 5, 6], 1, **how)
    run(spark, folder, [1, 2, 3, 4, 5, 6], 2, **how)
    wanted = [d for d in range(1, 7) if kind != "drops" or d % 2 == 0]
    assert tuples(projection.read_projection(spark, layout), "value") == [(float(d),) for d in wanted]
    commits = read_table(spark, layout.commit_log, COMMIT_LOG)
    assert commits.count() == (1 if step == "commit_version" else 2)
    rows = [versions.read_version(spark, layout, r[0]).count() for r in commits.select("version_id").collect()]
    assert sum(rows) == len(wanted)  # no row is in two versions
    assert [r.last_obs_local.day for r in refresh.load_state(spark, layout).collect()] == [6]
    assert refresh.unfinished_runs(spark, layout).count() == 0


def test_runs_of_a_dataset_without_a_journal_are_left_alone(spark, folder):
    layout = DatasetLayout(folder, "d")
    commit(spark, layout, [("A", DAY.format(9), 1)], 0)
    assert refresh.finish_runs(spark, layout, RUN) == []


def test_late_rows_do_not_depend_on_the_order_of_files(spark, folder, monkeypatch):
    run(spark, folder, [4, 6], 0)
    layout = DatasetLayout(folder, "d")
    series = series_map(spark, CONFIG)
    for n, days in enumerate([[9, 5], [6, 8], [3, 7]]):
        source = points(spark, [("A", DAY.format(d), 10 * d) for d in days]).withColumnRenamed("value_num", "value")
        source.drop("value_str").coalesce(1).write.mode("append").parquet(f"{folder}/in")
    schema = spark.read.parquet(f"{folder}/in").schema

    def stream():
        refresh_stream(
            spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{folder}/in"), CONFIG, folder, RUN + timedelta(days=1),
            f"{folder}/checkpoint", lambda run_ts: refresh.table_stages(series, CONFIG, run_ts, ["ord"]),
        ).awaitTermination()

    with monkeypatch.context() as broken:
        broken.setattr(refresh, "save_state", lost)
        with pytest.raises(Exception, match="lost"):
            stream()
    stream()
    late = refresh.read_late_rows(spark, layout)
    assert tuples(late, "value") == [(30.0,), (50.0,), (60.0,)] and late.select("batch").distinct().count() >= 2
    assert {r.last_obs_local.day for r in late.collect()} == {6}
    stored = tuples(projection.read_projection(spark, layout), "value")
    assert stored == [(4.0,), (6.0,), (30.0,), (50.0,), (70.0,), (80.0,), (90.0,)]
    assert [r.last_obs_local.day for r in refresh.load_state(spark, layout).collect()] == [9]


def test_sizes_of_nested_values_count(spark, monkeypatch):
    from tidemark.operators import lookup

    monkeypatch.setattr(lookup, "BROADCAST_BYTES", 10_000)
    for value in ("array_repeat(1.0, 1000)", "repeat('x', 10000)", "cast(repeat('x', 10000) AS binary)",
                  "array(repeat('x', 10000))", "map('k', repeat('x', 10000))", "struct(repeat('x', 10000) AS a)"):
        assert not fits_broadcast(spark.range(2).selectExpr("id", f"{value} AS v")), value
    assert fits_broadcast(spark.range(2).selectExpr("id", "array(1.0) AS v", "cast(null AS map<string,string>) AS m"))
