"""Each micro-batch is one refresh run."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timedelta, timezone

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from tidemark.plans.refresh import Stages, frozen_marks, layout_of, run_refresh
from tidemark.plans.versions import new_version_id


def refresh_stream(
    source: DataFrame,
    config: dict,
    root: str,
    epoch: datetime,
    checkpoint: str,
    stages_for: Callable[[datetime], Stages],
    publish: str = "append",
    trigger: dict | None = None,
    late_rows: bool = True,
    monotonic_state: bool = True,
    bucket: str | None = None,
    as_of: Callable[[datetime], datetime] | None = None,
) -> StreamingQuery:
    """Start a query that commits and projects every micro-batch.

    Without a ``trigger`` (options of ``DataStreamWriter.trigger``) it stops when it caught up.
    Batch n has the version id of ``epoch`` plus n microseconds, so a batch repeated after a
    failure has the id of its first attempt: the commit log and the projected versions make it
    take effect once.  Its rows carry the time of the attempt that was committed.

    The order in which files arrive does not decide which rows are kept: a row before its
    series' mark is merged like any other, and marks only move on.  (Of rows with one key in
    several batches, the first one written stays.)  Such rows are listed with their batch as
    ``read_late_rows`` gives them: those at or before the marks as they were when the stream of
    this ``epoch`` first began, so the order of files does not decide that either.  With ``late_rows`` off such rows are
    dropped, as a run does.  ``as_of`` gives the end of the time window of a batch from its
    time.
    """

    spark = source.sparkSession
    marks = frozen_marks(spark, layout_of(root, config), new_version_id(epoch)) if late_rows else None

    def run_batch(batch: DataFrame, batch_id: int) -> None:
        run_ts = datetime.now(timezone.utc)
        run_refresh(
            batch,
            config,
            root,
            run_ts,
            stages_for(run_ts),
            as_of=as_of(run_ts) if as_of else None,
            publish=publish,
            monotonic_state=monotonic_state,
            bucket=bucket,
            late_rows=late_rows,
            frozen_marks=marks,
            version_id=new_version_id(epoch + timedelta(microseconds=batch_id)),
        )

    return (
        source.writeStream.foreachBatch(run_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )
