"""Counters that come with the writing job, and stage times up to the run table."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from kbweave.operators import cdc, metrics, runs
from kbweave.sources import storage


def test_counters_come_with_the_write(spark):
    rows = spark.createDataFrame([("NEW", True, 5), ("UPDATED", True, 7), ("UNCHANGED", False, 9), ("DELETED", None, None), ("NEW", False, None)], "change_status string, success boolean, bytes long")
    jobs = []
    written, found = metrics.written_with_counters(rows, lambda df: jobs.append(1) or storage.materialize(df, "metrics"), F.col("bytes"))
    want = cdc.run_counters(rows.where("success is not null"), rows.where("success is null"), F.col("bytes")).first().asDict()
    assert found.first().asDict() == want == {"total_urls": 4, "success_urls": 2, "failed_urls": 2, "new_urls": 2, "updated_urls": 1, "unchanged_urls": 1, "deleted_urls": 1, "total_bytes": 12}
    assert written.count() == 5 and len(jobs) == 1
    storage.drop(written)
    assert metrics.written_with_counters(rows.limit(0), lambda df: storage.materialize(df, "metrics"), F.col("bytes"))[1].first()["total_urls"] == 0


def test_stage_times_reach_the_run_table(spark):
    ticks = iter([0.0, 2.0, 10.0, 10.5, 20.0, 21.0])
    times = metrics.StageTimes(clock=lambda: next(ticks))
    with times.stage("audit"):
        pass
    with pytest.raises(RuntimeError), times.stage("chunk"):
        raise RuntimeError
    with times.stage("audit"):
        pass
    assert times.seconds == {"audit": 3.0, "chunk": 0.5}
    facts = spark.range(1).select(F.lit("r").alias("run_id"), F.lit(0).alias("started_ms"), F.lit(9).alias("finished_ms"), F.lit("").alias("error"), F.lit("sync").alias("stage"), *[F.lit(0).alias(c) for c in ("indexed_count", "indexing_errors", "deleted_count", *runs.COUNTERS)], times.column().alias("timings"))
    first = runs.finished(facts, F.lit("2024-01-02"))
    again = runs.finished(facts.withColumn("timings", F.create_map(F.lit("audit"), F.lit(4.0))), F.lit("2024-01-03"))
    got = runs.latest(first.unionByName(again)).first()
    assert got["timings"] == {"audit": 4.0, "chunk": 0.5}
    assert metrics.StageTimes().column() is not None and runs.latest(runs.started(spark, "s", "a", "b", None)).first()["timings"] in ({}, None)
