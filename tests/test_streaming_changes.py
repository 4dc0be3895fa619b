"""The stateful stream against the batch operators over three runs, with a restart before each and a replayed file."""

from __future__ import annotations

import random
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from kbweave.operators import cdc
from kbweave.streaming import changes as streaming


def made_runs(seed=1):
    rng = random.Random(seed)
    runs = []
    for run in (1, 2, 3):
        rows = []
        for i in range(60):
            if rng.random() < 0.8:
                for _ in range(rng.choice([1, 1, 2])):
                    rows.append((f"https://h/{i}", run, len(rows), rng.random() < 0.8, f"c{rng.randint(0, 2)}"))
        runs.append(rows)
    return runs


def frame(spark, rows):
    at = [(u, r, o, datetime(2024, 1, r), s, h) for u, r, o, s, h in rows]
    return spark.createDataFrame(at, streaming.PAGE)


def batch_changes(spark, runs):
    """Run by run with classify_changes and deleted_pages."""
    out, history, before = [], [], None
    schema = "normalized_url string, version_no long, content_hash string, change_status string"
    for rows in runs:
        snapshots = spark.createDataFrame(history, schema)
        now = frame(spark, rows)
        found = cdc.classify_changes(now, snapshots).collect()
        gone = [] if before is None else cdc.deleted_pages(spark.createDataFrame(before, schema), now, snapshots).collect()
        out += [(r["normalized_url"], r["run"], r["ord"], r["version_no"], r["change_status"], r["index_status"], r["effective_hash"], r["previous_content_hash"]) for r in found]
        dead = [(r["normalized_url"], r["version_no"], r["content_hash"], "DELETED") for r in gone]
        out += [(u, None, None, v, s, "SKIPPED", h, h) for u, v, h, s in dead]
        fresh = [(r["normalized_url"], r["version_no"], r["effective_hash"], r["change_status"]) for r in found]
        history += fresh + dead
        # what the previous run had, and what stays deleted
        seen = {u for u, *_ in fresh}
        before = fresh + [x for x in before or [] if x[0] not in seen and x[0] not in {d[0] for d in dead}]
    return out


def drain(spark, tmp_path):
    pages = spark.readStream.schema(streaming.PAGE).parquet(str(tmp_path / "in"))
    found = streaming.stream_changes(pages, keep="12 hours")
    q = found.writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "check")).trigger(availableNow=True).start()
    assert q.awaitTermination(240)


def test_stream_equals_batch_over_three_runs(spark, tmp_path):
    runs = made_runs()
    (tmp_path / "in").mkdir()
    for k, rows in enumerate(runs):
        frame(spark, rows).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        if k == 1:  # the first run's file is delivered once more
            frame(spark, runs[0]).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        drain(spark, tmp_path)  # each start is a restart from the checkpoint
    got = [tuple(r) for r in spark.read.schema(streaming.CHANGE).parquet(str(tmp_path / "out")).collect()]
    want = batch_changes(spark, runs)
    seen = lambda rows: sorted(r for r in rows if r[4] != "DELETED")
    dead = lambda rows: sorted((r[0], r[3], *r[5:]) for r in rows if r[4] == "DELETED")
    assert seen(got) == seen(want)
    assert dead(got) == dead(want) and dead(got)


@pytest.mark.parametrize("seed", range(20))
def test_steps_equal_the_window(seed):
    """The state machine by itself against a plain chain."""
    rng = random.Random(seed)
    state, out = None, []
    rows = [(run, k, rng.random() < 0.6, f"c{rng.randint(0, 2)}") for run in (1, 2) for k in range(6)]
    for run, k, ok, digest in rows:
        state, change = streaming.step(state, run, k, run * 1000, ok, digest)
        out.append(change)
        assert streaming.step(state, run, k, run * 1000, ok, digest) == (state, None)
    before = None
    for (run, k, ok, digest), change in zip(rows, out, strict=True):
        effective = digest if ok or before is None else before
        status = "NEW" if before is None else "UNCHANGED" if not ok or digest == before else "UPDATED"
        assert change[:2] == (run, k) and change[3] == status and change[5:] == (effective, before)
        before = effective
    assert [c[2] for c in out] == list(range(1, 13))


def test_batch_use_of_the_filter(spark):
    rows = spark.createDataFrame([("u", 1, 1, 1, "NEW", "PENDING", "a", None), ("u", 1, None, 2, "DELETED", "SKIPPED", "a", "a")], streaming.CHANGE)
    assert [r["version_no"] for r in streaming.deleted_of(rows).select(F.col("version_no")).collect()] == [2]
