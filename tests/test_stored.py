"""Stored tables by bucket and runs written back: what is read and rewritten, failures before the switch, repeated runs."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from kbweave.operators import cdc
from kbweave.plans import stored_runs
from kbweave.sources import bucketed, storage


def url(i):
    return f"https://www.example.com/en/p{i}"


def pages(spark, rows):
    """(number, order, success, content)"""
    return spark.createDataFrame([(url(i), o, ok, f"hash-{c}") for i, o, ok, c in rows], "normalized_url string, ord long, success boolean, content_hash string")


def rows_of(table, *columns):
    return sorted((tuple(r) for r in table.read().select(*columns).collect()), key=repr)


@pytest.fixture
def store(spark, tmp_path):
    fresh = stored_runs.open_store(spark, str(tmp_path / "store"), buckets=64)
    first = [(i, i, i % 9 != 0, "a") for i in range(400)]
    return stored_runs.record_run(fresh, "r1", "2024-01-01 00:00:00", pages(spark, first))


def test_runs_equal_the_operators(spark, store):
    second = [(i, i, i % 7 != 0, "b" if i % 3 == 0 else "a") for i in range(0, 380)] + [(5, 900, True, "c"), (500, 901, True, "n")]
    now = pages(spark, second)
    before = store.snapshots.read()
    want = cdc.classify_changes(now, before.select("normalized_url", "version_no", F.col("effective_hash").alias("content_hash")))
    master = store.master.read()
    done = stored_runs.record_run(store, "r2", "2024-01-02 00:00:00", now)
    got = done.snapshots.read().where("run_id = 'r2'")
    columns = ("normalized_url", "ord", "version_no", "change_status", "index_status", "effective_hash", "previous_content_hash")
    assert sorted(tuple(r) for r in got.where("change_status <> 'DELETED'").select(*columns).collect()) == sorted(tuple(r) for r in want.select(*columns).collect())
    gone = sorted(r[0] for r in got.where("change_status = 'DELETED'").select("normalized_url").collect())
    assert gone == sorted(url(i) for i in range(380, 400))
    at = F.lit("2024-01-02").cast("timestamp")
    expected = cdc.upsert_master(master, want.withColumn("seen_at", at), spark.createDataFrame([(u,) for u in gone], "normalized_url string"))
    assert rows_of(done.master, *stored_runs.MASTER.names) == sorted((tuple(r) for r in expected.select(*stored_runs.MASTER.names).collect()), key=repr)
    # a page that comes back after its deletion
    back = stored_runs.record_run(done, "r3", "2024-01-03 00:00:00", pages(spark, [(390, 1, True, "a")]), whole=False)
    last = back.snapshots.read().where(F.col("normalized_url") == url(390)).orderBy(F.desc("version_no")).first()
    assert (last["change_status"], last["version_no"]) == ("UNCHANGED", 3)
    assert back.master.read().where(F.col("normalized_url") == url(390)).first()["is_active"]


def test_small_runs_touch_their_buckets(spark, store):
    some = pages(spark, [(7, 1, True, "z"), (8, 2, True, "z"), (900, 3, True, "n")])
    touched = store.master.touched(some)
    assert len(touched) <= 3
    done = stored_runs.record_run(store, "r2", "2024-01-02 00:00:00", some, whole=False)
    old, new = set(store.master.files()), set(done.master.files())
    assert {int(f.split("bucket=")[1]) for f in old ^ new} == set(touched)
    # what the run reads: files of these buckets only
    read = {f.split("bucket=")[1].split("/")[0] for f in store.snapshots.read(touched).inputFiles()}
    assert read <= {str(b) for b in touched}
    assert set(done.snapshots.files()) > set(store.snapshots.files())
    assert done.master.read().count() == 401


def test_repeated_runs_change_nothing(spark, store, tmp_path):
    now = pages(spark, [(i, i, True, "q") for i in range(20)])
    done = stored_runs.record_run(store, "r2", "2024-01-02 00:00:00", now, whole=False)
    again = stored_runs.record_run(stored_runs.open_store(spark, str(tmp_path / "store")), "r2", "2024-01-02 00:00:00", now, whole=False)
    assert (again.master.version, again.snapshots.version) == (done.master.version, done.snapshots.version)
    assert rows_of(again.snapshots, "normalized_url", "version_no") == rows_of(done.snapshots, "normalized_url", "version_no")


def test_failure_before_the_switch_leaves_the_old_rows(spark, store, tmp_path, monkeypatch):
    now = pages(spark, [(i, i, True, "q") for i in range(20)])
    before = rows_of(store.master, *stored_runs.MASTER.names)
    commit = bucketed.BucketedTable._commit

    def fail(self, folders, run):
        if self.path.endswith("master"):
            raise RuntimeError("lost")
        return commit(self, folders, run)

    monkeypatch.setattr(bucketed.BucketedTable, "_commit", fail)
    with pytest.raises(RuntimeError, match="lost"):
        stored_runs.record_run(store, "r2", "2024-01-02 00:00:00", now, whole=False)
    monkeypatch.undo()
    opened = stored_runs.open_store(spark, str(tmp_path / "store"))
    assert rows_of(opened.master, *stored_runs.MASTER.names) == before and "r2" in opened.snapshots.runs
    finished = stored_runs.record_run(opened, "r2", "2024-01-02 00:00:00", now, whole=False)
    assert finished.snapshots.version == opened.snapshots.version and "r2" in finished.master.runs
    changed = finished.master.read().where("last_change_status = 'UPDATED'").count()
    assert changed == sum(i % 9 != 0 for i in range(20)) + sum(i % 9 == 0 for i in range(20))
    assert bucketed.vacuum(finished.master) > 0 and finished.master.read().count() == 400


def test_indexed_pages_are_written_back(spark, store):
    some = spark.createDataFrame([(url(i),) for i in (1, 2, 9, 9999)], "normalized_url string")
    done = stored_runs.record_indexed(store, "r1", some)
    status = {r["normalized_url"]: r["index_status"] for r in done.snapshots.read().collect()}
    assert [status[url(i)] for i in (1, 2, 3, 9)] == ["INDEXED", "INDEXED", "PENDING", "SKIPPED"]
    assert {r["index_status"] for r in done.master.read().where(F.col("normalized_url").isin(url(1), url(2))).collect()} == {"INDEXED"}
    assert done.snapshots.read().count() == store.snapshots.read().count()
    twice = stored_runs.record_indexed(done, "r1", some)
    assert (twice.master.version, twice.snapshots.version) == (done.master.version, done.snapshots.version)


def test_tables_reject_what_they_cannot_hold(spark, store, tmp_path):
    with pytest.raises(ValueError, match="not replaced"):
        store.master.replace(store.master.read(), [0])
    with pytest.raises(Exception, match="(?i)exist"):
        bucketed.create_table(spark, store.master.path, "normalized_url", stored_runs.MASTER)
    assert bucketed.open_table(spark, str(tmp_path / "nowhere")) is None
    empty = bucketed.create_table(spark, str(tmp_path / "empty"), "normalized_url", stored_runs.MASTER)
    assert empty.read().count() == 0 and bucketed.open_table(spark, str(tmp_path / "empty")).read().count() == 0 and bucketed.vacuum(empty) == 0
    assert storage.exists(spark, str(tmp_path / "empty"))
