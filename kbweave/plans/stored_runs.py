"""A run written back: snapshots of the pages and the URL master as stored tables by bucket of the URL.

Snapshots are written first, the master is then made from the run's own snapshots, and last the run is finished. Each step knows from the run's id whether it has been done, so that a run that broke off is finished by
running it again, and a finished one changes nothing. A run of some URLs reads and rewrites the buckets of these URLs only.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kbweave.operators import cdc
from kbweave.sources import bucketed
from kbweave.sources.bucketed import BucketedTable
from kbweave.sources.storage import struct

SNAPSHOT = struct("normalized_url string, run_id string, version_no long, content_hash string, previous_content_hash string, effective_hash string, change_status string, index_status string, success boolean, ord long, seen_at timestamp")
MASTER = struct("normalized_url string, first_seen timestamp, last_seen timestamp, is_active boolean, last_content_hash string, last_change_status string, index_status string")


@dataclass(frozen=True)
class Store:
    snapshots: BucketedTable
    master: BucketedTable


def open_store(spark: SparkSession, path: str, buckets: int = 256) -> Store:
    """The two tables at path; new ones where there are none."""
    find = lambda name, schema: bucketed.open_table(spark, f"{path}/{name}") or bucketed.create_table(spark, f"{path}/{name}", "normalized_url", schema, buckets)
    return Store(find("snapshots", SNAPSHOT), find("master", MASTER))


def new_snapshots(store: Store, run_id: str, seen_at: str, pages: DataFrame, whole: bool, buckets: list[int] | None) -> DataFrame:
    """The run's versions: of all pages(normalized_url, ord, success, content_hash), and, where the run is of the whole site, DELETED ones of the active URLs that it lacks."""
    before = store.snapshots.read(buckets)
    at, run = F.lit(seen_at).cast("timestamp"), F.lit(run_id)
    found = cdc.classify_changes(pages, before.select("normalized_url", "version_no", F.col("effective_hash").alias("content_hash")))
    rows = found.withColumn("run_id", run).withColumn("seen_at", at).select(*SNAPSHOT.names)
    if not whole:
        return rows
    last = cdc.latest_snapshots(before.select("normalized_url", "version_no", "effective_hash", "change_status")).where("change_status <> 'DELETED'")
    gone = last.join(pages.select("normalized_url").distinct(), "normalized_url", "left_anti")
    dead = gone.select("normalized_url", run.alias("run_id"), (F.col("version_no") + 1).alias("version_no"), F.col("effective_hash").alias("content_hash"), F.col("effective_hash").alias("previous_content_hash"), "effective_hash", F.lit("DELETED").alias("change_status"), F.lit("SKIPPED").alias("index_status"), F.lit(None).cast("boolean").alias("success"), F.lit(None).cast("long").alias("ord"), at.alias("seen_at"))
    return rows.unionByName(dead)


def record_run(store: Store, run_id: str, seen_at: str, pages: DataFrame, whole: bool = True) -> Store:
    """The store after a run; `whole` runs mark what they lack as deleted and read all buckets, others touch the buckets of their pages only."""
    snapshots, master = store.snapshots, store.master
    touched = None if whole else snapshots.touched(pages)
    if run_id not in snapshots.runs:
        snapshots = snapshots.append(new_snapshots(store, run_id, seen_at, pages, whole, touched), run_id)
    if run_id not in master.runs:
        own = snapshots.read(touched).where(F.col("run_id") == run_id)
        buckets = master.touched(own)
        rows = snapshots.read(buckets).where(F.col("run_id") == run_id)
        dead = rows.where("change_status = 'DELETED'").select("normalized_url")
        master = master.replace(cdc.upsert_master(master.read(buckets), rows.where("change_status <> 'DELETED'"), dead), buckets, run_id)
    return Store(snapshots, master)


def record_indexed(store: Store, run_id: str, indexed: DataFrame) -> Store:
    """The store with the run's PENDING versions of indexed(normalized_url) as INDEXED, in the master too; done twice it changes nothing."""
    done = f"{run_id}/indexed"
    snapshots, master = store.snapshots, store.master
    touched = snapshots.touched(indexed)
    if done not in snapshots.runs:
        rows = snapshots.read(touched)
        own = F.col("run_id") == run_id
        marked = cdc.mark_indexed(rows.where(own), indexed).unionByName(rows.where(~own))
        snapshots = snapshots.replace(marked, touched, done)
    if done not in master.runs:
        rows = master.read(touched)
        ok = indexed.select("normalized_url").distinct().withColumn("__ok", F.lit(True))
        status = F.when(F.coalesce("__ok", F.lit(False)) & (F.col("index_status") == "PENDING"), "INDEXED").otherwise(F.col("index_status"))
        master = master.replace(rows.join(ok, "normalized_url", "left").withColumn("index_status", status).drop("__ok"), touched, done)
    return Store(snapshots, master)
