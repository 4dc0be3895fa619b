"""Change detection between runs: NEW, UPDATED, UNCHANGED and DELETED versions of pages, set-based.

A page's version chain is a window over its rows in input order; the state before the run is each page's latest snapshot. Nothing is
looked up row by row, and both tables meet in one equi-join on the normalized URL.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

FINISHED = ("COMPLETED", "PARTIAL")


def latest_snapshots(snapshots: DataFrame, key: str = "normalized_url") -> DataFrame:
    """The row of the greatest version of each page, deleted ones included; an aggregate, so it combines before the shuffle."""
    rest = [c for c in snapshots.columns if c != key]
    return snapshots.groupBy(key).agg(F.max_by(F.struct(*rest), "version_no").alias("__row")).select(key, "__row.*")


def classify_changes(current: DataFrame, snapshots: DataFrame) -> DataFrame:
    """current(normalized_url, ord, success, content_hash) against the snapshots (normalized_url, version_no, content_hash).

    Adds previous_content_hash, effective_hash, change_status, version_no and index_status. A failed fetch carries the last known
    content on; a page that fails at first is NEW and becomes UPDATED when it succeeds; a page that returns after deletion with the same content is UNCHANGED.
    """
    before = latest_snapshots(snapshots.select("normalized_url", "version_no", "content_hash")).select("normalized_url", F.col("version_no").alias("__v"), F.col("content_hash").alias("__h"))
    joined = current.where("normalized_url <> ''").join(before, "normalized_url", "left")
    chain = W.partitionBy("normalized_url").orderBy("ord")
    upto = chain.rowsBetween(W.unboundedPreceding, 0)
    effective = F.coalesce(F.last(F.when(F.col("success"), F.col("content_hash")), ignorenulls=True).over(upto), F.col("__h"), F.first("content_hash").over(upto))
    numbered = joined.withColumn("effective_hash", effective).withColumn("__n", F.row_number().over(chain))
    chained = numbered.withColumn("previous_content_hash", F.coalesce(F.lag("effective_hash").over(chain), F.col("__h")))
    status = (
        F.when(F.col("previous_content_hash").isNull(), "NEW")
        .when(~F.col("success"), "UNCHANGED")
        .when(F.col("content_hash") == F.col("previous_content_hash"), "UNCHANGED")
        .otherwise("UPDATED")
    )
    done = chained.withColumn("change_status", status).withColumn("version_no", F.coalesce("__v", F.lit(0)) + F.col("__n"))
    pending = F.col("success") & F.col("change_status").isin("NEW", "UPDATED")
    return done.withColumn("index_status", F.when(pending, "PENDING").otherwise("SKIPPED")).drop("__v", "__h", "__n")


def changed_fields(status, success, current_markdown, previous_markdown):
    """Names of the fields that changed; only the body counts."""
    body = F.when(status == "NEW", success).otherwise((status == "UPDATED") & ~current_markdown.eqNullSafe(previous_markdown))
    return F.array_compact(F.array(F.when(body, F.lit("markdown"))))


def latest_finished_run(runs: DataFrame, run_id: str) -> DataFrame:
    done = runs.where(F.col("run_status").isin(*FINISHED) & (F.col("run_id") != run_id))
    return done.agg(F.max_by("run_id", "started_at").alias("run_id"))


def deleted_pages(previous: DataFrame, current: DataFrame, snapshots: DataFrame) -> DataFrame:
    """New DELETED versions of pages that the previous run had and the current one lacks."""
    gone = previous.where("change_status <> 'DELETED'").select("normalized_url").distinct().join(current.select("normalized_url").distinct(), "normalized_url", "left_anti")
    last = latest_snapshots(snapshots.select("normalized_url", "version_no", "content_hash"))
    return gone.join(last, "normalized_url").select("normalized_url", F.col("content_hash"), (F.col("version_no") + 1).alias("version_no"), F.lit("DELETED").alias("change_status"), F.lit(False).alias("is_active"))


def run_counters(changes: DataFrame, deleted: DataFrame, size: Column | None = None) -> DataFrame:
    """One row of counters, `size` being the bytes of a page's body; total_urls counts rows before those without a URL are dropped, so pass all of them."""
    rows = changes.select("change_status", F.col("success"), (F.octet_length("markdown").cast("long") if size is None else size).alias("bytes"))
    both = rows.unionByName(deleted.select(F.lit("DELETED").alias("change_status"), F.lit(None).cast("boolean").alias("success"), F.lit(0).cast("long").alias("bytes")))
    return both.agg(*counters(F.col("bytes")))


def counters(size: Column) -> list[Column]:
    """The counters of a run over its rows (change_status, success; success is null for deletions), for an aggregate or for metrics that are observed while the rows are written."""
    status = F.col("change_status")
    return [
        F.count_if(F.col("success").isNotNull()).alias("total_urls"),
        F.count_if("success").alias("success_urls"),
        F.count_if(~F.col("success")).alias("failed_urls"),
        *[F.count_if(status == s).alias(f"{s.lower()}_urls") for s in ("NEW", "UPDATED", "UNCHANGED", "DELETED")],
        F.coalesce(F.sum(F.when(F.col("success"), size)), F.lit(0)).cast("long").alias("total_bytes"),
    ]


def upsert_master(master: DataFrame, changes: DataFrame, deleted: DataFrame, key: str = "normalized_url") -> DataFrame:
    """url master (normalized_url, first_seen, last_seen, is_active, last_content_hash, last_change_status, index_status) after a run.

    changes carries `seen_at`; of several rows of a page the last one counts.
    """
    last = changes.groupBy(key).agg(F.max_by(F.struct("seen_at", "effective_hash", "change_status", "index_status"), "version_no").alias("n"))
    gone = deleted.select(key, F.lit(True).alias("gone"))
    joined = master.join(last, key, "full_outer").join(gone, key, "left")
    seen = F.col("n").isNotNull()
    dead = F.coalesce("gone", F.lit(False))
    return joined.select(
        key,
        F.coalesce("first_seen", "n.seen_at").alias("first_seen"),
        F.coalesce("n.seen_at", "last_seen").alias("last_seen"),
        F.when(dead, False).when(seen, True).otherwise(F.col("is_active")).alias("is_active"),
        F.coalesce("n.effective_hash", "last_content_hash").alias("last_content_hash"),
        F.when(dead, "DELETED").otherwise(F.coalesce("n.change_status", "last_change_status")).alias("last_change_status"),
        F.coalesce("n.index_status", F.col("index_status")).alias("index_status"),
    )


def mark_deleted(master: DataFrame, gone: DataFrame, at: Column, key: str = "normalized_url") -> DataFrame:
    """The master's rows of gone pages are inactive and DELETED, and were seen last at a time."""
    hit = F.coalesce("__gone", F.lit(False))
    joined = master.join(gone.select(key, F.lit(True).alias("__gone")).distinct(), key, "left")
    new = {"is_active": F.lit(False), "last_change_status": F.lit("DELETED"), "last_seen": at}
    return joined.select(*[F.when(hit, new[c]).otherwise(F.col(c)).alias(c) if c in new else F.col(c) for c in master.columns])


def mark_indexed(snapshots: DataFrame, indexed: DataFrame, key: str = "normalized_url") -> DataFrame:
    """PENDING rows of successfully indexed pages become INDEXED."""
    ok = indexed.select(key).distinct().withColumn("__ok", F.lit(True))
    hit = F.coalesce("__ok", F.lit(False)) & (F.col("index_status") == "PENDING") & F.col("success")
    return snapshots.join(ok, key, "left").withColumn("index_status", F.when(hit, "INDEXED").otherwise(F.col("index_status"))).drop("__ok")
