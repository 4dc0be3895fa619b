"""The run table: one event per start and finish, appended; a run's row is its events merged.

Nothing is updated in place: a start writes RUNNING, a finish writes counters, status, duration and outcome, and `latest` folds them. A run whose finish fails is
finished again as FAILED, so that none stays RUNNING.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kbweave.plans.pipeline import run_status

COUNTERS = ("total_urls", "success_urls", "failed_urls", "new_urls", "updated_urls", "unchanged_urls", "deleted_urls", "total_bytes")
#: Fixed order of what a failure reason lists.
REASON_KEYS = ("pre_finalize_stage", "indexing_errors", "indexed_count", "deleted_count", "crawl_failed_urls", "success_urls", "total_urls")
EVENTS = "run_id string, source string, root_url string, at timestamp, event string, run_status string, " + ", ".join(f"{c} long" for c in COUNTERS) + ", duration_ms long, failed_reason string, metadata map<string,string>, outcome map<string,string>, timings map<string,double>"


def started(spark: SparkSession, run_id: str, source: str, root_url: str, at: object, metadata: dict[str, str] | None = None) -> DataFrame:
    return spark.createDataFrame([(run_id, source, root_url, at, "start", "RUNNING", *[None] * len(COUNTERS), None, None, metadata or {}, None, None)], EVENTS)


def failure_reason(status: Column, error: Column, facts: dict[str, Column]) -> Column:
    """Why a run is not COMPLETED, with the facts that lead there; null if it is."""
    tail = F.concat_ws("; ", *[F.concat(F.lit(f"{k}="), F.coalesce(facts[k].cast("string"), F.lit("0" if k != "pre_finalize_stage" else ""))) for k in REASON_KEYS])
    count = lambda k: F.coalesce(facts[k].cast("string"), F.lit("0"))
    partial = F.concat(F.lit("PARTIAL: bulk_errors="), count("indexing_errors"), F.lit(" indexed_count="), count("indexed_count"), F.lit(" deleted_count="), count("deleted_count"), F.lit(" crawl_failed_urls="), count("crawl_failed_urls"), F.lit(" | "), tail)
    return F.when(status == "FAILED", F.concat_ws(" | ", error, tail)).when(status == "PARTIAL", partial)


def finished(facts: DataFrame, at: Column, strict: bool = False) -> DataFrame:
    """Finish events from facts(run_id, started_ms, finished_ms, error, stage, indexed_count, indexing_errors, deleted_count, timings and the COUNTERS)."""
    status = run_status(F.col("error"), F.col("indexing_errors"), F.col("failed_urls"), F.lit(strict))
    named = {"pre_finalize_stage": F.col("stage"), "crawl_failed_urls": F.col("failed_urls"), **{k: F.col(k) for k in REASON_KEYS if k not in ("pre_finalize_stage", "crawl_failed_urls")}}
    note = F.when((status == "COMPLETED") & (F.col("failed_urls") > 0), F.concat(F.col("failed_urls").cast("string"), F.lit(" crawl URL(s) failed; COMPLETED because no bulk item failed.")))
    outcome = {"pre_finalize_stage": F.col("stage"), "strict_partial_crawl": F.lit(str(strict).lower()), "run_status_final": status, "crawl_failures_note": note}
    outcome |= {k: F.col(k).cast("string") for k in ("indexed_count", "indexing_errors", "deleted_count", *COUNTERS[:-1])}
    merged = F.map_filter(F.create_map(*[x for k, v in outcome.items() for x in (F.lit(k), v.cast("string"))]), lambda _, v: v.isNotNull())
    nothing = F.lit(None).cast("string")
    return facts.select(
        "run_id", nothing.alias("source"), nothing.alias("root_url"), at.cast("timestamp").alias("at"), F.lit("finish").alias("event"), status.alias("run_status"),
        *[F.col(c).cast("long").alias(c) for c in COUNTERS], duration_ms(F.col("started_ms"), F.col("finished_ms")).alias("duration_ms"),
        failure_reason(status, F.nullif(F.trim(F.coalesce("error", F.lit(""))), F.lit("")), named).alias("failed_reason"),
        F.lit(None).cast("map<string,string>").alias("metadata"), merged.alias("outcome"), F.col("timings").cast("map<string,double>").alias("timings"),
    )


def duration_ms(started_ms: Column, finished_ms: Column) -> Column:
    """Milliseconds between two epochs; a run without a start took none."""
    return finished_ms.cast("long") - F.coalesce(started_ms, finished_ms).cast("long")


def merged_outcome(maps: Column) -> Column:
    """One map of several in order: a later value of a key replaces an earlier one."""
    entries = F.flatten(F.transform(F.filter(maps, lambda m: m.isNotNull()), F.map_entries))
    last = F.filter(entries, lambda e, i: ~F.exists(F.slice(entries, i + 2, F.size(entries)), lambda later: later["key"] == e["key"]))
    return F.map_from_entries(last)


def latest(events: DataFrame) -> DataFrame:
    """One row per run: what the start says, the last finish, and outcome and timings of all finishes merged in order of time."""
    fields = ["run_status", *COUNTERS, "duration_ms", "failed_reason"]
    is_end = F.col("event") == "finish"
    out = events.groupBy("run_id").agg(
        F.max("source").alias("source"),
        F.max("root_url").alias("root_url"),
        F.min(F.when(~is_end, F.col("at"))).alias("started_at"),
        F.max(F.when(is_end, F.col("at"))).alias("finished_at"),
        F.max_by(F.struct(*fields), F.struct(is_end, "at")).alias("l"),
        F.max_by("metadata", F.when(~is_end, F.col("at"))).alias("metadata"),
        F.transform(F.array_sort(F.collect_list(F.struct("at", F.map_entries("outcome").alias("o")))), lambda x: F.map_from_entries(x["o"])).alias("outcomes"),
        F.transform(F.array_sort(F.collect_list(F.struct("at", F.map_entries("timings").alias("t")))), lambda x: F.map_from_entries(x["t"])).alias("times"),
    )
    return out.select("run_id", "source", "root_url", "started_at", "finished_at", "l.*", "metadata", merged_outcome(F.col("outcomes")).alias("outcome"), merged_outcome(F.col("times")).alias("timings"))


def close_run(finish: Callable[[], DataFrame], append: Callable[[DataFrame], None], facts: DataFrame, at: Column) -> bool:
    """Append the finish; if that fails, append FAILED with the reason instead. Whether the finish went through."""
    try:
        append(finish())
        return True
    except Exception as e:
        crashed = facts.withColumn("error", F.lit(f"finalize crashed: {type(e).__name__}: {e}"))
        append(finished(crashed, at))
        return False


def exit_code(status: str | None, indexing_errors: int) -> int:
    """0 done, 2 failed, 3 done with bulk errors, 1 without any state."""
    return 1 if status is None else 2 if status == "FAILED" else 3 if indexing_errors > 0 else 0


def broken_references(rows: DataFrame, key: str, parents: DataFrame, parent_key: str) -> DataFrame:
    """Rows whose key has no parent: snapshots without their run or page. There should be none."""
    return rows.join(parents.select(F.col(parent_key).alias(key)).distinct(), key, "left_anti")
