"""Page tables: keep-best dedupe, merges of secondary sources, retry recovery, filters and crawl summaries.

Order of input matters in these operators and is carried as a column (`ord`), since rows of a table have none.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from kbweave.functions.classify import failure_bucket
from kbweave.functions.urls import CrawlRules, admission_reason, blocklists, domain, normalize_url, path


def dedupe_best(pages: DataFrame, key: str, success: str = "success", body: str = "markdown", ord: str = "ord") -> DataFrame:
    """One row per key: successful before failed, longer before shorter, first before later. `place` is the key's first
    appearance; rows without a key stay and come last."""
    keyed, keyless = _by_key(pages, key, ord)
    rank = W.partitionBy(key).orderBy(F.desc(F.coalesce(F.col(success), F.lit(False))), F.desc(F.length(F.coalesce(F.col(body), F.lit("")))), ord)
    ranked = keyed.withColumn("__rank", F.row_number().over(rank)).withColumn("place", F.min(ord).over(W.partitionBy(key)).cast("long"))
    return ranked.where("__rank = 1").drop("__rank").unionByName(keyless)


def _by_key(pages: DataFrame, key: str, ord: str) -> tuple[DataFrame, DataFrame]:
    """Rows with a key, and those without, which are placed last and never meet in one partition."""
    present = F.coalesce(F.col(key), F.lit("")) != ""
    return pages.where(present), pages.where(~present).withColumn("place", F.lit(1 << 62) + F.col(ord))


def dedupe_best_by_aggregate(pages: DataFrame, key: str, success: str = "success", body: str = "markdown", ord: str = "ord") -> DataFrame:
    """The same rows as an aggregate that combines before the shuffle; one hot key is no hot task."""
    keyed, keyless = _by_key(pages, key, ord)
    order = F.struct(F.coalesce(F.col(success), F.lit(False)).alias("s"), F.length(F.coalesce(F.col(body), F.lit(""))).alias("n"), (-F.col(ord)).alias("o"))
    best = keyed.groupBy(key).agg(F.max_by(F.struct(*[F.col(c) for c in pages.columns if c != key]), order).alias("__best"), F.min(ord).cast("long").alias("place"))
    return best.select(key, "__best.*", "place").unionByName(keyless)


def append_new(pages: DataFrame, batch: DataFrame, key: str = "source_url", ord: str = "ord") -> DataFrame:
    """pages plus the batch's rows with a key that pages lack; the first of a key within the batch."""
    present = batch.where(F.coalesce(F.col(key), F.lit("")) != "")
    first = present.groupBy(key).agg(F.min_by(F.struct(*[F.col(c) for c in batch.columns if c != key]), ord).alias("__first")).select(key, "__first.*")
    return pages.unionByName(first.join(pages.select(key).distinct(), key, "left_anti"), allowMissingColumns=True)


def upsert(pages: DataFrame, batch: DataFrame, key: str, ord: str = "ord") -> DataFrame:
    """The batch's row replaces the first page with its key in place (keeping `ord`), or is appended. Keys of the batch are distinct."""
    first = pages.groupBy(key).agg(F.min(ord).alias("__first"))
    marked = pages.join(first, key, "left")
    incoming = batch.select(F.col(key), F.struct(*[F.col(c) for c in batch.columns if c not in (key, ord)]).alias("__new"), F.col(ord).alias("__ord"))
    joined = marked.join(incoming, key, "full_outer")
    replace = F.col("__new").isNotNull() & ((F.col(ord) == F.col("__first")) | F.col(ord).isNull())
    values = [F.when(replace, F.col(f"__new.{c}")).otherwise(F.col(c)).alias(c) for c in pages.columns if c not in (key, ord)]
    return joined.select(F.col(key), F.coalesce(F.col(ord), F.col("__ord")).alias(ord), *values)


def recover(pages: DataFrame, retried: DataFrame, key: str = "source_url", ord: str | None = None) -> DataFrame:
    """Failed pages whose retry succeeded take the retry's fields: of several good retries those of the last by `ord`, or without it the greatest row."""
    row = F.struct(*[F.col(c) for c in retried.columns if c != key])
    shown = F.to_json(row)  # maps have no order
    good = retried.where(F.col("success")).groupBy(key).agg(F.max_by(row, F.struct(F.col(ord), shown) if ord else shown).alias("__new"))
    joined = pages.join(good, key, "left")
    swap = F.col("__new").isNotNull() & ~F.coalesce(F.col("success"), F.lit(False))
    fresh = {c for c in retried.columns if c != key}
    return joined.select(*[F.when(swap, F.col(f"__new.{c}")).otherwise(F.col(c)).alias(c) if c in fresh else F.col(c) for c in pages.columns])


def removal_reason(url: Column, status_code: Column, rules: CrawlRules) -> Column:
    """`404`, `blocklist` or NULL. The basename is taken from the path without its trailing slash, unlike in crawling."""
    urls, paths, names = blocklists(rules)
    where = F.regexp_replace(F.lower(path(F.trim(url), params=False)), "/+$", "")
    listed = lambda x, values: x.isin(*values) if values else F.lit(False)
    blocked = F.coalesce(listed(normalize_url(url), urls), F.lit(False)) | ((where != "") & listed(where, paths)) | listed(F.substring_index(where, "/", -1), names)
    return F.when(F.coalesce(status_code == 404, F.lit(False)), "404").when(blocked, "blocklist")


def filter_pages(pages: DataFrame, rules: CrawlRules, url: str = "source_url", status: str = "status_code") -> DataFrame:
    return pages.where(removal_reason(F.col(url), F.col(status), rules).isNull())


def filter_counts(pages: DataFrame, rules: CrawlRules, url: str = "source_url", status: str = "status_code") -> DataFrame:
    reason = removal_reason(F.col(url), F.col(status), rules)
    return pages.select(reason.alias("r")).agg(F.count_if(F.col("r") == "404").alias("removed_404"), F.count_if(F.col("r") == "blocklist").alias("removed_blocklist"), F.count_if(F.col("r").isNull()).alias("kept_pages"), F.count("*").alias("input_pages"))


def skip_reasons(pages: DataFrame, rules: CrawlRules, top: int = 10, url: str = "source_url", status: str = "status_code") -> DataFrame:
    counted = pages.select(admission_reason(F.col(url), F.col(status), rules).alias("reason")).where("reason <> 'ok'").groupBy("reason").agg(F.count("*").alias("n"))
    return counted.orderBy(F.desc("n"), "reason").limit(top)


def failure_buckets(pages: DataFrame, error: str = "error", success: str = "success") -> DataFrame:
    return pages.where(~F.coalesce(F.col(success), F.lit(False))).groupBy(failure_bucket(F.col(error)).alias("bucket")).agg(F.count("*").alias("n"))


def crawl_summary(pages: DataFrame, rules: CrawlRules, url: str = "source_url", kept: DataFrame | None = None, retries: DataFrame | None = None, listed: int = 1000) -> DataFrame:
    """One row about the visited pages; with `kept`, the pages after dedupe, also duplicates_removed, and with `retries`(url, attempts, recovered, candidate) the retry counts.

    non_internal is the sorted list of at most `listed` URLs outside the host, of which non_internal_urls counts all.
    """
    internal = domain(F.col(url)) == rules.host
    one = pages.agg(
        F.count("*").alias("saved_pages"),
        F.count_if(~F.coalesce(F.col("success"), F.lit(False))).alias("failed_pages"),
        F.coalesce(F.max("depth"), F.lit(0)).alias("max_observed_depth"),
        F.coalesce(F.bool_and(internal), F.lit(True)).alias("all_results_internal"),
        F.count_if(~internal).alias("non_internal_urls"),
    )
    if kept is None:
        return one
    outside = pages.where(~internal).select(F.col(url).alias("u")).distinct().orderBy("u").limit(listed).agg(F.sort_array(F.collect_list("u")).alias("non_internal"))
    after = kept.agg(F.count("*").alias("kept_pages"), F.count_if(~F.coalesce(F.col("success"), F.lit(False))).alias("failed_kept"))
    both = one.join(F.broadcast(after)).join(F.broadcast(outside))
    out = both.withColumn("duplicates_removed", F.col("saved_pages") - F.col("kept_pages")).withColumn("visited_results", F.col("saved_pages")).withColumn("saved_pages", F.col("kept_pages")).withColumn("failed_pages", F.col("failed_kept")).drop("kept_pages", "failed_kept")
    if retries is None:
        return out
    counts = retries.agg(F.count_if("candidate").alias("retry_candidates"), F.coalesce(F.sum("attempts"), F.lit(0)).alias("retry_attempted"), F.count_if("recovered").alias("retry_recovered"))
    return out.join(F.broadcast(counts)).withColumn("retry_failed", F.col("retry_attempted") - F.col("retry_recovered"))


def capped(rows: DataFrame, most: int | None, *order: str) -> DataFrame:
    """The first `most` rows in an order, which is a stated limit of a crawl, a listing or an enrichment; None and 0 mean all."""
    return rows.orderBy(*order).limit(most) if most and most > 0 else rows
