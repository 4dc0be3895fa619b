"""Enrichment of pages by generated metadata: join-back, apply, delta selection and the pluggable enricher."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kbweave.operators.pages import capped

#: What a record hands on to its page besides title, description and keywords.
CARRIED = ("card_name", "page_type", "page_purpose", "customer_blurb", "facet_tags", "key_facts", "page_index")


def last_record(records: DataFrame, key: str, ord: str = "ord") -> DataFrame:
    """The last record of each key wins."""
    return records.groupBy(key).agg(F.max_by(F.struct(*[F.col(c) for c in records.columns if c != key]), ord).alias("__r")).select(key, "__r.*")


def join_back(pages: DataFrame, records: DataFrame, key: str = "source_url") -> DataFrame:
    """Title, description and keywords from the record where it has them; all three are lower-cased in any case. Of the CARRIED fields the page takes
    those that the records have; pages without a record keep their own."""
    carried = [c for c in CARRIED if c in records.columns]
    found = last_record(records, key).select(key, F.col("ai_title").alias("__t"), F.col("ai_summary").alias("__d"), F.col("keywords").alias("__k"), F.lit(True).alias("__hit"), *[F.col(c).alias(f"__c_{c}") for c in carried])
    joined = pages.join(found, key, "left")
    chosen = {
        "title": F.lower(F.coalesce(F.nullif("__t", F.lit("")), "title")),
        "description": F.lower(F.coalesce(F.nullif("__d", F.lit("")), "description")),
        "keywords": F.lower(F.coalesce(F.array_join("__k", ", "), "keywords")),
    }
    for c in carried:
        chosen[c] = F.when(F.col("__hit"), F.col(f"__c_{c}")).otherwise(F.col(c)) if c in pages.columns else F.col(f"__c_{c}")
    return joined.select(*[chosen[c].alias(c) if c in chosen else F.col(c) for c in [*pages.columns, *[c for c in carried if c not in pages.columns]]])


def enrich_counts(pages: DataFrame, records: DataFrame, key: str = "source_url") -> DataFrame:
    """(pages, enriched, skipped): how many pages have a record, and how many have none."""
    hit = pages.join(records.select(key, F.lit(True).alias("__hit")).distinct(), key, "left")
    return hit.agg(F.count("*").alias("pages"), F.count_if("__hit").alias("enriched"), F.count_if(F.col("__hit").isNull()).alias("skipped"))


def content_body(title: Column, purpose: Column, description: Column, facts: Column) -> Column:
    """Title, purpose, description and bulleted facts, one paragraph each."""
    bullets = F.array_join(F.transform(F.filter(facts, lambda f: F.trim(f) != ""), lambda f: F.concat(F.lit("- "), F.trim(f))), "\n")
    parts = [F.trim(F.coalesce(p, F.lit(""))) for p in (title, purpose, description)] + [F.coalesce(bullets, F.lit(""))]
    return F.concat_ws("\n\n", *[F.when(p != "", p) for p in parts])


def apply_records(pages: DataFrame, records: DataFrame, key: str = "normalized_url") -> DataFrame:
    """As join_back by normalized URL, case kept, and with the `content` that replaces the markdown as source of chunks."""
    found = last_record(records, key).select(key, F.col("ai_title").alias("__t"), F.col("ai_summary").alias("__d"), F.col("page_purpose").alias("__p"), F.col("key_facts").alias("__f"), F.lit(True).alias("__hit"))
    joined = pages.join(found, key, "left")
    title = F.coalesce(F.nullif("__t", F.lit("")), "title")
    description = F.coalesce(F.nullif("__d", F.lit("")), "description")
    kept = [c for c in pages.columns if c not in ("title", "description")]
    return joined.select(*kept, title.alias("title"), description.alias("description"), F.when(F.col("__hit"), content_body(title, F.col("__p"), description, F.col("__f"))).alias("content"))


def changed_only(rows: DataFrame, changes: DataFrame, key: str = "normalized_url") -> DataFrame:
    """Rows of pages that are NEW or UPDATED. Placed before chunking and embedding, which then see the delta alone."""
    return rows.join(changes.where(F.col("change_status").isin("NEW", "UPDATED") & F.col("success")).select(key).distinct(), key, "left_semi")


def enrich(pages: DataFrame, enricher: Callable[[pd.DataFrame], pd.DataFrame], schema: str, most: int | None = None, order: str = "ord") -> DataFrame:
    """Batches of pages through a callable; rows it fails on are left out by returning fewer rows. With `most` only the first pages in order are enriched."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield enricher(batch)

    return capped(pages, most, order).mapInPandas(run, schema)


def first_sentence(batch: pd.DataFrame) -> pd.DataFrame:
    """The default enricher: deterministic, without a model. Expects source_url, title and markdown."""
    text = batch["markdown"].fillna("").str.strip()
    return pd.DataFrame({"source_url": batch["source_url"], "ai_title": batch["title"], "ai_summary": text.str.split(r"(?<=[.!?])\s", n=1, regex=True).str[0]})
