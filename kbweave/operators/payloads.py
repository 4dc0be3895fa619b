"""Payload records of pages and chunks: text to embed, and metadata of fixed keys with admitted extras.

A record is one VARIANT column, since extras may have any name and type; fixed keys come first, and a key is never set twice.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kbweave.functions.text import collapse, content_hash, empty_if_null, join_present, let, prefix_keywords, prefix_text, split_keywords
from kbweave.functions.urls import is_login_redirect, last_path_param, path_text, record_path

#: Keys that never become metadata, and prefixes of such keys.
SKIPPED_KEYS = ("embedding_text", "markdown", "html", "content", "body", "raw_html")
SKIPPED_PREFIXES = ("request_", "response_")
LONGEST_TEXT, LONGEST_JSON = 500, 2000


def enriched_fields(title: Column, description: Column, keywords: Column, path: Column, source_url: Column, redirected_url: Column) -> Column:
    """struct<title, description, keywords, path>; pages that were sent to a login take the last words of their own path in front."""
    where = record_path(path, source_url)
    word = F.when(is_login_redirect(redirected_url), last_path_param(where)).otherwise("")
    fields = [prefix_text(collapse(x), word).alias(n) for x, n in ((title, "title"), (description, "description"))]
    return F.struct(*fields, prefix_keywords(split_keywords(keywords), word).alias("keywords"), where.alias("path"))


def is_admitted(key: Column, value: Column) -> Column:
    """Whether an extra field becomes metadata: by name, and by length for texts (white space collapsed) and nested values (as JSON)."""
    named = ~key.isin(*SKIPPED_KEYS)
    for prefix in SKIPPED_PREFIXES:
        named = named & ~F.startswith(key, F.lit(prefix))

    def text_fits(said: Column) -> Column:
        return (F.length(said) <= LONGEST_TEXT) | (F.length(collapse(said)) <= LONGEST_TEXT)

    def json_fits(json: Column) -> Column:
        """Measured with a blank behind each colon and comma outside of strings."""
        blanks = F.regexp_count(F.regexp_replace(json, '"(?:[^"\\\\]|\\\\.)*"', ""), F.lit("[:,]"))
        return F.when(F.length(json) > LONGEST_JSON, False).otherwise(F.length(json) + blanks <= LONGEST_JSON)

    def of_kind(kind: Column) -> Column:
        nested = kind.startswith("OBJECT") | kind.startswith("ARRAY")
        return F.when(kind == "STRING", let(F.try_variant_get(value, "$", "string"), text_fits)).when(nested, let(F.to_json(value), json_fits)).otherwise(True)

    return named & F.when(F.is_variant_null(value), True).otherwise(let(F.schema_of_variant(value), of_kind))


def extras(record: Column, fixed: list[str]) -> Column:
    """The admitted extra fields of a record (VARIANT) as a map from name to JSON, without those whose names are among `fixed`; in the order of names, in which a VARIANT keeps its fields."""
    fields = F.map_entries(record.cast("map<string,variant>"))
    kept = F.filter(fields, lambda e: ~e["key"].isin(*fixed) & is_admitted(e["key"], e["value"]))
    return F.map_from_entries(F.transform(kept, lambda e: F.struct(e["key"].alias("key"), F.to_json(e["value"]).alias("value"))))


FIXED_KEYS = ["title", "description", "keywords", "path", "source_url", "parsed_url_path_text"]


def page_payloads(records: DataFrame, key: str = "ord", column: str = "record") -> DataFrame:
    """(key, embedding_text, metadata struct, extra map of JSON) of the successful pages among records(key, column VARIANT) that have any text."""
    get = lambda n: F.try_variant_get(column, f"$.{n}", "string")
    good = records.where(F.try_variant_get(column, "$.success", "boolean"))
    fields = enriched_fields(get("title"), get("description"), get("keywords"), get("path"), get("source_url"), get("redirected_url"))
    shown = good.select(key, F.col(column), fields.alias("f"), get("source_url").alias("source_url"))
    words = path_text(F.col("f.path"))
    text = join_present("\n", F.col("f.title"), F.col("f.description"), F.array_join("f.keywords", " "), words)
    metadata = F.struct("f.title", "f.description", "f.keywords", "f.path", F.col("source_url"), F.nullif(words, F.lit("")).alias("parsed_url_path_text"))
    base = shown.select(key, F.col(column), text.alias("embedding_text"), metadata.alias("metadata")).where("embedding_text <> ''")
    return base.select(key, "embedding_text", "metadata", extras(F.col(column), FIXED_KEYS).alias("extra"))


def chunk_metadata(metadata: Column, normalized_url: Column, parent_doc_id: Column, chunk_index: Column, chunk_count: Column, chunk: Column) -> Column:
    """The page's metadata with the chunk's own keys; doc_id is the chunk's."""
    digest = content_hash(chunk)
    ident = F.sha2(F.concat_ws(":", parent_doc_id, chunk_index.cast("string"), digest), 256)
    own = [normalized_url.alias("normalized_url"), parent_doc_id.alias("parent_doc_id"), chunk_index.alias("chunk_index"), chunk_count.alias("chunk_count"), digest.alias("chunk_hash"), ident.alias("doc_id")]
    return F.struct(*[metadata[n].alias(n) for n in FIXED_KEYS], *own)


def stamp_changes(payloads: DataFrame, changes: DataFrame, key: str = "normalized_url") -> DataFrame:
    """payloads(key, doc_id, ...) of changed pages with content_hash, change_status and is_active; a chunk's own doc_id stays, others take the page's."""
    new = changes.where(F.col("success") & F.col("change_status").isin("NEW", "UPDATED")).select(key, "content_hash", "change_status").withColumn("page_id", F.sha2(key, 256))
    joined = payloads.drop("content_hash", "change_status", "is_active").join(new, key)
    return joined.withColumn("doc_id", F.coalesce(F.nullif(empty_if_null(F.col("doc_id")), F.lit("")), "page_id")).drop("page_id").withColumn("is_active", F.lit(True))
