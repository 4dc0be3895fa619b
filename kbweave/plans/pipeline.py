"""A build run as one plan per stage: filter, change detection, enrichment, chunks of changed pages, vectors, index delta, outcome."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kbweave.functions.text import content_hash, split_keywords
from kbweave.functions.urls import CrawlRules, doc_id, normalize_url
from kbweave.operators import cdc, chunking, enrich
from kbweave.operators.pages import dedupe_best_by_aggregate, filter_pages


@dataclass(frozen=True)
class RunOptions:
    run_id: str = "run"
    chunk_size: int = chunking.CHUNK_SIZE
    chunk_overlap: int = chunking.CHUNK_OVERLAP
    dims: int = 384
    strict_partial_crawl: bool = False
    rules: CrawlRules = CrawlRules()

    def __post_init__(self) -> None:
        if self.chunk_size < 1 or self.chunk_overlap < 0:
            raise ValueError("chunk_size must be positive and chunk_overlap not negative")


def hashed_model(dims: int) -> Callable[[list[str]], list[list[float]]]:
    """Unit vectors of hashed words: the offline stand-in for a sentence model, deterministic and without files."""
    import re
    import zlib

    def encode(texts: list[str]) -> list[list[float]]:
        out = []
        for text in texts:
            sums = [0.0] * dims
            for word in re.findall("[a-z0-9]+", text.lower()):
                code = zlib.crc32(word.encode())
                sums[code % dims] += 1 if code >> 31 else -1
            size = sum(x * x for x in sums) ** 0.5
            out.append([x / size for x in sums] if size else sums)
        return out

    return encode


def embed(records: DataFrame, model: Callable[[int], Callable[[list[str]], list[list[float]]]] = hashed_model, dims: int = 384, text: str = "embedding_text", batch: int = 32) -> DataFrame:
    """records with a text, plus `embedding`. The model is made once per task and gets `batch` texts at a time; a task without rows makes none."""
    schema = T.StructType([*records.schema.fields, T.StructField("embedding", T.ArrayType(T.FloatType()))])
    at = records.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = None
        for rows in batches:
            if rows.num_rows:
                encode = encode or model(dims)
                texts = rows.column(at).to_pylist()
                vectors = [v for s in range(0, len(texts), batch) for v in encode(texts[s : s + batch])]
                yield pa.RecordBatch.from_arrays([*rows.columns, pa.array(vectors, pa.list_(pa.float32()))], [*rows.schema.names, "embedding"])

    return records.where(F.coalesce(F.col(text), F.lit("")) != "").mapInArrow(run, schema)


def first_model(*models: Callable[[int], Callable[[list[str]], list[list[float]]]]) -> Callable[[int], Callable[[list[str]], list[list[float]]]]:
    """The first model that can be made, so that a service that does not answer is replaced by the next one; made on the executor, for the first row only."""

    def make(dims: int) -> Callable[[list[str]], list[list[float]]]:
        problems = []
        for model in models:
            try:
                return model(dims)
            except Exception as e:
                problems.append(f"{type(e).__name__}: {e}")
        raise RuntimeError("no embedding model: " + "; ".join(problems))

    return make


def ingest(pages: DataFrame, snapshots: DataFrame, options: RunOptions = RunOptions(), model: Callable[[int], Callable[[list[str]], list[list[float]]]] = hashed_model, records: DataFrame | None = None, trusted_urls: bool = False, composed: bool = False) -> dict[str, DataFrame]:
    """pages(source_url, title, description, keywords, markdown, success, status_code, ord) -> changes, chunks (with vectors).

    `trusted_urls` promises URLs without escapes, `composed` bodies in composed form (NFC); each leaves out a Python step.
    """
    kept = filter_pages(pages, options.rules)
    keyed = kept.withColumn("normalized_url", normalize_url(F.col("source_url"), clean=trusted_urls))
    best = dedupe_best_by_aggregate(keyed.withColumn("__ord", F.col("ord")), "normalized_url", ord="__ord").drop("place", "__ord")
    hashed = best.withColumn("content_hash", content_hash(F.col("markdown"), composed))
    changes = cdc.classify_changes(hashed, snapshots)
    # the delta is taken before anything expensive: enrichment, chunking and embedding see changed pages only
    delta = changes.where(F.col("change_status").isin("NEW", "UPDATED") & F.col("success"))
    body = F.col("markdown")
    if records is not None:
        delta = enrich.apply_records(delta, records)
        body = F.coalesce("content", "markdown")
    chunks = chunking.explode_chunks(delta.withColumn("__body", body), "__body", "normalized_url", options.chunk_size, options.chunk_overlap).drop("__body")
    text = chunking.embedding_text(F.col("title"), F.col("description"), split_keywords(F.col("keywords")), F.col("source_url"), F.col("chunk"))
    vectors = embed(chunks.withColumn("embedding_text", text), model, options.dims)
    return {"changes": changes, "chunks": vectors.withColumn("_id", F.col("doc_id")).withColumn("page_id", doc_id(F.col("normalized_url")))}


def run_status(error: Column, indexing_errors: Column, failed_urls: Column, strict: Column) -> Column:
    return F.when(F.trim(F.coalesce(error, F.lit(""))) != "", "FAILED").when((indexing_errors > 0) | (strict & (failed_urls > 0)), "PARTIAL").otherwise("COMPLETED")


def finish(stage: Callable[[], DataFrame], record: Callable[[str, str], None], name: str) -> DataFrame | None:
    """Run a stage; a failure is recorded and the caller goes on to finalize the run."""
    try:
        return stage()
    except Exception as e:
        record(name, f"{type(e).__name__}: {e}")
        return None
