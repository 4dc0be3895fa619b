"""Corpus pipeline: language ID, near-dedup, benchmark decontamination, secret scan, packing.

Each stage takes (spark, docs, sf_dir) and works on all rows that its predecessor kept; every stage but the last returns the columns of
`documents`. Stage results are written as Parquet in the shared folder and read again, so that a lost executor costs one stage at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kbweave.llm import decontamination, language_crf, minhash, packing, secrets
from kbweave.llm.common import drop_materialized, materialize, table

#: Documents whose likeliest language has less of the words' posterior mass than this are rejected, as are those without any letter; texts that switch between two languages stay.
LEAST_LANGUAGE_SHARE = 0.35


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """docs without those whose language is not found or unsure. Null and empty texts and texts without a letter go; without any labelled row all documents go.

    Repeated rows are judged one by one, columns of any name pass through, an empty table stays empty.
    """
    model = language_crf.fit(docs.select("doc_id", "text", "lang"), F.lit(True))
    found = language_crf.identify(docs, model, "text", "__language")
    sure = (F.col("__language.lang") != language_crf.UND) & (F.col("__language.score") >= LEAST_LANGUAGE_SHARE)
    return found.where(sure).select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near-duplicates, the one of the least id (null ids last); of repeated rows one. Null and empty texts are one class."""
    return minhash.keep_representatives(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """docs without the contaminated ones. Null and empty texts have no words and stay; an empty benchmark removes nothing; repeated rows share their verdict."""
    return decontamination.remove_documents(docs, table(spark, sf_dir, "benchmark"))


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows, with secrets replaced by markers and n_chars, where there is one, counted again. Null texts stay null, empty ones empty."""
    clean = secrets.scrub(docs)
    return clean.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else clean


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all rows in their sequences. A null or empty text is its end id alone; repeated rows are packed as often as they occur; no rows give no pieces."""
    return packing.pack(docs)


STAGES = [
    ("language_id", language_id),
    ("near_dedup", near_dedup),
    ("benchmark_decontamination", benchmark_decontamination),
    ("secret_scan", secret_scan),
    ("packing", pack),
]

#: SQL cannot express a trained model, signatures or a tokenizer; tests/llm holds the stages against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
        if before is not None:
            drop_materialized(before)
        before = docs
    return docs
