"""Sinks: JSONL, bulk action lines, bundles without credentials."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from kbweave.operators.batches import batched

SECRET_KEYS = ("password", "api_key", "token", "secret")


def write_jsonl(rows: DataFrame, path: str) -> None:
    rows.write.mode("overwrite").json(path)


def bulk_lines(actions: DataFrame, index_name: str, upsert: bool = False) -> DataFrame:
    """Action and source lines of a bulk request, as one string per action; actions(op, _id, source struct). An action without op or id fails the query."""
    head = F.to_json(F.map_from_arrays(F.array("op"), F.array(F.struct(F.lit(index_name).alias("_index"), F.col("_id").cast("string").alias("_id")))))
    body = F.when(F.col("op") == "index", F.to_json("source")).when(F.col("op") == "update", F.to_json(F.struct(F.col("source").alias("doc"), F.lit(upsert).alias("doc_as_upsert"))))
    broken = (F.trim(F.coalesce("op", F.lit(""))) == "") | (F.trim(F.coalesce(F.col("_id").cast("string"), F.lit(""))) == "")
    checked = F.when(broken, F.raise_error(F.lit("an action needs op and _id")).cast("string")).otherwise(F.concat_ws("\n", head, body))
    return actions.select("op", "_id", checked.alias("value"))


def bulk_requests(actions: DataFrame, index_name: str, keep: Callable[[DataFrame], DataFrame], size: int = 200, upsert: bool = False) -> DataFrame:
    """(batch, body): bulk requests of `size` actions in the order of op and id, each ending in a line feed."""
    lines = batched(bulk_lines(actions, index_name, upsert), ["op", "_id"], size, keep)
    return lines.groupBy("batch").agg(F.concat(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("op", "_id", "value"))), lambda x: x["value"]), "\n"), F.lit("\n")).alias("body"))


def replay(requests: DataFrame, send: Callable[[str], str]) -> DataFrame:
    """(batch, item): the responses of sending each request, one JSON action per row. `send` runs on the executors and returns the response's JSON."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            for number, body in zip(rows["batch"], rows["body"], strict=True):
                items = json.loads(send(body)).get("items")
                if not isinstance(items, list):
                    raise RuntimeError("a bulk response without items")
                yield pd.DataFrame({"batch": [number] * len(items), "item": [json.dumps(i) for i in items]})

    return requests.mapInPandas(run, "batch long, item string")


def unique_names(rows: DataFrame, name: str, order: list[str], suffix: str = ".md", out: str = "file_name") -> DataFrame:
    """rows with their file name: the first of equal names takes it as it is, the others get -2, -3 and so on, in order."""
    n = F.row_number().over(W.partitionBy(name).orderBy(*order))
    return rows.withColumn("__n", n).withColumn(out, F.concat(F.col(name), F.when(F.col("__n") > 1, F.concat(F.lit("-"), F.col("__n").cast("string"))).otherwise(""), F.lit(suffix))).drop("__n")


def write_crawl(spark, pages: DataFrame, summary: DataFrame, path: str, start_url: str, max_depth: int, max_pages: int) -> None:
    """A crawl's output: pages as JSON lines, and one JSON object with the start, the limits and the summary."""
    pages.write.mode("overwrite").json(f"{path}/pages")
    head = summary.select(F.lit(start_url).alias("start_url"), F.lit(max_depth).alias("max_depth"), F.lit(max_pages).alias("max_pages"), F.struct(*summary.columns).alias("summary"))
    head.coalesce(1).write.mode("overwrite").json(f"{path}/crawl")


def pretty_json(value: object) -> str:
    """One JSON document, indented by two, characters as they are."""
    return json.dumps(value, ensure_ascii=False, indent=2)


def append_snapshots(snapshots: DataFrame, path: str) -> None:
    snapshots.write.mode("append").partitionBy("run_id").parquet(path)


def export_bundle(records: DataFrame, deleted: DataFrame, path: str, settings: dict[str, object]) -> None:
    """vectors, sorted distinct deleted ids and a manifest with counts. Settings that name a credential are left out."""
    spark = records.sparkSession
    records.write.mode("overwrite").json(f"{path}/vectors")
    deleted.select("_id").distinct().orderBy("_id").write.mode("overwrite").text(f"{path}/deleted_doc_ids")
    shown = {k: str(v) for k, v in settings.items() if not any(s in k.lower() for s in SECRET_KEYS)}
    manifest = spark.createDataFrame([(1, records.count(), deleted.select("_id").distinct().count(), shown)], "schema_version int, record_count_hint long, deleted_doc_id_count long, settings map<string,string>")
    manifest.coalesce(1).write.mode("overwrite").json(f"{path}/manifest")


#: The files of a bundle where its manifest names no others.
BUNDLE_FILES = {"embeddings": "vectors", "deleted_doc_ids": "deleted_doc_ids"}


def read_bundle(spark, path: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(vectors, deleted ids, manifest); a manifest may name its files, else they have their usual names."""
    manifest = spark.read.json(f"{path}/manifest")
    named = manifest.select("files.*").first().asDict() if "files" in manifest.columns else {}
    at = lambda part: f"{path}/{named.get(part) or BUNDLE_FILES[part]}"
    return spark.read.json(at("embeddings")), spark.read.text(at("deleted_doc_ids")).where("trim(value) <> ''").select(F.trim("value").alias("_id")), manifest
