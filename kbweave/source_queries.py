"""Registered queries of readers and writers: rows of the tables go out in a format and come back through its reader. Each comes with its DuckDB statement.

What is written lies under a path that the input's stamp names and is written anew by each run, so that no run leaves more behind than the last.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kbweave.functions import text
from kbweave.operators import cdc
from kbweave.queries import query, table
from kbweave.sources import readers, storage, writers


def place(spark: SparkSession, d: str, source: str, name: str) -> str:
    made = storage.stamp(spark, f"{d.rstrip('/')}/{source}.parquet")
    return f"{storage.shared_dir(spark)}/kbweave/io-{name}-{made}"


@query("SELECT doc_id, lang || ' ' || source AS embedding_text, (doc_id % 97)::FLOAT AS first, 2 AS n FROM documents")
def q_read_jsonl(spark: SparkSession, d: str) -> DataFrame:
    path = place(spark, d, "documents", "jsonl")
    rows = table(spark, d, "documents").select(F.concat_ws(" ", "lang", "source").alias("embedding_text"), F.to_json(F.array(F.col("doc_id") % 97, F.lit(1))).alias("embedding"), F.to_json(F.struct("doc_id", "source")).alias("metadata"))
    writers.write_jsonl(rows, path)
    back = readers.read_jsonl(spark, path)
    vector = readers.embedding_array(F.col("embedding"))
    return back.select(F.get_json_object("metadata", "$.doc_id").cast("long").alias("doc_id"), "embedding_text", F.get(vector, F.lit(0)).alias("first"), F.size(vector).alias("n"))


@query("SELECT url AS source_url, 'T' || page_id AS title, (page_id % 5)::INTEGER AS depth, page_id % 3 <> 0 AS success, '[\"a\",\"k' || page_id || '\"]' AS keywords FROM pages")
def q_read_page_json(spark: SparkSession, d: str) -> DataFrame:
    """Files of fifty wrapped records, each one JSON object."""
    path, n = place(spark, d, "pages", "page-json"), F.col("page_id")
    record = F.struct(F.concat(F.lit("T"), n.cast("string")).alias("title"), F.col("url").alias("source_url"), (n % 5).alias("depth"), (n % 3 != 0).alias("success"), F.array(F.lit("a"), F.concat(F.lit("k"), n.cast("string"))).alias("keywords"))
    files = table(spark, d, "pages").groupBy(F.floor(n / 50).alias("file")).agg(F.to_json(F.struct(F.collect_list(record).alias("pages"))).alias("value"))
    files.write.mode("overwrite").partitionBy("file").text(path)
    back = readers.read_page_json(spark, f"{path}/*/*.txt")
    return back.select("source_url", "title", "depth", "success", "keywords")


@query("SELECT doc_id, lang || ', \"' || source || '\"' || chr(10) || doc_id AS embedding_text, lang, 2 AS n FROM documents")
def q_read_csv(spark: SparkSession, d: str) -> DataFrame:
    """Quotes, commas and line feeds in a field; metadata folded from the other columns."""
    path, n = place(spark, d, "documents", "csv"), F.col("doc_id")
    rows = table(spark, d, "documents").select(F.concat("lang", F.lit(', "'), "source", F.lit('"\n'), n.cast("string")).alias("embedding_text"), F.to_json(F.array(n, F.lit(0.5))).alias("embedding"), "doc_id", "lang", F.lit("").alias("empty"))
    rows.write.mode("overwrite").option("header", True).option("escape", '"').csv(path)
    back = readers.read_embedding_csv(spark, path)
    at = lambda k: F.get_json_object("metadata", f"$.{k}")
    return back.select(at("doc_id").cast("long").alias("doc_id"), "embedding_text", at("lang").alias("lang"), F.size(F.from_json("metadata", "map<string,string>")).alias("n"))


@query("SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN 'no embedding' WHEN vec_id % 5 = 0 THEN 'embedding of 3 numbers' WHEN vec_id % 11 = 0 THEN 'metadata is no object' END AS reason FROM embeddings")
def q_split_valid(spark: SparkSession, d: str) -> DataFrame:
    n = F.col("vec_id")
    vector = F.when(n % 7 == 0, F.array().cast("array<float>")).when(n % 5 == 0, F.slice("embedding", 1, 3)).otherwise(F.col("embedding"))
    rows = table(spark, d, "embeddings").select("vec_id", vector.alias("embedding"), F.when(n % 11 == 0, "[1]").when(n % 2 == 0, '{"a": 1}').alias("metadata"))
    good, bad = readers.split_valid(rows, 64)
    return good.select("vec_id", F.lit(None).cast("string").alias("reason")).unionByName(bad.select("vec_id", "reason"))


@query("SELECT doc_id, lang, doc_id + 1 AS other FROM documents")
def q_embedded_json(spark: SparkSession, d: str) -> DataFrame:
    """The list that a page's script assigns."""
    listed = F.to_json(F.array(F.struct("doc_id", "lang", (F.col("doc_id") + 1).alias("other"))))
    page = F.concat(F.lit("<html><script>var a = {x: [1]}; window.items = "), listed, F.lit(";\nrun();</script>"))
    return table(spark, d, "documents").select(F.inline(readers.embedded_json(page, "window.items", "array<struct<doc_id: long, lang: string, other: long>>")))


@query("SELECT 'https://h.example/' || lang || '/' || doc_id AS url FROM documents WHERE lang = 'en'")
def q_sitemaps(spark: SparkSession, d: str) -> DataFrame:
    """Sitemaps of a hundred pages each below one index; the pages of one language are wanted."""
    docs = table(spark, d, "documents").select(F.floor(F.col("doc_id") / 100).alias("k"), F.concat(F.lit("https://h.example/"), "lang", F.lit("/"), F.col("doc_id").cast("string")).alias("loc"))
    entry = lambda u: F.concat(F.lit("<url><loc> "), u, F.lit("</loc></url>\n"))
    maps = docs.groupBy("k").agg(F.array_join(F.collect_list(entry(F.col("loc"))), "").alias("xml")).select(F.concat(F.lit("https://h.example/s"), F.col("k").cast("string"), F.lit(".xml")).alias("url"), "xml")
    root = maps.agg(F.array_join(F.collect_list(entry(F.col("url"))), "").alias("xml")).select(F.lit("https://h.example/sitemap.xml").alias("url"), "xml")
    return readers.traverse_sitemaps(maps.unionByName(root), ["https://h.example/sitemap.xml"], "https://h[.]example/en/", max_sitemaps=None)


@query("SELECT count(*) AS records, count(*) FILTER (doc_id % 9 = 0) AS deleted, count(*) AS hint, count(*) FILTER (doc_id % 9 = 0) AS deleted_hint, min(doc_id) FILTER (doc_id % 9 = 0) AS first_deleted FROM documents")
def q_bundle_round_trip(spark: SparkSession, d: str) -> DataFrame:
    path = place(spark, d, "documents", "bundle")
    rows = table(spark, d, "documents").select(F.col("doc_id").cast("string").alias("_id"), "lang")
    writers.export_bundle(rows, rows.where("_id % 9 = 0").unionByName(rows.where("_id % 9 = 0")), path, {"index": "a", "api_key": "never"})
    vectors, gone, manifest = writers.read_bundle(spark, path)
    counts = vectors.agg(F.count("*").alias("records")).join(F.broadcast(gone.agg(F.count("*").alias("deleted"), F.min(F.col("_id").cast("long")).alias("first_deleted"))))
    return counts.join(F.broadcast(manifest.select(F.col("record_count_hint").alias("hint"), F.col("deleted_doc_id_count").alias("deleted_hint"))))


@query("SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN 'raw ' || lang ELSE trim(text, ' ' || chr(10) || chr(9)) END AS markdown FROM documents")
def q_pick_markdown(spark: SparkSession, d: str) -> DataFrame:
    fit = F.when(F.col("doc_id") % 3 == 0, " \n\t").otherwise(F.concat(F.lit("\n"), "text"))
    return table(spark, d, "documents").select("doc_id", text.pick_markdown(fit, F.concat(F.lit(" raw "), "lang", F.lit("\n"))).alias("markdown"))


@query("SELECT max_by(o_orderkey, o_orderkey)::VARCHAR AS run_id FROM orders WHERE o_orderkey % 4 < 2 AND o_orderkey <> (SELECT max(o_orderkey) FROM orders WHERE o_orderkey % 4 < 2)")
def q_latest_run(spark: SparkSession, d: str) -> DataFrame:
    """The latest finished run but the newest one itself."""
    key = F.col("o_orderkey")
    status = F.when(key % 4 == 0, "COMPLETED").when(key % 4 == 1, "PARTIAL").when(key % 4 == 2, "FAILED").otherwise("RUNNING")
    runs = table(spark, d, "orders").select(key.cast("string").alias("run_id"), status.alias("run_status"), F.timestamp_seconds(key).alias("started_at"))
    own = runs.where("run_status IN ('COMPLETED', 'PARTIAL')").agg(F.max_by("run_id", "started_at").alias("r")).first()["r"]
    return cdc.latest_finished_run(runs, own)
