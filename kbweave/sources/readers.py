"""Record readers with declared schemas. Order of input is kept as file name and position where it matters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

PAGE = T.StructType(
    [T.StructField(n, T.StringType()) for n in ("title", "description", "keywords", "category", "sub_category", "source_url", "path")]
    + [T.StructField("depth", T.IntegerType()), T.StructField("success", T.BooleanType()), T.StructField("status_code", T.IntegerType())]
    + [T.StructField(n, T.StringType()) for n in ("redirected_url", "error", "metadata", "markdown", "content")]
)
RECORD = T.StructType([T.StructField("embedding_text", T.StringType()), T.StructField("embedding", T.StringType()), T.StructField("metadata", T.StringType())])


def _documents(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Whole files as (file, v): JSON that may be an object, a list or a wrapper is parsed once and kept open as VARIANT."""
    files = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("file"), F.parse_json("value").alias("v"))
    return files


def read_page_json(spark: SparkSession, path: str | list[str], wrapper: str = "pages", schema: T.StructType = PAGE) -> DataFrame:
    """Records of files that hold `{wrapper: [..]}`, a list or a single object; elements that are no objects are dropped.

    Adds file and ord. Fields of another type become strings (arrays and objects as JSON).
    """
    docs = _documents(spark, path)
    wrapped = F.try_variant_get("v", f"$.{wrapper}", "array<variant>")
    listed = F.try_variant_get("v", "$", "array<variant>")
    each = docs.select("file", F.posexplode(F.coalesce(wrapped, listed, F.array("v"))).alias("ord", "r"))
    objects = each.where(F.schema_of_variant("r").startswith("OBJECT"))
    return objects.select("file", "ord", *[F.try_variant_get("r", f"$.{f.name}", f.dataType.simpleString()).alias(f.name) for f in schema.fields])


def read_jsonl(spark: SparkSession, path: str | list[str], schema: T.StructType = RECORD, strict: bool = True, numbered: bool = False) -> DataFrame:
    """One object per line. Blank lines are skipped; broken JSON fails the query (`numbered`: with file and line); lines that are no objects fail it too, or are skipped if not strict."""
    if numbered:  # whole files, so that a broken line can be named; for loads of moderate files
        files = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("file"), F.posexplode(F.split("value", "\r\n|\r|\n")).alias("at", "value"))
        lines = files.where(F.trim("value") != "").select(F.try_parse_json("value").alias("r"), F.concat(F.lit("no JSON in line "), (F.col("at") + 1).cast("string"), F.lit(" of "), "file").alias("why"))
        lines = lines.where(F.col("r").isNotNull() | F.raise_error(F.col("why")).isNotNull())
    else:
        lines = spark.read.text(path).where(F.trim("value") != "").select(F.parse_json("value").alias("r"))
    kind = F.schema_of_variant("r").startswith("OBJECT")
    rows = lines.where(kind | F.raise_error(F.lit("a line holds no JSON object")).isNotNull()) if strict else lines.where(kind)
    return rows.select(*[F.try_variant_get("r", f"$.{f.name}", f.dataType.simpleString()).alias(f.name) for f in schema.fields])


def read_embedding_csv(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """embedding_text, embedding (JSON array) and metadata (JSON, or folded from the remaining non-empty columns)."""
    raw = spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(path)
    rest = [c for c in raw.columns if c not in ("embedding_text", "embedding", "metadata")]
    folded = F.map_filter(F.map_from_arrays(F.array(*[F.lit(c) for c in rest]), F.array(*[F.col(f"`{c}`") for c in rest])), lambda _, v: F.coalesce(v, F.lit("")) != "") if rest else F.create_map().cast("map<string,string>")
    column = lambda c: F.col(c) if c in raw.columns else F.lit(None).cast("string")
    return raw.select(F.coalesce(column("embedding_text"), F.lit("")).alias("embedding_text"), column("embedding").alias("embedding"), F.coalesce(F.nullif(column("metadata"), F.lit("")), F.to_json(folded)).alias("metadata"))


def embedding_array(embedding):
    """float array of a JSON array string; NULL or blank is the empty vector."""
    return F.coalesce(F.from_json(F.nullif(F.trim(embedding), F.lit("")), "array<float>"), F.array().cast("array<float>"))


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """embedding records of a folder or file of .jsonl, .json and .csv files, one union of readers."""
    jvm = spark._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    fs = where.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(where):
        raise FileNotFoundError(path)
    names = [path]
    if fs.getFileStatus(where).isDirectory():
        names, found = [], fs.listFiles(where, True)
        while found.hasNext():
            names.append(str(found.next().getPath()))
        names.sort()
    readers = {"jsonl": lambda p: read_jsonl(spark, p, strict=False), "json": lambda p: read_page_json(spark, p, "records", RECORD).drop("file", "ord"), "csv": lambda p: read_embedding_csv(spark, p)}
    parts = [read(found) for suffix, read in readers.items() if (found := [n for n in names if n.endswith(f".{suffix}")])]
    if not parts:
        return spark.createDataFrame([], RECORD)
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.withColumn("embedding", embedding_array(F.col("embedding")))


def split_valid(records: DataFrame, dims: int | None = None) -> tuple[DataFrame, DataFrame]:
    """(valid records, rejected ones with a reason): a record needs an embedding, of `dims` numbers if given, and metadata that is a JSON object or absent."""
    metadata = F.try_parse_json("metadata")
    wrong = F.when(F.size("embedding") <= 0, "no embedding")
    if dims is not None:
        wrong = wrong.when(F.size("embedding") != dims, F.concat(F.lit("embedding of "), F.size("embedding").cast("string"), F.lit(" numbers")))
    wrong = wrong.when(F.col("metadata").isNotNull() & ~F.coalesce(F.schema_of_variant(metadata).startswith("OBJECT"), F.lit(False)), "metadata is no object")
    judged = records.withColumn("reason", wrong)
    return judged.where("reason IS NULL").drop("reason"), judged.where("reason IS NOT NULL")


def first_table(spark: SparkSession, *paths: str) -> DataFrame | None:
    """The JSON lines of the first path that exists: a file of records generated before stands in for a live service."""
    from kbweave.sources.storage import exists

    return next((spark.read.json(p) for p in paths if p and exists(spark, p)), None)


def embedded_json(html, name: str, schema: str):
    """The array assigned to a script variable, `name = {...};` or `name = [...];`."""
    return F.from_json(F.regexp_extract(html, rf"(?s){name}\s*=\s*([\[{{].*?[\]}}])\s*;", 1), schema)


def sitemap_links(xml):
    return F.transform(F.regexp_extract_all(xml, F.lit(r"(?is)<loc>\s*(.*?)\s*</loc>"), F.lit(1)), lambda u: F.replace(u, F.lit("&amp;"), F.lit("&")))


def traverse_sitemaps(documents: DataFrame, roots: list[str], wanted: str, max_sitemaps: int | None = 50) -> DataFrame:
    """URLs under the root sitemaps that match `wanted` (anchored at the start). documents(url, xml) holds what a fetch would return.

    Breadth first: each round reads the sitemaps that the last one named and that were not read before, in order of their URLs, until there are none or
    `max_sitemaps` have been read, the limit of a polite crawl; None reads all.
    """
    from kbweave.sources.storage import materialize

    spark = documents.sparkSession
    links = documents.select("url", F.explode(sitemap_links(F.col("xml"))).alias("link"))
    frontier = spark.createDataFrame([(r,) for r in roots], "url string")
    seen, found, read = frontier, None, 0
    while True:
        if max_sitemaps is not None:
            frontier = frontier.orderBy("url").limit(max_sitemaps - read)
        frontier = materialize(frontier, "sitemaps")
        read += frontier.count()
        named = materialize(links.join(frontier, "url").select("link").distinct(), "sitemap-links")  # each round is computed once
        part = named.where(F.col("link").rlike(f"^(?:{wanted})"))
        found = part if found is None else found.unionByName(part)
        frontier = named.where(F.col("link").rlike(r"\.xml(\?.*)?$")).select(F.col("link").alias("url")).join(seen, "url", "left_anti")
        if frontier.isEmpty() or (max_sitemaps is not None and read >= max_sitemaps):
            break
        seen = seen.unionByName(frontier)
    return found.distinct().select(F.col("link").alias("url"))
