"""Shared plumbing of the training-data operators: Arrow row mapping, shared storage, table access."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Rows and bytes of one Arrow batch handed to a Python worker; together they bound a worker's memory by a few long texts.
BATCH_ROWS = 512
BATCH_BYTES = 16 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def bounded_batches(spark: SparkSession, rows: int = BATCH_ROWS) -> None:
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share, as the session names it; one of our own only where it names none and all executors are in this process."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    import tempfile

    return f"file://{tempfile.gettempdir()}/kbweave-shared"


def materialize(df: DataFrame, label: str = "step") -> DataFrame:
    """Cut the lineage with a written table in the shared folder, so that a lost executor costs a reread and not a recomputation."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/kbweave/{label}-{uuid.uuid4().hex}"
    df.write.mode("overwrite").option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def drop_materialized(df: DataFrame) -> None:
    """Delete the files of a table written by materialize() once nothing reads it any more."""
    spark = df.sparkSession
    hadoop = spark._jsc.hadoopConfiguration()
    for name in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        path = spark._jvm.org.apache.hadoop.fs.Path(name)
        path.getFileSystem(hadoop).delete(path, True)


def with_struct(
    docs: DataFrame,
    make: Callable[[], Callable[[pa.Array], list[pa.Array]]],
    fields: list[T.StructField],
    out: str,
    column: str = "text",
    rows: int = BATCH_ROWS,
) -> DataFrame:
    """docs plus one struct column `out`, computed batch by batch from `column`.

    `make` runs once per task and returns the function from a text array to the struct's child arrays. A column of docs that is
    already called `out` is replaced; every other column passes through unread, whatever its name.
    """
    bounded_batches(docs.sparkSession, rows)
    kept = docs.select(*[F.col(f"`{c}`") for c in docs.columns if c.lower() != out.lower()])
    schema = T.StructType([*kept.schema.fields, T.StructField(out, T.StructType(fields), False)])
    at = [c.lower() for c in kept.columns].index(column.lower())
    names = [f.name for f in fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = make()
        for batch in batches:
            if batch.num_rows:
                made = pa.StructArray.from_arrays(work(batch.column(at)), names)
                yield pa.RecordBatch.from_arrays([*batch.columns, made], [*batch.schema.names, out])

    return kept.mapInArrow(run, schema)


def held_out(column: str, modulus: int, remainder: int):
    """crc32 of the id's decimal text decides; a null id is never held out."""
    return F.coalesce(F.crc32(F.col(column).cast("string")) % modulus == remainder, F.lit(False))


def salted_join(left: DataFrame, right: DataFrame, keys: list[str], counts: DataFrame, per_salt: int) -> DataFrame:
    """left joined with right on keys, where a key of many rows of left is dealt out over salts.

    `counts`(keys, many) says how many rows of left have a key. Only keys with more than `per_salt` rows are salted, which are at most all rows / per_salt, so that their list travels by broadcast.
    """
    hot = F.broadcast(counts.where(F.col("many") > per_salt).select(*keys, (F.col("many") / per_salt).cast("int").alias("__salts")))
    last = F.coalesce("__salts", F.lit(0))
    dealt = left.join(hot, keys, "left").withColumn("__salt", F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in left.columns if c not in keys]), last + 1).cast("int")).drop("__salts")
    copied = right.join(hot, keys, "left").withColumn("__salt", F.explode(F.sequence(F.lit(0), last))).drop("__salts")
    return dealt.join(copied, [*keys, "__salt"]).drop("__salt")
