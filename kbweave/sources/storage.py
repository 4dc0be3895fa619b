"""The folder that driver and executors share, tables written there on the way, and stamps of inputs."""

from __future__ import annotations

import hashlib
import re
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

KINDS = {"string": T.StringType(), "long": T.LongType(), "boolean": T.BooleanType(), "timestamp": T.TimestampType()}


def struct(fields: str) -> T.StructType:
    """A schema from `name kind, ...`, which needs no session."""
    return T.StructType([T.StructField(part.split()[0], KINDS[part.split()[1]]) for part in fields.split(",")])


def shared_dir(spark: SparkSession) -> str:
    """`spark.checkpoint.dir` of the session; a folder of our own only where it is unset and all executors are in this process."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    import tempfile

    return f"file://{tempfile.gettempdir()}/kbweave-shared"


def materialize(df: DataFrame, label: str = "table") -> DataFrame:
    """Write df once and read it again: what several plans use is computed once, and a lost executor costs a reread."""
    path = f"{shared_dir(df.sparkSession)}/kbweave/{label}-{uuid.uuid4().hex}"
    df.write.mode("overwrite").option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def path_of(spark: SparkSession, path: str):
    """(file system, path) of Hadoop for any store that Spark reads."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def exists(spark: SparkSession, path: str) -> bool:
    fs, where = path_of(spark, path)
    return bool(fs.exists(where))


#: Changes with the form of the tables that stamps find again.
FORMAT = "7"


def stamp(spark: SparkSession, path: str) -> str:
    """A digest of the names, sizes and times of the files under a path, by which derived tables are found again, in later sessions too, while their input is the same."""
    fs, where = path_of(spark, path)
    files = fs.listStatus(where)
    seen = sorted((str(f.getPath()), f.getLen(), f.getModificationTime()) for f in files)
    return hashlib.sha256(repr((FORMAT, seen)).encode()).hexdigest()[:24]


def scratch(spark: SparkSession, label: str) -> str:
    """A new path in the shared folder."""
    return f"{shared_dir(spark)}/kbweave/{label}-{uuid.uuid4().hex}"


def delete(spark: SparkSession, path: str) -> None:
    fs, where = path_of(spark, path)
    fs.delete(where, True)


def drop(*tables: DataFrame) -> None:
    """Delete the files of tables written by materialize() once nothing reads them any more."""
    for df in tables:
        for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
            delete(df.sparkSession, folder)


def kept(result: DataFrame, *made: str) -> DataFrame:
    """A short result that comes to the driver, after which the tables that it was made from go."""
    out = result.sparkSession.createDataFrame(result.collect(), result.schema)
    for path in made:
        delete(result.sparkSession, path)
    return out
