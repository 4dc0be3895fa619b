"""Stored tables by buckets of a key: readers and writers of some keys touch the folders of their buckets only.

Rows lie in data/<write>/bucket=<n>; a numbered manifest says which folders make up each bucket and which run wrote them. A write puts its folders down first and the manifest last, so that a failure in between leaves
the old rows, readers of the old version keep reading it, and a run that has been written already is known by its id. One writer at a time.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kbweave.sources import storage


@dataclass(frozen=True)
class BucketedTable:
    spark: SparkSession
    path: str
    key: str
    buckets: int
    schema: T.StructType
    version: int
    folders: tuple[tuple[int, str], ...] = ()  # (bucket, write), several writes of a bucket from the oldest on
    runs: frozenset[str] = field(default_factory=frozenset)

    def bucket(self, key: Column | None = None) -> Column:
        return F.pmod(F.crc32((F.col(self.key) if key is None else key).cast("binary")), F.lit(self.buckets)).cast("int")

    def touched(self, *rows: DataFrame) -> list[int]:
        """The buckets of some rows' keys; at most as many as the table has."""
        found: set[int] = set()
        for r in rows:
            found |= {x[0] for x in r.where(F.col(self.key).isNotNull()).select(self.bucket()).distinct().collect()}
        return sorted(found)

    def files(self, buckets: list[int] | None = None) -> list[str]:
        wanted = None if buckets is None else set(buckets)
        return [f"{self.path}/data/{write}/bucket={b}" for b, write in self.folders if wanted is None or b in wanted]

    def read(self, buckets: list[int] | None = None) -> DataFrame:
        """The rows of some buckets, or all; only their folders are listed and read."""
        paths = self.files(buckets)
        return self.spark.read.schema(self.schema).parquet(*paths) if paths else self.spark.createDataFrame([], self.schema)

    def _written(self, rows: DataFrame) -> tuple[str, list[int]]:
        write = uuid.uuid4().hex
        placed = rows.select(*[F.col(f"`{f.name}`").cast(f.dataType) for f in self.schema], self.bucket().alias("bucket"))
        placed.repartitionByRange("bucket", self.key).sortWithinPartitions("bucket", self.key).write.partitionBy("bucket").parquet(f"{self.path}/data/{write}")
        fs, where = storage.path_of(self.spark, f"{self.path}/data/{write}")
        names = [str(f.getPath().getName()) for f in fs.listStatus(where)]
        return write, sorted(int(n.split("=")[1]) for n in names if n.startswith("bucket="))

    def _commit(self, folders: list[tuple[int, str]], run: str | None) -> BucketedTable:
        rows = [(b, w, run, self.key, self.buckets, self.schema.json()) for b, w in folders] or [(-1, "", run, self.key, self.buckets, self.schema.json())]
        made = self.spark.createDataFrame(rows, "bucket int, write string, run string, key string, buckets int, schema string")
        made.coalesce(1).write.mode("error").parquet(f"{self.path}/manifest/v={self.version + 1:09d}")
        return BucketedTable(self.spark, self.path, self.key, self.buckets, self.schema, self.version + 1, tuple(folders), self.runs | ({run} if run else set()))

    def append(self, rows: DataFrame, run: str | None = None) -> BucketedTable:
        """The table with more rows; a run that is in already changes nothing."""
        if run in self.runs:
            return self
        write, buckets = self._written(rows)
        return self._commit([*self.folders, *[(b, write) for b in buckets]], run)

    def replace(self, rows: DataFrame, buckets: list[int], run: str | None = None) -> BucketedTable:
        """The table with the rows of some buckets replaced by others, which must be of these buckets; a run that is in already changes nothing."""
        if run in self.runs:
            return self
        write, made = self._written(rows)
        lost = set(buckets)
        if not set(made) <= lost:
            raise ValueError("rows of buckets that are not replaced")
        return self._commit(sorted([f for f in self.folders if f[0] not in lost] + [(b, write) for b in made]), run)


def create_table(spark: SparkSession, path: str, key: str, schema: T.StructType, buckets: int = 256) -> BucketedTable:
    """An empty table; fails where there is one."""
    return BucketedTable(spark, path, key, buckets, schema, 0)._commit([], None)


def open_table(spark: SparkSession, path: str) -> BucketedTable | None:
    """The newest complete version, None without one."""
    if not storage.exists(spark, f"{path}/manifest"):
        return None
    fs, where = storage.path_of(spark, f"{path}/manifest")
    names = sorted((str(f.getPath().getName()) for f in fs.listStatus(where)), reverse=True)
    done = [n for n in names if n.startswith("v=") and storage.exists(spark, f"{path}/manifest/{n}/_SUCCESS")]
    if not done:
        return None
    rows = spark.read.parquet(f"{path}/manifest/{done[0]}").collect()
    runs = {r["run"] for r in spark.read.parquet(*[f"{path}/manifest/{n}" for n in done]).select("run").distinct().collect() if r["run"]}
    one = rows[0]
    return BucketedTable(spark, path, one["key"], one["buckets"], T.StructType.fromJson(json.loads(one["schema"])), int(done[0][2:]), tuple((r["bucket"], r["write"]) for r in rows if r["bucket"] >= 0), frozenset(runs))


def vacuum(table: BucketedTable) -> int:
    """Delete the folders that the newest version does not name, once no reader holds an older one; returns how many."""
    fs, where = storage.path_of(table.spark, f"{table.path}/data")
    held = set(table.files())
    lost = 0
    for write in [str(f.getPath().getName()) for f in fs.listStatus(where)] if fs.exists(where) else []:
        at = f"{table.path}/data/{write}"
        for name in [str(f.getPath().getName()) for f in fs.listStatus(storage.path_of(table.spark, at)[1])]:
            if name.startswith("bucket=") and f"{at}/{name}" not in held:
                storage.delete(table.spark, f"{at}/{name}")
                lost += 1
    return lost
