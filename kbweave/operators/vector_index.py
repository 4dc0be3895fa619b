"""An inverted-file index of vectors: coarse centroids, one list of rows per centroid, exact scores within the lists that a search reads.

Centroids come from a bounded sample by spherical k-means on the driver; every row is put on the list of its nearest centroid. Lists are folders, so that a search reads the files of the lists it probes and no others; rows are
placed by ranges of (list, id), so that a list of a third of all rows is many files. A list's radius is the largest angle between its centroid and its rows, which bounds the score that any of its rows can
reach: `nearest` probes the nearest lists until the candidate rule is met, and with `exact` goes on to the lists whose bound still reaches the k-th score.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kbweave.sources import storage

#: Rows that k-means sees at most; a documented bound of the fit, not of the index.
SAMPLE = 50_000
ROUNDS = 12
#: The share of the ten nearest that the probed lists of the sample's queries must hold, and how many queries are tried.
TARGET, TRIED = 0.95, 256


@dataclass(frozen=True)
class VectorIndex:
    """rows(list, id, embedding of length one, payload columns) by folders of `list`; centroids, sizes and radii (angles) of the lists; and how many lists hold TARGET of the nearest neighbours."""

    rows: DataFrame
    centroids: np.ndarray
    sizes: np.ndarray
    radii: np.ndarray
    probes: int = 1
    payload: tuple[str, ...] = ()


def unit(matrix: np.ndarray) -> np.ndarray:
    return matrix / np.maximum(np.sqrt((matrix**2).sum(axis=1, keepdims=True)), 1e-300)


def as_matrix(column: pa.Array, dims: int | None = None) -> np.ndarray:
    """Rows of a list column as doubles, without a Python object per number. Vectors of another length than the others fail."""
    if not len(column):
        return np.zeros((0, dims or 0))
    flat = np.asarray(column.flatten().cast(pa.float64()))
    sizes = np.unique(np.asarray(column.value_lengths()))
    if len(sizes) > 1 or (dims is not None and len(sizes) and sizes[0] != dims):
        raise ValueError("vectors of an index have one length")
    return flat.reshape(len(column), -1)


def train_centroids(rows: DataFrame, id_column: str, embedding: str, lists: int, sample: int = SAMPLE) -> tuple[np.ndarray, int]:
    """(centroids, probes): spherical k-means over the rows with the least id hashes, the same for the same rows in any order, and the least number of lists that holds TARGET of the sample's nearest neighbours.

    A larger table has nearer neighbours than its sample, so that the share is a cautious one.
    """
    given = rows.where(F.size(embedding) > 0).select(F.xxhash64(F.col(id_column)).alias("h"), F.col(embedding).alias("e"))
    taken = given.orderBy("h", "e").limit(sample).select("h", "e").toArrow()
    data = unit(as_matrix(taken.column("e").combine_chunks()))
    lists = max(1, min(lists, len(data)))
    if not len(data):
        return np.zeros((0, 0)), 1
    start = np.random.default_rng(7).choice(len(data), lists, replace=False)
    centroids = data[np.sort(start)]
    for _ in range(ROUNDS):
        near = (data @ centroids.T).argmax(axis=1)
        sums = np.zeros_like(centroids)
        np.add.at(sums, near, data)
        alive = np.bincount(near, minlength=lists) > 0
        centroids = np.where(alive[:, None], unit(sums), centroids)
    near = (data @ centroids.T).argmax(axis=1)
    asked = data[:: max(1, len(data) // TRIED)][:TRIED]
    found = np.argpartition(-(asked @ data.T), min(10, len(data) - 1), axis=1)[:, :10]
    # the place that each neighbour's list has among the lists of the query
    place = np.argsort(np.argsort(-(asked @ centroids.T), axis=1, kind="stable"), axis=1)
    need = np.sort(np.take_along_axis(place, near[found], axis=1).ravel())
    return centroids, 1 + int(need[min(len(need) - 1, int(np.ceil(TARGET * len(need))) - 1)])


def nearest_lists(rows: DataFrame, embedding: str, centroids: np.ndarray, probes: int = 1) -> DataFrame:
    """rows with `lists`, the numbers of the nearest centroids, and `angle` to the nearest; vectors come out with length one."""
    schema = T.StructType([f for f in rows.schema.fields if f.name != embedding] + [T.StructField(embedding, T.ArrayType(T.DoubleType())), T.StructField("lists", T.ArrayType(T.IntegerType())), T.StructField("angle", T.DoubleType())])
    rest = [f for f in schema.names[:-3]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                data = unit(as_matrix(batch.column(embedding), centroids.shape[1]))
                score = data @ centroids.T
                order = score.argmax(axis=1)[:, None] if probes == 1 else np.argsort(-score, axis=1, kind="stable")[:, :probes]
                angle = np.arccos(np.clip(np.take_along_axis(score, order[:, :1], axis=1)[:, 0], -1, 1))
                flat = lambda m, t: pa.ListArray.from_arrays(np.arange(0, m.size + 1, m.shape[1], dtype=np.int32), pa.array(m.ravel(), t))
                yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in rest], flat(data, pa.float64()), flat(order, pa.int32()), pa.array(angle)], schema.names)

    return rows.mapInArrow(run, schema)


def build_vector_index(rows: DataFrame, id_column: str, embedding: str, path: str, lists: int = 256, payload: tuple[str, ...] = (), sample: int = SAMPLE) -> VectorIndex:
    """Write the index of all rows with a vector; `payload` columns are kept beside it, for filters. The table of lists is written last and makes the index visible."""
    spark = rows.sparkSession
    centroids, probes = train_centroids(rows, id_column, embedding, lists, sample)
    given = rows.where(F.size(embedding) > 0).select(F.col(id_column).alias("id"), F.col(embedding).alias("embedding"), *payload)
    version = f"rows-{uuid.uuid4().hex}"
    if len(centroids):
        placed = nearest_lists(given, "embedding", centroids).withColumn("list", F.get("lists", F.lit(0))).drop("lists")
        placed.repartitionByRange("list", "id").sortWithinPartitions("list", "id").write.partitionBy("list").parquet(f"{path}/{version}")
        found = {r["list"]: r for r in spark.read.parquet(f"{path}/{version}").groupBy("list").agg(F.count("*").alias("n"), F.max("angle").alias("radius")).collect()}  # one row per list
    else:
        given.withColumn("angle", F.lit(0.0)).withColumn("list", F.lit(0)).write.partitionBy("list").parquet(f"{path}/{version}")
        found = {}
    made = [(k, version, [float(x) for x in c], found[k]["n"] if k in found else 0, found[k]["radius"] if k in found else 0.0, probes) for k, c in enumerate(centroids)]
    table = spark.createDataFrame(made or [(-1, version, [], 0, 0.0, 1)], "list int, rows string, centroid array<double>, n long, radius double, probes int")
    table.coalesce(1).write.mode("overwrite").parquet(f"{path}/lists")
    return open_vector_index(spark, path)


def open_vector_index(spark: SparkSession, path: str) -> VectorIndex:
    """The index at path; its lists, which are as many as its builder chose, come to the driver."""
    lists = spark.read.parquet(f"{path}/lists").orderBy("list").collect()
    known = [r for r in lists if r["list"] >= 0]
    rows = spark.read.parquet(f"{path}/{lists[0]['rows']}") if known else spark.createDataFrame([], "id long, embedding array<double>, angle double, list int")
    payload = tuple(c for c in rows.columns if c not in ("id", "embedding", "angle", "list"))
    return VectorIndex(rows, np.asarray([r["centroid"] for r in known]), np.asarray([r["n"] for r in known], np.int64), np.asarray([r["radius"] for r in known]), lists[0]["probes"], payload)


def has_index(spark: SparkSession, path: str) -> bool:
    return storage.exists(spark, f"{path}/lists/_SUCCESS")


def probe_order(index: VectorIndex, query: list[float]) -> tuple[np.ndarray, np.ndarray]:
    """(lists from the nearest on, the best cosine that a row of each can have)."""
    q = unit(np.asarray([query], np.float64))
    angle = np.arccos(np.clip(index.centroids @ q[0], -1, 1))
    order = np.argsort(angle, kind="stable")
    return order, np.cos(np.maximum(0.0, angle - index.radii))[order]


def scored(index: VectorIndex, lists: list[int], query: list[float], k: int, candidates: DataFrame | None) -> list:
    """The k best (id, score) of some lists, which is a top-k that comes to the driver."""
    q = unit(np.asarray([query], np.float64))[0]
    near = index.rows.where(F.col("list").isin(*lists))
    if candidates is not None:
        near = near.join(candidates.select("id"), "id", "left_semi")
    dot = F.aggregate(F.zip_with("embedding", F.array(*[F.lit(float(x)) for x in q]), lambda a, b: a * b), F.lit(0.0), lambda s, v: s + v)
    return near.select("id", ((1 + dot) / 2).alias("score")).orderBy(F.desc("score"), "id").limit(k).collect()


def nearest(index: VectorIndex, query: list[float], k: int, look_at: int, candidates: DataFrame | None = None, exact: bool = False, slack: float = 1e-9) -> DataFrame:
    """(id, score) of the k nearest rows by cosine, as (1 + cos) / 2, ties by id.

    Reads the nearest lists that hold `look_at` rows together, and no fewer than the index's `probes`. Where `candidates`(id) leaves fewer than k of these, twice as many rows are looked at, and so on until k are found or all lists are read. With
    `exact` the lists whose bound reaches the k-th score are read too, after which the result is that of a scan.
    """
    spark = index.rows.sparkSession
    schema = T.StructType([index.rows.schema["id"], T.StructField("score", T.DoubleType())])
    if not len(index.centroids):
        return spark.createDataFrame([], schema)
    order, best = probe_order(index, query)
    held = np.cumsum(index.sizes[order])
    hits: list = []
    done = 0
    while done < len(order) and len(hits) < k:
        upto = min(len(order), max(index.probes, int(np.searchsorted(held, look_at)) + 1))
        if upto > done:
            hits = top(hits + scored(index, order[done:upto].tolist(), query, k, candidates), k)
            done = upto
        look_at *= 2
    if exact and done < len(order):
        reach = [int(x) for x, b in zip(order[done:], best[done:], strict=True) if len(hits) < k or (1 + b) / 2 + slack >= hits[-1]["score"]]
        if reach:
            hits = top(hits + scored(index, reach, query, k, candidates), k)
    return spark.createDataFrame([(h["id"], h["score"]) for h in hits], schema)


def top(hits: list, k: int) -> list:
    return sorted(hits, key=lambda h: (-h["score"], h["id"]))[:k]


def nearest_of_many(index: VectorIndex, queries: DataFrame, id_column: str, embedding: str, k: int, probes: int | None = None, block: int = 512, rows_per_salt: int = 200_000) -> DataFrame:
    """(query, id, score) of each query's k nearest rows among its `probes` nearest lists, the index's own number by default. Blocks of queries meet blocks of rows list by list, and lists of very many rows are dealt out over salts; ids are integers."""
    salts = F.lit(1) + F.get(F.array(*[F.lit(int(n // rows_per_salt)) for n in index.sizes]), F.col("list"))
    asked = nearest_lists(queries.where(F.size(embedding) > 0).select(F.col(id_column).cast("long").alias("id"), F.col(embedding).alias("embedding")), "embedding", index.centroids, probes or index.probes)
    each = asked.select("id", "embedding", F.explode("lists").alias("list"))
    each = each.withColumn("salt", F.explode(F.sequence(F.lit(0), salts - 1))).select("id", "embedding", "list", "salt")
    rows = index.rows.select(F.col("id").cast("long").alias("id"), "embedding", "list", F.pmod(F.xxhash64("id"), salts).cast("int").alias("salt"))
    pairs = _packed(rows, block).join(_packed(each.repartition("list", "salt").sortWithinPartitions("list", "salt"), block).toDF("list", "salt", "q_ids", "q_vectors", "q_dims").drop("q_dims"), ["list", "salt"])
    rank = F.row_number().over(W.partitionBy("query").orderBy(F.desc("score"), "id"))
    return pairs.select("ids", "vectors", "dims", "q_ids", "q_vectors").mapInArrow(_best(k), "query bigint, id bigint, score double").withColumn("__r", rank).where(F.col("__r") <= k).drop("__r")


def _packed(rows: DataFrame, block: int) -> DataFrame:
    """Blocks (list, salt, ids, vectors, dims) of rows (id, embedding, list, salt)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            data, ids = as_matrix(batch.column("embedding")), np.asarray(batch.column("id"))
            key = np.asarray(batch.column("list")).astype(np.int64) << 32 | np.asarray(batch.column("salt"))
            order = np.argsort(key, kind="stable")
            made = []
            for part in np.split(order, np.flatnonzero(np.diff(key[order])) + 1):
                for at in range(0, len(part), block):
                    chosen = part[at : at + block]
                    made.append((int(key[chosen[0]] >> 32), int(key[chosen[0]] & 0xFFFFFFFF), ids[chosen].tolist(), data[chosen].tobytes(), data.shape[1]))
            types = [pa.int32(), pa.int32(), pa.list_(pa.int64()), pa.binary(), pa.int32()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*made, strict=True), types, strict=True)], ["list", "salt", "ids", "vectors", "dims"])

    return rows.mapInArrow(run, "list int, salt int, ids array<bigint>, vectors binary, dims int")


def _best(k: int):
    """Top-k lists per query of the pairs of blocks that a task meets; it holds k rows of each of its queries."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[tuple[float, int]]] = {}
        for batch in batches:
            for ids, vectors, dims, q_ids, q_vectors in zip(*(batch.column(c).to_pylist() for c in ("ids", "vectors", "dims", "q_ids", "q_vectors")), strict=True):
                score = np.frombuffer(q_vectors).reshape(-1, dims) @ np.frombuffer(vectors).reshape(-1, dims).T
                for q, row in zip(q_ids, score, strict=True):
                    near = np.flatnonzero(row >= np.partition(row, -k)[-k]) if len(row) > k else np.arange(len(row))
                    held[q] = sorted(held.get(q, []) + [(-float(row[j]), ids[j]) for j in near])[:k]
        rows = [(q, i, (1 - s) / 2) for q, found in held.items() for s, i in found]
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (pa.int64(), pa.int64(), pa.float64()), strict=True)], ["query", "id", "score"])

    return run
