"""Removal of every byte covered by a 400-byte string that also starts elsewhere.

The candidates for "starts elsewhere" are refined as the interleave of merged suffix orders is: blocks of equal content get split by ever
longer context, blocks with one member are settled as unique, blocks whose members agree to the full depth are settled as repeated, and only blocks that are
still open go into the next round. Blocks are named by 128 bits of hash instead of by rank, so that shards never have to agree on an
order and a round moves the open blocks alone; see the README for why no Burrows-Wheeler transform is stored.

Round 0. Each window of `length` bytes is owned by the rightmost minimum among the hashes of its first 64-byte strings: equal windows
have equal owners at equal offsets. Windows in a row with one owner are a run; its core (bytes that all its windows share) is the owner's string,
its name the hash of all its bytes. A core that occurs once settles the run as unique, a name that occurs twice settles it as repeated.
Round 1 cuts open runs at multiples of 16 offsets, round 2 into single windows, which are decided for good.

Counting is by partial aggregation on names, so that a passage that occurs in every document is one row per task; its places are
then found by a broadcast list of such passages and not moved by name. Defined results: a null
text is an empty one; texts shorter than `length` lose nothing; repeated rows are repeats of each other; matches never cross documents.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kbweave.llm.common import bounded_batches, drop_materialized, materialize

U64 = np.uint64
OWNER = 64


@dataclass(frozen=True)
class Settings:
    length: int = 400
    step: int = 16
    max_broadcast: int = 1_000_000  # rows of an open list that travel to every executor; longer lists are joined by shuffle
    often: int = 4096  # rows of one class or core that may meet in one task; those of more are not moved by it


def join_hash(a: np.ndarray, b: np.ndarray, salt: int) -> np.ndarray:
    """Hash of two hashes in order; multiplications wrap."""
    x = (a ^ U64(salt)) * U64(0x9E3779B97F4A7C15) + b
    x ^= x >> U64(32)
    x *= U64(0xD6E8FEB86659FD93)
    x ^= x >> U64(29)
    return x


class Hashes:
    """Hashes of the strings of 1, 2, 4, ... bytes at every position of a buffer."""

    def __init__(self, data: np.ndarray, top: int, salt: int):
        self.levels = {1: data.astype(U64) + U64(salt * 257 + 1)}
        n = 1
        while 2 * n <= top:
            h = self.levels[n]
            self.levels[2 * n] = join_hash(h[:-n], h[n:], salt + 2 * n) if len(h) > n else h[:0]
            if n > 1 and n < OWNER:
                del self.levels[n]
            n *= 2

    def block(self, start: np.ndarray, size: np.ndarray | int) -> np.ndarray:
        """Hash of size[i] bytes from start[i], from overlapping strings of a fixed power of two: 256 bytes where they fit, 64 otherwise."""
        size = np.broadcast_to(np.asarray(size, np.int64), start.shape)
        unit = 256 if len(size) and size.min() >= 256 else OWNER
        h = self.levels[unit]
        out = join_hash(h[start], size.astype(U64), 7)
        for k in range(1, -(-int(size.max(initial=unit)) // unit)):
            at = np.minimum(start + k * unit, start + size - unit)
            out = join_hash(out, h[at], 11)
        return out


def rightmost_minimum(h: np.ndarray, width: int) -> np.ndarray:
    """For every position s the rightmost position of the least h in [s, s + width)."""
    value, place = h, np.arange(len(h), dtype=np.int32)
    n = 1
    while 2 * n <= width:
        right = value[n:] <= value[:-n]
        place = np.where(right, place[n:], place[:-n])
        value = np.where(right, value[n:], value[:-n])
        n *= 2
    shift = width - n
    if shift:
        right = value[shift:] <= value[: len(value) - shift]
        place = np.where(right, place[shift:], place[: len(place) - shift])
    return place


def runs(data: np.ndarray, bounds: np.ndarray, s: Settings, salts: tuple[int, int] = (1, 2)) -> tuple[np.ndarray, ...]:
    """(text, owner, lo, hi, core, name): windows start at owner - hi ... owner - lo; owner counts from its text's begin."""
    width = s.length - OWNER + 1
    h = Hashes(data, 256, salts[0])
    if len(data) < s.length:
        return tuple(np.zeros(0, np.int64) for _ in range(6))
    place = rightmost_minimum(h.levels[OWNER], width)[: len(data) - s.length + 1].astype(np.int64)
    text = np.searchsorted(bounds, np.arange(len(place)), "right") - 1
    fits = np.arange(len(place)) + s.length <= bounds[text + 1]
    at = np.flatnonzero(fits)
    if not len(at):
        return tuple(np.zeros(0, np.int64) for _ in range(6))
    new = np.concatenate([[True], (place[at[1:]] != place[at[:-1]]) | (at[1:] != at[:-1] + 1)])
    first = at[new]
    last = at[np.concatenate([np.flatnonzero(new)[1:] - 1, [len(at) - 1]])]
    owner, of = place[first], text[first]
    core = h.levels[OWNER][owner]
    name = join_hash(h.block(first, last - first + s.length), (owner - last).astype(U64), 13)
    return of, owner - bounds[of], owner - last, owner - first, core, name


def pieces(data: np.ndarray, owner: np.ndarray, lo: np.ndarray, hi: np.ndarray, grain: int, s: Settings) -> tuple[np.ndarray, ...]:
    """(item, lo, hi, core, name) of runs of one buffer, cut at multiples of `grain` offsets from the owner."""
    first, last = lo // grain, hi // grain
    many = last - first + 1
    item = np.repeat(np.arange(len(owner)), many)
    k = first[item] + np.arange(len(item)) - np.repeat(np.cumsum(many) - many, many)
    a, b = np.maximum(k * grain, lo[item]), np.minimum(k * grain + grain - 1, hi[item])
    if grain == 1:  # a window is its own core; two independent hashes decide
        start = owner[item] - a
        return item, a, b, Hashes(data, 256, 1).block(start, s.length), Hashes(data, 256, 5).block(start, s.length)
    h = Hashes(data, 256, 3)
    core = join_hash(h.block(owner[item] - k * grain, s.length - grain + 1), k.astype(U64), 17)
    name = join_hash(h.block(owner[item] - b, b - a + s.length), a.astype(U64), 19)
    return item, a, b, core, name


NAMES = ["k1", "k2", "owner", "lo", "hi", "weight", "core", "name"]
CLASS = ["core", "name", "lo", "hi"]
ROWS = "k1 bigint, k2 bigint, owner int, lo int, hi int, weight int, core bigint, name bigint"


def _batch(k1, k2, owner, lo, hi, weight, core, name) -> pa.RecordBatch:
    ints = [pa.array(np.asarray(x).astype(np.int32)) for x in (owner, lo, hi, weight)]
    return pa.RecordBatch.from_arrays([pa.array(k1), pa.array(k2), *ints, pa.array(np.asarray(core).view(np.int64)), pa.array(np.asarray(name).view(np.int64))], NAMES)


def text_keys(text):
    """96 bits that stand for a text in joins."""
    return F.xxhash64(text).alias("k1"), F.crc32(text).alias("k2")


def groups(texts: list[bytes], most: int = 1 << 21) -> Iterator[tuple[int, int]]:
    start = size = 0
    for i, t in enumerate(texts):
        if size and size + len(t) > most:
            yield start, i
            start, size = i, 0
        size += len(t)
    if start < len(texts):
        yield start, len(texts)


def all_runs(keyed: DataFrame, s: Settings) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            k1, k2 = (np.asarray(batch.column(i)) for i in (0, 1))
            texts = batch.column(2).cast(pa.binary()).to_pylist()
            for start, stop in groups(texts):
                part = texts[start:stop]
                bounds = np.concatenate([[0], np.cumsum([len(t) for t in part])])
                of, owner, lo, hi, core, name = runs(np.frombuffer(b"".join(part), np.uint8), bounds, s)
                if len(of):
                    yield _batch(k1[start:stop][of], k2[start:stop][of], owner, lo, hi, np.ones(len(of)), core, name)

    return keyed.where(F.octet_length("text") >= s.length).mapInArrow(run, ROWS)


def cut_open(keyed: DataFrame, listed: DataFrame, grain: int, s: Settings) -> DataFrame:
    """The open items of `listed` (k1, k2, owner, lo, hi, weight), cut finer; only the texts they stand in are read."""
    size = listed.count()
    per_text = listed.groupBy("k1", "k2").agg(F.collect_list(F.struct("owner", "lo", "hi", "weight")).alias("items"))
    one = keyed.join(F.broadcast(per_text) if size <= s.max_broadcast else per_text, ["k1", "k2"]).select("k1", "k2", "text", "items")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            k1, k2 = (np.asarray(batch.column(i)) for i in (0, 1))
            for i, (text, items) in enumerate(zip(batch.column(2).cast(pa.binary()).to_pylist(), batch.column(3), strict=True)):
                flat = items.values.flatten()
                owner, lo, hi, weight = (np.asarray(c).astype(np.int64) for c in flat)
                item, a, b, core, name = pieces(np.frombuffer(text, np.uint8), owner, lo, hi, grain, s)
                yield _batch(np.full(len(item), k1[i]), np.full(len(item), k2[i]), owner[item], a, b, weight[item], core, name)

    # copies of a text would repeat its items: each item is counted once, whatever the number of rows with the text
    return one.dropDuplicates(["k1", "k2"]).mapInArrow(run, ROWS) if size > s.max_broadcast else one.mapInArrow(run, ROWS).dropDuplicates(["k1", "k2", "owner", "lo", "hi"])


def listed_rows(rows: DataFrame, listed: DataFrame, keys: list[str], s: Settings) -> DataFrame:
    """The rows whose keys are in `listed`, where `many` is at least the number of rows with these keys.

    Keys of more than `often` rows are at most all rows / often: their list travels and their rows stay in place, as a shuffle would bring all rows of a key, copies of a text among them, into one task.
    """
    often = F.broadcast(listed.where(F.col("many") > s.often).select(*keys))
    few = listed.where(F.col("many") <= s.often).select(*keys)
    return rows.join(often, keys, "left_semi").unionByName(rows.join(often, keys, "left_anti").join(few, keys, "left_semi"))


def settle(rows: DataFrame, final: bool, s: Settings) -> tuple[DataFrame, DataFrame | None, list[DataFrame]]:
    """(repeated items with their places, items that stay open or bear witness, tables that both read)."""
    classes = rows.groupBy(*CLASS).agg(F.sum("weight").alias("many"), F.min(F.struct("k1", "k2", "owner")).alias("member"))

    def repeated(classes: DataFrame) -> DataFrame:
        return listed_rows(rows.where("weight = 1"), classes.where("many > 1"), CLASS, s).select("k1", "k2", "owner", "lo", "hi")

    if final:
        return repeated(classes), None, []
    # one table for both questions: how often a class occurs, and whether its core holds a class that occurs once
    classes = materialize(classes, "classes")
    cores = classes.groupBy("core").agg(F.sum("many").alias("total"), F.min("many").alias("least"), F.count("*").alias("many"))
    undecided = cores.where("total > 1 AND least = 1").select("core", "many")
    still = listed_rows(classes, undecided, ["core"], s).select("member.k1", "member.k2", "member.owner", "lo", "hi", F.when(F.col("many") > 1, 2).otherwise(1).alias("weight"))
    return repeated(classes), still, [classes]


def repeated_windows(docs: DataFrame, text: str, s: Settings) -> tuple[DataFrame, list[DataFrame]]:
    """(k1, k2, owner, lo, hi): all windows, as runs, whose bytes start elsewhere too; and the written tables that they come from."""
    bounded_batches(docs.sparkSession)
    keyed = docs.select(*text_keys(F.col(text)), F.col(text).alias("text"))
    found = []
    rows = materialize(all_runs(keyed, s), "runs")
    written = [rows]
    for grain, final in ((s.step, False), (1, False), (0, True)):
        repeated, still, read = settle(rows, final, s)
        found.append(repeated)
        written += read
        if not final:
            listed = materialize(still, "open")
            rows = materialize(cut_open(keyed, listed, grain, s), "pieces")
            written.append(rows)
            drop_materialized(listed)
    return found[0].unionByName(found[1]).unionByName(found[2]), written


def merged(spans: Column) -> Column:
    """Sorted spans without overlap: each run of windows that touches the one before extends it."""
    last = lambda done: F.get(done, F.size(done) - 1)

    def step(done: Column, x: Column) -> Column:
        longer = F.struct(last(done)["first"].alias("first"), F.greatest(last(done)["end"], x["end"]).alias("end"))
        return F.when((F.size(done) > 0) & (x["first"] <= last(done)["end"]), F.concat(F.slice(done, 1, F.size(done) - 1), F.array(longer))).otherwise(F.concat(done, F.array(x)))

    return F.aggregate(F.array_sort(spans), F.array().cast("array<struct<first:int,end:int>>"), step)


def remove_repeats(docs: DataFrame, id_column: str = "doc_id", text: str = "text", settings: Settings = Settings(), texts: bool = False) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_removed, n_spans, kept_sha256; with `texts` also the bytes that are left. Other columns of docs are left out."""
    s = settings
    windows, written = repeated_windows(docs, text, s)
    runs_of = windows.groupBy("k1", "k2").agg(F.collect_set(F.struct((F.col("owner") - F.col("hi")).alias("first"), (F.col("owner") - F.col("lo") + s.length).alias("end"))).alias("runs"))
    found = materialize(runs_of.select("k1", "k2", merged(F.col("runs")).alias("spans")), "spans")
    for done in written:
        drop_materialized(done)
    size = found.agg(F.sum(F.size("spans"))).first()[0] or 0
    keyed = docs.select(F.col(id_column).alias("doc_id"), *text_keys(F.col(text)), F.coalesce(F.col(text), F.lit("")).alias("text"))
    joined = keyed.join(F.broadcast(found) if size <= s.max_broadcast else found, ["k1", "k2"], "left").select("doc_id", "text", "spans")
    fields = [keyed.schema["doc_id"], *[T.StructField(n, T.LongType()) for n in ("n_bytes", "n_removed", "n_spans")], T.StructField("kept_sha256", T.StringType())]
    if texts:
        fields.append(T.StructField("kept", T.BinaryType()))
    bounded_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for data, spans in zip(batch.column(1).cast(pa.binary()).to_pylist(), batch.column(2).to_pylist(), strict=True):
                cut = [(x["first"], x["end"]) for x in spans or ()]
                edges = [0, *(x for c in cut for x in c), len(data)]
                kept = b"".join(data[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True))
                out.append((len(data), len(data) - len(kept), len(cut), hashlib.sha256(kept).hexdigest(), *([kept] if texts else [])))
            if out:
                yield pa.RecordBatch.from_arrays([batch.column(0), *map(pa.array, zip(*out, strict=True))], [f.name for f in fields])

    return joined.mapInArrow(run, T.StructType(fields))
