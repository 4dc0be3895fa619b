"""Near-duplicate detection by BagMinHash.

Texts are multisets of five-word shingles (lower-cased words). BagMinHash signatures come from hierarchical Poisson processes over discretised
multiplicities, so that two signatures agree in a component with the probability of the weighted Jaccard similarity. Bands of the signatures give buckets; in each
bucket every text is compared with the bucket's most popular text, the multiset overlap of the two texts is verified exactly,
and links of at least `similarity` join texts into classes. Where a bucket still holds several classes, the pairs across classes that can reach
the threshold are derived from the texts' profiles relative to the leader, so that no link between texts that share a bucket is lost and no group is paired up in full.

Exact copies are collapsed by the digest of their text before anything is shuffled by band; a bucket's size never decides whether a text is
compared. Defined results: null and empty texts are copies of each other; texts of fewer than five words are one shingle; repeated rows are
copies; the class id is the least doc_id of the class (null ids last). Links between texts that share a bucket are all found, except that two texts of one class are not
compared again, so that n_links counts the links that were verified, not all links of a text.

Joins on a leader are salted by the number of its texts, the other joins on a bucket or shingle carry narrow rows that adaptive execution splits where they are skewed.
Tables that were written on the way are deleted once the classes are written.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kbweave.llm.common import bounded_batches, drop_materialized, materialize

WORD = re.compile(r"\w+")
GOLD = np.uint64(0x9E3779B97F4A7C15)
U64 = np.uint64


@dataclass(frozen=True)
class Settings:
    words: int = 5
    similarity: float = 0.8
    bands: int = 24
    rows: int = 4
    seed: int = 1
    max_broadcast: int = 200_000  # pairs or labels that travel to every executor; more are joined by shuffle
    salted: int = 512  # partners of a text that are compared in one task


def shingles(text: str | None, n: int) -> list[str]:
    words = WORD.findall((text or "").lower())
    if not words:
        return []
    if len(words) < n:
        return [" ".join(words)]
    return [" ".join(words[i : i + n]) for i in range(len(words) - n + 1)]


def mix(x: np.ndarray) -> np.ndarray:
    x = x + GOLD
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def shingle_codes(texts: list[str | None], n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text index, shingle code, multiplicity), sorted; codes are mixed word hashes."""
    import xxhash

    cache: dict[str, int] = {}
    owners, codes = [], []
    h = xxhash.xxh64_intdigest
    for i, text in enumerate(texts):
        words = WORD.findall((text or "").lower())
        if not words:
            continue
        for w in set(words):
            if w not in cache:
                cache[w] = h(w)
        w = np.fromiter(map(cache.__getitem__, words), U64, len(words))
        k = min(n, len(w))
        rolled = np.full(len(w) - k + 1, U64(k))
        for j in range(k):
            rolled = mix(rolled ^ w[j : j + len(rolled)])
        code, many = np.unique(rolled, return_counts=True)
        owners.append((i, len(code)))
        codes.append((code, many))
    if not owners:
        z = np.zeros(0, np.int64)
        return z, np.zeros(0, U64), z
    owner = np.repeat([o for o, _ in owners], [c for _, c in owners])
    return owner, np.concatenate([c for c, _ in codes]), np.concatenate([m for _, m in codes])


def signatures(owner: np.ndarray, code: np.ndarray, many: np.ndarray, texts: int, m: int, seed: int) -> np.ndarray:
    """texts x m signature codes: per component the code of the point that came first.

    Weights (multiplicities) are cut at 1, 2, 4, 8, ... into levels. Each (shingle, level) is a Poisson process whose rate is the level's
    width; a point carries its height inside the level and counts for every weight above it, so that a larger weight sees all points of a
    smaller one. Points are drawn in the order of time, and a process stops once it is later than every component's minimum.
    """
    level = np.zeros(len(code), np.int64)
    top = int(many.max()) if len(many) else 0
    parts = [(owner, code, many, level)]
    low = 1
    k = 1
    while low < top:
        has = many > low
        parts.append((owner[has], code[has], many[has], np.full(int(has.sum()), k)))
        low *= 2
        k += 1
    owner, code, many, level = (np.concatenate([p[i] for p in parts]) for i in range(4))
    base = np.where(level == 0, 0, 1 << np.maximum(level - 1, 0)).astype(np.float64)
    width = np.where(level == 0, 1, 1 << np.maximum(level - 1, 0)).astype(np.float64)
    state = mix(code ^ mix(level.astype(U64) + U64(seed * 1000)))
    time = np.zeros(len(code))
    best = np.full(texts * m, np.inf)
    sign = np.zeros(texts * m, U64)
    live = np.arange(len(code))
    while len(live):
        state[live] = mix(state[live])
        u = ((state[live] >> U64(11)).astype(np.float64) + 0.5) * 2.0**-53
        time[live] -= np.log(u) / width[live]
        other = mix(state[live] ^ U64(0xD1B54A32D192ED03))
        component = (other >> U64(40)).astype(np.int64) % m
        height = base[live] + width[live] * ((other & U64(0xFFFFFFFF)).astype(np.float64) * 2.0**-32)
        seen = height < many[live]
        at = owner[live] * m + component
        hit = live[seen]
        slot, when = at[seen], time[hit]
        order = np.lexsort((when, slot))
        slot, when, hit = slot[order], when[order], hit[order]
        first = np.concatenate([[True], slot[1:] != slot[:-1]]) if len(slot) else np.zeros(0, bool)
        slot, when, hit = slot[first], when[first], hit[first]
        better = when < best[slot]
        best[slot[better]] = when[better]
        sign[slot[better]] = state[hit[better]]
        limit = best.reshape(texts, m).max(axis=1)
        live = live[time[live] < limit[owner[live]]]
    return sign.reshape(texts, m)


def overlap(a: Counter, b: Counter) -> float:
    """Weighted Jaccard of two multisets."""
    small, large = (a, b) if len(a) < len(b) else (b, a)
    common = sum(min(n, large[x]) for x, n in small.items() if x in large)
    total = sum(a.values()) + sum(b.values()) - common
    return common / total if total else 1.0


def sign(docs: DataFrame, id_column: str, text: str, settings: Settings) -> DataFrame:
    """(doc_id, key, n_shingles, bands): key is the text's 128-bit digest, bands are bucket codes (none for texts without words)."""
    bounded_batches(docs.sparkSession)
    given = docs.select(F.col(id_column).alias("doc_id"), F.col(text).alias("text"))
    schema = T.StructType([given.schema["doc_id"], T.StructField("key", T.BinaryType()), T.StructField("n_shingles", T.LongType()), T.StructField("bands", T.ArrayType(T.LongType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).to_pylist()
            owner, code, many = shingle_codes(texts, settings.words)
            found = signatures(owner, code, many, len(texts), settings.bands * settings.rows, settings.seed)
            bands = np.zeros((len(texts), settings.bands), U64) + np.arange(settings.bands, dtype=U64)
            for r in range(settings.rows):
                bands = mix(bands ^ found[:, r :: settings.rows])
            total = np.bincount(owner, many, len(texts)).astype(np.int64)
            keys = pa.array([hashlib.md5((t or "").encode()).digest() for t in texts], pa.binary())
            lists = [b if n else [] for b, n in zip(bands.astype(np.int64).tolist(), total.tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), keys, pa.array(total), pa.array(lists, pa.list_(pa.int64()))], ["doc_id", "key", "n_shingles", "bands"])

    return given.mapInArrow(run, schema)


def text_key(text):
    return F.unhex(F.md5(F.coalesce(text, F.lit(""))))


def _met(pairs: DataFrame, docs: DataFrame, text: str, settings: Settings) -> DataFrame:
    """(a, b, text_a, text_b) of the pairs of keys.

    Every text is read where it lies, takes the list of its partners along and is sent once for each; the partners' texts (b) are few and are sent once for
    every `salted` texts that meet them. Up to max_broadcast pairs travel to the texts, so that texts without a partner are not moved; longer lists are joined by shuffle.
    """
    send = F.broadcast if pairs.count() <= settings.max_broadcast else (lambda df: df)
    salts = pairs.groupBy("b").agg((F.floor(F.count("*") / settings.salted) + 1).cast("int").alias("salts"))
    dealt = pairs.join(send(salts), "b").select("a", F.struct("b", F.pmod(F.xxhash64("a"), "salts").cast("int").alias("salt")).alias("p"))
    keyed = docs.select(text_key(F.col(text)).alias("key"), F.col(text).alias("text"))
    side = keyed.join(send(salts.withColumnRenamed("b", "key")), "key").dropDuplicates(["key"]).select(F.col("key").alias("b"), F.col("text").alias("text_b"), F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"))
    mine = keyed.join(send(dealt.groupBy(F.col("a").alias("key")).agg(F.collect_set("p").alias("partners"))), "key").dropDuplicates(["key"])
    met = mine.select(F.col("key").alias("a"), F.col("text").alias("text_a"), F.explode("partners").alias("p")).select("a", "text_a", "p.b", "p.salt").join(side, ["b", "salt"])
    return met.select("a", "b", "text_a", "text_b")


def verify(pairs: DataFrame, docs: DataFrame, text: str, settings: Settings) -> DataFrame:
    """(a, b, similarity) of the pairs whose multiset overlap reaches the threshold."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last_key, last = None, Counter()
        for batch in batches:
            rows = []
            for a, b, ta, tb in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if b != last_key:
                    last_key, last = b, Counter(map(hash, shingles(tb, settings.words)))
                s = overlap(Counter(map(hash, shingles(ta, settings.words))), last)
                if s >= settings.similarity:
                    rows.append((a, b, s))
            if rows:
                a, b, s = zip(*rows, strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.binary()), pa.array(b, pa.binary()), pa.array(s)], ["a", "b", "similarity"])

    return _met(pairs, docs, text, settings).mapInArrow(run, "a binary, b binary, similarity double")


def profile(pairs: DataFrame, docs: DataFrame, text: str, settings: Settings) -> DataFrame:
    """(a, b, n, inside, excess): a's size, its overlap with b, and the codes of the shingles that a has more often than b, with how much more often."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last_key, last = None, {}
        for batch in batches:
            rows = []
            for a, b, ta, tb in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if b != last_key:
                    _, code, many = shingle_codes([tb], settings.words)
                    last_key, last = b, dict(zip(code.view(np.int64).tolist(), many.tolist(), strict=True))
                _, code, many = shingle_codes([ta], settings.words)
                code, have = code.view(np.int64), np.fromiter((last.get(c, 0) for c in code.view(np.int64).tolist()), np.int64, len(code))
                rows.append((a, b, int(many.sum()), int(np.minimum(many, have).sum()), [{"code": c, "more": m} for c, m in zip(code[many > have].tolist(), (many - have)[many > have].tolist(), strict=True)]))
            if rows:
                kinds = [pa.binary(), pa.binary(), pa.int64(), pa.int64(), pa.list_(pa.struct([("code", pa.int64()), ("more", pa.int64())]))]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], ["a", "b", "n", "inside", "excess"])

    return _met(pairs, docs, text, settings).mapInArrow(run, "a binary, b binary, n bigint, inside bigint, excess array<struct<code:bigint,more:bigint>>")


def pairs_across(profiles: DataFrame, labels: DataFrame, settings: Settings) -> DataFrame:
    """(a, b): all pairs of different classes under one leader that can reach the threshold, without generating the others.

    What two texts share is at most what the smaller of them shares with the leader, plus what both have beyond the leader. A pair that needs
    some of the latter is found by prefix filtering: a text that needs r of its surplus to be shared is listed under its rarest surplus shingles
    only, up to the last r - 1. A pair that needs none has sizes and overlaps that fit, as only texts close below the threshold have.
    """
    c = settings.similarity / (1 + settings.similarity)
    slack = 1e-9
    label = labels.select(F.col("key"), "label")
    named = profiles.join(label.toDF("a", "la"), "a", "left").withColumn("la", F.coalesce("la", "a")).join(label.toDF("b", "lb"), "b", "left").withColumn("lb", F.coalesce("lb", "b"))
    named = materialize(named.select("a", "b", "la", "lb", "n", "inside", "excess"), "profiles")
    heads = named.groupBy("b").agg(F.min("n").alias("least"), (F.floor(F.count("*") / settings.salted) + 1).cast("int").alias("salts"))
    # the least size under a leader goes to its texts, salted by their number
    salt = F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt")
    most = named.groupBy("b").agg(F.count("*").alias("many")).agg(F.max("many")).first()[0] or 0
    if most > settings.salted:
        known = named.join(heads.select("b", "salts"), "b").withColumn("salt", F.pmod(F.xxhash64("a"), "salts").cast("int")).join(heads.select("b", "least", salt), ["b", "salt"]).drop("salt", "salts")
    else:
        known = named.join(heads.select("b", "least"), "b")
    known = materialize(known, "profiles")
    each = known.select("a", "b", "la", "n", "inside", "least", F.explode("excess").alias("x")).select("a", "b", "la", "n", "inside", "least", "x.code", "x.more")
    spread = each.groupBy("b", "code").agg(F.count("*").alias("texts"), F.min("la").alias("low"), F.max("la").alias("high"))
    rarest = W.partitionBy("a", "b").orderBy("texts", "code").rowsBetween(W.unboundedPreceding, -1)
    placed = each.join(spread, ["b", "code"]).withColumn("rest", F.col("n") - F.col("inside") - F.coalesce(F.sum("more").over(rarest), F.lit(0)))
    needed = F.greatest(F.lit(1), F.ceil(c * (F.col("n") + F.col("least")) - F.col("inside") - slack))
    held = placed.where("low < high").where(F.col("rest") >= needed).select("a", "b", "code", "la", "n", "inside", "rest")
    one = held.select(*[F.col(n).alias(f"x_{n}") for n in held.columns])
    two = held.select(*[F.col(n).alias(f"y_{n}") for n in held.columns])
    # at the first surplus shingle that two texts share, all others that they share are still to come
    room = F.least("x_inside", "y_inside") + F.least("x_rest", "y_rest")
    first = one.join(two, (F.col("x_b") == F.col("y_b")) & (F.col("x_code") == F.col("y_code")) & (F.col("x_la") < F.col("y_la")) & (room >= c * (F.col("x_n") + F.col("y_n")) - slack)).select(F.col("x_a").alias("a"), F.col("y_a").alias("b"))
    # without shared surplus a text needs a partner of at least `similarity` of its size and of at most inside / c - n: it asks the size classes in between
    fits = known.drop("excess").where(F.col("inside") >= c * (F.col("n") + F.col("least")) - slack)
    size_class = lambda n: F.floor(F.log(F.greatest(n, F.lit(1))) / F.log(F.lit(1.05))).cast("int")
    asked = F.sequence(size_class(settings.similarity * F.col("n") - 1e-6) - 1, F.greatest(size_class(F.col("inside") / c - F.col("n") + 1e-6) + 1, size_class(settings.similarity * F.col("n") - 1e-6)))
    out = fits.where("la <> lb").withColumn("size_class", F.explode(asked)).select(*[F.col(n).alias(f"x_{n}") for n in ("a", "b", "la", "n", "inside", "size_class")])
    every = fits.withColumn("size_class", size_class(F.col("n"))).select(*[F.col(n).alias(f"y_{n}") for n in ("a", "b", "la", "n", "inside", "size_class")])
    close = F.least("x_inside", "y_inside") >= c * (F.col("x_n") + F.col("y_n")) - slack
    second = out.join(every, (F.col("x_b") == F.col("y_b")) & (F.col("x_size_class") == F.col("y_size_class")) & (F.col("x_la") != F.col("y_la")) & close).select(F.col("x_a").alias("a"), F.col("y_a").alias("b"))
    found = materialize(first.union(second).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "across")
    drop_materialized(named)
    drop_materialized(known)
    return found


def components(links: DataFrame, max_broadcast: int = 200_000) -> DataFrame:
    """(key, label) for every end of a link; label is the least key of the component. Least labels spread along the links, with
    a jump to the label's own label in every round, until nothing changes. Up to max_broadcast labels travel to every executor, more are joined by shuffle."""
    both = materialize(links.select("a", "b").union(links.select("b", "a")).toDF("a", "b").distinct(), "links")
    labels = materialize(both.groupBy(F.col("a").alias("key")).agg(F.min("b").alias("m")).select("key", F.least("key", "m").alias("label")), "labels")
    small = labels.count() <= max_broadcast
    side = F.broadcast if small else (lambda df: df)
    while True:
        heard = both.join(side(labels), both.b == labels.key).groupBy("a").agg(F.min("label").alias("heard"))
        near = heard.join(side(labels), labels.key == heard.a).select("key", F.col("label").alias("old"), F.least("label", "heard").alias("label"))
        jump = near.join(side(labels.select(F.col("key").alias("label"), F.col("label").alias("next"))), "label", "left")
        fresh = materialize(jump.select("key", "old", F.least("label", F.coalesce("next", "label")).alias("label")), "labels")
        changed = fresh.where(F.col("old") != F.col("label")).limit(1).count()
        drop_materialized(labels)
        labels = fresh.select("key", "label")
        if not changed:
            drop_materialized(both)
            return labels


def join_classes(labels: DataFrame, links: DataFrame, max_broadcast: int = 200_000) -> DataFrame:
    """labels after further links: the classes that the links join are themselves the ends of links, and only those are walked again."""
    of = lambda side: F.coalesce(F.col(f"l{side}"), F.col(side)).alias(side)
    raised = links.join(labels.toDF("a", "la"), "a", "left").join(labels.toDF("b", "lb"), "b", "left").select(of("a"), of("b")).where("a <> b")
    between = materialize(raised.distinct(), "classes")
    moved = components(between, max_broadcast).toDF("old", "new")
    drop_materialized(between)
    ends = links.select(F.col("a").alias("key")).union(links.select("b")).distinct().join(labels, "key", "left_anti").select("key", F.col("key").alias("label"))
    every = labels.unionByName(ends)
    return materialize(every.join(moved, every.label == moved.old, "left").select("key", F.coalesce("new", "label").alias("label")), "labels")


def near_duplicates(docs: DataFrame, id_column: str = "doc_id", text: str = "text", settings: Settings = Settings()) -> DataFrame:
    """One row per document: doc_id, class_id, class_size, n_links (verified links of its text), n_shingles, key of its text, label (the key that names its class)."""
    signed = materialize(sign(docs, id_column, text, settings), "signatures")
    distinct = signed.groupBy("key").agg(F.first("bands").alias("bands"))
    each = distinct.select("key", F.explode("bands").alias("h"))
    shared = materialize(each.join(each.groupBy("h").agg(F.count("*").alias("n")).where("n > 1"), "h"), "buckets")
    popular = shared.groupBy("key").agg(F.sum("n").alias("popularity"))
    leaders = materialize(shared.join(popular, "key").groupBy("h").agg(F.max(F.struct("popularity", "key"))["key"].alias("leader")), "leaders")
    stars = shared.join(leaders, "h").where(F.col("key") != F.col("leader")).select(F.col("key").alias("a"), F.col("leader").alias("b")).distinct()
    tried = materialize(stars, "stars")
    links = materialize(verify(tried, docs, text, settings), "verified")
    labels = components(links, settings.max_broadcast)
    # buckets in which different classes meet: what may link them is found relative to the bucket's leader, which all of its texts were compared with
    marked = shared.select("h", "key").join(labels, "key", "left").withColumn("label", F.coalesce("label", "key"))
    mixed = marked.groupBy("h").agg(F.min("label").alias("low"), F.max("label").alias("high")).where("low < high").select("h")
    heads = leaders.join(mixed, "h").select(F.col("leader").alias("b")).distinct()
    open_pairs = materialize(tried.join(heads, "b", "left_semi"), "profiled")
    rest = pairs_across(profile(open_pairs, docs, text, settings), labels, settings)
    done = [shared, leaders, tried, open_pairs, rest, links, labels]
    if not rest.isEmpty():
        more = materialize(verify(rest, docs, text, settings), "verified")
        done.append(more)
        if not more.isEmpty():
            links = links.unionByName(more)
            labels = join_classes(labels, more, settings.max_broadcast)
            done.append(labels)
    degree = links.select("a", "b").union(links.select("b", "a")).toDF("a", "b").distinct().groupBy(F.col("a").alias("key")).agg(F.count("*").alias("n_links"))
    known = labels.join(degree, "key", "left")
    classed = signed.select("doc_id", "key", "n_shingles").join(known, "key", "left").withColumn("label", F.coalesce("label", "key"))
    classed = materialize(classed, "classed")
    for df in (signed, *done):
        drop_materialized(df)
    ids = classed.groupBy("label").agg(F.min("doc_id").alias("class_id"), F.count("*").alias("class_size"))
    return classed.join(ids, "label").select("doc_id", "class_id", "class_size", F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"), "n_shingles", "key", "label")


def keep_representatives(docs: DataFrame, id_column: str = "doc_id", text: str = "text", settings: Settings = Settings()) -> DataFrame:
    """docs with one row of each class, that of the least id (null ids last); of several texts of the class under this id the one with the least key, of repeated rows one."""
    found = near_duplicates(docs, id_column, text, settings)
    # classes go by their label: ids may be null or stand for several texts
    first = found.where(F.col("doc_id").eqNullSafe(F.col("class_id"))).groupBy("label", F.col("doc_id").alias("__id"), F.col("key").alias("__key")).agg(F.count("*").alias("__rows"))
    kept = materialize(first.groupBy("label").agg(F.min_by(F.struct("__id", "__key", "__rows"), "__key").alias("k")).select("k.*"), "kept")
    drop_materialized(found)
    marked = docs.withColumn("__key", text_key(F.col(f"`{text}`")))
    joined = marked.join(kept, marked[id_column].eqNullSafe(kept["__id"]) & (marked["__key"] == kept["__key"]), "left_semi")
    if not kept.where("__rows > 1").isEmpty():  # texts are dealt out once more only where rows repeat
        joined = joined.dropDuplicates([id_column, "__key"])
    return joined.select(*[F.col(f"`{c}`") for c in docs.columns])
