"""Retrieval: BM25 over several fields, exact cosine neighbours, hybrid fusion, blended scores, typeahead.

The query is small and enters the plans as literals. BM25 reads the postings of its terms from a written index (`bm25`), or, for tables that are searched once,
scans them (`bm25_scan`); neighbours are exact, filters first, and top-k ends in TakeOrderedAndProject.
BM25 is exact (k1 = 1.2, b = 0.75, idf = ln(1 + (N - df + 0.5) / (df + 0.5))); norms are not quantised, neighbours not approximated.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from kbweave.functions.text import STOPWORDS, collapse, empty_if_null, prefix_match, tokenize
from kbweave.operators.index import TextIndex, term_bucket

K1, B = 1.2, 0.75


@dataclass(frozen=True)
class Weights:
    """Boosts of fields, of the branches of the hybrid query, and of the final blend."""

    title: float = 3.0
    description: float = 1.5
    keywords: float = 2.0
    lexical: float = 2.2
    vector: float = 2.5
    final_lexical: float = 0.5
    final_vector: float = 0.5


@dataclass(frozen=True)
class SearchSettings:
    weights: Weights = Weights()
    broad: bool = False
    strict: bool = False
    strict_min_tokens: int = 4
    strict_min_hits: int = 1
    size: int = 25
    suggest_size: int = 15
    debug: bool = False  # a larger result list, for looking into a ranking
    candidate_factor: int = 10
    max_candidates: int = 10_000

    @property
    def shown(self) -> int:
        size = self.size or 25
        return max(3 * size, size + 10) if self.debug else size

    @property
    def neighbours(self) -> int:
        """k of the vector branch."""
        return max(self.size or 25, 10)

    @property
    def candidates(self) -> int:
        """How many neighbours an approximate index would look at; the exact search here looks at all."""
        return min(self.max_candidates, max(self.neighbours * self.candidate_factor, self.neighbours * 5))


def query_tokens(query: str) -> list[str]:
    return re.findall("[a-z0-9]+", query.lower())


def query_core_tokens(query: str, settings: SearchSettings) -> list[str]:
    tokens = query_tokens(query)
    if not settings.strict or len(tokens) < max(1, settings.strict_min_tokens):
        return []
    return list(dict.fromkeys(t for t in tokens if len(t) > 1 and t not in STOPWORDS))


def is_active(column: str = "is_active") -> Column:
    return F.coalesce(F.col(column), F.lit(True))


def metadata_filter(query: str, settings: SearchSettings = SearchSettings()) -> Column:
    """Whether a document has to do with the query at all; columns title, description, search_text, path, source_url, keywords, keywords_joined."""
    low = " ".join(query.lower().split())
    tokens = query_tokens(query)
    has = lambda f: F.arrays_overlap(tokenize(empty_if_null(F.col(f))), F.array(*[F.lit(t) for t in tokens])) if tokens else F.lit(False)
    clauses = [F.exists(tokenize(empty_if_null(F.col("keywords_joined"))), lambda t: F.contains(t, F.lit(low))), has("keywords_joined")]
    clauses += [F.array_contains("keywords", t) for t in low.split()]
    if settings.broad:
        clauses += [has("title"), has("description"), has("search_text")]
        clauses += [F.contains(F.lower(empty_if_null(F.col(f))), F.lit(low)) for f in ("path", "source_url")]
    out = clauses[0]
    for c in clauses[1:]:
        out = out | c
    core = query_core_tokens(query, settings)
    return F.coalesce(out, F.lit(False)) & (strict_filter(core, settings.strict_min_hits) if core else F.lit(True))


def strict_filter(core: list[str], min_hits: int = 1) -> Column:
    """At least so many core tokens in keywords, title, path or the path's words."""
    hits = F.lit(0)
    for t in core:
        hit = F.array_contains("keywords", t) | F.array_contains(tokenize(empty_if_null(F.col("title"))), t)
        for f in ("path", "parsed_url_path_text"):
            hit = hit | F.contains(F.lower(empty_if_null(F.col(f))), F.lit(t))
        hits = hits + F.coalesce(hit, F.lit(False)).cast("int")
    return hits >= min(max(1, min_hits), len(core))


def bm25(index: TextIndex, fields: dict[str, float], query: str, candidates: DataFrame | None = None) -> DataFrame:
    """(id, score): best field counts, score of a field = boost * sum over query terms. Reads the postings of the query's terms only.

    `candidates`(id) restricts the result, not the statistics.
    """
    terms = list(dict.fromkeys(query_tokens(query)))
    if not terms:
        return index.postings.limit(0).select(F.col("doc").alias("id"), F.lit(0.0).alias("score"))
    wanted = F.col("bucket").isin(*[term_bucket(F.lit(t), index.buckets) for t in terms]) & F.col("term").isin(*terms) & F.col("field").isin(*fields)
    return score_postings(index.postings.where(wanted).select("field", "term", "doc", "tf", "len"), index.stats, fields, candidates)


def score_postings(read: DataFrame, stats: DataFrame, fields: dict[str, float], candidates: DataFrame | None = None) -> DataFrame:
    """(id, score) from the postings of a query's terms and the statistics (field, n_docs, avg_len)."""
    # one row per query term and field
    weights = read.groupBy("field", "term").agg(F.count("*").alias("df")).join(F.broadcast(stats), "field")
    idf = F.log(F.lit(1.0) + (F.col("n_docs") - F.col("df") + 0.5) / (F.col("df") + 0.5))
    joined = read.join(F.broadcast(weights.select("field", "term", idf.alias("idf"), "avg_len")), ["field", "term"])
    # the classic numerator (k1 + 1) is a constant factor and is left out, as in current engines
    part = F.col("idf") * F.col("tf") / (F.col("tf") + F.lit(K1) * (F.lit(1 - B) + F.lit(B) * F.col("len") / F.col("avg_len")))
    if candidates is not None:
        joined = joined.join(candidates.select(F.col("id").alias("doc")), "doc", "left_semi")
    sums = joined.groupBy(F.col("doc").alias("id")).agg(*[F.sum(F.when(F.col("field") == f, part)).alias(f"__{i}") for i, f in enumerate(fields)])
    scores = [F.lit(boost) * F.coalesce(F.col(f"__{i}"), F.lit(0.0)) for i, boost in enumerate(fields.values())]
    return sums.select("id", (scores[0] if len(scores) == 1 else F.greatest(*scores)).alias("score")).where("score > 0")


def bm25_scan(docs: DataFrame, id_column: str, fields: dict[str, float], query: str, candidates: Column | None = None) -> DataFrame:
    """The same result for a table without an index, which is read twice: for the statistics and for the scores.

    One pass makes term frequencies and lengths per document (narrow rows, no text is shuffled); document frequencies and mean
    lengths are one row per field and are joined back by broadcast.
    """
    terms = list(dict.fromkeys(query_tokens(query)))
    one = docs.select(F.col(id_column).alias("id"), (candidates if candidates is not None else F.lit(True)).alias("__c"), *[tokenize(empty_if_null(F.col(f))).alias(f"__t_{f}") for f in fields])
    counted = one.select("id", "__c", *[F.size(f"__t_{f}").alias(f"__n_{f}") for f in fields], *[_count(f, t).alias(f"__tf_{f}_{i}") for f in fields for i, t in enumerate(terms)])
    stats = counted.agg(
        *[F.count_if(F.col(f"__n_{f}") > 0).alias(f"__N_{f}") for f in fields],
        *[F.avg(F.when(F.col(f"__n_{f}") > 0, F.col(f"__n_{f}"))).alias(f"__avg_{f}") for f in fields],
        *[F.count_if(F.col(f"__tf_{f}_{i}") > 0).alias(f"__df_{f}_{i}") for f in fields for i in range(len(terms))],
    ).first()

    def field_score(f: str, boost: float) -> Column:
        score = F.lit(0.0)
        mean = stats[f"__avg_{f}"] or 1.0
        for i in range(len(terms)):
            df = stats[f"__df_{f}_{i}"]
            idf = F.log(F.lit(1.0) + (F.lit(float(stats[f"__N_{f}"])) - df + 0.5) / F.lit(df + 0.5))
            tf = F.col(f"__tf_{f}_{i}").cast("double")
            norm = F.lit(K1) * (F.lit(1 - B) + F.lit(B) * F.col(f"__n_{f}") / F.lit(mean))
            score = score + idf * tf / (tf + norm)
        return F.lit(boost) * score

    # the classic numerator (k1 + 1) is a constant factor and is left out, as in current engines
    scores = [field_score(f, b) for f, b in fields.items()]
    best = scores[0] if len(scores) == 1 else F.greatest(*scores)
    return counted.where("__c").select("id", best.alias("score")).where("score > 0")


def _count(field: str, term: str) -> Column:
    return F.size(F.filter(f"__t_{field}", lambda t: t == term))


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, v: s + v)


def knn(docs: DataFrame, id_column: str, embedding: str, query: list[float], k: int, candidates: Column | None = None) -> DataFrame:
    """(id, score) of the k nearest by cosine, as (1 + cos) / 2; exact, filters before the dot product."""
    vector = F.array(*[F.lit(float(x)) for x in query])
    norm = F.sqrt(F.lit(sum(x * x for x in query)))
    chosen = docs.where(candidates) if candidates is not None else docs
    e = F.col(embedding)
    cosine = dot(e, vector) / (F.sqrt(dot(e, e)) * norm)
    return chosen.select(F.col(id_column).alias("id"), ((1 + cosine) / 2).alias("score")).orderBy(F.desc("score"), "id").limit(k)


def knn_queries(docs: DataFrame, queries: DataFrame, id_column: str, embedding: str, k: int, block: int = 512, most: int = 20_000) -> DataFrame:
    """(query, id, score): the k nearest rows of every row of `queries`(id, embedding), by cosine as (1 + cos) / 2, ties by id; exact.

    Queries and rows are packed into blocks of vectors, and each pair of blocks is one matrix product whose k best per query go on, so that what
    travels is blocks and short lists, never all pairs. A task keeps one list per query of the blocks that it meets, and passes its lists on where they
    are `most`; it looks at one pair of blocks at a time. Vectors must have one length.
    """
    packed = "ids array<bigint>, vectors binary, dims int"

    def pack(rows: DataFrame) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for at in range(0, batch.num_rows, block):
                    part = batch.slice(at, block)
                    vectors = np.asarray([np.asarray(v, np.float64) for v in part.column(1).to_pylist()])
                    vectors /= np.maximum(np.sqrt((vectors**2).sum(axis=1, keepdims=True)), 1e-300)
                    yield pa.RecordBatch.from_arrays([pa.array([part.column(0).to_pylist()], pa.list_(pa.int64())), pa.array([vectors.tobytes()]), pa.array([vectors.shape[1]], pa.int32())], ["ids", "vectors", "dims"])

        return rows.select(F.col(id_column).cast("long"), F.col(embedding)).where(F.col(embedding).isNotNull()).mapInArrow(run, packed)

    def best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[tuple[float, int]]] = {}
        for batch in batches:
            columns = [batch.column(c) for c in ("ids", "vectors", "dims", "q_ids", "q_vectors")]
            for at in range(batch.num_rows):
                ids, vectors, dims, q_ids, q_vectors = (c[at].as_py() for c in columns)
                score = np.frombuffer(q_vectors).reshape(-1, dims) @ np.frombuffer(vectors).reshape(-1, dims).T
                for q, row in zip(q_ids, score, strict=True):
                    near = np.flatnonzero(row >= np.partition(row, -k)[-k]) if len(row) > k else np.arange(len(row))
                    held[q] = sorted(held.get(q, []) + [(-float(row[j]), ids[j]) for j in near])[:k]
                if len(held) >= most:
                    yield listed(held)
                    held = {}
        if held:
            yield listed(held)

    def listed(held: dict[int, list[tuple[float, int]]]) -> pa.RecordBatch:
        rows = [(q, i, (1 - s) / 2) for q, found in held.items() for s, i in found]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (pa.int64(), pa.int64(), pa.float64()), strict=True)], ["query", "id", "score"])

    pairs = pack(docs).crossJoin(pack(queries).toDF("q_ids", "q_vectors", "q_dims")).drop("q_dims")
    rank = F.row_number().over(W.partitionBy("query").orderBy(F.desc("score"), "id"))
    return pairs.mapInArrow(best, "query bigint, id bigint, score double").withColumn("__r", rank).where(F.col("__r") <= k).drop("__r")


def fuse(lexical: DataFrame, vector: DataFrame, weights: Weights = Weights(), size: int = 25) -> DataFrame:
    """(id, raw_score, lexical_score, vector_score): boosted sum over the union of both branches."""
    both = lexical.withColumnRenamed("score", "l").join(vector.withColumnRenamed("score", "v"), "id", "full_outer")
    raw = F.lit(weights.lexical) * F.coalesce("l", F.lit(0.0)) + F.lit(weights.vector) * F.coalesce("v", F.lit(0.0))
    return both.select("id", raw.alias("raw_score"), F.coalesce("l", F.lit(0.0)).alias("lexical_score"), F.coalesce("v", F.lit(0.0)).alias("vector_score")).orderBy(F.desc("raw_score"), "id").limit(size)


def blend(hits: DataFrame, weights: Weights = Weights()) -> DataFrame:
    """Adds the normalised and calibrated components and the final score (0 to 100). The largest lexical score is taken over the
    hits, which are few, so that one window over them is one small task."""
    wl, wv = max(0.0, weights.final_lexical), max(0.0, weights.final_vector)
    if wl + wv <= 0:
        wl = wv = 0.5
    top = F.max("lexical_score").over(W.partitionBy(F.lit(1)))
    normal = F.when(F.col("__top") > 0, F.least(F.lit(1.0), F.greatest(F.lit(0.0), F.col("lexical_score") / F.col("__top")))).otherwise(0.0)
    cosine = 2.0 * F.col("vector_score") - 1.0
    calibrated = F.least(F.lit(1.0), F.greatest(F.lit(0.0), cosine))
    return hits.withColumn("__top", top).select("*", normal.alias("lexical_score_normalized"), cosine.alias("vector_score_cosine"), calibrated.alias("vector_score_calibrated"), (100.0 * (wl * normal + wv * calibrated) / (wl + wv)).alias("score")).drop("__top")


def explain_flags(query: str, title: Column, keywords: Column) -> list[Column]:
    """exact_match_bonus_applied and phrase_bonus_applied; reported, never added to the score."""
    q = " ".join(query.split()).lower()
    t = F.lower(F.trim(empty_if_null(title)))
    known = F.transform(keywords, lambda k: F.lower(F.trim(k)))
    exact = (t != "") & (t == q)
    phrase = F.lit(bool(q)) & (F.contains(t, F.lit(q)) | F.coalesce(F.array_contains(known, q), F.lit(False)))
    return [exact.alias("exact_match_bonus_applied"), phrase.alias("phrase_bonus_applied")]


def search(docs: DataFrame, query: str, query_vector: list[float] | None, settings: SearchSettings = SearchSettings(), id_column: str = "_id", index: TextIndex | None = None, encode: Callable[[list[str]], list[list[float]]] | None = None) -> DataFrame:
    """Ranked hits of a hybrid search with explained scores; blank queries give no rows.

    With `index` (of title, description and keywords_joined) the lexical branch reads postings instead of the table. Without a vector `encode`, a sentence
    model, makes it from the query; its length is set to one.
    """
    w, size = settings.weights, settings.shown
    if query_vector is None and encode is not None and query.strip():
        query_vector = encode_query(query, encode)
    wanted = is_active() & metadata_filter(query, settings) if query.strip() else F.lit(False)
    fields = {"title": w.title, "description": w.description, "keywords_joined": w.keywords}
    if index is not None:
        lexical = bm25(index, fields, query or "", docs.where(wanted).select(F.col(id_column).alias("id")))
    else:
        lexical = bm25_scan(docs, id_column, fields, query or "", wanted)
    vector = knn(docs, id_column, "embedding", query_vector, settings.neighbours, wanted) if query_vector else docs.limit(0).select(F.col(id_column).alias("id"), F.lit(0.0).alias("score"))
    hits = blend(fuse(lexical, vector, w, size), w)
    shown = [c for c in ("title", "description", "keywords", "source_url", "path") if c in docs.columns]
    return hits.join(docs.select(F.col(id_column).alias("id"), *shown), "id").select("*", *explain_flags(query, F.col("title"), F.col("keywords"))).orderBy(F.desc("score"), F.desc("raw_score"), "id")


def encode_query(query: str, encode: Callable[[list[str]], list[list[float]]]) -> list[float]:
    """The unit vector of a query by a sentence model."""
    vector = [float(x) for x in encode([query])[0]]
    size = sum(x * x for x in vector) ** 0.5
    return [x / size for x in vector] if size else vector


def suggest(docs: DataFrame, prefix: str, size: int = 15, id_column: str = "_id") -> DataFrame:
    """(suggestion, source_field, rank) for a typed prefix: titles of matching documents, keywords only where they match the typed words.

    A document matches if it has any of the whole words or a word that starts with the last one; it ranks by how many of them it has.
    """
    words = " ".join(prefix.lower().split()).split()
    bag = F.split(F.lower(F.concat_ws(" ", empty_if_null(F.col("title")), F.array_join("keywords", " "))), "[^a-z0-9]+")
    matched = F.lit(0)
    for i, w in enumerate(words):
        matched = matched + F.exists(bag, _starts(w) if i == len(words) - 1 else _equals(w)).cast("int")
    hits = docs.where(is_active() & (matched > 0)).select(F.col(id_column).alias("id"), matched.alias("m"), "title", "keywords").orderBy(F.desc("m"), "id").limit(max(3 * size, size + 8))
    return expand_suggestions(hits, words, size)


def expand_suggestions(hits: DataFrame, words: list[str], size: int) -> DataFrame:
    """(suggestion, source_field) of ranked hits (id, m, title, keywords): titles always, keywords where they match the typed words; each once, in the hits' order."""
    typed = F.array(*[F.lit(w) for w in words]) if words else F.array().cast("array<string>")
    fromkeys = F.transform(F.filter("keywords", lambda k: prefix_match(k, typed)), lambda k: F.struct(collapse(k).alias("suggestion"), F.lit("keywords").alias("source_field")))
    all_of = F.concat(F.array(F.struct(collapse(F.col("title")).alias("suggestion"), F.lit("title").alias("source_field"))), F.coalesce(fromkeys, F.array().cast("array<struct<suggestion:string,source_field:string>>")))
    each = hits.select("m", "id", F.posexplode(all_of).alias("pos", "s")).where("s.suggestion <> ''")
    first = each.groupBy(F.lower("s.suggestion").alias("low"), F.col("s.source_field").alias("source_field")).agg(F.min(F.struct((-F.col("m")).alias("o"), "id", "pos", F.col("s.suggestion").alias("suggestion"))).alias("f"))
    return first.select(F.col("f.suggestion").alias("suggestion"), "source_field", F.col("f.o").alias("o"), F.col("f.id").alias("id"), F.col("f.pos").alias("pos")).orderBy("o", "id", "pos").limit(size).select("suggestion", "source_field")


def _starts(word: str):
    return lambda t: F.startswith(t, F.lit(word))


def _equals(word: str):
    return lambda t: t == word

