"""Benchmark decontamination with DataFrame functions only.

The benchmark's 13-word windows are few and their number is checked: up to `max_windows` of them travel inside the plan as hash
sets. A document's words are scanned once; at every position a hash of the first, middle and last word of the window is looked up
in a hash set, survivors are compared by the hash of the whole window and at last by the window's text. No document is shuffled. A larger
benchmark takes the other path: its distinct anchor hashes, up to `max_broadcast` of 8 bytes, travel to every executor, positions of documents, as narrow rows, pass through them
where they lie, and only positions that pass are shuffled, cut into windows and verified by hash and text. Beyond `max_broadcast` positions and anchors meet by shuffle.

Words are `[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+` of the text with A-Z lower-cased. An item with fewer than 13 words, but not none, is one
window. Defined results: a null or empty text has no words and no hits; equal items are items of their own; null items have no windows;
an empty benchmark contaminates nothing; repeated rows are judged one by one.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kbweave.llm.common import materialize

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SEPARATOR = "[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"


@dataclass(frozen=True)
class Decontamination:
    window: int = 13
    max_windows: int = 50_000  # more do not travel inside the plan
    max_broadcast: int = 4_000_000  # anchor hashes that travel to every executor; more are joined by shuffle
    max_places: int = 200_000  # positions with a known anchor that travel back to the texts; beyond that texts and positions meet by shuffle
    percent: int = 5  # of the words that must be hit


def words_of(text: Column) -> Column:
    return F.filter(F.split(F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER), SEPARATOR), lambda w: w != "")


def bind(value: Column, body) -> Column:
    """body(value) with value computed once, however often body names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def anchor(words: Column, start: Column, n: int) -> Column:
    return F.xxhash64(F.get(words, start), F.get(words, start + n // 2), F.get(words, start + (n - 1)))


def windows(items: DataFrame, settings: Decontamination) -> DataFrame:
    """(n, words, item_ids) for each distinct window of the benchmark."""
    n = F.least(F.size("w"), F.lit(settings.window))
    cut = items.select(F.col("item_id").cast("string").alias("item_id"), words_of(F.col("text")).alias("w")).where(F.size("w") > 0)
    each = cut.select("item_id", n.alias("n"), F.explode(F.transform(F.sequence(F.lit(1), F.size("w") - n + 1), lambda s: F.slice("w", s, n))).alias("words"))
    return each.groupBy("n", "words").agg(F.collect_set("item_id").alias("item_ids"))


def _hits_in_plan(words: Column, listed: list, n: int) -> Column:
    """array<struct<start,n,item_ids>> of the verified windows of n words in one document."""
    if not listed:
        return F.array().cast("array<struct<start:int,n:int,item_ids:array<string>>>")
    anchors = sorted({r["anchor"] for r in listed})
    # one literal each, folded to an array when the plan is optimized
    column = lambda values: F.split(F.lit("\n".join(values)), "\n")
    hashes = column([str(r["hash"]) for r in listed]).cast("array<bigint>")
    texts = column([" ".join(r["words"]) for r in listed])
    ids = column([",".join(r["item_ids"]) for r in listed])
    last = F.size(words) - n

    def verified(start: Column) -> Column:
        gram = F.slice(words, start + 1, n)
        return bind(
            F.array_position(hashes, F.xxhash64(gram)),
            lambda at: F.when((at > 0) & (F.get(texts, at.cast("int") - 1) == F.array_join(gram, " ")), F.struct(start.cast("int").alias("start"), F.lit(n).alias("n"), F.split(F.get(ids, at.cast("int") - 1), ",").alias("item_ids"))),
        )

    near = F.filter(F.sequence(F.lit(0), last), lambda s: anchor(words, s, n).isin(anchors))
    found = F.filter(F.transform(near, verified), lambda x: x.isNotNull())
    return F.when(last >= 0, found).otherwise(F.array().cast("array<struct<start:int,n:int,item_ids:array<string>>>"))


def _summary(words: Column, hits: Column, percent: int) -> Column:
    places = F.array_distinct(F.flatten(F.transform(hits, lambda h: F.sequence(h["start"], h["start"] + h["n"] - 1))))
    items = F.array_sort(F.array_distinct(F.flatten(F.transform(hits, lambda h: h["item_ids"]))))
    return F.struct(F.size(words).cast("long").alias("n_words"), places.alias("hit_words"), items.alias("items"))


def _finish(found: DataFrame, out: str, percent: int) -> DataFrame:
    s = F.col(f"{out}.n_words"), F.size(f"{out}.hit_words").cast("long"), F.col(f"{out}.items")
    full = F.struct(
        s[0].alias("n_words"),
        s[1].alias("n_hit"),
        F.size(s[2]).cast("long").alias("n_items"),
        F.sha2(F.array_join(s[2], ","), 256).alias("items_sha256"),
        ((s[1] > 0) & (100 * s[1] >= percent * s[0])).alias("contaminated"),
        s[2].alias("items"),
        F.col(f"{out}.hit_words").alias("hit_words"),
    )
    return found.withColumn(out, full)


def find_contamination(docs: DataFrame, benchmark: DataFrame, text: str = "text", out: str = "contamination", settings: Decontamination = Decontamination()) -> DataFrame:
    """docs plus the struct `out`: n_words, n_hit, n_items, items_sha256, contaminated, items, hit_words (0-based positions)."""
    made = windows(benchmark.select("item_id", "text"), settings)
    hashed = made.select("n", "words", "item_ids", F.xxhash64("words").alias("hash"), F.xxhash64(F.get("words", F.lit(0)), F.get("words", (F.col("n") / 2).cast("int")), F.get("words", F.col("n") - 1)).alias("anchor"))
    listed = hashed.limit(settings.max_windows + 1).collect()
    plain = docs.select(*[F.col(f"`{c}`") for c in docs.columns if c.lower() != out.lower()])
    if len(listed) > settings.max_windows or len({(r["n"], r["hash"]) for r in listed}) < len(listed) or any("," in i or "\n" in i for r in listed for i in r["item_ids"]):
        return _by_join(plain, hashed, text, out, settings)
    listed.sort(key=lambda r: (r["n"], r["words"]))
    sizes = sorted({r["n"] for r in listed})

    def judge(words: Column) -> Column:
        hits = F.concat(*[_hits_in_plan(words, [r for r in listed if r["n"] == n], n) for n in sizes]) if sizes else _hits_in_plan(words, [], settings.window)
        return bind(hits, lambda h: _summary(words, h, settings.percent))

    return _finish(plain.withColumn(out, bind(words_of(F.col(f"`{text}`")), judge)), out, settings.percent)


def _by_join(docs: DataFrame, hashed: DataFrame, text: str, out: str, settings: Decontamination) -> DataFrame:
    """The same result for benchmarks of any size; documents meet their hits by the text's digest, so that copies are looked up once."""
    key = F.sha2(F.coalesce(F.col(f"`{text}`"), F.lit("")), 256)
    keyed = docs.withColumn("__key", key)
    made = materialize(hashed, "benchmark-windows")
    anchors = materialize(made.select("n", "anchor").distinct(), "benchmark-anchors")
    sizes = sorted(r["n"] for r in anchors.select("n").distinct().collect())
    send = F.broadcast if anchors.count() <= settings.max_broadcast else (lambda df: df)
    worded = keyed.select("__key", words_of(F.col(f"`{text}`")).alias("w"))

    def places(n: int) -> DataFrame:
        """(key, start, n) of the positions whose anchor some window has; the words themselves are not carried along."""
        each = worded.where(F.size("w") >= n).select("__key", F.posexplode(bind(F.col("w"), lambda w: F.transform(F.sequence(F.lit(0), F.size(w) - n), lambda s: anchor(w, s, n)))).alias("start", "anchor"))
        return each.join(send(anchors.where(F.col("n") == n).select("anchor")), "anchor", "left_semi").select("__key", "start", F.lit(n).alias("n"))

    none = F.array().cast("array<struct<start:int,n:int,item_ids:array<string>>>")
    if sizes:
        near = materialize(reduce(DataFrame.unionByName, map(places, sizes)).distinct().groupBy("__key").agg(F.collect_list(F.struct("start", "n")).alias("at")), "anchor-hits")
        few = (near.agg(F.sum(F.size("at"))).first()[0] or 0) <= settings.max_places
        cut = F.transform("at", lambda a: F.struct(a["start"].alias("start"), a["n"].alias("n"), F.slice("w", a["start"] + 1, a["n"]).alias("gram")))
        grams = worded.join(F.broadcast(near) if few else near, "__key").select("__key", F.explode(cut).alias("g")).select("__key", "g.*").withColumn("hash", F.xxhash64("gram"))
        found = grams.dropDuplicates(["__key", "start", "n"]).join(made, ["n", "hash"]).where(F.col("gram") == F.col("words"))
        hits = found.groupBy("__key").agg(F.collect_list(F.struct(F.col("start").cast("int").alias("start"), F.col("n"), "item_ids")).alias("__hits"))
        joined = keyed.join(F.broadcast(hits) if few else hits, "__key", "left")
    else:
        joined = keyed.withColumn("__hits", none)
    judged = joined.withColumn(out, bind(words_of(F.col(f"`{text}`")), lambda w: _summary(w, F.coalesce("__hits", none), settings.percent)))
    return _finish(judged.drop("__key", "__hits"), out, settings.percent)


def remove_documents(docs: DataFrame, benchmark: DataFrame, text: str = "text", settings: Decontamination = Decontamination()) -> DataFrame:
    """docs without the contaminated ones; the columns stay as they were."""
    found = find_contamination(docs, benchmark, text, "__contamination", settings)
    return found.where(~F.col("__contamination.contaminated")).select(*[F.col(f"`{c}`") for c in docs.columns])


def remove_spans(docs: DataFrame, benchmark: DataFrame, text: str = "text", settings: Decontamination = Decontamination()) -> DataFrame:
    """docs with the hit words, and what separates them from the next word, cut out of the text; all rows stay."""
    found = find_contamination(docs, benchmark, text, "__contamination", settings)
    source = F.col(f"`{text}`")
    # A-Z are lower-cased before words are cut, so upper-case letters belong to words here
    cased = SEPARATOR.replace("\\x3A-\\x60", "\\x3A-\\x40\\x5B-\\x60")
    word = "[^" + cased[1:-2] + "]+"
    kept = bind(
        F.regexp_extract_all(source, F.lit(f"({word})({cased[:-1]}*)"), F.lit(0)),
        lambda parts: F.array_join(F.filter(parts, lambda _, i: ~F.array_contains("__contamination.hit_words", i)), ""),
    )
    lead = F.regexp_extract(source, f"^({cased[:-1]}*)", 1)
    clean = F.when(F.col("__contamination.n_hit") > 0, F.concat(lead, kept)).otherwise(source)
    return found.select(*[clean.alias(c) if c.lower() == text.lower() else F.col(f"`{c}`") for c in docs.columns])
