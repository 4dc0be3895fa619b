"""Chunking of page bodies: blocks, pieces that fit, greedy packing with overlap."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kbweave.functions.text import WS, collapse, content_hash, join_present, let, normalize_body, split_blocks, strip
from kbweave.functions.urls import doc_id, path_text

CHUNK_SIZE = 1200
CHUNK_OVERLAP = 200
JOINER = "\n\n"


def effective_overlap(size: int, overlap: int) -> int:
    """An overlap that would swallow the chunk becomes a sixth of it."""
    return overlap if 0 <= overlap < size else size // 6


def fit_blocks(blocks: Column, size: int = CHUNK_SIZE) -> Column:
    """Blocks of which none is longer than `size`: a longer one is cut at the last space that leaves the piece within the size, else hard. A pattern does it inside the JVM."""
    start = WS.replace("[", "[^", 1)
    piece = f"(?s){start}.{{0,{size - 1}}}(?= |\\z)|{start}.{{0,{size - 1}}}"
    pieces = lambda b: F.filter(F.transform(F.regexp_extract_all(b, F.lit(piece), F.lit(0)), strip), lambda p: p != "")
    return F.flatten(F.transform(blocks, lambda b: F.when(F.length(b) > size, pieces(b)).otherwise(F.array(b))))


def pack_blocks(parts: Column, size: int = CHUNK_SIZE, overlap: int = CHUNK_OVERLAP) -> Column:
    """Greedy fold: parts join a chunk while it stays within `size`; a full chunk hands its last parts of up to `overlap` characters on.

    The overlap is emitted alone where the next part does not fit behind it, unless it equals the chunk before.
    """
    text = lambda ps: F.array_join(ps, JOINER)
    nothing = F.array().cast("array<string>")
    gap = len(JOINER)
    # the open parts carry their joined length, so that a step measures the new part alone
    state = F.struct(nothing.alias("done"), nothing.alias("open"), F.lit(0).alias("n"))

    def grow(done: Column, open_parts: Column, n: Column) -> Column:
        return F.struct(done.alias("done"), open_parts.alias("open"), n.alias("n"))

    def joined(open_parts: Column, n: Column, m: Column) -> Column:
        """The length after a part of m characters."""
        return n + m + F.when(F.size(open_parts) > 0, gap).otherwise(0)

    def tail(open_parts: Column) -> Column:
        """The longest suffix of parts that is at most `overlap` characters long, joiners included, and its length."""
        taken = F.struct(F.lit(0).alias("k"), F.lit(0).alias("n"), F.lit(True).alias("open"))

        def take(t: Column, p: Column) -> Column:
            more = t["n"] + F.length(p) + F.when(t["k"] > 0, gap).otherwise(0)
            fits = t["open"] & (more <= overlap)
            return F.struct(F.when(fits, t["k"] + 1).otherwise(t["k"]).alias("k"), F.when(fits, more).otherwise(t["n"]).alias("n"), fits.alias("open"))

        return let(F.aggregate(F.reverse(open_parts), taken, take), lambda t: F.struct(F.slice(open_parts, F.size(open_parts) - t["k"] + 1, t["k"]).alias("parts"), t["n"].alias("n")))

    def after_flush(done: Column, carried: Column, part: Column, m: Column) -> Column:
        parts = carried["parts"]
        alone = F.when((F.size(parts) > 0) & ~F.coalesce(F.element_at(done, -1) == text(parts), F.lit(False)), F.concat(done, F.array(text(parts)))).otherwise(done)
        return F.when(joined(parts, carried["n"], m) <= size, grow(done, F.concat(parts, F.array(part)), joined(parts, carried["n"], m))).otherwise(grow(alone, F.array(part), m))

    def step(s: Column, part: Column) -> Column:
        def with_length(m: Column) -> Column:
            total = joined(s["open"], s["n"], m)
            flushed = F.concat(s["done"], F.array(text(s["open"])))
            carried = tail(s["open"]) if overlap > 0 else F.struct(nothing.alias("parts"), F.lit(0).alias("n"))
            return (
                F.when(total <= size, grow(s["done"], F.concat(s["open"], F.array(part)), total))
                .when(F.size(s["open"]) == 0, grow(s["done"], F.array(part), m))
                .otherwise(let(F.struct(flushed.alias("done"), carried.alias("carried")), lambda f: after_flush(f["done"], f["carried"], part, m)))
            )

        return let(F.length(part), with_length)

    return F.aggregate(parts, state, step, lambda s: F.when(F.size(s["open"]) > 0, F.concat(s["done"], F.array(text(s["open"])))).otherwise(s["done"]))


def chunk_text(body: Column, size: int = CHUNK_SIZE, overlap: int = CHUNK_OVERLAP) -> Column:
    return pack_blocks(fit_blocks(split_blocks(normalize_body(body)), size), size, effective_overlap(size, overlap))


def explode_chunks(pages: DataFrame, body: str, normalized_url: str, size: int = CHUNK_SIZE, overlap: int = CHUNK_OVERLAP) -> DataFrame:
    """One row per chunk: chunk_index, chunk_count, chunk, parent_doc_id, chunk_hash, doc_id; pages without text give none.

    The fold walks over parts once for each page, so that a page is one row of work whatever its length.
    """
    prepared = pages.withColumn("__parts", fit_blocks(split_blocks(normalize_body(F.col(body))), size))
    chunked = prepared.withColumn("__chunks", pack_blocks(F.col("__parts"), size, effective_overlap(size, overlap))).drop("__parts")
    counted = chunked.withColumn("chunk_count", F.size("__chunks"))
    each = counted.select("*", F.posexplode("__chunks").alias("chunk_index", "chunk")).drop("__chunks")
    hashed = each.withColumn("parent_doc_id", doc_id(F.col(normalized_url))).withColumn("chunk_hash", content_hash(F.col("chunk")))
    return hashed.withColumn("doc_id", F.sha2(F.concat_ws(":", "parent_doc_id", F.col("chunk_index").cast("string"), "chunk_hash"), 256))


def embedding_text(title: Column, description: Column, keywords: Column, path_or_url: Column, chunk: Column | None = None) -> Column:
    """Non-empty parts, one a line."""
    parts = [collapse(title), collapse(description), F.array_join(keywords, " "), path_text(path_or_url), *([collapse(chunk)] if chunk is not None else [])]
    return join_present("\n", *parts)
