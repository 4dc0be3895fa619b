"""Hierarchical multi-length packing.

A document's token ids (end id appended) are cut into whole windows of the longest context and one remainder. The remainders are
routed to context tiers by length, every tier is packed, the gaps of long windows are filled from the shorter tiers first, and
what is left of the short tiers' windows is nested into long windows. All of that works on the histogram of lengths, which
has at most as many rows as the context has tokens, so that the plan on the driver does not grow with the corpus; each piece then finds its
place by its rank among the pieces of its length. Sequences are numbered from the fullest to the emptiest and dealt to step groups in turn, so that every group gets
the same mix of tiers and the tokens of two groups differ by less than one sequence.

Defined results: a null text is an empty one and is the end id alone. Repeated rows are packed as often as they occur. An empty table gives no rows.
"""

from __future__ import annotations

import re
import struct
import zlib
from bisect import bisect_left, insort
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kbweave.llm.common import bounded_batches, materialize


@dataclass(frozen=True)
class Packing:
    tokenizer: str | None = None  # path of a tokenizer file; None: word_bpe_49k.json of public_tokenizers
    end_id: int = 2
    context: int = 4096
    tiers: tuple[int, ...] = (4096, 2048, 1024, 512)
    step_group: int = 64  # full sequences' worth of tokens that one optimizer step takes
    max_broadcast: int = 200_000  # (task, length) counts that travel to every executor; more are joined by shuffle
    cache_words: int = 1_000_000  # of a Python worker; about 200 bytes each


# Latin text whose pieces can be found here; anything else takes the tokenizer's own path.
_L = "a-zªµºß-öø-įı-ňŊ-ǃǆǉǌ-ǯǰǳ-ǵǸ-ɏ"
_N = "0-9²³¹¼-¾"
#: Fixed: the split pattern of the tokenizer file, spelled out for lower-case Latin text.
PIECE = re.compile(f"[{_L}]+|'(?:s|t|re|ve|m|ll|d)|[{_N}]|[^{_L}{_N}]+")
PLAIN = re.compile("[\\x00-\\x1b\\x20-\\u012f\\u0131-\\u0148\\u014a-\\u01c3\\u01cd-\\u01ef\\u01f8-\\u024f]*")


class WordEncoder:
    """Token ids as little-endian uint32 bytes, by a bounded cache of words; equal to the tokenizer's own output."""

    def __init__(self, settings: Packing):
        from tokenizers import Tokenizer

        path = settings.tokenizer
        if path is None:
            import public_tokenizers

            path = public_tokenizers.path("word_bpe_49k.json")
        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.limit = settings.cache_words
        # byte-level alphabet: visible bytes stand for themselves, the others for the code points from 256 on
        hidden = [b for b in range(256) if not (33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255)]
        self.shown = [chr(256 + hidden.index(b)) if b in hidden else chr(b) for b in range(256)]
        self.words: dict[str, bytes] = {}

    def encode(self, text: str) -> bytes:
        if "<|" in text or not PLAIN.fullmatch(text):
            return np.asarray(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        words = text.lower().split()
        try:
            return b"".join(map(self.words.__getitem__, words))
        except KeyError:
            if len(self.words) > self.limit:
                self.words.clear()
            for word in words:
                if word not in self.words:
                    ids = [t.id for part in PIECE.findall(word) for t in self.model.tokenize(part if part.isascii() and part.isprintable() else "".join(map(self.shown.__getitem__, part.encode())))]
                    self.words[word] = struct.pack(f"<{len(ids)}I", *ids)
            return b"".join(map(self.words.__getitem__, words))


#: One encoder per Python worker and setting; workers are reused by later tasks, and so is the cache.
_ENCODERS: dict[Packing, WordEncoder] = {}


def encoder_of(settings: Packing) -> WordEncoder:
    if settings not in _ENCODERS:
        _ENCODERS[settings] = WordEncoder(settings)
    return _ENCODERS[settings]


def pieces(docs: DataFrame, id_column: str, text: str, settings: Packing) -> DataFrame:
    """One row per piece: id, start, length, ids_crc32, doc_tokens and the piece's rank among those of its length in its task."""
    bounded_batches(docs.sparkSession)
    given = docs.select(F.col(id_column).alias("doc_id"), F.col(text).alias("text"))
    longs = ("start", "length", "ids_crc32", "doc_tokens", "shard", "rank")
    schema = T.StructType([given.schema["doc_id"], *[T.StructField(n, T.LongType()) for n in longs]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        encoder, seen, shard = encoder_of(settings), Counter(), TaskContext.get().partitionId()
        end, step = np.asarray([settings.end_id], "<u4").tobytes(), 4 * settings.context
        for batch in batches:
            rows, at = [], []
            for k, value in enumerate(batch.column(1).to_pylist()):
                ids = (encoder.encode(value) if value else b"") + end
                for start in range(0, len(ids), step):
                    part = ids[start : start + step]
                    n = len(part) // 4
                    rows.append((start // 4, n, zlib.crc32(part), len(ids) // 4, shard, seen[n]))
                    seen[n] += 1
                    at.append(k)
            if rows:
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(at)), *map(pa.array, zip(*rows, strict=True))], ["doc_id", *longs])

    return given.mapInArrow(run, schema)


class Plan:
    """Windows as patterns: so many equal sequences, each with the same lengths at the same offsets."""

    def __init__(self, histogram: dict[int, int], settings: Packing = Packing()):
        self.context = settings.context
        self.open: dict[int, list[tuple[int, tuple[tuple[int, int], ...], int]]] = {}
        self.gaps: list[int] = []
        for k, tier in enumerate(settings.tiers):
            lower = settings.tiers[k + 1] if k + 1 < len(settings.tiers) else 0
            for length in sorted((n for n in histogram if lower < n <= tier), reverse=True):
                self._place(length, ((length, 0),), histogram[length], tier)
        self._nest()

    def _put(self, gap: int, many: int, slots: tuple[tuple[int, int], ...], size: int) -> None:
        if many:
            if gap not in self.open:
                self.open[gap] = []
                insort(self.gaps, gap)
            self.open[gap].append((many, slots, size))

    def _place(self, need: int, slots: tuple[tuple[int, int], ...], many: int, tier: int) -> None:
        """Into the tightest gaps first, then into new windows of the tier."""
        while many and (k := bisect_left(self.gaps, need)) < len(self.gaps):
            gap = self.gaps[k]
            have, held, size = self.open[gap].pop()
            if not self.open[gap]:
                del self.open[gap], self.gaps[k]
            used = size - gap
            times = max(1, min(gap // need, many // have))
            take = min(have, many // times)
            added = tuple((n, used + t * need + o) for t in range(times) for n, o in slots)
            self._put(gap - times * need, take, held + added, size)
            self._put(gap, have - take, held, size)
            many -= take * times
        if many:
            times = max(1, min(tier // need, many))
            full, rest = divmod(many, times)
            for count, t in ((full, times), (min(rest, 1), rest)):
                if count:
                    self._put(tier - t * need, count, tuple((n, j * need + o) for j in range(t) for n, o in slots), tier)

    def _nest(self) -> None:
        """Short windows that a power of two does not fill go into the long windows, longest first."""
        used = lambda slots: max(o + n for n, o in slots)
        held = [x for gap in self.gaps for x in self.open[gap]]
        short = [x for x in held if x[2] < self.context]
        exact = [x for x in short if (n := used(x[1])) & (n - 1) == 0]
        self.open = {}
        self.gaps = []
        for many, slots, size in held:
            if size == self.context:
                self._put(size - used(slots), many, slots, size)
        for many, slots, _ in sorted((x for x in short if x not in exact), key=lambda x: -used(x[1])):
            self._place(used(slots), slots, many, self.context)
        done = [x for gap in self.gaps for x in self.open[gap]] + exact
        self.patterns = sorted(((many, slots, used(slots)) for many, slots, _ in done), key=lambda x: -x[2])

    def padded(self, size: int) -> int:
        """The context that a sequence of `size` tokens is padded to: none at a power of two."""
        return size if size & (size - 1) == 0 else self.context

    def slots(self) -> dict[str, np.ndarray]:
        """Slots by length and rank: the first rank of a slot's run, the first sequence of its pattern, the offset and the sequence's context."""
        runs: list[tuple[int, int, int, int, int]] = []
        first = 0
        for many, held, size in self.patterns:
            runs += [(length, first, many, offset, self.padded(size)) for length, offset in held]
            first += many
        runs.sort()
        seen, out = Counter(), []
        for length, sequence, many, offset, context in runs:
            out.append((length, seen[length], sequence, offset, context))
            seen[length] += many
        cols = np.asarray(out, np.int64).reshape(-1, 5).T
        return dict(zip(("length", "rank", "sequence", "offset", "context"), cols, strict=True))


def pack(docs: DataFrame, id_column: str = "doc_id", text: str = "text", settings: Packing = Packing()) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, context (the tier that the sequence is padded to) and step_group.

    Other columns of docs are left out; the id column comes out as doc_id, whatever its name.
    """
    cut = materialize(pieces(docs, id_column, text, settings), "pieces")
    counts = materialize(cut.groupBy("shard", "length").agg(F.count("*").alias("n")), "piece-counts")
    histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    plan = Plan(histogram, settings)
    slots = plan.slots()
    tokens = sum(many * plan.padded(size) for many, _, size in plan.patterns)
    groups = max(1, -(-tokens // (settings.step_group * settings.context)))
    before = W.partitionBy("length").orderBy("shard").rowsBetween(W.unboundedPreceding, -1)
    starts = counts.select("shard", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    few = counts.count() <= settings.max_broadcast
    ranked = cut.join(F.broadcast(starts) if few else starts, ["shard", "length"]).select("doc_id", "start", "length", "ids_crc32", "doc_tokens", (F.col("first") + F.col("rank")).alias("rank"))
    names = ("sequence_id", "offset", "context", "step_group")
    kept = ranked.columns[:-1]
    schema = T.StructType([*ranked.schema.fields[:-1], *[T.StructField(n, T.LongType()) for n in names]])
    # (length, rank) as one sortable number; ranks stay far below 2**48
    keys = (slots["length"] << 48) + slots["rank"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, rank = (np.asarray(batch.column(n)) for n in ("length", "rank"))
            at = np.searchsorted(keys, (length << 48) + rank, "right") - 1
            sequence = slots["sequence"][at] + rank - slots["rank"][at]
            made = [sequence, slots["offset"][at], slots["context"][at], sequence % groups]
            yield pa.RecordBatch.from_arrays([*[batch.column(n) for n in kept], *map(pa.array, made)], [*kept, *names])

    return ranked.mapInArrow(run, schema)
