"""Alignment of two tokenizers' tokens over the same bytes by a sweep over their end events.

Every token is an event at its end offset. One pass over the texts emits the events of both tokenizers, packed by side and window of bytes (ids only: the lengths follow from the vocabularies);
the union is repartitioned by document and sorted by offset within partitions, and a machine streams through it. Its state is the events since the last offset at which tokens
of both sides end: at such an offset a group closes. Within a group every stretch between neighbouring ends of either side is one link of the two tokens around it, since both sides tile the same bytes.

Words are tokenized once per Python worker and looked up after that; a text in which words and white space do not part cleanly is tokenized whole. Both ways give the tokenizers' own output, whose
bytes are compared with the text.

Counts of id pairs are how many documents hold a pair linked. They go back to the documents' pairs by broadcast where they are counted as few, else by a join in which pairs of very many documents are salted.

Defined results: texts that are null or empty, or that one side does not reproduce byte by byte, have no tokens, no groups and no links. Repeated rows are documents of their own, whatever their
ids. An empty table gives no rows; columns other than id and text are left out. Memory of the machine is one window of both sides, one group, and a document's distinct id pairs.
"""

from __future__ import annotations

import hashlib
import re
from array import array
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kbweave.llm.common import bounded_batches, materialize, salted_join


@dataclass(frozen=True)
class Settings:
    a: str | None = None  # path of a byte-level BPE file; None: byte_bpe_50k.json of public_tokenizers
    b: str | None = None  # path of a piece model with byte fallback; None: piece_bpe_32k.model
    window: int = 1 << 16  # bytes of text whose events travel as one row per side
    cache_bytes: int = 96 << 20  # of words held by a Python worker
    max_broadcast: int = 2_000_000  # id pairs that travel to every executor
    salted: int = 1_000_000  # documents of an id pair per salt


class Tokenizers:
    """Ids of texts by both tokenizers, equal to their own output, and the bytes of every id.

    Words with the space in front part cleanly on both sides: a white-space run before a word ends before its last character, and no piece has a space after another character. So words are
    tokenized once, held as indices into flat arrays of ids, and gathered; texts in which a space inside a run would be cut, or whose words lack a single space in front, are tokenized whole.
    """

    #: A space that the byte side does not cut at, or that the piece side does not keep with one word.
    MIXED = re.compile(r"\s (?!\S)|  | $|▁")

    def __init__(self, settings: Settings):
        import public_tokenizers
        from sentencepiece import SentencePieceProcessor

        self.encode_a, first = byte_level(settings.a or public_tokenizers.path("byte_bpe_50k.json"))
        model = SentencePieceProcessor(model_file=settings.b or public_tokenizers.path("piece_bpe_32k.model"))
        pieces = [model.id_to_piece(k) for k in range(model.get_piece_size())]
        self.encode_b = lambda texts: model.encode(texts, num_threads=1)
        self.token = first, [bytes([int(p[3:5], 16)]) if model.is_byte(k) else p.replace("▁", " ").encode() for k, p in enumerate(pieces)]
        self.whole_only = any(re.search("[^▁]▁", p) for p in pieces)
        self.limit = settings.cache_bytes
        self.clear()

    def clear(self) -> None:
        self.words: dict[str, int] = {}
        self.held = 0
        self.flat = [array("I"), array("I")]
        self.count = [array("I"), array("I")]
        self.good = bytearray()
        self.views: list[tuple[np.ndarray, np.ndarray, np.ndarray]] | None = None

    def same(self, side: int, ids: list[int], text: str) -> bool:
        return b"".join(map(self.token[side].__getitem__, ids)) == b" " + text.encode()

    def learn(self, new: list[str]) -> None:
        self.views = None
        for word, *both in zip(new, self.encode_a([" " + w for w in new]), self.encode_b(new), strict=True):
            self.words[word] = len(self.good)
            self.good.append(all(self.same(side, ids, word) for side, ids in enumerate(both)))
            for side, ids in enumerate(both):
                self.flat[side].extend(ids)
                self.count[side].append(len(ids))
            self.held += 220 + len(word) + 4 * sum(map(len, both))

    def gather(self, index: np.ndarray) -> list[np.ndarray]:
        if self.views is None:
            self.views = []
            for flat, count in zip(self.flat, self.count, strict=True):
                n = np.asarray(count, np.int64)
                self.views.append((np.asarray(flat, np.uint32), n, np.cumsum(n) - n))
        out = []
        for flat, count, start in self.views:
            n = count[index]
            ends = np.cumsum(n)
            out.append(flat[np.arange(ends[-1]) + np.repeat(start[index] - ends + n, n)])
        return out

    def whole(self, text: str) -> list[np.ndarray] | None:
        both = self.encode_a([" " + text])[0], self.encode_b([text])[0]
        return [np.asarray(ids, np.uint32) for ids in both] if all(self.same(side, ids, text) for side, ids in enumerate(both)) else None

    def __call__(self, texts: list[str | None], segment: int = 1 << 20) -> Iterator[list[np.ndarray] | None]:
        """Ids of each text by both sides; None for a text without tokens. Words are learnt for many short texts at once, long texts go by segments that end before a space."""
        at = 0
        while at < len(texts):
            size, last = 0, at
            while last < len(texts) and (last == at or size + len(texts[last] or "") <= segment):
                size += len(texts[last] or "")
                last += 1
            yield from self.several(texts[at:last], segment)
            at = last

    def several(self, texts: list[str | None], segment: int) -> Iterator[list[np.ndarray] | None]:
        if len(texts) == 1 and texts[0] and len(texts[0]) > segment and not self.mixed(texts[0]):
            text, at, parts = texts[0], 0, []
            while at <= len(text):
                end = text.find(" ", at + segment)
                end = len(text) if end < 0 else end
                parts.append(next(self.several([text[at:end]], 2 * len(text))))
                at = end + 1
            yield None if any(p is None for p in parts) else [np.concatenate(side) for side in zip(*parts, strict=True)]
            return
        if self.held > self.limit:
            self.clear()
        split = [t.split(" ") if t and not self.mixed(t) else None for t in texts]
        new = [w for w in dict.fromkeys(w for ws in split if ws for w in ws) if w not in self.words]
        if new:
            self.learn(new)
        good = np.frombuffer(bytes(self.good), np.uint8)
        for text, words in zip(texts, split, strict=True):
            if words is None:
                yield self.whole(text) if text else None
                continue
            index = np.fromiter(map(self.words.__getitem__, words), np.int64, len(words))
            yield self.gather(index) if good[index].all() else None

    def mixed(self, text: str) -> bool:
        return self.whole_only or self.MIXED.search(" " + text) is not None


def byte_level(path: str) -> tuple[Callable[[list[str]], list[list[int]]], list[bytes]]:
    """An encoder of texts and the bytes of each id, from a byte-level BPE file. Where every merge makes the next id, ids are ranks, and the rank form of the same vocabulary encodes it faster; else the file's own tokenizer does."""
    import json

    import tiktoken
    from public_tokenizers import PATTERN
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = True
    hidden = [b for b in range(256) if not (33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255)]
    byte = {chr(256 + hidden.index(b)) if b in hidden else chr(b): b for b in range(256)}
    vocabulary = tokenizer.get_vocab(with_added_tokens=True)
    token = [b""] * (max(vocabulary.values()) + 1)
    for piece, k in vocabulary.items():
        token[k] = bytes(byte[c] for c in piece) if all(c in byte for c in piece) else piece.encode()
    made = json.loads(tokenizer.to_str())
    pairs = [m.split(" ") if isinstance(m, str) else m for m in made["model"]["merges"]]
    own = made["model"]["vocab"]
    split = made["pre_tokenizer"]
    if all(own.get("".join(m)) == 256 + k for k, m in enumerate(pairs)) and made["normalizer"] is None and (split or {}).get("type") == "ByteLevel" and split["use_regex"] and not split["add_prefix_space"]:
        ranks = tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks={token[k]: k for k in own.values()}, special_tokens={})
        return lambda texts: [ranks.encode_ordinary(t) for t in texts], token
    return lambda texts: [e.ids for e in tokenizer.encode_batch(texts, add_special_tokens=False)], token


#: The tokenizers per Python worker and setting; workers are reused by later tasks, and so are the words.
_TOKENIZERS: dict[Settings, Tokenizers] = {}


def tokenizers_of(settings: Settings) -> Tokenizers:
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    if settings not in _TOKENIZERS:
        _TOKENIZERS[settings] = Tokenizers(settings)
    return _TOKENIZERS[settings]


def tables(settings: Settings) -> tuple[list[np.ndarray], np.dtype]:
    """Byte lengths of the ids of both sides, and the type that holds every id."""
    token = tokenizers_of(settings).token
    return [np.asarray([len(t) for t in side], np.int64) for side in token], np.dtype("<u2" if max(map(len, token)) <= 1 << 16 else "<u4")


EVENTS = ("shard", "row", "offset", "side", "ids")


def events(docs: DataFrame, id_column: str, text: str, settings: Settings) -> DataFrame:
    """(shard, row, offset, side, ids, doc_id): the end events of both sides, packed by window; a document without tokens is one empty row. shard and row name a document, whatever its id."""
    bounded_batches(docs.sparkSession)
    given = docs.select(F.col(id_column).alias("doc_id"), F.col(text).alias("text"))
    longs = [T.StructField(n, T.LongType()) for n in EVENTS[:4]]
    schema = T.StructType([*longs, T.StructField("ids", T.BinaryType()), given.schema["doc_id"]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenize, (lengths, kind) = tokenizers_of(settings), tables(settings)
        shard, row = TaskContext.get().partitionId(), -1
        for batch in batches:
            made, at = [], []
            for k, both in enumerate(tokenize(batch.column(1).to_pylist())):
                row += 1
                if both is None:
                    made.append((shard, row, 0, 0, b""))
                    at.append(k)
                    continue
                for side, (ids, length) in enumerate(zip(both, lengths, strict=True)):
                    ends = np.cumsum(length[ids])
                    cuts = [0, *np.searchsorted(ends, np.arange(settings.window, ends[-1], settings.window), "right"), len(ids)]
                    for lo, hi in zip(cuts, cuts[1:], strict=False):
                        if hi > lo:
                            made.append((shard, row, int(ends[lo] - length[ids[lo]]), side, ids[lo:hi].astype(kind).tobytes()))
                            at.append(k)
            if made:
                columns = [pa.array(c, t) for c, t in zip(zip(*made, strict=True), [pa.int64()] * 4 + [pa.binary()], strict=True)]
                yield pa.RecordBatch.from_arrays([*columns, batch.column(0).take(pa.array(at))], [*EVENTS, "doc_id"])

    return given.mapInArrow(run, schema)


class Aligned:
    """Groups and links between two common ends: ids and ends of both sides, the group of each token, and the two tokens of each link."""

    def __init__(self, ids: list[np.ndarray], ends: list[np.ndarray]):
        self.ids, self.ends = ids, ends
        every = np.concatenate(ends)
        every.sort(kind="stable")
        twice = every[1:] == every[:-1]
        self.cuts = every[1:][twice]
        marks = every[np.concatenate(([True], ~twice))]
        self.group = [np.searchsorted(self.cuts, e) for e in ends]
        self.link = [np.searchsorted(e, marks) for e in ends]

    def digest(self, shown: np.ndarray) -> bytes:
        """`;a,a|b,b` of each group; `shown` has an id behind each of , ; and | in fixed width."""
        n = len(self.cuts)
        before = [np.concatenate(([0], np.cumsum(np.bincount(g, minlength=n)))) for g in self.group]
        code = np.empty(len(self.ids[0]) + len(self.ids[1]), np.int64)
        for side, mark in ((0, 1), (1, 2)):
            g = self.group[side]
            code[np.arange(len(g)) + (before[1][g] if side == 0 else before[0][g + 1])] = 3 * self.ids[side].astype(np.int64) + np.concatenate(([True], g[1:] != g[:-1])) * mark
        padded = shown[code].view(np.uint8)
        return padded[padded != 0].tobytes()


def sweep(rows: Iterator[tuple], lengths: list[np.ndarray], kind: np.dtype) -> Iterator[tuple]:
    """Streams sorted event rows (document, offset, side, ids, doc_id); yields (document, doc_id, Aligned) for every stretch up to the last common end, and (document, doc_id, None) at each document's end."""
    none = np.empty(0, kind), np.empty(0, np.int64)
    current, name = None, None
    open_ = [none, none]
    reach = [0, 0]
    for document, offset, side, packed, doc_id in rows:
        if document != current:
            if current is not None:
                yield current, name, None
            current, name, open_, reach = document, doc_id, [none, none], [0, 0]
        ids = np.frombuffer(packed, kind)
        if not len(ids):
            continue
        ends = offset + np.cumsum(lengths[side][ids])
        held = open_[side]
        open_[side] = (np.concatenate((held[0], ids)), np.concatenate((held[1], ends))) if len(held[0]) else (ids, ends)
        reach[side] = ends[-1]
        # all that ends up to the side that has come less far is known
        known = min(reach)
        if not known:
            continue
        (ids_a, ends_a), (ids_b, ends_b) = open_
        few = (ends_a, ends_b) if len(ends_a) <= len(ends_b) else (ends_b, ends_a)
        near = few[0][: np.searchsorted(few[0], known, "right")]
        at = np.searchsorted(few[1], near)
        common = near[(at < len(few[1])) & (few[1][np.minimum(at, len(few[1]) - 1)] == near)]
        if not len(common):
            continue
        cut = common[-1]
        ka, kb = np.searchsorted(ends_a, cut, "right"), np.searchsorted(ends_b, cut, "right")
        yield current, name, Aligned([ids_a[:ka], ids_b[:kb]], [ends_a[:ka], ends_b[:kb]])
        open_ = [(ids_a[ka:], ends_a[ka:]), (ids_b[kb:], ends_b[kb:])]
    if current is not None:
        yield current, name, None


def swept(docs: DataFrame, id_column: str, text: str, settings: Settings, fields: list[T.StructField], emit: Callable[[Iterator[tuple]], Iterator[tuple]], rows: int = 1024) -> DataFrame:
    """Rows (doc_id, fields) that `emit` makes from the sweep over docs."""
    found = events(docs, id_column, text, settings)
    schema = T.StructType([found.schema["doc_id"], *fields])
    names = schema.names
    types = [pa.list_(pa.int64()) if isinstance(f.dataType, T.ArrayType) else pa.string() if isinstance(f.dataType, T.StringType) else pa.int64() for f in fields]
    lengths, kind = tables(settings)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name: list[pa.DataType] = []

        def each() -> Iterator[tuple]:
            for batch in batches:
                name[:] = [batch.column(5).type]
                for shard, row, offset, side, ids, doc_id in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                    yield (shard, row), offset, side, ids, doc_id

        made: list[tuple] = []
        weight = 0
        for out in emit(sweep(each(), lengths, kind)):
            made.append(out)
            weight += sum(len(x) for x in out if isinstance(x, np.ndarray))
            if len(made) >= rows or weight > 2_000_000:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*made, strict=True), name + types, strict=True)], names)
                made, weight = [], 0
        if made:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*made, strict=True), name + types, strict=True)], names)

    dealt = found.repartition("shard", "row").sortWithinPartitions("shard", "row", "offset", "side")
    return dealt.mapInArrow(run, schema)


def longs(*names: str) -> list[T.StructField]:
    return [T.StructField(n, T.LongType()) for n in names]


def arrays(*names: str) -> list[T.StructField]:
    return [T.StructField(n, T.ArrayType(T.LongType())) for n in names]


def groups(docs: DataFrame, id_column: str = "doc_id", text: str = "text", settings: Settings = Settings()) -> DataFrame:
    """One row per group: doc_id, start and end (bytes of space + text), a_ids, b_ids."""

    def emit(stretches: Iterator[tuple]) -> Iterator[tuple]:
        start = 0
        for _, doc_id, part in stretches:
            if part is None:
                start = 0
                continue
            at = [np.searchsorted(g, np.arange(len(part.cuts) + 1)) for g in part.group]
            for k, end in enumerate(part.cuts.tolist()):
                yield doc_id, start, end, *(ids[a[k] : a[k + 1]].astype(np.int64) for ids, a in zip(part.ids, at, strict=True))
                start = end

    return swept(docs, id_column, text, settings, [*longs("start", "end"), *arrays("a_ids", "b_ids")], emit)


def links(docs: DataFrame, id_column: str = "doc_id", text: str = "text", settings: Settings = Settings()) -> DataFrame:
    """One row per link: doc_id, the ordinals of the two tokens and their ids."""

    def emit(stretches: Iterator[tuple]) -> Iterator[tuple]:
        seen = [0, 0]
        for _, doc_id, part in stretches:
            if part is None:
                seen = [0, 0]
                continue
            for a, b in zip(*(x.tolist() for x in part.link), strict=True):
                yield doc_id, seen[0] + a, seen[1] + b, int(part.ids[0][a]), int(part.ids[1][b])
            seen = [s + len(ids) for s, ids in zip(seen, part.ids, strict=True)]

    return swept(docs, id_column, text, settings, longs("a_place", "b_place", "a_id", "b_id"), emit, 20_000)


PAIR = 1 << 32


def documents(docs: DataFrame, id_column: str = "doc_id", text: str = "text", settings: Settings = Settings()) -> DataFrame:
    """One row per document: doc_id, shard, row, n_a, n_b, n_groups, n_links, groups_sha256, its distinct id pairs (a * 2**32 + b) and how often each is linked."""

    def emit(stretches: Iterator[tuple]) -> Iterator[tuple]:
        shown = np.asarray([mark + b"%d" % k for k in range(max(map(len, tables(settings)[0]))) for mark in (b",", b";", b"|")])
        n, sha, held = [0, 0, 0, 0], hashlib.sha256(), []
        for document, doc_id, part in stretches:
            if part is None:
                pairs, times = _summed(held)
                yield doc_id, *document, *n, sha.hexdigest() if n[2] else "", pairs, times
                n, sha, held = [0, 0, 0, 0], hashlib.sha256(), []
                continue
            said = part.digest(shown)
            sha.update(said if n[2] else said[1:])
            a, b = (ids[at].astype(np.int64) for ids, at in zip(part.ids, part.link, strict=True))
            held.append(np.unique(a * PAIR + b, return_counts=True))
            if len(held) > 64:
                held = [_summed(held)]
            n = [x + y for x, y in zip(n, (len(part.ids[0]), len(part.ids[1]), len(part.cuts), len(a)), strict=True)]

    fields = [*longs("shard", "row", "n_a", "n_b", "n_groups", "n_links"), T.StructField("groups_sha256", T.StringType()), *arrays("pairs", "times")]
    return swept(docs, id_column, text, settings, fields, emit)


def _summed(held: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    if len(held) == 1:
        return held[0]
    if not held:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    keys, at = np.unique(np.concatenate([k for k, _ in held]), return_inverse=True)
    return keys, np.bincount(at, np.concatenate([t for _, t in held])).astype(np.int64)


def pair_counts(found: DataFrame) -> DataFrame:
    """(pair, docs, best) of documents(): in how many documents a pair is linked, and whether its first id has no pair of more. The maxima are at most one row per id of the first vocabulary."""
    counts = found.select(F.explode("pairs").alias("pair")).groupBy("pair").agg(F.count("*").alias("docs"))
    first = F.shiftright("pair", 32).alias("a")
    most = counts.groupBy(first).agg(F.max("docs").alias("most"))
    return counts.withColumn("a", first).join(F.broadcast(most), "a").select("pair", "docs", (F.col("docs") == F.col("most")).alias("best"))


def align(docs: DataFrame, id_column: str = "doc_id", text: str = "text", settings: Settings = Settings()) -> DataFrame:
    """One row per document: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256."""
    found = materialize(documents(docs, id_column, text, settings), "aligned-documents")
    counts = materialize(pair_counts(found), "aligned-pairs")
    each = found.select("shard", "row", F.explode(F.arrays_zip("pairs", "times")).alias("x")).select("shard", "row", F.col("x.pairs").alias("pair"), F.col("x.times").alias("times"))
    if counts.count() <= settings.max_broadcast:
        known = each.join(F.broadcast(counts), "pair")
    else:
        known = salted_join(each, counts, ["pair"], counts.select("pair", F.col("docs").alias("many")), settings.salted)
    sums = known.groupBy("shard", "row").agg(F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("n_best"), F.sum(F.col("times") * F.col("docs")).alias("count_sum"))
    whole = found.drop("pairs", "times").join(sums, ["shard", "row"], "left")
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c)
    return whole.select("doc_id", "n_a", "n_b", "n_groups", "n_links", zero("n_best"), zero("count_sum"), "groups_sha256")
