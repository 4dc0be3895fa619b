"""Quality classifier: a byte-level convolutional network in numpy.

Bytes are embedded, learned filters slide over overlapping windows of the whole text, rectified responses are max-pooled over overlapping chunks, and the
chunks' mean and maximum are combined into one probability. Training takes a bounded, hash-ordered sample of labelled
rows (`max_train_rows`, `max_train_bytes`); scoring covers every byte of every text in blocks of bounded size, each of which is pooled before the next.

Defined results: a null text is an empty one; an empty text is one chunk of padding and gets the network's score for it; without labelled
rows, or with one class only, every score is the share of label 1 among them (0.5 without any).
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kbweave.llm.common import with_struct


@dataclass(frozen=True)
class Settings:
    max_train_rows: int = 4000  # bound of the training sample, by the hash of doc_id
    max_train_bytes: int = 1 << 18  # of a training text; with max_train_rows this bounds what the driver holds
    embedding: int = 6
    width: int = 16  # bytes under a filter
    stride: int = 4  # windows overlap by three quarters
    filters: int = 32
    chunk: int = 64  # windows in a chunk
    hop: int = 48  # windows from chunk to chunk, less than a chunk: chunks overlap
    epochs: int = 8
    rate: float = 0.01
    batch: int = 32
    seed: int = 11
    threshold: float = 0.3


@dataclass
class Network:
    settings: Settings
    table: np.ndarray  # 256 x embedding
    kernel: np.ndarray  # width * embedding x filters
    bias: np.ndarray
    out: np.ndarray  # 2 * filters + 1
    constant: float | None = None


def layout(sizes: np.ndarray, s: Settings) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Window starts and chunk bounds for texts that stand one after another, each padded to at least one window.

    Returns (windows per text, chunk begin, chunk end, text of each chunk), bounds counted in windows.
    """
    n = np.maximum(1, -(-np.maximum(sizes - s.width, 0) // s.stride) + 1)
    first = np.concatenate([[0], np.cumsum(n)])[:-1]
    chunks = np.maximum(1, -(-np.maximum(n - s.chunk, 0) // s.hop) + 1)
    of = np.repeat(np.arange(len(n)), chunks)
    k = np.arange(len(of)) - np.repeat(np.cumsum(chunks) - chunks, chunks)
    begin = first[of] + k * s.hop
    return n, begin, np.minimum(begin + s.chunk, first[of] + n[of]), of


def windows(texts: list[bytes], s: Settings) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(windows x width byte codes, chunk begin, chunk end, text of each chunk); texts are padded with zero bytes."""
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    n, begin, end, of = layout(sizes, s)
    room = (n - 1) * s.stride + s.width
    data = np.frombuffer(b"".join(t + b"\0" * int(r - len(t)) for t, r in zip(texts, room, strict=True)), np.uint8)
    base = np.repeat(np.cumsum(room) - room, n)
    within = np.arange(len(base)) - np.repeat(np.cumsum(n) - n, n)
    at = base + within * s.stride
    return np.lib.stride_tricks.sliding_window_view(data, s.width)[at], begin, end, of


def pool(response: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    bounds = np.stack([begin, np.minimum(end, len(response) - 1)], axis=1).reshape(-1)
    top = np.maximum.reduceat(response, bounds, axis=0)[::2]
    last = end == len(response)  # reduceat stops before the end index, which cannot be the array's length
    top[last] = np.maximum(top[last], response[-1])
    return top


def combine(chunks: np.ndarray, of: np.ndarray, many: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(features, first chunk of each text, chunks of each text): mean and maximum over the chunks, and a constant."""
    count = np.bincount(of, minlength=many)
    first = np.cumsum(count) - count
    mean = np.add.reduceat(chunks, first, axis=0) / count[:, None]
    top = np.maximum.reduceat(chunks, first, axis=0)
    return np.concatenate([mean, top, np.ones((many, 1), chunks.dtype)], axis=1), first, count


def responses(codes: np.ndarray, net: Network) -> np.ndarray:
    flat = net.table[codes].reshape(len(codes), -1)
    return np.maximum(flat @ net.kernel + net.bias, 0)


def probability(features: np.ndarray, net: Network) -> np.ndarray:
    return 1 / (1 + np.exp(-(features @ net.out).astype(np.float64)))


def score(texts: list[bytes], net: Network, block: int = 1 << 14) -> np.ndarray:
    """Probability of label 1 for each text. `block` windows are embedded at a time; what stays of a text longer than a block is the sum and the maximum of its chunks."""
    if net.constant is not None:
        return np.full(len(texts), net.constant)
    s = net.settings
    found = np.empty(len(texts))
    most = block * s.stride
    short = [i for i, t in enumerate(texts) if len(t) <= most]
    start = 0
    while start < len(short):
        stop, size = start, 0
        while stop < len(short) and (stop == start or size + len(texts[short[stop]]) <= most):
            size += len(texts[short[stop]])
            stop += 1
        codes, begin, end, of = windows([texts[i] for i in short[start:stop]], s)
        features, _, _ = combine(pool(responses(codes, net), begin, end), of, stop - start)
        found[short[start:stop]] = probability(features, net)
        start = stop
    for i in (i for i, t in enumerate(texts) if len(t) > most):
        found[i] = probability(long_features(texts[i], net, max(1, block // s.hop)), net)[0]
    return found


def long_features(text: bytes, net: Network, step: int) -> np.ndarray:
    """The features of one text, `step` chunks at a time; chunks are those of the whole text."""
    s = net.settings
    n, begin, end, _ = layout(np.asarray([len(text)]), s)
    total, top = np.zeros(s.filters), np.full(s.filters, -np.inf, np.float32)
    for k in range(0, len(begin), step):
        a, b = int(begin[k]), int(end[min(k + step, len(begin)) - 1])
        part = text[a * s.stride : (b - 1) * s.stride + s.width]
        part += b"\0" * ((b - a - 1) * s.stride + s.width - len(part))
        codes = np.lib.stride_tricks.sliding_window_view(np.frombuffer(part, np.uint8), s.width)[:: s.stride]
        pooled = pool(responses(codes, net), begin[k : k + step] - a, end[k : k + step] - a)
        total += pooled.sum(axis=0, dtype=np.float64)
        top = np.maximum(top, pooled.max(axis=0))
    return np.concatenate([(total / len(begin)).astype(np.float32), top, np.ones(1, np.float32)])[None]


def train(rows: list[tuple[bytes, int]], s: Settings = Settings()) -> Network:
    rng = np.random.default_rng(s.seed)
    net = Network(s, rng.normal(0, 0.5, (256, s.embedding)).astype(np.float32), rng.normal(0, (s.width * s.embedding) ** -0.5, (s.width * s.embedding, s.filters)).astype(np.float32), np.zeros(s.filters, np.float32), np.zeros(2 * s.filters + 1, np.float32))
    share = float(np.mean([y for _, y in rows])) if rows else 0.5
    if not 0 < share < 1:
        net.constant = share
        return net
    names = ("table", "kernel", "bias", "out")
    first = {n: np.zeros_like(getattr(net, n)) for n in names}
    second = {n: np.zeros_like(getattr(net, n)) for n in names}
    weight = {0: 0.5 / (1 - share), 1: 0.5 / share}
    t = 0
    for epoch in range(s.epochs):
        order = rng.permutation(len(rows))
        for at in range(0, len(order), s.batch):
            batch = [rows[i] for i in order[at : at + s.batch]]
            y = np.asarray([b[1] for b in batch], np.float32)
            codes, begin, end, of = windows([b[0] for b in batch], s)
            flat = net.table[codes].reshape(len(codes), -1)
            response = np.maximum(flat @ net.kernel + net.bias, 0)
            chunks = pool(response, begin, end)
            features, begin_text, count = combine(chunks, of, len(batch))
            p = 1 / (1 + np.exp(-(features @ net.out)))
            error = (p - y) * np.asarray([weight[int(v)] for v in y], np.float32) / len(batch)
            grads = {"out": features.T @ error + 1e-4 * net.out}
            f = s.filters
            wide = error[:, None] * net.out[None]
            by_chunk = (wide[:, :f] / count[:, None])[of]
            is_top = chunks == features[:, f : 2 * f][of]
            by_chunk = by_chunk + np.where(is_top, (wide[:, f : 2 * f] / np.maximum(np.add.reduceat(is_top, begin_text, axis=0), 1))[of], 0)
            # the gradient of a chunk's maximum goes to the first window that has it
            back = np.zeros_like(response)
            many = end - begin
            windows_of = np.repeat(begin, many) + np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
            chunk_of = np.repeat(np.arange(len(begin)), many)
            equal = (response[windows_of] == chunks[chunk_of]) & (chunks[chunk_of] > 0)
            w, j = np.nonzero(equal)
            _, once = np.unique(chunk_of[w] * f + j, return_index=True)
            w, j = w[once], j[once]
            np.add.at(back, (windows_of[w], j), by_chunk[chunk_of[w], j])
            hot = np.flatnonzero(back.any(axis=1))
            grads["kernel"] = flat[hot].T @ back[hot]
            grads["bias"] = back.sum(axis=0)
            grads["table"] = np.zeros_like(net.table)
            np.add.at(grads["table"], codes[hot].reshape(-1), (back[hot] @ net.kernel.T).reshape(-1, s.embedding))
            t += 1
            rate = s.rate * (1 - epoch / s.epochs * 0.8)
            for n in names:
                first[n] += 0.1 * (grads[n] - first[n])
                second[n] += 0.001 * (grads[n] ** 2 - second[n])
                getattr(net, n)[...] -= rate * (first[n] / (1 - 0.9**t)) / (np.sqrt(second[n] / (1 - 0.999**t)) + 1e-8)
    return net


FIELDS = [T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())]


def fit(docs: DataFrame, labels: DataFrame, usable: Column, id_column: str = "doc_id", text: str = "text", label: str = "quality", settings: Settings = Settings()) -> Network:
    """Train on at most max_train_rows labelled ids, in the order of the id's hash; of several texts of an id the least, and none of more than max_train_bytes, is taken, so
    that the sample, and the network, is the same in every run. Texts are read for the chosen ids only."""
    given = labels.where(usable & F.col(label).isin(0, 1)).select(F.col(id_column).alias("__id"), F.col(label).cast("int").alias("__y")).distinct()
    chosen = given.orderBy(F.xxhash64(F.col("__id").cast("string")), "__id", "__y").limit(settings.max_train_rows)
    given_text = F.coalesce(F.col(text), F.lit("")).alias("__text")
    met = docs.select(F.col(id_column).alias("__id"), given_text).where(F.octet_length("__text") <= settings.max_train_bytes).join(F.broadcast(chosen), "__id")
    picked = met.groupBy("__id", "__y").agg(F.min("__text").alias("__text")).select("__text", "__y")  # at most as many rows as were chosen
    return train(sorted((r[0].encode(), r[1]) for r in picked.collect()), settings)


def classify(docs: DataFrame, net: Network, text: str = "text", out: str = "quality") -> DataFrame:
    """docs plus the struct `out`: score and predicted (1 from the threshold on)."""
    model = docs.sparkSession.sparkContext.broadcast(net)

    def make() -> Callable[[pa.Array], list[pa.Array]]:
        net = model.value

        def work(texts: pa.Array) -> list[pa.Array]:
            found = score([t or b"" for t in texts.cast(pa.binary()).to_pylist()], net)
            return [pa.array(found), pa.array((found >= net.settings.threshold).astype(np.int32))]

        return work

    return with_struct(docs, make, FIELDS, out, text)
