"""Quality rules by compression bands.

A document passes if its zstandard ratio (bytes in / bytes out) over the whole text lies in a band that depends on the text's
length, and if no more than a small share of its fixed-size chunks lies outside the band of the chunk's own length; the last, shorter chunk
counts like the others, and a text of up to one chunk is its only chunk. Repetitive text compresses too
well, noise (random characters, encoded payloads) too badly. Base counts of words, symbols, repeated lines and repeated 8-word
windows go with the verdict.

The lower limits lie between noise and prose as measured with zstandard level 3: base64 in lines reaches 1.09 at 256 bytes, 1.25 at 1 kB, 1.31 at 4 kB and 1.33
beyond, words of random printable characters less; prose starts at 1.35, 1.44, 1.9 and 2.1 there. Below 128 bytes the two cannot be told apart.
The upper limits are the 0.999 quantiles of the ratios of texts that are labelled good, rounded up: one in a thousand of these is above, while texts that say the same again and again, which the
windows of the base rule do not see, compress better from 1 kB on.

Defined results: a null or empty text has zero counts, ratio 0.0 and fails the base rule (fewer than 20 words).
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from kbweave.llm.common import with_struct

SYMBOLS = b"#*$%&|<>"
WINDOW = 8


@dataclass(frozen=True)
class Bands:
    """Per length class (bytes, lower bound inclusive): the least and the greatest whole-text ratio that passes. Whole chunks have an upper limit of their own, since long texts compress better than their chunks."""

    lengths: tuple[int, ...] = (0, 128, 256, 512, 1024, 2048, 4096, 8192, 16384, 65536)
    low: tuple[float, ...] = (0.0, 1.0, 1.2, 1.28, 1.35, 1.4, 1.45, 1.5, 1.5, 1.5)
    high: tuple[float, ...] = (2.2, 1.6, 1.87, 2.03, 2.16, 2.24, 2.36, 2.45, 2.58, 2.8)
    chunk_bytes: int = 4096
    chunk_high: float = 2.3
    bad_chunk_share: float = 0.25
    level: int = 3


FIELDS = [
    T.StructField("n_words", T.LongType()),
    T.StructField("word_chars", T.LongType()),
    T.StructField("n_symbols", T.LongType()),
    T.StructField("n_dup_lines", T.LongType()),
    T.StructField("n_repeat_words", T.LongType()),
    T.StructField("ratio", T.DoubleType()),
    T.StructField("n_chunks", T.LongType()),
    T.StructField("n_bad_chunks", T.LongType()),
    T.StructField("base_failed", T.BooleanType()),
    T.StructField("kept", T.BooleanType()),
]


def repeat_words(words: list[bytes]) -> int:
    """How many words stand in an 8-word window that occurs twice or more; windows with equal hashes are compared word by word."""
    n = len(words) - WINDOW + 1
    if n < 2:
        return 0
    number: dict[bytes, int] = {}
    codes = np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, len(words))
    rolled = np.zeros(n, np.uint64)
    for j in range(WINDOW):
        rolled = rolled * np.uint64(0x9E3779B97F4A7C15) + codes[j : j + n].astype(np.uint64)
        rolled ^= rolled >> np.uint64(29)
    order = np.argsort(rolled, kind="stable")
    same = rolled[order[1:]] == rolled[order[:-1]]
    if not same.any():
        return 0
    at = np.lib.stride_tricks.sliding_window_view(codes, WINDOW)
    equal = same.copy()
    equal[same] = (at[order[1:][same]] == at[order[:-1][same]]).all(axis=1)
    if (same != equal).any():  # two windows share a hash: order by the words themselves
        order = np.lexsort(at.T[::-1])
        equal = (at[order[1:]] == at[order[:-1]]).all(axis=1)
    twice = np.zeros(n, bool)
    twice[order[1:][equal]] = True
    twice[order[:-1][equal]] = True
    edge = np.zeros(len(words) + 1, np.int64)
    first = np.flatnonzero(twice)
    np.add.at(edge, first, 1)
    np.add.at(edge, first + WINDOW, -1)
    return int((np.cumsum(edge[:-1]) > 0).sum())


def measure(data: bytes) -> tuple[int, int, int, int, int]:
    words = data.split()
    chars = sum(map(len, words)) if data.isascii() else len(b"".join(words).decode())
    lines = [x for x in data.split(b"\n") if x and not x.isspace()]
    return len(words), chars, len(data) - len(data.translate(None, SYMBOLS)), len(lines) - len(set(lines)), repeat_words(words)


def judge(bands: Bands) -> Callable[[bytes], tuple[float, int, int, bool]]:
    import zstandard

    press = zstandard.ZstdCompressor(level=bands.level, write_content_size=False, write_checksum=False).compress

    def fits(data: bytes, ratio: float, whole: bool = True) -> bool:
        k = bisect_right(bands.lengths, len(data)) - 1
        return bands.low[k] <= ratio <= (bands.high[k] if whole or len(data) < bands.chunk_bytes else bands.chunk_high)

    def verdict(data: bytes) -> tuple[float, int, int, bool]:
        if not data:
            return 0.0, 0, 0, False
        ratio = len(data) / len(press(data))
        if len(data) <= bands.chunk_bytes:
            bad = int(not fits(data, ratio))
            return ratio, 1, bad, not bad
        parts = [data[start : start + bands.chunk_bytes] for start in range(0, len(data), bands.chunk_bytes)]
        bad = sum(not fits(part, len(part) / len(press(part)), False) for part in parts)
        return ratio, len(parts), bad, fits(data, ratio) and bad <= bands.bad_chunk_share * len(parts)

    return verdict


def compression_rules(docs: DataFrame, text: str = "text", out: str = "rules", bands: Bands = Bands()) -> DataFrame:
    """docs plus the struct `out` with the counts, ratios and verdicts of FIELDS; one output row per input row."""

    def make() -> Callable[[pa.Array], list[pa.Array]]:
        verdict = judge(bands)

        def work(texts: pa.Array) -> list[pa.Array]:
            rows = []
            for data in texts.cast(pa.binary()).to_pylist():
                data = data or b""
                n, chars, symbols, dup, repeat = measure(data)
                ratio, chunks, bad, fine = verdict(data)
                failed = n < 20 or 100 * repeat > 30 * n
                rows.append((n, chars, symbols, dup, repeat, ratio, chunks, bad, failed, fine and not failed))
            kinds = [pa.int64()] * 5 + [pa.float64(), pa.int64(), pa.int64(), pa.bool_(), pa.bool_()]
            return [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)]

        return work

    return with_struct(docs, make, FIELDS, out, text)
