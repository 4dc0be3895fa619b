"""Secret scan: fixed patterns plus dictionary-primed zstandard novelty.

Base spans are the leftmost, non-overlapping matches of three fixed patterns. The method adds spans of kind `novel`: every
token-like candidate of `min_length` characters or more with a sensitive word within `context` bytes before or after it is compressed in the midst of what surrounds it, with
a compressor that is primed with a dictionary of identifiers; the bytes which the candidate adds to the compressed surroundings, over its length,
are its novelty. Identifiers, words and repeated values cost next to nothing, keys and passwords cost nearly their entropy. A candidate is reported from `min_ratio` on,
shorter ones, whose cost is coarser, from `short_ratio` on.

Defined results: a null text is an empty one; an empty text has no spans. Offsets are code points, ends are exclusive.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left, bisect_right
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kbweave.llm.common import with_struct

KINDS = ("assign", "access", "hex", "novel")

#: Fixed patterns, applied to ASCII-lower-cased UTF-8 bytes (assign) or to the bytes as they are.
ASSIGN = re.compile(rb"""(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([a-z0-9+/_.=-]+)""")
ACCESS = re.compile(rb"AKIA[A-Z0-9]+")
HEX = re.compile(rb"[0-9a-f]{24,}")
ASSIGN_WORDS = (b"password", b"passwd", b"secret", b"token", b"apikey", b"api_key")

#: What makes a context sensitive, beyond the words of the fixed pattern.
SENSITIVE = re.compile(rb"password|passwd|passphrase|\bpwd\b|secret|token|(?:api|access|private|encryption|signing|license)[\x20_-]?key|credential|authorization|bearer|signature|\bauth\b|aws_|client[\x20_-]?id|conn(?:ection)?[\x20_-]?str")
#: One of these stands in every match of SENSITIVE; texts without any are not searched further.
SENSITIVE_STEMS = (b"passw", b"passphrase", b"pwd", b"secret", b"token", b"key", b"credential", b"auth", b"bearer", b"signature", b"aws_", b"client", b"conn")
CANDIDATE = re.compile(rb"[A-Za-z0-9+/_=~!@$%^*-]{12,}")
CANDIDATE_BYTE = re.compile(rb"[A-Za-z0-9+/_=~!@$%^*-]")

#: Identifier vocabulary for the primed dictionary; combinations of these are made by rule below.
PARTS = (
    "password passwd secret token api key access private public client server auth bearer session cookie user name email "
    "config settings environment default value string number boolean object array function return import export class const "
    "connection database host port url http https localhost example path file json yaml header request response error message "
    "index count total length offset buffer stream reader writer handler manager service controller factory provider builder "
    "true false null none undefined begin end certificate signature credential account bucket region endpoint timeout version "
    "get set is has from to with for not this that new add remove update delete create build make load save open close start stop run test main "
    "max min size length input output result data info list map item node tree table column row field type class method argument "
    "authentication authorization provider application service system local share usr bin lib src com org net project package module python java linux "
    "http request handler final release debug manager distributed"
).split()


@dataclass(frozen=True)
class Novelty:
    context: int = 96  # bytes on each side of a candidate that are searched for a sensitive word and that the measurement takes in
    min_length: int = 12
    min_classes: int = 2  # of lower case, upper case, digits
    min_ratio: float = 0.7  # marginal compressed bytes over candidate bytes
    short_length: int = 16
    short_ratio: float = 0.75  # for candidates below short_length
    level: int = 3


def dictionary_bytes() -> bytes:
    """Identifiers in the usual spellings: snake, camel and constant case of neighbouring vocabulary words."""
    made: list[str] = []
    for step in (1, 3, 7):
        for k, a in enumerate(PARTS):
            b = PARTS[(k + step) % len(PARTS)]
            made += [f"{a}_{b}", f"{a}{b.title()}", f"{a}_{b}".upper(), f"{a}-{b}"]
    return (" = ".join(made) + " " + " ".join(PARTS)).encode()


def base_spans(data: bytes) -> Iterator[tuple[int, int, int]]:
    """(start, kind, end) in bytes of the fixed patterns; matches that are too short are dropped after they were consumed."""
    lowered = data.lower()
    if any(w in lowered for w in ASSIGN_WORDS):
        for m in ASSIGN.finditer(lowered):
            if m.end(1) - m.start(1) >= 6:
                yield m.start(), 0, m.end()
    if b"AKIA" in data:
        for m in ACCESS.finditer(data):
            if m.end() - m.start() >= 20:
                yield m.start(), 1, m.end()
    for m in HEX.finditer(data):
        yield m.start(), 2, m.end()


def novelty_meter(settings: Novelty) -> Callable[[bytes, bytes, bytes], float]:
    import zstandard

    primed = zstandard.ZstdCompressionDict(dictionary_bytes(), dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    press = zstandard.ZstdCompressor(level=settings.level, dict_data=primed, write_checksum=False, write_content_size=False, write_dict_id=False).compress

    def meter(before: bytes, candidate: bytes, after: bytes) -> float:
        return (len(press(before + candidate + after)) - len(press(before + after))) / max(1, len(candidate))

    return meter


def regions(data: bytes, hits: list[tuple[int, int]], reach: int) -> Iterator[tuple[int, int]]:
    """Stretches of text within reach of a sensitive word, joined where they touch; a candidate that begins before a stretch belongs to it."""
    begin = end = -1
    for s, e in hits:
        if end < 0:
            begin, end = max(0, s - reach), e + reach
        elif s - reach <= end:
            end = max(end, e + reach)
        else:
            yield begin, end
            begin, end = s - reach, e + reach
    if end >= 0:
        yield begin, end


def novel_spans(data: bytes, taken: list[tuple[int, int, int]], settings: Novelty, meter: Callable[[bytes, bytes, bytes], float]) -> Iterator[tuple[int, int, int]]:
    lowered = data.lower()
    if not any(stem in lowered for stem in SENSITIVE_STEMS):
        return
    reach = settings.context
    hits = [m.span() for m in SENSITIVE.finditer(lowered)]
    starts, ends = [s for s, _ in hits], [e for _, e in hits]
    done = 0
    for begin, stop in regions(data, hits, reach):
        begin = max(begin, done)
        while begin > done and CANDIDATE_BYTE.match(data, begin - 1):
            begin -= 1
        for m in CANDIDATE.finditer(data, begin):
            if m.start() >= stop:
                break
            done = m.end()
            raw = m.group()
            body = raw.strip(b"!@$%^*~=-")
            if len(body) < settings.min_length:
                continue
            start = m.start() + raw.index(body)
            end = start + len(body)
            classes = (body.lower() != body) + (body.upper() != body) + any(48 <= c < 58 for c in body)
            if classes < settings.min_classes or any(s < end and start < e for s, _, e in taken):
                continue
            # a sensitive word outside the candidate: the last that ends before it, or the first that starts after it
            k, j = bisect_right(ends, start) - 1, bisect_left(starts, end)
            if not (k >= 0 and start - ends[k] <= reach) and not (j < len(starts) and starts[j] - end <= reach):
                continue
            least = settings.min_ratio if len(body) >= settings.short_length else settings.short_ratio
            if meter(data[max(0, start - reach) : start], body, data[end : end + reach]) >= least:
                yield start, 3, end


def find_secrets(data: bytes, settings: Novelty, meter: Callable[[bytes, bytes, bytes], float]) -> list[tuple[int, int, int]]:
    """All spans as (start, kind, end) in code points, sorted by start, then kind."""
    spans = list(base_spans(data))
    spans += sorted(set(novel_spans(data, spans, settings, meter)))
    spans.sort()
    if spans and not data.isascii():
        at: dict[int, int] = {}
        seen = last = 0
        for b in sorted({x for s, _, e in spans for x in (s, e)}):
            seen += len(data[last:b].decode("utf-8", "replace"))
            at[b], last = seen, b
        spans = [(at[s], k, at[e]) for s, k, e in spans]
    return spans


FIELDS = [
    T.StructField("spans", T.ArrayType(T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())]))),
    T.StructField("n_assign", T.LongType()),
    T.StructField("n_access", T.LongType()),
    T.StructField("n_hex", T.LongType()),
    T.StructField("n_novel", T.LongType()),
    T.StructField("base_sha256", T.StringType()),
    T.StructField("spans_text", T.StringType()),
    T.StructField("redacted", T.StringType()),
]
SPAN = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))
KINDS_OF = [SPAN, pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string()]


def redact(text: str, spans: list[tuple[int, int, int]]) -> str:
    """Replace each union of overlapping spans by a marker with the first kind's name."""
    out, last = [], 0
    for start, kind, end in spans:
        if start >= last:
            out += [text[last:start], f"[{KINDS[kind].upper()}]"]
        last = max(last, end)
    return "".join([*out, text[last:]])


def secret_scan(docs: DataFrame, text: str = "text", out: str = "secrets", settings: Novelty = Novelty(), redacted: bool = True) -> DataFrame:
    """docs plus the struct `out` (FIELDS): spans, counts by kind, digests and, if asked for, the text with secrets replaced."""

    def make() -> Callable[[pa.Array], list[pa.Array]]:
        meter = novelty_meter(settings)

        def work(texts: pa.Array) -> list[pa.Array]:
            rows = []
            for data in texts.cast(pa.binary()).to_pylist():
                spans = find_secrets(data or b"", settings, meter)
                named = [f"{KINDS[k]}:{s}:{e}" for s, k, e in spans]
                base = ",".join(n for n, (_, k, _) in zip(named, spans, strict=True) if k < 3)
                counts = [sum(k == want for _, k, _ in spans) for want in range(4)]
                clean = None if data is None or not redacted else redact(data.decode(), spans) if spans else data.decode()
                rows.append(([{"kind": KINDS[k], "start": s, "end": e} for s, k, e in spans], *counts, hashlib.sha256(base.encode()).hexdigest(), ",".join(named), clean))
            return [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), KINDS_OF, strict=True)]

        return work

    return with_struct(docs, make, FIELDS, out, text)


def scrub(docs: DataFrame, text: str = "text") -> DataFrame:
    """docs with the secrets in `text` replaced by markers; the columns stay as they were."""
    found = secret_scan(docs, text, "__secrets")
    return found.select(*[F.col("__secrets.redacted").alias(c) if c.lower() == text.lower() else F.col(f"`{c}`") for c in docs.columns])
