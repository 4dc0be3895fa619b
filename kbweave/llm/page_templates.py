"""Main-text extraction by equivalence-class template deduction.

Every page is parsed once into events in page order: opened elements, named by a hash of their path (tags with class and id, digits left out), and
blocks of text, named by the hash of their element and their words. Events of one host that occur equally often on each of its pages have the same
occurrence vector; a vector is kept as two sums of hashes of (page, count), which add up in any order, so that
classes form by grouping on (host, sums) and no host is ever gathered in one task. Copies of a page count once.

A class of at least `min_size` events on at least `share` of a host's pages is kept if it is valid: its events come in the same order on every page, as often as they
repeat, and its occurrences do not interleave with those of a class on more pages. Valid classes nest into the host's template. Its texts are constants,
those inside an article or main element only if their own element belongs to the same class and is no heading (a paragraph or heading that all articles share is theirs); every
other block is data of the slot below the innermost template element around it. Markup only ranks slots: those inside navigation, forms, notices, adverts or comments are dropped, and where a host's slots hold article or main
elements, only slots that lie mostly in them remain. What the remaining slots hold, and what else lies in an article, all articles of a page included, is the text.

Defined results: a null or empty page has the empty text; a host that cannot be read from the url is the empty host; hosts with fewer than
`min_pages` different pages, and pages on which no chosen slot holds anything, are judged by markup alone. Character references are decoded, white space
inside a block is one space, blocks are joined by one newline. Repeated rows get equal results; memory is linear in a page, whatever its depth.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kbweave.llm.common import bounded_batches, drop_materialized, materialize, with_struct

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = frozenset("address article aside blockquote body br caption center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead title tr ul".split())
#: Never text: not shown, or controls.
HIDDEN = frozenset("head script style noscript template button select option textarea iframe object svg canvas audio video".split())
#: Regions that rank below the article.
CHROME = frozenset("nav footer aside form dialog menu".split())
ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog menu menubar toolbar form".split())
#: What a class or id part says about a region that is no article text.
CHROME_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies consent notice notices gdpr newsletter subscribe "
    "popup modal overlay sidebar side rail nav navbar navigation menu breadcrumb breadcrumbs footer comment comments disqus reply replies respond share sharing social related "
    "recommended recommendations widget toolbar skip pagination pager login signup search masthead".split()
)
BODY_WORDS = frozenset("article entry post story content body main text".split())
CLOSED_BY = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
ENDS_P = BLOCKS - {"br", "html", "body", "title", "tbody", "thead", "tfoot", "tr", "td", "th", "caption", "legend", "li", "dt", "dd", "summary", "figcaption"}
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
SPACE = re.compile(r"[\s\x1c-\x1f]+")
DIGITS = re.compile(r"[0-9]+")
LOW = (1 << 31) - 1


@dataclass(frozen=True)
class Settings:
    min_pages: int = 3
    min_size: int = 2  # events of a class
    share: float = 0.5  # of a host's pages that a class is on; bounds a host's template by twice the events of its mean page
    max_broadcast: int = 100_000  # template events of all hosts that travel to every executor; more are joined by host


def is_hidden(tag: str, attrs: dict[str, str | None]) -> bool:
    return tag in HIDDEN or "hidden" in attrs or attrs.get("aria-hidden") == "true" or "display:none" in (attrs.get("style") or "").replace(" ", "").lower()


def is_chrome(tag: str, attrs: dict[str, str | None], in_main: bool) -> bool:
    if tag in CHROME or (tag == "header" and not in_main) or (attrs.get("role") or "").lower() in ROLES:
        return True
    if tag in ("html", "body", "main") or not ("class" in attrs or "id" in attrs):
        return False
    for name in f"{attrs.get('class') or ''} {attrs.get('id') or ''}".lower().split():
        parts = set(re.split(r"[-_:]+", re.sub(r"(?<=[a-z])(?=[0-9])", "-", name)))
        if parts & CHROME_WORDS and not (tag == "article" and not parts & {"comment", "comments", "ad", "promo", "related"}) and not (parts & BODY_WORDS and not parts & {"comment", "comments", "ad", "ads", "sidebar", "footer", "nav", "menu", "related", "share"}):
            return True
        if "header" in parts and not in_main and not parts & BODY_WORDS:
            return True
    return False


class PageReader(HTMLParser):
    """Events in page order: codes, parents (the event around each, -1 for none) and, for texts, (event, text, event of the chrome around it or -1, 1 inside a main element, 2 if it is a heading there)."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        import xxhash

        self.hash = xxhash.xxh64_intdigest
        # tag, code, event, event of the chrome around it, inside main, hidden, event of the innermost block
        self.stack: list[tuple[str, int, int, int, bool, bool, int]] = [("", 0, -1, -1, False, False, -1)]
        self.codes: list[int] = []
        self.parents: list[int] = []
        self.blocks: list[tuple[int, str, int, int]] = []
        self.heads: set[int] = set()
        self.parts: list[str] = []

    def flush(self) -> None:
        if self.parts:
            text = SPACE.sub(" ", "".join(self.parts)).strip()
            self.parts = []
            if text:
                _, _, _, chrome, main, hidden, block = self.stack[-1]
                if not hidden:
                    of = self.codes[block] if block >= 0 else 0
                    self.blocks.append((len(self.codes), text, chrome, 2 if main and block in self.heads else int(main)))
                    self.codes.append(self.hash(text, of & LOW) >> 1)
                    self.parents.append(block)

    def close_to(self, k: int) -> None:
        self.flush()
        del self.stack[k:]

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag in BLOCKS or tag in HIDDEN:
            self.flush()
        if tag in ENDS_P:
            for k in range(len(self.stack) - 1, 0, -1):
                if self.stack[k][0] == "p":
                    self.close_to(k)
                    break
                if self.stack[k][0] in BLOCKS:
                    break
        if tag == "body" or tag in CLOSED_BY:
            closes = CLOSED_BY.get(tag, {"head"})
            for k in range(len(self.stack) - 1, 0, -1):
                if self.stack[k][0] in closes:
                    self.close_to(k)
                    break
                if self.stack[k][0] in ("ul", "ol", "dl", "table", "body", "select", "menu"):
                    break
        _, above, event, chrome, main, hidden, block = self.stack[-1]
        name, given = tag, {}
        if attrs:
            given = dict(attrs)
            if given.get("class") or given.get("id"):
                name += "." + ".".join(sorted(DIGITS.sub("#", f"{given.get('class') or ''} {given.get('id') or ''}").split()))
        code = self.hash(f"{above:x}/{name}") >> 1
        here = len(self.codes)
        if not hidden:
            self.codes.append(code)
            self.parents.append(event)
            if tag in HEADINGS:
                self.heads.add(here)
        if tag in VOID:
            return
        inside = hidden or is_hidden(tag, given)
        if not inside and chrome < 0 and is_chrome(tag, given, main):
            chrome = here
        if chrome < 0 and not main:
            main = tag in ("article", "main") or (given.get("role") or "").lower() in ("main", "article") or (given.get("itemprop") or "").lower() == "articlebody"
        self.stack.append((tag, code, event if hidden else here, chrome, main, inside, here if tag in BLOCKS and not hidden else block))

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)

    def handle_endtag(self, tag: str) -> None:
        for k in range(len(self.stack) - 1, 0, -1):
            if self.stack[k][0] == tag:
                outer = any(x[0] in BLOCKS for x in self.stack[k + 1 :])
                if tag in BLOCKS or tag in HIDDEN or outer:
                    self.flush()
                if tag not in BLOCKS and tag not in HIDDEN and outer:
                    del self.stack[k]  # an inline end tag does not close the blocks that were opened since
                else:
                    del self.stack[k:]
                return

    def handle_data(self, data: str) -> None:
        self.parts.append(data)


def read_page(html: str) -> PageReader:
    reader = PageReader()
    reader.feed(html)
    reader.close()
    reader.flush()
    return reader


def host_of(url):
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)", 1))


_LONGS, _INTS = T.ArrayType(T.LongType()), T.ArrayType(T.IntegerType())
EVENTS = [
    T.StructField("digest", T.LongType()),
    T.StructField("vocab", _LONGS),  # codes of the different events
    T.StructField("times", _INTS),  # how often each occurs
    T.StructField("places", _INTS),  # the events in page order, as places in vocab
    T.StructField("parents", _INTS),
    T.StructField("at", _INTS),  # events that are texts
    T.StructField("texts", T.ArrayType(T.StringType())),
    T.StructField("chrome", _INTS),
    T.StructField("main", _INTS),
]


def parse_pages(pages: DataFrame, html: str, out: str) -> DataFrame:
    """pages plus the struct `out` of EVENTS; the only pass that reads HTML."""

    def make() -> Callable[[pa.Array], list[pa.Array]]:
        import xxhash

        def work(sources: pa.Array) -> list[pa.Array]:
            columns: list[list] = [[] for _ in EVENTS]
            for source in sources.to_pylist():
                page = read_page(source or "")
                seen = Counter(page.codes)
                place = {c: i for i, c in enumerate(seen)}
                at, texts, chrome, main = zip(*page.blocks, strict=True) if page.blocks else ((), (), (), ())
                row = (xxhash.xxh64_intdigest(source or "") >> 1, list(seen), list(seen.values()), [place[c] for c in page.codes], page.parents, at, texts, chrome, main)
                for column, value in zip(columns, row, strict=True):
                    column.append(value)
            ints = pa.list_(pa.int32())
            kinds = [pa.int64(), pa.list_(pa.int64()), ints, ints, ints, ints, pa.list_(pa.string()), ints, ints]
            return [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]

        return work

    return with_struct(pages, make, EVENTS, out, html, rows=256)


def occurrence_classes(parsed: DataFrame, settings: Settings) -> DataFrame:
    """(host, class, pages, code) of the events of classes that are large and frequent enough, by grouping on the sums of their vectors."""
    different = parsed.select("host", "e.digest", "e.vocab", "e.times").dropDuplicates(["host", "digest"])
    total = different.groupBy("host").agg(F.count("*").alias("of"))
    each = different.select("host", "digest", F.explode(F.arrays_zip("vocab", "times")).alias("x")).select("host", F.col("x.vocab").alias("code"), F.xxhash64("digest", "x.times").alias("v"))
    sums = each.groupBy("host", "code").agg(F.count("*").alias("pages"), F.sum(F.col("v").bitwiseAND(LOW)).alias("a"), F.sum(F.shiftrightunsigned("v", 33)).alias("b"))
    often = sums.join(total, "host").where((F.col("pages") >= settings.min_pages) & (F.col("pages") >= settings.share * F.col("of")))
    named = often.select("host", F.xxhash64("pages", "a", "b").alias("class"), "pages", "code")
    large = named.groupBy("host", "class").agg(F.count("*").alias("size"), F.collect_list("code").alias("members"), F.first("pages").alias("pages")).where(F.col("size") >= settings.min_size)
    return large.select("host", "class", "pages", F.explode("members").alias("code"))


def sequences(codes: list[int], known: dict[int, int], sizes: dict[int, int]) -> dict[int, tuple[int, ...] | None]:
    """For each class on a page the order of its events, None if it does not repeat in one order."""
    found: dict[int, list[int]] = {}
    for c in codes:
        k = known.get(c)
        if k is not None:
            found.setdefault(k, []).append(c)
    out = {}
    for k, events in found.items():
        n = sizes[k]
        first = events[:n]
        out[k] = tuple(first) if len(events) % n == 0 and events == first * (len(events) // n) and len(set(first)) == n else None
    return out


def interleaved(codes: list[int], known: dict[int, int], sizes: dict[int, int], rank: dict[int, tuple]) -> set[int]:
    """Classes whose occurrences on this page interleave with those of a class of better rank; what is left nests."""
    lost: set[int] = set()
    while True:
        stack: list[list[int]] = []  # class, events still to come
        worse = None
        for c in codes:
            k = known.get(c)
            if k is None or k in lost:
                continue
            if any(x[0] == k for x in stack):
                if stack[-1][0] != k:
                    worse = max((k, stack[-1][0]), key=lambda x: rank[x])
                    break
                stack[-1][1] -= 1
            else:
                stack.append([k, sizes[k] - 1])
            if not stack[-1][1]:
                stack.pop()
        if worse is None:
            return lost
        lost.add(worse)


class Template:
    """A host's entries of a template table: up to `max_broadcast` of all hosts travel to every worker, more are joined to the pages by host."""

    def __init__(self, table: DataFrame, settings: Settings):
        self.table, self.fields = table, [c for c in table.columns if c != "host"]
        self.sent = None
        if table.count() <= settings.max_broadcast:
            held: dict[str, list[dict]] = {}
            for r in table.collect():
                held.setdefault(r["host"], []).append(r.asDict())
            self.sent = table.sparkSession.sparkContext.broadcast(held)

    def over(self, pages: DataFrame) -> DataFrame:
        """pages with the entries as the column __t, null where they travel by themselves."""
        if self.sent is not None:
            return pages.withColumn("__t", F.lit(None).cast("array<int>"))
        return pages.join(self.table.groupBy("host").agg(F.collect_list(F.struct(*self.fields)).alias("__t")), "host", "left")


def entry_reader(sent: Broadcast | None, prepare: Callable[[list[dict]], tuple]) -> Callable[[pa.RecordBatch, int, str], tuple | None]:
    """What `prepare` makes of a host's entries, once for each host while it is remembered; None for hosts without any."""
    known: dict[str, tuple | None] = {}

    def read(batch: pa.RecordBatch, row: int, host: str) -> tuple | None:
        if host not in known:
            if len(known) >= 1000:
                known.clear()
            entries = sent.value.get(host) if sent is not None else batch.column("__t")[row].as_py()
            known[host] = prepare(entries) if entries else None
        return known[host]

    return read


def _over_hosts(pages: DataFrame, columns: list[str], template: Template, prepare: Callable, judge: Callable, schema: str) -> DataFrame:
    """Rows (host, ...) that `judge(host, prepared entries, codes, columns)` counts, summed up within each batch."""
    bounded_batches(pages.sparkSession, 1024)
    names = [f.split()[0] for f in schema.split(", ")]
    types = [pa.string() if f.split()[1] == "string" else pa.int64() for f in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        read = entry_reader(sent, prepare)
        for batch in batches:
            out: Counter[tuple] = Counter()
            for i, (host, vocab, places, *values) in enumerate(zip(*(batch.column(c).to_pylist() for c in ["host", "vocab", "places", *columns]), strict=True)):
                held = read(batch, i, host)
                if held is not None:
                    out.update(judge(host, held, [vocab[k] for k in places], *values))
            if out:
                rows = [(*k, n) for k, n in out.items()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names)

    sent = template.sent
    return template.over(pages.select("host", "vocab", "places", *columns)).mapInArrow(run, schema)


def _classes(entries: list[dict]) -> tuple[dict[int, int], dict[int, int], dict[int, tuple]]:
    """(class of each event, size of each class, rank of each class: the best are on the most pages, then the largest)."""
    known = {t["code"]: t["class"] for t in entries}
    sizes = Counter(known.values())
    return known, sizes, {t["class"]: (-t["pages"], -sizes[t["class"]], t["class"]) for t in entries}


def _orders(host: str, held: tuple, codes: list[int]) -> dict[tuple, int]:
    import xxhash

    known, sizes, _ = held
    return {(host, k, -1 if order is None else xxhash.xxh64_intdigest(np.asarray(order).tobytes()) >> 1): 1 for k, order in sequences(codes, known, sizes).items()}


def _places(host: str, held: tuple, codes: list[int]) -> dict[tuple, int]:
    known, sizes, rank = held
    out = {(host, k, 0, -1): 1 for k in interleaved(codes, known, sizes, rank)}
    for k, order in sequences(codes, known, sizes).items():
        out |= {(host, k, c, i): 1 for i, c in enumerate(order or ())}
    return out


def valid_classes(parsed: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """(host, class, pages, code, place): the events of the classes that come in one order on all pages and nest, `place` being the event's rank in this order."""
    found = materialize(occurrence_classes(parsed, settings), "page-classes")
    pages = parsed.select("host", "e.vocab", "e.places")
    orders = _over_hosts(pages, [], Template(found, settings), _classes, _orders, "host string, class bigint, sequence bigint, n bigint")
    one = orders.groupBy("host", "class").agg(F.min("sequence").alias("least"), F.max("sequence").alias("most")).where("least = most AND least >= 0").select("host", "class")
    steady = materialize(found.join(one, ["host", "class"], "left_semi"), "page-ordered")
    seen = _over_hosts(pages, [], Template(steady, settings), _classes, _places, "host string, class bigint, code bigint, place bigint, n bigint")
    places = materialize(seen.select("host", "class", "code", "place").distinct(), "page-places")
    lost = places.where("place < 0").select("host", "class").distinct()
    valid = materialize(steady.join(places.where("place >= 0"), ["host", "class", "code"]).join(lost, ["host", "class"], "left_anti"), "page-template")
    for done in (found, steady, places):
        drop_materialized(done)
    return valid


def slots_of(codes: list[int], parents: list[int], at: list[int], chrome: list[int], main: list[int], known: dict[int, int]) -> list[tuple[int, int] | None]:
    """For each text of a page its slot: the innermost template element around it and the event of the chrome that it stands in (-1: none); None for constants."""
    above: dict[int, int] = {-1: 0}

    def element(event: int) -> int:
        """Code of the innermost template element from this event upwards."""
        chain = []
        while event not in above:
            if codes[event] in known:
                above[event] = codes[event]
                break
            chain.append(event)
            event = parents[event]
        for x in chain:
            above[x] = above[event]
        return above[event]

    out: list[tuple[int, int] | None] = []
    for event, root, inside in zip(at, chrome, main, strict=True):
        own = parents[event]
        # a heading of an article is the article's, however many articles have it
        constant = codes[event] in known and (not inside or (inside == 1 and own >= 0 and known.get(codes[own]) == known[codes[event]]))
        out.append(None if constant else (element(own), root))
    return out


def _known(entries: list[dict]) -> tuple[dict[int, int]]:
    return ({t["code"]: t["class"] for t in entries},)


def _weights(host: str, held: tuple, codes: list[int], parents: list[int], at: list[int], chrome: list[int], main: list[int], sizes: list[int]) -> dict[tuple, int]:
    out: Counter[tuple] = Counter()
    for slot, n, inside in zip(slots_of(codes, parents, at, chrome, main, *held), sizes, main, strict=True):
        if slot is not None and slot[1] < 0:
            out[host, slot[0], int(inside > 0)] += n
    return out


def rank_slots(parsed: DataFrame, template: DataFrame, settings: Settings) -> DataFrame:
    """(host, slot): the slots outside chrome whose data is the article; of hosts with main elements only the slots that lie mostly in them."""
    narrow = parsed.select("host", "e.vocab", "e.places", "e.parents", "e.at", "e.chrome", "e.main", F.transform("e.texts", F.length).alias("sizes"))
    mass = _over_hosts(narrow, ["parents", "at", "chrome", "main", "sizes"], Template(template, settings), _known, _weights, "host string, slot bigint, inside bigint, chars bigint")
    slots = mass.groupBy("host", "slot").agg((F.sum(F.col("chars") * (2 * F.col("inside") - 1)) > 0).alias("is_main"))
    marked = slots.where("is_main").select("host").distinct().withColumn("marked", F.lit(True))
    return slots.join(marked, "host", "left").where("is_main OR marked IS NULL").select("host", "slot")


def main_text(page: dict, known: dict[int, int], chosen: set[int]) -> str:
    """Join a page's data of the chosen slots; without a template, or where they are empty, what markup leaves."""
    if known:
        slots = slots_of(page["codes"], page["parents"], page["at"], page["chrome"], page["main"], known)
        kept = [t for t, s, m in zip(page["texts"], slots, page["main"], strict=True) if s is not None and s[1] < 0 and (m or s[0] in chosen)]
        if kept:
            return "\n".join(kept)
    else:
        slots = [(0, root) for root in page["chrome"]]
    plain = [(t, m) for t, s, m in zip(page["texts"], slots, page["main"], strict=True) if s is not None and s[1] < 0]
    return "\n".join(t for t, m in plain if m or not any(m for _, m in plain))


def parse_table(pages: DataFrame, url: str, html: str, keep_html: bool = True) -> DataFrame:
    """The written table (host, row, e): `row` has the columns of pages, `e` the events."""
    kept = [c for c in pages.columns if keep_html or c.lower() != html.lower()]
    rows = pages.select(host_of(F.col(f"`{url}`")).alias("host"), F.struct(*[F.col(f"`{c}`") for c in kept]).alias("row"), F.col(f"`{html}`").alias("html"))
    return materialize(parse_pages(rows, "html", "e").select("host", "row", "e"), "page-events")


def _slots(entries: list[dict]) -> tuple[dict[int, int], set[int]]:
    return {t["code"]: t["class"] for t in entries if t["event"]}, {t["code"] for t in entries if not t["event"]}


def extract_main_text(pages: DataFrame, url: str = "url", html: str = "html", out: str = "main_text", settings: Settings = Settings(), keep_html: bool = True) -> DataFrame:
    """pages plus the string `out`; one output row per input row. A column of pages that is called `out` is replaced; without `keep_html` the source is left out."""
    plain = pages.select(*[F.col(f"`{c}`") for c in pages.columns if c.lower() != out.lower()])
    parsed = parse_table(plain, url, html, keep_html)
    valid = valid_classes(parsed, settings)
    chosen = rank_slots(parsed, valid, settings).select("host", F.lit(0).cast("long").alias("class"), F.col("slot").alias("code"), F.lit(False).alias("event"))
    whole = materialize(valid.select("host", "class", "code", F.lit(True).alias("event")).unionByName(chosen), "page-slots")
    drop_materialized(valid)
    template = Template(whole, settings)
    columns = ["vocab", "places", "parents", "at", "texts", "chrome", "main"]
    given = parsed.schema["row"].dataType
    joined = template.over(parsed.select("host", "row", *[F.col(f"e.{c}") for c in columns]))
    bounded_batches(pages.sparkSession, 256)
    schema = T.StructType([T.StructField("row", given), T.StructField("__text", T.StringType())])
    sent = template.sent

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        read = entry_reader(sent, _slots)
        for batch in batches:
            hosts = batch.column("host").to_pylist()
            rows = zip(*(batch.column(c).to_pylist() for c in columns), strict=True)
            made = []
            for i, (host, row) in enumerate(zip(hosts, rows, strict=True)):
                page = dict(zip(columns, row, strict=True))
                page["codes"] = [page["vocab"][k] for k in page["places"]]
                made.append(main_text(page, *(read(batch, i, host) or ({}, set()))))
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(made, pa.string())], ["row", "__text"])

    done = joined.mapInArrow(run, schema)
    return done.select(*[F.col(f"row.`{c}`").alias(c) for c in given.names], F.col("__text").alias(out))
