"""HTML: head metadata by patterns in the JVM, detail pages by stdlib parsers in Arrow UDFs."""

from __future__ import annotations

from html.parser import HTMLParser

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kbweave.functions.text import collapse, empty_if_null

_META = "<meta[^>]+{0}=[\"']{1}[\"'][^>]+content=[\"'](.*?)[\"']"
#: Fixed patterns of head fields.
HEAD_PATTERNS = {
    "title": "<title[^>]*>(.*?)</title>",
    "description": _META.format("name", "description"),
    "keywords": _META.format("name", "keywords"),
    "canonical_url": "<link[^>]+rel=[\"']canonical[\"'][^>]+href=[\"'](.*?)[\"']",
    "robots": _META.format("name", "robots"),
    "language": "<html[^>]+lang=[\"'](.*?)[\"']",
    **{f"og:{k}": _META.format("property", f"og:{k}") for k in ("title", "description", "url", "type")},
    **{f"twitter:{k}": _META.format("name", f"twitter:{k}") for k in ("title", "description")},
}
#: The references that are decoded without a UDF.
REFERENCES = (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&apos;", "'"), ("&nbsp;", " "), ("&copy;", "©"), ("&middot;", "·"), ("&amp;", "&"))
#: Those that markup itself needs.
MARKUP_REFERENCES = (("&lt;", "<"), ("&gt;", ">"), ("&amp;", "&"))


@F.pandas_udf(T.StringType())
def _unescape(values):
    import html

    return values.map(lambda v: v if v is None else html.unescape(v))


def unescape(x: Column, common_only: bool = False, references: tuple[tuple[str, str], ...] | None = None) -> Column:
    """Character references to characters; `common_only` promises that only REFERENCES occur, `references` are the ones to decode in order, others stay."""
    if not common_only and references is None:
        return _unescape(x)
    for name, char in REFERENCES if references is None else references:
        x = F.replace(x, F.lit(name), F.lit(char))
    return x


def head_field(html: Column, field: str, common_only: bool = False, references: tuple[tuple[str, str], ...] | None = None) -> Column:
    found = F.regexp_extract(empty_if_null(html), "(?is)" + HEAD_PATTERNS[field], 1)
    return F.nullif(collapse(unescape(found, common_only, references)), F.lit(""))


def head_metadata(html: Column, common_only: bool = False) -> Column:
    """map of the head fields that are present."""
    every = F.map_from_arrays(F.array(*[F.lit(k) for k in HEAD_PATTERNS]), F.array(*[head_field(html, k, common_only) for k in HEAD_PATTERNS]))
    return F.map_filter(every, lambda _, v: v.isNotNull())


def metadata_block(fixed: Column, flat: Column, head: Column, depth: Column) -> Column:
    """Metadata of a page: fixed fields first, then flattened ones (dots become colons), then the head's, then a default depth."""
    dotted = F.transform_keys(flat, lambda k, _: F.replace(k, F.lit("."), F.lit(":")))
    known = F.map_keys(fixed)
    more = F.map_filter(dotted, lambda k, _: ~F.array_contains(known, k))
    rest = F.map_filter(head, lambda k, _: ~F.array_contains(known, k) & ~F.array_contains(F.map_keys(dotted), k))
    deep = F.map_filter(F.create_map(F.lit("depth"), depth.cast("string")), lambda k, _: ~F.array_contains(known, k) & ~F.array_contains(F.map_keys(dotted), k))
    return F.map_concat(fixed, more, rest, deep)


#: Open elements that a start tag ends.
ENDED_BY = {"li": {"li"}, "p": {"p"}, "td": {"td", "th"}, "th": {"td", "th"}, "tr": {"td", "th", "tr"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "option": {"option"}, **{h: {"p"} for h in ("h1", "h2", "h3", "h4", "ul", "ol", "table", "div")}}


class _Reader(HTMLParser):
    """Flat list of (tag, attributes, text) in document order; text is what stands inside until the element ends."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.items: list[list] = []
        self.open: list[int] = []

    def handle_starttag(self, tag, attrs):
        for k in range(len(self.open) - 1, -1, -1):  # end tags that may be left out
            outer = self.items[self.open[k]][0]
            if outer in ENDED_BY.get(tag, ()):
                del self.open[k:]
            elif outer in ("table", "ul", "ol", "dl", "select"):
                break
        self.items.append([tag, dict(attrs), []])
        if tag not in ("br", "img", "input", "link", "meta", "hr"):
            self.open.append(len(self.items) - 1)

    def handle_endtag(self, tag):
        for k in range(len(self.open) - 1, -1, -1):
            if self.items[self.open[k]][0] == tag:
                del self.open[k:]
                return

    def handle_data(self, data):
        if not any(self.items[k][0] in ("script", "style") for k in self.open):
            for k in self.open:
                self.items[k][2].append(data)


def elements(html: str | None) -> list[tuple[str, dict, str]]:
    reader = _Reader()
    reader.feed(html or "")
    reader.close()
    return [(tag, attrs, " ".join("".join(parts).split())) for tag, attrs, parts in reader.items]


def parse_table(html: str | None) -> list[dict[str, str]]:
    """Rows of the first table as maps; the first row names the columns, surplus cells are called col_i."""
    rows: list[list[str]] = []
    for tag, _, text in elements(html):
        if tag == "tr":
            rows.append([])
        elif tag in ("td", "th") and rows:
            rows[-1].append(text)
        elif tag == "table" and rows:
            break
    rows = [r for r in rows if r]
    if len(rows) < 2:
        return []
    head = rows[0]
    return [{(head[i] if i < len(head) and head[i] else f"col_{i}"): cell for i, cell in enumerate(r)} for r in rows[1:]]


#: Section names of an offer's detail page and the headings that open them.
SECTIONS = {"summary_text": ("summary", "offer details", "about"), "eligible_cards": ("eligible cards", "applicable cards"), "steps_to_avail": ("how to avail", "steps"), "terms_and_conditions": ("terms", "conditions")}


def parse_detail(html: str | None) -> dict:
    """Title, sections and table of an offer or reward page: headings open a section, paragraphs and list items fill it."""
    out: dict = {"title": None, "image_url": None, "validity": None, **{s: [] for s in SECTIONS}}
    section = "summary_text"
    for tag, attrs, text in elements(html):
        if tag == "h1" and text and out["title"] is None:
            out["title"] = text
        elif tag in ("h2", "h3", "h4", "strong") and text:
            low = text.lower()
            section = next((s for s, heads in SECTIONS.items() if any(h in low for h in heads)), section)
            if "valid" in low:
                out["validity"] = text
        elif tag == "img" and attrs.get("src") and out["image_url"] is None:
            out["image_url"] = attrs["src"]
        elif tag in ("p", "li") and len(text) >= 3:
            if "valid" in text.lower() and out["validity"] is None:
                out["validity"] = text
            if text not in out[section]:
                out[section].append(text)
    out["table"] = parse_table(html)
    return out


DETAIL = T.StructType(
    [
        T.StructField("title", T.StringType()),
        T.StructField("image_url", T.StringType()),
        T.StructField("validity", T.StringType()),
        *[T.StructField(s, T.ArrayType(T.StringType())) for s in SECTIONS],
        T.StructField("table", T.ArrayType(T.MapType(T.StringType(), T.StringType()))),
    ]
)


@F.udf(DETAIL, useArrow=True)
def page_detail(html):
    return parse_detail(html)


#: Where a reward page keeps its fields, as (tag, attribute, value or prefix of it).
REWARD_FIELDS = {"name": ("h1", "class", "product-title"), "price": ("h2", "class", "new-price"), "pay": ("div", "id", "pointsnpay"), "delivery": ("h3", "id", "estimated-delivery"), "cities": ("span", "class", "rwd-tooltip"), "code": ("span", "id", "item-code")}


#: Fixed patterns: where a reward page's texts hold points, points with cash, days and cities.
REWARD_PATTERNS = {"price": r"(\d[\d,]+)", "pay": r"(?i)pay[:\s]+([\d,]+)\s*\+\s*(?:Rs\.?|₹)\s*([\d,]+)", "delivery": r"\d+", "cities": r"(?i)^only\s+available\s+in\s*"}


def list_items(html: str | None, box: str) -> list[str]:
    """Texts of the list items inside the first div of a class."""
    import re

    start = re.search(rf"(?is)<div\b[^>]*\bclass\s*=\s*[\"'][^\"']*(?<![\w-]){box}(?![\w-])[^\"']*[\"'][^>]*>", html or "")
    if not start:
        return []
    depth, end = 1, len(html)
    for m in re.finditer(r"(?i)<(/?)div\b[^>]*>", html[start.end() :]):
        depth += -1 if m.group(1) else 1
        if not depth:
            end = start.end() + m.start()
            break
    return [text for tag, _, text in elements(html[start.end() : end]) if tag == "li" and text]


def parse_reward(html: str | None) -> dict:
    """Name, points, points and cash, item codes, features (of the features box), delivery days and cities of a reward page."""
    import re

    found: dict[str, str] = {}
    out: dict = {"item_code_points": None, "item_code_pointspay": None, "features": list_items(html, "brief-features")}
    for tag, attrs, text in elements(html):
        for field, (t, attribute, value) in REWARD_FIELDS.items():
            if tag == t and any(v.startswith(value) for v in (attrs.get(attribute) or "").split()):
                found.setdefault(field, text)
        if tag == "input" and (attrs.get("data-itemcode") or "").strip():
            kind = "item_code_pointspay" if "points+pay" in (attrs.get("data-paytype") or "").lower().replace(" ", "") else "item_code_points"
            out[kind] = attrs["data-itemcode"].strip()
    number = lambda s: int(s.replace(",", "")) if s else None
    price, pay, days = (re.search(REWARD_PATTERNS[k], found.get(k, "")) for k in ("price", "pay", "delivery"))
    cities = re.sub(REWARD_PATTERNS["cities"], "", found.get("cities", ""))
    return out | {
        "product_name": found.get("name") or None,
        "points_only": number(price and price.group(1)),
        "points_pay_points": number(pay and pay.group(1)),
        "points_pay_cash": number(pay and pay.group(2)),
        "item_code_points": out["item_code_points"] or found.get("code"),
        "estimated_delivery_days": number(days and days.group()),
        "available_cities": [c.strip() for c in cities.split(",") if c.strip()],
    }


REWARD = T.StructType(
    [T.StructField(n, T.StringType()) for n in ("product_name", "item_code_points", "item_code_pointspay")]
    + [T.StructField(n, T.IntegerType()) for n in ("points_only", "points_pay_points", "points_pay_cash", "estimated_delivery_days")]
    + [T.StructField(n, T.ArrayType(T.StringType())) for n in ("features", "available_cities")]
)


@F.udf(REWARD, useArrow=True)
def reward_detail(html):
    return parse_reward(html)


@F.udf(T.ArrayType(T.StructType([T.StructField("href", T.StringType()), T.StructField("text", T.StringType())])), useArrow=True)
def page_links(html):
    """Anchors in order, the first of each target."""
    seen: dict[str, str] = {}
    for tag, attrs, text in elements(html):
        target = attrs.get("href") if tag == "a" else attrs.get("data-url")
        if target and target not in seen:
            seen[target] = text
    return [{"href": h, "text": t} for h, t in seen.items()]


@F.udf(T.ArrayType(T.StructType([T.StructField("section", T.StringType()), T.StructField("name", T.StringType()), T.StructField("text", T.StringType())])), useArrow=True)
def page_people(html):
    """People and paragraphs by section (history, board, management): a heading opens a section, h3/h4 name a person, p describes."""
    out, section, name = [], "history", None
    for tag, _, text in elements(html):
        low = text.lower()
        if tag in ("h1", "h2") and text:
            section = "board" if "board" in low else "management" if "management" in low or "leadership" in low else "differentiators" if "different" in low or "why" in low else "history"
            name = None
        elif tag in ("h3", "h4") and text:
            name = text
        elif tag == "p" and text:
            out.append({"section": section, "name": name, "text": text})
    return out


@F.udf(T.MapType(T.StringType(), T.StringType()), useArrow=True)
def cookie_map(header):
    from http.cookies import CookieError, SimpleCookie

    try:
        return {k: m.value for k, m in SimpleCookie(header or "").items()}
    except CookieError:
        return {}


@F.udf(T.MapType(T.StringType(), T.StringType()), useArrow=True)
def flatten_json(document):
    """Nested JSON to dotted keys; arrays are joined by a comma, nested elements of arrays are JSON with sorted keys."""
    import json

    flat: dict[str, str] = {}
    todo = [("", json.loads(document))] if document else []
    while todo:
        prefix, value = todo.pop()
        if isinstance(value, dict):
            todo += [(f"{prefix}.{k}" if prefix else str(k), v) for k, v in reversed(value.items())]
        elif isinstance(value, list):
            shown = [json.dumps(v, ensure_ascii=False, sort_keys=True) if isinstance(v, (dict, list)) else str(v).strip() for v in value]
            if any(shown):
                flat[prefix] = ", ".join(s for s in shown if s)
        elif value is not None and str(value).strip():
            flat[prefix] = str(value).strip()
    return flat


def final_request(requests: Column, final_url: Column) -> Column:
    """The last request for the final URL, else the last one."""
    matching = F.filter(requests, lambda r: r["url"] == final_url)
    return F.coalesce(F.try_element_at(matching, F.lit(-1)), F.try_element_at(requests, F.lit(-1)))


def final_request_details(requests: Column, url: Column, redirected_url: Column) -> Column:
    """struct<headers, cookies> of the navigation that a page ended with: the last request for its URL or for where it was sent, else the last navigation. `requests` holds (event_type, is_navigation_request, url, headers)."""
    empty = F.create_map().cast("map<string,string>")
    walks = F.filter(requests, lambda r: (r["event_type"] == "request") & F.coalesce(r["is_navigation_request"], F.lit(False)))
    of_page = F.filter(walks, lambda r: (r["url"] == F.coalesce(url, F.lit(""))) | (r["url"] == F.coalesce(redirected_url, F.lit(""))))
    last = F.coalesce(F.try_element_at(of_page, F.lit(-1)), F.try_element_at(walks, F.lit(-1)))
    headers = F.coalesce(last["headers"], empty)
    said = F.coalesce(F.nullif(F.try_element_at(headers, F.lit("cookie")), F.lit("")), F.try_element_at(headers, F.lit("Cookie")))
    # name=value pairs between semicolons; of a name that comes twice the last value counts
    parts = F.transform(F.filter(F.split(F.coalesce(said, F.lit("")), ";"), lambda c: F.contains(c, F.lit("="))), lambda c: F.struct(F.trim(F.substring_index(c, "=", 1)).alias("key"), F.trim(F.substr(c, F.instr(c, "=") + 1)).alias("value")))
    kept = F.filter(parts, lambda x, i: (x["key"] != "") & ~F.exists(F.slice(parts, i + 2, F.size(parts)), lambda y: y["key"] == x["key"]))
    return F.struct(headers.alias("headers"), F.map_from_entries(kept).alias("cookies"))
