"""Text and keyword expressions. All of them stay in the JVM; NFC, which Spark lacks, is one guarded Arrow UDF."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: White space as Python's `\\s` has it: Java's Unicode property and the four separators that it lacks.
WS = "(?U:[\\s\\x1c-\\x1f])"
#: Characters that hashing folds or drops.
FOLDED = "“”‘’–—\u200b\u200c\u200d\ufeff"
#: Something that composition (NFC) may change. The listed ranges hold only characters that are their own composed form and compose with nothing before them.
DECOMPOSED = "[^\\u0000-\\u02FF\\u0375-\\u037D\\u037F-\\u0386\\u0388-\\u0482\\u048A-\\u0590\\u2010-\\u20CF\\u2100-\\u2125\\u3001-\\u3029\\u3041-\\u3098\\u30A0-\\u30FF\\u4E00-\\u9FFF\\uAC00-\\uD7A3\\uFF01-\\uFFEE\\x{1F300}-\\x{1FAFF}]"

#: Lines that start like this and repeat are calls to action.
CTA_STARTERS = ("apply now", "know more", "learn more", "click here", "read more", "check now", "download app")
#: Words that carry no meaning in a query.
STOPWORDS = ("i", "me", "my", "we", "our", "you", "your", "want", "need", "book", "please", "can", "could", "would", "how", "what", "is", "are", "to", "for", "a", "an", "the", "of", "on", "in", "with", "do")
#: Words after which a brand takes its second word too.
BRAND_STOPWORDS = ("a", "the", "my", "new", "buy", "get")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value) with value evaluated once, however often body uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def empty_if_null(x: Column) -> Column:
    return F.coalesce(x, F.lit(""))


def blank_to_null(x: Column) -> Column:
    return F.when(strip(x) != "", x)


def collapse(x: Column) -> Column:
    """White space runs to one space, ends trimmed, NULL to ''."""
    return F.trim(F.regexp_replace(empty_if_null(x), f"{WS}+", " "))


def strip(x: Column) -> Column:
    return F.regexp_replace(x, f"^{WS}+|{WS}+$", "")


def join_present(separator: str, *parts: Column) -> Column:
    return F.concat_ws(separator, *[F.when(p != "", p) for p in parts])


@F.pandas_udf(T.StringType())
def _nfc(values):
    import unicodedata

    return values.map(lambda v: v if v is None else unicodedata.normalize("NFC", v))


def beyond_latin1(x: Column) -> Column:
    """Whether a text has a character above U+00FF. Only such texts hold any that hashing folds, drops or composes; a text of as many bytes as characters has none, which costs next to nothing to see."""
    return (F.octet_length(x) != F.length(x)) & x.rlike("[^\\x00-\\xFF]")


def nfc(x: Column, trusted: bool = False) -> Column:
    """Canonical composition. Only texts that it may change go through the UDF; with `trusted` the text is known to be composed and no Python is planned."""
    if trusted:
        return x
    open_ = beyond_latin1(x) & x.rlike(DECOMPOSED)
    # null where the text is composed already
    return F.coalesce(_nfc(F.when(open_, x)), x)


def normalize_for_hash(x: Column, composed: bool = False) -> Column:
    """Markdown without what differs from crawl to crawl: composition, line ends, zero-width characters, typographic quotes and dashes, case, white space."""
    return collapse(F.lower(let(nfc(empty_if_null(x), composed), _folded)))


def normalize_text_for_hash(x: Column, composed: bool = False) -> Column:
    """The shorter normal form of labels and titles: composed, without zero-width characters, lower-cased, white space collapsed; quotes and dashes stay."""
    return collapse(F.lower(F.regexp_replace(nfc(empty_if_null(x), composed), "[\\u200B-\\u200D\\uFEFF]", "")))


def _folded(text: Column) -> Column:
    return F.when(beyond_latin1(text), F.translate(text, FOLDED, "\"\"''--")).otherwise(text)


def content_hash(markdown: Column, composed: bool = False) -> Column:
    return F.sha2(normalize_for_hash(markdown, composed), 256)


def normalize_body(x: Column) -> Column:
    unix = F.regexp_replace(empty_if_null(x), "\r\n|\r", "\n")
    return strip(F.regexp_replace(F.regexp_replace(unix, "[ \t]+\n", "\n"), "\n{3,}", "\n\n"))


def split_blocks(x: Column) -> Column:
    return F.filter(F.transform(F.split(x, f"\n{WS}*\n+"), strip), lambda b: b != "")


def page_body(*candidates: Column) -> Column:
    """The first text that is not blank."""
    return F.coalesce(*[strip(blank_to_null(c)) for c in candidates], F.lit(""))


def prefix_text(text: Column, prefix: Column) -> Column:
    """`prefix | text`, once, whatever the case."""
    t, p = strip(empty_if_null(text)), strip(empty_if_null(prefix))
    return F.when(p == "", t).when(t == "", p).when((F.lower(t) == F.lower(p)) | F.startswith(F.lower(t), F.concat(F.lower(p), F.lit(" | "))), t).otherwise(F.concat_ws(" | ", p, t))


def split_keywords(x: Column) -> Column:
    """Comma string to list; case and repetition stay."""
    return F.filter(F.transform(F.split(collapse(x), ","), lambda k: F.trim(k)), lambda k: k != "")


def keyword_list(x: Column) -> Column:
    return F.filter(F.transform(x, collapse), lambda k: k != "")


def clean_keywords(keywords: Column) -> Column:
    return F.array_join(keywords, " ")


def prefix_keywords(keywords: Column, prefix: Column) -> Column:
    p = strip(empty_if_null(prefix))
    present = F.coalesce(F.lower(F.get(keywords, F.lit(0))) == F.lower(p), F.lit(False))
    return F.when((p == "") | present, keywords).otherwise(F.concat(F.array(p), keywords))


def normalize_keywords(x: Column) -> Column:
    """Lower-cased, distinct in order of appearance, no blanks; commas separate."""
    return F.array_distinct(F.filter(F.transform(F.split(empty_if_null(x), ","), lambda k: F.lower(strip(k))), lambda k: k != ""))


def tokenize(x: Column) -> Column:
    return F.regexp_extract_all(F.lower(x), F.lit("[a-z0-9]+"), F.lit(0))


def n_tokens(x: Column) -> Column:
    """How many tokens a text has, without a list of them."""
    return F.regexp_count(F.lower(x), F.lit("[a-z0-9]+"))


def counted(tokens: Column) -> Column:
    """array<struct<term, tf, len>> of a list of tokens: each distinct one with its number and the list's length, from runs of the sorted list."""
    none = F.array().cast("array<struct<term:string,tf:int,len:int>>")

    def runs(ts: Column) -> Column:
        starts = F.filter(F.sequence(F.lit(0), F.size(ts) - 1), lambda i: (i == 0) | (F.get(ts, i) != F.get(ts, i - 1)))
        return let(starts, lambda at: F.transform(at, lambda i, k: F.struct(F.get(ts, i).alias("term"), (F.coalesce(F.get(at, k + 1), F.size(ts)) - i).alias("tf"), F.size(ts).alias("len"))))

    return let(F.sort_array(tokens), lambda ts: F.when(F.size(ts) > 0, runs(ts)).otherwise(none))


def core_tokens(x: Column, enabled: bool = True, min_tokens: int = 4, stopwords: tuple[str, ...] = STOPWORDS) -> Column:
    """Distinct meaningful tokens of a query that is long enough, else none."""
    if not enabled:
        return F.array().cast("array<string>")

    def chosen(tokens: Column) -> Column:
        kept = F.array_distinct(F.filter(tokens, lambda t: (F.length(t) > 1) & ~t.isin(*stopwords)))
        return F.when(F.size(tokens) >= max(1, min_tokens), kept).otherwise(F.array().cast("array<string>"))

    return let(tokenize(x), chosen)


def _is_cta(line: Column) -> Column:
    """Whether a lower-cased line is a short call to action."""
    starts = F.startswith(line, F.lit(CTA_STARTERS[0]))
    for s in CTA_STARTERS[1:]:
        starts = starts | F.startswith(line, F.lit(s))
    return starts & (F.length(line) <= 80)


def sanitize_markdown(x: Column) -> Column:
    """Right-trimmed lines without consecutive repeats and without short calls to action that occur three times or more."""

    def unrepeated(lines: Column) -> Column:
        return F.filter(lines, lambda line, i: (i == 0) | (strip(line) == "") | (line != F.get(lines, i - 1)))

    def keep(lines: Column) -> Column:
        numbered = F.transform(lines, lambda line, i: F.struct(F.lower(strip(line)).alias("n"), i.alias("i"), line.alias("line")))
        return let(numbered, lambda rows: F.when(F.size(F.filter(rows, lambda r: _is_cta(r["n"]))) >= 3, let(F.sort_array(rows), rarer)).otherwise(lines))

    def rarer(rows: Column) -> Column:
        """The lines in their order, from rows sorted by normal form, where a line of three or more stands within two places of its like."""

        def stays(r: Column, j: Column) -> Column:
            like = lambda k: F.coalesce(F.get(rows, j + k)["n"] == r["n"], F.lit(False))
            return ~(_is_cta(r["n"]) & ((like(-2)) | (like(-1) & like(1)) | like(2)))

        back = F.sort_array(F.transform(F.filter(rows, stays), lambda r: F.struct(r["i"].alias("i"), r["line"].alias("line"))))
        return F.transform(back, lambda r: r["line"])

    lines = F.transform(F.split(F.regexp_replace(empty_if_null(x), "\r\n|\r", "\n"), "\n"), lambda line: F.regexp_replace(line, WS + "+$", ""))
    kept = let(let(lines, unrepeated), keep)
    return strip(F.regexp_replace(F.array_join(kept, "\n"), "\n{3,}", "\n\n"))


def pick_markdown(fit: Column, raw: Column) -> Column:
    return F.coalesce(strip(blank_to_null(fit)), strip(empty_if_null(raw)))


def strip_code_fences(x: Column) -> Column:
    return strip(F.regexp_replace(strip(empty_if_null(x)), "^```(?:json)?|```$", ""))


def section_chunk(section: str, items: Column) -> Column:
    present = F.filter(items, lambda i: i != "")
    return F.when(F.size(present) > 0, F.concat(F.lit(f"[{section}] "), F.array_join(present, " | "))).otherwise("")


def half_description(x: Column, reference_behaviour: bool = True) -> Column:
    """The first half of the text, or, without the quirk, the first half only where both halves are equal."""
    half = F.left(x, F.floor(F.length(x) / 2).cast("int"))
    if reference_behaviour:
        return half
    return F.when((F.length(x) % 2 == 0) & (F.concat(half, half) == x), half).otherwise(x)


def first_word_brand(name: Column, stopwords: tuple[str, ...] = BRAND_STOPWORDS) -> Column:
    words = F.filter(F.split(empty_if_null(name), WS + "+"), lambda w: w != "")
    return let(words, lambda w: F.when(F.size(w) == 0, "").when(F.lower(F.get(w, F.lit(0))).isin(*stopwords), F.array_join(F.slice(w, 1, 2), " ")).otherwise(F.get(w, F.lit(0))))


def safe_int(x: Column, kind: str = "string") -> Column:
    """Integer of a decimal string, NULL for anything else; of a number (kind `double`) its part before the point, of a `boolean` 1 or 0."""
    if kind == "boolean":
        return x.cast("int").cast("long")
    if kind == "double":
        return F.when(F.isnan(x) | (F.abs(x) >= 2.0**63), None).otherwise(F.when(x < 0, F.ceil(x)).otherwise(F.floor(x)).try_cast("long"))
    return F.when(strip(x).rlike("^[+-]?[0-9]+(?:_[0-9]+)*$"), F.replace(strip(x), F.lit("_"), F.lit(""))).try_cast("long")


def non_empty_lines(x: Column) -> Column:
    """How many lines of a text hold more than white space."""
    return F.size(F.filter(F.split(empty_if_null(x), "\r\n|\r|\n"), lambda line: strip(line) != ""))


def promo_code(x: Column) -> Column:
    return F.nullif(F.regexp_extract(empty_if_null(x), "(?i)promo\\s*code\\s*[:\\-]?\\s*([A-Z0-9]+)", 1), F.lit(""))


def grouped_int(x: Column, pattern: str = "([0-9][0-9,]*)") -> Column:
    """The first number with thousands separators."""
    return F.replace(F.regexp_extract(empty_if_null(x), pattern, 1), F.lit(","), F.lit("")).try_cast("int")


def prefix_match(keyword: Column, prefix_tokens: Column) -> Column:
    """Whether consecutive words of the keyword start with the typed tokens, as in a typeahead."""

    def body(words: Column) -> Column:
        m = F.size(prefix_tokens)
        places = F.when(F.size(words) >= m, F.sequence(F.lit(0), F.size(words) - m)).otherwise(F.array().cast("array<int>"))
        return (m == 0) | F.exists(places, lambda s: F.forall(F.sequence(F.lit(0), m - 1), lambda i: F.startswith(F.get(words, s + i), F.get(prefix_tokens, i))))

    return let(F.filter(F.split(collapse(F.lower(keyword)), " "), lambda w: w != ""), body)
