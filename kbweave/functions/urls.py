"""URL expressions: parts by the RFC 3986 pattern, stable keys, readable path text, admission rules."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kbweave.functions.text import collapse, empty_if_null, let, strip

#: Fixed pattern: appendix B of RFC 3986; groups 2 scheme, 4 authority, 5 path, 7 query, 9 fragment.
URL = "^(([a-zA-Z][a-zA-Z0-9+.-]*):)?(//([^/?#]*))?([^?#]*)(\\?([^#]*))?(#(.*))?$"
#: Path segments that only name a language.
LANGUAGE_SEGMENTS = ("en", "hi", "fr", "de", "es", "it", "pt", "ja", "ko", "zh", "ar", "ru")
#: Error texts after which a page is fetched again.
RETRYABLE_MARKERS = (
    "timeout", "timed out", "navigation", "failed on navigating", "connection", "net::", "err_empty_response", "proxy direct failed",
    "acs-goto", "page.goto: timeout", "blocked by anti-bot", "anti-bot protection", "429", "503", "temporarily unavailable",
)
#: File types that are not crawled, in the order in which they are tried.
SKIP_EXTENSIONS = (".pdf", ".png", ".jpg", ".jpeg", ".webp", ".gif", ".svg", ".zip", ".mp4", ".mov", ".avi", ".mp3", ".wav")


@dataclass(frozen=True)
class CrawlRules:
    """What a crawl admits. The host and the block lists belong to a site and are given by whoever configures the crawl."""

    host: str = "www.example.com"
    blocked_urls: tuple[str, ...] = ()
    asset_paths: tuple[str, ...] = ("/assets/", "/static-resources/")
    blocked_substrings: tuple[str, ...] = ("/hi/", "/sites", "mailto:", "/en/corporate/", "resolution-framework", "compare-cards.page")
    max_path: int = 350


def part(url: Column, group: int) -> Column:
    return F.regexp_extract(empty_if_null(url), URL, group)


def scheme(url: Column) -> Column:
    return F.lower(part(url, 2))


def domain(url: Column) -> Column:
    return F.lower(part(url, 4))


def path(url: Column, params: bool = True) -> Column:
    """Path; without `params` what follows the last segment's semicolon is cut, as urlparse does."""
    whole = part(url, 5)
    return whole if params else F.regexp_replace(whole, ";[^/]*$", "")


@F.pandas_udf(T.StringType())
def _normalize_any(urls):
    from urllib.parse import parse_qsl, urlencode, urlsplit, urlunsplit

    def one(url):
        if not url:
            return ""
        try:
            parts = urlsplit(url.strip())
            query = urlencode(sorted(parse_qsl(parts.query, keep_blank_values=True), key=lambda kv: kv[0]))
            return urlunsplit(((parts.scheme or "https").lower(), parts.netloc.lower(), parts.path or "/", query, ""))
        except ValueError:  # an unbalanced bracket in the host
            return None

    return urls.map(one)


def normalize_clean_url(url: Column) -> Column:
    """Key of a URL whose query needs no re-encoding; built from JVM expressions only."""

    def body(u: Column) -> Column:
        pairs = F.filter(F.split(part(u, 7), "&"), lambda p: p != "")
        keyed = F.transform(pairs, lambda p, i: F.struct(F.substring_index(p, "=", 1).alias("k"), i.alias("i"), F.when(F.contains(p, F.lit("=")), p).otherwise(F.concat(p, F.lit("="))).alias("p")))
        query = F.array_join(F.transform(F.array_sort(keyed), lambda s: s["p"]), "&")
        base = F.concat(F.coalesce(F.nullif(scheme(u), F.lit("")), F.lit("https")), F.lit("://"), domain(u), F.coalesce(F.nullif(part(u, 5), F.lit("")), F.lit("/")))
        return F.when(u == "", "").otherwise(F.concat(base, F.when(query == "", "").otherwise(F.concat(F.lit("?"), query))))

    return let(strip(empty_if_null(url)), body)


#: Absolute URLs with an authority whose query has nothing to decode or to encode.
CLEAN = "^\\s*$|^\\s*[a-zA-Z][a-zA-Z0-9+.-]*://[^\\s/?#\\[\\]]+(/[^\\s?#]*)?(\\?[A-Za-z0-9_.&=-]*)?(#\\S*)?\\s*$"


def normalize_url(url: Column, clean: bool = False) -> Column:
    """Stable key of a URL. `clean` promises that all URLs match CLEAN, and then no Python is planned."""
    fast = normalize_clean_url(url)
    if clean:
        return fast
    return F.when(empty_if_null(url).rlike(CLEAN), fast).otherwise(_normalize_any(F.when(~empty_if_null(url).rlike(CLEAN), url)))


def doc_id(normalized_url: Column) -> Column:
    return F.sha2(normalized_url, 256)


def _segments(value: Column) -> Column:
    return F.filter(F.split(let(collapse(value), lambda v: F.coalesce(F.nullif(path(v, params=False), F.lit("")), v)), "/"), lambda s: s != "")


def _readable(segment: Column) -> Column:
    bare = F.when(F.contains(segment, F.lit(".")), F.regexp_replace(segment, "\\.[^.]*$", "")).otherwise(segment)
    return collapse(F.regexp_replace(F.translate(bare, "-_", "  "), "[^A-Za-z0-9\\s]", " "))


def path_text(value: Column) -> Column:
    """Words of a URL's path: the last segment if it has several, else all but the language segments."""

    def body(segments: Column) -> Column:
        words = F.filter(F.transform(segments, _readable), lambda w: (w != "") & ~(F.lower(w).isin(*LANGUAGE_SEGMENTS) & (F.size(segments) > 1)))
        return let(words, lambda w: F.when(F.size(w) == 0, "").when(F.contains(F.element_at(w, -1), F.lit(" ")), F.element_at(w, -1)).otherwise(F.array_join(w, " ")))

    return let(_segments(value), body)


def last_path_param(value: Column, letters_only: bool = True) -> Column:
    """Words of the last segment without its suffix; as a crawl record has them (`letters_only` off) other characters than dashes and underscores stay."""
    plain = lambda s: collapse(F.translate(F.regexp_replace(s, "\\.[^.]*$", ""), "-_", "  "))
    return let(_segments(value), lambda s: F.when(F.size(s) == 0, "").otherwise((_readable if letters_only else plain)(F.element_at(s, -1))))


def absolute_url(href: Column, base: Column) -> Column:
    """href against the page's URL by RFC 3986, section 5.2: dot segments are removed, a query or fragment alone keeps the path."""

    def merged(h: Column, b: Column) -> Column:
        root = F.concat(scheme(b), F.lit("://"), part(b, 4))
        folder = F.regexp_replace(F.coalesce(F.nullif(part(b, 5), F.lit("")), F.lit("/")), "[^/]*$", "")
        own = part(h, 5)
        raw = F.when(F.startswith(own, F.lit("/")), own).otherwise(F.concat(folder, own))
        steps = F.aggregate(
            F.split(raw, "/"),
            F.array().cast("array<string>"),
            lambda done, s: F.when(s == "..", F.when(F.size(done) > 1, F.slice(done, 1, F.greatest(F.size(done) - 1, F.lit(0)))).otherwise(done)).when(s == ".", done).otherwise(F.concat(done, F.array(s))),
        )
        open_end = F.when(raw.rlike("/\\.{1,2}$"), "/").otherwise("")
        tail = F.concat(F.when(part(h, 6) != "", part(h, 6)).otherwise(""), F.when(part(h, 8) != "", part(h, 8)).otherwise(""))
        query = F.when(part(h, 6) != "", part(h, 6)).otherwise(part(b, 6))
        return (
            F.when(h == "", b)
            .when(part(h, 2) != "", h)
            .when(F.startswith(h, F.lit("//")), F.concat(scheme(b), F.lit(":"), h))
            .when(own == "", F.concat(root, part(b, 5), query, part(h, 8)))
            .otherwise(F.concat(root, F.array_join(steps, "/"), open_end, tail))
        )

    return let(F.struct(F.trim(empty_if_null(href)).alias("h"), F.trim(empty_if_null(base)).alias("b")), lambda x: merged(x["h"], x["b"]))


def record_path(path_value: Column, source_url: Column) -> Column:
    return let(collapse(path_value), lambda p: F.when(p != "", p).otherwise(path(collapse(source_url), params=False)))


def is_login_redirect(url: Column) -> Column:
    return F.contains(F.lower(path(url, params=False)), F.lit("login"))


def canonical_offer_url(raw: Column, base: str) -> Column:
    """Detail links with an id in the query become paths; doubled suffixes are collapsed."""
    url = F.when(F.startswith(strip(raw), F.lit("/")), F.concat(F.lit(base), strip(raw))).otherwise(strip(raw))

    def body(u: Column) -> Column:
        ident = strip(F.substring_index(F.substring_index(u, "offer-id=", -1), "&", 1))
        byid = F.contains(u, F.lit("offer-detail.page")) & F.contains(u, F.lit("offer-id="))
        return F.replace(F.when(byid, F.concat(F.lit(f"{base}/offer/"), ident, F.lit(".page"))).otherwise(u), F.lit(".page.page"), F.lit(".page"))

    return let(url, body)


def slug_id(value: Column, size: int = 12, digest: str = "md5") -> Column:
    """The first digits of a digest: md5 for offers and rewards, sha256 for runs of people pages, sha1 for file names."""
    made = {"md5": F.md5, "sha1": F.sha1, "sha256": lambda v: F.sha2(v, 256)}[digest]
    return F.substring(made(value), 1, size)


def safe_file_name(url: Column, longest: int = 140) -> Column:
    """Host, path and a digest of the query as a file name without its suffix; `writers.unique_names` numbers those that repeat."""
    words = F.replace(F.coalesce(F.nullif(F.regexp_replace(path(url, params=False), "^/+|/+$", ""), F.lit("")), F.lit("home")), F.lit("/"), F.lit("_"))
    query = F.when(part(url, 7) != "", F.concat(F.lit("_"), slug_id(part(url, 7), 8, "sha1"))).otherwise("")
    safe = F.regexp_replace(F.regexp_replace(F.concat(part(url, 4), F.lit("_"), words, query), "[^a-zA-Z0-9._-]+", "-"), "^[-_.]+|[-_.]+$", "")
    return F.left(F.coalesce(F.nullif(safe, F.lit("")), F.lit("page")), F.lit(longest))


def blocklists(rules: CrawlRules) -> tuple[list[str], list[str], list[str]]:
    """(normalized URLs, paths, basenames) of the blocked URLs, cleaned of trailing commas and encoded quotes."""
    from urllib.parse import urlsplit

    cleaned = [u.strip().rstrip(",").replace("%22", "").strip() for u in rules.blocked_urls]
    parts = [urlsplit(u) for u in cleaned if u]
    urls = [f"{(p.scheme or 'https').lower()}://{p.netloc.lower()}{p.path or '/'}" for p in parts]
    paths = [p.path.lower().rstrip("/") for p in parts if p.path.rstrip("/")]
    return sorted(set(urls)), sorted(set(paths)), sorted({p.rsplit("/", 1)[-1] for p in paths} - {""})


def any_contains(x: Column, markers: tuple[str, ...]) -> Column:
    out = F.lit(False)
    for m in markers:
        out = out | F.contains(x, F.lit(m))
    return out


def admission_reason(url: Column, status_code: Column, rules: CrawlRules = CrawlRules()) -> Column:
    """Why a URL is not crawled, first rule wins; `ok` if it is."""
    urls, paths, names = blocklists(rules)
    listed = lambda x, values: x.isin(*values) if values else F.lit(False)

    def body(given: Column) -> Column:
        raw = given["url"]
        lower = F.lower(raw)
        where = F.lower(path(raw, params=False))
        key = F.regexp_replace(where, "/+$", "")
        out = (
            F.when(F.coalesce(status_code == 404, F.lit(False)), "http_404")
            .when(raw == "", "empty_url")
            .when(raw.rlike("[\\[\\]]"), "bracket_url")
            .when(domain(raw) != rules.host, "non_www_domain")
            .when(given["blocked"], "blocklisted_url")
            .when((key != "") & listed(key, paths), "blocklisted_path")
            .when(listed(F.substring_index(where, "/", -1), names), "blocklisted_basename")
            .when(F.contains(where, F.lit("/en/en/en/")), "repeated_lang_segments")
            .when(any_contains(where, rules.asset_paths), "asset_path")
            .when(F.length(where) > rules.max_path, "path_too_long")
            .when(F.contains(lower, F.lit("%22")), "malformed_url")
            .when(any_contains(where, rules.blocked_substrings) | any_contains(lower, rules.blocked_substrings), "blocked_path_substring")
        )
        for extension in SKIP_EXTENSIONS:
            out = out.when(F.endswith(where, F.lit(extension)), f"ext_{extension[1:]}")
        return out.otherwise("ok")

    # the key of a URL with escapes or spaces takes a UDF, which must stand outside the body
    blocked = F.coalesce(listed(normalize_url(url), urls), F.lit(False)) if urls else F.lit(False)
    return let(F.struct(strip(empty_if_null(url)).alias("url"), blocked.alias("blocked")), body)


def is_retryable(url: Column, success: Column, status_code: Column, error: Column, rules: CrawlRules = CrawlRules()) -> Column:
    failed = ~F.coalesce(success, F.lit(False))
    return failed & (domain(url) == rules.host) & (admission_reason(url, status_code, rules) == "ok") & any_contains(F.lower(empty_if_null(error)), RETRYABLE_MARKERS)
