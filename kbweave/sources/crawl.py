"""Breadth-first crawl over a fetched page table or a pluggable fetcher.

The frontier is a table: links of the last depth that are admitted and were not seen. A fetcher is a function from a URL to HTML that
runs on the executors; without one, pages come from a table (url, html), which is how tests and replays run.
"""

from __future__ import annotations

import random
import time
from collections.abc import Callable, Iterator
from dataclasses import dataclass, replace

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kbweave.functions.dom import page_markdown
from kbweave.functions.html import final_request_details, head_field, page_links
from kbweave.functions.urls import CrawlRules, absolute_url, admission_reason, normalize_url
from kbweave.operators.crawl_records import page_records, retry_counts, retry_rounds
from kbweave.operators.pages import crawl_summary, dedupe_best_by_aggregate


def polite_get(get: Callable[[str], str], retries: int = 3, backoff: float = 2.0, jitter: float = 0.0, delay: float = 0.0) -> Callable[[str], str]:
    """get with linear back-off and up to `jitter` seconds more; the empty text after the last try. `delay` seconds pass before each fetch."""

    def fetch(url: str) -> str:
        time.sleep(delay)
        for attempt in range(1, retries + 1):
            try:
                return get(url)
            except OSError:
                if attempt < retries:
                    time.sleep(backoff * attempt + random.uniform(0, jitter))
        return ""

    return fetch


@dataclass(frozen=True)
class Tuning:
    """How a crawl fetches: large ones go slowly and wait longer, since sites answer them with blocks otherwise."""

    concurrency: int = 8
    mean_delay_s: float = 0.0  # before each fetch, and up to max_range_s more
    max_range_s: float = 0.0
    timeout_s: int = 30
    keep_requests: bool = True  # whether the requests that a page made are recorded


def tuning(max_depth: int, max_pages: int) -> Tuning:
    return Tuning(2, 0.2, 0.3, 60, False) if max_depth >= 3 or max_pages >= 150 else Tuning()


def concurrency(max_depth: int, max_pages: int) -> int:
    """Partitions that fetch at a time."""
    return tuning(max_depth, max_pages).concurrency


@dataclass(frozen=True)
class Fetched:
    """What a fetcher may say about a page beside its HTML; `requests` are dicts of event_type, is_navigation_request, url and headers."""

    html: str = ""
    status_code: int | None = None
    redirected_url: str | None = None
    redirected_status_code: int | None = None
    error: str | None = None
    requests: tuple[dict, ...] = ()
    response_headers: dict[str, str] | None = None


REQUESTS = "array<struct<event_type: string, is_navigation_request: boolean, url: string, headers: map<string,string>>>"
#: Columns of a fetched page beside url and depth, with their types.
RESULT = {"html": "string", "status_code": "int", "redirected_url": "string", "redirected_status_code": "int", "error": "string", "requests": REQUESTS, "response_headers": "map<string,string>"}
Get = Callable[..., "str | Fetched"]


def one_fetch(get: Get, how: Tuning, sleep: Callable[[float], None] = time.sleep) -> Callable[[str], Fetched]:
    """get(url), or get(url, timeout=seconds) where it takes one, as a Fetched: after the delay, an error as such, HTML without a status as a 200, and requests only where they are kept."""
    import inspect

    try:
        timed = "timeout" in inspect.signature(get).parameters
    except (TypeError, ValueError):
        timed = False

    def run(url: str) -> Fetched:
        if how.mean_delay_s or how.max_range_s:
            sleep(how.mean_delay_s + random.uniform(0, how.max_range_s))
        try:
            got = get(url, timeout=how.timeout_s) if timed else get(url)
        except Exception as e:
            return Fetched(error=f"{type(e).__name__}: {e}")
        got = got if isinstance(got, Fetched) else Fetched(html=got or "")
        status = 200 if got.status_code is None and got.html and not got.error else got.status_code
        return replace(got, status_code=status, requests=got.requests if how.keep_requests else ())

    return run


def fetch(urls: DataFrame, get: Get, how: Tuning = Tuning()) -> DataFrame:
    """urls(url, depth) with the columns of RESULT. The URLs of a host are fetched one after another by one task, so that the delay holds per host; as many tasks as `concurrency` fetch at a time."""
    names = [*RESULT]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        one = one_fetch(get, how)
        for batch in batches:
            found = [one(u) for u in batch["url"]]
            made = {n: pd.Series([getattr(f, n) for f in found], dtype=object) for n in names}
            made["requests"] = pd.Series([[{"event_type": r.get("event_type"), "is_navigation_request": bool(r.get("is_navigation_request")), "url": r.get("url"), "headers": {str(k): str(v) for k, v in (r.get("headers") or {}).items()}} for r in f.requests] for f in found], dtype=object)
            for n in ("status_code", "redirected_status_code"):
                made[n] = pd.array([getattr(f, n) for f in found], dtype="Int32")
            yield pd.DataFrame({"url": batch["url"], "depth": batch["depth"], **made})

    host = F.regexp_extract("url", "^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#]*)", 1)
    return urls.repartition(how.concurrency, host).mapInPandas(run, "url string, depth int, " + ", ".join(f"{k} {v}" for k, v in RESULT.items()))


def looked_up(urls: DataFrame, pages: DataFrame, by: tuple[str, ...] = ("url",)) -> DataFrame:
    """urls(url, depth) with the columns of RESULT from a table (url, html) of pages fetched before, which may have the other columns too.

    `by` are the columns that name a fetch, in both tables; a table that holds several fetches of a URL needs more than the URL.
    """
    have = {c.lower() for c in pages.columns}
    kept = pages.select(*by, *[F.col(n).cast(t).alias(n) if n in have else F.lit(None).cast(t).alias(n) for n, t in RESULT.items()])
    joined = urls.join(kept, [*by], "left")
    status = F.coalesce("status_code", F.when((F.coalesce("html", F.lit("")) != "") & (F.coalesce("error", F.lit("")) == ""), 200))
    return joined.withColumn("status_code", status).select("url", "depth", *RESULT)


def crawl(spark: SparkSession, start: str, pages: DataFrame | None = None, get: Callable[[str], str] | None = None, max_depth: int = 4, max_pages: int = 800, rules: CrawlRules = CrawlRules(), checkpoint: Callable[[DataFrame], DataFrame] = lambda df: df) -> DataFrame:
    """(url, depth, success and the columns of RESULT) of at most max_pages pages in breadth-first order."""
    frontier = spark.createDataFrame([(start, 0)], "url string, depth int")
    seen = frontier.select(normalize_url(F.col("url")).alias("key"))
    out, left = None, max_pages
    for depth in range(max_depth + 1):
        due = frontier.orderBy("url").limit(left)
        got = checkpoint(looked_up(due, pages) if pages is not None else fetch(due, get, tuning(max_depth, max_pages)))
        got = got.withColumn("success", came())
        out = got if out is None else out.unionByName(got)
        left -= got.count()
        if depth == max_depth or left <= 0:
            break
        links = got.where("success").select("url", F.explode(page_links("html")).alias("l")).select(F.regexp_replace(absolute_url(F.col("l.href"), F.col("url")), "#.*$", "").alias("url")).distinct()
        admitted = links.where(admission_reason(F.col("url"), F.lit(None).cast("int"), rules) == "ok").withColumn("key", normalize_url(F.col("url")))
        new = checkpoint(admitted.join(seen, "key", "left_anti").dropDuplicates(["key"]))
        if new.isEmpty():
            break
        seen = seen.unionByName(new.select("key"))
        frontier = new.select("url", F.lit(depth + 1).alias("depth"))
    return out


def came() -> Column:
    """Whether a fetch brought a page."""
    return (F.coalesce("html", F.lit("")) != "") & (F.coalesce("error", F.lit("")) == "")


def fetched_rows(got: DataFrame, agent: str = "", headers: dict[str, str] | None = None, cookies: list[dict[str, str]] | None = None, references: tuple[tuple[str, str], ...] | None = None) -> DataFrame:
    """What `page_records` reads, from crawled (url, depth, success and the columns of RESULT): head fields and markdown of the HTML, what was sent, and the headers and cookies of the last navigation.

    `references` are the character references that head fields decode, all of HTML by default.
    """
    nothing = F.create_map().cast("map<string,string>")
    head = lambda n: F.coalesce(head_field(F.col("html"), n, references=references), F.lit(""))
    pairs = lambda m: F.create_map(*[F.lit(x) for kv in m.items() for x in kv]) if m else nothing
    sent = F.array(*[pairs(c) for c in cookies]) if cookies else F.array().cast("array<map<string,string>>")
    final = final_request_details(F.col("requests"), F.col("url"), F.col("redirected_url"))
    return got.select(
        "url", "depth", "success", "status_code", "redirected_url", "redirected_status_code", "error",
        *[head(n).alias(n) for n in ("title", "description", "keywords")], page_markdown(F.when(F.col("success"), F.col("html"))).alias("markdown"),
        pairs(headers or {}).alias("headers"), sent.alias("cookies"), F.lit(agent).alias("user_agent"), final["headers"].alias("final_headers"), final["cookies"].alias("final_cookies"), "response_headers",
    )


def crawl_site(spark: SparkSession, start: str, pages: DataFrame | None = None, get: Callable[[str], str] | None = None, max_depth: int = 4, max_pages: int = 800, rules: CrawlRules = CrawlRules(), rounds: int = 2, per_round: int = 40, keep: Callable[[DataFrame], DataFrame] = lambda df: df) -> tuple[DataFrame, DataFrame]:
    """(page records with `ord`, summary): a crawl, its retry rounds and the keep-best dedupe by URL. The records are what a build run (`pipeline.ingest`) takes.

    `keep` stores tables that are read several times. Fetches that bring neither a page nor an error count as retryable network errors.
    """
    got = keep(crawl(spark, start, pages, get, max_depth, max_pages, rules, keep))
    silent = F.when(F.coalesce("error", F.lit("")) == "", "connection: empty response").otherwise(F.col("error"))
    told = lambda rows: rows.withColumn("error", F.when(~F.col("success"), silent).otherwise(F.col("error")))
    records = keep(page_records(fetched_rows(told(got))).withColumn("ord", F.xxhash64("source_url")))

    def again(due: DataFrame, k: int) -> DataFrame:
        urls = due.select(F.col("source_url").alias("url"), F.lit(0).alias("depth"))
        tried = looked_up(urls, pages) if pages is not None else fetch(urls, get, tuning(max_depth, max_pages))
        return page_records(fetched_rows(told(tried.withColumn("success", came()))))

    after, log = retry_rounds(records, again, rules, rounds, per_round, keep=keep)
    best = keep(dedupe_best_by_aggregate(after.withColumn("__ord", F.col("ord")), "source_url", ord="__ord").drop("place", "__ord"))
    summary = crawl_summary(after, rules, kept=best).join(F.broadcast(retry_counts(records, log, rules)))
    return best, summary
