"""Page records of a crawl: what a fetch returned, with metadata, markdown and taxonomy, and the rounds of retries over failed pages."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kbweave.functions import classify
from kbweave.functions.text import empty_if_null, let, prefix_text, sanitize_markdown
from kbweave.functions.urls import CrawlRules, admission_reason, is_login_redirect, is_retryable, last_path_param, path
from kbweave.operators.pages import recover

#: Fixed order of a page record's fields.
FIELDS = (
    "title", "description", "keywords", "category", "sub_category", "source_url", "path", "depth", "success", "status_code", "redirected_url", "redirected_status_code",
    "error", "request_headers_sent", "request_cookies_sent", "request_headers_final", "request_cookies_final", "response_headers", "metadata", "markdown",
)
NOTHING = "map<string,string>"


def sent_headers(headers: Column, user_agent: Column) -> Column:
    """Configured headers, with the agent's name where none of them gives it."""
    known = F.coalesce(headers, F.create_map().cast(NOTHING))
    names = F.map_keys(known)
    named = F.array_contains(names, "User-Agent") | F.array_contains(names, "user-agent")
    return F.when((empty_if_null(user_agent) != "") & ~named, F.map_concat(known, F.create_map(F.lit("User-Agent"), user_agent))).otherwise(known)


def sent_cookies(cookies: Column) -> Column:
    """name, value, domain and path of configured cookies (maps); what is missing is empty."""
    at = lambda c, n: empty_if_null(F.try_element_at(c, F.lit(n)))
    return F.transform(F.coalesce(cookies, F.array().cast(f"array<{NOTHING}>")), lambda c: F.struct(*[at(c, n).alias(n) for n in ("name", "value", "domain", "path")]))


def _prefixed_keywords(keywords: Column, word: Column) -> Column:
    """word, keywords, unless the word is among them or there is none."""
    given = F.trim(empty_if_null(keywords))
    known = F.transform(F.split(given, ","), lambda k: F.lower(F.trim(k)))
    return F.when((word == "") | F.array_contains(known, F.lower(word)), given).when(given == "", word).otherwise(F.concat_ws(", ", word, given))


def page_records(fetched: DataFrame) -> DataFrame:
    """The page records of fetched(url, depth, success, status_code, redirected_url, redirected_status_code, error, title, description, keywords, markdown, headers, cookies,
    user_agent, final_headers, final_cookies, response_headers).

    A page whose fetch failed has no body, no taxonomy and no final request; a status of 400 or more makes it unsuccessful. Pages that were sent to a login take the last
    words of their own path in front of title, description and keywords.
    """
    url = empty_if_null(F.col("url"))
    where = F.coalesce(F.nullif(path(url, params=False), F.lit("")), F.lit("/"))
    word = F.when(is_login_redirect(F.col("redirected_url")), last_path_param(where, letters_only=False)).otherwise("")
    fetched_ok = F.coalesce(F.col("success"), F.lit(False))
    refused = F.coalesce(F.col("status_code") >= 400, F.lit(False))
    body = F.when(fetched_ok, sanitize_markdown(F.col("markdown"))).otherwise("")
    base = fetched.select(
        "*",
        *[prefix_text(F.col(n), word).alias(f"__{n}") for n in ("title", "description")],
        _prefixed_keywords(F.col("keywords"), word).alias("__keywords"),
        where.alias("__path"),
        body.alias("__markdown"),
    )
    kind = F.when(fetched_ok, classify.menu_taxonomy(F.col("__path"), F.col("__title"), F.col("__markdown")))
    error = F.when(~fetched_ok, F.coalesce(F.nullif("error", F.lit("")), F.lit("Fetch failed"))).otherwise(F.coalesce(F.nullif("error", F.lit("")), F.when(refused, F.concat(F.lit("HTTP "), F.col("status_code").cast("string"))), F.lit("")))
    empty = F.create_map().cast(NOTHING)
    final = lambda n: F.when(fetched_ok, F.coalesce(F.col(n), empty)).otherwise(empty)
    made = {
        "title": F.col("__title"), "description": F.col("__description"), "keywords": F.col("__keywords"), "category": F.col("__kind.category"), "sub_category": F.col("__kind.sub_category"),
        "source_url": F.col("url"), "path": F.col("__path"), "depth": F.coalesce("depth", F.lit(0)), "success": fetched_ok & ~refused, "status_code": F.col("status_code"),
        "redirected_url": F.col("redirected_url"), "redirected_status_code": F.col("redirected_status_code"), "error": error,
        "request_headers_sent": sent_headers(F.col("headers"), F.col("user_agent")), "request_cookies_sent": sent_cookies(F.col("cookies")),
        "request_headers_final": final("final_headers"), "request_cookies_final": final("final_cookies"), "response_headers": F.coalesce("response_headers", empty),
        "metadata": F.create_map(*[x for n, c in (("title", "__title"), ("description", "__description"), ("keywords", "__keywords"), ("path", "__path")) for x in (F.lit(n), F.col(c))]),
        "markdown": F.col("__markdown"),
    }
    return base.withColumn("__kind", kind).select(*[made[n].alias(n) for n in FIELDS])


def retry_rounds(pages: DataFrame, fetch: Callable[[DataFrame, int], DataFrame], rules: CrawlRules, rounds: int = 2, per_round: int = 40, ord: str = "ord", keep: Callable[[DataFrame], DataFrame] = lambda df: df) -> tuple[DataFrame, DataFrame]:
    """(pages after the retries, log(source_url, round, recovered, candidate)).

    Each round fetches the first `per_round` retryable pages in order that no round recovered, `fetch(urls, round)` gives their page records, and admitted successes
    replace the failed rows in place. `keep` stores what a round uses twice.
    """
    wanted = is_retryable(F.col("source_url"), F.col("success"), F.col("status_code"), F.col("error"), rules)
    current, logs = pages, []
    for k in range(1, rounds + 1):
        due = keep(current.where(wanted & (F.coalesce(F.col("source_url"), F.lit("")) != "")).orderBy(ord).limit(per_round).select("source_url", ord))
        if due.isEmpty():
            break
        got = keep(fetch(due.select("source_url").distinct(), k))
        fine = got.where(F.col("success") & (admission_reason(F.col("source_url"), F.col("status_code"), rules) == "ok"))
        logs.append(due.select("source_url").distinct().join(fine.select("source_url", F.lit(True).alias("recovered")).distinct(), "source_url", "left").select("source_url", F.lit(k).alias("round"), F.coalesce("recovered", F.lit(False)).alias("recovered")))
        current = keep(recover(current, fine.drop(ord)))
    log = logs[0] if logs else pages.limit(0).select("source_url", F.lit(0).alias("round"), F.lit(False).alias("recovered"))
    for more in logs[1:]:
        log = log.unionByName(more)
    return current, log


def retry_counts(pages: DataFrame, log: DataFrame, rules: CrawlRules) -> DataFrame:
    """(retry_candidates, retry_attempted, retry_recovered, retry_failed) of the pages before the retries and the log of the rounds."""
    wanted = is_retryable(F.col("source_url"), F.col("success"), F.col("status_code"), F.col("error"), rules)
    first = pages.agg(F.count_if(wanted).alias("retry_candidates"))
    counts = log.agg(F.count("*").alias("retry_attempted"), F.count_if("recovered").alias("retry_recovered"))
    return first.join(F.broadcast(counts)).withColumn("retry_failed", F.col("retry_attempted") - F.col("retry_recovered"))


def first_filled(*sources: Callable[[], DataFrame]) -> tuple[DataFrame, int]:
    """(rows, place) of the first source that has any; the last one's rows if none has."""
    rows, at = sources[0](), 0
    for at, source in enumerate(sources):
        rows = source() if at else rows
        if not rows.isEmpty():
            break
    return rows, at


