"""URL filter by rules and, where no rule fits, by an empirical-Bayes reputation of hosts.

Labelled pages are binomial outcomes of their hosts. A host's rate of bad pages has a beta prior around its registered domain's rate, a domain one around
its suffix's, a suffix one around the rate of all labelled pages; each level's prior strength is the moment estimate of the beta-binomial over the level,
so that levels whose members hardly differ shrink their members almost wholly. A host is blocked if the lower bound of its posterior rate, `z` standard deviations
below the mean, is above `max_bad`; hosts without a labelled page have their domain's rate and are as wide as the prior.

Counts are sums that combine before the shuffle, so that a host of a third of all pages is one row per task; the reputations, one row per host, go back to the
pages by broadcast where they are counted as few, else by a join in which hosts of many pages are salted.

Defined results: a null url and one without `://` have the empty host and path, no rule, and the empty host's reputation. Repeated rows get equal results, and each
counts as an outcome. Labels without both marks, and pages with a null id, are no outcomes; several labels of one id are bad if one is. Without any label the prior is
so wide that nothing is blocked. An empty table gives no rows; columns of any name pass through untouched.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kbweave.llm.common import materialize, salted_join

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Rule:
    """A rule of a host with all its subdomains for the paths that start with `path`."""

    allow: bool
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path


#: The rules that the contract names.
RULES = (Rule(True, "com", "/"), Rule(False, "example.com", "/en/"), Rule(True, "www.example.com", "/en/"), Rule(False, "net", "/es/"), Rule(False, "net", "/fr/"))


@dataclass(frozen=True)
class Settings:
    rules: tuple[Rule, ...] = RULES
    suffixes: tuple[str, ...] = ("co.uk", "org.uk", "ac.uk", "gov.uk", "com.au", "net.au", "org.au", "co.nz", "co.jp", "ne.jp", "or.jp", "com.br", "co.in", "co.za")  # suffixes of several labels; otherwise the last label
    max_bad: float = 0.35
    z: float = 1.645
    min_strength: float = 1.0  # pseudo-pages of a level's prior
    max_strength: float = 10_000.0
    spread: float = 0.1  # the correlation of a host's pages at which the moment estimate is best
    max_broadcast: int = 500_000  # hosts that travel to every executor
    salted: int = 100_000  # pages of a host per salt


def split_url(url: Column) -> tuple[Column, Column]:
    """(host, path) of a url: both empty where it is null or has no `://`."""
    rest = F.regexp_extract(url, r"(?s)^.*?://(.*)$", 1)
    host = F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), UPPER, LOWER)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return F.coalesce(host, F.lit("")), F.coalesce(path, F.lit(""))


def fits(rule: Rule, host: Column, path: Column) -> Column:
    return ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)


def longest_rule(rules: tuple[Rule, ...], host: Column, path: Column) -> tuple[Column, Column]:
    """(name, allow) of the longest rule that fits, null where none does; of equally long ones the one with the longer host."""
    ordered = sorted(rules, key=lambda r: (-len(r.name), -len(r.host), r.name))
    name, allow = F.lit(None).cast("string"), F.lit(None).cast("boolean")
    for rule in reversed(ordered):
        fit = fits(rule, host, path)
        name, allow = F.when(fit, rule.name).otherwise(name), F.when(fit, rule.allow).otherwise(allow)
    return name, allow


def registered(host: Column, suffixes: tuple[str, ...]) -> tuple[Column, Column]:
    """(registered domain, suffix) of a host; a host that is a suffix itself is its own domain."""
    last = F.element_at(F.split(host, r"\."), -1)
    suffix = last
    for s in sorted(suffixes, key=len):
        suffix = F.when((host == s) | host.endswith("." + s), s).otherwise(suffix)
    labels = F.split(host, r"\.")
    many = F.least(F.size(labels), F.size(F.split(suffix, r"\.")) + 1)
    return F.array_join(F.slice(labels, -many, many), "."), suffix


def outcomes(pages: DataFrame, labels: DataFrame, page_id: str, url: str, settings: Settings) -> DataFrame:
    """(host, domain, suffix, pages, n, bad): how many pages a host has, how many are labelled and how many of these are bad."""
    marked = (F.col("quality").isNotNull()) | (F.col("toxic").isNotNull())
    bad = F.coalesce(F.col("quality") == 0, F.lit(False)) | F.coalesce(F.col("toxic") == 1, F.lit(False))
    known = labels.where(marked & F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").alias("__id")).agg(F.max(bad.cast("int")).alias("__bad"))
    seen = pages.select(F.col(page_id).alias("__id"), split_url(F.col(url))[0].alias("host")).join(known, "__id", "left")
    counts = seen.groupBy("host").agg(F.count("*").alias("pages"), F.count("__bad").alias("n"), F.coalesce(F.sum("__bad"), F.lit(0)).alias("bad"))
    domain, suffix = registered(F.col("host"), settings.suffixes)
    return counts.select("host", domain.alias("domain"), suffix.alias("suffix"), "pages", "n", "bad")


def strength(groups: DataFrame, settings: Settings) -> float:
    """Moment estimate of the prior's pseudo-pages over groups (n, bad, prior): Var(bad) = n p (1 - p) (1 + (n - 1) r) with r = 1 / (strength + 1).

    Groups weigh as is best at r = `spread`, so that a group of very many pages weighs as much as some dozens of common ones and not by its square. Where no group has two labelled pages the spread is unknown and the prior as wide as allowed.
    """
    n, p = F.col("n"), F.col("prior")
    weight = (n - 1) / F.pow(1 + settings.spread * (n - 1), 2)
    over = F.pow(F.col("bad") - n * p, 2) / (n * p * (1 - p)) - 1
    row = groups.where(n > 1).agg(F.sum(weight * over).alias("over"), F.sum(weight * (n - 1)).alias("scale")).first()
    if not row["scale"]:
        return settings.min_strength
    if row["over"] <= 0:
        return settings.max_strength
    return min(settings.max_strength, max(settings.min_strength, row["scale"] / row["over"] - 1))


def posterior(groups: DataFrame, size: float) -> DataFrame:
    """groups with alpha, beta and the posterior mean under a beta prior of mean `prior` and `size` pseudo-pages."""
    alpha, beta = F.lit(size) * F.col("prior") + F.col("bad"), F.lit(size) * (1 - F.col("prior")) + F.col("n") - F.col("bad")
    return groups.withColumn("alpha", alpha).withColumn("beta", beta).withColumn("mean", F.col("alpha") / (F.col("alpha") + F.col("beta")))


def reputations(hosts: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """(host, pages, n, bad, alpha, beta, mean, lower) from outcomes() by shrinking down the levels; four numbers reach the driver."""
    total = hosts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.coalesce(F.sum("bad"), F.lit(0)).alias("bad")).first()
    base = (total["bad"] + 0.5) / (total["n"] + 1.0)
    parents: DataFrame | None = None
    for level, above in (("suffix", None), ("domain", "suffix"), ("host", "domain")):
        keys = [level] if above is None else [level, above]
        groups = hosts if level == "host" else hosts.groupBy(*keys).agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))
        prior = groups.withColumn("prior", F.lit(base)) if parents is None else groups.join(parents, above)
        parents = posterior(prior, strength(prior, settings))
        if level != "host":
            parents = parents.select(level, F.col("mean").alias("prior"))
    a, b = F.col("alpha"), F.col("beta")
    lower = F.greatest(F.lit(0.0), F.col("mean") - F.lit(settings.z) * F.sqrt(a * b / ((a + b) * (a + b) * (a + b + 1))))
    return parents.select("host", "pages", "n", "bad", "alpha", "beta", "mean", lower.alias("lower"))


def judge_urls(pages: DataFrame, labels: DataFrame, page_id: str = "page_id", url: str = "url", settings: Settings = Settings()) -> DataFrame:
    """pages plus one struct column `url_filter` (host, path, rule, verdict, labelled, bad, rate, lower); a column of that name is replaced."""
    hosts = materialize(outcomes(pages, labels, page_id, url, settings), "host-outcomes")
    found = materialize(reputations(hosts, settings), "host-reputations")
    host, path = split_url(F.col(url))
    kept = [F.col(f"`{c}`") for c in pages.columns if c.lower() != "url_filter"]
    given = pages.select(F.struct(*kept).alias("__page"), host.alias("__host"), path.alias("__path"))
    known = found.select(F.col("host").alias("__host"), "n", "bad", "mean", "lower", "pages")
    if found.count() <= settings.max_broadcast:
        joined = given.join(F.broadcast(known.drop("pages")), "__host")
    else:
        joined = salted_join(given, known.drop("pages"), ["__host"], known.select("__host", F.col("pages").alias("many")), settings.salted)
    rule, allow = longest_rule(settings.rules, F.col("__host"), F.col("__path"))
    passes = F.coalesce(allow, F.col("lower") <= settings.max_bad)
    verdict = F.struct(
        F.col("__host").alias("host"), F.col("__path").alias("path"), rule.alias("rule"), F.when(passes, "allow").otherwise("block").alias("verdict"),
        F.col("n").alias("labelled"), "bad", F.col("mean").alias("rate"), "lower",
    )
    return joined.select("__page.*", verdict.alias("url_filter"))


def filter_urls(pages: DataFrame, labels: DataFrame, page_id: str = "page_id", url: str = "url", settings: Settings = Settings()) -> DataFrame:
    """The pages that judge_urls() allows, with their own columns."""
    judged = judge_urls(pages.select(F.struct(*[F.col(f"`{c}`") for c in pages.columns]).alias("__own"), F.col(page_id).alias("__i"), F.col(url).alias("__u")), labels, "__i", "__u", settings)
    return judged.where("url_filter.verdict = 'allow'").select("__own.*")
