"""Registered queries of the training-data operators: whole tables, production parameters, contract columns."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kbweave.llm.common import held_out, table


def op1_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    from kbweave.llm.minhash import near_duplicates

    found = near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", "class_id", "class_size", "n_links", "n_shingles")


def op2_quality_cnn(spark: SparkSession, sf_dir: str) -> DataFrame:
    from kbweave.llm.quality_cnn import classify, fit

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    net = fit(docs, table(spark, sf_dir, "labels"), F.crc32(F.col("doc_id").cast("string")) % 5 != 0)
    return classify(docs, net).select("doc_id", held_out("doc_id", 5, 0).alias("held_out"), "quality.score", "quality.predicted")


def op3_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    from kbweave.llm.surrogates import replace_pii

    replaced = replace_pii(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return replaced.select("doc_id", "text", "pii.*")


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    from kbweave.llm.decontamination import find_contamination

    found = find_contamination(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", *[f"contamination.{c}" for c in ("n_words", "n_hit", "n_items", "items_sha256", "contaminated")])


OP4_SQL = r"""
WITH item AS (
  SELECT CAST(item_id AS VARCHAR) AS item_id,
         regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark),
gram AS (
  SELECT item_id, least(len(w), 13) AS n, array_to_string(list_slice(w, i, i + least(len(w), 13) - 1), ' ') AS g
  FROM (SELECT item_id, w, unnest(generate_series(1, len(w) - least(len(w), 13) + 1)) AS i FROM item WHERE len(w) > 0)),
doc AS (
  SELECT row_number() OVER () AS r, doc_id,
         coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w
  FROM documents),
place AS (
  SELECT r, n, i, array_to_string(list_slice(w, i, i + n - 1), ' ') AS g
  FROM (SELECT r, w, n, unnest(generate_series(1, len(w) - n + 1)) AS i FROM doc, (SELECT DISTINCT n FROM gram) WHERE len(w) >= n)),
hit AS (SELECT DISTINCT p.r, p.i, p.n, m.item_id FROM place p JOIN gram m ON p.n = m.n AND p.g = m.g),
covered AS (SELECT r, count(DISTINCT pos) AS n_hit FROM (SELECT r, unnest(generate_series(i, i + n - 1)) AS pos FROM hit) GROUP BY r),
named AS (SELECT r, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids FROM (SELECT DISTINCT r, item_id FROM hit) GROUP BY r)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM doc LEFT JOIN covered USING (r) LEFT JOIN named USING (r)
"""


def op5_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    from kbweave.llm.secrets import secret_scan

    found = secret_scan(table(spark, sf_dir, "documents").select("doc_id", "text"), redacted=False)
    return found.select("doc_id", "secrets.n_assign", "secrets.n_access", "secrets.n_hex", "secrets.base_sha256", F.col("secrets.spans_text").alias("spans"), "secrets.n_novel")


def op6_language_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    from kbweave.llm.language_crf import fit, identify

    docs = table(spark, sf_dir, "documents")
    model = fit(docs.select("doc_id", "text", "lang"), F.crc32(F.col("doc_id").cast("string")) % 4 != 2)
    found = identify(docs.select("doc_id", "text"), model)
    return found.select("doc_id", held_out("doc_id", 4, 2).alias("held_out"), F.col("language.lang").alias("lang_pred"), "language.score")


def op7_compression_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    from kbweave.llm.compression_rules import compression_rules

    ruled = compression_rules(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return ruled.select("doc_id", "rules.*")


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from kbweave.llm.packing import pack

    return pack(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op9_page_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    from kbweave.llm.page_templates import extract_main_text

    found = extract_main_text(table(spark, sf_dir, "pages"), keep_html=False)
    return found.select("page_id", "url", F.col("main_text").alias("text"), F.length("main_text").cast("long").alias("n_chars"))


def op10_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    from kbweave.llm.repeats import remove_repeats

    return remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op11_host_reputation(spark: SparkSession, sf_dir: str) -> DataFrame:
    from kbweave.llm.host_reputation import judge_urls

    judged = judge_urls(table(spark, sf_dir, "pages").select("page_id", "url"), table(spark, sf_dir, "labels"))
    return judged.select("page_id", *[f"url_filter.{c}" for c in ("host", "path", "rule", "verdict", "labelled", "bad")])


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    from kbweave.llm.spelling_variants import group_variants

    return group_variants(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    from kbweave.llm.token_alignment import align

    return align(table(spark, sf_dir, "documents").select("doc_id", "text"))

OP11_SQL = r"""
WITH page AS (
  SELECT page_id, translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
  FROM (SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages)),
known AS (
  SELECT doc_id, max(CASE WHEN coalesce(quality = 0, false) OR coalesce(toxic = 1, false) THEN 1 ELSE 0 END) AS bad
  FROM labels WHERE doc_id IS NOT NULL AND (quality IS NOT NULL OR toxic IS NOT NULL) GROUP BY doc_id),
host AS (
  SELECT host, split_part(host, '.', -1) AS suffix, CASE WHEN contains(host, '.') THEN split_part(host, '.', -2) || '.' || split_part(host, '.', -1) ELSE host END AS domain,
         count(bad) AS n, coalesce(sum(bad), 0) AS bad
  FROM page LEFT JOIN known ON page_id = doc_id GROUP BY host),
base AS (SELECT (sum(bad) + 0.5::DOUBLE) / (sum(n) + 1) AS p FROM host),
suffix AS (SELECT suffix, sum(n)::DOUBLE AS n, sum(bad)::DOUBLE AS bad, any_value(p) AS p FROM host, base GROUP BY suffix),
s_size AS (SELECT CASE WHEN coalesce(sum(w * (n - 1)), 0) = 0 THEN 1 WHEN sum(w * o) <= 0 THEN 10000 ELSE least(10000, greatest(1, sum(w * (n - 1)) / sum(w * o) - 1)) END AS m FROM (SELECT n, (n - 1) / (1 + 0.1 * (n - 1)) ** 2 AS w, (bad - n * p) ** 2 / (n * p * (1 - p)) - 1 AS o FROM suffix WHERE n > 1)),
domain AS (
  SELECT h.domain, any_value(h.suffix) AS suffix, sum(h.n)::DOUBLE AS n, sum(h.bad)::DOUBLE AS bad, any_value((m * s.p + s.bad) / (m + s.n)) AS p
  FROM host h JOIN suffix s USING (suffix), s_size GROUP BY h.domain),
d_size AS (SELECT CASE WHEN coalesce(sum(w * (n - 1)), 0) = 0 THEN 1 WHEN sum(w * o) <= 0 THEN 10000 ELSE least(10000, greatest(1, sum(w * (n - 1)) / sum(w * o) - 1)) END AS m FROM (SELECT n, (n - 1) / (1 + 0.1 * (n - 1)) ** 2 AS w, (bad - n * p) ** 2 / (n * p * (1 - p)) - 1 AS o FROM domain WHERE n > 1)),
own AS (SELECT h.host, h.n, h.bad, (m * d.p + d.bad) / (m + d.n) AS p FROM host h JOIN domain d USING (domain), d_size),
h_size AS (SELECT CASE WHEN coalesce(sum(w * (n - 1)), 0) = 0 THEN 1 WHEN sum(w * o) <= 0 THEN 10000 ELSE least(10000, greatest(1, sum(w * (n - 1)) / sum(w * o) - 1)) END AS m FROM (SELECT n, (n - 1) / (1 + 0.1 * (n - 1)) ** 2 AS w, (bad - n * p) ** 2 / (n * p * (1 - p)) - 1 AS o FROM own WHERE n > 1)),
beta AS (SELECT host, n, bad, m * p + bad AS a, m * (1 - p) + n - bad AS b FROM own, h_size),
bound AS (SELECT host, n, bad, a / (a + b) - 1.645 * sqrt(a * b / ((a + b) * (a + b) * (a + b + 1))) AS lower FROM beta),
rule(name, host, path, allow) AS (VALUES ('com/', 'com', '/', true), ('example.com/en/', 'example.com', '/en/', false), ('www.example.com/en/', 'www.example.com', '/en/', true), ('net/es/', 'net', '/es/', false), ('net/fr/', 'net', '/fr/', false)),
fit AS (
  SELECT p.host, p.path, arg_max(r.name, length(r.name)) AS rule, arg_max(r.allow, length(r.name)) AS allow
  FROM (SELECT DISTINCT host, path FROM page) p JOIN rule r ON (p.host = r.host OR ends_with(p.host, '.' || r.host)) AND starts_with(p.path, r.path) GROUP BY p.host, p.path)
SELECT page_id, p.host, p.path, rule, CASE WHEN coalesce(allow, lower <= 0.35) THEN 'allow' ELSE 'block' END AS verdict, n AS labelled, bad
FROM page p JOIN bound USING (host) LEFT JOIN fit f ON p.host = f.host AND p.path = f.path
"""

OP12_SQL = r"""
WITH RECURSIVE crc_table AS (
  SELECT list(c ORDER BY i) AS t FROM (SELECT i, list_reduce(list_prepend(i::BIGINT, range(8)), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END) AS c FROM range(256) r(i))),
run AS (
  SELECT doc_id, run, count(*) AS times
  FROM (SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[A-Za-zÀ-ÿ]+')) AS run FROM documents)
  WHERE length(run) >= 6 GROUP BY doc_id, run),
coded AS (SELECT doc_id, run, times, hex(encode(coalesce(doc_id::VARCHAR, '') || ':' || run)) AS x FROM run),
hashed AS (
  SELECT run, times, xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(1, length(x), 2), lambda i: ('0x' || substr(x, i, 2))::BIGINT)), lambda c, v: xor(t[(xor(c, v) & 255) + 1], c >> 8))) AS h
  FROM coded, crc_table),
word AS (
  SELECT w AS word, sum(times)::BIGINT AS n
  FROM (SELECT CASE WHEN h % 199 = 0 THEN substr(run, 1, (h % length(run))::INT) || substr(run, (h % length(run))::INT + 2) ELSE run END AS w, times FROM hashed)
  WHERE length(w) >= 6 GROUP BY w HAVING sum(times) >= 5),
letter AS (SELECT string_agg(chr(192 + i::INT), '' ORDER BY i) AS wide, string_agg(chr(33 + i::INT), '' ORDER BY i) AS byte FROM range(64) r(i)),
flat AS (SELECT word, n, translate(word, wide, byte) AS w FROM word, letter),
pair AS (SELECT a.word, a.n, b.word AS other, b.n AS other_n FROM flat a JOIN flat b ON abs(length(a.w) - length(b.w)) <= 1 AND a.w <> b.w AND levenshtein(a.w, b.w) = 1),
best AS (SELECT word, n, count(*) AS n_near, max(other_n) AS top FROM pair GROUP BY word, n),
chosen AS (SELECT b.word, b.n_near, CASE WHEN b.top >= 5 * b.n THEN decode(min(encode(p.other))) END AS form, CASE WHEN b.top >= 5 * b.n THEN b.top END AS form_n
           FROM best b JOIN pair p ON p.word = b.word AND p.other_n = b.top GROUP BY b.word, b.n_near, b.top, b.n),
walk AS (
  SELECT word, word AS root FROM word
  UNION
  SELECT w.word, c.form FROM walk w JOIN chosen c ON c.word = w.root WHERE c.form IS NOT NULL),
last AS (SELECT w.word, w.root FROM walk w LEFT JOIN chosen c ON c.word = w.root WHERE c.form IS NULL)
SELECT word, form, root, n, coalesce(n_near, 0)::BIGINT AS n_near, form_n
FROM word LEFT JOIN chosen USING (word) JOIN last USING (word)
"""


OPERATORS = (
    op1_minhash, op2_quality_cnn, op3_surrogates, op4_decontamination, op5_secret_scan, op6_language_crf, op7_compression_rules, op8_packing, op9_page_templates, op10_repeats,
    op11_host_reputation, op12_spelling_variants, op13_token_alignment,
)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in OPERATORS}


def oracle_sql() -> dict[str, str]:
    return {"op4_decontamination": OP4_SQL, "op11_host_reputation": OP11_SQL, "op12_spelling_variants": OP12_SQL}
