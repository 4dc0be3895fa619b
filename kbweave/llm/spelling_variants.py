"""Spelling variants of frequent words: near words by a rare-first prefix filter over positional bigrams, forms and roots.

One edit destroys at most two of a word's bigrams. All bigrams are ordered by how few words have them; each word offers its three rarest ones (and the other places of a
bigram among them), so that two words at distance one share an offered bigram. An edit moves a bigram by one place at most, and none at equal lengths, so that words meet only
by (bigram, place, length): a replacement at the same place and length, an insertion at the same place or one later in the word that is one longer. What meets is verified
by the edit distance in the join itself; bigrams that very many words offer at one place are salted.

Forms: the near word that occurs most often, if it is `factor` times as frequent. Along a chain of forms the frequency grows by that factor with every step, which bounds its length by the logarithm of the largest
frequency; roots are found by doubling the reach of all links that often.

Defined results: null texts have no words, a null id is an empty one in the text that is hashed. Repeated rows count as often as they occur. Words of equal frequency go in code-point order. Empty
tables give no rows; other columns are left out.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kbweave.llm.common import materialize, salted_join
from kbweave.llm.host_reputation import LOWER, UPPER

#: Fixed: the runs of letters that are words.
RUN = "[A-Za-z\\u00C0-\\u00FF]+"


@dataclass(frozen=True)
class Settings:
    min_length: int = 6
    min_count: int = 5
    factor: int = 5  # a form is at least so many times as frequent
    slip: int = 199  # a run loses one character where this divides its hash; 0: never
    salted: int = 5_000  # words that offer one bigram at one place and length, per salt


def count_words(docs: DataFrame, id_column: str = "doc_id", text: str = "text", settings: Settings = Settings()) -> DataFrame:
    """(word, n) of all words that are long and frequent enough; counts combine before the shuffle."""
    runs = docs.select(F.coalesce(F.col(id_column).cast("string"), F.lit("")).alias("id"), F.explode(F.regexp_extract_all(F.translate(F.col(text), UPPER, LOWER), F.lit(RUN), F.lit(0))).alias("run"))
    runs = runs.where(F.length("run") >= settings.min_length)
    word = F.col("run")
    if settings.slip:
        h = F.crc32(F.concat("id", F.lit(":"), "run").cast("binary"))
        at = (h % F.length("run")).cast("int")
        cut = F.concat(F.substring(word, F.lit(1), at), F.substring(word, at + 2, F.length("run")))
        word = F.when(h % settings.slip == 0, cut).otherwise(word)
    words = runs.select(word.alias("word")).where(F.length("word") >= settings.min_length)
    return words.groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= settings.min_count)


def offered(words: DataFrame) -> DataFrame:
    """(word, n, length, gram, place): the three rarest bigrams of each word with all places of these."""
    places = F.sequence(F.lit(1), F.length("word") - 1)
    each = words.where(F.length("word") > 1).select("word", "n", F.explode(F.transform(places, lambda i: F.struct(F.substring(F.col("word"), i, F.lit(2)).alias("gram"), i.alias("place")))).alias("g")).select("word", "n", "g.*")
    # one row per pair of letters: at most the square of the alphabet's 90
    rarity = each.groupBy("gram").agg(F.count("*").alias("f"))
    ranked = each.join(F.broadcast(rarity), "gram").groupBy("word", "n").agg(F.sort_array(F.collect_list(F.struct("f", "gram", "place"))).alias("g"))
    third = F.get(F.col("g"), F.least(F.size("g"), F.lit(3)) - 1)
    kept = F.filter("g", lambda x: (x["f"] < third["f"]) | ((x["f"] == third["f"]) & (x["gram"] <= third["gram"])))
    return ranked.select("word", "n", F.length("word").alias("length"), F.explode(kept).alias("g")).select("word", "n", "length", "g.gram", "g.place")


def near_pairs(words: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """(a, a_n, b, b_n), each pair of words(word, n) at edit distance one once."""
    grams = materialize(offered(words), "spelling-bigrams")
    at = ["gram", "place", "length"]
    right = grams.select(*at, F.col("word").alias("b"), F.col("n").alias("b_n"))
    meets = lambda place, length: F.struct(place.alias("place"), length.alias("length"))
    place, length = F.col("place"), F.col("length")
    keys = F.explode(F.array(meets(place, length), meets(place, length + 1), meets(place + 1, length + 1)))
    left = grams.select("gram", F.col("word").alias("a"), F.col("n").alias("a_n"), length.alias("a_length"), keys.alias("k")).select("gram", "k.*", "a", "a_n", "a_length")
    once = (F.col("a_length") < F.col("length")) | (F.col("a") < F.col("b"))
    close = salted_join(right, left, at, grams.groupBy(*at).agg(F.count("*").alias("many")), settings.salted).where(once & (F.levenshtein("a", "b", 1) == 1))
    return close.groupBy("a", "b").agg(F.first("a_n").alias("a_n"), F.first("b_n").alias("b_n"))


def roots(links: DataFrame, longest: int) -> DataFrame:
    """(word, root) of links(word, form): the last word of each chain of at most `longest` links."""
    found = links.select("word", F.col("form").alias("root"))
    for _ in range(max(0, longest - 1).bit_length()):
        further = found.select(F.col("word").alias("root"), F.col("root").alias("last"))
        found = found.join(further, "root", "left").select("word", F.coalesce("last", "root").alias("root"))
    return found


def group_variants(docs: DataFrame, id_column: str = "doc_id", text: str = "text", settings: Settings = Settings()) -> DataFrame:
    """(word, form, root, n, n_near, form_n): one row per word."""
    words = materialize(count_words(docs, id_column, text, settings), "spelling-words")
    pairs = near_pairs(words, settings)
    side = lambda x, y: F.struct(F.col(x).alias("word"), F.col(f"{x}_n").alias("n"), F.col(y).alias("other"), F.col(f"{y}_n").alias("other_n"))
    each = pairs.select(F.explode(F.array(side("a", "b"), side("b", "a"))).alias("x")).select("x.*")
    best = each.groupBy("word", "n").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("other_n")).alias("less"), "other")).alias("best"))
    forms = F.when(-F.col("best.less") >= settings.factor * F.col("n"), F.struct(F.col("best.other").alias("form"), (-F.col("best.less")).alias("form_n")))
    near = materialize(best.select("word", "n_near", forms.alias("f")), "spelling-near")
    most = words.agg(F.max("n").alias("n")).first()["n"] or settings.min_count
    longest = int(math.log(max(1.0, most / settings.min_count), settings.factor) + 1e-9) + 1
    found = roots(near.where("f is not null").select("word", "f.form"), longest)
    return words.join(near, "word", "left").join(found, "word", "left").select("word", F.col("f.form").alias("form"), F.coalesce("root", "word").alias("root"), "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.col("f.form_n").alias("form_n"))
