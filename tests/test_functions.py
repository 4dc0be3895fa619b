"""Hand-written vectors and properties of column functions and of the pure helpers behind them."""

from __future__ import annotations

import hashlib
import random

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from kbweave.functions import classify, dates, html, markers, text, urls
from kbweave.operators import chunking


def one(spark, column, **values):
    types = {str: "string", int: "int", bool: "boolean"}
    schema = ", ".join(f"{k} {types[type(v)] if v is not None else 'string'}" for k, v in values.items())
    return spark.createDataFrame([tuple(values.values())], schema).select(column.alias("x")).first()[0]


def test_url_path_text(spark):
    assert one(spark, urls.path_text(F.col("u")), u="/en/eapply/track-credit-card-application.page") == "track credit card application"
    assert one(spark, urls.path_text(F.col("u")), u="/creditcards/app/user/login#address-tab") == "creditcards app user login"
    assert one(spark, urls.path_text(F.col("u")), u=None) == ""


def test_normalize_url(spark):
    cases = {"HTTP://A.b": "http://a.b/", "https://a.b?z=1&a=%20&a=*~": "https://a.b/?a=+&a=%2A~&z=1", "//h/p": "https://h/p", "https://a.b/p;x?q#f": "https://a.b/p;x?q=", "": "", "https://a.b/c?b=2&a=1": "https://a.b/c?a=1&b=2", "http://[a/": None}
    rows = spark.createDataFrame(list(cases.items()), "u string, want string").select("u", "want", urls.normalize_url(F.col("u")).alias("got")).collect()
    for r in rows:
        assert r["got"] == r["want"], r


def test_clean_and_general_url_paths_agree(spark):
    made = [f"https://h.example/{p}{q}{f}" for p in ("", "a", "a/b.html") for q in ("", "?b=1&a=2", "?x", "?a=&a=1") for f in ("", "#top")]
    df = spark.createDataFrame([(u,) for u in made], "u string")
    assert df.where(~urls.normalize_url(F.col("u"), clean=True).eqNullSafe(urls._normalize_any(F.col("u")))).count() == 0


def test_content_hash_ignores_noise(spark):
    empty = hashlib.sha256(b"").hexdigest()
    assert one(spark, text.content_hash(F.col("t")), t="") == empty
    same = ["“A – b”  c\r\n", '"a - b" c', '  "A — B"\n\n\n\n\nC']
    rows = spark.createDataFrame([(s,) for s in same], "t string").select(text.content_hash(F.col("t"), composed=False).alias("h")).distinct().count()
    assert rows == 1


def test_keywords_and_prefixes(spark):
    assert one(spark, text.clean_keywords(text.split_keywords(F.col("k"))), k="card a,credit card b,services") == "card a credit card b services"
    assert one(spark, text.normalize_keywords(F.col("k")), k=" A,b,a,,B ") == ["a", "b"]
    assert one(spark, text.prefix_text(F.col("t"), F.col("p")), t="P | x", p="p") == "P | x"
    assert one(spark, text.prefix_text(F.col("t"), F.col("p")), t="x", p="p") == "p | x"
    assert one(spark, text.prefix_match(F.col("k"), F.array(F.lit("address"), F.lit("change"))), k="billing address change") is True
    assert one(spark, text.prefix_match(F.col("k"), F.array(F.lit("address"), F.lit("change"))), k="pin") is False


def test_dates(spark):
    both = spark.createDataFrame([("Valid 1st Jan 2024 - 31 March 2024",), ("1 October 2024 to 3 November 2024",), ("30 Feb 2024 - 1 Mar 2024",), ("5Jan'24 – 6Feb'24",)], "t string")
    got = [tuple(r[0]) for r in both.select(dates.date_range(F.col("t"))).collect()]
    assert got[0][1:] == ("2024-01-01", "2024-03-31")
    assert got[1] == (None, None, None)  # the separator splits inside the month's name
    assert got[2] == (None, None, None)
    assert got[3][1:] == ("2024-01-05", "2024-02-06")
    fixed = both.select(dates.date_range(F.col("t"), reference_behaviour=False)).collect()
    assert tuple(fixed[1][0])[1:] == ("2024-10-01", "2024-11-03")


def test_classifiers(spark):
    assert one(spark, classify.offer_type(F.col("t")), t="Get 10% off") == "discount"
    assert one(spark, classify.reward_category(F.col("t")), t="a gym bag") == "Health & Fitness"
    assert one(spark, classify.redemption_type(F.col("t")), t="plain mug") == "physical_product"
    assert tuple(one(spark, classify.menu_taxonomy(F.col("p"), F.lit(""), F.lit("")), p="/en/personal/rewards/x.page")) == ("Personal", "rewards")


def test_html(spark):
    page = "<html lang='en'><head><title>A &amp; B</title><meta name='description' content=' x  y '></head>"
    assert one(spark, html.head_metadata(F.col("h")), h=page) == {"title": "A & B", "description": "x y", "language": "en"}
    assert html.parse_table("<table><tr><th>a<th></th></tr><tr><td>1<td>2<td>3</tr></table>") == [{"a": "1", "col_1": "2", "col_2": "3"}]
    assert one(spark, html.cookie_map(F.col("c")), c="a=1; b=x") == {"a": "1", "b": "x"}
    assert one(spark, html.flatten_json(F.col("j")), j='{"a":{"b":1},"c":[1,{"z":2}],"d":null}') == {"a.b": "1", "c": '1, {"z": 2}'}
    assert one(spark, html.page_links(F.col("h")), h="<a href='/x'>one</a><a href='/x'>two</a>")[0]["text"] == "one"


def test_reward_detail(spark):
    page = "<h1 class='product-title'>Mug</h1><h2 class='new-price'>1,200 pts</h2><div id='pointsnpay1'>Pay: 300 + Rs. 4,500</div><input data-itemcode='A1' data-paytype='Points'><input data-itemcode='B2' data-paytype='Points + Pay'><div class='brief-features'><ul><li>light<li>blue</ul></div><h3 id='estimated-delivery'>in 7 days</h3><span class='rwd-tooltip'>Only available in Pune, Delhi</span>"
    got = one(spark, html.reward_detail(F.col("h")), h=page)
    assert (got["product_name"], got["points_only"], got["points_pay_points"], got["points_pay_cash"]) == ("Mug", 1200, 300, 4500)
    assert (got["item_code_points"], got["item_code_pointspay"], got["estimated_delivery_days"]) == ("A1", "B2", 7)
    assert got["features"] == ["light", "blue"] and got["available_cities"] == ["Pune", "Delhi"]
    assert one(spark, html.reward_detail(F.col("h")), h="")["points_only"] is None


def test_chunker_vectors(spark):
    def pack(sizes):
        parts = [chr(97 + i) * n for i, n in enumerate(sizes)]
        got = one(spark, chunking.pack_blocks(F.split(F.col("p"), ","), 1200, 200), p=",".join(parts))
        return [[len(x) for x in c.split("\n\n")] for c in got]

    assert pack([900, 150, 300]) == [[900, 150], [150, 300]]
    assert pack([900, 150, 1100]) == [[900, 150], [150], [1100]]
    assert chunking.effective_overlap(600, 600) == 100


def cut(block, size):
    """The cut rule word by word: at the last space that leaves the piece within the size, else hard."""
    out = []
    while len(block) > size:
        at = block.rfind(" ", 1, size + 1)
        at = at if at > 0 else size
        out.append(block[:at].strip())
        block = block[at:].lstrip()
    return [p for p in [*out, block.strip()] if p]


def test_fit_blocks_matches_the_rule(spark):
    import random

    rng = random.Random(8)
    blocks = ["".join(rng.choice("ab \n\t\u00a0\U0001f600") for _ in range(rng.randrange(1, 90))).strip() for _ in range(300)]
    blocks = [b for b in blocks if b]
    for size in (1, 2, 7, 20):
        got = spark.createDataFrame([(b,) for b in blocks], "b string").select("b", chunking.fit_blocks(F.array("b"), size).alias("p")).collect()
        assert all(r["p"] == cut(r["b"], size) for r in got)


def test_guard_of_composition():
    import re
    import sys
    import unicodedata

    guard = re.compile(re.sub(r"\\x\{(\w+)\}", lambda m: f"\\U{int(m.group(1), 16):08x}", text.DECOMPOSED))
    seconds = {unicodedata.normalize("NFD", chr(c))[-1] for c in range(sys.maxunicode + 1) if not 0xD800 <= c < 0xE000 and len(unicodedata.normalize("NFD", chr(c))) > 1}
    for c in range(sys.maxunicode + 1):
        x = chr(c)
        if not 0xD800 <= c < 0xE000 and not guard.match(x):
            assert unicodedata.normalize("NFC", x) == x and not unicodedata.combining(x) and x not in seconds, hex(c)
    assert guard.search("cafe\u0301") and not guard.search("café — “quoted” 日本 Привет 한국")


def test_blocked_urls_with_escapes_are_removed(spark):
    from kbweave.operators import pages

    rules = urls.CrawlRules(host="www.example.com", blocked_urls=("https://www.example.com/a b/x",), blocked_substrings=())
    rows = spark.createDataFrame([("HTTPS://www.example.com/a b/x",), (" https://www.example.com/a b/x ",), ("https://www.example.com/a b/y",)], "source_url string").withColumn("status_code", F.lit(200))
    kept = pages.filter_pages(rows, rules)
    assert [r[0] for r in kept.select("source_url").collect()] == ["https://www.example.com/a b/y"]
    reasons = rows.select(urls.admission_reason(F.col("source_url"), F.col("status_code"), rules)).collect()
    assert [r[0] for r in reasons] == ["blocklisted_url", "blocklisted_url", "ok"]


def test_sanitize(spark):
    raw = "Know more\nKnow more\nx\nknow more\n\n\n\ny  \nKNOW MORE now\nknow more"
    assert one(spark, text.sanitize_markdown(F.col("t")), t=raw) == "x\n\ny\nKNOW MORE now"


def test_many_markers_equal_a_chain_of_searches(spark):
    rng = random.Random(5)
    letters = "abcé .+-[$"
    made = {"".join(rng.choice(letters) for _ in range(rng.randint(1, 6))) for _ in range(400)}
    names = sorted(made)
    rng.shuffle(names)
    rules = tuple((f"r{k}", tuple(names[k::25])) for k in range(25))
    texts = ["".join(rng.choice(letters + "xyz") for _ in range(rng.randint(0, 12))) for _ in range(300)] + ["", "zzz", "ABC"]
    df = spark.createDataFrame([(t,) for t in texts] + [(None,)], "t string")
    got = [r[0] for r in df.select(classify.first_rule(F.col("t"), rules, "none")).collect()]
    want = [next((n for n, ms in rules if any(m in (t or "").lower() for m in ms)), "none") for t in [*texts, None]]
    assert got == want and len(set(want)) > 10
    some = classify.REWARD_CATEGORIES
    shown = spark.createDataFrame([("A Gold phone case",), ("swiggy e-voucher",), ("bookmyshow",), ("nothing",)], "t string")
    assert [r[0] == r[1] for r in shown.select(classify.first_rule(F.col("t"), some, "x"), markers.first_rule_of_many(F.col("t"), some, "x")).collect()] == [True] * 4
    assert shown.select(markers.first_rule_of_many(F.col("t"), (("a", ()), ("b", ("",))), "x")).first()[0] == "b"


def test_sanitize_is_not_quadratic_in_lines(spark):
    import time

    raw = "\n".join(f"read more {k % 4000}\nx{k}" for k in range(12_000)) + "\nread more 4001\ny\nREAD more 4001"
    one(spark, text.sanitize_markdown(F.col("t")), t="a")
    start = time.time()
    assert one(spark, text.sanitize_markdown(F.col("t")), t=raw) == "\n".join(f"x{k}" for k in range(12_000)) + "\nread more 4001\ny\nREAD more 4001"
    assert time.time() - start < 20
