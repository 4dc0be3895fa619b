"""Host reputation, spelling variants and token alignment: against brute force and SQL, and over nulls, empty and long texts, repeated rows, empty tables and clashing columns."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import Counter
from pathlib import Path

import duckdb
import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from kbweave.llm import host_reputation, queries, spelling_variants, token_alignment

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", ["op11_host_reputation", "op12_spelling_variants"])
def test_query_matches_sql(spark, name):
    duck = duckdb.connect()
    for p in Path(SF).glob("*.parquet"):
        duck.execute(f"CREATE VIEW {p.stem} AS SELECT * FROM read_parquet('{p}')")
    found = queries.queries()[name](spark, SF)
    cursor = duck.execute(queries.oracle_sql()[name])
    names = [d[0] for d in cursor.description]
    assert sorted(names) == sorted(found.columns)
    assert sorted((tuple(r) for r in found.select(*names).collect()), key=repr) == sorted(cursor.fetchall(), key=repr)


# --- host reputation


def test_rules_and_url_parts(spark):
    urls = [
        ("http://Example.COM/en/x?a#b", "example.com", "/en/x", "example.com/en/", "block"),
        ("http://www.example.com/en/", "www.example.com", "/en/", "www.example.com/en/", "allow"),
        ("http://a.www.example.com/en/1", "a.www.example.com", "/en/1", "www.example.com/en/", "allow"),
        ("http://badexample.com/en/1", "badexample.com", "/en/1", "com/", "allow"),
        ("http://example.com", "example.com", "", None, "allow"),
        ("http://x.net/es/?q", "x.net", "/es/", "net/es/", "block"),
        ("http://x.net?u=://y.com/", "x.net", "", None, "allow"),
        ("http://ÄB.net/fr/\nx", "Äb.net", "/fr/\nx", "net/fr/", "block"),
        ("no scheme.com/", "", "", None, "allow"),
        ("", "", "", None, "allow"),
        (None, "", "", None, "allow"),
        ("://h#/fr/", "h", "", None, "allow"),
    ]
    pages = spark.createDataFrame([(k, u[0]) for k, u in enumerate(urls)], "page_id long, url string").select("*", *[F.lit(1).alias(c) for c in ("host", "path", "rule", "n", "bad", "url_filter", "__salt")])
    labels = spark.createDataFrame([(0, 1, 0), (None, 0, 1), (2, None, None)], "doc_id long, quality int, toxic int")
    for limit in (100, 0):
        got = {r["page_id"]: r for r in host_reputation.judge_urls(pages, labels, settings=host_reputation.Settings(max_broadcast=limit, salted=1)).select("page_id", F.col("host").alias("own"), "url_filter.*").collect()}
        assert {k: (r["host"], r["path"], r["rule"], r["verdict"], r["own"]) for k, r in got.items()} == {k: (*u[1:], 1) for k, u in enumerate(urls)}
        assert sum(r["labelled"] for r in got.values()) == 2  # one outcome, shown at both pages of example.com
    assert host_reputation.judge_urls(pages.limit(0), labels).count() == 0
    kept = host_reputation.filter_urls(pages, labels.limit(0))
    assert kept.columns == pages.columns and kept.count() == len(urls) - 3


def planted_hosts():
    rng = random.Random(5)
    hosts = [(f"h{k}.site{k % 7}.{'com' if k % 2 else 'org'}", 0.1, 40) for k in range(60)]
    hosts += [("bad.mixed.org", 0.9, 60), ("once.mixed.org", 1.0, 1), ("big.mixed.org", 0.05, 3000)]
    hosts += [(f"s{k}.farm.org", 0.95, 5) for k in range(12)] + [("new.farm.org", 0.0, 0)]
    rows, marks = [], []
    for host, rate, n in hosts:
        for _ in range(max(1, n)):
            if n:
                marks.append((len(rows), int(rng.random() >= rate), 0))
            rows.append((len(rows), f"https://{host}/p"))
    return rows, marks


def brute_reputation(rows, marks, s):
    """Plain re-implementation with dictionaries."""
    bad_of = {i: int(q == 0 or t == 1) for i, q, t in marks}
    hosts = {}
    for i, url in rows:
        h = url.split("://")[1].split("/")[0]
        n, b = hosts.get(h, (0, 0))
        hosts[h] = (n + (i in bad_of), b + bad_of.get(i, 0))
    level = {"host": hosts, "domain": {}, "suffix": {}}
    up = {h: ".".join(h.split(".")[-2:]) for h in hosts}
    for h, (n, b) in hosts.items():
        for name, key in (("domain", up[h]), ("suffix", h.split(".")[-1])):
            x = level[name].get(key, (0, 0))
            level[name][key] = (x[0] + n, x[1] + b)
    total = [sum(x[k] for x in hosts.values()) for k in (0, 1)]
    prior = {"suffix": lambda k: (total[1] + 0.5) / (total[0] + 1)}
    out = {}
    for name, parent in (("suffix", None), ("domain", "suffix"), ("host", "domain")):
        p = {k: prior[name](k) for k in level[name]}
        weight = {k: (n - 1) / (1 + s.spread * (n - 1)) ** 2 for k, (n, _) in level[name].items() if n > 1}
        over = sum(w * ((level[name][k][1] - level[name][k][0] * p[k]) ** 2 / (level[name][k][0] * p[k] * (1 - p[k])) - 1) for k, w in weight.items())
        scale = sum(w * (level[name][k][0] - 1) for k, w in weight.items())
        m = s.min_strength if not scale else s.max_strength if over <= 0 else min(s.max_strength, max(s.min_strength, scale / over - 1))
        mean = {k: (m * p[k] + b) / (m + n) for k, (n, b) in level[name].items()}
        if name == "suffix":
            prior["domain"] = lambda k, mean=mean: mean[k.split(".")[-1]]
        elif name == "domain":
            prior["host"] = lambda k, mean=mean: mean[up[k]]
        else:
            out = {k: (m * p[k] + b, m * (1 - p[k]) + n - b) for k, (n, b) in hosts.items()}
    return out


def test_posteriors_match_brute_force_and_blocks_planted_hosts(spark):
    rows, marks = planted_hosts()
    s = host_reputation.Settings(rules=())
    pages = spark.createDataFrame(rows, "page_id long, url string")
    labels = spark.createDataFrame(marks, "doc_id long, quality int, toxic int")
    hosts = host_reputation.outcomes(pages, labels, "page_id", "url", s)
    got = {r["host"]: r for r in host_reputation.reputations(hosts, s).collect()}
    want = brute_reputation(rows, marks, s)
    assert got.keys() == want.keys()
    for h, (a, b) in want.items():
        assert (got[h]["alpha"], got[h]["beta"]) == pytest.approx((a, b), rel=1e-9)
        # the bound stays near the exact quantile
        assert abs(got[h]["lower"] - np.quantile(np.random.default_rng(1).beta(a, b, 40_000), 0.05)) < 0.09
    verdicts = {r["url_filter"]["host"]: r["url_filter"]["verdict"] for r in host_reputation.judge_urls(pages, labels, settings=s).select("url_filter").distinct().collect()}
    blocked = {h for h, v in verdicts.items() if v == "block"}
    assert "bad.mixed.org" in blocked and {f"s{k}.farm.org" for k in range(12)} <= blocked  # few pages each, but a bad domain
    assert "big.mixed.org" not in blocked and "once.mixed.org" not in blocked and not any(h.startswith("h") for h in blocked)


def test_registered_domains(spark):
    hosts = {"a.b.co.uk": ("b.co.uk", "co.uk"), "co.uk": ("co.uk", "co.uk"), "x.y.com": ("y.com", "com"), "com": ("com", "com"), "": ("", ""), "localhost": ("localhost", "localhost")}
    df = spark.createDataFrame([(h,) for h in hosts], "h string")
    domain, suffix = host_reputation.registered(F.col("h"), host_reputation.Settings().suffixes)
    assert {r[0]: (r[1], r[2]) for r in df.select("h", domain, suffix).collect()} == hosts


# --- spelling variants


def brute_words(rows, s):
    n = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if s.slip and h % s.slip == 0:
                k = h % len(run)
                run = run[:k] + run[k + 1 :]
            if len(run) >= s.min_length:
                n[run] += 1
    return {w: c for w, c in n.items() if c >= s.min_count}


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    k = next((i for i in range(len(a)) if a[i] != b[i]), len(a))
    return a != b and (a[k + 1 :] == b[k + 1 :] if len(a) == len(b) else len(b) == len(a) + 1 and a[k:] == b[k + 1 :])


def brute_variants(rows, s):
    words = brute_words(rows, s)
    near = {w: [v for v in words if one_edit(w, v)] for w in words}
    form = {}
    for w, vs in near.items():
        best = min(vs, key=lambda v: (-words[v], v), default=None)
        form[w] = best if best and words[best] >= s.factor * words[w] else None
    out = []
    for w in words:
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, words[w], len(near[w]), words[form[w]] if form[w] else None))
    return sorted(out, key=repr)


def rows_of(df):
    return sorted((tuple(r) for r in df.select("word", "form", "root", "n", "n_near", "form_n").collect()), key=repr)


def made_words(seed, many):
    rng = random.Random(seed)
    words, rows = {}, []
    for _ in range(many):
        w = "".join(rng.choice("abé") for _ in range(rng.randint(4, 9)))
        words[w] = int(4 ** rng.uniform(0, 5))
    for k, (w, c) in enumerate(words.items()):
        rows.append((k, f"{w.upper() if k % 3 else w} - " * c))
    return rows


@pytest.mark.parametrize(("seed", "salted"), [(1, 5000), (2, 3)])
def test_variants_match_brute_force(spark, seed, salted):
    s = spelling_variants.Settings(salted=salted, slip=7)
    rows = [*made_words(seed, 400), (None, "abcdef " * 30), (None, None), (-1, ""), (-1, "aaaaaaa aaaaaaa " * 20), (-1, "aaaaaa×aaaaaa " * 20), (-2, "z" * 5000 + " " + "z" * 5000)]
    df = spark.createDataFrame(rows, "doc_id long, text string").select("*", *[F.lit("x").alias(c) for c in ("word", "n", "form", "gram")])
    assert rows_of(spelling_variants.group_variants(df, settings=s)) == brute_variants(rows, s)
    assert spelling_variants.group_variants(df.limit(0)).count() == 0


def test_chain_of_forms(spark):
    rows = [(1, "abcdefg " * 5), (2, "abcdef " * 25), (3, "abcdefh " * 125), (4, "abcdefhi " * 625), (5, "abcdefhij " * 3125), (6, "abcdefhijk " * 15625)]
    s = spelling_variants.Settings(slip=0)
    got = {r[0]: r[2] for r in rows_of(spelling_variants.group_variants(spark.createDataFrame(rows, "doc_id long, text string"), settings=s))}
    assert set(got.values()) == {"abcdefhijk"}
    assert rows_of(spelling_variants.group_variants(spark.createDataFrame(rows, "doc_id long, text string"), settings=s)) == brute_variants(rows, s)


def test_query_of_variants_matches_brute_force(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    assert rows_of(queries.op12_spelling_variants(spark, SF)) == brute_variants(rows, spelling_variants.Settings())


# --- token alignment


@pytest.fixture(scope="module")
def own():
    import public_tokenizers as P
    from sentencepiece import SentencePieceProcessor
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    a.encode_special_tokens = True
    b = SentencePieceProcessor(model_file=P.path("piece_bpe_32k.model"))
    hidden = [k for k in range(256) if not (33 <= k <= 126 or 161 <= k <= 172 or 174 <= k <= 255)]
    byte = {chr(256 + hidden.index(k)) if k in hidden else chr(k): k for k in range(256)}

    def both(text):
        ids_a = a.encode(" " + text, add_special_tokens=False).ids
        ids_b = b.encode(text)
        said_a = [bytes(byte[c] for c in a.id_to_token(i)) for i in ids_a]
        said_b = [bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode() for i, p in zip(ids_b, map(b.id_to_piece, ids_b), strict=True)]
        return ids_a, said_a, ids_b, said_b

    return both


def brute_alignment(text, own):
    """(a ids, b ids, groups, links) by walking both sides; None without tokens."""
    if not text:
        return None
    ids_a, said_a, ids_b, said_b = own(text)
    if b"".join(said_a) != b" " + text.encode() or b"".join(said_b) != b" " + text.encode():
        return None
    spans = []
    for said in (said_a, said_b):
        at, out = 0, []
        for x in said:
            out.append((at, at + len(x)))
            at += len(x)
        spans.append(out)
    cuts = sorted({e for _, e in spans[0]} & {e for _, e in spans[1]})
    groups = [([], []) for _ in cuts]
    for side, ids in ((0, ids_a), (1, ids_b)):
        k = 0
        for i, (_, e) in zip(ids, spans[side], strict=True):
            while cuts[k] < e:
                k += 1
            groups[k][side].append(i)
    links, j0 = [], 0
    for i, (s, e) in enumerate(spans[0]):
        while spans[1][j0][1] <= s:
            j0 += 1
        j = j0
        while j < len(ids_b) and spans[1][j][0] < e:
            links.append((i, j, ids_a[i], ids_b[j]))
            j += 1
    return ids_a, ids_b, groups, links


def brute_rows(rows, own):
    found = [(i, brute_alignment(t, own)) for i, t in rows]
    docs = Counter(p for _, x in found if x for p in {(a, b) for *_, a, b in x[3]})
    most = Counter()
    for (a, _), n in docs.items():
        most[a] = max(most[a], n)
    out = []
    for i, x in found:
        if x is None:
            out.append((i, 0, 0, 0, 0, 0, 0, ""))
            continue
        said = ";".join(f"{','.join(map(str, a))}|{','.join(map(str, b))}" for a, b in x[2])
        counts = [(docs[a, b], most[a]) for *_, a, b in x[3]]
        out.append((i, len(x[0]), len(x[1]), len(x[2]), len(x[3]), sum(c == m for c, m in counts), sum(c for c, _ in counts), hashlib.sha256(said.encode()).hexdigest()))
    return sorted(out, key=repr)


COLUMNS = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
ODD = [
    (1, None), (2, ""), (2, "the same"), (2, "the same"), (None, "the same"), (3, " "), (4, "a  b   c"), (5, "\n\n x \n y\t\tz "), (6, "▁ tricky ▁"), (7, "<|endoftext|> <s> </s> <0x41>"),
    (8, "É ß \U0001f600​漢字仮名 مرحبا"), (9, "x " * 30000), (10, "unbroken" * 4000), (11, "é a b　c\x00d\x1ce \x1f f"), (12, "don't we'll I'd 've 12345 3.14 --- !!!???"),
]


def test_alignment_matches_brute_force(spark, own):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    assert sorted((tuple(r) for r in queries.op13_token_alignment(spark, SF).select(*COLUMNS).collect()), key=repr) == brute_rows(rows, own)


@pytest.mark.parametrize("limits", [{}, {"window": 16, "cache_bytes": 1000, "max_broadcast": 0, "salted": 1}])
def test_alignment_of_odd_input(spark, own, limits):
    s = token_alignment.Settings(**limits)
    rows = [r for r in ODD if not limits or len(r[1] or "") < 40000]
    df = spark.createDataFrame(rows, "doc_id long, text string").select("*", *[F.lit(1).alias(c) for c in ("shard", "row", "ids", "pair", "n_a")])
    want = brute_rows(rows, own)
    assert sorted((tuple(r) for r in token_alignment.align(df, settings=s).select(*COLUMNS).collect()), key=repr) == want
    assert sum(r[-1] == "" for r in want) >= 3
    assert token_alignment.align(df.limit(0), settings=s).count() == 0
    strings = token_alignment.align(df.select(F.col("doc_id").cast("string").alias("name"), F.col("text").alias("body")), "name", "body", s)
    assert strings.schema["doc_id"].dataType.simpleString() == "string" and strings.count() == len(rows)


def test_groups_and_links(spark, own):
    rows = [(k, t) for k, (_, t) in enumerate(ODD) if t and len(t) < 10000]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    s = token_alignment.Settings(window=8)
    want = {i: brute_alignment(t, own) for i, t in rows}
    links = sorted(tuple(r) for r in token_alignment.links(df, settings=s).collect())
    assert links == sorted((i, *x) for i, found in want.items() if found for x in found[3])
    groups = {}
    for r in token_alignment.groups(df, settings=s).orderBy("doc_id", "start").collect():
        groups.setdefault(r["doc_id"], []).append(r)
    for i, t in rows:
        mine = groups.get(i, [])
        assert [(r["a_ids"], r["b_ids"]) for r in mine] == (want[i][2] if want[i] else [])
        if mine:
            assert mine[0]["start"] == 0 and mine[-1]["end"] == len(t.encode()) + 1 and all(x["end"] == y["start"] for x, y in zip(mine, mine[1:], strict=False))


@given(st.lists(st.text(st.sampled_from("ab'sA1 é \n\t\x1c ​漢▁<|>.,-😀"), max_size=12).map(lambda x: x) | st.sampled_from(["  ", " the", "don't", "\r\n", " ", "token"]), max_size=8).map("".join))
@settings(max_examples=300, deadline=None)
def test_words_part_cleanly(own, text):
    found = next(token_alignment.tokenizers_of(token_alignment.Settings())([text]))
    want = brute_alignment(text, own)
    assert (found is None) == (want is None)
    if want:
        assert [x.tolist() for x in found] == [want[0], want[1]]


def test_long_texts_go_by_segments(own):
    rng = random.Random(3)
    text = " ".join("".join(rng.choice("aeioustrn") for _ in range(rng.randint(1, 9))) for _ in range(40_000))
    tokenizers = token_alignment.Tokenizers(token_alignment.Settings(cache_bytes=100_000))
    parts = [x.tolist() for x in next(tokenizers([text], 1000))]
    ids_a, _, ids_b, _ = own(text)
    assert parts == [ids_a, ids_b]
