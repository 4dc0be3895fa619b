"""Operators over the whole corpus: near-duplicates, packing, page templates, repeats and the pipeline, against brute force."""

from __future__ import annotations

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from kbweave.llm import minhash, packing, page_templates, queries, repeats

SF = "/root/testdata/sf0.001"
ODD = [(1, None), (2, ""), (2, ""), (3, "x " * 30000), (None, "the quick brown fox"), (4, "É ß \U0001f600\n\t"), (5, "the quick brown fox"), (6, "\n\n")]


def rows_of(name, sf=SF):
    return duckdb.connect().execute(f"SELECT * FROM read_parquet('{sf}/{name}.parquet')").fetchall()


def odd(spark):
    return spark.createDataFrame(ODD, "doc_id long, text string").select("doc_id", "text", *[F.lit(7).alias(c) for c in ("key", "bands", "label", "class_id", "length", "start", "rank", "k1", "spans")])


def brute_classes(texts, similarity=0.8):
    sets = [Counter(minhash.shingles(t, 5)) for t in texts]
    parent = list(range(len(texts)))

    def find(i):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    for i in range(len(texts)):
        for j in range(i):
            same = (texts[i] or "") == (texts[j] or "")
            if same or (sets[i] and sets[j] and minhash.overlap(sets[i], sets[j]) >= similarity):
                parent[find(i)] = find(j)
    return [find(i) for i in range(len(texts))]


def partition(ids, classes):
    groups = defaultdict(list)
    for i, c in zip(ids, classes, strict=True):
        groups[c].append(i)
    return sorted(sorted(g) for g in groups.values())


@pytest.mark.parametrize("limits", [{}, {"max_broadcast": 0, "salted": 2}])
def test_near_duplicates_match_brute_force(spark, limits):
    docs = rows_of("documents")
    rng = random.Random(5)
    base = [rng.choice("alpha beta gamma delta epsilon zeta eta theta".split()) + str(rng.randrange(300)) for _ in range(400)]
    texts = [(r[0], r[1]) for r in docs]
    for k in range(60):  # a chain of edits: neighbours are similar, far ones are not
        base[(k * 7) % 400] = f"edit{k}"
        texts.append((10_000 + k, " ".join(base)))
    long = [f"w{rng.randrange(900)}" for _ in range(300)]
    for k in range(40):  # texts of many sizes around one leader, with and without additions of their own
        cut = long[: 300 - 7 * (k % 12)]
        texts.append((20_000 + k, " ".join(cut + [f"own{k}x{j}" for j in range(5 * (k % 9))])))
    got = minhash.near_duplicates(spark.createDataFrame(texts, "doc_id long, text string"), settings=minhash.Settings(**limits)).collect()
    assert len(got) == len(texts)
    assert partition([r["doc_id"] for r in got], [r["class_id"] for r in got]) == partition([i for i, _ in texts], brute_classes([t for _, t in texts]))


def test_signatures_estimate_weighted_jaccard():
    texts = ["a b c d e " * k + "x y z w q " * 3 for k in (1, 3, 10, 40)]
    sign = minhash.signatures(*minhash.shingle_codes(texts, 5), len(texts), 4000, 1)
    for i in range(4):
        for j in range(i):
            want = minhash.overlap(Counter(minhash.shingles(texts[i], 5)), Counter(minhash.shingles(texts[j], 5)))
            assert abs((sign[i] == sign[j]).mean() - want) < 0.04


def test_near_duplicates_odd_input(spark):
    rows = minhash.near_duplicates(odd(spark)).collect()
    assert len(rows) == len(ODD)
    sizes = {r["doc_id"]: r["class_size"] for r in rows}
    assert sizes[1] == sizes[2] == 3 and sizes[5] == 2 and sizes[3] == 1
    kept = minhash.keep_representatives(odd(spark))
    assert kept.columns == odd(spark).columns and kept.count() == 5
    assert minhash.near_duplicates(odd(spark).limit(0)).count() == 0


def test_representatives_keep_every_class(spark):
    one, two, three = ("the first text of all", "a second one with other words", "numbers one two three four")
    lines = [(None, one), (None, one), (None, two), (7, three), (7, "quite another text under this id"), (8, three), (None, three)]
    kept = minhash.keep_representatives(spark.createDataFrame(lines, "doc_id long, text string")).collect()
    assert sorted(map(repr, map(tuple, kept))) == sorted(map(repr, [lines[0], lines[2], lines[3], lines[4]]))


def check_packing(rows, texts):
    settings = packing.Packing()
    encoder = packing.WordEncoder(settings)
    plain = encoder.tokenizer
    want = Counter()
    by_doc = defaultdict(list)
    for r in rows:
        by_doc[r["doc_id"]].append(r)
    for i, t in texts:
        ids = np.asarray([*plain.encode(t or "", add_special_tokens=False).ids, 2], "<u4")
        want[i] += len(ids)
        mine = [r for r in by_doc[i] if r["doc_tokens"] == len(ids)]
        for r in mine:
            part = ids[r["start"] : r["start"] + r["length"]]
            assert zlib.crc32(part.tobytes()) == r["ids_crc32"] or len({t for j, t in texts if j == i}) > 1
    assert Counter({i: sum(r["length"] for r in rs) for i, rs in by_doc.items()}) == want
    sequences = defaultdict(list)
    for r in rows:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    padding = 0
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 4096
        padding += 0 if at & (at - 1) == 0 else 4096 - at
    return padding, sum(want.values())


def test_packing_round_trip(spark):
    padding, tokens = check_packing(queries.op8_packing(spark, SF).collect(), [(r[0], r[1]) for r in rows_of("documents")])
    assert padding < 0.06 * tokens


def test_packing_odd_input(spark):
    texts = [*ODD, (7, "don't it's we'll ½² ǅ İstanbul Σίσυφος ΣΑΣ <|endoftext|> a\x1cb"), (8, "ZÜRICH naïve café!!! 12,5% ... l'été")]
    rows = packing.pack(spark.createDataFrame(texts, "doc_id long, text string")).collect()
    check_packing(rows, texts)
    assert packing.pack(odd(spark).limit(0)).count() == 0
    assert packing.pack(spark.createDataFrame([(1, "a", 5, 6, 7)], "offset int, text string, doc_tokens int, sequence_id int, context int"), "offset").columns[0] == "doc_id"


@pytest.mark.parametrize("limit", [200_000, 0])
def test_step_groups_weigh_alike(spark, limit):
    settings = packing.Packing(step_group=4, max_broadcast=limit)
    rows = packing.pack(spark.read.parquet(f"{SF}/documents.parquet"), settings=settings).collect()
    check_packing(rows, [(r[0], r[1]) for r in rows_of("documents")])
    used, group, context = Counter(), {}, {}
    for r in rows:
        used[r["sequence_id"]] += r["length"]
        group[r["sequence_id"]] = r["step_group"]
        assert context.setdefault(r["sequence_id"], r["context"]) == r["context"]
    assert all(context[s] == (n if n & (n - 1) == 0 else 4096) for s, n in used.items())
    weight = Counter()
    for s, n in used.items():
        weight[group[s]] += n
    assert len(weight) == -(-sum(context.values()) // (4 * 4096)) > 3
    assert max(weight.values()) - min(weight.values()) <= 4096


@pytest.mark.parametrize("seed", range(6))
def test_plan_places_every_piece(seed):
    rng = random.Random(seed)
    histogram = Counter(rng.choice([rng.randint(1, 4096), rng.randint(1, 90), 4096, 512]) for _ in range(rng.choice([3, 200, 5000])))
    plan = packing.Plan(histogram)
    placed = Counter()
    for many, slots, size in plan.patterns:
        at = 0
        for length, offset in sorted(slots, key=lambda x: x[1]):
            assert offset == at
            at += length
            placed[length] += many
        assert at == size <= 4096
    assert placed == histogram


def test_main_text_matches_the_article(spark):
    import html
    import re

    want = {}
    for page_id, _, source in rows_of("pages"):
        body = re.sub(r"<!--.*?-->", "", re.search(r"<article>(.*)</article>", source, re.S).group(1), flags=re.S)
        blocks = [" ".join(html.unescape(re.sub(r"<[^>]+>", "", b)).split()) for b in re.split(r"</?(?:p|h1|br)[^>]*>", body)]
        want[page_id] = "\n".join(b for b in blocks if b)
    got = queries.op9_page_templates(spark, SF).collect()
    assert {r["page_id"]: r["text"] for r in got} == want
    assert all(r["n_chars"] == len(r["text"]) for r in got)


def site(i, extra=""):
    return f"<body><div><p>Site slogan</p></div><div class='story'><h2>Story {i}</h2>{extra}<p>Own words {i} &amp; more</p><br></div><div><p>Imprint</p></div><div class='comments'><p>first!</p></div></body>"


@pytest.mark.parametrize("limit", [100_000, 0])
def test_templates_remove_constant_blocks(spark, limit):
    pages = [(i, f"https://h.example/{i}", site(i, "<p>twin</p>" * (i % 3))) for i in range(6)]
    pages += [(7, None, None), (8, "", ""), (9, "https://lonely.example/", "<header>top</header><p>only <b>page<p>two")]
    shared = "<article><div class='tools'>Print this</div>" + "<p>a line that all share</p><p>own %s</p>" + "</article>"
    pages += [(20 + i, "https://s.example/", shared % (f"{i}</p><p>x" * i)) for i in range(6)]
    df = spark.createDataFrame(pages, "page_id int, url string, html string")
    settings = page_templates.Settings(max_broadcast=limit)
    got = {r["page_id"]: r["main_text"] for r in page_templates.extract_main_text(df.withColumn("main_text", F.lit(1)).withColumn("host", F.lit(2)).withColumn("__t", F.lit(3)), settings=settings).collect()}
    assert got[3] == "Story 3\nOwn words 3 & more" and got[5] == "Story 5\ntwin\ntwin\nOwn words 5 & more"
    assert got[21] == "a line that all share\nown 1\nx"  # the article's own line stays, the constant element goes
    assert got[7] == got[8] == "" and got[9] == "only page\ntwo"
    # the template decides: without classes the constants of the site stay
    blind = {r["page_id"]: r["main_text"] for r in page_templates.extract_main_text(df, settings=page_templates.Settings(min_size=10_000)).collect()}
    assert blind[3] == "Site slogan\nStory 3\nOwn words 3 & more\nImprint"
    assert page_templates.extract_main_text(spark.createDataFrame([], "page_id int, url string, html string")).count() == 0


def test_classes_decide_where_markup_is_silent(spark):
    """The pages of the table with a constant element of no telling name inside each article: it goes by its class alone, and nothing else does."""
    import re

    host = lambda u: re.sub(r".*//([^/]*).*", r"\1", u)
    marked = [(i, u, h.replace("</article>", f"<div class='k'>Follow {host(u)} everywhere</div></article>")) for i, u, h in rows_of("pages", "/root/testdata/sf0.01")]
    df = spark.createDataFrame(marked, "page_id long, url string, html string")
    want = {r["page_id"]: r["text"] for r in queries.op9_page_templates(spark, "/root/testdata/sf0.01").collect()}
    hosts = Counter(host(u) for _, u, _ in marked)
    big = {i for i, u, _ in marked if hosts[host(u)] >= 3}
    with_classes, without = ({r["page_id"]: r["main_text"] for r in page_templates.extract_main_text(df, settings=s).collect()} for s in (page_templates.Settings(), page_templates.Settings(min_size=10_000)))
    assert len(big) > 200 and all(with_classes[i] == want[i] != without[i] for i in big)


def test_headings_of_articles_stay(spark):
    """Twelve articles with the same section headings and the same line in a tool bar: the headings are the articles', the line is not."""
    page = "<body><div>Slogan of the site</div><article><h1>Title {0}</h1><h2>Introduction</h2><p>Text {0} begins</p><h3>Conclusion</h3><p>and ends {0}</p><div class='k'>Keep in touch</div></article></body>"
    df = spark.createDataFrame([(i, f"https://h.example/{i}", page.format(i)) for i in range(12)], "page_id int, url string, html string")
    got = {r["page_id"]: r["main_text"] for r in page_templates.extract_main_text(df).collect()}
    assert got == {i: f"Title {i}\nIntroduction\nText {i} begins\nConclusion\nand ends {i}" for i in range(12)}


def test_classes_raise_precision_where_nothing_is_marked(spark):
    """The pages of the table with article and its like as plain blocks, and a constant slogan and imprint of no telling name on each page of a host: classes find them, and lose next to nothing of the articles."""
    import re

    host = lambda u: re.sub(r".*//([^/]*).*", r"\1", u)
    plain = lambda h, u: re.sub(r"<(/?)(?:article|main)\b[^>]*>", r"<\1div>", h).replace("<body>", f"<body><div>Slogan of {host(u)}</div>").replace("</body>", f"<div>Imprint of {host(u)}</div></body>")
    pages = rows_of("pages", "/root/testdata/sf0.01")
    hosts = Counter(host(u) for _, u, _ in pages)
    df = spark.createDataFrame([(i, u, plain(h, u)) for i, u, h in pages if hosts[host(u)] >= 4], "page_id long, url string, html string")
    gold = {r["page_id"]: Counter(r["text"].split("\n")) for r in queries.op9_page_templates(spark, "/root/testdata/sf0.01").collect()}

    def rates(settings):
        hit = said = known = 0
        for r in page_templates.extract_main_text(df, settings=settings).collect():
            lines = Counter(r["main_text"].split("\n"))
            hit, said, known = hit + (lines & gold[r["page_id"]]).total(), said + lines.total(), known + gold[r["page_id"]].total()
        return hit / said, hit / known

    precision, recall = rates(page_templates.Settings())
    before, _ = rates(page_templates.Settings(min_size=10_000))
    assert recall >= 0.99 and precision > before


def test_classes_match_brute_force(spark):
    pages = [(u.split("/")[2], h) for _, u, h in rows_of("pages")]
    rng = random.Random(3)
    parts = ["<div class='a'><i>x</i></div>", "<ul><li>k</li><li>k</li></ul>", "<p>free</p>", "<div><b>z</b><em>y</em></div>", "<div><em>y</em><b>z</b></div>", "<section><i>1</i></section>"]
    pages += [("made", "<main>" + "".join(rng.choice(parts) for _ in range(rng.randrange(2, 9))) + f"<p>{k}</p></main>") for k in range(40)]
    pages += pages[-3:] * 2  # copies count once
    df = spark.createDataFrame([(f"//{h}/{k}", s) for k, (h, s) in enumerate(pages)], "url string, html string")
    got = defaultdict(dict)
    for r in page_templates.valid_classes(page_templates.parse_table(df, "url", "html")).collect():
        got[r["host"], r["class"]][r["place"]] = r["code"]
    by_host = defaultdict(dict)
    for host, source in pages:
        by_host[host][source] = page_templates.read_page(source).codes
    want, spans = set(), 0
    for host, sources in by_host.items():
        counts = [Counter(codes) for codes in sources.values()]
        vectors = defaultdict(list)
        for code in set().union(*counts):
            vectors[tuple(c[code] for c in counts)].append(code)
        classes = []
        for vector, members in vectors.items():
            on = sum(n > 0 for n in vector)
            if on < 3 or 2 * on < len(counts) or len(members) < 2:
                continue
            orders = set()
            for codes in sources.values():
                mine = [c for c in codes if c in members]
                n = len(members)
                orders |= {tuple(mine[k : k + n]) for k in range(0, len(mine), n)}
            if len(orders) == 1 and len(set(next(iter(orders)))) == len(members):
                classes.append((-on, -len(members), next(iter(orders))))
        kept = {tuple(v[k] for k in sorted(v)) for (h, _), v in got.items() if h == host}
        assert kept <= {o for *_, o in classes}
        for codes in sources.values():  # what is kept nests on every page
            held = {c: o for o in kept for c in o}
            stack = []
            for c in (c for c in codes if c in held):
                if c == held[c][0]:
                    stack.append(list(held[c]))
                assert stack[-1].pop(0) == c
                spans += not stack[-1]
                stack = [x for x in stack if x]
        alone = {o for *_, o in classes} - kept
        for out in alone:  # what is dropped interleaves with a class that is on as many pages at least
            def crosses(a, b):
                for codes in sources.values():
                    held, stack = {c: o for o in (a, b) for c in o}, []
                    for c in (c for c in codes if c in held):
                        if c == held[c][0]:
                            stack.append(list(held[c]))
                        if stack[-1][0] != c:
                            return True
                        stack[-1].pop(0)
                        stack = [x for x in stack if x]
                return False

            assert any(crosses(out, o) for *_, o in classes if o != out)
        want |= kept
    assert spans > 100 and len(want) > 3


def test_pages_of_any_depth(spark):
    deep = "<div>" * 20_000 + "core" + "</div>" * 20_000
    pages = [(k, "https://d.example/", deep) for k in range(3)] + [(3, "https://e.example/", "<article>" + "<p>word</p>" * 50_000 + "</article><article>second</article>")]
    got = {r["page_id"]: r["main_text"] for r in page_templates.extract_main_text(spark.createDataFrame(pages, "page_id int, url string, html string")).collect()}
    assert got[0] == got[2] == "core" and got[3] == "\n".join(["word"] * 50_000 + ["second"])


def brute_repeats(texts, size=400):
    data = [(t or "").encode() for t in texts]
    starts = Counter(b[s : s + size] for b in data for s in range(len(b) - size + 1))
    out = []
    for b in data:
        cover = np.zeros(len(b) + 1, int)
        for s in range(len(b) - size + 1):
            if starts[b[s : s + size]] > 1:
                cover[s] += 1
                cover[s + size] -= 1
        gone = np.cumsum(cover[:-1]) > 0
        kept = np.frombuffer(b, np.uint8)[~gone].tobytes()
        out.append((len(b), int(gone.sum()), int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum()), hashlib.sha256(kept).hexdigest()))
    return out


@pytest.mark.parametrize("limit", [1_000_000, 0])
def test_repeats_match_brute_force(spark, limit):
    rng = random.Random(4)
    words = [f"{rng.choice('abcdefgh')}{rng.randrange(50)}é" for _ in range(60)]
    passage = " ".join(rng.choice(words) for _ in range(200))
    texts = [None, "", "ab" * 900, "abc" * 300, passage[:399], passage[:400]]
    for _ in range(40):
        a, b = sorted(rng.randrange(len(passage)) for _ in range(2))
        own = lambda: " ".join(rng.choice(words) + str(rng.random())[2:5] for _ in range(rng.randrange(60)))
        texts.append(own() + passage[a:b] + own() + passage[: rng.randrange(500)])
    texts += texts[-3:]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    got = {r["doc_id"]: tuple(r)[1:] for r in repeats.remove_repeats(df, settings=repeats.Settings(max_broadcast=limit)).collect()}
    assert [got[i] for i in range(len(texts))] == brute_repeats(texts)


def test_repeats_of_very_common_passages(spark):
    rng = random.Random(5)
    word = lambda: rng.choice("abcdef") + str(rng.randrange(10**6))
    passage, other = (" ".join(word() for _ in range(90)) for _ in range(2))
    texts = [f"{word()} {passage} {' '.join(word() for _ in range(rng.randrange(80)))}" for _ in range(30)] + [other] * 30 + ["x" * 900, None, other[:399]]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    for often in (1, 29, 4096):
        got = {r["doc_id"]: tuple(r)[1:] for r in repeats.remove_repeats(df, settings=repeats.Settings(often=often)).collect()}
        assert [got[i] for i in range(len(texts))] == brute_repeats(texts)


def test_rows_of_one_passage_do_not_meet_in_one_task(spark):
    copies = spark.range(0, 6000, 1, 4).select(F.repeat(F.lit("abcd"), 100).alias("text"))
    conf = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {k: spark.conf.get(k) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        windows, _ = repeats.repeated_windows(copies, "text", repeats.Settings())
        tasks = [r["count"] for r in windows.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert sum(tasks) == 6000 and max(tasks) < 3000


def test_repeats_odd_input(spark):
    rows = repeats.remove_repeats(odd(spark), texts=True).collect()
    assert len(rows) == len(ODD)
    assert {r["doc_id"]: r["n_removed"] for r in rows}[3] == 60000
    assert repeats.remove_repeats(odd(spark).limit(0)).count() == 0


def test_intermediate_tables_are_deleted(spark, tmp_path, monkeypatch):
    monkeypatch.setattr("kbweave.llm.common.shared_dir", lambda spark: f"file://{tmp_path}")
    assert minhash.near_duplicates(spark.read.parquet(f"{SF}/documents.parquet")).count() > 0
    assert {p.name.rsplit("-", 1)[0] for p in (tmp_path / "kbweave").iterdir() if any(p.glob("*.parquet"))} == {"classed"}


def test_pipeline_odd_input(spark):
    """Nulls, empty and repeated rows, clashing columns and empty tables, as the docstrings of the stages say."""
    import corpus_pipeline as p

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    extra = [F.lit(7).alias(c) for c in ("key", "label", "language", "secrets", "contamination", "spans", "offset", "__key")]
    lines = [(90_001, None, "en", None, None), (90_002, "", None, "s", 0), (None, None, None, None, None), (90_003, "12 34 !!", "en", "s", 8)]
    plain = docs.select("doc_id", "text", "lang", "source", "n_chars")
    given = plain.unionByName(plain.limit(5)).unionByName(spark.createDataFrame(lines, plain.schema)).select("*", *extra)
    seen = p.language_id(spark, given, SF)
    assert seen.columns == given.columns and seen.where("text IS NULL OR text = '' OR doc_id = 90003").isEmpty()
    kept = p.near_dedup(spark, given, SF)
    assert kept.columns == given.columns and kept.where("doc_id IN (90001, 90002) OR (doc_id IS NULL AND text IS NULL)").count() == 1
    clean = p.benchmark_decontamination(spark, given, SF)
    assert clean.columns == given.columns and clean.where("doc_id > 90000 OR doc_id IS NULL").count() == 4
    scrubbed = p.secret_scan(spark, given, SF)
    assert scrubbed.columns == given.columns and scrubbed.count() == given.count() and scrubbed.where("text IS NULL").count() == 2
    packed = p.pack(spark, given, SF)
    assert packed.where("doc_id IN (90001, 90002)").select("length").collect() == [(1,), (1,)]
    none = given.limit(0)
    for _, stage in p.STAGES:
        none = stage(spark, none, SF)
        assert none.count() == 0


def test_pipeline_stages(spark):
    import corpus_pipeline as p

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, names = docs.columns, [n for n, _ in p.STAGES]
    assert names == ["language_id", "near_dedup", "benchmark_decontamination", "secret_scan", "packing"]
    counts = [docs.count()]
    for _, stage in p.STAGES[:-1]:
        docs = p.materialize(stage(spark, docs, SF))
        assert docs.columns == columns
        counts.append(docs.count())
    assert counts[1] >= 0.9 * counts[0] and counts[2] < counts[1] and counts[3] < counts[2] and counts[4] == counts[3]
    items = rows_of("benchmark")
    from test_rowwise import brute_contamination

    left = docs.collect()
    assert not any(brute_contamination(r["text"], items)[4] for r in left)
    assert not any('token = "' in r["text"] for r in left)
    packed = p.run(spark, SF).collect()
    # brute force over the stages' own inputs: near-duplicates by all pairs, contamination and secrets by plain code
    first = p.language_id(spark, spark.read.parquet(f"{SF}/documents.parquet"), SF).collect()
    labels = brute_classes([r["text"] for r in first])
    best = {}
    for r, c in zip(first, labels, strict=True):
        best[c] = min(best.get(c, r["doc_id"]), r["doc_id"])
    want = {r["doc_id"]: r["text"] for r in first if r["doc_id"] in best.values()}
    want = {i: t for i, t in want.items() if not brute_contamination(t, items)[4]}
    assert {r["doc_id"] for r in left} == set(want)
    from test_rowwise import brute_spans

    assert all((r["text"] != want[r["doc_id"]]) >= bool(brute_spans(want[r["doc_id"]])) for r in left)
    check_packing(packed, [(r["doc_id"], r["text"]) for r in left])
