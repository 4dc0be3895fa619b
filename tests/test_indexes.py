"""Written indexes: vector lists, segments with deltas and merges, filters and typeahead from postings, each against the plan over the table."""

from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from kbweave.operators import segments, vector_index
from kbweave.operators.segments import Layout, Segment
from kbweave.plans import indexed_search, search
from kbweave.plans.search import SearchSettings
from kbweave.sources import storage

SF = "/root/testdata/sf0.01"


# --- vectors


def brute_nearest(rows, query, k, allowed=None):
    q = np.asarray(query, float) / np.linalg.norm(query)
    found = [(-(1 + float(np.dot(v / np.linalg.norm(v), q))) / 2, i) for i, v in rows if allowed is None or i in allowed]
    return [(i, -s) for s, i in sorted(found)[:k]]


@pytest.fixture(scope="module")
def clustered(spark, tmp_path_factory):
    rng = np.random.default_rng(3)
    centers = rng.normal(size=(12, 16))
    # a third of all rows is one cluster; some rows are equal
    which = np.where(rng.random(3000) < 0.33, 0, rng.integers(0, 12, 3000))
    data = (centers[which] + 0.3 * rng.normal(size=(3000, 16))).astype(np.float32)
    data[100:120] = data[100]
    rows = [(i, v) for i, v in enumerate(data)]
    df = spark.createDataFrame([(i, [float(x) for x in v], i % 5 == 0) for i, v in rows], "id long, embedding array<float>, keep boolean")
    path = str(tmp_path_factory.mktemp("vectors"))
    extra = df.unionByName(spark.createDataFrame([(9001, None, True), (9002, [], True)], df.schema))
    return rows, df, vector_index.build_vector_index(extra, "id", "embedding", path, lists=24, payload=("keep",)), path


def pairs_of(df):
    return [(r["id"], r["score"]) for r in df.orderBy(F.desc("score"), "id").collect()]


def test_every_row_is_on_one_list(clustered):
    rows, _, index, path = clustered
    assert index.sizes.sum() == len(rows) == index.rows.count() and len(index.sizes) == 24
    assert index.payload == ("keep",)
    again = vector_index.open_vector_index(index.rows.sparkSession, path)
    assert np.allclose(again.centroids, index.centroids) and (again.sizes == index.sizes).all()


@pytest.mark.parametrize("probe", [0, 100, 1234])
def test_exact_search_equals_brute_force(clustered, probe):
    rows, _, index, _ = clustered
    want = brute_nearest(rows, rows[probe][1], 30)
    got = pairs_of(vector_index.nearest(index, [float(x) for x in rows[probe][1]], 30, 60, exact=True))
    assert [s for _, s in got] == pytest.approx([s for _, s in want]) and {i for i, _ in got[:20]} == {i for i, _ in want[:20]}


def test_probing_reads_a_fraction(clustered):
    rows, _, index, _ = clustered
    order, _ = vector_index.probe_order(index, [float(x) for x in rows[7][1]])
    near = index.rows.where(F.col("list").isin(*order[:3].tolist()))
    files = lambda df: {f for f in df.inputFiles()}
    scanned = near.select(F.input_file_name().alias("f")).distinct().collect()
    assert 0 < len(scanned) < len(files(index.rows)) / 2
    assert "PartitionFilters: [isnotnull(list" in near._jdf.queryExecution().toString() or "list#" in near._jdf.queryExecution().toString()


def test_filter_widens_the_probe(spark, clustered):
    rows, _, index, _ = clustered
    allowed = {i for i, _ in rows if i % 97 == 0}
    ids = spark.createDataFrame([(i,) for i in sorted(allowed)], "id long")
    got = pairs_of(vector_index.nearest(index, [float(x) for x in rows[5][1]], 25, 25, ids))
    assert len(got) == 25 and {i for i, _ in got} <= allowed
    exact = pairs_of(vector_index.nearest(index, [float(x) for x in rows[5][1]], 40, 25, ids, exact=True))
    assert [i for i, _ in exact] == [i for i, _ in brute_nearest(rows, rows[5][1], 40, allowed)][: len(exact)] and len(exact) == len(allowed)


def test_recall_of_many_queries(clustered):
    rows, df, index, _ = clustered
    asked = df.where("id % 50 = 0")
    want = {(r["query"], r["id"]) for r in search.knn_queries(df, asked, "id", "embedding", 10).collect()}
    got = [(r["query"], r["id"]) for r in vector_index.nearest_of_many(index, asked, "id", "embedding", 10).collect()]
    assert len(got) == len(set(got)) == len(want) == 600 and index.probes < 12
    assert len(want & set(got)) >= 0.9 * len(want)
    salted = {(r["query"], r["id"]) for r in vector_index.nearest_of_many(index, asked, "id", "embedding", 10, probes=6, block=7, rows_per_salt=50).collect()}
    assert len(want & salted) >= 0.9 * len(want)


def test_recall_on_the_table(spark):
    from kbweave.queries import QUERIES

    r = QUERIES["q_knn_recall"](spark, SF).first()
    assert r["enough"] and r["queries"] == 10


def test_empty_vector_index(spark, tmp_path):
    none = spark.createDataFrame([], "id long, embedding array<float>")
    index = vector_index.build_vector_index(none, "id", "embedding", str(tmp_path / "v"))
    assert vector_index.nearest(index, [1.0, 0.0], 5, 10).count() == 0
    assert vector_index.nearest(vector_index.open_vector_index(spark, str(tmp_path / "v")), [1.0, 0.0], 5, 10, exact=True).count() == 0


def test_vectors_of_several_lengths_fail(spark, tmp_path):
    odd = spark.createDataFrame([(1, [1.0, 2.0]), (2, [1.0])], "id long, embedding array<float>")
    with pytest.raises(Exception, match="one length"):
        vector_index.build_vector_index(odd, "id", "embedding", str(tmp_path / "v"))


# --- segments


LAYOUT = indexed_search.PAGES
COLUMNS = "_id long, title string, description string, keywords array<string>, keywords_joined string, search_text string, path string, source_url string, parsed_url_path_text string, is_active boolean"


def made_docs(spark, ids, seed=0):
    rng = random.Random(seed)
    words = ["card", "cards", "fee", "fees", "travel", "traveller", "gold", "x9", "a", "of", "loan", "loans"]
    rows = []
    for i in ids:
        pick = lambda n: " ".join(rng.choice(words) for _ in range(n))
        keywords = [pick(2), rng.choice(words)]
        rows.append((i, pick(4), pick(6), keywords, " ".join(keywords), pick(30), f"/en/{rng.choice(words)}/{i}", f"https://www.example.com/{rng.choice(words)}", pick(2), rng.choice([True, True, None, False])))
    return spark.createDataFrame(rows, COLUMNS)


def test_filters_equal_the_expression(spark, tmp_path):
    docs = made_docs(spark, range(120)).unionByName(spark.createDataFrame([(500, None, None, None, None, None, None, None, None, None)], COLUMNS))
    index = segments.create(docs, "_id", LAYOUT, str(tmp_path / "i"))
    for query in ("rav", "oa", "gold  FEE loans a travel", "/en/lo"):
        for settings in (SearchSettings(), SearchSettings(broad=True), SearchSettings(broad=True, strict=True, strict_min_tokens=1, strict_min_hits=2)):
            want = sorted(r["_id"] for r in docs.where(search.is_active() & search.metadata_filter(query, settings)).select("_id").collect())
            assert sorted(r["id"] for r in indexed_search.candidates(index, query, settings).collect()) == want, (query, settings)


def test_many_terms_are_joined(spark, tmp_path, monkeypatch):
    docs = made_docs(spark, range(60))
    index = segments.create(docs, "_id", LAYOUT, str(tmp_path / "i"))
    monkeypatch.setattr(indexed_search, "LISTED", 3)
    settings = SearchSettings(broad=True)
    want = sorted(r["_id"] for r in docs.where(search.is_active() & search.metadata_filter("/en/", settings)).select("_id").collect())
    assert sorted(r["id"] for r in indexed_search.candidates(index, "/en/", settings).collect()) == want


def test_suggestions_equal_the_scan(spark, tmp_path):
    docs = made_docs(spark, range(200), 4)
    index = segments.create(docs, "_id", LAYOUT, str(tmp_path / "i"))
    for typed in ("c", "tra", "travell", "gold ca", "loan loan", "of the x", "zz", "", " "):
        want = [tuple(r) for r in search.suggest(docs, typed).collect()] if typed.strip() else []
        assert [tuple(r) for r in indexed_search.suggest(index, typed).collect()] == want, typed


def test_search_reads_few_stored_rows(spark, tmp_path):
    docs = made_docs(spark, range(150), 2)
    index = segments.create(docs, "_id", LAYOUT, str(tmp_path / "i"))
    want = [tuple(r) for r in search.search(docs, "gold card fee", None).select("id", "score", "title", "phrase_bonus_applied").collect()]
    got = [tuple(r) for r in indexed_search.search(index, None, "gold card fee", None).select("id", "score", "title", "phrase_bonus_applied").collect()]
    assert [g[0] for g in got] == [w[0] for w in want] and [g[1] for g in got] == pytest.approx([w[1] for w in want]) and [g[2:] for g in got] == [w[2:] for w in want]
    assert indexed_search.search(index, None, "  ", None).count() == 0


def scores(index, query="gold card of"):
    fields = {"title": 3.0, "description": 1.5, "keywords_joined": 2.0}
    return {r["id"]: round(r["score"], 9) for r in indexed_search.lexical(index, fields, query).collect()}


def test_deltas_equal_a_rebuild(spark, tmp_path):
    rng = random.Random(8)
    path = str(tmp_path / "i")
    state = {i: made_docs(spark, [i], i).first() for i in range(30)}
    index = segments.create(spark.createDataFrame(list(state.values()), COLUMNS), "_id", LAYOUT, path)
    for step in range(5):
        put = {i: made_docs(spark, [i], 1000 * step + i).first() for i in [*rng.sample(range(30), 5), 100 + step]}
        gone = rng.sample(range(32), 4)
        index = segments.apply_delta(index, spark.createDataFrame(list(put.values()), COLUMNS), "_id", spark.createDataFrame([(i,) for i in gone], "_id long"), merge=step == 4)
        state = {i: r for i, r in state.items() if i not in gone} | put
        docs = spark.createDataFrame(list(state.values()), COLUMNS)
        assert len(index.segments) == (step + 2 if step < 4 else 1)
        if step in (2, 4):
            fresh = segments.create(docs, "_id", LAYOUT, str(tmp_path / f"fresh-{step}"))
            assert scores(index) == scores(fresh)
            for typed in ("tra", "gold ca"):
                assert [tuple(r) for r in indexed_search.suggest(index, typed).collect()] == [tuple(r) for r in search.suggest(docs, typed).collect()]
            want = sorted(r["_id"] for r in docs.where(search.is_active() & search.metadata_filter("rav", SearchSettings(broad=True))).select("_id").collect())
            assert sorted(r["id"] for r in indexed_search.candidates(index, "rav", SearchSettings(broad=True)).collect()) == want
    opened = segments.open_index(spark, path, LAYOUT)
    assert (opened.version, opened.segments) == (index.version, index.segments) and scores(opened) == scores(index)
    assert len(segments.vacuum(index)) == 6 and scores(index) == scores(fresh)


def test_blocks_give_the_same_hits(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(segments, "FREQUENT", 20)
    rng = random.Random(6)
    words = ["the"] * 30 + ["of"] * 10 + [f"w{k}" for k in range(60)]
    rows = [(i, " ".join(rng.choice(words) for _ in range(int(2 ** rng.uniform(0, 9)))), rng.choice(["the w1", "w2 of the", ""])) for i in range(800)]
    docs = spark.createDataFrame([*rows, (900, None, None)], "_id long, body string, head string")
    layout = Layout(text=("body", "head"), stored=("body",))
    index = segments.create(docs.where("_id < 600"), "_id", layout, str(tmp_path / "i"))
    fields = {"body": 1.0, "head": 2.5}
    for grown in (index, segments.apply_delta(index, docs.where("_id >= 600"), "_id", merge=False), segments.apply_delta(segments.open_index(spark, str(tmp_path / "i"), layout), docs.where("_id % 100 = 0"), "_id", merge=False)):
        for query, k in (("the of", 10), ("w3 the", 5), ("w7", 40), ("zzz", 3)):
            want = indexed_search.lexical(grown, fields, query).orderBy(F.desc("score"), "id").limit(k).collect()
            top = indexed_search.best_documents(grown, fields, query, k)
            got = top.hits.orderBy(F.desc("score"), "id").collect()
            assert [r["score"] for r in got] == pytest.approx([r["score"] for r in want]) and {r["id"] for r in got[: k // 2]} == {r["id"] for r in want[: k // 2]}
            assert top.read <= top.total
    stop = indexed_search.best_documents(index, {"body": 1.0}, "the of", 10)
    assert stop.read < stop.total and stop.total == index.postings(["body"], ["the", "of"]).count()
    some = docs.where("_id % 7 = 0").select(F.col("_id").alias("id"))
    picked = indexed_search.best_documents(index, fields, "the of", 10, some).hits.collect()
    assert sorted(r["score"] for r in picked) == pytest.approx(sorted(r["score"] for r in indexed_search.lexical(index, fields, "the of", some).orderBy(F.desc("score"), "id").limit(10).collect()))
    assert indexed_search.best_documents(index, fields, "", 5).hits.count() == 0


def test_delta_writes_little(spark, tmp_path):
    path = str(tmp_path / "i")
    index = segments.create(made_docs(spark, range(3000)), "_id", LAYOUT, path)
    size = lambda name: sum(f.stat().st_size for f in (tmp_path / "i" / name).rglob("*.parquet"))
    grown = segments.apply_delta(index, made_docs(spark, range(30), 9), "_id")
    assert size(grown.segments[1].name) < 0.2 * size(grown.segments[0].name)
    assert grown.segments[1].n_docs == grown.segments[1].n_dead == 30


def test_interrupted_writers_are_not_seen(spark, tmp_path):
    path = str(tmp_path / "i")
    assert segments.open_index(spark, path, LAYOUT) is None
    index = segments.create(made_docs(spark, range(10)), "_id", LAYOUT, path)
    (tmp_path / "i" / "segment-lost").mkdir()
    (tmp_path / "i" / "manifest" / "v=000000002").mkdir()  # a manifest without its mark
    assert segments.open_index(spark, path, LAYOUT).version == 1
    with pytest.raises(Exception, match="(?i)exist"):
        segments._commit(spark, path, LAYOUT, 1, list(index.segments))  # another writer's version


def test_empty_delta_and_empty_index(spark, tmp_path):
    none = made_docs(spark, range(1)).limit(0)
    index = segments.create(none, "_id", LAYOUT, str(tmp_path / "i"))
    assert scores(index) == {} and indexed_search.candidates(index, "card").count() == 0 and indexed_search.suggest(index, "c").count() == 0
    grown = segments.apply_delta(index, made_docs(spark, range(5)), "_id")
    assert scores(grown) == scores(segments.create(made_docs(spark, range(5)), "_id", LAYOUT, str(tmp_path / "j")))
    emptied = segments.apply_delta(grown, none, "_id", spark.createDataFrame([(i,) for i in range(9)], "_id long"))
    assert scores(emptied) == {} and emptied.stats().count() == 0


def test_merge_policy():
    sized = lambda *n: tuple(Segment(str(k), x, 0) for k, x in enumerate(n))
    assert segments.merge_run(sized(1000, 10, 10, 10)) == 0
    assert segments.merge_run(sized(1000, 10, 10, 10, 10)) == 4
    assert segments.merge_run(sized(100, 30, 10, 5)) == 4
    assert segments.merge_run(sized(5)) == 0


def test_stamp_and_drop(spark, tmp_path):
    df = storage.materialize(spark.range(5), "dropped")
    files = df.inputFiles()
    assert files
    storage.drop(df)
    assert not any(storage.exists(spark, f) for f in files)
    with pytest.raises(ValueError, match="checkpoint"):

        class Elsewhere:
            class conf:
                get = staticmethod(lambda *a: None)

            class sparkContext:
                master = "local-cluster[2,1,1024]"

        storage.shared_dir(Elsewhere)


def test_a_build_shuffles_texts_and_not_postings(spark, tmp_path):
    """Fails where postings travel: 100 documents of 500 different words each hold 50 000 of them."""
    rows = spark.range(0, 100, 1, 4).select(F.col("id").alias("_id"), F.concat_ws(" ", F.transform(F.sequence(F.lit(1), F.lit(500)), lambda k: F.concat(F.lit("w"), k.cast("string")))).alias("body"), F.lit(None).cast("string").alias("head"))
    written = lambda: sum(s.shuffleWriteRecords() for s in (stages.apply(i) for stages in [spark._jsc.sc().statusStore().stageList(None, False, False, spark.sparkContext._gateway.new_array(spark._jvm.double, 0), None)] for i in range(stages.size())))
    before = written()
    index = segments.create(rows, "_id", Layout(text=("body", "head")), str(tmp_path / "i"))
    assert index.postings(["body"], ["w7", "w499"]).count() == 200 and [(r["n_docs"], r["avg_len"]) for r in index.stats().collect()] == [(100, 500.0)]
    assert written() - before < 20_000


def test_typeahead_needs_no_postings(spark, tmp_path):
    docs = made_docs(spark, range(200), 4)
    index = segments.create(docs, "_id", indexed_search.TYPED, str(tmp_path / "i"))
    assert [r[0] for r in index.table("postings").select("field").distinct().collect()] == ["__state"]
    for typed in ("c", "travell", "gold ca"):
        assert [tuple(r) for r in indexed_search.suggest(index, typed).collect()] == [tuple(r) for r in search.suggest(docs, typed).collect()], typed


def test_search_needs_no_words_and_no_bounds(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(segments, "FREQUENT", 20)
    docs = made_docs(spark, range(200), 4)
    index = segments.create(docs, "_id", indexed_search.SEARCHED, str(tmp_path / "i"))
    whole = segments.create(docs, "_id", LAYOUT, str(tmp_path / "w"))
    assert [index.table(t).count() for t in ("words", "tops", "impacts")] == [0, 0, 0] and whole.table("impacts").count() > 0
    assert scores(index) == scores(whole)
    got, want = ([(r["id"], round(r["score"], 9)) for r in indexed_search.best_documents(i, {"title": 3.0, "search_text": 1.0}, "gold card of", 7).hits.collect()] for i in (index, whole))
    assert got == want and len(got) == 7
    wanted = sorted(r["_id"] for r in docs.where(search.is_active() & search.metadata_filter("rav", SearchSettings(broad=True))).select("_id").collect())
    assert sorted(r["id"] for r in indexed_search.candidates(index, "rav", SearchSettings(broad=True)).collect()) == wanted
    grown = segments.apply_delta(index, made_docs(spark, [3, 900], 9), "_id", spark.createDataFrame([(5,)], "_id long"), merge=False)
    merged = segments.merge_newest(grown, 2)
    assert scores(grown) == scores(merged) and merged.table("impacts").count() == 0


def test_a_share_writes_one_file_of_postings(spark, tmp_path):
    """Fails where a share writes a file for each bucket of terms."""
    index = segments.create(made_docs(spark, range(200)), "_id", LAYOUT, str(tmp_path / "i"))
    files = index.table("postings").select(F.input_file_name().alias("f"), "term").distinct().collect()
    assert len({r["f"] for r in files}) <= int(spark.conf.get("spark.sql.shuffle.partitions")) and len({r["term"] for r in files}) > 12


def test_many_terms_leave_the_pages_between_them_unread(spark, tmp_path):
    """Fails where a long list of terms is looked up between its least and its greatest."""
    rows = spark.range(0, 400, 1, 4).select("id", F.concat_ws(" ", F.transform(F.sequence(F.lit(0), F.lit(999)), lambda k: F.concat(F.lit("w"), (1000 + k).cast("string")))).alias("body"))
    index = segments.create(rows, "id", Layout(text=("body",), impacts=False), str(tmp_path / "i"))
    terms = [f"w10{k:02d}" for k in range(8)] + [f"w19{k}" for k in range(90, 98)]
    found = index.postings(["body"], terms)
    assert len(found.collect()) == 16 * 400
    read = found._jdf.queryExecution().executedPlan().collectLeaves().apply(0).metrics().apply("numOutputRows").value()
    assert read < 400 * 1000 / 2


def test_a_hybrid_search_filters_once(spark, tmp_path, monkeypatch):
    """Fails where each branch and each round of the vector branch filters the documents again."""
    docs = made_docs(spark, range(150), 2)
    index = segments.create(docs, "_id", indexed_search.SEARCHED, str(tmp_path / "i"))
    rng = np.random.default_rng(2)
    vectors = vector_index.build_vector_index(spark.createDataFrame([(i, rng.normal(size=6).tolist()) for i in range(150)], "id long, embedding array<double>"), "id", "embedding", str(tmp_path / "v"), lists=12)
    given, passed = indexed_search.candidates, spark.sparkContext.accumulator(0)

    def counted(batches):
        for b in batches:
            passed.add(b.num_rows)
            yield b

    monkeypatch.setattr(indexed_search, "candidates", lambda *a: given(*a).mapInArrow(counted, "id long"))
    written = []
    materialize = storage.materialize
    monkeypatch.setattr(storage, "materialize", lambda *a: written.append(materialize(*a)) or written[-1])
    hits = indexed_search.search(index, vectors, "gold card fee", [1.0] * 6, exact=True)
    many = given(index, "gold card fee").count()
    assert hits.count() == 25 and passed.value == many > 25
    assert len(written) == 1 and not any(storage.exists(spark, f) for f in written[0].inputFiles())


def test_lists_that_are_passed_on_early_give_the_same_neighbours(spark):
    rng = np.random.default_rng(5)
    df = spark.createDataFrame([(i, rng.normal(size=6).tolist()) for i in range(300)], "id long, embedding array<double>")
    asked = df.where("id % 5 = 0")
    rows = lambda **how: sorted((r["query"], r["id"], round(r["score"], 9)) for r in search.knn_queries(df, asked, "id", "embedding", 4, **how).collect())
    assert rows(block=32, most=7) == rows(block=512)
