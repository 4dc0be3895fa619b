"""Stateful operators, sources and plans on small inputs."""

from __future__ import annotations

import json
import random

import pytest
from pyspark.sql import functions as F

from kbweave.operators import cdc, index
from kbweave.plans import pipeline, search, service, settings
from kbweave.sources import crawl, readers, writers
from kbweave.streaming import micro_batch


def test_changes_match_a_row_by_row_run(spark):
    rng = random.Random(3)
    before = {f"u{i}": (rng.randint(1, 3), f"h{rng.randint(0, 2)}") for i in range(40) if rng.random() < 0.6}
    rows = [(f"u{rng.randrange(40)}", i, rng.random() < 0.7, f"h{rng.randint(0, 2)}") for i in range(150)]
    want = {}
    state = dict(before)
    for u, i, ok, h in rows:
        have = state.get(u)
        effective = h if ok else have[1] if have else h
        status = "NEW" if have is None else "UNCHANGED" if not ok or h == have[1] else "UPDATED"
        state[u] = ((have[0] if have else 0) + 1, effective)
        want[i] = (status, state[u][0], effective)
    current = spark.createDataFrame(rows, "normalized_url string, ord int, success boolean, content_hash string")
    snapshots = spark.createDataFrame([(u, v, h) for u, (v, h) in before.items()], "normalized_url string, version_no int, content_hash string")
    got = {r["ord"]: (r["change_status"], r["version_no"], r["effective_hash"]) for r in cdc.classify_changes(current, snapshots).collect()}
    assert got == want


def pages(spark, n=12, mark=""):
    rows = [(f"https://www.example.com/p/{i}", f"Title {i}", "d", "k,l", f"Body number {i} {mark if i % 3 == 0 else ''}\n\nmore words here", i != 5, 200, i) for i in range(n)]
    return spark.createDataFrame(rows, "source_url string, title string, description string, keywords string, markdown string, success boolean, status_code int, ord int")


def test_ingest_twice_changes_nothing(spark):
    none = spark.createDataFrame([], "normalized_url string, version_no int, content_hash string")
    options = pipeline.RunOptions(dims=16)
    first = pipeline.ingest(pages(spark), none, options)
    snaps = first["changes"].select("normalized_url", "version_no", F.col("effective_hash").alias("content_hash"))
    assert first["changes"].where("change_status = 'NEW'").count() == 12
    assert first["chunks"].where(F.size("embedding") == 16).count() == 11
    second = pipeline.ingest(pages(spark), snaps, options)
    assert second["changes"].where("change_status <> 'UNCHANGED'").count() == 0
    third = pipeline.ingest(pages(spark, mark="edit"), snaps, options)
    assert third["changes"].where("change_status = 'UPDATED'").count() == 4


def test_search_end_to_end(spark):
    rows = [(str(i), t, "", ["card", t.split()[0]], f"card {t.split()[0]}", t, "/p", "u", "", True, [float(i), 1.0]) for i, t in enumerate(["fees for cards", "card limits", "other things", "fees"])]
    docs = spark.createDataFrame(rows, "_id string, title string, description string, keywords array<string>, keywords_joined string, search_text string, path string, source_url string, parsed_url_path_text string, is_active boolean, embedding array<double>")
    hits = search.search(docs, "fees", [0.0, 1.0]).collect()
    assert {h["id"] for h in hits} == {"0", "3"}
    assert hits[0]["score"] >= hits[1]["score"]
    assert any(h["exact_match_bonus_applied"] for h in hits)
    assert search.search(docs, " ", [0.0, 1.0]).count() == 0


def test_index_delta(spark):
    old = spark.createDataFrame([("a", "p", True), ("b", "p", True), ("c", "q", True)], "_id string, parent_doc_id string, is_active boolean")
    new = spark.createDataFrame([("c", "q", True)], old.schema)
    gone = spark.createDataFrame([("x", "p")], "_id string, parent_doc_id string")
    assert {r[0] for r in index.apply_actions(old, new, gone, by="parent_doc_id").select("_id").collect()} == {"c"}
    assert {r[0] for r in index.apply_actions(old, new, gone).select("_id").collect()} == {"a", "b", "c"}


def test_readers(spark, tmp_path):
    (tmp_path / "a.jsonl").write_text('{"embedding_text":"x","embedding":[1,2],"metadata":{"k":1}}\n\n[1]\n')
    (tmp_path / "b.csv").write_text('embedding_text,embedding,title\ny,"[3.5]",T\nz,,\n')
    (tmp_path / "c.json").write_text(json.dumps({"records": [{"embedding_text": "w", "embedding": "[4]"}, 7]}))
    got = {r["embedding_text"]: r for r in readers.read_records(spark, str(tmp_path)).collect()}
    assert got["x"]["embedding"] == [1.0, 2.0] and json.loads(got["x"]["metadata"]) == {"k": 1}
    assert got["y"]["embedding"] == [3.5] and json.loads(got["y"]["metadata"]) == {"title": "T"}
    assert got["z"]["embedding"] == [] and got["w"]["embedding"] == [4.0]
    with pytest.raises(FileNotFoundError):
        readers.read_records(spark, str(tmp_path / "none"))
    with pytest.raises(Exception, match="no JSON object"):
        readers.read_jsonl(spark, str(tmp_path / "a.jsonl")).collect()
    (tmp_path / "pages.json").write_text(json.dumps({"pages": [{"source_url": "u", "keywords": ["a", "b"], "depth": 1, "success": True}, "junk"]}))
    page = readers.read_page_json(spark, str(tmp_path / "pages.json")).collect()
    assert len(page) == 1 and page[0]["source_url"] == "u" and page[0]["success"] is True


def test_sitemaps_and_crawl(spark):
    maps = spark.createDataFrame([("r.xml", "<loc>s.xml</loc><loc>https://h/a</loc>"), ("s.xml", "<loc>https://h/b</loc><loc>r.xml</loc>")], "url string, xml string")
    assert {r[0] for r in readers.traverse_sitemaps(maps, ["r.xml"], "https://h/").collect()} == {"https://h/a", "https://h/b"}
    site = {"https://www.example.com/": ["/x"], "https://www.example.com/a": ["https://www.example.com/b", "https://else.example/"], "https://www.example.com/b": []}
    site["https://www.example.com/"] = ["https://www.example.com/a", "https://www.example.com/f.pdf"]
    table = spark.createDataFrame([(u, "".join(f"<a href='{x}'>l</a>" for x in links) or "<p>end</p>") for u, links in site.items()], "url string, html string")
    got = crawl.crawl(spark, "https://www.example.com/", table, max_depth=3).select("url", "depth").collect()
    assert {tuple(r) for r in got} == {("https://www.example.com/", 0), ("https://www.example.com/a", 1), ("https://www.example.com/b", 2)}
    fetched = crawl.crawl(spark, "https://www.example.com/", get=lambda u: "<p>x</p>", max_depth=1).collect()
    assert len(fetched) == 1 and fetched[0]["success"]


def test_bundle_round_trip_has_no_credentials(spark, tmp_path):
    records = spark.createDataFrame([("a", "t")], "_id string, title string")
    gone = spark.createDataFrame([("z",), ("z",), ("y",)], "_id string")
    writers.export_bundle(records, gone, str(tmp_path / "b"), {"index": "kb", "es_password": "hunter2"})
    vectors, deleted, manifest = writers.read_bundle(spark, str(tmp_path / "b"))
    assert vectors.count() == 1 and [r[0] for r in deleted.orderBy("_id").collect()] == ["y", "z"]
    assert "hunter2" not in str(manifest.collect()) and manifest.first()["deleted_doc_id_count"] == 2
    lines = writers.bulk_lines(spark.createDataFrame([("index", "a", ("t",)), ("delete", "b", None)], "op string, _id string, source struct<title:string>"), "kb").collect()
    assert lines[0]["value"].split("\n")[1] == '{"title":"t"}' and "\n" not in lines[1]["value"]


def test_stream_runs_as_micro_batches(spark, tmp_path):
    src = str(tmp_path / "in")
    pages(spark).write.parquet(src)
    seen = []
    stream = spark.readStream.schema(pages(spark).schema).parquet(src)
    micro_batch.ingest_stream(stream, lambda df, n: seen.append(df.count()), str(tmp_path / "cp")).awaitTermination(60)
    assert sum(seen) == 12


def test_settings_and_service(monkeypatch):
    monkeypatch.setenv("KB_DIMS", "64")
    monkeypatch.setenv("KB_RUN_ID", "")
    made = settings.load(pipeline.RunOptions, '{"chunk_size": 900}', run_id="r")
    assert (made.dims, made.chunk_size, made.run_id) == (64, 900, "r")
    with pytest.raises(ValueError):
        pipeline.RunOptions(chunk_size=0)
    manager = service.RunManager(lambda: 7)
    assert manager.start(wait=True) and manager.last["result"] == 7
    with pytest.raises(ValueError):
        service.Scheduler(manager, 1)


def test_retry_takes_the_last_good_try(spark):
    from kbweave.operators import pages as ops

    first = spark.createDataFrame([("u", False, "a")], "source_url string, success boolean, markdown string")
    again = spark.createDataFrame([("u", True, "z", 1), ("u", True, "b", 2), ("u", False, "y", 3)], "source_url string, success boolean, markdown string, ord int")
    assert ops.recover(first, again, ord="ord").collect()[0]["markdown"] == "b"
    assert ops.recover(first, again).collect()[0]["markdown"] == "z"
    keyless = spark.createDataFrame([("k", True, "x", 1), ("k", True, "xx", 2), (None, True, "n", 3), (None, True, "m", 4)], "source_url string, success boolean, markdown string, ord int")
    for dedupe in (ops.dedupe_best, ops.dedupe_best_by_aggregate):
        assert sorted(r["markdown"] for r in dedupe(keyless, "source_url").collect()) == ["m", "n", "xx"]


def test_runs_never_stay_open(spark):
    from kbweave.operators import runs

    at = F.lit("2024-01-01 00:00:00")
    facts = spark.createDataFrame([("r", 5, 9, None, "sync", 1, 0, 0, *[1] * 8, {"a": 1.0})], "run_id string, started_ms long, finished_ms long, error string, stage string, indexed_count int, indexing_errors int, deleted_count int, " + ", ".join(f"{c} long" for c in runs.COUNTERS) + ", timings map<string,double>")
    kept = []

    def broken():
        raise ValueError("no disk")

    assert not runs.close_run(broken, kept.append, facts, at)
    row = runs.latest(kept[0]).collect()[0]
    assert row["run_status"] == "FAILED" and "no disk" in row["failed_reason"] and row["duration_ms"] == 4
    assert runs.close_run(lambda: runs.finished(facts, at), kept.append, facts, at)
    assert runs.latest(kept[1]).collect()[0]["run_status"] == "COMPLETED"
    assert [runs.exit_code(*x) for x in ((None, 0), ("FAILED", 0), ("COMPLETED", 2), ("COMPLETED", 0))] == [1, 2, 3, 0]


def test_models_fall_back(spark):
    def none(dims):
        raise OSError("no service")

    made = pipeline.first_model(none, pipeline.hashed_model)(8)
    assert len(made(["x"])[0]) == 8
    with pytest.raises(RuntimeError, match="no service"):
        pipeline.first_model(none)(8)
    rows = spark.createDataFrame([("1", "card", "", ["card"], "card", "card", "/p", "u", "", True, made(["card"])[0])], "_id string, title string, description string, keywords array<string>, keywords_joined string, search_text string, path string, source_url string, parsed_url_path_text string, is_active boolean, embedding array<double>")
    assert search.search(rows, "card", None, encode=made).collect()[0]["vector_score"] > 0.99


def test_text_index_gives_the_scan_s_scores(spark, tmp_path):
    rows = spark.createDataFrame([(i, " ".join(f"w{(i * k) % 7}" for k in range(i % 9))) for i in range(200)], "id int, body string").withColumn("title", F.concat(F.lit("w"), (F.col("id") % 5).cast("string")))
    made = index.build_text_index(rows, "id", ["title", "body"], str(tmp_path / "i"), buckets=8)
    fields = {"title": 3.0, "body": 1.0}
    for q in ("w1 w3", "w0", "absent", ""):
        want = {r["id"]: round(r["score"], 9) for r in search.bm25_scan(rows, "id", fields, q).collect()} if q else {}
        assert {r["id"]: round(r["score"], 9) for r in search.bm25(made, fields, q).collect()} == want
    plan = search.bm25(made, fields, "w1 w3")._jdf.queryExecution().toString()
    assert "PartitionFilters: [bucket" in plan.replace("isnotnull(bucket#", "") or "bucket#" in plan.split("PartitionFilters:")[1][:200]


def test_index_table_and_file_errors(spark, tmp_path):
    made = index.create_index(spark, f"file://{tmp_path}/idx")
    assert made.count() == 0 and made.schema == index.INDEX
    with pytest.raises(Exception, match="op and _id"):
        writers.bulk_lines(spark.createDataFrame([("", "a", ("t",))], "op string, _id string, source struct<title:string>"), "kb").collect()


def test_mark_deleted(spark):
    master = spark.createDataFrame([("a", True, "NEW", 1), ("b", True, "NEW", 1)], "normalized_url string, is_active boolean, last_change_status string, last_seen int")
    got = {r[0]: tuple(r)[1:] for r in cdc.mark_deleted(master, master.where("normalized_url = 'a'"), F.lit(2)).collect()}
    assert got == {"a": (False, "DELETED", 2), "b": (True, "NEW", 1)}
