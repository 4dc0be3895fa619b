"""Page markdown, the crawl that feeds a build run, readers with rejects, and the schedule."""

from __future__ import annotations

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from kbweave.functions import dom
from kbweave.functions.urls import CrawlRules
from kbweave.plans import pipeline, service
from kbweave.sources import crawl, readers, storage, writers

BASE = "https://www.example.com"


def test_markdown():
    page = "<html><head><title>t</title></head><body><nav>menu</nav><h2>Head &amp; more</h2><p>One <b>two</b> <a href='/x'>link</a><img src=a></p><ul><li>a<li>b</ul><div class='big popup'>no</div><footer>no</footer><table><tr><td>1<td>2</table></body></html>"
    assert dom.to_markdown(page) == "menu\n\n## Head & more\n\nOne two [link](/x)\n\n* a\n\n* b\n\n1 | 2 |"
    assert dom.to_markdown(None) == dom.to_markdown("") == ""
    assert len(dom.to_markdown("<div>" * 5000 + "deep" + "</div>" * 5000)) == 4


def test_fetch_results_reach_the_records(spark):
    base, waits = BASE, []

    def get(url, timeout):
        if url.endswith("/gone"):
            return crawl.Fetched(html="<title>Gone</title>", status_code=404)
        if url.endswith("/boom"):
            raise TimeoutError("slow")
        moves = ({"event_type": "request", "is_navigation_request": True, "url": url, "headers": {"cookie": "a=1; b = x=y ; a=2;c"}}, {"event_type": "response", "url": url})
        return crawl.Fetched(html=f"<title>T{timeout}</title><p>Body</p>", status_code=200, redirected_url=f"{base}/login", redirected_status_code=200, requests=moves, response_headers={"server": "s"})

    urls = spark.createDataFrame([(f"{BASE}/{n}", 1) for n in ("ok", "gone", "boom")], "url string, depth int")
    got = crawl.fetch(urls, get, crawl.Tuning(2))
    rows = {r["source_url"].rsplit("/", 1)[1]: r for r in crawl.page_records(crawl.fetched_rows(got.withColumn("success", crawl.came()), "agent", {"X": "1"}, [{"name": "n", "value": "v"}])).collect()}
    ok, gone, boom = rows["ok"], rows["gone"], rows["boom"]
    assert ok["success"] and ok["status_code"] == 200 and ok["redirected_url"] == f"{BASE}/login" and ok["title"] == "ok | T30"
    assert ok["request_headers_final"] == {"cookie": "a=1; b = x=y ; a=2;c"} and ok["request_cookies_final"] == {"a": "2", "b": "x=y"} and ok["response_headers"] == {"server": "s"}
    assert ok["request_headers_sent"] == {"X": "1", "User-Agent": "agent"} and [c.asDict() for c in ok["request_cookies_sent"]] == [{"name": "n", "value": "v", "domain": "", "path": ""}]
    assert not gone["success"] and gone["error"] == "HTTP 404" and gone["status_code"] == 404
    assert not boom["success"] and boom["error"] == "TimeoutError: slow" and boom["markdown"] == "" and boom["status_code"] is None
    slow = crawl.one_fetch(lambda u: "x", crawl.Tuning(2, 0.2, 0.3, 60, False), waits.append)
    assert slow("u") == crawl.Fetched("x", 200) and 0.2 <= waits[0] <= 0.5
    assert crawl.one_fetch(get, crawl.Tuning(keep_requests=False))(f"{BASE}/ok").requests == ()


def test_crawl_feeds_a_build_run(spark, tmp_path):
    site = {"/": "<title>Home</title><meta name='keywords' content='a, b'><a href='one'>1</a><a href='/two#x'>2</a><a href='https://else.example/'>e</a>", "/one": "<title>One</title><p>Body of one</p>", "/two": ""}
    table = spark.createDataFrame([(BASE + p, h) for p, h in site.items()], "url string, html string")
    keep = lambda df: storage.materialize(df)
    records, summary = crawl.crawl_site(spark, f"{BASE}/", table, max_depth=2, rules=CrawlRules(blocked_substrings=()), per_round=5, keep=keep)
    got = {r["source_url"]: r for r in records.collect()}
    assert got[f"{BASE}/one"]["success"] and got[f"{BASE}/one"]["markdown"] == "Body of one" and got[f"{BASE}/"]["keywords"] == "a, b"
    assert not got[f"{BASE}/two"]["success"] and got[f"{BASE}/two"]["category"] is None
    s = summary.collect()[0]
    assert (s["saved_pages"], s["failed_pages"], s["retry_candidates"], s["retry_attempted"], s["retry_recovered"]) == (3, 1, 1, 2, 0)
    none = spark.createDataFrame([], "normalized_url string, version_no int, content_hash string")
    run = pipeline.ingest(records, none, pipeline.RunOptions(dims=8, rules=CrawlRules(blocked_substrings=())))
    assert run["changes"].where("change_status = 'NEW'").count() == 3 and run["chunks"].count() == 2
    writers.write_crawl(spark, records, summary, str(tmp_path / "c"), BASE, 2, 800)
    assert spark.read.json(str(tmp_path / "c/pages")).count() == 3 and spark.read.json(str(tmp_path / "c/crawl")).first()["summary"]["saved_pages"] == 3
    assert crawl.tuning(3, 10) == crawl.tuning(1, 150) == crawl.Tuning(2, 0.2, 0.3, 60, False) and crawl.concurrency(1, 10) == 8


def test_readers_name_and_reject(spark, tmp_path):
    (tmp_path / "d").mkdir()
    (tmp_path / "d" / "a.jsonl").write_text('{"embedding_text":"x","embedding":[1,2],"metadata":{"k":1}}\n\n{"embedding_text":"y","metadata":[1]}\n{"embedding_text":"z","embedding":[1],"metadata":7}\n')
    good, bad = readers.split_valid(readers.read_records(spark, str(tmp_path)), 2)
    assert [r["embedding_text"] for r in good.collect()] == ["x"]
    assert {r["embedding_text"]: r["reason"] for r in bad.collect()} == {"y": "no embedding", "z": "embedding of 1 numbers"}
    (tmp_path / "b.jsonl").write_text('{"embedding_text":"x"}\n\n{broken\n')
    with pytest.raises(Exception, match="no JSON in line 3"):
        readers.read_jsonl(spark, str(tmp_path / "b.jsonl"), numbered=True).collect()
    assert readers.first_table(spark, "", str(tmp_path / "none"), str(tmp_path / "d")).count() == 3
    assert readers.first_table(spark, str(tmp_path / "none")) is None
    maps = spark.createDataFrame([(f"{k:02d}.xml", f"<loc>{k + 1:02d}.xml</loc><loc>https://h/{k}</loc>") for k in range(6)], "url string, xml string")
    assert readers.traverse_sitemaps(maps, ["00.xml"], "https://h/", max_sitemaps=None).count() == 6
    assert readers.traverse_sitemaps(maps, ["00.xml"], "https://h/", max_sitemaps=3).count() == 3


def test_cron():
    at = datetime(2024, 2, 28, 23, 59, 30)
    assert service.Cron("*/15 * * * *").after(at) == datetime(2024, 2, 29, 0, 0)
    assert service.Cron("0 0 1 1 *").after(at) == datetime(2025, 1, 1, 0, 0)
    assert service.Cron("30 6 * * mon-fri").after(datetime(2024, 3, 1, 7, 0)) == datetime(2024, 3, 4, 6, 30)
    assert service.Cron("0 12 13 * 5").after(datetime(2024, 9, 1)) == datetime(2024, 9, 6, 12, 0)
    assert service.Cron("0 0 * * 7").after(datetime(2024, 9, 1, 1)) == datetime(2024, 9, 8, 0, 0)
    for bad in ("* * * *", "60 * * * *", "5-1 * * * *", "*/0 * * * *"):
        with pytest.raises(ValueError):
            service.Cron(bad)
    with pytest.raises(ValueError):
        service.Scheduler(service.RunManager(lambda: 1), 60, "* * * * *")
    assert 0 < service.Scheduler(service.RunManager(lambda: 1), cron="* * * * *").wait() <= 60


def test_each_fetch_of_a_url_is_looked_up_by_itself(spark, tmp_path):
    from kbweave.functions import html
    from kbweave.record_queries import q_fetched_pages

    page = "<title>a &quot;b&quot; &amp;&amp;amp &lt;</title>"
    spark.createDataFrame([(k, "https://www.example.com/x", page) for k in (1, 2, 5)], "page_id long, url string, html string").write.parquet(str(tmp_path / "pages.parquet"))
    found = sorted((r["status_code"], r["title"]) for r in q_fetched_pages(spark, str(tmp_path)).collect())
    assert found == [(k, "a &quot;b&quot; &&amp <") for k in (200, 200, 404)]
    assert spark.createDataFrame([(page,)], "t string").select(html.head_field(F.col("t"), "title")).first()[0] == 'a "b" &&amp <'


def test_pages_of_one_url_are_tried_again_one_by_one(spark, tmp_path):
    from kbweave.queries import q_retry_recovery

    spark.createDataFrame([(k, "https://www.example.com/x", "") for k in (1, 3, 6)], "page_id long, url string, html string").write.parquet(str(tmp_path / "pages.parquet"))
    assert sorted(map(tuple, q_retry_recovery(spark, str(tmp_path)).collect())) == [(1, "first", True), (3, "first", False), (6, "retried", True)]
