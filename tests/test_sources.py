from __future__ import annotations

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from lanternflow.operators import state
from lanternflow.plans import pipeline, report
from lanternflow.sources import readers, writers
from lanternflow.streaming import discovery


@pytest.fixture()
def folder(tmp_path):
    (tmp_path / "a.csv").write_text('﻿result_url,query,source,location,signal,category_hint\nhttps://one.in/x,"say ""hi""",s1,Pune,sig,food\nbad url,q,s1,,,\n', encoding="utf-8")
    (tmp_path / "b.csv").write_text("query,result_url,source,location,category_hint\nq2,https://two.in,s2,Goa,kids\nq3,https://www.one.in/y,s2,,\n")
    (tmp_path / "c.txt").write_text("url\nthree.in\n")
    return tmp_path


def test_directory_keeps_columns_apart(spark, folder):
    rows = {r.original_url: r for r in readers.directory_source(spark, str(folder)).collect()}
    assert set(rows) == {"https://one.in/x", "https://two.in", "https://www.one.in/y"}
    one, two = rows["https://one.in/x"], rows["https://two.in"]
    assert (one.query, one.source, one.location, one.signal, one.category_hint) == ('say "hi"', "s1", "Pune", "sig", "food")
    assert (two.query, two.source, two.signal, two.category_hint) == ("q2", "s2", None, "kids")
    assert readers.directory_source(spark, str(folder), limit=1).count() == 1
    assert tuple(readers.read_counts(readers.read_csv(spark, [str(folder / "a.csv")])).first()) == (2, 2, 1)


@pytest.mark.parametrize("column", ["domain_url", "domain", "url", "website", "site", "result_url", "URL"])
def test_flexible_column(spark, tmp_path, column):
    (tmp_path / "x.csv").write_text(f"{column}\nbrand.in\n")
    r = readers.csv_source(spark, str(tmp_path / "x.csv")).first()
    assert (r.domain, r.source) == ("https://brand.in", "csv:x.csv")


def test_seeds_dedupe_before_the_limit(spark, tmp_path):
    (tmp_path / "s.csv").write_text("domain_url\na.in\nwww.a.in\nnope\nb.in\nc.in\n")
    assert [r.domain for r in readers.seeds(spark, str(tmp_path / "s.csv"), 2).collect()] == ["https://a.in", "https://b.in"]
    (tmp_path / "t.csv").write_text("url\na.in\n")
    with pytest.raises(ValueError):
        readers.seeds(spark, str(tmp_path / "t.csv"))


def test_search_results_and_index(spark, tmp_path):
    (tmp_path / "r.csv").write_text('query,result_url\n"""CDN.shopify.com"" ""Pune""",https://p.in/x\n')
    r = readers.search_results(spark, str(tmp_path / "r.csv")).first()
    assert (r.signal, r.source) == ("cdn.shopify.com", "search-csv")
    (tmp_path / "i.json").write_text('{"url": "https://q.in/a", "status": "200"}\n{oops\n')
    assert [r.domain for r in readers.crawl_index(spark, str(tmp_path / "i.json")).collect()] == ["https://q.in"]


def test_pages_robots_and_sitemap(spark):
    p = spark.createDataFrame([("a", 200, "<p>", None), ("b", 503, "x", None), ("c", 200, "y" * 50, None), ("d", 200, "", "timeout")], "final_url string, status_code int, html string, error string")
    assert [r.error for r in readers.page_rows(p, 20).orderBy("final_url").collect()] == [None, "HTTP 503", "response too large", "timeout"]
    urls = spark.createDataFrame([("h", "/a"), ("h", "/b"), ("g", "/a")], "host string, path string")
    assert readers.robots_allowed(urls, spark.createDataFrame([("h", "/a")], "host string, prefix string")).count() == 2
    xml = "<urlset xmlns='x'><url><loc>https://brand.in/products/a</loc></url><url><loc> https://brand.in/blog </loc></url><url><loc>https://o.in/products/b</loc></url></urlset>"
    rows = readers.sitemap(spark.createDataFrame([("https://brand.in", xml), ("https://c.in", "not xml")], "store string, xml string")).collect()
    assert [r.url for r in rows] == ["https://brand.in/products/a"]


def test_discovery_report_and_batch(spark, folder):
    tables = state.initialize(spark)
    found = readers.many([("dir", readers.directory_source(spark, str(folder)))])
    merged, prov, stats = pipeline.discovered(tables["candidates"], tables["provenance"], found)
    rows = {r.domain: r for r in merged.collect()}
    assert (rows["https://one.in"].discovery_count, rows["https://one.in"].priority_score) == (2, 4)
    assert tuple(stats.first()) == ("dir", 2, 0, 1) and prov.count() == 3
    again, _, stats = pipeline.discovered(merged, prov, found)
    assert tuple(stats.first()) == ("dir", 0, 2, 1) and again.where("domain = 'https://one.in'").first().discovery_count == 4
    home = spark.createDataFrame([("https://one.in", 0, "https://one.in/", "Shopify.theme ShopifyAnalytics", None)], "store string, page_order int, final_url string, html string, error string")
    after, recs, metrics = pipeline.batch(merged, home)
    status = {r.domain: (r.status, r.retry_reason, r.attempt_count) for r in after.collect()}
    assert status == {"https://one.in": ("REJECTED_INDIA", None, 1), "https://two.in": ("RETRY", "OTHER_TRANSIENT", 1)}
    assert metrics.first().processed == 2
    parts = report.report(after, prov, tables["runs"], recs)
    told = json.loads(writers.report_json(parts))
    assert told["funnel"][0]["candidates"] == 2 and {s["source"] for s in told["sources"]} == {"s1", "s2"}


def test_export(spark, tmp_path):
    row = ("https://a.in", ["x@a.in"], [], (None, "https://facebook.com/a", None, None, None), "Other", "t", None, "Goa", 5, 6)
    schema = "domain_url string, emails array<string>, phones array<string>, socials struct<instagram:string,facebook:string,twitter:string,linkedin:string,youtube:string>, category string, tagline_or_description string, logo_url string, state string, shopify_score int, india_score int"
    recs = spark.createDataFrame([row, (*row[:8], 7, 6)], schema).withColumn("seq", F.monotonically_increasing_id())
    writers.export(recs, str(tmp_path))
    public = [json.loads(x) for f in sorted((tmp_path / "public_json").glob("part-*")) for x in f.read_text().splitlines()]
    assert len(public) == 1 and public[0]["shopify_score"] == 7 and public[0]["socials"]["instagram"] is None and public[0]["logo_url"] is None
    back = readers.read_csv(spark, [str(next((tmp_path / "csv").glob("part-*.csv")))]).first()
    assert json.loads(back.contacts) == {"emails": ["x@a.in"], "phones": []}
    gaps = {r.field: r.percent for r in writers.missing_report(recs, str(tmp_path / "missing")).collect()}
    assert gaps["logo"] == 100.0 and gaps["socials"] == 0.0


def test_cache_and_evolution(spark):
    t = dt.datetime(2024, 1, 1)
    page = spark.createDataFrame([("u", "u", 200, "old", {}, [], None, t)], state.PAGE)
    new = spark.createDataFrame([("u", "u", 200, "new", {}, [], None, t + dt.timedelta(1))], state.PAGE)
    assert [r.html for r in writers.cache_pages(page, new).collect()] == ["new"]
    assert state.evolved(page.drop("headers"), state.PAGE).columns == page.columns


def test_merge_stream(spark, tmp_path):
    schema = "domain string, original_url string, source string, signal string, observed_at timestamp"
    rows = [("a.in", "https://a.in", "s", "x", dt.datetime(2024, 1, 1)), ("a.in", "https://a.in", "t", "y", dt.datetime(2024, 1, 1))]
    spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/in")
    q = discovery.merge_stream(discovery.observations(spark, f"{tmp_path}/in", schema), f"{tmp_path}/out")
    q.awaitTermination(120)
    r = spark.read.parquet(f"{tmp_path}/out/snapshot-0").first()
    assert (r.domain, r.discovery_count, r.signals) == ("a.in", 2, ["x", "y"])
