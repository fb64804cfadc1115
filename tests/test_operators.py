from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from lanternflow import vocab
from lanternflow.config import Settings, env_number
from lanternflow.operators import audit, cohorts, dedupe, extract, sampling, scoring, state
from lanternflow.plans import pipeline

NOW = dt.datetime(2024, 1, 2)
PAGES = "store string, page_order int, final_url string, html string"


def pages(spark, *htmls, store="https://brand.in"):
    return spark.createDataFrame([(store, k, f"{store}/{k or ''}", h) for k, h in enumerate(htmls)], PAGES)


def batch(spark, *rows):
    full = [(d, f"https://{d}", n, s, None, k) for k, (d, n, s) in enumerate(rows)]
    return spark.createDataFrame(full, "domain string, original_url string, discovery_count long, signals array<string>, notes string, seq int")


def test_keep_first_and_best(spark):
    df = spark.createDataFrame([("a", 2, 5), ("a", 1, 5), ("b", 3, 9), (None, 0, 1), ("a", 4, 7)], "key string, seq int, score int")
    assert {(r.key, r.seq) for r in dedupe.keep_first(df, "key", "seq").collect()} == {("a", 1), ("b", 3)}
    assert [(r.key, r.seq) for r in dedupe.keep_best(df, "key", F.col("score"), "seq").collect()] == [("a", 4), ("b", 3)]
    again = dedupe.keep_first(dedupe.keep_first(df, "key", "seq"), "key", "seq")
    assert again.count() == 2


def test_merge_counts_and_preserves(spark):
    empty = spark.createDataFrame([], state.CANDIDATE)
    once = state.merge_candidates(empty, batch(spark, ("a.in", 1, ["x"]), ("a.in", 0, ["y"]), ("b.in", 1, [])), F.lit(NOW))
    twice = state.merge_candidates(once.withColumn("status", F.lit("ACCEPTED")), batch(spark, ("a.in", 3, ["z"])), F.lit(NOW + dt.timedelta(1)))
    rows = {r.domain: r for r in twice.collect()}
    assert (rows["a.in"].discovery_count, rows["a.in"].signals, rows["a.in"].status) == (5, ["x", "y", "z"], "ACCEPTED")
    assert rows["a.in"].created_at == NOW and rows["b.in"].updated_at == NOW
    assert tuple(state.merge_outcome(once, batch(spark, ("a.in", 1, []), ("c.in", 1, []))).first()) == (1, 1)


def test_state_machine(spark):
    assert state.edges(spark).count() == 22
    now = state.merge_candidates(spark.createDataFrame([], state.CANDIDATE), batch(spark, ("a.in", 1, []), ("b.in", 1, [])), F.lit(NOW))
    events = spark.createDataFrame([("a.in", "ACCEPTED", None, None, True), ("b.in", "PROCESSING", "e", "r", True), ("q.in", "NEW", None, None, False)], "domain string, new_status string, error string, reason string, counts_attempt boolean")
    after, refused = state.transition(now, events)
    assert {(r.domain, r.status, r.attempt_count) for r in after.collect()} == {("a.in", "NEW", 0), ("b.in", "PROCESSING", 1)}
    assert {(r.domain, r.why) for r in refused.collect()} == {("a.in", "illegal move"), ("q.in", "unknown domain")}
    stale = state.recover_stale(after.withColumn("updated_at", F.lit(NOW)), F.lit(NOW + dt.timedelta(hours=1)))
    assert {r.domain: r.retry_reason for r in stale.collect()} == {"a.in": None, "b.in": "STALE_PROCESSING"}


@pytest.mark.parametrize(("attempts", "want"), [(0, "RETRY"), (1, "RETRY"), (2, "FAILED")])
def test_failure_budget(spark, attempts, want):
    assert spark.range(1).select(state.failure_status(F.lit(attempts), 3)).first()[0] == want


def test_cache_ttl(spark):
    df = spark.createDataFrame([("a", NOW), ("b", NOW - dt.timedelta(days=2))], "url string, fetched_at timestamp")
    assert [r.url for r in state.fresh(df, F.lit(NOW), 24).collect()] == ["a"]


@pytest.mark.parametrize(
    ("htmls", "score", "band"),
    [(["Shopify.theme ShopifyAnalytics"], 5, "MEDIUM"), (["cdn.shopify.com shopify-section"], 4, "MEDIUM"), (["powered by  Shopify"], 1, "LOW"), (["Shopify.theme", "Shopify.theme"], 3, "LOW"), (["none"], 0, "LOW")],
)
def test_platform_score(spark, htmls, score, band):
    r = scoring.verified(pages(spark, *htmls)).first()
    assert (r.score, r.confidence, r.passed) == (score, band, score >= 4)


def test_platform_header_and_product_json(spark):
    df = pages(spark, "x").withColumn("headers", F.create_map(F.lit("x-shopid"), F.lit("1")))
    v = scoring.verified(df)
    assert v.first().score == 3
    assert scoring.with_product_json(v, F.lit(True)).first().score == 5


@pytest.mark.parametrize(
    ("text", "score", "found_state"),
    [
        ("Registered office: 12 MG Road, Bengaluru, Karnataka 560001, India", 10, "Karnataka"), ("Price ₹ 499", 1, None), ("GSTIN 29ABCDE1234F1Z5", 3, None), ("Haryana Gujarat", 1, None),
        ("code 123456. Our store address is 4 Hill Road, Mumbai, Maharashtra 400050, India. Call +91 91234 56789", 12, "Maharashtra"),
    ],
)
def test_country_score(spark, text, score, found_state):
    df = spark.createDataFrame([("s", 0, "https://brand.com", text, "")], "store string, page_order int, final_url string, text string, address string")
    r = scoring.country_verified(df).first()
    assert (r.score, r.detected_state) == (score, found_state)


def test_structured_address_wins(spark):
    html = '<script type="application/ld+json">{"@graph":[{"@type":"Store","address":{"addressRegion":"Karnataka","addressLocality":"Bengaluru"}}]}</script><p>Mumbai</p>'
    p = extract.parsed_pages(pages(spark, html))
    r = scoring.country_verified(p.select("store", "page_order", "final_url", F.col("page.text").alias("text"), F.col("page.jsonld_address").alias("address"))).first()
    assert (r.detected_state, r.detected_city) == ("Karnataka", "Bengaluru")


HOME = """<html><head><title>Kids wear</title><meta name="description" content="Playful kidswear made in small batches">
<script>Shopify.theme = {}; ShopifyAnalytics</script></head><body><header><img class="site-logo" src="/logo.png" width="120" height="40"></header><nav>accessories</nav>
<a href="/pages/contact-us">Contact</a><a href="https://other.com/contact">x</a><a href="/collections/all">all</a><a href="https://instagram.com/brand?utm=1">ig</a>
<a href="mailto:Care@Brand.in">mail</a></body></html>"""
CONTACT = "<p>Registered office: 12 MG Road, Bengaluru, Karnataka 560001, India. Call +91 91234 56789</p>"


def test_records_end_to_end(spark):
    r = pipeline.records(pages(spark, HOME, CONTACT)).first()
    assert (r.status, r.state, r.category) == ("ACCEPTED", "Karnataka", "Kids & Baby")
    assert (r.emails, r.phones, r.socials.instagram) == (["care@brand.in"], ["+919123456789"], "https://instagram.com/brand")
    assert (r.logo_url, r.tagline_or_description) == ("https://brand.in/logo.png", "Playful kidswear made in small batches")
    assert pipeline.accepted(pipeline.records(pages(spark, HOME, CONTACT))).count() == 1


def test_links_and_linked_pages(spark):
    p = extract.parsed_pages(pages(spark, HOME))
    assert [r.url for r in extract.important_links(p, 1).collect()] == ["https://brand.in/pages/contact-us"]
    fetched = spark.createDataFrame([("https://brand.in/pages/contact-us", "https://brand.in/pages/contact-us", CONTACT)], "requested_url string, final_url string, html string")
    got = pipeline.linked_pages(pages(spark, HOME).drop("page_order"), fetched)
    assert {(r.page_order, r.final_url) for r in got.collect()} == {(0, "https://brand.in/"), (1, "https://brand.in/pages/contact-us")}


@pytest.mark.parametrize(
    ("html", "want"),
    [
        ('<script type="application/ld+json">{"@type":"Organization","logo":{"url":"/brand.svg"}}</script><img src="/logo.png">', "https://brand.in/brand.svg"), ('<img src="/favicon.ico" alt="logo">', None),
        ('<img src="/logo.png" width="16" height="16px">', None), ('<meta property="og:image" content="/share.jpg">', "https://brand.in/share.jpg"), ('<header><img src="/a.png"></header><img src="/logo.png">', "https://brand.in/logo.png"),
    ],
)
def test_logo(spark, html, want):
    rows = extract.logos(extract.parsed_pages(pages(spark, html))).collect()
    assert (rows[0].logo if rows else None) == want


def test_broken_markup_does_not_stop_a_page(spark):
    html = '<a href="http://[bad">x</a><script type="application/ld+json">{oops</script><p>a <b>c'
    r = extract.parsed_pages(pages(spark, html)).select("page.*").first()
    assert (r.text, len(r.links), r.jsonld) == ("x a c", 1, [])


def test_cohorts(spark):
    rows = [("s", k, "ACCEPTED" if k < 24 else "FAILED") for k in range(32)] + [("s", 0, "ACCEPTED"), ("", 99, "NEW"), ("t", 7, "NEW")]
    stats = cohorts.with_rates(cohorts.cohort_stats(spark.createDataFrame(rows, "source string, id int, status string"), ["source"]))
    r = {x.source: x for x in stats.collect()}
    assert (r["s"].candidates, r["s"].accepted_rate, r["s"].high_volume_high_yield, r["t"].sample) == (32, 75.0, True, "tiny")
    runs = spark.createDataFrame([(1, 20, 5, 120.0), (2, 0, 0, 0.0)], "id int, processed int, accepted int, total_seconds double")
    got = {x.id: x for x in cohorts.run_metrics(runs).collect()}
    assert (got[1].processed_per_minute, got[1].accepted_per_minute, got[2].acceptance_percent) == (10.0, 2.5, None)
    assert cohorts.status_counts(spark.createDataFrame([], "status string")).count() == 8


def test_targeted_sample(spark):
    conf = ["LOW"] * 3 + ["MEDIUM"] * 4 + ["HIGH"] * 13
    rows = [(f"d{k:02}", k, str(k), str(20 - k), "" if k == 12 else "Goa", "t", "l", "PASS", "PASS", c) for k, c in enumerate(conf)]
    df = spark.createDataFrame(rows, "domain string, seq int, shopify_score string, india_score string, state string, tagline_or_description string, logo_url string, auto_contacts_check string, auto_socials_check string, auto_audit_confidence string")
    got = {r.domain: r.selection_reason for r in sampling.targeted(df).collect()}
    assert len(got) == 15 and got["d00"].startswith("all_low_confidence") and "missing_state" in got["d12"] and "lowest_india_score" in got["d19"]
    capped = [r.domain for r in sampling.targeted(df, target=4).collect()]
    assert capped == ["d00", "d01", "d02", "d03"]


def test_stratified(spark):
    df = spark.createDataFrame([("A" if k % 2 else "B", str(k)) for k in range(40)], "status string, domain string")
    got = sampling.stratified(df, "status", "domain", {"A": 5, "B": 30}, seed=4)
    assert {r["status"]: r["count"] for r in got.groupBy("status").count().collect()} == {"A": 5, "B": 20}
    assert sorted(r.domain for r in got.collect()) == sorted(r.domain for r in sampling.stratified(df, "status", "domain", {"A": 5, "B": 30}, seed=4).collect())


def current(spark, recs):
    now = recs.select(F.col("domain_url").alias("domain"), F.lit(True).alias("available"), F.lit("").alias("markup"), F.col("shopify_score").alias("platform_score"), F.lit(True).alias("platform_passed"), F.col("shopify_evidence").alias("platform_evidence"), F.col("india_score").alias("country_score"), F.lit(True).alias("country_passed"), F.col("india_evidence").alias("country_evidence"), "state", F.col("logo_url").alias("logo"), F.lit(None).cast("int").alias("logo_width"), F.lit(None).cast("int").alias("logo_height"), "emails", "phones", "socials")
    return now


def test_audit(spark):
    recs = pipeline.records(pages(spark, HOME, CONTACT))
    stored = recs.withColumnRenamed("domain_url", "domain")
    row = audit.audited(stored, current(spark, recs)).first()
    assert tuple(row.__fields__) == vocab.AUTO_COLUMNS and row.auto_audit_confidence == "HIGH"
    lost = audit.audited(stored, current(spark, recs).limit(0)).first()
    assert (lost.auto_shopify_check, lost.auto_audit_confidence) == ("UNCERTAIN", "LOW")
    moved = audit.audited(stored.withColumn("state", F.lit("Goa")), current(spark, recs))
    assert (moved.first().auto_state_check, moved.first().auto_audit_confidence) == ("FAIL", "LOW")
    told = audit.suggested(moved)
    assert (told.first().suggested_state, told.first().review_priority) == ("no", "HIGH")
    assert audit.changed_manual_rows(moved, told).count() == 0 and audit.invalid_verdicts(moved, [f"auto_{c}_check" for c in vocab.CHECKS]).count() == 0


GOOD = ("https://a.in", '{"emails": ["x@a.in"], "phones": []}', '{"instagram": "https://instagram.com/a"}', "Other", "d", "https://a.in/logo.png", "Goa", "5", "6")
COLUMNS = "domain_url string, contacts string, socials string, category string, tagline_or_description string, logo_url string, state string, shopify_score string, india_score string"


@pytest.mark.parametrize(
    ("change", "failed"),
    [({}, set()), ({0: "nope"}, {"Valid domain URLs"}), ({1: "{"}, {"JSON-in-CSV fields"}), ({1: '{"emails": ["x@a.in", "x@a.in"], "phones": []}'}, {"Deduplicated contacts"}), ({2: '{"facebook": "https://facebook.com/sharer/x"}'}, {"Social profile URLs"}), ({5: "https://a.in/favicon.ico"}, {"Logo validation"}), ({7: "3"}, {"Verification thresholds"})],
)
def test_quality(spark, change, failed):
    row = [change.get(k, v) for k, v in enumerate(GOOD)]
    rows = audit.quality(spark.createDataFrame([tuple(row)], COLUMNS), 1).collect()
    assert {r.check for r in rows if not r.passed} == failed
    assert ("NOT READY" in audit.render_checks([tuple(r) for r in rows])) == bool(failed)


def test_search_queries(spark):
    rows = pipeline.search_queries(spark).collect()
    assert len(rows) == 355 and [r.priority for r in rows] == sorted((r.priority for r in rows), reverse=True)


def test_settings(monkeypatch):
    monkeypatch.setenv("LANTERNFLOW_MAX_PAGES", "bad")
    assert Settings.from_env().max_pages == 5 and Settings().with_overrides(max_pages=2).max_pages == 2
    assert env_number("LANTERNFLOW_NONE", 1.5, float) == 1.5


def test_runs_and_first_provenance(spark):
    import datetime as dt

    from pyspark.sql import functions as F

    from lanternflow.operators import state

    at = lambda h: F.lit(dt.datetime(2024, 1, 1, h))
    runs = state.create_run(state.create_run(state.initialize(spark)["runs"], "a", at(1)), "b", at(2))
    done = {r.id: r for r in state.finish_run(runs, 2, {"processed": 10, "accepted": 4}, at(3)).collect()}
    assert (done[2].wave, done[2].total_seconds, done[2].processed, done[2].accepted) == ("b", 3600.0, 10, 4) and done[1].finished_at is None and set(done) == {1, 2}
    people = spark.createDataFrame([("a",), ("b",)], "domain string")
    rows = spark.createDataFrame([("a", "late", "q2", "u2", dt.datetime(2024, 1, 2)), ("a", "early", "q1", "u1", dt.datetime(2024, 1, 1))], "domain string, source string, discovery_query string, source_url string, observed_at timestamp")
    assert sorted(map(tuple, state.first_provenance(people, rows).collect())) == [("a", "early", "q1", "u1", 2), ("b", "unknown", None, None, 0)]
    assert state.candidate(people, "b").count() == 1
