from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from lanternflow.functions import text as X
from lanternflow.functions import urls as U


@pytest.mark.parametrize(
    ("raw", "want"),
    [
        ("brand.in", "https://brand.in"), ("http://www.Brand.co.in/path?x=1", "https://brand.co.in"), ("<https://brand.com>", "https://brand.com"), ("[shop](https://shop.brand.in/a)", "https://shop.brand.in"),
        ("https://brand.com:8443/x", "https://brand.com:8443"), ("https://brand.com:443", "https://brand.com"), ("https://brand.com./", "https://brand.com"), ("", None), (None, None), ("localhost", None),
        ("exa_mple.com", None), ("https://a.com:bad", None), ("co.in", None), ("http://1.2.3.4", None), ("not a url", None),
    ],
)
def test_normalize_domain(one, raw, want):
    assert one(U.normalize_domain, raw) == want


def test_normalize_domain_international(one):
    assert one(lambda c: U.normalize_domain(c, international=True), "https://bücher.de/?a=1&amp;b=2") == "https://xn--bcher-kva.de"


@pytest.mark.parametrize(("raw", "want"), [("https://shop.example.co.in", "example.co.in"), ("https://a.b.example.com", "example.com"), ("https://brand.myshopify.com", "brand.myshopify.com"), ("bad", None)])
def test_registered_domain(one, raw, want):
    assert one(lambda c: U.registered_domain(U.normalize_domain(c)), raw) == want


def test_unknown_domains_are_the_same(one):
    assert one(lambda a, b: U.same_registered_domain(U.normalize_domain(a), U.normalize_domain(b)), "x", "y") is True


@pytest.mark.parametrize(
    ("url", "want"),
    [
        ("https://www.instagram.com/brand/?utm=1", ("instagram", "https://instagram.com/brand")), ("https://m.facebook.com/brand", ("facebook", "https://facebook.com/brand")), ("https://twitter.com/brand", ("twitter", "https://x.com/brand")),
        ("https://in.linkedin.com/company/brand", ("linkedin", "https://in.linkedin.com/company/brand")), ("https://facebook.com/sharer.php?u=x", None), ("https://twitter.com/intent/tweet", None), ("https://facebook.com/settings", None),
        ("https://instagram.com/shopify", None), ("https://youtu.be/abc", None), ("https://youtube.com/@brand", ("youtube", "https://youtube.com/@brand")), ("https://linkedin.com/feed", None), ("https://instagram.com/p/123", None), ("https://brand.in/x", None),
    ],
)
def test_social_profile(one, url, want):
    got = one(U.social_profile, url)
    assert (tuple(got) if got else None) == want


@pytest.mark.parametrize(
    ("error", "want"),
    [("blocked by robots.txt", "ROBOTS_BLOCKED"), ("HTTP 429", "HTTP_429"), ("http 503 x", "HTTP_5XX"), ("ConnectTimeout", "TIMEOUT"), ("getaddrinfo failed", "DNS_ERROR"), ("certificate verify", "SSL_ERROR"), ("ConnectError", "CONNECTION_ERROR"), ("odd", "OTHER_TRANSIENT"), (None, "OTHER_TRANSIENT")],
)
def test_retry_reason(one, error, want):
    assert one(U.retry_reason, error) == want


def test_forbidden_logo_looks_at_the_path_only(one):
    assert one(U.forbidden_logo, "https://visa.com/logo.png") is False
    assert one(U.forbidden_logo, "https://a.com/favicon.ico?x") is True


def test_asset_key(one):
    assert one(U.asset_key, "HTTPS://Cdn.Brand.in/Logo.PNG?v=1#x") == "https://cdn.brand.in/Logo.PNG"


def test_clean_text(one):
    assert one(X.clean_text, "  a\n\t b ") == "a b"
    assert one(lambda c: X.clean_text(c, 5), "abcd efgh") == "abcd…"


@pytest.mark.parametrize(
    ("text", "want"),
    [("Store in Bangalore", ("Karnataka", "Bangalore")), ("Kochi, Kerala 682001", ("Kerala", "Kochi")), ("nothing", (None, None)), ("Andheri, MH - 400001", ("Maharashtra", None)), ("New Delhi office", ("Delhi", "New Delhi")), (None, (None, None))],
)
def test_location(one, text, want):
    assert tuple(one(X.location, text)) == want


@pytest.mark.parametrize(
    ("text", "want"),
    [("Mail Hello@Brand.in or hello@brand.in now", ["hello@brand.in"]), ("a@b.com.", []), ("contact@yourbrand.com noreply@brand.in x@a.myshopify.com logo@2x.png", []), ("x..y@brand.in", []), (None, [])],
)
def test_emails(one, text, want):
    assert (one(X.emails, text) or []) == want


@pytest.mark.parametrize(("raw", "want"), [("+91 91234 56789", "+919123456789"), ("tel: 09123456789", "+919123456789"), ("919123456789", "+919123456789"), ("+919876543210", None), ("12345", None), ("+1 743 555 3824", None)])
def test_phone(one, raw, want):
    assert one(X.normalize_phone, raw) == want


def test_context_matches(one):
    p = r"\b[1-9][0-9]{5}\b"
    got = one(lambda c: X.matches_in_context(c, p, 4), "ab 123456 cdefgh 654321")
    assert [tuple(m) for m in got] == [("123456", "ab 123456 cde"), ("654321", "fgh 654321")]


def test_occurrences_are_not_bound_to_words(one):
    assert one(lambda c: X.occurrences(c, "rings"), "earrings and rings") == 2


def test_category_ties_go_to_the_first(one):
    assert one(lambda c: X.category([(c, 1)], (("A", ("x",)), ("B", ("y",)))), "x y") == "A"
    assert one(lambda c: X.category([(c, 1)], (("A", ("x",)), ("B", ("y z",)))), "x y z") == "B"
    assert one(lambda c: X.category([(c, 1)], (("A", ("x",)),)), "q") == "Other"


def test_description(one):
    assert one(X.acceptable_description, "too short") is None
    assert one(X.acceptable_description, "Please accept cookies to go on with this page") is None
    assert one(X.acceptable_description, "Hand-made  sarees from the looms of Kanchi") == "Hand-made sarees from the looms of Kanchi"


def test_rating_and_json(one):
    assert [one(X.rating, v) for v in ("Yes", "no", "", None, "maybe")] == [1, 0, None, None, -1]
    assert one(X.malformed_json, "not json") is True
    assert one(X.json_list, '["a", "b"]') == ["a", "b"]
    assert one(X.json_list, "x") == []


def test_query_text(one):
    assert one(X.inferred_signal, 'find "Powered by SHOPIFY" shops') == "Powered by Shopify"
    assert one(lambda q: X.quoted_family(q, F.lit("cdn.shopify.com")), '"cdn.shopify.com" "Mumbai" food') == "Mumbai"


def test_a_field_that_fails_stays_alone(monkeypatch):
    from lanternflow.functions import markup

    def broken(*_):
        raise RuntimeError("no logo")

    monkeypatch.setattr(markup, "_logo", broken)
    page = markup.parse('<title>t</title><script type="application/ld+json">{"description": "d"}</script><a href="/x">y</a>', "https://a.in", ())
    assert page["jsonld_logos"] == [] and page["title_h1"] == "t" and page["jsonld_description"] == ["d"] and page["links"][0]["url"] == "https://a.in/x"
    deep = "<div>" * 20_000 + "z"
    assert markup.parse(deep, "https://a.in", ())["text"] == "z"


def test_sitemap_locations():
    from lanternflow.functions.markup import locations

    assert locations("<?xml version='1.0'?><u xmlns='x'><loc> https://a.in/p?x=1&amp;y=2 </loc><loc/></u>") == ["https://a.in/p?x=1&y=2"]
    assert locations("<u><loc>https://a.in</loc>") == [] and locations(None) == [] and locations("no xml") == []


def test_parsed_pages_are_handed_on_in_portions(spark):
    """A worker holds a portion of a batch, however many pages or how much markup the batch has."""
    from pyspark.sql import functions as F

    from lanternflow.functions import markup
    from lanternflow.operators.extract import parsed_pages

    html = "<title>t</title>" + "<a href='/x'>y</a>" * 50
    pages = [(html, f"https://a.in/{k}") for k in range(2000)] + [(None, None), ("", "https://b.in")]
    parts = list(markup.parsed_portions(pages, ()))
    assert sum(map(len, parts)) == len(pages) and max(map(len, parts)) <= markup.PORTION // len(html) + 1
    assert [p["links"][0]["url"] if p["links"] else None for part in parts for p in part] == ["https://a.in/x"] * 2000 + [None] * 2
    df = spark.range(3000, numPartitions=1).select(F.col("id").alias("store"), F.lit(html).alias("html"), F.concat(F.lit("https://a.in/"), F.col("id")).alias("final_url"))
    assert parsed_pages(df).where("page.links[49].text = 'y' and page.title_h1 = 't'").count() == 3000
    assert int(spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch").rstrip("bB")) <= 4 << 20
