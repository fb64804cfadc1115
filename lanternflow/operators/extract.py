"""Fields of a store from its parsed pages.

parsed: store, page_order, final_url, page (functions.markup.PAGE).  Each field is an aggregate that
picks the first or best value in an explicit order.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from lanternflow import vocab
from lanternflow.functions import text as X
from lanternflow.functions import urls as U
from lanternflow.functions.base import bounded_batches


def parsed_pages(pages: DataFrame) -> DataFrame:
    """pages: store, page_order, final_url, html -> parsed, each page parsed once."""
    from lanternflow.functions.markup import parsed_page

    bounded_batches(pages.sparkSession)
    return pages.where(F.coalesce("html", F.lit("")) != "").withColumn("page", parsed_page(F.col("html"), F.col("final_url")))


def link_score(path: Column, anchor: Column, weights: Mapping[str, int] = vocab.PAGE_PRIORITY) -> Column:
    """The weight of the best phrase in a link's path and text."""
    hay = F.replace(F.lower(F.concat_ws(" ", path, anchor)), F.lit("_"), F.lit("-"))
    return F.greatest(*[F.when(hay.contains(p), w).otherwise(0) for p, w in weights.items()])


def important_links(parsed: DataFrame, limit: int = 4, weights: Mapping[str, int] = vocab.PAGE_PRIORITY) -> DataFrame:
    """store, url, score, rank: the best links to pages of the same registered domain."""
    links = parsed.select("store", "final_url", F.explode("page.links").alias("l"))
    links = links.where(~F.lower(F.trim("l.href")).rlike("^(#|mailto:|tel:|javascript:)")).withColumn("url", F.regexp_replace("l.url", "#.*$", ""))
    links = links.withColumn("score", link_score(U.path_of(F.col("url")), F.col("l.text"), weights)).where(F.col("score") > 0)
    same = U.registered_domain(U.normalize_domain(F.col("url"))).eqNullSafe(U.registered_domain(U.normalize_domain(F.col("final_url"))))
    best = links.where(same & F.col("url").rlike("(?i)^https?://")).groupBy("store", "url").agg(F.max("score").alias("score"))
    return best.withColumn("rank", F.row_number().over(W.partitionBy("store").orderBy(F.desc("score"), "url"))).where(F.col("rank") <= limit)


def contacts(parsed: DataFrame) -> DataFrame:
    """store, emails, phones: sorted and distinct."""
    links = F.col("page.links")
    mails = F.transform(F.filter(links, lambda x: x["href"].startswith("mailto:")), lambda x: F.substr(x["href"], F.lit(8)))
    tels = F.transform(F.filter(links, lambda x: x["href"].startswith("tel:")), lambda x: F.substr(x["href"], F.lit(5)))
    values = F.col("page.jsonld_contacts")
    sources = F.concat(F.array(F.col("page.text")), mails, F.filter(values, lambda v: v.contains("@")))
    found = F.flatten(F.transform(sources, lambda s: X.emails(s)))
    dialled = F.transform(F.concat(tels, F.filter(values, lambda v: ~v.contains("@"))), lambda v: X.normalize_phone(v))
    numbers = F.concat(X.phones(F.col("page.text")), F.filter(dialled, lambda v: v.isNotNull()))
    gathered = parsed.select("store", found.alias("e"), numbers.alias("p")).groupBy("store").agg(F.flatten(F.collect_set("e")).alias("e"), F.flatten(F.collect_set("p")).alias("p"))
    return gathered.select("store", F.array_sort(F.array_distinct("e")).alias("emails"), F.array_sort(F.array_distinct("p")).alias("phones"))


def socials(parsed: DataFrame) -> DataFrame:
    """store, socials: a struct of five urls, null where there is none; the first valid one of each platform."""
    rows = parsed.select("store", "page_order", F.posexplode("page.links").alias("pos", "l")).withColumn("s", U.social_profile(F.col("l.url")))
    order = F.struct("page_order", "pos")
    picked = [F.min_by("s.url", F.when(F.col("s.platform") == p, order)).alias(p) for p in vocab.PLATFORMS]
    return rows.groupBy("store").agg(*picked).select("store", F.struct(*vocab.PLATFORMS).alias("socials"))


def empty_socials() -> Column:
    return F.struct(*[F.lit(None).cast("string").alias(p) for p in vocab.PLATFORMS])


def descriptions(parsed: DataFrame) -> DataFrame:
    """store, description: meta of any page, then og, then JSON-LD, then the homepage's hero, then an about page."""
    tier = lambda n, values: F.transform(values, lambda v, i: F.struct(F.lit(n).alias("tier"), F.col("page_order").alias("page_order"), i.alias("pos"), X.acceptable_description(v).alias("value")))
    home, about = F.col("page_order") == 0, (F.col("page_order") > 0) & F.lower("final_url").contains("about")
    empty = F.array().cast("array<string>")
    options = F.concat(
        tier(0, F.array("page.meta_description")), tier(1, F.array("page.og_description")), tier(2, F.col("page.jsonld_description")),
        tier(3, F.when(home, F.col("page.hero")).otherwise(empty)), tier(4, F.when(about, F.array("page.main_text")).otherwise(empty)),
    )
    rows = parsed.select("store", F.inline(options)).where(F.col("value").isNotNull())
    return rows.groupBy("store").agg(F.min_by("value", F.struct("tier", "page_order", "pos")).alias("description"))


def valid_logo(url: Column, width: Column | None = None, height: Column | None = None) -> Column:
    ok = url.rlike("(?i)^https?://[^/?#]+") & (U.path_of(url) != "") & ~U.forbidden_logo(url)
    if width is None:
        return ok
    n = lambda c: F.replace(c, F.lit("px"), F.lit("")).try_cast("int")
    tiny = n(width).between(1, 32) & n(height).between(1, 32)
    return ok & ~F.coalesce(tiny, F.lit(False))


def logos(parsed: DataFrame) -> DataFrame:
    """store, logo: JSON-LD's first, else the best image, else og:image; ties to the first."""
    option = lambda score, url, ok, pos: F.struct(F.when(ok, score).alias("score"), (-F.col("page_order")).alias("page"), (-pos).alias("pos"), url.alias("url"))
    named = F.transform("page.jsonld_logos", lambda u, i: option(F.lit(1000), u, valid_logo(u), i))

    def image(x: Column, i: Column) -> Column:
        logo = x["hint"].contains("logo")
        score = F.when(x["header"] & logo, 90).when(logo, 75).when(x["header"], 45)
        return option(score, x["url"], valid_logo(x["url"], x["width"], x["height"]), i)

    shared = F.array(option(F.lit(10), F.col("page.og_image"), valid_logo(F.col("page.og_image")), F.lit(1 << 20)))
    rows = parsed.select("store", F.inline(F.concat(named, F.transform("page.images", image), shared))).where("score is not null")
    return rows.groupBy("store").agg(F.max_by("url", F.struct("score", "page", "pos")).alias("logo"))


def categories(parsed: DataFrame, described: DataFrame, taxonomy: X.Taxonomy = vocab.CATEGORIES) -> DataFrame:
    """store, category: headlines of each page weigh 4, navigation 1, the description 3 once."""
    names = [name for name, _ in taxonomy]
    words = {name: ws for name, ws in taxonomy}

    points = lambda text, weight, name: X.phrase_points(text, words[name], weight)
    pages = parsed.groupBy("store").agg(*[F.sum(points(F.col("page.title_h1"), 4, n) + points(F.col("page.nav"), 1, n)).alias(f"c{k}") for k, n in enumerate(names)])
    out = pages.join(described, "store", "left")
    best = F.array_max(F.array(*[F.struct((F.col(f"c{k}") + points(F.col("description"), 3, n)).alias("score"), F.lit(-k).alias("place"), F.lit(n).alias("name")) for k, n in enumerate(names)]))
    return out.select("store", F.when(best["score"] > 0, best["name"]).otherwise(vocab.NO_CATEGORY).alias("category"))
