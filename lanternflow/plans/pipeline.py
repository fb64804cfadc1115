"""From pages to verified, enriched and deduplicated records.

The cheap native gate over homepages comes first; pages are parsed once, after it; each
field is an aggregate of its own, joined on the store.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lanternflow import vocab
from lanternflow.config import Settings
from lanternflow.functions import urls as U
from lanternflow.operators import cohorts, extract, scoring, state
from lanternflow.plans.staging import staged


def linked_pages(homes: DataFrame, pages: DataFrame, limit: int = 4) -> DataFrame:
    """store, page_order, final_url, html, headers: a homepage and the best of its links that were fetched.

    homes: store, final_url, html; pages: requested_url, final_url, html."""
    parsed = extract.parsed_pages(homes.withColumn("page_order", F.lit(0)))
    links = extract.important_links(parsed, limit).select("store", "url", "rank")
    more = links.join(pages.select(F.col("requested_url").alias("url"), "final_url", "html"), "url").select("store", F.col("rank").alias("page_order"), "final_url", "html")
    return homes.select("store", F.lit(0).alias("page_order"), "final_url", "html").unionByName(more)


def records(pages: DataFrame, settings: Settings = Settings(), signals=vocab.PLATFORM_SIGNALS, taxonomy=vocab.CATEGORIES) -> DataFrame:
    """pages: store, page_order, final_url, html (headers) -> a row for each store with status, scores and fields.

    Rejected stores stay, with the status that the gates give; fields are extracted for accepted ones."""
    rows = staged(scoring.verified(pages, signals, settings.platform_threshold), "platform")
    home = scoring.prefilter(pages, signals, settings.prefilter_threshold).select("store", "plausible")
    passed = rows.where("passed").select("store")
    parsed = staged(extract.parsed_pages(pages.join(passed, "store", "left_semi")), "parsed")  # each page is parsed once
    country = staged(scoring.country_verified(parsed.select("store", "page_order", "final_url", F.col("page.text").alias("text"), F.col("page.jsonld_address").alias("address")), settings.country_threshold), "country")
    gated = parsed.join(country.where("passed").select("store"), "store", "left_semi")
    described = staged(extract.descriptions(gated), "descriptions")
    fields = [extract.contacts(gated), extract.socials(gated), described, extract.logos(gated), extract.categories(gated, described, taxonomy)]
    out = rows.select("store", F.col("score").alias("shopify_score"), F.col("confidence").alias("shopify_confidence"), F.col("evidence").alias("shopify_evidence"), F.col("passed").alias("__platform")).join(home, "store")
    out = out.join(country.select("store", F.col("score").alias("india_score"), F.col("confidence").alias("india_confidence"), F.col("evidence").alias("india_evidence"), F.col("passed").alias("__country"), F.col("detected_state").alias("state"), "detected_city", "detected_pincodes"), "store", "left")
    for f in fields:
        out = out.join(staged(f, "field") if f is not described else f, "store", "left")
    empty = F.array().cast("array<string>")
    status = state.outcome_status(F.lit(None).cast("string"), F.col("plausible"), F.col("__platform") & F.coalesce("__country", F.lit(False)), F.col("__platform"), F.coalesce("__country", F.lit(False)), F.lit(0), settings.max_attempts)
    return out.select(
        F.col("store").alias("domain_url"), status.alias("status"), F.coalesce("emails", empty).alias("emails"), F.coalesce("phones", empty).alias("phones"), F.coalesce("socials", extract.empty_socials()).alias("socials"),
        "category", F.col("description").alias("tagline_or_description"), F.col("logo").alias("logo_url"), "state", "detected_city", "detected_pincodes",
        "shopify_score", "india_score", "shopify_confidence", "india_confidence", "shopify_evidence", "india_evidence",
    )


def accepted(recs: DataFrame) -> DataFrame:
    """The best accepted record of each registered domain."""
    keyed = recs.where("status = 'ACCEPTED'").withColumn("key", U.registered_domain(F.col("domain_url")))
    row = F.struct(*[F.col(c) for c in recs.columns])
    best = keyed.groupBy("key").agg(F.min_by(row, F.struct(-(F.col("shopify_score") + F.col("india_score")), "domain_url")).alias("r"))
    return best.select("r.*")


def discovered(current: DataFrame, provenance: DataFrame, found: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """One discovery run over found (sources.readers.many): the new candidates, the new provenance, and counts by provider."""
    from lanternflow.operators.dedupe import discovery_classes, distinct_provenance

    ordered = staged(found.withColumn("order", F.concat_ws("|", F.format_string("%05d", "provider_seq"), "seq")), "found")
    classes = discovery_classes(ordered, current, "domain", "order")
    batch = ordered.select("domain", "original_url", F.lit(1).cast("long").alias("discovery_count"), F.array_compact(F.array("signal")).alias("signals"), F.lit(None).cast("string").alias("notes"), F.col("order").alias("seq"))
    merged = staged(state.merge_candidates(current, batch), "merged")
    rows = ordered.select("domain", "source", F.col("query").alias("discovery_query"), "location", F.col("original_url").alias("source_url"), "signal", "category_hint", F.current_timestamp().alias("observed_at"), "order")
    new = distinct_provenance(rows, ("domain", "source", "discovery_query", "source_url", "signal"), "order", provenance).drop("order")
    all_rows = staged(provenance.unionByName(new), "provenance")
    # a flag and two sources are enough for a priority, however many observations a domain has
    named = F.max(state.names_a_place(F.col("discovery_query"))).alias("named")
    told = all_rows.groupBy("domain").agg(F.array_compact(F.array(F.min("source"), F.max("source"))).alias("sources"), named)
    out = merged.join(told, "domain", "left")
    score = state.priority(F.col("signals"), F.coalesce("sources", F.array().cast("array<string>")), F.lit(None).cast("string"), F.col("domain"), F.col("discovery_count"), named=F.col("named"))
    merged = staged(out.withColumn("priority_score", score.cast("int")).select(*current.columns), "candidates")
    return merged, all_rows, classes.groupBy("provider").pivot("class", ["new", "existing", "duplicate"]).count().na.fill(0)


def batch(current: DataFrame, pages: DataFrame, settings: Settings = Settings(), signals=vocab.PLATFORM_SIGNALS, taxonomy=vocab.CATEGORIES) -> tuple[DataFrame, DataFrame, DataFrame]:
    """One batch over fetched pages (store, page_order, final_url, html, error): new candidates, its records, one row of metrics."""
    todo = state.pick(current, ("NEW", "RETRY"), settings.batch_limit).select("domain", "attempt_count")
    todo = staged(todo, "picked")
    recs = staged(records(pages.join(todo.select(F.col("domain").alias("store")), "store", "left_semi"), settings, signals, taxonomy), "records")
    home = pages.where("page_order = 0").select(F.col("store").alias("domain"), "error", F.lit(True).alias("__home"))
    seen = todo.join(home, "domain", "left").join(recs.select(F.col("domain_url").alias("domain"), F.col("status").alias("__s")), "domain", "left")
    error = F.coalesce("error", F.when(F.col("__home").isNull(), "page was not fetched"))
    events = staged(seen.select(
        "domain", F.when(F.col("attempt_count") >= settings.max_attempts, "FAILED").when(error.isNotNull(), state.failure_status(F.col("attempt_count"), settings.max_attempts)).otherwise(F.coalesce("__s", F.lit("REJECTED_SHOPIFY"))).alias("new_status"),
        error.alias("error"), F.when(error.isNotNull(), U.retry_reason(error)).alias("reason"), F.lit(True).alias("counts_attempt"),
    ), "events")
    # the move to PROCESSING lies between, so each of these is legal from there
    after, _ = state.transition(current, events, force=True)
    metrics = events.agg(F.count(F.lit(1)).alias("processed"), *[F.count(F.when(F.col("new_status").isin(*s), 1)).alias(n) for n, s in cohorts.COUNTED.items()], F.count(F.when(F.col("new_status") == "RETRY", 1)).alias("retried"))
    return after, recs, metrics


def search_queries(spark: SparkSession) -> DataFrame:
    """The 355 search queries: places by signals, cities by signals with a category in turn, categories alone."""
    known = {c.lower() for c in vocab.MAJOR_CITIES}
    lit = lambda rows, names: F.inline(F.array(*[F.struct(*[F.lit(v).alias(n) for n, v in zip(names, r)]) for r in rows]))
    one = spark.range(1)
    places = one.select(lit([(c, 3) for c in vocab.MAJOR_CITIES] + [(s, 2) for s in vocab.STATES if s.lower() not in known], ("location", "base")))
    signals = [(s, vocab.SIGNAL_PRIORITY[s]) for s in vocab.SEARCH_SIGNALS]
    strong = [signals[0], signals[1], signals[-1]]
    each = lambda df, of: df.select("*", lit(of, ("signal", "weight")))
    hint = vocab.CATEGORY_HINTS
    cities = one.select(lit([(c, 10, hint[k % len(hint)]) for k, c in enumerate(vocab.PRIORITY_CITIES)], ("location", "base", "category_hint")))
    alone = one.select(lit([("India", 12, c, *strong[k % 3]) for k, c in enumerate(hint)], ("location", "base", "category_hint", "signal", "weight")))
    rows = each(places, signals).withColumn("category_hint", F.lit("")).unionByName(each(cities, strong)).unionByName(alone)
    query = F.concat(F.format_string('"%s" "%s"', "signal", "location"), F.when(F.col("category_hint") != "", F.concat(F.lit(" "), "category_hint")).otherwise(""))
    return rows.select(query.alias("query"), (F.col("base") + F.col("weight")).alias("priority"), "location", "signal", "category_hint").orderBy(F.desc("priority"), "location", "signal")
