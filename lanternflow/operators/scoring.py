"""Weighted-signal classifiers behind thresholds.

A score is the sum of the weights of the distinct signals that any of a store's pages
shows; a signal's evidence is that of the first page that has it.  Patterns run in the JVM.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lanternflow import vocab
from lanternflow.functions import text as X
from lanternflow.functions.base import let
from lanternflow.operators.dedupe import first_evidence


def searchable(headers: Column | None, html: Column) -> Column:
    """Headers as key:value, then the markup."""
    if headers is None:
        return html
    lines = F.concat_ws(" ", F.transform(F.map_entries(headers), lambda e: F.concat_ws(":", e["key"], e["value"])))
    return F.concat(F.coalesce(lines, F.lit("")), F.lit("\n"), html)


def signal_hits(text: Column, signals: Sequence[vocab.Signal]) -> Column:
    """array<struct<signal, weight, value>> of the signals that a text shows."""
    hits = [F.when(F.regexp_extract(text, "(?i)" + s.pattern, 0) != "", F.struct(F.lit(s.name).alias("signal"), F.lit(s.weight).alias("weight"), F.substring(F.regexp_extract(text, "(?i)" + s.pattern, 0), 1, 150).alias("value"))) for s in signals]
    return F.array_compact(F.array(*hits))


def header_hit(headers: Column, names: Sequence[str] = vocab.PLATFORM_HEADERS, signal: tuple[str, int] = vocab.PLATFORM_HEADER_SIGNAL) -> Column:
    value = F.coalesce(*[F.when(F.coalesce(headers[n], F.lit("")) != "", headers[n]) for n in names])
    return F.when(value.isNotNull(), F.struct(F.lit(signal[0]).alias("signal"), F.lit(signal[1]).alias("weight"), F.substring(value, 1, 150).alias("value")))


def page_evidence(pages: DataFrame, signals: Sequence[vocab.Signal] = vocab.PLATFORM_SIGNALS) -> DataFrame:
    """pages: store, page_order, final_url, html, headers (optional) -> a row for each page and signal."""
    headers = F.col("headers") if "headers" in pages.columns else None
    hits = signal_hits(searchable(headers, F.col("html")), signals)
    if headers is not None:
        hits = F.array_compact(F.array_append(hits, header_hit(headers)))
    return pages.where(F.coalesce("html", F.lit("")) != "").select("store", "page_order", F.col("final_url").alias("source_url"), F.inline(hits))


def scores(evidence: DataFrame) -> DataFrame:
    """store, score, evidence: from a row for each page and signal."""
    once = first_evidence(evidence, "store", "signal", "page_order")
    return once.groupBy("store").agg(F.sum("weight").cast("int").alias("score"), F.array_sort(F.collect_list(F.struct("page_order", "signal", "weight", "source_url", "value"))).alias("evidence"))


def confidence(score: Column, threshold: int, floor: int = 7, above: int = 3) -> Column:
    """HIGH from max(floor, threshold + above), MEDIUM from the threshold, else LOW."""
    return F.when(score >= max(floor, threshold + above), "HIGH").when(score >= threshold, "MEDIUM").otherwise("LOW")


def verified(pages: DataFrame, signals: Sequence[vocab.Signal] = vocab.PLATFORM_SIGNALS, threshold: int = 4) -> DataFrame:
    """store, score, passed, confidence, evidence, for every store of pages."""
    out = pages.select("store").distinct().join(scores(page_evidence(pages, signals)), "store", "left")
    score = F.coalesce("score", F.lit(0))
    return out.select("store", score.alias("score"), (score >= threshold).alias("passed"), confidence(score, threshold).alias("confidence"), "evidence")


def prefilter(pages: DataFrame, signals: Sequence[vocab.Signal] = vocab.PLATFORM_SIGNALS, threshold: int = 2) -> DataFrame:
    """The same over homepages only."""
    return verified(pages.where("page_order = 0"), signals, threshold).withColumnRenamed("passed", "plausible")


def with_product_json(verdicts: DataFrame, has_json: Column, threshold: int = 4) -> DataFrame:
    """Adds the active products check of a caller, once."""
    name, weight = vocab.PRODUCT_JSON_SIGNAL
    new = has_json & ~F.coalesce(F.exists("evidence", lambda e: e["signal"] == name), F.lit(False))
    score = F.col("score") + F.when(new, weight).otherwise(0)
    return verdicts.withColumns({"score": score, "passed": score >= threshold, "confidence": confidence(score, threshold)})


def country_page(text: Column, address: Column, final_url: Column) -> Column:
    """struct of a page's country findings.  text: visible text; address: text of structured addresses."""
    p = X.pattern
    addressed = lambda around: around.rlike(p(vocab.ADDRESS_WORD))
    placed = lambda around: addressed(around) & X.location(around)["state"].isNotNull()
    pins = X.matches_in_context(text, "(?U)" + vocab.PIN)
    pin = let(pins, lambda m: F.coalesce(F.get(F.filter(m, lambda x: placed(x["around"])), F.lit(0)), F.get(m, F.lit(0))))
    near = F.get(X.matches_in_context(text, p(vocab.ADDRESS_WORD)), F.lit(0))["around"]
    country = F.get(F.filter(X.matches_in_context(text, p(vocab.COUNTRY_WORD)), lambda m: addressed(m["around"])), F.lit(0))["value"]
    host = F.lower(F.regexp_extract(final_url, r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#:]*)", 1))
    found = lambda pat: F.nullif(F.regexp_extract(text, p(pat), 0), F.lit(""))

    def judged(pin: Column, contextual: Column, supporting: Column, pin_placed: Column) -> Column:
        values = {
            "gstin": F.upper(found(vocab.GSTIN)), "india_phone": found(vocab.PHONE), "explicit_india_address": country, "india_pincode": pin_placed,
            "india_state_or_city": F.coalesce(supporting["city"], supporting["state"]), "inr_pricing": found(vocab.PRICE),
            "india_shipping": F.substring(found(vocab.SHIPPING), 1, 150), "dot_in_domain": F.when(host.endswith(".in"), host),
            "clear_indian_physical_address": F.when(pin_placed.isNotNull(), F.concat_ws(" ", F.coalesce(contextual["city"], contextual["state"]), pin_placed)),
        }
        hit = lambda k: F.struct(F.lit(k).alias("signal"), F.lit(vocab.COUNTRY_WEIGHTS[k]).alias("weight"), values[k].alias("value"))
        hits = F.filter(F.array(*map(hit, values)), lambda h: h["value"].isNotNull())
        return F.struct(hits.alias("hits"), contextual["state"].alias("state"), contextual["city"].alias("city"), F.array_distinct(X.matches(text, "(?U)" + vocab.PIN)).alias("pins"))

    def with_places(pin: Column) -> Column:
        structured = X.location(address)
        contextual = let(structured, lambda s: F.when(s["state"].isNotNull(), s).otherwise(X.location(F.coalesce(pin["around"], near, F.lit("")))))
        pin_placed = F.when(F.coalesce(placed(pin["around"]), F.lit(False)), pin["value"])
        return let(contextual, lambda c: let(F.when(c["state"].isNotNull(), c).otherwise(X.location(text)), lambda s: let(pin_placed, lambda q: judged(pin, c, s, q))))

    return let(pin, with_places)


def country_verified(pages: DataFrame, threshold: int = 4) -> DataFrame:
    """pages: store, page_order, final_url, text, address -> store, score, passed, confidence, evidence, detected_state,
    detected_city, detected_pincodes.  State and city are each the first that any page gives."""
    seen = pages.where(F.col("text").isNotNull()).select("store", "page_order", "final_url", country_page(F.col("text"), F.coalesce("address", F.lit("")), F.col("final_url")).alias("c"))
    evidence = seen.select("store", "page_order", F.col("final_url").alias("source_url"), F.inline("c.hits"))
    first = lambda c: F.min_by(c, F.when(F.col(c).isNotNull(), F.col("page_order")))
    where = seen.select("store", "page_order", "c.state", "c.city", "c.pins").groupBy("store").agg(first("state").alias("detected_state"), first("city").alias("detected_city"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("pins")))).alias("detected_pincodes"))
    out = pages.select("store").distinct().join(scores(evidence), "store", "left").join(where, "store", "left")
    score = F.coalesce("score", F.lit(0))
    return out.select("store", score.alias("score"), (score >= threshold).alias("passed"), confidence(score, threshold, 8, 4).alias("confidence"), "evidence", "detected_state", "detected_city", "detected_pincodes")
