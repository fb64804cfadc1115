"""Top-k and samples with explicit, reproducible orders."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W


def number(c: Column) -> Column:
    """Blank and malformed numbers are 0."""
    return F.coalesce(c.cast("string").try_cast("int"), F.lit(0))


def lowest(df: DataFrame, score: str, key: str, n: int = 2) -> DataFrame:
    return df.orderBy(number(F.col(score)), key).limit(n)


def shuffled(key: Column, seed: int) -> Column:
    """A reproducible random order."""
    return F.xxhash64(F.lit(seed), key)


def stratified(df: DataFrame, by: str, key: str, sizes: dict[str, int], seed: int = 1, order: Column | None = None) -> DataFrame:
    """Up to sizes[value] rows of each stratum, in random or given order."""
    strata = df.where(F.col(by).isin(*sizes))
    rank = F.row_number().over(W.partitionBy(by).orderBy(shuffled(F.col(key), seed) if order is None else order, key))
    limit = F.create_map(*[F.lit(x) for kv in sizes.items() for x in kv])[F.col(by)]
    return strata.withColumn("stratum_rank", rank).where(F.col("stratum_rank") <= limit)


def targeted(audits: DataFrame, target: int = 15, seed: int = 3, review_all_limit: int = 30) -> DataFrame:
    """Rows that expose risk first, then random sound ones: domain, selection_reason, in the order chosen.

    audits: domain, seq, shopify_score, india_score, state, tagline_or_description, logo_url, auto_contacts_check,
    auto_socials_check, auto_audit_confidence.  Each rule nominates rows in its order; a domain enters at its first
    nomination while fewer than ``target`` are in, and collects the reasons of all rules that nominate it.  The two
    fills stop once the sample is full, after the row at hand."""
    conf = F.col("auto_audit_confidence")
    doubtful = audits.where(conf.isin("LOW", "MEDIUM")).count()
    label = F.when(F.lit(doubtful <= min(target, review_all_limit)), F.concat(F.lit("all_"), F.lower(conf), F.lit("_confidence"))).otherwise(F.concat(F.lit("sample_"), F.lower(conf), F.lit("_confidence")))
    empty = lambda c: F.coalesce(F.trim(c), F.lit("")) == ""

    def rule(rows: DataFrame, tier: int, place: Column, reason: Column) -> DataFrame:
        return rows.select("domain", F.lit(tier).alias("tier"), place.cast("long").alias("place"), reason.alias("reason"))

    parts = [rule(audits.where(conf == "LOW"), 0, F.col("seq"), label), rule(audits.where(conf == "MEDIUM"), 1, F.col("seq"), label)]
    for tier, (score, reason) in enumerate((("shopify_score", "lowest_shopify_score"), ("india_score", "lowest_india_score")), 2):
        low = lowest(audits, score, "domain").select("*", F.struct(number(F.col(score)), "domain").alias("__o"))
        parts.append(rule(low.withColumn("__p", F.row_number().over(W.orderBy("__o"))), tier, F.col("__p"), F.lit(reason)))
    for tier, (column, reason) in enumerate((("state", "missing_state"), ("tagline_or_description", "missing_description"), ("logo_url", "missing_logo")), 4):
        parts.append(rule(audits.where(empty(F.col(column))).orderBy("seq").limit(1), tier, F.col("seq"), F.lit(reason)))
    unusual = (F.coalesce("auto_contacts_check", F.lit("")) != "PASS") | F.coalesce(F.col("auto_socials_check").isin("FAIL", "UNCERTAIN"), F.lit(False))
    parts.append(rule(audits.where(unusual).orderBy("seq").limit(2), 7, F.col("seq"), F.lit("unusual_contact_or_social")))
    head = parts[0]
    for p in parts[1:]:
        head = head.unionByName(p)
    # at most target domains and two fills: bounded by the sample's size
    risky = [r[0] for r in head.groupBy("domain").agg(F.min(F.struct("tier", "place")).alias("at")).orderBy("at").limit(target).select("domain").collect()]
    chosen, reasons = list(risky), {}
    for r in head.where(F.col("domain").isin(risky)).orderBy("tier", "place").collect() if risky else []:
        reasons.setdefault(r["domain"], [])
        if r["reason"] not in reasons[r["domain"]]:
            reasons[r["domain"]].append(r["reason"])
    fills = ((audits.where(conf == "HIGH").orderBy(shuffled(F.col("domain"), seed), "domain"), "random_high_confidence"), (audits.orderBy("seq"), "random_accepted_fill"))
    for rows, reason in fills:
        for r in rows.select("domain").limit(2 * target).collect():
            if r[0] not in reasons and len(chosen) < target:
                chosen.append(r[0])
                reasons[r[0]] = []
            if r[0] in reasons and reason not in reasons[r[0]]:
                reasons[r[0]].append(reason)
            if len(chosen) >= target:
                break
    rows = [(k, d, ";".join(reasons[d])) for k, d in enumerate(chosen)]
    return audits.sparkSession.createDataFrame(rows, "place int, domain string, selection_reason string").orderBy("place")
