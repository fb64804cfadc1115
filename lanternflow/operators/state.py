"""Candidate state as snapshots: merges, moves between states, retries, caches, runs.

Parquet has no row-level writes, so a merge is a join of the old snapshot with the batch,
reduced to a row for each domain first; the new snapshot is written beside the old one.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lanternflow import vocab

CANDIDATE = (
    "domain string, original_url string, status string, priority_score int, discovery_count long, attempt_count int, signals array<string>,"
    " notes string, last_error string, retry_reason string, created_at timestamp, updated_at timestamp"
)
PROVENANCE = "domain string, source string, discovery_query string, location string, source_url string, signal string, category_hint string, observed_at timestamp"
PAGE = "requested_url string, final_url string, status_code int, html string, headers map<string,string>, redirect_history array<string>, error string, fetched_at timestamp"
RUN = "id long, wave string, started_at timestamp, finished_at timestamp, processed long, accepted long, rejected_platform long, rejected_country long, failed long, total_seconds double"
STORE = "domain string, record string"
SCHEMAS = {"candidates": CANDIDATE, "provenance": PROVENANCE, "pages": PAGE, "runs": RUN, "stores": STORE}


def initialize(spark: SparkSession) -> dict[str, DataFrame]:
    """Empty tables."""
    return {name: spark.createDataFrame([], schema) for name, schema in SCHEMAS.items()}


def evolved(old: DataFrame, schema: str) -> DataFrame:
    """An older snapshot with the columns it lacks, as nulls."""
    return old.sparkSession.createDataFrame([], schema).unionByName(old, allowMissingColumns=True)


def merge_candidates(current: DataFrame, batch: DataFrame, now: Column | None = None) -> DataFrame:
    """current: CANDIDATE.  batch: domain, original_url, discovery_count, signals, notes, seq.

    On a match the url is the newest, counts add up (each observation at least one), signals unite, notes stay where the
    batch has none; status, priority and creation time are kept.  Others are inserted as NEW."""
    now = F.current_timestamp() if now is None else now
    new = batch.groupBy("domain").agg(
        F.max_by("original_url", "seq").alias("b_url"),
        F.sum(F.greatest(F.lit(1), F.coalesce("discovery_count", F.lit(1)))).cast("long").alias("b_count"),
        F.array_distinct(F.flatten(F.collect_set("signals"))).alias("b_signals"),
        F.max_by("notes", F.when(F.col("notes").isNotNull(), F.col("seq"))).alias("b_notes"),
    )
    empty = F.array().cast("array<string>")
    out = current.join(new, "domain", "full_outer")
    hit = F.col("b_count").isNotNull()
    return out.select(
        "domain",
        F.coalesce("b_url", "original_url").alias("original_url"),
        F.coalesce("status", F.lit("NEW")).alias("status"),
        F.coalesce("priority_score", F.lit(0)).alias("priority_score"),
        (F.coalesce("discovery_count", F.lit(0)) + F.coalesce("b_count", F.lit(0))).alias("discovery_count"),
        F.coalesce("attempt_count", F.lit(0)).alias("attempt_count"),
        F.array_sort(F.array_union(F.coalesce("signals", empty), F.coalesce("b_signals", empty))).alias("signals"),
        F.coalesce("b_notes", "notes").alias("notes"),
        "last_error",
        "retry_reason",
        F.coalesce("created_at", now).alias("created_at"),
        F.when(hit, now).otherwise(F.col("updated_at")).alias("updated_at"),
    )


def merge_outcome(current: DataFrame, batch: DataFrame) -> DataFrame:
    """created and updated: distinct domains of the batch, new and known."""
    keys = batch.select("domain").distinct()
    known = current.select("domain", F.lit(1).alias("known"))
    return keys.join(known, "domain", "left").agg(F.count(F.when(F.col("known").isNull(), 1)).alias("created"), F.count("known").alias("updated"))


def save_latest(current: DataFrame, new: DataFrame, key: str, seq: str) -> DataFrame:
    """Last write wins by key; rows of current count as older."""
    both = current.withColumn(seq, F.lit(None).cast(new.schema[seq].dataType)).unionByName(new, allowMissingColumns=True)
    row = F.struct(*[F.col(c) for c in current.columns])
    return both.groupBy(key).agg(F.max_by(row, F.struct(F.col(seq).isNotNull(), F.col(seq))).alias("r")).select("r.*")


def edges(spark: SparkSession) -> DataFrame:
    """The 22 moves allowed between states."""
    pairs = F.array(*[F.struct(F.lit(a).alias("old"), F.lit(b).alias("new")) for a, bs in vocab.TRANSITIONS.items() for b in bs])
    return spark.range(1).select(F.inline(pairs))


def is_allowed(old: Column, new: Column) -> Column:
    """Same state, or a known move."""
    table = F.create_map(*[x for a, bs in vocab.TRANSITIONS.items() for x in (F.lit(a), F.array(*map(F.lit, bs)))])
    return old.eqNullSafe(new) | F.coalesce(F.array_contains(table[old], new), F.lit(False))


def transition(current: DataFrame, events: DataFrame, now: Column | None = None, force: bool = False) -> tuple[DataFrame, DataFrame]:
    """events: domain, new_status, error, reason, counts_attempt; one for each domain.  Returns the new snapshot, and
    the events that were refused with why: unknown domain, or illegal move.  Error and reason are overwritten, by
    nothing too."""
    now = F.current_timestamp() if now is None else now
    told = current.select("domain", "status").join(events, "domain", "right")
    legal = F.lit(True) if force else is_allowed(F.col("status"), F.col("new_status"))
    refused = told.where(F.col("status").isNull() | ~legal).withColumn("why", F.when(F.col("status").isNull(), "unknown domain").otherwise("illegal move"))
    good = told.where(F.col("status").isNotNull() & legal).drop("status")
    hit = F.col("new_status").isNotNull()
    out = current.join(good, "domain", "left").withColumns({
        "status": F.coalesce("new_status", "status"),
        "last_error": F.when(hit, F.col("error")).otherwise(F.col("last_error")),
        "retry_reason": F.when(hit, F.col("reason")).otherwise(F.col("retry_reason")),
        "attempt_count": F.col("attempt_count") + F.when(hit & F.col("counts_attempt"), 1).otherwise(0),
        "updated_at": F.when(hit, now).otherwise(F.col("updated_at")),
    })
    return out.select(*current.columns), refused


def recover_stale(current: DataFrame, cutoff: Column) -> DataFrame:
    """Rows that have been PROCESSING since before the cutoff go to RETRY."""
    stale = (F.col("status") == "PROCESSING") & (F.col("updated_at") < cutoff)
    text = F.lit("stale processing state recovered")
    return current.withColumns({
        "last_error": F.when(stale, text).otherwise(F.col("last_error")),
        "retry_reason": F.when(stale, "STALE_PROCESSING").otherwise(F.col("retry_reason")),
        "status": F.when(stale, "RETRY").otherwise(F.col("status")),
    })


def batch_status(attempts: Column, most: int) -> Column:
    """FAILED once the budget is used up, else PROCESSING."""
    return F.when(attempts >= most, "FAILED").otherwise("PROCESSING")


def failure_status(attempts: Column, most: int) -> Column:
    """After one more failure."""
    return F.when(attempts + 1 >= most, "FAILED").otherwise("RETRY")


def outcome_status(error: Column, plausible: Column, accepted: Column, platform_ok: Column, country_ok: Column, attempts: Column, most: int) -> Column:
    """Error, then prefilter, then acceptance, then the gate that rejected, platform before country."""
    return (
        F.when(error.isNotNull(), failure_status(attempts, most))
        .when(~F.coalesce(plausible, F.lit(False)), "REJECTED_SHOPIFY")
        .when(F.coalesce(accepted, F.lit(False)), "ACCEPTED")
        .when(~F.coalesce(platform_ok, F.lit(True)), "REJECTED_SHOPIFY")
        .when(~F.coalesce(country_ok, F.lit(True)), "REJECTED_INDIA")
        .otherwise(failure_status(attempts, most))
    )


def pick(current: DataFrame, statuses: Sequence[str], limit: int) -> DataFrame:
    """The next candidates: highest priority, then oldest, then by domain."""
    return current.where(F.col("status").isin(*statuses)).orderBy(F.desc("priority_score"), "created_at", "domain").limit(limit)


def fresh(cache: DataFrame, now: Column, ttl_hours: float, at: str = "fetched_at") -> DataFrame:
    return cache.where(F.col(at) >= now - F.make_dt_interval(secs=F.lit(ttl_hours * 3600.0)))


def names_a_place(query: Column, places: Sequence[str] = (*vocab.STATES, *vocab.CITY_STATE)) -> Column:
    """Whether a search query names a state or a city."""
    q = F.lower(F.coalesce(query, F.lit("")))
    named = F.lit(False)
    for p in places:
        named = named | q.contains(p.lower())
    return named


def priority(signals: Column, sources: Column, queries: Column, domain: Column, count: Column, named: Column | None = None) -> Column:
    """0 to 9.  signals and sources are arrays, queries one text; named says of queries seen one by one whether any names a place."""
    strong = F.arrays_overlap(F.transform(signals, lambda s: F.lower(s)), F.array(*map(F.lit, vocab.STRONG_DISCOVERY)))
    named = names_a_place(queries) if named is None else named
    points = lambda c, n: F.when(F.coalesce(c, F.lit(False)), n).otherwise(0)
    return points(strong, 3) + points(F.size(F.array_distinct(sources)) >= 2, 2) + points(named, 2) + points(F.regexp_extract(domain, "^https?://([^/:]*)", 1).endswith(".in"), 1) + points(count > 1, 1)


def first_provenance(candidates: DataFrame, provenance: DataFrame, order: Sequence[str] = ("observed_at", "source", "discovery_query", "source_url")) -> DataFrame:
    """Candidates with source, query and url of their first observation, and the number of all; ``unknown`` and 0 if there is none."""
    first = F.min_by(F.struct("source", "discovery_query", "source_url"), F.struct(*order)).alias("f")
    out = candidates.join(provenance.groupBy("domain").agg(first, F.count(F.lit(1)).alias("n")), "domain", "left")
    return out.select(*candidates.columns, F.coalesce("f.source", F.lit("unknown")).alias("discovery_source"), "f.discovery_query", F.col("f.source_url").alias("discovery_source_url"), F.coalesce("n", F.lit(0)).alias("observations"))


def candidate(current: DataFrame, domain: str) -> DataFrame:
    """The row of one domain."""
    return current.where(F.col("domain") == domain)


def create_run(runs: DataFrame, wave: str, now: Column | None = None) -> DataFrame:
    """runs with one more, under the next id."""
    now = F.current_timestamp() if now is None else now
    new = runs.agg((F.coalesce(F.max("id"), F.lit(0)) + 1).alias("id")).select("id", F.lit(wave).alias("wave"), now.alias("started_at"))
    return runs.unionByName(new, allowMissingColumns=True)


def finish_run(runs: DataFrame, run_id: int, counts: dict[str, int], now: Column | None = None) -> DataFrame:
    """runs with the end, the duration and the counts of one of them."""
    now, mine = F.current_timestamp() if now is None else now, F.col("id") == run_id
    ended = {"finished_at": now, "total_seconds": F.unix_micros(now) / 1e6 - F.unix_micros("started_at") / 1e6, **{c: F.lit(n).cast("long") for c, n in counts.items()}}
    return runs.withColumns({c: F.when(mine, v).otherwise(F.col(c)) for c, v in ended.items()})


def with_provenance(candidates: DataFrame, provenance: DataFrame) -> DataFrame:
    """Candidates with their provenance, oldest first, and the first one's source, query and url; ``unknown`` if none."""
    rows = provenance.groupBy("domain").agg(F.array_sort(F.collect_list(F.struct("observed_at", "source", "discovery_query", "source_url", "signal", "location", "category_hint"))).alias("provenance"))
    out = candidates.join(rows, "domain", "left")
    first = F.get("provenance", F.lit(0))
    return out.withColumns({"provenance": F.coalesce("provenance", F.expr("cast(array() as array<struct<observed_at:timestamp,source:string,discovery_query:string,source_url:string,signal:string,location:string,category_hint:string>>)")), "discovery_source": F.coalesce(first["source"], F.lit("unknown")), "discovery_query": first["discovery_query"], "discovery_source_url": first["source_url"]})
