"""The report: funnel, cohorts with rates, retries, completeness and distributions, as small frames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lanternflow.functions import text as X
from lanternflow.operators import cohorts
from lanternflow.sources.writers import record_gaps


def provenance_rows(provenance: DataFrame, candidates: DataFrame) -> DataFrame:
    """Provenance with its candidate's id and status; the location, or the query where there is none; a family's label."""
    rows = provenance.join(candidates.select("domain", F.col("domain").alias("id"), "status"), "domain")
    place = F.when(F.coalesce("location", F.lit("")) != "", F.col("location")).otherwise(F.coalesce(X.quoted_family(F.col("discovery_query"), F.col("signal")), "discovery_query"))
    return rows.withColumn("family", place)


def report(candidates: DataFrame, provenance: DataFrame, runs: DataFrame, records: DataFrame) -> dict[str, DataFrame]:
    rows = provenance_rows(provenance, candidates)
    rated = lambda *dims: cohorts.with_rates(cohorts.cohort_stats(rows, dims)).orderBy(F.desc("candidates"), *dims)
    return {
        "funnel": cohorts.funnel(candidates),
        "statuses": cohorts.status_counts(candidates),
        "sources": rated("source"),
        "queries": rated("discovery_query"),
        "families": rated("source", "signal", "family"),
        "locations": rated("location"),
        "category_hints": rated("category_hint"),
        "retry_reasons": cohorts.counts(candidates, "retry_reason", drop_empty=True).orderBy(F.desc("n"), "retry_reason"),
        "runs": cohorts.run_metrics(cohorts.latest_runs(runs)),
        "missing_fields": cohorts.completeness(records, record_gaps()),
        "states": cohorts.distribution(records, "state"),
        "categories": cohorts.distribution(records, "category", "Other"),
        "confidences": cohorts.distribution(records, "shopify_confidence"),
    }
