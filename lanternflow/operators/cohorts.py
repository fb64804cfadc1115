"""Funnels, cohort yields, rates, completeness and run metrics.

Counts of distinct candidates by status come from one distinct of (dimension, id, status),
then plain conditional counts: no expansion of rows for each counted status.
Rounding is the engine's half-up.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lanternflow import vocab

COUNTED = {"accepted": ("ACCEPTED",), "rejected_platform": ("REJECTED_SHOPIFY",), "rejected_country": ("REJECTED_INDIA",), "failed": ("FAILED",)}


def counts(df: DataFrame, by: str, name: str = "n", drop_empty: bool = False) -> DataFrame:
    """Rows of each value; without empty ones if asked."""
    rows = df.where(F.coalesce(F.col(by).cast("string"), F.lit("")) != "") if drop_empty else df
    return rows.groupBy(by).agg(F.count(F.lit(1)).alias(name))


def status_counts(df: DataFrame, status: str = "status", all_statuses: Sequence[str] = vocab.STATUSES) -> DataFrame:
    """Every status has a row; absent ones 0."""
    every = df.sparkSession.range(1).select(F.explode(F.array(*map(F.lit, all_statuses))).alias(status))
    return every.join(counts(df, status), status, "left").select(status, F.coalesce("n", F.lit(0)).alias("n"))


def cohort_stats(rows: DataFrame, dims: Sequence[str], candidate: str = "id", status: str = "status", counted: dict[str, tuple[str, ...]] = COUNTED) -> DataFrame:
    """Distinct candidates of each cohort, and how many of them have each status.  Empty dimensions are left out."""
    for d in dims:
        rows = rows.where(F.coalesce(F.col(d), F.lit("")) != "")
    once = rows.select(*dims, candidate, status).distinct()
    return once.groupBy(*dims).agg(F.count(F.lit(1)).alias("candidates"), *[F.count(F.when(F.col(status).isin(*s), 1)).alias(n) for n, s in counted.items()])


def rate(part: Column, whole: Column) -> Column:
    """Per cent, one decimal; 0 where there is nothing."""
    return F.coalesce(F.round(F.try_divide(F.lit(100.0) * part, whole), 1), F.lit(0.0))


def with_rates(stats: DataFrame, counted: Sequence[str] = tuple(COUNTED)) -> DataFrame:
    """Rates, a label of the sample's size, and whether many candidates came with a high yield (on the rounded rate)."""
    n = F.col("candidates")
    out = stats.withColumns({f"{c}_rate": rate(F.col(c), n) for c in counted})
    return out.withColumns({
        "sample": F.when(n >= 30, "high_volume").when(n >= 10, "meaningful").otherwise("tiny"),
        "high_volume_high_yield": (n >= 30) & (F.col(f"{counted[0]}_rate") >= 75.0),
    })


def funnel(candidates: DataFrame) -> DataFrame:
    """One row: observations, candidates, statuses, duplicate reduction."""
    s = F.col("status")
    return candidates.agg(
        F.count(F.lit(1)).alias("candidates"),
        F.coalesce(F.sum("discovery_count"), F.lit(0)).cast("long").alias("observations"),
        *[F.count(F.when(s.isin(*v), 1)).alias(k) for k, v in COUNTED.items()],
        (F.coalesce(F.sum("discovery_count"), F.lit(0)) - F.count(F.lit(1))).cast("long").alias("duplicate_reduction"),
    )


def missing_fields(record: dict[str, Column]) -> Column:
    """Labels of fields that are missing, in the order given.  A field is missing if its condition holds."""
    return F.array_compact(F.array(*[F.when(c, F.lit(k)) for k, c in record.items()]))


def completeness(df: DataFrame, fields: dict[str, Column]) -> DataFrame:
    """field, missing, percent: a row for each field."""
    one = df.agg(F.count(F.lit(1)).alias("total"), *[F.count(F.when(c, 1)).alias(k) for k, c in fields.items()])
    rows = F.array(*[F.struct(F.lit(k).alias("field"), F.col(k).alias("missing"), rate(F.col(k), F.col("total")).alias("percent")) for k in fields])
    return one.select(F.inline(rows))


def distribution(df: DataFrame, by: str, unknown: str = "Unknown") -> DataFrame:
    value = F.coalesce(F.nullif(F.col(by).cast("string"), F.lit("")), F.lit(unknown))
    return df.groupBy(value.alias(by)).agg(F.count(F.lit(1)).alias("n"))


def run_metrics(runs: DataFrame) -> DataFrame:
    """Per-minute rates and acceptance of runs; null where a run has nothing to divide by."""
    minutes = F.col("total_seconds") / 60.0
    return runs.withColumns({
        "processed_per_minute": F.round(F.try_divide(F.col("processed").cast("double"), minutes), 2),
        "accepted_per_minute": F.round(F.try_divide(F.col("accepted").cast("double"), minutes), 2),
        "acceptance_percent": F.round(F.try_divide(F.lit(100.0) * F.col("accepted"), F.col("processed")), 1),
    })


def latest_runs(runs: DataFrame, limit: int = 10) -> DataFrame:
    return runs.orderBy(F.desc("id")).limit(limit)


def verdict_counts(audits: DataFrame, checks: Sequence[str], verdicts: Sequence[str] = vocab.VERDICTS) -> DataFrame:
    """check and a column for each verdict; 0 where there is none."""
    long = audits.select(F.explode(F.array(*[F.struct(F.lit(c).alias("check"), F.col(c).alias("verdict")) for c in checks])).alias("x")).select("x.*")
    return long.groupBy("check").agg(*[F.count(F.when(F.col("verdict") == v, 1)).alias(v) for v in verdicts])


def precision(ratings: DataFrame, columns: Sequence[str]) -> DataFrame:
    """ratings: columns of 1, 0, -1 (invalid) or null -> metric, correct, evaluated, invalid, percentage (null if none)."""
    long = ratings.select(F.explode(F.array(*[F.struct(F.lit(c).alias("metric"), F.col(c).cast("int").alias("r")) for c in columns])).alias("x")).select("x.*")
    out = long.groupBy("metric").agg(F.count(F.when(F.col("r") == 1, 1)).alias("correct"), F.count(F.when(F.col("r") >= 0, 1)).alias("evaluated"), F.count(F.when(F.col("r") < 0, 1)).alias("invalid"))
    return out.withColumn("percentage", F.round(F.try_divide(F.lit(100.0) * F.col("correct"), F.col("evaluated")), 1))


def render_precision(rows: Sequence) -> str:
    line = lambda r: f"{r['metric']}: " + ("N/A (no completed ratings)" if r["percentage"] is None else f"{r['percentage']:.1f}% ({r['correct']}/{r['evaluated']})")
    return "\n".join(map(line, rows))
