"""Sinks: exports in CSV and JSON, reports, worksheets, page caches.

Files are written by the engine's writers under a folder name and keep their partitions;
``single`` gathers the finished rows in one part, and never what computes them.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lanternflow import vocab
from lanternflow.functions import text as X
from lanternflow.operators import cohorts
from lanternflow.operators.dedupe import keep_best

CSV = {"header": "true", "escape": '"', "emptyValue": ""}
PUBLIC = ("domain_url", "contacts", "socials", "category", "tagline_or_description", "logo_url", "state")


def csv(df: DataFrame, path: str, single: bool = False) -> None:
    (df.repartition(1) if single else df).write.mode("overwrite").options(**CSV).csv(path)


def public(records: DataFrame) -> DataFrame:
    """Records without debug fields: contacts as struct(emails, phones)."""
    return records.select("domain_url", F.struct("emails", "phones").alias("contacts"), *PUBLIC[2:], *[c for c in ("shopify_score", "india_score", "shopify_confidence", "india_confidence") if c in records.columns])


def export(records: DataFrame, folder: str, key: str = "domain_url", seq: str = "seq") -> DataFrame:
    """The best record of each domain as public JSON, CSV, debug JSON and completeness report; returns what was exported."""
    best = keep_best(records, key, F.coalesce("shopify_score", F.lit(0)) + F.coalesce("india_score", F.lit(0)), seq)
    told = public(best)
    told.write.mode("overwrite").option("ignoreNullFields", "false").json(f"{folder}/public_json")
    nested = lambda c: F.to_json(c, {"ignoreNullFields": "false"}).alias(c)
    csv(told.select(*[nested(c) if c in ("contacts", "socials") else c for c in told.columns]), f"{folder}/csv")
    best.write.mode("overwrite").option("ignoreNullFields", "false").json(f"{folder}/debug_json")
    report = cohorts.completeness(best, record_gaps())
    csv(report, f"{folder}/completeness")
    return told


def record_gaps() -> dict[str, Column]:
    """Missing fields of a record; the category Other is a category."""
    return {
        "contacts": (F.size("emails") <= 0) & (F.size("phones") <= 0),
        "socials": ~X.any_of([~X.missing(F.col(f"socials.{p}")) for p in vocab.PLATFORMS]),
        "category": X.missing(F.col("category")),
        "description": X.missing(F.col("tagline_or_description")),
        "logo": X.missing(F.col("logo_url")),
        "state": X.missing(F.col("state")),
        "domain": X.missing(F.col("domain_url")),
    }


def missing_report(records: DataFrame, path: str) -> DataFrame:
    """CSV of the incomplete records, each with its missing fields; returns per cent missing of each field."""
    gaps = record_gaps()
    listed = records.withColumn("missing", cohorts.missing_fields(gaps)).where(F.size("missing") > 0)
    csv(listed.select(F.col("domain_url").alias("domain"), F.concat_ws(",", "missing").alias("missing_fields"), "shopify_score", "india_score"), path)
    return cohorts.completeness(records, gaps)


def completeness_markdown(rows: Sequence, total: int) -> str:
    head = ["# Missing fields", "", f"Records: {total}", "", "| Field | Missing | Percent |", "|---|---:|---:|"]
    return "\n".join(head + [f"| {r['field']} | {r['missing']} | {r['percent']:.1f}% |" for r in rows])


def report_json(parts: dict[str, DataFrame]) -> str:
    """Small frames of a report as one JSON text."""
    return json.dumps({k: [r.asDict(True) for r in df.collect()] for k, df in parts.items()}, default=str, ensure_ascii=False)


def cache_pages(current: DataFrame, fetched: DataFrame) -> DataFrame:
    """The page cache after a fetch: newest page of each url."""
    row = F.struct(*[F.col(c) for c in current.columns])
    return current.unionByName(fetched, allowMissingColumns=True).groupBy("requested_url").agg(F.max_by(row, "fetched_at").alias("r")).select("r.*")
