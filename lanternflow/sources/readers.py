"""Candidate sources.  Each returns rows of CANDIDATE_ROW in an explicit order (seq).

CSV files are read by group of equal headers: with one schema over different column orders
values would change places silently.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lanternflow import vocab
from lanternflow.functions import text as X
from lanternflow.functions import urls as U
from lanternflow.operators.dedupe import keep_first

CANDIDATE_ROW = "original_url string, domain string, signal string, source string, query string, location string, category_hint string, seq string"
#: Name of a provider's function by the name it is asked for.
CSV_OPTIONS = {"header": "true", "escape": '"', "multiLine": "true", "enforceSchema": "false"}


def csv_files(spark: SparkSession, path: str) -> list[str]:
    """The file, or the *.csv files of a folder, by name, through the store's own listing."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    store = hadoop.getFileSystem(spark._jsc.hadoopConfiguration())
    if store.getFileStatus(hadoop).isFile():
        return [path]
    return sorted(str(f.getPath()) for f in store.listStatus(hadoop) if f.isFile() and f.getPath().getName().endswith(".csv"))


def read_csv(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """Union of files by column name; names are trimmed and in lower case; all values are text; __file and __row keep order."""
    groups: dict[tuple[str, ...], list[str]] = {}
    for p in paths:
        head = spark.read.options(**CSV_OPTIONS).csv(p).columns
        groups.setdefault(tuple(head), []).append(p)
    frames = []
    for head, files in groups.items():
        df = spark.read.options(**CSV_OPTIONS).schema(", ".join(f"`{c}` string" for c in head)).csv(files)
        df = df.select("*", F.col("_metadata.file_name").alias("__file"), F.format_string("%s|%020d", F.col("_metadata.file_name"), F.monotonically_increasing_id()).alias("__row"))
        frames.append(df.toDF(*[re.sub("^﻿", "", c).strip().lower() for c in head], "__file", "__row"))
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def _first(df: DataFrame, names: Sequence[str]) -> Column:
    there = [F.nullif(F.trim(F.col(n)), F.lit("")) for n in names if n in df.columns]
    return F.coalesce(*there, F.lit(None).cast("string"))


def flexible(df: DataFrame, source: str | None = None, prefix: str = "csv:", limit: int | None = None) -> DataFrame:
    """Rows with a valid domain.  The url is the first column with a value, in the order of URL_COLUMNS.  A limit counts
    valid rows, before any dedupe."""
    url = _first(df, vocab.URL_COLUMNS)
    default = F.lit(source) if source else F.concat(F.lit(prefix), F.col("__file"))
    out = df.select(
        url.alias("original_url"), U.normalize_domain(url).alias("domain"), _first(df, ["signal"]).alias("signal"), F.coalesce(_first(df, ["source"]), default).alias("source"),
        _first(df, ["query"]).alias("query"), _first(df, ["location"]).alias("location"), _first(df, ["category_hint"]).alias("category_hint"), F.col("__row").alias("seq"),
    ).where("domain is not null")
    return out.orderBy("seq").limit(limit) if limit is not None else out


def read_counts(df: DataFrame) -> DataFrame:
    """rows_read, with_url and invalid of a source."""
    url = _first(df, vocab.URL_COLUMNS)
    return df.agg(F.count(F.lit(1)).alias("rows_read"), F.count(url).alias("raw"), F.count(F.when(url.isNotNull() & U.normalize_domain(url).isNull(), 1)).alias("invalid"))


def seeds(spark: SparkSession, path: str, limit: int | None = None) -> DataFrame:
    """The seed list: needs domain_url; first of each registered domain, then the limit."""
    df = read_csv(spark, [path])
    if "domain_url" not in df.columns:
        raise ValueError(f"{path} has no column domain_url")
    rows = df.select(F.col("domain_url").alias("original_url"), U.normalize_domain(F.col("domain_url")).alias("domain"), F.col("__row").alias("seq")).where("domain is not null")
    first = keep_first(rows.withColumn("key", U.registered_domain(F.col("domain"))), "key", "seq").drop("key").orderBy("seq")
    return first.limit(limit) if limit is not None else first


def csv_source(spark: SparkSession, path: str, limit: int | None = None) -> DataFrame:
    return flexible(read_csv(spark, [path]), limit=limit)


def directory_source(spark: SparkSession, path: str, limit: int | None = None) -> DataFrame:
    """Every *.csv of a folder, not below it, by name; one limit for all."""
    files = csv_files(spark, path)
    return flexible(read_csv(spark, files), prefix="directory:", limit=limit) if files else spark.createDataFrame([], CANDIDATE_ROW)


def search_results(spark: SparkSession, path: str, limit: int | None = None) -> DataFrame:
    """query, result_url: the signal is inferred from the query."""
    df = read_csv(spark, [path])
    if not {"query", "result_url"} <= set(df.columns):
        raise ValueError(f"{path} needs the columns query and result_url")
    df = df.withColumn("signal", X.inferred_signal(F.col("query"))).drop("source")
    return flexible(df.drop(*[c for c in vocab.URL_COLUMNS if c in df.columns and c != "result_url"]), source="search-csv", limit=limit)


def crawl_index_import(spark: SparkSession, path: str, limit: int | None = None) -> DataFrame:
    return flexible(read_csv(spark, [path]), source="commoncrawl-import", limit=limit)


def crawl_index(spark: SparkSession, path: str, limit: int | None = 1000) -> DataFrame:
    """A landed dump of a crawl index, a JSON object a line; bad lines are skipped."""
    df = spark.read.schema("url string, status string, mime string, timestamp string, _corrupt_record string").option("mode", "PERMISSIVE").json(path)
    rows = df.where("url is not null").select(F.col("url"), F.lit(None).cast("string").alias("signal"), F.lit("crawl-index").alias("__file"), F.format_string("%020d", F.monotonically_increasing_id()).alias("__row"))
    return flexible(rows, source="commoncrawl-index", limit=limit)


def many(providers: Sequence[tuple[str, DataFrame]], limit: int | None = None) -> DataFrame:
    """Providers in order, as one; the limit counts valid rows, repeated ones too."""
    frames = [df.withColumns({"provider": F.lit(name), "provider_seq": F.lit(k)}) for k, (name, df) in enumerate(providers)]
    out = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
    return out.orderBy("provider_seq", "seq").limit(limit) if limit is not None else out


def records(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """Stored records, by domain."""
    df = spark.read.parquet(path)
    if schema:
        df = df.select("domain", F.from_json("record", schema).alias("r")).select("domain", "r.*")
    return df.orderBy("domain")


def page_rows(pages: DataFrame, most_bytes: int = 5_000_000) -> DataFrame:
    """Fetched pages as data: what can't be used becomes an error and an empty body, never a lost row."""
    kind = F.lower(F.coalesce(F.element_at("headers", "content-type"), F.lit("text/html"))) if "headers" in pages.columns else F.lit("text/html")
    status = F.col("status_code") if "status_code" in pages.columns else F.lit(200)
    error = (
        F.when(status == 429, "HTTP 429")
        .when(status >= 400, F.concat(F.lit("HTTP "), status.cast("string")))
        .when(~kind.contains("html") & ~kind.contains("xml") & ~kind.contains("text/plain"), F.concat(F.lit("unsupported content type: "), kind))
        .when(F.octet_length("html") > most_bytes, "response too large")
    )
    return pages.withColumn("error", F.coalesce(F.col("error") if "error" in pages.columns else F.lit(None).cast("string"), error)).withColumn("html", F.when(F.col("error").isNull(), F.col("html")).otherwise(""))


def robots_allowed(pages: DataFrame, rules: DataFrame) -> DataFrame:
    """pages (host, path) without those a rule (host, prefix) disallows; hosts without rules allow all."""
    rules = rules.where(F.coalesce("prefix", F.lit("")) != "").select("host", "prefix").distinct()
    # a path meets the rules that are one of its own prefixes, of the lengths that its host's rules have: an equi-join
    lengths = rules.groupBy("host").agg(F.collect_set(F.length("prefix")).alias("lengths"))
    starts = pages.select("host", "path").distinct().join(lengths, "host").select("host", "path", F.explode(F.filter("lengths", lambda n: n <= F.length("path"))).alias("n"))
    bad = starts.select("host", "path", F.substr("path", F.lit(1), F.col("n")).alias("prefix")).join(rules, ["host", "prefix"], "left_semi").select("host", "path").distinct()
    return pages.join(bad, ["host", "path"], "left_anti")


def sitemap(pages: DataFrame, limit: int = 10) -> DataFrame:
    """store, xml -> store, url: shop pages of the same registered domain, in order."""
    from lanternflow.functions.markup import sitemap_urls

    rows = pages.select("store", F.posexplode(sitemap_urls(F.col("xml"))).alias("pos", "url"))
    path = F.lower(U.path_of(F.col("url")))
    good = rows.where(U.same_registered_domain(U.normalize_domain(F.col("url")), U.normalize_domain(F.col("store"))) & (path.contains("/products") | path.contains("/collections") | path.contains("/pages")))
    return good.groupBy("store").agg(F.slice(F.array_sort(F.collect_list(F.struct("pos", "url"))), 1, limit).alias("u")).select("store", F.explode("u.url").alias("url"))
