"""URL filters: rules first, then a path-template tree for each host.

A rule (verdict, host, path) fits its host and all subdomains, if the url's path starts
with the rule's; the longest wins.  Urls with a verdict by rule are the labelled examples
of the method, unless labels are given.

Method.  A path is its segments; digits in a segment become ``<n>``, a literal segment that
follows itself counts once.  Level by level, from the host down, as deep as branches have
``LEAST`` urls (below that the rest of a path is one ``**``):

* A segment is variable, and becomes ``*``, if it has fewer than ``LEAST`` urls or fewer than
  the square root of its parent's: values that many others stand beside.  A branch of a few
  per cent of a host's urls stays, and no node has more literal children than that root.
* Literal siblings that are statistically alike are merged, as ``first+``: those that go on in
  the same way (mostly end, mostly go on by a number, or by a word) and whose shares of bad
  labels, in order, are no further from one to the next than a two-proportion test at
  ``DEVIATIONS`` allows.  Siblings without labels are merged with one another.

A template is the path of what is left.  Its purity is the share of bad labels, smoothed
with ``ALPHA`` urls of its host's share, which is smoothed with as many of the share of all;
templates of ``REJECT`` and more are rejected.  So a template without labels is judged by
its host, and a host without labels passes.

All of it is SQL over counts: pages are reduced to (host, shape) before anything else, so
that a host with a third of all pages is a few rows of the tree; only the last join meets
pages again, and its side with the pages can be split.  Each level is written to the
shared folder, which keeps plans small.

Cases: a null url, or one without ``://``, has an empty host and path, no rule, and is
judged like any other host; empty segments are skipped; null page_ids and repeated rows are
kept and count; without labels all pass; an empty table gives an empty result; extra
columns are dropped.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lanternflow.llm._shared import discarded, read_table, staged

Rule = tuple[str, str, str]
RULES: tuple[Rule, ...] = (("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"), ("allow", "com", "/fr/"), ("block", "com", "/de/"))
LEAST, DEVIATIONS, ALPHA, REJECT = 5, 1.96, 2, 0.8
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
PARTS = "://([^/?#]*)([^?#]*)"


def host_of(url: Column) -> Column:
    return F.translate(F.coalesce(F.regexp_extract(url, PARTS, 1), F.lit("")), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, PARTS, 2), F.lit(""))


def by_rules(host: Column, path: Column, rules: Sequence[Rule] = RULES) -> Column:
    """struct(rule, verdict) of the longest rule that fits, else null."""
    out = F.lit(None)
    for verdict, h, p in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        out = F.when(fits, F.struct(F.lit(h + p).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(out)
    return out


def shape(path: Column) -> Column:
    """Segments joined by one slash.  Signs that stand for more in a template are spelt out."""
    plain = F.filter(F.split(F.replace(F.replace(path, F.lit("*"), F.lit("%2A")), F.lit("+"), F.lit("%2B")), "/"), lambda s: s != "")
    segments = F.transform(plain, lambda s: F.regexp_replace(s, "[0-9]+", "<n>"))
    once = F.filter(F.transform(segments, lambda s, i: F.struct(s.alias("s"), F.coalesce((i > 0) & (s == F.get(segments, i - 1)) & ~s.contains("<n>"), F.lit(False)).alias("again"))), lambda x: ~x["again"])
    return F.array_join(F.transform(once, lambda x: x["s"]), "/")


#: The next segment of what is left of a path, and what is left after it.
NEXT, AFTER = "regexp_extract(rest, '^[^/]*', 0)", "regexp_replace(rest, '^[^/]*/?', '')"


def children_sql(table: str) -> str:
    """Counts of each branch: its urls n, labels l, bad ones b, and how its urls go on (ends e, by a number v)."""
    return f"""select host, g, s, sum(n) as n, sum(l) as l, sum(b) as b, sum(case when rest = '' then n else 0 end) as e, sum(case when {NEXT} like '%<n>%' then n else 0 end) as v
    from (select host, g, {NEXT} as s, {AFTER} as rest, n, l, b from {table} where rest <> '') x group by host, g, s"""


def decided_sql(table: str) -> str:
    """What stands for segment s of a branch: name."""
    return f"""select host, g, s, case when fixed <> '' then fixed when count(*) over h = 1 then s else concat(min(s) over h, '+') end as name from (
      select *, sum(far) over (partition by host, g, fixed, kind, told order by share, s rows between unbounded preceding and current row) as run from (
        select *, case when told = 1 and share - lag(share) over w > {DEVIATIONS} * sqrt((b + lag(b) over w) / (l + lag(l) over w) * (1 - (b + lag(b) over w) / (l + lag(l) over w)) * (1 / l + 1 / lag(l) over w)) then 1 else 0 end as far from (
          select c.host, c.g, c.s, cast(c.l as double) as l, cast(c.b as double) as b, case when c.l > 0 then 1 else 0 end as told, case when c.l > 0 then cast(c.b as double) / cast(c.l as double) else 0.0 end as share,
            case when p.n < {LEAST} then '**' when c.n < {LEAST} or c.n * c.n < p.n then '*' when c.s like '%<n>%' then c.s else '' end as fixed,
            case when c.e >= c.v and c.e >= c.n - c.e - c.v then 'ends' when c.v >= c.n - c.e - c.v then 'number' else 'word' end as kind
          from {table} c join (select host, g, sum(n) as n from {table} group by host, g) p on c.host = p.host and c.g = p.g
        ) x window w as (partition by host, g, fixed, kind, told order by share, s)
      ) y
    ) z window h as (partition by host, g, fixed, kind, told, run)"""


def descended_sql(table: str, decisions: str) -> str:
    """table a level further down."""
    return f"""select t.host, t.shape, case when t.rest = '' then t.g else concat(t.g, '/', d.name) end as g, case when d.name is null or d.name = '**' then '' else {AFTER} end as rest, t.n, t.l, t.b
    from {table} t left join {decisions} d on t.host = d.host and t.g = d.g and {NEXT} = d.s"""


def judged_sql(table: str) -> str:
    """host, shape and the template with its purity."""
    return f"""select t.host, t.shape, case when t.g = '' then '/' else t.g end as template,
      (m.b + {ALPHA} * (h.b + {ALPHA} * (select (sum(b) + 1.0) / (sum(l) + 2.0) from {table})) / (h.l + {ALPHA})) / (m.l + {ALPHA}) as purity
    from {table} t
    join (select host, g, sum(l) as l, sum(b) as b from {table} group by host, g) m on t.host = m.host and t.g = m.g
    join (select host, sum(l) as l, sum(b) as b from {table} group by host) h on t.host = h.host"""


def filtered(pages: DataFrame, rules: Sequence[Rule] = RULES, labels: DataFrame | None = None, reject: float = REJECT) -> DataFrame:
    """page_id, url, host, path, rule, template, purity, verdict.  labels: page_id, bad (boolean), instead of the rules' verdicts."""
    spark = pages.sparkSession
    rows = pages.select("page_id", F.col("url").cast("string").alias("url")).withColumns({"host": host_of(F.col("url")), "path": path_of(F.col("url"))})
    by = by_rules(F.col("host"), F.col("path"), rules) if rules else F.lit(None).cast("struct<rule:string,verdict:string>")
    rows = rows.withColumn("by", by).withColumn("bad", F.col("by.verdict") == "block")
    if labels is not None:
        rows = rows.drop("bad").join(labels.groupBy("page_id").agg(F.max("bad").alias("bad")), "page_id", "left")
    rows = rows.withColumn("shape", shape(F.col("path")))
    counts = rows.groupBy("host", "shape").agg(F.count(F.lit(1)).alias("n"), F.count("bad").alias("l"), F.count(F.when(F.col("bad"), 1)).alias("b"))
    tree = staged(counts.select("host", "shape", F.lit("").alias("g"), F.col("shape").alias("rest"), "n", "l", "b"), "url-tree")
    while tree.where("rest <> ''").take(1):
        branches = staged(spark.sql(children_sql("{t}"), t=tree), "url-branches")
        decided = spark.sql(decided_sql("{c}"), c=branches)
        above, tree = tree, staged(spark.sql(descended_sql("{t}", "{d}"), t=tree, d=decided), "url-tree")
        discarded(branches)
        discarded(above)
    judged = spark.sql(judged_sql("{t}"), t=tree)
    verdict = F.coalesce("by.verdict", F.when(F.col("purity") >= reject, "block").otherwise("allow"))
    return rows.join(judged, ["host", "shape"], "left").select("page_id", "url", "host", "path", F.col("by.rule").alias("rule"), "template", "purity", verdict.alias("verdict"))


def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filtered(read_table(spark, sf_dir, "pages")).select("page_id", "host", "path", "rule", "verdict")


#: Levels that the SQL goes down; further ones change nothing where no branch of LEAST urls is deeper.
SQL_LEVELS = 8


def _sql() -> str:
    fits = "\n".join(f"when (host = '{h}' or ends_with(host, '.{h}')) and starts_with(path, '{p}') then '{v} {h}{p}'" for v, h, p in sorted(RULES, key=lambda r: -len(r[1] + r[2])))
    steps = "".join(f"c{k} as ({children_sql(f't{k - 1}')}), d{k} as ({decided_sql(f'c{k}')}), t{k} as ({descended_sql(f't{k - 1}', f'd{k}')}),\n" for k in range(1, SQL_LEVELS + 1))
    return f"""
with u as (
  select page_id, translate(coalesce(regexp_extract(url, '{PARTS}', 1), ''), '{UPPER}', '{LOWER}') as host, coalesce(regexp_extract(url, '{PARTS}', 2), '') as path from pages
), r0 as (
  select *, case {fits} end as hit, list_transform(list_filter(string_split(replace(replace(path, '*', '%2A'), '+', '%2B'), '/'), lambda s: s <> ''), lambda s: regexp_replace(s, '[0-9]+', '<n>', 'g')) as x from u
), r as (
  select *, array_to_string(list_filter(x, lambda s, i: i = 1 or s <> x[i - 1] or contains(s, '<n>')), '/') as shape from r0
), t0 as (
  select host, shape, '' as g, shape as rest, count(*) as n, count(hit) as l, count(*) filter (where hit like 'block%') as b from r group by host, shape
), {steps} j as ({judged_sql(f"t{SQL_LEVELS}")})
select page_id, r.host, path, split_part(hit, ' ', 2) as rule,
  case when hit is not null then split_part(hit, ' ', 1) when purity >= {REJECT} then 'block' else 'allow' end as verdict
from r left join j on r.host = j.host and r.shape = j.shape
"""


QUERIES = {"op3_url_filter": op3_url_filter}
SQL = {"op3_url_filter": _sql()}
