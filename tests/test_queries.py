"""Queries against their SQL, on rows that the driver's tables have few of or none."""

from __future__ import annotations

import duckdb
import pyarrow as pa
import pyarrow.parquet as pq
import pytest


@pytest.fixture
def agree(spark, tmp_path):
    """A query's rows over one table, after they were compared with its SQL's."""
    import __spark_entry__ as entry

    def run(query, name, table):
        pq.write_table(table, tmp_path / f"{name}.parquet")
        got = entry.queries()[query](spark, str(tmp_path))
        con = duckdb.connect()
        con.execute(f"create view {name} as select * from read_parquet('{tmp_path}/{name}.parquet')")
        sql = con.execute(f"select {', '.join(got.columns)} from ({entry.oracle_sql()[query]})").fetchall()
        rows = got.collect()
        assert sorted(map(repr, map(tuple, rows))) == sorted(map(repr, sql))
        return rows

    return run


def test_country_patterns_are_as_their_sql_reads_them(agree):
    texts = [
        "4200919553109845", "+919553109845", "x0091 9553109845.", "0091 95531098451", "0091 9553109845", "0091 955310984٥", "+91\x0b9553109845", "+91 9553109845\n", "+91-95531\n09845١",
        "123456́ 234567‿ 345678² 456789‍ 567890_ ́678901 789012", "éINR 5", "INR 5", "INR\x0b5", "Rſ. 5", "Rs. ٥", "İNR 5", "ınr 5", "₹\n5", "inr5", "xINR 5", "𝐀123456 😀234567 𝟏345678 456789𝐀",
        "éIndia", "Indiá", "INDIA", "ındia", "Bharat_", "bharat²", "", None,
    ]
    rows = agree("country_patterns", "documents", pa.table({"doc_id": pa.array([6 * k + 5 for k in range(len(texts))], pa.int64()), "text": pa.array(texts, pa.string())}))
    phone = {r["doc_id"]: r["phone"] for r in rows}
    assert [phone[6 * k + 5] for k in range(4)] == [True, True, True, False]


def test_page_title_h1_is_as_its_sql_reads_it(agree):
    htmls = [
        "<title>the&amp;&amp;&amp</title><h1>the&am</h1>", "<title>a</title><h1>b</h1><h1>c</h1>", "<TITLE>a</TITLE><h1 class='x'>b</h1><h1><b>c</b></h1><h1>d</h1>", "<h1>a\n\x0b\t b</h1><title>\xa0c\xa0</title>",
        "<title>&amp;copy; &copy; &middot; &quot; &lt; &#39; &copy</title>", "<script>'<title>a</title>'</script><title>b</title>", "<!-- <h1>a</h1> --><h1>b</h1>", "<title>a", "<title></title><h1>\u2003a\u3000\n</h1>", "<h1>a\u2028</h1>", "", None, "<h1>" * 20, "<title>x</title>" + "<h1>" + "y " * 100_000 + "</h1>",
    ]
    n = len(htmls)
    rows = agree("page_title_h1", "pages", pa.table({"page_id": pa.array(range(n), pa.int64()), "url": pa.array(["http://a.example.com/"] * n), "html": pa.array(htmls, pa.string())}))
    assert len(rows) == n and {r["store"]: r["title_h1"] for r in rows}[0] == "the&&&amp the&am"


@pytest.mark.parametrize("query", ["links_topk_per_page", "parsed_pages"])
def test_pages_are_parsed_once(spark, query):
    import __spark_entry__ as entry

    plan = entry.queries()[query](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1
