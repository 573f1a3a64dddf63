from __future__ import annotations

import time

import pytest
from pyspark.sql import functions as F

from tests.comparing import connect, normalised, spark_rows, sql_rows
from tidemart.llm.line_dedup import clean_pages, page_lines, url_host
from tidemart.llm.queries import LLM_ORACLES, LLM_QUERIES

SCHEMA = "page_id bigint, url string, html string, dropped string, kept int"


@pytest.mark.parametrize("sf_dir", ["/root/testdata/sf0.001", "/root/testdata/sf0.01"])
def test_query_matches_sql(spark, sf_dir):
    got = spark_rows(LLM_QUERIES["op2_line_dedup"](spark, sf_dir))
    expected = sql_rows(connect(sf_dir), LLM_ORACLES["op2_line_dedup"])
    assert normalised(*got) == normalised(*expected)
    assert sf_dir.endswith("001") or any(row[got[0].index("n_kept")] < row[got[0].index("n_lines")] for row in got[1])


@pytest.mark.parametrize(
    "url,host",
    [
        ("http://Example.COM/a", "example.com"),
        ("https://u:p@h.org:8080?x", "h.org"),
        ("ftp://h#x", "h"),
        ("no url", None),
        ("http:///x", None),
        ("", None),
        (None, None),
    ],
)
def test_hosts(spark, url, host):
    assert spark.createDataFrame([(url,)], "u string").select(url_host(F.col("u"))).first()[0] == host


def test_lines(spark):
    html = (
        "<html><SCRIPT>var x='<p>';</SCRIPT ><style>p{}</style><p>One <b>bold</b>  line<br>two\n three"
        "<!-- <p>no</p> --><li><a href='/x'>link</a></li><div> </div>&amp;<sup>2</sup></html>"
    )
    frame = spark.createDataFrame([(html,), (None,), ("",)], "h string").select(page_lines(F.col("h")))
    assert [r[0] for r in frame.collect()] == [["One bold line", "two", "three", "link", "&amp;2"], [], []]


def kept(spark, rows, **options):
    frame = spark.createDataFrame([(k, u, h, "x", 1) for k, u, h in rows], SCHEMA).repartition(3)
    return {r.page_id: r.kept for r in clean_pages(spark, frame, **options).collect()}


def test_shares_are_per_host(spark):
    rows = [(k, "http://a.x/", f"<p>menu<p>menu<p>own {k}" + ("<p>rare" if k < 2 else "")) for k in range(20)]
    rows += [(100 + k, "http://b.x/", f"<p>other {k}" + ("<p>menu" if k == 0 else "")) for k in range(20)]
    rows += [(200, None, "<p>menu"), (201, "nowhere", "<p>menu"), (202, "http://c.x", "<p>menu"), (203, "http://a.x/", None)]
    got = kept(spark, rows)
    assert got[5] == ["own 5"] and got[0] == ["own 0", "rare"] and got[100] == ["other 0", "menu"]
    assert got[200] == got[201] == got[202] == ["menu"] and got[203] == []
    # Exactly at the ratio a line stays; above it goes.
    assert kept(spark, rows, ratio=20 / 21)[5] == ["menu", "menu", "own 5"]
    assert kept(spark, rows, ratio=0.95)[5] == ["own 5"]
    assert kept(spark, rows, min_pages=21)[5] == ["menu", "menu", "own 5"]


def test_repeated_long_and_no_rows(spark):
    long = "<p>" + "<p>".join(f"line {k}" for k in range(50_000))
    got = kept(spark, [(1, "http://a.x", long)] * 3 + [(2, "http://a.x", "<p>line 7<p>new")])
    assert got == {1: [], 2: ["new"]}
    assert kept(spark, []) == {}


@pytest.mark.parametrize("html", ["<" * 300_000, "<script" * 50_000, "<!-- " * 60_000, "<a " * 100_000, "<p>x" + "< " * 150_000])
def test_time_grows_with_the_length_of_a_page(spark, html):
    start = time.perf_counter()
    spark.createDataFrame([(html,)], "h string").select(page_lines(F.col("h"))).collect()
    assert time.perf_counter() - start < 10


def test_tags_and_scripts_that_do_not_end(spark):
    pages = ["<p>a < b<p>c", "<p>one<script>two<p>three", "<p>one<!-- two", "<b <i>x</i>"]
    frame = spark.createDataFrame([(k, h) for k, h in enumerate(pages)], "k int, h string").select("k", page_lines(F.col("h")).alias("l"))
    assert [r.l for r in frame.orderBy("k").collect()] == [["a < b", "c"], ["one"], ["one"], ["<b x"]]
