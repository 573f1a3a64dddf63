"""Site-relative line deduplication: lines that too large a share of a host's pages have are dropped.

A page's lines are the texts between its block tags. Per host, the pages that contain a line are
counted (once per page, combined before the shuffle, so that a line on every page of a huge host is one
row per task) and divided by the host's pages. Lines above ``ratio`` that are on at least ``min_pages``
pages are boilerplate, and all their occurrences on that host go; the same line on another host stays.

What is boilerplate on a host is carried as one array of line hashes: as each such line is on more than
``ratio`` of the pages, there are fewer of them than the host's mean lines per page divided by ``ratio``.
Pages and hosts are joined by shuffle, where the pages of a large host are split over tasks.

Cases: null or empty html has no lines. Pages whose url has no host, or is null, keep all lines. Rows
that repeat a page are pages of their own. An empty table gives no rows. Entities are left as they are
written. Pages are read whole; other columns pass through ``clean_pages``, but for html and columns that
are already called host, lines or kept.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemart.llm.common import BLANKS, written

RATIO = 0.1
MIN_PAGES = 3

HOST = r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:@]+)"
# What a reader does not see, and tags within a line (fixed values of HTML). A tag ends at the next "<" at the latest, and
# an unclosed script, style or comment goes on to the end: no part of a page is looked at for every "<" before it.
UNSEEN = r"(?is)<script\b.*?(?:</script\s*>|\z)|<style\b.*?(?:</style\s*>|\z)|<!--.*?(?:-->|\z)"
INLINE = r"(?i)</?(?:a|abbr|b|bdi|cite|code|em|font|i|kbd|mark|q|s|samp|small|span|strong|sub|sup|u|var|wbr)(?:\s[^<>]*+)?>"
TAG = r"<[^<>]*+>"


def url_host(url: Column) -> Column:
    """The host of a URL in lower case, null if it has none."""
    return F.lower(F.nullif(F.regexp_extract(url, HOST, 1), F.lit("")))


def page_lines(html: Column) -> Column:
    """The visible lines of a page in order, white space folded, none empty."""
    text = F.regexp_replace(F.coalesce(html, F.lit("")), UNSEEN, "\n")
    text = F.regexp_replace(F.regexp_replace(text, INLINE, ""), TAG, "\n")
    lines = F.transform(F.split(text, r"[\n\r]+"), lambda line: F.trim(F.regexp_replace(line, BLANKS, " ")))
    return F.filter(lines, lambda line: line != "")


def boilerplate(pages: DataFrame, ratio: float = RATIO, min_pages: int = MIN_PAGES) -> DataFrame:
    """``(host, pages, dropped)``: hashes of the boilerplate lines of each host, from ``(host, lines)``."""
    known = pages.where("host is not null")
    totals = known.groupBy("host").agg(F.count(F.lit(1)).alias("pages"))
    hashes = F.array_distinct(F.transform("lines", lambda line: F.xxhash64(line)))
    counts = known.select("host", F.explode(hashes).alias("line")).groupBy("host", "line").agg(
        F.count(F.lit(1)).alias("with_line")
    )
    counts = counts.where(F.col("with_line") >= min_pages).join(totals, "host")
    common = counts.where(F.col("with_line") > F.col("pages") * F.lit(ratio))
    return common.groupBy("host").agg(F.first("pages").alias("pages"), F.collect_list("line").alias("dropped"))


def clean_pages(spark: SparkSession, pages: DataFrame, ratio: float = RATIO, min_pages: int = MIN_PAGES) -> DataFrame:
    """The other columns of ``pages`` (url, html and more) with host, lines and ``kept``, the lines that stay."""
    others = [c for c in pages.columns if c not in ("html", "host", "lines", "kept")]
    cut = written(
        spark,
        pages.select(
            F.struct(*(F.col(f"`{c}`") for c in others)).alias("page"),
            url_host(F.col("url")).alias("host"),
            page_lines(F.col("html")).alias("lines"),
        ),
        "page-lines",
    )
    common = written(spark, boilerplate(cut, ratio, min_pages), "boilerplate").select(F.col("host").alias("on_host"), "dropped")
    met = cut.join(common, F.col("host") == F.col("on_host"), "left")
    kept = F.filter("lines", lambda line: ~F.array_contains(F.col("dropped"), F.xxhash64(line)))
    kept = F.when(F.col("dropped").isNull(), F.col("lines")).otherwise(kept)
    met = met.select("page", "host", "lines", kept.alias("kept"))
    return met.select(*(F.col(f"page.`{c}`").alias(c) for c in others), "host", "lines", "kept")
