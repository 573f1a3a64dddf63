from __future__ import annotations

import hashlib
import re

import pytest

from tests.comparing import connect, normalised, spark_rows, sql_rows
from tidemart.llm.exact_dedup import DigestIndex
from tidemart.llm.queries import LLM_ORACLES, LLM_QUERIES

SCHEMA = "doc_id bigint, text string, keep string"


def decided(frame):
    return {row.doc_id: (row.keep_id, row.group_size, row.kept) for row in frame.collect()}


def test_query_matches_sql(spark):
    sf_dir = "/root/testdata/sf0.001"
    found = spark_rows(LLM_QUERIES["op1_exact_dedup"](spark, sf_dir))
    expected = sql_rows(connect(sf_dir), LLM_ORACLES["op1_exact_dedup"])
    assert normalised(*found) == normalised(*expected)


def test_batches_find_earlier_rows_and_reruns_agree(spark):
    index = DigestIndex.create(spark, buckets=4)
    first = spark.createDataFrame([(5, "a  b", "x"), (3, "a\tb", "x"), (9, "c", "x")], SCHEMA)
    second = spark.createDataFrame([(1, "a b", "x"), (2, "d", "x"), (4, "d", "x")], SCHEMA)
    assert decided(index.add(first)) == {5: (3, 2, False), 3: (3, 2, True), 9: (9, 1, True)}
    once = decided(index.add(second, "two"))
    assert once == {1: (3, 1, False), 2: (2, 2, True), 4: (2, 2, False)}
    assert decided(index.add(second, "two")) == once
    assert index.rows().count() == 3


def test_index_is_bucketed_and_not_shuffled(spark):
    index = DigestIndex.create(spark, buckets=4)
    index.add(spark.createDataFrame([(1, "a", "x")], SCHEMA))
    plan = (
        index.rows().hint("merge").join(index.rows().select("digest"), "digest", "left_anti")
    )._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Exchange" not in plan


def test_nulls_empty_long_and_repeated_rows(spark):
    long = "word " * 200_000
    rows = [(None, None, "x"), (None, "", "x"), (7, "", None), (7, "", None), (8, " \n", "x"), (9, long, "x"), (2, long, "x")]
    found = DigestIndex.create(spark, buckets=2).add(spark.createDataFrame(rows, SCHEMA))
    got = sorted((r.doc_id or 0, r.keep_id, r.group_size, r.kept) for r in found.collect())
    assert got == [(0, 7, 4, False), (0, 7, 4, False), (2, 2, 2, True), (7, 7, 4, True), (7, 7, 4, True), (8, 8, 1, True), (9, 2, 2, False)]
    digest = next(r.digest for r in found.collect() if r.doc_id == 9)
    assert bytes(digest) == hashlib.sha256(re.sub(r"\s+", " ", long).encode()).digest()


@pytest.mark.parametrize("rows", [[]])
def test_empty_batch(spark, rows):
    assert DigestIndex.create(spark, buckets=2).add(spark.createDataFrame(rows, SCHEMA)).count() == 0


def test_only_null_ids(spark):
    found = DigestIndex.create(spark, buckets=2).add(spark.createDataFrame([(None, "a", "x")] * 2, SCHEMA))
    assert [(r.keep_id, r.group_size, r.kept) for r in found.collect()] == [(None, 2, True)] * 2
