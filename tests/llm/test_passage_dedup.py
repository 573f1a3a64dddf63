from __future__ import annotations

import random

import pytest

from tests.llm.brute import words
from tidemart.llm.passage_dedup import RUN, PassageDedup
from tidemart.llm.queries import LLM_QUERIES


def expected(docs):
    """(doc, word) -> first place of the run there, for all runs that repeat, by listing all runs."""
    places = {}
    for d, text in docs:
        w = words(text)
        for k in range(len(w) - RUN + 1):
            places.setdefault(tuple(w[k : k + RUN]), []).append((d, k))
    return {p: min(at) for at in places.values() if len(at) > 1 for p in at}


def got(rows):
    return {
        (r.doc_id, r.first_word + k): (r.keep_doc_id, r.keep_word + k) for r in rows for k in range(r.n_words - RUN + 1)
    }


@pytest.mark.parametrize("sf_dir", ["/root/testdata/sf0.001", "/root/testdata/sf0.01"])
def test_query_matches_brute_force(spark, sf_dir):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    rows = LLM_QUERIES["op6_passage_dedup"](spark, sf_dir).collect()
    assert got(rows) == expected(docs)
    assert all(r.kept == ((r.doc_id, r.first_word) == (r.keep_doc_id, r.keep_word)) for r in rows)


def test_passage_inside_longer_lines_and_across_line_breaks(spark):
    rng = random.Random(4)
    fresh = lambda n: [f"u{rng.randrange(10**9)}" for _ in range(n)]
    passage = fresh(50)
    inside = " ".join(fresh(60) + passage + fresh(70))
    other = " ".join(fresh(110) + passage + fresh(20))
    broken = "\n".join(" ".join(x) for x in (fresh(9) + passage[:13], passage[13:20], passage[20:41], passage[41:] + fresh(30)))
    docs = [(1, inside), (2, other), (3, broken), (4, " ".join(fresh(200))), (5, None), (6, ""), (7, " ".join(passage[:49]))]
    frame = spark.createDataFrame(docs, "doc_id bigint, text string").repartition(3)
    rows = PassageDedup(spark, frame).spans().collect()
    assert sorted((r.doc_id, r.first_word, r.n_words, r.keep_doc_id, r.keep_word, r.occurrences, r.kept) for r in rows) == [
        (1, 60, 50, 1, 60, 3, True), (2, 110, 50, 1, 60, 3, False), (3, 9, 50, 1, 60, 3, False),
    ]


def test_odd_rows(spark):
    text = " ".join(f"w{k}" for k in range(60))
    rows = [(None, text), (4, "x " * 1000), (4, "x " * 1000), (3, text.upper()), (3, text.upper())]
    found = PassageDedup(spark, spark.createDataFrame(rows, "doc_id bigint, text string")).spans().collect()
    assert [(r.first_word, r.n_words, r.keep_doc_id, r.kept) for r in found if r.doc_id is None] == [(0, 60, 3, False)]
    assert [(r.first_word, r.n_words, r.occurrences, r.kept) for r in found if r.doc_id == 3] == [(0, 60, 3, True)]
    assert {r.first_word + k for r in found if r.doc_id == 4 for k in range(r.n_words)} == set(range(1000))
    assert PassageDedup(spark, spark.createDataFrame([], "doc_id bigint, text string")).spans().count() == 0
