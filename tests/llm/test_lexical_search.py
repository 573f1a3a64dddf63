from __future__ import annotations

import math
import re
from collections import Counter

import numpy as np
import pytest

from tests.comparing import connect, normalised, spark_rows, sql_rows
from tests.llm.brute import FOLD
from tidemart.llm import lexical_search as module
from tidemart.llm.lexical_search import LAST, Items, Ranking, lexical_search, terms
from tidemart.llm.queries import LLM_ORACLES, LLM_QUERIES

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
# The second columns clash with names that the operator uses itself.
DOCS = "doc_id bigint, text string, n int, score string, item int"
ITEMS = "item_id bigint, text string, doc_id int, rank string"


def plain(docs, items, best=20):
    split = [(doc_id, Counter(TERM.findall((text or "").translate(FOLD)))) for doc_id, text in docs]
    split = [(doc_id, counts) for doc_id, counts in split if counts]
    documents, total = len(split), sum(sum(c.values()) for _, c in split)
    df = Counter(term for _, counts in split for term in counts)
    found = []
    for item_id, text in items:
        scored = []
        for doc_id, counts in split:
            m = 75 + 25 * sum(counts.values()) * documents // total
            score = 0
            for term in TERM.findall((text or "").translate(FOLD)):
                if counts[term]:
                    w = math.floor(1000 * math.log((2 * documents + 2) / (2 * df[term] + 1)))
                    score += w * (10**9 * counts[term] // (1000 * counts[term] + 12 * m))
            if score > 0:
                scored.append((-score, doc_id is None, doc_id or 0, doc_id))
        for rank, (score, _, _, doc_id) in enumerate(sorted(scored)[:best], 1):
            found.append((item_id, rank, doc_id, -score))
    return sorted(found, key=repr)


def search(spark, docs, items, best=20):
    frames = (
        spark.createDataFrame([(d, t, 1, "x", 2) for d, t in docs], DOCS).repartition(3),
        spark.createDataFrame([(i, t, 1, "x") for i, t in items], ITEMS),
    )
    return sorted((tuple(r) for r in lexical_search(spark, *frames, best).collect()), key=repr)


@pytest.mark.parametrize("sf_dir", ["/root/testdata/sf0.001", "/root/testdata/sf0.01"])
def test_query_matches_sql(spark, sf_dir):
    got = spark_rows(LLM_QUERIES["op13_lexical_search"](spark, sf_dir))
    assert normalised(*got) == normalised(*sql_rows(connect(sf_dir), LLM_ORACLES["op13_lexical_search"]))
    assert len(got[1]) > 500


def test_terms():
    assert terms("It's 9") == [b"it", b"s", b"9"]
    assert [t.decode() for t in terms("A-b  ÉA_1\x7fx")] == ["a", "b", "Éa", "1", "x"]
    assert terms(None) == terms(" .,") == []


ODD_DOCS = [
    (1, "red fox red"),
    (2, "Red, fox! jumps"),
    (2, "another row of id two: red"),
    (3, "red fox red"),
    (4, None),
    (5, ""),
    (6, "... --- !!!"),
    (None, "red fox red"),
    (7, "redfox foxred fo x Ähre"),
    (8, "cat " * 50_000 + "fox"),
    (9, "dog éclair 日本 語"),
    (10, "plain words without any of them"),
]
ODD_ITEMS = [
    (1, "red fox"),
    (2, "RED red red fox ähre Ähre"),
    (3, None),
    (4, ""),
    (5, "?!"),
    (6, "unknown"),
    (None, "日本 éclair"),
    (8, "fox"),
    (8, "cat"),
    (9, "fox"),
]


def test_odd_rows(spark):
    got = search(spark, ODD_DOCS, ODD_ITEMS)
    assert got == plain(ODD_DOCS, ODD_ITEMS) and len(got) > 20
    assert search(spark, ODD_DOCS, ODD_ITEMS, best=2) == plain(ODD_DOCS, ODD_ITEMS, best=2)


def test_empty_tables(spark):
    assert search(spark, [], ODD_ITEMS) == search(spark, ODD_DOCS, []) == search(spark, [(1, None)], [(1, None)]) == []


def test_items_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(module, "ITEM_BYTES", 20)
    monkeypatch.setattr(module, "MATRIX", 8)
    assert search(spark, ODD_DOCS, ODD_ITEMS) == plain(ODD_DOCS, ODD_ITEMS)


def test_ranking_keeps_what_a_full_sort_keeps(monkeypatch):
    monkeypatch.setattr(module, "MATRIX", 50)
    rng = np.random.default_rng(1)
    scores, ids = rng.integers(-2, 6, (400, 3)), rng.permutation(400)
    ids[5] = LAST
    ranking = Ranking(3, 7)
    for start in range(0, 400, 9):
        ranking.show(scores[start : start + 9], ids[start : start + 9])
    item, score, doc = ranking.settle()
    expected = [
        (i, s, d)
        for i in range(3)
        for s, d in sorted(((int(s), int(d)) for s, d in zip(scores[:, i], ids) if s > 0), key=lambda x: (-x[0], x[1]))[:7]
    ]
    assert list(zip(item.tolist(), score.tolist(), doc.tolist())) == expected


def test_items_of_a_term():
    items = Items.of([(1, "a b a"), (2, None), (3, "b")])
    assert items.terms == [b"a", b"b"] and items.items.tolist() == [0, 0, 2] and items.times.tolist() == [2, 1, 1]
