from __future__ import annotations

import itertools
import random

import numpy as np
import pytest

from tests.comparing import connect, normalised, spark_rows, sql_rows
from tests.llm.brute import jaccard_components, roots
from tidemart.llm import ngram_join
from tidemart.llm.components import components
from tidemart.llm.hashing import mix
from tidemart.llm.ngram_join import Signatures, keep_one, ngram_components
from tidemart.llm.queries import LLM_ORACLES, LLM_QUERIES

SCHEMA = "doc_id bigint, text string, node string, component_id string"


def found(spark, rows):
    frame = spark.createDataFrame([(d, t, "x", "y") for d, t in rows], SCHEMA).repartition(3)
    return {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_components(spark, frame).collect()}


def edited(rng, words, edits):
    words = list(words)
    for _ in range(edits):
        words[rng.randrange(len(words))] = f"new{rng.randrange(10**6)}"
    return " ".join(words)


@pytest.mark.parametrize("sf_dir", ["/root/testdata/sf0.001", "/root/testdata/sf0.01"])
def test_query_matches_sql(spark, sf_dir):
    got = spark_rows(LLM_QUERIES["op10_ngram_join"](spark, sf_dir))
    expected = sql_rows(connect(sf_dir), LLM_ORACLES["op10_ngram_join"])
    assert normalised(*got) == normalised(*expected)


@pytest.mark.parametrize("seed,frequent", [(1, 32), (2, 3)])
def test_families_of_copies_against_brute_force(spark, monkeypatch, seed, frequent):
    """Chains of edits, a passage that many share, sizes around the bands' ends."""
    monkeypatch.setattr(ngram_join, "FREQUENT", frequent)
    rng = random.Random(seed)
    vocabulary = [f"w{k}" for k in range(300)]
    passage = " ".join(rng.choices(vocabulary, k=40))
    texts = []
    for size in (1, 3, 4, 5, 6, 8, 9, 12, 19, 20, 36, 40, 68, 70, 140, 260):
        base = rng.choices(vocabulary, k=size)
        texts.append(" ".join(base))
        chain = list(base)
        for k in range(6):
            texts.append(edited(rng, base, rng.randrange(0, 1 + size // 20)))
            chain = edited(rng, chain, rng.randrange(0, 1 + size // 25)).split(" ")
            texts.append(" ".join(chain))
            texts.append(" ".join(base[: max(1, size - k)]))
        texts += [passage + " " + " ".join(rng.choices(vocabulary, k=rng.randrange(1, 60))) for _ in range(4)]
    rng.shuffle(texts)
    rows = list(enumerate(texts))
    assert found(spark, rows) == jaccard_components(rows)


@pytest.mark.parametrize("size", list(range(1, 70)) + [127, 128, 129, 255, 300])
def test_similar_sets_share_a_signature(size):
    """For the most different pairs that still link, whatever the order of the signatures."""
    rng = np.random.default_rng(size)
    for turn in range(12):
        a = mix(rng.integers(1, 2**60, size).astype(np.uint64))
        keep = rng.integers(-(-4 * size // 5), size + 1)
        common = a[:keep]
        extra = (keep * 5 // 4) - size
        b = np.concatenate([common, mix(rng.integers(2**60, 2**61, max(0, extra)).astype(np.uint64))])
        inter, union = keep, size + max(0, extra)
        assert 100 * inter >= 80 * union
        plain = Signatures(80, 100)
        seen = np.unique(np.concatenate([plain.of_parts(a, k)[0] for k, _ in plain.bands(size)]))
        hot = seen[rng.random(len(seen)) < 0.5]
        for chooser in (plain, Signatures(80, 100, (hot, np.full(len(hot), 100)))):
            assert np.intersect1d(chooser.chosen(a), chooser.chosen(b)).size


def test_nulls_empty_short_long_and_repeated_rows(spark):
    long = " ".join(f"t{k % 5000}" for k in range(60_000))
    rows = [(1, None), (2, ""), (3, " \n"), (4, "Two Words"), (9, "two words"), (5, long), (6, long + " end"), (7, "Two\tWORDS"), (7, "two words")]
    got = found(spark, rows)
    assert got[1] == (0, 1) and got[2] == (0, 2) and got[3] == (0, 3)
    assert got[4] == got[7] == got[9] == (1, 4)
    assert got[5][1] == got[6][1] == 5
    frame = spark.createDataFrame([(None, "a b", "", ""), (3, "a b", "", ""), (None, "c d", "", "")], SCHEMA)
    assert sorted((r.doc_id or 0, r.component_id or 0) for r in ngram_components(spark, frame).collect()) == [(0, 0), (0, 3), (3, 3)]


def test_empty_table(spark):
    assert found(spark, []) == {}


def test_components(spark):
    rng = random.Random(5)
    edges = [(k, k + 1) for k in range(40)] + [(100, k) for k in range(101, 180)] + [(300, 300)]
    edges += [(rng.randrange(400, 500), rng.randrange(400, 500)) for _ in range(60)]
    frame = spark.createDataFrame(edges, "u bigint, v bigint")
    got = {r.node: r.component for r in components(spark, frame).collect()}
    nodes = set(itertools.chain.from_iterable(e for e in edges if e[0] != e[1]))
    assert got == roots(nodes, [e for e in edges if e[0] != e[1]])


def near(words, *places):
    """A text like another one, with a word changed at each place."""
    changed = list(words)
    for place in places:
        changed[place] = f"changed{place}"
    return " ".join(changed)


def test_texts_that_share_an_id_keep_all_their_links(spark):
    a, b, c = ([f"{name}{k}" for k in range(90)] for name in "abc")
    rows = [(1, " ".join(a)), (1, " ".join(b)), (5, near(a, 40)), (6, near(b, 40)), (7, near(b, 10)), (8, " ".join(c)), (9, near(c, 0))]
    got = {k: v[1] for k, v in found(spark, rows).items()}
    assert got == {1: 1, 5: 1, 6: 1, 7: 1, 8: 8, 9: 8}


def test_rows_without_an_id_are_linked_by_similar_texts(spark):
    a, b = ([f"{name}{k}" for k in range(90)] for name in "ab")

    rows = [(None, near(a, 40)), (5, near(a, 40, 0)), (6, near(a, 40, 89)), (None, " ".join(b)), (None, near(b, 3))]
    frame = spark.createDataFrame([(d, t, "", "") for d, t in rows], SCHEMA)
    assert sorted((r.doc_id or 0, r.component_id or 0) for r in ngram_components(spark, frame).collect()) == [(0, 0), (0, 0), (0, 5), (5, 5), (6, 5)]
    kept = sorted((r.doc_id or 0, r.text) for r in keep_one(spark, frame).collect())
    assert kept == sorted([(0, " ".join(b)), (0, near(b, 3)), (5, near(a, 40, 0))])
