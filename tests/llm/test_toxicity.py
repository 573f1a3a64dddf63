from __future__ import annotations

import itertools
import random
import time
import zlib

import pytest

from tidemart.llm.queries import LLM_QUERIES
from tidemart.llm.toxicity import Lexicon, fold, learn_entries, learn_exceptions, matches, sums, toxicity

DOCS = "doc_id bigint, text string, score string, weight string"
LABELS = "doc_id bigint, toxic int, quality int"


@pytest.mark.parametrize(
    "text,folded",
    [
        ("Plain WORDS, here.", " plain words here "),
        ("1d10t st@pid cl0wn", " idiot stapid clown "),
        ("ídìot іdіоt ｉｄｉｏｔ", " idiot idiot idiot "),
        ("id​i­ot", " idiot "),
        ("in 1999 50% off$$$ a-b", " in off a b "),
        ("", "  "),
        (" \n", "  "),
    ],
)
def test_folding(text, folded):
    assert fold(text) == folded


def test_longest_entry_counts_once_and_exceptions_spare():
    lexicon = Lexicon({" tra": 1.0, " trash": 2.0, " trash ": 3.0, " idio": 5.0}, ("trash can",))
    found = matches(lexicon.automaton(), fold("Trash trashy train trash can idiots maidiot"))
    assert [w for _, w in found] == [3.0, 2.0, 1.0, 5.0]


def corpus(rng, count):
    plain = [f"w{k}" for k in range(200)] + [a + b + c for a in "bcdfg" for b in "aeiou" for c in "lmnprt"]
    docs, labels = [], []
    for k in range(count):
        words = rng.choices(plain, k=rng.randrange(5, 120))
        toxic = k % 4 == 0
        if toxic:
            for _ in range(2 + len(words) // 40):
                words.insert(rng.randrange(len(words)), rng.choice(["vilest", "vileness", "vil3ly", "Rоtter"]))
        elif k % 40 == 1:
            words.insert(rng.randrange(len(words)), "rotter damme")
        docs.append((k, " ".join(words), "x", "y"))
        labels.append((k, int(toxic), None))
    return docs, labels


def test_learns_stems_and_exceptions(spark):
    docs, labels = corpus(random.Random(1), 800)
    known = [r for r in labels if zlib.crc32(str(r[0]).encode()) % 3 != 1]
    scores, lexicon = toxicity(spark, spark.createDataFrame(docs, DOCS), spark.createDataFrame(known, LABELS))
    got = {r.doc_id: r.score for r in scores.collect()}
    held = {r[0]: r[1] for r in labels if zlib.crc32(str(r[0]).encode()) % 3 == 1}
    assert sum((got[k] >= 0.7) == bool(t) for k, t in held.items()) / len(held) > 0.97
    assert "rotter damme" in lexicon.exceptions
    assert all(0 <= s <= 1 for s in got.values())


def test_query_on_held_out_documents(spark):
    sf_dir = "/root/testdata/sf0.1"
    rows = LLM_QUERIES["op9_toxicity"](spark, sf_dir).collect()
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    assert len(rows) == spark.read.parquet(f"{sf_dir}/documents.parquet").count()
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1)
        assert r.predicted == int(r.score >= 0.7) and 0 <= r.score <= 1
    held = [r for r in rows if r.held_out and r.doc_id in labels]
    found = [r for r in held if r.predicted]
    right = [r for r in found if labels[r.doc_id]]
    toxic = [r for r in held if labels[r.doc_id]]
    assert len(right) / len(toxic) > 0.85 and len(right) / len(found) > 0.95


def test_odd_tables(spark):
    docs = spark.createDataFrame([(1, None, "", ""), (2, "", "", ""), (None, "vile", "", ""), (3, "a " * 100_000, "", ""), (3, "a", "", "")], DOCS)
    none = spark.createDataFrame([], LABELS)
    scores, lexicon = toxicity(spark, docs, none)
    assert [r.score for r in scores.collect()] == [0.0] * 5 and not lexicon.weights
    one = spark.createDataFrame([(1, 1, 0), (2, None, 0), (None, 1, 0), (99, 1, 0)], LABELS)
    assert {r.score for r in toxicity(spark, docs, one)[0].collect()} == {1.0}
    assert toxicity(spark, spark.createDataFrame([], DOCS), one)[0].count() == 0
    assert {r.words for r in sums(docs, Lexicon()).collect()} == {0, 1, 100_000}


def test_all_significant_entries_and_exceptions_are_learnt(spark):
    stems = ["".join(x) for x in itertools.product("abcdefgh", repeat=3)]
    toxic, plain = (" ".join(f"{first}{s}stemmeds" for s in stems) for first in "pq")
    texts = spark.createDataFrame([(toxic, True)] * 8 + [(plain, False)] * 8, "text string, toxic boolean").repartition(2)
    weights = learn_entries(texts)
    # Whole words, their starts of 4 to 12 letters, and those of 3 letters, which 8 words share.
    assert len(weights) == 512 * 10 + 64
    phrases = " ".join(f"{w} rotter" for w in plain.split()) + " end"
    again = " ".join(f"z{w} rotter" for w in plain.split()) + " end"
    texts = spark.createDataFrame([(phrases, False), (again, False)] * 3, "text string, toxic boolean").repartition(2)
    # A phrase before and one behind each entry; both texts end alike.
    assert len(learn_exceptions(texts, {" rotter": 2.0})) == 2 * (2 * 512) - 1


def plain_matches(lexicon, text):
    """Each word's longest entry, unless the word lies in an exception phrase; by looking at all places."""
    starts = [k for k in range(len(text) - 1) if text[k] == " " and text[k + 1] != " "]
    spared = set()
    for phrase in lexicon.exceptions:
        phrase = f" {phrase} "
        for k in starts:
            if text.startswith(phrase, k):
                spared.update(range(k, k + len(phrase) - 1))
    found = []
    for k in starts:
        entries = [e for e in lexicon.weights if text.startswith(e, k)]
        if entries and k not in spared:
            found.append((k, lexicon.weights[max(entries, key=len)]))
    return found


def test_matches_against_all_places():
    rng = random.Random(8)
    lexicon = Lexicon({" ab": 1.0, " ab ": 2.0, " abc": 3.0, " b": 4.0, " ca": 5.0}, ("ab b", "b ab", "ca ca", "abc ab"))
    automaton = lexicon.automaton()
    for _ in range(400):
        text = fold(" ".join(rng.choice(["ab", "abc", "b", "ca", "cab", "d"]) for _ in range(rng.randint(0, 12))))
        assert matches(automaton, text) == plain_matches(lexicon, text)


def test_time_grows_with_the_number_of_exceptions():
    automaton = Lexicon({" trash": 1.0}, ("trash can",)).automaton()
    start = time.perf_counter()
    assert len(matches(automaton, fold("trash can trash " * 100_000))) == 100_000
    assert time.perf_counter() - start < 5
