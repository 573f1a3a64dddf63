from __future__ import annotations

import math
import random
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from tests.llm.brute import words
from tidemart.llm import class_lm
from tidemart.llm.class_lm import CLASSES, END, END_ENDING, Exchange, WORD_TYPES, entropy_term, learn, score, score_documents, tokens
from tidemart.llm.hashing import text_blocks
from tidemart.llm.queries import LLM_QUERIES

SCHEMA = "doc_id bigint, text string, score string, word int"


def hashed(text):
    """(hash, ending) of each word of a text and of the end."""
    batch = pa.RecordBatch.from_arrays([pa.array([text], pa.string())], names=["text"])
    for _, data, offsets in text_blocks(batch):
        found, endings, _ = tokens(data, offsets)
        return list(zip(found.tolist(), endings.tolist()))


def base_scores(docs, train):
    """The contract's base score, token counts and known tokens."""
    end = object()
    count = Counter(w for text in train for w in [*words(text), end])
    total, distinct = sum(count.values()), len(count)
    found = {}
    for doc_id, text in docs:
        own = [*words(text), end]
        base = sum(math.log10((count[w] + 1) / (total + distinct + 1)) for w in own)
        found[doc_id] = (len(own), sum(count[w] > 0 for w in own), total, base)
    return found


@pytest.mark.parametrize("core", [class_lm.CORE, 50])
def test_query_against_brute_force(spark, monkeypatch, core):
    monkeypatch.setattr(class_lm, "CORE", core)
    monkeypatch.setattr(class_lm, "ROUNDS", 3)
    sf_dir = "/root/testdata/sf0.001"
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    held = lambda d: zlib.crc32(str(d).encode()) % 7 == 2
    want = base_scores(docs, [t for d, t in docs if not held(d)])
    rows = LLM_QUERIES["op8_class_lm"](spark, sf_dir).collect()
    assert len(rows) == len(docs)
    for r in rows:
        n_tokens, n_known, total, base = want[r.doc_id]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held(r.doc_id), n_tokens, n_known, total)
        assert r.base_score == pytest.approx(base) and r.score < 0
    out = [r for r in rows if r.held_out]
    assert sum(r.score for r in out) > 0.97 * sum(r.base_score for r in out)


@pytest.mark.parametrize("core", [class_lm.CORE, 20])
def test_scores_and_that_probabilities_add_up(spark, monkeypatch, core):
    monkeypatch.setattr(class_lm, "CORE", core)
    monkeypatch.setattr(class_lm, "ROUNDS", 2)
    rng = random.Random(3)
    texts = [" ".join(rng.choices([f"w{k}{e}" for k in range(30) for e in ("ing", "ed")], k=rng.randrange(0, 30))) for _ in range(60)]
    train = texts[:40] + [None]
    frame = spark.createDataFrame([(k, t, "x", 1) for k, t in enumerate(texts)], SCHEMA).repartition(3)
    model, counts = learn(spark.createDataFrame([(t,) for t in train], "text string").repartition(2))
    table = {r.word % 2**64: (r.n, r.ending) for r in counts.collect()}
    assert model.total == sum(n for n, _ in table.values()) and model.distinct == len(table)

    def class_of(word, ending):
        known = np.flatnonzero(model.core.words == np.uint64(word))
        own = model.core.types[known[0]] if len(known) else -1
        return model.classes[own if own >= 0 else WORD_TYPES + ending]

    for before in range(CLASSES):
        seen = sum((n + 1) * model.table[before, class_of(w, e)] for w, (n, e) in table.items())
        assert seen + model.table[before].sum() == pytest.approx(1)
    got = {r.doc_id: r.score for r in score(frame.select("doc_id", "text"), model, counts).collect()}
    for k, text in enumerate(texts):
        before, total = class_of(int(END), END_ENDING), 0.0
        for word, ending in hashed(text):
            now = class_of(word, ending)
            total += math.log10((table.get(word, (0, 0))[0] + 1) * model.table[before, now])
            before = now
        assert got[k] == pytest.approx(total)


def likelihood(pairs):
    return entropy_term(pairs).sum() - entropy_term(pairs.sum(axis=0)).sum() - entropy_term(pairs.sum(axis=1)).sum()


def test_exchange_moves_to_the_best_class(monkeypatch):
    monkeypatch.setattr(class_lm, "CLASSES", 5)
    rng = np.random.default_rng(2)
    types = 14
    bigrams = rng.integers(0, 9, (types, types)) * (rng.random((types, types)) < 0.6)

    def pairs_of(classes):
        pairs = np.zeros((5, 5))
        np.add.at(pairs, (classes[:, None].repeat(types, 1), classes[None].repeat(types, 0)), bigrams)
        return pairs

    state = Exchange(rng.integers(0, 5, types), np.zeros((5, 5)))
    state.pairs = pairs_of(state.classes)
    for t in [*range(types), 3, 3]:
        others = np.concatenate([np.arange(types), np.arange(types)])
        sides = np.repeat([1, 0], types)
        n = np.concatenate([bigrams[t], bigrams[:, t]]).astype(float)
        tried = []
        for c in range(5):
            classes = state.classes.copy()
            classes[t] = c
            tried.append(likelihood(pairs_of(classes)))
        state.move(t, others, sides, n)
        assert tried[state.classes[t]] == pytest.approx(max(tried))
        assert state.pairs == pytest.approx(pairs_of(state.classes))


def test_order_of_words_is_learnt(spark):
    """Text of three kinds of words in turn: two of three bits of the base score go."""
    rng = random.Random(1)
    text = lambda: " ".join(f"{rng.choice('abcde')}1 {rng.choice('vwxyz')}2 {rng.choice('mnopq')}3" for _ in range(20))
    model, counts = learn(spark.createDataFrame([(text(),) for _ in range(300)], "text string").repartition(2))
    docs = spark.createDataFrame([(k, text()) for k in range(20)], "doc_id bigint, text string")
    rows = score(docs, model, counts).collect()
    assert sum(r.score for r in rows) > 0.7 * sum(r.base_score for r in rows)


def test_odd_tables(spark):
    rows = [(1, None, "", 0), (2, "", "", 0), (None, "A a", "", 0), (3, "w " * 300_000, "", 0), (2, "", "", 0)]
    docs = spark.createDataFrame(rows, SCHEMA)
    got = score_documents(spark, docs, docs.where("false")).collect()
    assert sorted(r.n_tokens for r in got) == [1, 1, 1, 3, 300_001]
    assert all(r.base_score == 0 and r.n_known == 0 and r.train_tokens == 0 and math.isfinite(r.score) for r in got)
    got = {r.doc_id: r for r in score_documents(spark, docs, docs).collect()}
    assert got[None].n_known == 3 and got[1].score == got[2].score and got[3].n_tokens == 300_001
    assert score_documents(spark, docs.where("false"), docs).count() == 0
