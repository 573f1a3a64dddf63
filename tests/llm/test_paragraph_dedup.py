from __future__ import annotations

import random

import numpy as np
import pyarrow as pa
import pytest

from tests.llm.brute import words
from tidemart.llm.hashing import mix, text_bytes
from tidemart.llm.paragraph_dedup import SHINGLES, STRETCH, ParagraphDedup, Paragraphs, tuned_bands, without
from tidemart.llm.queries import LLM_QUERIES

SCHEMA = "doc_id bigint, text string, node int, start string"


def repeated_runs(docs, size=50):
    """(doc_id, first word) of all runs of ``size`` words that occur in two texts."""
    where = {}
    for doc_id, text in docs:
        w = words(text)
        for k in range(len(w) - size + 1):
            where.setdefault(tuple(w[k : k + size]), set()).add((doc_id, k))
    return {place for places in where.values() if len({d for d, _ in places}) > 1 for place in places}


def covered(rows):
    spans = {}
    for r in rows:
        spans.setdefault(r.doc_id, []).append((r.first_word, r.first_word + r.n_words))
    return spans


@pytest.mark.parametrize("sf_dir", ["/root/testdata/sf0.001", "/root/testdata/sf0.01"])
def test_query_against_all_runs(spark, sf_dir):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    rows = LLM_QUERIES["op6_paragraph_dedup"](spark, sf_dir).collect()
    runs, spans = repeated_runs(docs), covered(rows)
    # Every text with a repeated run is found, and nearly all words of the runs lie in spans.
    inside = {d: {k for low, high in found for k in range(low, high)} for d, found in spans.items()}
    repeated = {(d, j) for d, k in runs for j in range(k, k + 50)}
    assert len(runs) > 100 and {d for d, _ in runs} <= set(spans)
    assert sum(k in inside[d] for d, k in repeated) >= 0.995 * len(repeated)
    # Most shingles of every span occur elsewhere, too.
    texts, where = {d: words(text) for d, text in docs}, {}
    for d, w in texts.items():
        for k in range(len(w) - 4):
            where.setdefault(tuple(w[k : k + 5]), []).append((d, k))
    for r in rows:
        here = [tuple(texts[r.doc_id][k : k + 5]) for k in range(r.first_word, r.first_word + r.n_words - 4)]
        assert len(here) == r.n_words - 4 >= 46 and r.n_equal >= 0.8 * r.n_words
        assert sum(len(where[x]) > 1 for x in here) >= 0.7 * len(here), r
        assert r.kept or (r.doc_id, r.first_word) > (r.keep_doc_id, r.keep_word)


def passage_docs(changes=0, size=55):
    """Unlike texts, some with one of three passages inside longer lines or across line breaks."""
    rng = random.Random(2 + changes)
    vocabulary = [f"w{k}" for k in range(5000)]
    passages = [rng.choices(vocabulary, k=size) for _ in range(3)]
    docs, planted = [], {}
    for k in range(60):
        around = rng.choices(vocabulary, k=rng.randrange(60, 200))
        if k % 3 == 0:
            passage = list(passages[(k // 3) % 3])
            for place in rng.sample(range(25, size - 4), changes):
                passage[place] = rng.choice(vocabulary)
            at = rng.randrange(len(around))
            around[at:at] = passage
            planted[k] = (at, at + size)
        text = "".join(w + ("\n" if rng.random() < 0.1 else "  " if rng.random() < 0.1 else " ") for w in around)
        docs.append((k, text.upper() if k % 5 == 0 else text))
    return docs, planted


@pytest.mark.parametrize("changes,size", [(0, 50), (0, 55), (1, 120), (2, 200)])
def test_passages_inside_lines_and_across_them(spark, changes, size):
    docs, planted = passage_docs(changes, size)
    frame = spark.createDataFrame([(d, t, 1, "x") for d, t in docs], SCHEMA).repartition(3)
    spans = covered(ParagraphDedup(spark, frame).spans().collect())
    # Texts without a passage are left alone.
    assert set(spans) <= set(planted)
    caught = [d for d, (low, high) in planted.items() if any(min(b, high) - max(a, low) >= 45 for a, b in spans.get(d, []))]
    assert len(caught) == len(planted) if not changes else len(caught) >= 0.9 * len(planted)
    for d, found in spans.items():
        assert all(a >= planted[d][0] - 2 and b <= planted[d][1] + 2 for a, b in found)


def test_all_but_the_first_are_removed(spark):
    docs, planted = passage_docs(0, 60)
    frame = spark.createDataFrame([(d, t, 1, "x") for d, t in docs], SCHEMA).repartition(3)
    cleaned = {r.doc_id: r for r in ParagraphDedup(spark, frame).remove_repeats().collect()}
    firsts = {0, 3, 6}
    for d, text in docs:
        own = words(text)
        if d in planted and d not in firsts:
            low, high = planted[d]
            own = own[:low] + own[high:]
            assert abs(len(words(cleaned[d].text)) - len(own)) <= 2
        else:
            assert cleaned[d].text == text
        assert cleaned[d].start == "x" and cleaned[d].node == 1


def test_overlapping_paragraphs_are_one_occurrence(spark):
    rng = random.Random(3)
    passage = [f"q{rng.randrange(10**6)}" for _ in range(1500)]
    docs = [(d, " ".join([f"d{d}", *passage]), 1, "x") for d in range(4)]
    places = Paragraphs(*text_bytes(pa.array([docs[0][1]]))).places
    assert (np.diff(places) == 1).any()
    spans = ParagraphDedup(spark, spark.createDataFrame(docs, SCHEMA)).spans().collect()
    assert len(spans) >= 4 and {r.occurrences for r in spans} == {4}


def test_words_are_cut_from_a_text():
    text = " one  two\nthree four  five "
    assert without(text, [1], [3]) == " one  four  five "
    assert without(text, [0, 1], [2, 4]) == " five "
    assert without(text, [3], [5]) == " one  two\nthree "
    assert without(text, None, None) == text and without(None, [0], [1]) is None


def test_bands_reach_the_recall():
    rng = np.random.default_rng(1)
    bands = tuned_bands(0.8)
    both = Paragraphs.__new__(Paragraphs)
    found = 0
    for _ in range(2000):
        # 16 shingles each, 15 of them shared: a similarity of 0.88.
        every = mix(rng.integers(1, 2**60, SHINGLES + 1).astype(np.uint64))
        both.shingles, both.places = np.stack([every[:SHINGLES], np.append(every[-1], every[1:SHINGLES])], axis=1), np.arange(2)
        values = both.bands(bands)
        found += (values[0] == values[1]).any()
    assert tuned_bands(0.8) == 2 and found >= 0.95 * 2000


def sets_of(texts):
    found = Paragraphs(*text_bytes(pa.array([" ".join(text) for text in texts])))
    # Every stretch of each text as a paragraph.
    starts = [np.arange(a, max(b - STRETCH + 1, a)) for a, b in zip(found.first[:-1], found.first[1:])]
    found.places = np.concatenate(starts)
    found.owner = np.repeat(np.arange(len(starts)), [len(s) for s in starts])
    found.shingles = found.grams[found.places + np.arange(SHINGLES)[:, None]]
    return found, [frozenset(column.tolist()) for column in found.shingles.T]


@pytest.mark.parametrize("letters,num,den", [(3, 80, 100), (9, 80, 100), (400, 80, 100), (3, 50, 100), (400, 50, 100)])
def test_every_similar_pair_shares_a_band(letters, num, den):
    rng = random.Random(letters)
    texts = []
    for _ in range(40):
        text = [f"v{rng.randrange(letters)}" for _ in range(24)]
        if rng.random() < 0.5:
            # Words that go round: shingles come twice, or in another order.
            period = rng.randrange(1, 20)
            text = (text[:period] * 24)[:24]
        other = list(text)
        for _ in range(rng.randrange(3)):
            other[rng.randrange(24)] = f"v{rng.randrange(letters)}"
        turn = rng.randrange(24)
        texts += [text, other, text[turn:] + text[:turn], ["x"] * rng.randrange(3) + other]
    found, sets = sets_of(texts)
    bands = [set() for _ in sets]
    for paragraph, value in zip(*found.keys(num, den)[:2]):
        bands[paragraph].add(int(value))
    similar = 0
    for a in range(len(sets)):
        for b in range(a):
            common = len(sets[a] & sets[b])
            if sets[a] != sets[b] and common * den >= (len(sets[a]) + len(sets[b]) - common) * num:
                similar += 1
                assert bands[a] & bands[b], (a, b)
    assert similar > 20


def test_a_paragraph_that_begins_a_word_later_shares_a_band():
    rng = random.Random(7)
    run = [f"r{k}" for k in range(STRETCH + 1)]
    found, _ = sets_of([run])
    assert set(found.bands(2)[0]) & set(found.bands(2)[1])
    # Of two texts with 19 words in common, each with other words around, the paragraphs there are linked.
    linked = 0
    for trial in range(40):
        middle = [f"m{rng.randrange(10**6)}" for _ in range(STRETCH - 1)]
        found, sets = sets_of([[f"a{trial}", *middle], [*middle, f"b{trial}"]])
        assert len(sets[0] & sets[1]) == SHINGLES - 1
        values = found.bands(2)
        linked += bool(set(values[0]) & set(values[1]))
    assert linked == 40


def test_long_runs_hold_paragraphs():
    rng = random.Random(4)
    passage = [f"p{rng.randrange(10**6)}" for _ in range(47)]
    for trial in range(50):
        texts = [
            " ".join([f"a{rng.random()}" for _ in range(rng.randrange(90))] + passage + [f"b{rng.random()}" for _ in range(90)])
            for _ in range(2)
        ]
        found = Paragraphs(*text_bytes(pa.array(texts)))
        names = found.nodes()[0]
        assert set(names[found.owner == 0]) & set(names[found.owner == 1])


def test_odd_rows(spark):
    line = " ".join(f"word{k}" for k in range(60))
    long = "\n".join([line, "x " * 100_000, line, ""])
    rows = [(1, None, 0, ""), (2, "", 0, None), (None, line, 0, ""), (4, long, 0, ""), (4, long, 0, ""), (3, "\n\n" + line, 0, "")]
    dedup = ParagraphDedup(spark, spark.createDataFrame(rows, SCHEMA))
    found = {(r.doc_id, r.first_word, r.keep_doc_id, r.kept) for r in dedup.spans().collect() if r.n_words == 60}
    assert {(3, 0, 4, True), (None, 0, 3, False), (4, 0, 3, False), (4, 100_060, 3, False)} <= found
    texts = {r.doc_id: r.text for r in dedup.remove_repeats().collect()}
    assert texts[1] is None and texts[2] == "" and texts[None] == "" and texts[3] == "\n\n" + line
    assert "word" not in texts[4] and len(texts[4]) <= 200_002
    assert ParagraphDedup(spark, spark.createDataFrame([], SCHEMA)).spans().count() == 0


def test_stretch_is_shorter_than_the_passages():
    assert STRETCH < 50 // 2
