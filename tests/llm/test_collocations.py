from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from tests.comparing import connect, normalised, spark_rows, sql_rows
from tests.llm.brute import FOLD
from tidemart.llm.collocations import WINDOW, Collocations, Words, collocations, cut_chunks
from tidemart.llm.hashing import text_bytes
from tidemart.llm.queries import LLM_ORACLES, LLM_QUERIES

PIECES = re.compile("[.,;:!?\n-\r]")
WORD = re.compile("[^ \t]+")
# The last columns clash with names that the operator uses itself.
SCHEMA = "doc_id bigint, text string, lang string, chunk int, times string, n bigint"


def phrases(text):
    for piece in PIECES.split((text or "").translate(FOLD)):
        words = WORD.findall(piece)
        for size in range(1, 6):
            for k in range(len(words) - size + 1):
                yield tuple(words[k : k + size])


def plain(rows, min_count, keep_ratio, best):
    counts = defaultdict(Counter)
    for text, lang in rows:
        counts["und" if lang is None else lang].update(phrases(text))
    found = []
    for lang, f in counts.items():
        n = sum(a for phrase, a in f.items() if len(phrase) == 1)
        candidates = {phrase: a for phrase, a in f.items() if len(phrase) > 1 and a >= min_count}
        kept = []
        for phrase, a in candidates.items():
            if any(
                100 * b >= keep_ratio * a
                for longer, b in candidates.items()
                if len(longer) > len(phrase)
                and any(longer[k : k + len(phrase)] == phrase for k in range(len(longer) - len(phrase) + 1))
            ):
                continue
            score, k = min((1000 * a * n // (f[phrase[:k]] * f[phrase[k:]]), k) for k in range(1, len(phrase)))
            text = " ".join(phrase)
            kept.append((-score, -a, text.encode(), text, a, f[phrase[:k]], f[phrase[k:]], n))
        for rank, (score, _, _, text, a, left, right, n) in enumerate(sorted(kept)[:best], 1):
            found.append((lang, rank, text, a, left, right, n, -score))
    return sorted(found)


def found(spark, rows, min_count=3, keep_ratio=100, best=2000):
    frame = spark.createDataFrame([(k, t, lang, 1, "x", 2) for k, (t, lang) in enumerate(rows)], SCHEMA).repartition(3)
    return sorted(tuple(r) for r in collocations(spark, frame, min_count, keep_ratio, best).collect())


@pytest.mark.parametrize("sf_dir", ["/root/testdata/sf0.001", "/root/testdata/sf0.01"])
def test_query_matches_sql(spark, sf_dir):
    got = spark_rows(LLM_QUERIES["op11_collocations"](spark, sf_dir))
    assert normalised(*got) == normalised(*sql_rows(connect(sf_dir), LLM_ORACLES["op11_collocations"]))
    assert sf_dir.endswith("001") or len(got[1]) > 50


def mixed_rows():
    rng = random.Random(5)
    letters = "abcdefgh"
    texts = []
    for _ in range(300):
        words = [rng.choice(letters) + (rng.choice("  .,\n\t") if rng.random() < 0.2 else "") for _ in range(rng.randint(0, 60))]
        texts.append(" ".join(words))
    copied = " ".join(rng.choice(letters) + rng.choice(letters) for _ in range(400))
    return [(t, rng.choice(["en", "de", None, "und"])) for t in texts] + [(copied, "en")] * 5 + [(copied[7:] + " x", "en")] * 4


ODD = [
    (None, "en"),
    ("", "en"),
    (" .,; \n", "fr"),
    ("Él est É́l Straße STRASSE", "fr"),
    ("a\x00b a\x01b a\x00b\x0ba\x1fb", "fr"),
    ("same " * 3000, "rep"),
    ("one\ttwo  three; one two\tthree! one two three", "en"),
] + [("語 日本 語", None)] * 4


@pytest.mark.parametrize("min_count,keep_ratio,best", [(3, 100, 2000), (2, 60, 7), (20, 100, 5)])
def test_against_brute_force(spark, min_count, keep_ratio, best):
    rows = mixed_rows() + ODD
    expected = plain(rows, min_count, keep_ratio, best)
    assert found(spark, rows, min_count, keep_ratio, best) == expected and expected


def test_empty(spark):
    assert found(spark, []) == found(spark, [(None, None), ("", "en"), ("a b", "en")]) == []


def test_chunks_own_every_word_once(spark):
    rng = random.Random(1)
    text = " ".join(rng.choice("abcdefghijklmnop") * 2 for _ in range(5000)) + ". End, of it"
    texts = ["", "x", text, "", text[: len(text) // 2], "a b c d e"]
    words = Words(*text_bytes(pa.array(texts)))
    begins, ends, last = cut_chunks(words)
    owned = ends - np.where(last, 0, WINDOW)
    assert begins[0] == 0 and owned[-1] == len(words) and (owned[:-1] == begins[1:]).all() and len(begins) > 100
    assert last.sum() == 4
    # Neighbours share WINDOW words; the same text is cut in the same places.
    spelled, at = words.spelled()
    chunks = [spelled[a:b] for a, b in zip(at[begins], at[ends] - 1)]
    first = [c for c, b in zip(chunks, begins) if words.first[2] <= b < words.first[3]]
    again = [c for c, b in zip(chunks, begins) if words.first[4] <= b < words.first[5]]
    assert first[: len(again) - 1] == again[:-1]
    assert all(x.split()[-WINDOW:] == y.split()[:WINDOW] for x, y in zip(first, first[1:]))


def test_copies_are_counted_as_one_chunk(spark):
    rng = random.Random(2)
    text = " ".join(rng.choice("abcdefghijklmnop") * 3 for _ in range(2000))
    once, often = (
        Collocations(spark, spark.createDataFrame([(text, "en")] * n, "text string, lang string")).dictionary()
        for n in (1, 50)
    )
    assert once.count() == often.count() > 20
    assert often.where("times % 50 = 0").count() == often.count()


def test_products_beyond_64_bits(spark):
    schema = "lang string, phrase string, size int, f bigint"
    big = 4_000_000_000_000
    counts = spark.createDataFrame([("x", "a b", 2, big), ("x", "a", 1, big + 1), ("x", "b", 1, big + 7)], schema)
    totals = spark.createDataFrame([("x", 10 * big)], "lang string, n bigint")
    row = Collocations(spark, spark.createDataFrame([], SCHEMA)).scored(counts, totals).first()
    assert row.score == 1000 * big * 10 * big // ((big + 1) * (big + 7)) == 9999
