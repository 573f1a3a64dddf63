from __future__ import annotations

import itertools
import random
import re
import string
import time

import pytest
from pyspark.sql import functions as F

from tidemart.llm.decontamination import ALLOWED, MASKS, SHORT_ALLOWED, SHORTEST, WINDOW, decontaminate, overlaps
from tidemart.llm.queries import LLM_QUERIES

DOCS = "doc_id bigint, text string, item_id string, tokens int"
ITEMS = "item_id bigint, text string, doc_id string"
TOKEN = re.compile(r"[a-z0-9\u0080-\U0010ffff]+")
FOLD = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


def tolerance(size):
    if size >= WINDOW:
        return ALLOWED
    return next((d for least, d in SHORT_ALLOWED if size >= least), None)


def contaminated(docs, items):
    """All alignments of all pairs, window by window."""
    found = set()
    cut = lambda text: TOKEN.findall((text or "").translate(FOLD))
    items = [(i, cut(t)) for i, t in items]
    for doc_id, text in docs:
        own = cut(text)
        for item_id, theirs in items:
            window = min(WINDOW, len(theirs))
            if tolerance(window) is None or (doc_id, item_id) in found:
                continue
            for shift in range(window - len(theirs), len(own) - window + 1):
                equal = [0 <= q + shift < len(own) and own[q + shift] == t for q, t in enumerate(theirs)]
                inside = [0 <= q + shift < len(own) for q in range(len(theirs))]
                if any(
                    all(inside[k : k + window]) and sum(equal[k : k + window]) >= window - tolerance(window)
                    for k in range(len(theirs) - window + 1)
                ):
                    found.add((doc_id, item_id))
                    break
    return found


def test_masks_hit_whatever_differs():
    for size in range(SHORTEST, WINDOW + 1):
        for bad in itertools.combinations(range(size), tolerance(size)):
            assert any(
                not any(b - at in mask for b in bad) for mask in MASKS for at in range(size - mask[-1])
            ), (size, bad)


@pytest.mark.parametrize("sf_dir", ["/root/testdata/sf0.001", "/root/testdata/sf0.01"])
def test_query_matches_brute_force_on_exact_windows(spark, sf_dir):
    """On the given tables: the same items as a search for shared runs finds, and the planted ones."""
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    got = {(r.doc_id, r.item_id) for r in LLM_QUERIES["op3_decontamination"](spark, sf_dir).collect()}
    near = {}
    for item_id, text in items:
        w = TOKEN.findall(text.translate(FOLD))
        for k in range(len(w) - 4):
            near.setdefault(tuple(w[k : k + 5]), set()).add(item_id)
    expected = set()
    for doc_id, text in docs:
        w = TOKEN.findall(text.translate(FOLD))
        seen = set().union(*(near.get(tuple(w[k : k + 5]), ()) for k in range(len(w) - 4)))
        expected |= contaminated([(doc_id, text)], [(i, t) for i, t in items if i in seen])
    assert got == expected and got


def test_substitutions_against_brute_force(spark):
    rng = random.Random(8)
    vocabulary = [f"v{k}" for k in range(60)]
    items = [(k, " ".join(rng.choices(vocabulary, k=size))) for k, size in enumerate((3, 7, 8, 9, 11, 12, 13, 14, 17, 19, 20, 21, 30, 45))]
    docs = []
    for turn in range(150):
        words = rng.choices(vocabulary, k=rng.randrange(0, 40))
        item = rng.choice(items)[1].split()
        for _ in range(rng.randrange(0, 5)):
            item[rng.randrange(len(item))] = rng.choice(["Changed", "V1", "v2"])
        item = item[rng.randrange(0, 3) :] if turn % 3 == 0 else item
        glue = rng.choice([" ", ", ", "\n", " - "])
        docs.append((turn, glue.join(words + item + rng.choices(vocabulary, k=rng.randrange(0, 10))).upper()))
    frame = spark.createDataFrame([(d, t, "x", 0) for d, t in docs], DOCS).repartition(3)
    found = overlaps(spark, frame, spark.createDataFrame([(i, t, "x") for i, t in items], ITEMS)).collect()
    expected = contaminated(docs, items)
    assert {(r.doc_id, r.item_id) for r in found} == expected and len(expected) > 40
    kept = decontaminate(spark, frame, spark.createDataFrame([(i, t, "x") for i, t in items], ITEMS))
    assert kept.columns == frame.columns
    assert {r.doc_id for r in kept.collect()} == {d for d, _ in docs} - {d for d, _ in expected}


def test_odd_rows(spark):
    item = " ".join(f"tok{k}" for k in range(30))
    docs = [(1, None, None, 0), (2, "", "", 0), (3, item, "", 0), (3, item, "", 0), (None, item, "", 0), (None, "clean text", "", 0), (4, "word " * 200_000 + item, "", 0), (3, "other text", "", 0)]
    items = [(7, item, ""), (8, item, ""), (None, item + " x", ""), (9, None, ""), (10, "", "")]
    frame, bench = spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, ITEMS)
    found = overlaps(spark, frame, bench)
    assert {(r.doc_id, r.item_id) for r in found.collect()} == {(d, i) for d in (3, 4, None) for i in (7, 8, None)}
    assert {r.doc_start for r in found.where("doc_id = 4").collect()} == {200_000}
    kept = sorted(str(r.text) for r in decontaminate(spark, frame, bench).collect())
    assert kept == ["", "None", "clean text", "other text"]
    none = spark.createDataFrame([], ITEMS)
    assert decontaminate(spark, frame, none).count() == len(docs)
    assert overlaps(spark, spark.createDataFrame([], DOCS), bench).count() == 0


def test_time_grows_with_the_length_of_one_text(spark):
    """A text of one word 60,000 times, an item of the same word, and one text that holds many items again and again."""
    items = [(1, "same " * 30)] + [(k, " ".join(f"w{k}x{j}" for j in range(40))) for k in range(2, 30)]
    many = " ".join(text for _, text in items[1:]) * 40
    docs = spark.createDataFrame([(1, "same " * 60_000), (2, many), (3, "other words " * 50)], "doc_id bigint, text string")
    start = time.perf_counter()
    found = overlaps(spark, docs, spark.createDataFrame(items, "item_id bigint, text string"))
    counts = {(r.doc_id, r.item_id): r.n for r in found.groupBy("doc_id", "item_id").agg(F.count("*").alias("n")).collect()}
    assert time.perf_counter() - start < 60
    assert counts[1, 1] >= 60_000 - 30 and all(counts[2, k] == 40 for k in range(2, 30)) and len(counts) == 29
