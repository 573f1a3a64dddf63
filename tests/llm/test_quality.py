from __future__ import annotations

import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from tidemart.llm.hashing import text_blocks
from tidemart.llm.quality import STATISTICS, Discriminant, class_moments, quality, statistics
from tidemart.llm.queries import LLM_QUERIES

DOCS = "doc_id bigint, text string, statistics string, score int"
LABELS = "doc_id bigint, quality int, toxic int"


def described(texts):
    batch = pa.RecordBatch.from_arrays([pa.array(texts, pa.string())], names=["text"])
    return np.concatenate([statistics(data, offsets) for _, data, offsets in text_blocks(batch)])


def plain_statistics(text):
    """Some statistics counted the plain way."""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lower = [w.lower() for w in words]
    angle = lambda part, whole: np.arcsin(np.sqrt(part / whole))
    runs = Counter(zip(lower, lower[1:], lower[2:]))
    return {
        "words": np.log1p(len(words)),
        "distinct_words": np.log((len(set(lower)) + 8) / (len(words) + 8)),
        "doubled_words": angle(sum(a == b for a, b in zip(lower, lower[1:])), len(words) + 8),
        "top_word": angle(max(Counter(lower).values(), default=1) - 1, len(words) + 8),
        "repeated_runs": angle(sum(n - 1 for n in runs.values()), len(words) + 8),
        "capitals": angle(len(re.findall("[A-Z]", text)), len(re.findall("[A-Za-z]", text)) + 40),
        "digits": angle(len(re.findall("[0-9]", text)), len(text.encode()) + 40),
        "lines": angle(text.count("\n"), len(text.encode()) + 40),
    }


def test_statistics_of_each_text_alone():
    texts = ["One two", "two One one ONE!! x9", "", None, "  \n", "Straße | | a&& a&&", "b", "a b c a b c a b c\n1"]
    rows = described(texts)
    for text, row in zip(texts, rows):
        for name, value in plain_statistics(text or "").items():
            assert row[STATISTICS.index(name)] == pytest.approx(value), (text, name)
        assert described([text])[0] == pytest.approx(row)
    assert np.isfinite(rows).all() and (rows[2] == rows[3]).all()


def test_scores_are_those_of_two_normal_distributions():
    rng = np.random.default_rng(4)
    size = len(STATISTICS)
    groups = {0: rng.normal(0, 2, (300, size)), 1: rng.normal(0.5, 1, (500, size))}
    moments = {k: (float(len(v)), v.sum(axis=0), v.T @ v) for k, v in groups.items()}
    model = Discriminant.fit(moments, 0.2)
    both = np.concatenate([groups[0], groups[1]])
    z = lambda v: (v - both.mean(axis=0)) / both.std(axis=0)
    logs = []
    for k, v in groups.items():
        s = np.cov(z(v).T, bias=True)
        s = 0.8 * s + 0.2 * np.trace(s) / size * np.eye(size)
        away = z(both[:50]) - z(v).mean(axis=0)
        distance = np.einsum("ij,jk,ik->i", away, np.linalg.inv(s), away)
        logs.append(-0.5 * (distance + np.linalg.slogdet(s)[1]) + np.log(len(v) / 800))
    assert model.score(both[:50]) == pytest.approx(1 / (1 + np.exp(logs[0] - logs[1])))


def test_query_on_held_out_documents(spark):
    sf_dir = "/root/testdata/sf0.1"
    rows = LLM_QUERIES["op4_quality"](spark, sf_dir).collect()
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    assert len(rows) == spark.read.parquet(f"{sf_dir}/documents.parquet").count()
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
        assert r.predicted == int(r.score >= 0.3) and 0 <= r.score <= 1
    held = [(r.predicted, labels[r.doc_id]) for r in rows if r.held_out and r.doc_id in labels]
    good, bad = [p for p, q in held if q], [p for p, q in held if not q]
    assert np.mean(good) > 0.98 and np.mean(bad) < 0.03


def test_odd_tables(spark):
    long = "Word! " * 200_000
    docs = spark.createDataFrame(
        [(1, None, "", 0), (2, "", "", 0), (2, "", "", 0), (None, "a b", "", 0), (3, long, None, None)], DOCS
    )
    scores, model = quality(spark, docs, spark.createDataFrame([], LABELS))
    assert [r.score for r in scores.collect()] == [0.5] * 5 and model.means is None
    labels = spark.createDataFrame([(1, 1, 0), (3, None, 0), (None, 0, 0), (99, 0, 0), (2, 7, 0)], LABELS)
    assert {r.score for r in quality(spark, docs, labels)[0].collect()} == {1.0}
    same = spark.createDataFrame([(1, 1, 0), (2, 0, 0), (1, 1, 0)], LABELS)
    assert all(0 <= r.score <= 1 for r in quality(spark, docs, same)[0].collect())
    assert quality(spark, spark.createDataFrame([], DOCS), labels)[0].count() == 0


def test_moments_do_not_depend_on_partitions(spark):
    rows = [(list(map(float, np.arange(len(STATISTICS)) * k)), k % 2) for k in range(20)]
    frame = spark.createDataFrame(rows, "statistics array<double>, label bigint")
    one, many = class_moments(frame.repartition(1)), class_moments(frame.repartition(7))
    assert one[1][0] == many[1][0] == 10 and one[0][2] == pytest.approx(many[0][2])
