from __future__ import annotations

import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from tests.llm.brute import jaccard_components, words
from tests.llm.test_decontamination import contaminated
from tests.llm.test_mixing import expected_targets
from tests.llm.test_quality import described
from tidemart.llm.ngram_join import keep_one
from tidemart.llm.quality import Discriminant

SF_DIR = "/root/testdata/sf0.001"


def rows_of(frame):
    return [r.asDict() for r in frame.collect()]


@pytest.fixture(scope="module")
def stages(spark):
    """The rows after each stage."""
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    found = [("documents", docs, docs.columns)]
    for name, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.written(spark, stage(spark, docs, SF_DIR), "test-stage")
        found.append((name, docs, docs.columns))
    return [(name, rows_of(frame), columns) for name, frame, columns in found]


def test_columns(stages):
    assert all(columns == stages[0][2] for _, _, columns in stages[1:5])
    assert stages[5][2] == ["doc_id", "start", "n_tokens", "ids_crc32"]


def test_quality_against_a_model_of_all_rows(spark, stages):
    docs = stages[0][1]
    labels = [(r.doc_id, r.quality) for r in spark.read.parquet(f"{SF_DIR}/labels.parquet").collect()]
    values = dict(zip((d["doc_id"] for d in docs), described([d["text"] for d in docs])))
    moments = {}
    for label in (0, 1):
        own = np.array([values[d] for d, q in labels if q == label and d in values])
        moments[label] = (float(len(own)), own.sum(axis=0), own.T @ own)
    model = Discriminant.fit(moments)
    want = {d["doc_id"] for d in docs if model.score(values[d["doc_id"]][None])[0] >= 0.3}
    assert {d["doc_id"] for d in stages[1][1]} == want
    good = {d for d, q in labels if q}
    assert len(good & want) >= 0.98 * len(good) and len(want) < len(docs)


def test_near_duplicates(stages):
    label = jaccard_components([(d["doc_id"], d["text"]) for d in stages[1][1]])
    assert {d["doc_id"] for d in stages[2][1]} == {c for _, c in label.values()}
    assert len(stages[2][1]) < len(stages[1][1])


def test_decontamination(spark, stages):
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()]
    docs = [(d["doc_id"], d["text"]) for d in stages[2][1]]
    bad = {d for d, _ in contaminated(docs, items)}
    assert {d["doc_id"] for d in stages[3][1]} == {d for d, _ in docs} - bad and bad


def test_mix(stages):
    docs = {d["doc_id"]: d for d in stages[3][1]}
    sizes, taken, times = defaultdict(int), defaultdict(int), Counter()
    for d in docs.values():
        sizes[d["source"]] += len(words(d["text"]))
    cut = 0
    for d in stages[4][1]:
        own = docs[d["doc_id"]]
        times[d["doc_id"]] += 1
        taken[d["source"]] += len(words(d["text"]))
        assert (d["source"], d["lang"]) == (own["source"], own["lang"]) and d["n_chars"] == len(d["text"])
        if d["text"] != own["text"]:
            cut += 1
            assert words(own["text"])[: len(words(d["text"]))] == words(d["text"])
    assert max(times.values()) <= 2 and cut <= len(sizes)
    assert taken == {s: round(t) for s, t in expected_targets(sizes).items()}


def test_token_records(stages):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = Counter()
    for d in stages[4][1]:
        ids = tokenizer.encode(d["text"], add_special_tokens=False).ids + [0]
        want[d["doc_id"], len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())] += 1
    found = sorted(stages[5][1], key=lambda r: r["start"])
    assert Counter((r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in found) == want
    assert [r["start"] for r in found] == np.cumsum([0] + [r["n_tokens"] for r in found])[:-1].tolist()
    assert [r["doc_id"] for r in found] == sorted(r["doc_id"] for r in found)


SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, node int, size string"


@pytest.fixture
def odd_tables(spark, tmp_path):
    spark.read.parquet(f"{SF_DIR}/labels.parquet").write.parquet(str(tmp_path / "labels.parquet"))
    spark.read.parquet(f"{SF_DIR}/benchmark.parquet").write.parquet(str(tmp_path / "benchmark.parquet"))
    return str(tmp_path)


def test_odd_rows_go_through_all_stages(spark, odd_tables):
    long = " ".join(f"w{k}" for k in range(30_000))
    rows = [
        (1, None, None, None, None, 1, None), (2, "", "en", "a", 0, 1, ""), (3, long, "en", "a", 9, 1, ""),
        (4, long + " x", "en", None, 9, 1, ""), (5, "few words here", "en", "b", 9, 1, ""), (5, "few words here", "en", "b", 9, 1, ""),
        (None, "Few words here", "en", "b", 9, 1, ""), (None, "no id at all", "en", "b", 9, 1, ""), (5, "another text", "en", "b", 9, 1, ""),
    ]
    docs = spark.createDataFrame(rows, SCHEMA)
    kept = sorted((r.doc_id or 0, len(r.text or "")) for r in keep_one(spark, docs).collect())
    assert kept == [(0, 12), (1, 0), (2, 0), (3, len(long)), (5, 12)]
    for empty in (False, True):
        frame = docs.where("false") if empty else docs
        for _, stage in corpus_pipeline.STAGES:
            frame = corpus_pipeline.written(spark, stage(spark, frame, odd_tables), "odd-stage")
        assert (frame.count() == 0) == empty


def test_run(spark, stages):
    assert Counter(map(tuple, corpus_pipeline.run(spark, SF_DIR).collect())) == Counter(tuple(r.values()) for r in stages[5][1])
