from __future__ import annotations

import random
import zlib

import numpy as np
import pytest
import public_tokenizers
from pyarrow.fs import FileSystem
from tokenizers import Tokenizer

from tidemart.llm.queries import LLM_QUERIES
from tidemart.llm.token_records import OUTSIDE, SPLIT, encoder, frame, read_records, unframe, write_records
from tidemart.session import scratch_dir

PATH = public_tokenizers.path("byte_bpe_50k.json")
SCHEMA = "doc_id bigint, text string, ids string"


def expected_rows(rows):
    tokenizer = Tokenizer.from_file(PATH)
    start, found = 0, []
    for doc_id, text in sorted(rows, key=lambda r: r[0]):
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [0]
        found.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return found


def test_query_matches_whole_text_encoding(spark):
    sf_dir = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    found = [tuple(r) for r in LLM_QUERIES["op7_token_records"](spark, sf_dir).collect()]
    assert sorted(found) == expected_rows([tuple(r) for r in docs])


@pytest.mark.parametrize(
    "text",
    ["", " ", "a  b\n\n c", "x　y \u0085z", "日本語 text", "<|endoftext|> a", "tab\t\tend ", "it's ²½ $$", "é 😀", "\x0b\x1c"],
)
def test_pieces_give_the_ids_of_whole_texts(text):
    whole = Tokenizer.from_file(PATH).encode(text, add_special_tokens=False).ids
    for _ in range(2):
        assert encoder(PATH).encode([text, "a b", text])[2].tolist() == whole


def test_pieces_are_those_of_the_tokenizer():
    """Every allowed character beside every kind of character, and random strings."""
    whole = Tokenizer.from_file(PATH)
    rng = random.Random(3)
    kinds = " \n'sa1.é"
    allowed = [c for c in map(chr, range(0x250)) if not OUTSIDE.search(c)]
    texts = [a + c + b for c in allowed for a in kinds for b in kinds]
    texts += ["".join(rng.choices(" \n\t'stmdrevlaZ1²!$éß", k=9)) for _ in range(4000)]
    cut = [[t for t, _ in whole.pre_tokenizer.pre_tokenize_str(text)] for text in texts]
    for text, pieces in zip(texts, cut):
        assert [len(p.encode()) for p in SPLIT.findall(text)] == [len(p) for p in pieces], text


def test_round_trip_and_shuffled_reads(spark):
    long = "many words " * 50_000
    rows = [(3, "c", "x"), (None, "n", "x"), (1, None, None), (2, long, "x"), (2, long, "x"), (9, "", "x")]
    path = scratch_dir(spark, "records")
    write_records(spark.createDataFrame(rows, SCHEMA).repartition(3), path, PATH)
    found = sorted(read_records(spark, path).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in found] == [None, 1, 2, 2, 3, 9]
    assert [len(r.ids) for r in found] == [r.n_tokens for r in found]
    assert [r.start for r in found] == np.cumsum([0] + [r.n_tokens for r in found])[:-1].tolist()
    assert Tokenizer.from_file(PATH).decode(found[2].ids[:-1]) == long
    once, again, other = (
        [r.start for r in read_records(spark, path, shuffle_seed=s).collect()] for s in (1, 1, 2)
    )
    assert once == again and sorted(once) == sorted(other) and once != other


def test_damage_is_noticed():
    data = frame(7, np.array([5, 6], np.uint32), 2)
    assert unframe(data)[0] == 7
    for k in range(len(data)):
        with pytest.raises(ValueError):
            unframe(data[:k] + bytes([data[k] ^ 1]) + data[k + 1 :])


def test_empty_table(spark):
    path = scratch_dir(spark, "records")
    write_records(spark.createDataFrame([], SCHEMA), path, PATH)
    assert read_records(spark, path, digest=True).count() == 0


def test_unnamed_files_are_never_read(spark):
    path = scratch_dir(spark, "records")
    write_records(spark.createDataFrame([(1, "a", "x")], SCHEMA), path, PATH)
    store, root = FileSystem.from_uri(path)
    with store.open_output_stream(f"{root}/part-000000-lost.records") as out:
        out.write(b"half a record")
    assert [tuple(r)[:3] for r in read_records(spark, path, digest=True).collect()] == [(1, 0, 2)]
