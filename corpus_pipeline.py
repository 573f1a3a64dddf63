"""From raw documents to a training set on disk: corpus operators in a row.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir) and returns a frame, which
``run`` writes as Parquet in the shared folder and reads again as the next one's docs. All but the last
return the columns of their docs.

1. quality: rows with a score below ACCEPTED go. The discriminant learns from all labels of the docs.
2. near_duplicates: of each component of 5-word-shingle similarity 0.8 one row stays, that of the
   smallest doc_id.
3. decontamination: rows that hold a benchmark item go.
4. mix: sources are mixed to the target weights; a row comes once for each round that takes words of
   it, cut only where its source's share ends. Rows without words are not in the mix.
5. token_records: the mix as token records; returns what is read back from them (doc_id, start,
   n_tokens, ids_crc32).

Cases: null and empty texts are judged like any other by quality, stay in 2 and 3, and have nothing to
mix. Rows with a null id stay in 2 unless linked with a row that has one; of rows that repeat id and
text one stays. Extra columns pass through the first four stages. Empty tables give an empty result.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tidemart.llm.common import table, written
from tidemart.llm.decontamination import decontaminate
from tidemart.llm.mixing import Mix
from tidemart.llm.ngram_join import keep_one
from tidemart.llm.quality import quality, with_score
from tidemart.llm.token_records import read_records, write_records
from tidemart.session import scratch_dir

ACCEPTED = 0.3
TOKENIZER = "byte_bpe_50k.json"
SCORE = "pipeline_quality_score"


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that the discriminant does not reject."""
    _, model = quality(spark, docs, table(spark, sf_dir, "labels"))
    return with_score(docs, model, SCORE).where(f"{SCORE} >= {ACCEPTED}").drop(SCORE)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near copies."""
    return keep_one(spark, docs, size=5, num=80, den=100)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows without benchmark items."""
    return decontaminate(spark, docs, table(spark, sf_dir, "benchmark"))


def mix_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix of the sources."""
    return Mix(spark, docs).documents()


def token_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token records of the mix, read back."""
    path = scratch_dir(spark, "training-records")
    write_records(docs, path, public_tokenizers.path(TOKENIZER))
    return read_records(spark, path, digest=True)


STAGES = [
    ("quality", quality_stage),
    ("near_duplicates", near_duplicate_stage),
    ("decontamination", decontamination_stage),
    ("mix", mix_stage),
    ("token_records", token_stage),
]

# A discriminant, exact similarity and a tokenizer are beyond SQL; the tests compare with plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(spark, stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
