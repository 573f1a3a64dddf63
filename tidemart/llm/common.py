"""Readers, scratch tables and column rules that the corpus operators share."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from contextvars import ContextVar

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemart.session import scratch_dir

# White space and words as every operator here sees them (fixed values).
BLANKS = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"
BATCH_ROWS = 1000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


_workspace: ContextVar[str | None] = ContextVar("workspace", default=None)


def written(spark: SparkSession, frame: DataFrame, label: str) -> DataFrame:
    """``frame`` as a Parquet table in the shared folder: its lineage is cut there.

    Tasks that are lost later read the files again instead of recomputing what came before. The
    schema is given to the reader, so an empty frame can be read too. Texts go to Python workers a few
    at a time (BATCH_ROWS, set for the session): a batch is held by Spark and by the worker.
    """
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    root = _workspace.get()
    path = f"{root}/{label}-{uuid.uuid4().hex}" if root else scratch_dir(spark, label)
    frame.write.parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def settled(spark: SparkSession, build: Callable[[], DataFrame], label: str) -> DataFrame:
    """The frame that ``build`` makes, as a table of its own; the tables written on the way are deleted.

    Within another ``settled`` the result goes to that one's folder, and goes with it.
    """
    outer = _workspace.get()
    root = scratch_dir(spark, f"{label}-work")
    token = _workspace.set(root)
    try:
        frame = build()
        _workspace.set(outer)
        return written(spark, frame, label)
    finally:
        _workspace.reset(token)
        folder = spark._jvm.org.apache.hadoop.fs.Path(root)
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def fold(doc_id: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``; null for a null id."""
    return F.crc32(doc_id.cast("string").cast("binary")) % folds


def whole_text(text: Column) -> Column:
    """The text, a null one as the empty text."""
    return F.coalesce(text.cast("string"), F.lit(""))
