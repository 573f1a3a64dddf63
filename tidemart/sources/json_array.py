"""One large JSON array of objects, read by many tasks.

Spark reads a multi-line JSON file in one task. Here files are read as text that ends at each ``}``, which Spark splits
over tasks like any text. Whether a brace, bracket or quote counts depends on all that comes before it, so a
first pass works out for each split how it changes the state (in a string or not, and how deep), for both states
that it may begin in; the states that splits really begin in follow from one short row per split. A second
pass cuts the splits into elements, and the parts of elements that lie across splits are put together.

Elements must be objects; others are left out. An array that ends too early gives nulls for its last element.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

ESCAPE = re.compile(r"\\.", re.S)
WHOLE, HEAD, MIDDLE, TAIL = range(4)


def step(text: str, in_string: bool) -> tuple[bool, int]:
    """The state after a piece of JSON, and by how much it goes deeper; ``}`` is not in it but in strings."""
    parts = ESCAPE.sub("", text).split('"')
    outside = "".join(parts[1 if in_string else 0 :: 2])
    deeper = outside.count("{") + outside.count("[") - outside.count("]")
    return in_string ^ (len(parts) % 2 == 0), deeper


def split_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, int, str]]:
    for batch in batches:
        yield from zip(*(batch.column(k).to_pylist() for k in range(3)))


def split_steps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``(file, at, end_0, deeper_0, end_1, deeper_1)``: how each split changes both states."""
    found: dict[tuple[str, int], list] = {}
    for file, at, text in split_rows(batches):
        states = found.setdefault((file, at), [False, 0, True, 0])
        for k in (0, 2):
            states[k], deeper = step(text, states[k])
            # The brace that ended the piece closes something unless it is in a string.
            states[k + 1] += deeper - (not states[k])
    columns = list(zip(*((*key, *states) for key, states in found.items()))) or [()] * 6
    types = (pa.string(), pa.int64(), pa.bool_(), pa.int64(), pa.bool_(), pa.int64())
    names = ["file", "at", "end_0", "deeper_0", "end_1", "deeper_1"]
    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=names)


class Cutter:
    """Cuts the pieces of one split into elements."""

    def __init__(self, in_string: bool, depth: int):
        self.in_string, self.depth = in_string, max(depth - 1, 0)
        self.inside = self.began_inside = depth > 1
        self.parts: list[str] = []

    def take(self, text: str) -> tuple[int, str] | None:
        """The element, or the head of the split, that ends with this piece."""
        if not self.inside:
            start = text.find("{")
            if start < 0:
                return None
            text, self.inside, self.depth, self.in_string = text[start:], True, 0, False
        self.in_string, deeper = step(text, self.in_string)
        self.depth += deeper - (not self.in_string)
        self.parts += [text, "}"]
        if self.in_string or self.depth > 0:
            return None
        found = (HEAD if self.began_inside else WHOLE, "".join(self.parts))
        self.inside = self.began_inside = False
        self.parts = []
        return found

    def rest(self) -> tuple[int, str] | None:
        """What the split ends in the middle of."""
        return (MIDDLE if self.began_inside else TAIL, "".join(self.parts)) if self.inside else None


def json_elements(spark: SparkSession, path: str) -> DataFrame:
    """``(element)``: the objects of all arrays in the files under ``path``, as text."""
    pieces = spark.read.option("lineSep", "}").text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("at"), "value"
    )
    schema = "file string, at bigint, end_0 boolean, deeper_0 bigint, end_1 boolean, deeper_1 bigint"
    begins: dict[tuple[str, int], tuple[bool, int]] = {}
    last = None
    # One short row per split.
    for row in pieces.mapInArrow(split_steps, schema).orderBy("file", "at").collect():
        if row.file != last:
            in_string, depth, last = False, 0, row.file
        begins[row.file, row.at] = (in_string, depth)
        depth += row.deeper_1 if in_string else row.deeper_0
        in_string = row.end_1 if in_string else row.end_0
    known = spark.sparkContext.broadcast(begins)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["file", "at", "kind", "text"]
        rows: list[tuple] = []
        key, cutter = None, None
        for file, at, text in split_rows(batches):
            if (file, at) != key:
                if cutter and (found := cutter.rest()):
                    rows.append((*key, *found))
                key = (file, at)
                cutter = Cutter(*known.value[key])
            if found := cutter.take(text):
                rows.append((*key, *found))
            if len(rows) >= 1000:
                yield _batch(rows, names)
                rows = []
        if cutter and (found := cutter.rest()):
            rows.append((*key, *found))
        yield _batch(rows, names)

    parts = pieces.mapInArrow(cut, "file string, at bigint, kind int, text string")
    whole = parts.where(F.col("kind") == WHOLE).select(F.col("text").alias("element"))
    in_order = Window.partitionBy("file").orderBy("at", "kind")
    across = parts.where(F.col("kind") != WHOLE).withColumn("nth", F.count_if(F.col("kind") == TAIL).over(in_order))
    across = across.groupBy("file", "nth").agg(F.sort_array(F.collect_list(F.struct("at", "kind", "text"))).alias("parts"))
    return whole.union(across.select(F.array_join("parts.text", "").alias("element")))


def array_lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The lines of one array of the given elements, in their order; no more than a batch is held."""
    before = "["
    for batch in batches:
        if batch.num_rows:
            marks = pa.array([before] + [","] * (batch.num_rows - 1))
            before = ","
            yield pa.RecordBatch.from_arrays([pc.binary_join_element_wise(marks, batch.column(0).cast(pa.string()), "")], names=["line"])
    yield pa.RecordBatch.from_arrays([pa.array(["]" if before == "," else "[]"])], names=["line"])


def write_json_array(elements: DataFrame, path: str) -> None:
    """Write JSON texts, the frame's only column, as one file with a single array.

    Many tasks make the elements; the one that writes the file takes them as they come, without sorting or keeping them.
    """
    elements.repartition(1).mapInArrow(array_lines, "line string").write.text(path)


def _batch(rows: list[tuple], names: list[str]) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [()] * 4
    types = (pa.string(), pa.int64(), pa.int32(), pa.string())
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=names)


def json_array_scan(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The objects of JSON arrays as rows; a file is read by as many tasks as its size gives."""
    return json_elements(spark, path).select(F.inline(F.array(F.from_json("element", schema))))
