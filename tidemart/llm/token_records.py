"""Token ids in files of length-delimited binary records, with a separate offset index.

A record file is a run of frames, each holding one document (all numbers little-endian):

    u64 payload length | u32 masked CRC-32 of those 8 bytes | payload | u32 masked CRC-32 of it

and a payload is ``u8 has_id, i64 doc_id, u8 width, u32 count`` followed by ``count`` unsigned ids of
``width`` bytes (2 where the vocabulary allows it, else 4). The index is a Parquet table next to the
files, one row per record: file, offset, length, doc_id, n_tokens and the tokens before it. A reader
may take index rows in any order and seek, so shuffled epochs need no rewrite of the data.

Documents are range-partitioned and sorted by id before they are encoded, so the files in order of
their number hold the documents in order. A task writes its file under a name of its own attempt and
its index rows go through Spark's committer: a file counts only if the index names it, so lost or
speculative attempts leave nothing that is ever read.

Cases: a null text is the empty text and gives just the end id; null ids come first; rows that repeat
an id are ordered by their text's hash; an empty table gives an empty index. Texts are encoded whole.
Columns other than doc_id and text are ignored.
"""

from __future__ import annotations

import re
import struct
import uuid
import zlib
from collections.abc import Iterator
from functools import cached_property, lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyarrow.fs import FileSystem
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer, pre_tokenizers

from tidemart.llm.common import whole_text

INDEX_SCHEMA = (
    "doc_id bigint, file string, file_no int, offset bigint, length bigint, n_tokens bigint,"
    " start_in_file bigint"
)
RECORD_SCHEMA = "doc_id bigint, start bigint, n_tokens bigint, ids array<bigint>"

# The usual masking of stored checksums.
MASK_DELTA = 0xA282EAD8
# How byte-level BPE cuts texts (contractions, letters, numbers, other signs, white space;
# a last blank goes with what follows), written out for the characters that PLAIN allows.
LETTERS = "A-Za-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-\u024f"
NUMBERS = "0-9\xb2\xb3\xb9\xbc-\xbe"
WHITE = "\t\n\r "
SPLIT = re.compile(
    rf" ?[{LETTERS}]+|'(?:[stmd]|re|ve|ll)| ?[{NUMBERS}]+| ?[^{WHITE}{LETTERS}{NUMBERS}]+"
    rf"|[{WHITE}]+(?![^{WHITE}])|[{WHITE}]+"
)
# Only in this range do all Unicode versions agree on what letters, numbers and white space are.
OUTSIDE = re.compile("[^\t\n\r\x20-\x7e\xa1-\u024f]")
LENGTH = struct.Struct("<Q")
CHECK = struct.Struct("<I")
HEADER = struct.Struct("<BqBI")
BLOCK_DOCS = 512
CACHED_PIECES = 500_000


def masked_crc(data: bytes) -> int:
    crc = zlib.crc32(data)
    return (((crc >> 15) | (crc << 17)) + MASK_DELTA) & 0xFFFFFFFF


class PieceNumbers(dict):
    """Numbers pieces as they are first seen and remembers which are new."""

    def __init__(self):
        super().__init__()
        self.new: list[str] = []

    def __missing__(self, piece: str) -> int:
        number = self[piece] = len(self)
        self.new.append(piece)
        return number


class Encoder:
    """Encodes texts with a tokenizer file, each distinct piece of text once.

    Byte-level BPE never merges across the pieces that its pattern cuts, so a text's ids are those of
    its pieces in order. The cache is emptied when it is full, which bounds its memory. Vocabularies of
    another kind, and texts with rarer characters, are encoded as a whole.
    """

    def __init__(self, tokenizer_path: str):
        self.path = tokenizer_path
        self.pieces = Tokenizer.from_file(tokenizer_path)
        self.vocabulary = self.pieces.get_vocab_size()
        kind = self.pieces.pre_tokenizer
        self.by_piece = (
            isinstance(kind, pre_tokenizers.ByteLevel)
            and not kind.add_prefix_space
            and kind.use_regex
            and self.pieces.normalizer is None
        )
        if self.by_piece:
            self.pieces.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self.special = [token.content for token in self.pieces.get_added_tokens_decoder().values()]
        self.forget()

    @cached_property
    def whole(self) -> Tokenizer:
        """The tokenizer as it is in its file, made only if a text needs it."""
        return Tokenizer.from_file(self.path)

    def forget(self) -> None:
        self.numbers = PieceNumbers()
        self.ids = np.zeros(1 << 16, np.uint32)
        self.first = np.zeros(1 << 14, np.int64)
        self.count = np.zeros(1 << 14, np.int64)
        self.used = 0

    def learn(self) -> None:
        new, self.numbers.new = self.numbers.new, []
        if not new:
            return
        coded = self.pieces.encode(new, is_pretokenized=True, add_special_tokens=False)
        ids = np.array(coded.ids, np.uint32)
        counts = np.bincount(np.array(coded.word_ids, np.int64), minlength=len(new))
        known = len(self.numbers) - len(new)
        while len(self.count) < len(self.numbers):
            self.count, self.first = (np.concatenate([x, np.zeros_like(x)]) for x in (self.count, self.first))
        while len(self.ids) < self.used + len(ids):
            self.ids = np.concatenate([self.ids, np.zeros_like(self.ids)])
        self.ids[self.used : self.used + len(ids)] = ids
        self.count[known : known + len(new)] = counts
        self.first[known : known + len(new)] = self.used + np.cumsum(counts) - counts
        self.used += len(ids)

    def plain(self, text: str) -> bool:
        return self.by_piece and not OUTSIDE.search(text) and not any(token in text for token in self.special)

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of each text."""
        if len(self.numbers) > CACHED_PIECES:
            self.forget()
        plain = [k for k, text in enumerate(texts) if self.plain(text)]
        found: list[np.ndarray] = [np.zeros(0, np.uint32)] * len(texts)
        split = [SPLIT.findall(texts[k]) for k in plain]
        sizes = [len(pieces) for pieces in split]
        numbers = np.fromiter(map(self.numbers.__getitem__, chain.from_iterable(split)), np.int64, sum(sizes))
        self.learn()
        counts = self.count[numbers]
        ends = np.cumsum(counts)
        total = int(ends[-1]) if len(ends) else 0
        flat = self.ids[np.repeat(self.first[numbers] - (ends - counts), counts) + np.arange(total)]
        bounds = np.concatenate([[0], ends])[np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)]
        for k, start, end in zip(plain, bounds, bounds[1:]):
            found[k] = flat[start:end]
        for k in sorted(set(range(len(texts))) - set(plain)):
            found[k] = np.array(self.whole.encode(texts[k], add_special_tokens=False).ids, np.uint32)
        return found


@lru_cache(maxsize=2)
def encoder(tokenizer_path: str) -> Encoder:
    """One per Python worker, which serves many tasks."""
    return Encoder(tokenizer_path)


def frame(doc_id: int | None, ids: np.ndarray, width: int) -> bytes:
    payload = HEADER.pack(doc_id is not None, doc_id or 0, width, len(ids)) + ids.astype(f"<u{width}").tobytes()
    length = LENGTH.pack(len(payload))
    return b"".join((length, CHECK.pack(masked_crc(length)), payload, CHECK.pack(masked_crc(payload))))


def unframe(data: bytes) -> tuple[int | None, np.ndarray]:
    """A record's id and token ids; raises if a checksum does not hold."""
    (size,) = LENGTH.unpack_from(data, 0)
    payload = data[12:-4]
    if (
        CHECK.unpack_from(data, 8)[0] != masked_crc(data[:8])
        or size != len(payload)
        or CHECK.unpack_from(data, len(data) - 4)[0] != masked_crc(payload)
    ):
        raise ValueError("damaged record")
    has_id, doc_id, width, count = HEADER.unpack_from(payload, 0)
    return doc_id if has_id else None, np.frombuffer(payload, f"<u{width}", count, HEADER.size).astype(np.uint32)


def write_records(
    docs: DataFrame, path: str, tokenizer_path: str, end_id: int | None = 0
) -> None:
    """Encode ``(doc_id, text)`` rows into record files and an index under the new folder ``path``.

    ``path`` is a URI that every executor can write to (``file:`` on a shared mount, or a store that
    Arrow opens). ``end_id`` is put after each document.
    """

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(tokenizer_path)
        width = 2 if coder.vocabulary <= 1 << 16 else 4
        tail = np.array([] if end_id is None else [end_id], np.uint32)
        file_no = TaskContext.get().partitionId()
        name = f"part-{file_no:06d}-{uuid.uuid4().hex}.records"
        store, root = FileSystem.from_uri(path)
        out, offset, start = None, 0, 0
        for batch in batches:
            for k in range(0, batch.num_rows, BLOCK_DOCS):
                block = batch.slice(k, BLOCK_DOCS).to_pydict()
                rows = []
                for doc_id, ids in zip(block["doc_id"], coder.encode(block["text"])):
                    ids = np.concatenate([ids, tail])
                    data = frame(doc_id, ids, width)
                    out = out or store.open_output_stream(f"{root}/{name}")
                    out.write(data)
                    rows.append((doc_id, name, file_no, offset, len(data), len(ids), start))
                    offset, start = offset + len(data), start + len(ids)
                columns = [pa.array(c, t) for c, t in zip(zip(*rows), INDEX_TYPES)]
                yield pa.RecordBatch.from_arrays(columns, names=INDEX_NAMES)
        if out:
            out.close()

    store, root = FileSystem.from_uri(path)
    store.create_dir(root, recursive=True)
    text_hash = F.xxhash64("text")
    ordered = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), whole_text(F.col("text")).alias("text"))
    ordered = ordered.repartitionByRange("doc_id", text_hash).sortWithinPartitions("doc_id", text_hash)
    ordered.mapInArrow(encoded, INDEX_SCHEMA).write.parquet(f"{path}/index")


INDEX_NAMES = ["doc_id", "file", "file_no", "offset", "length", "n_tokens", "start_in_file"]
INDEX_TYPES = [pa.int64(), pa.string(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64()]


def record_index(spark: SparkSession, path: str) -> DataFrame:
    """The offset index, with ``start``: the tokens of all documents before it.

    Only one sum per file goes through the ordered window.
    """
    rows = spark.read.schema(INDEX_SCHEMA).parquet(f"{path}/index")
    sums = rows.groupBy("file_no").agg(F.sum("n_tokens").alias("file_tokens"))
    before = Window.orderBy("file_no").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select(
        "file_no", F.coalesce(F.sum("file_tokens").over(before), F.lit(0)).alias("file_start")
    )
    return rows.join(starts, "file_no").withColumn("start", F.col("file_start") + F.col("start_in_file"))


def read_records(
    spark: SparkSession, path: str, digest: bool = False, shuffle_seed: int | None = None
) -> DataFrame:
    """The records, by way of the index: doc_id, start, n_tokens and the ids.

    With ``digest`` the ids are given as ``ids_crc32``, the CRC-32 of them as 32-bit numbers. With
    ``shuffle_seed`` the records come in a random order that the seed fixes; otherwise each task reads
    a stretch of a file from front to back.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = FileSystem.from_uri(path)
        name, source = None, None
        for batch in batches:
            for k in range(0, batch.num_rows, BLOCK_DOCS):
                block = batch.slice(k, BLOCK_DOCS).to_pydict()
                ids_of, counts, last = [], [], []
                for file, offset, length in zip(block["file"], block["offset"], block["length"]):
                    if file != name:
                        if source:
                            source.close()
                        name, source = file, store.open_input_file(f"{root}/{file}")
                    doc_id, ids = unframe(source.read_at(length, offset))
                    ids_of.append(doc_id)
                    counts.append(len(ids))
                    last.append(zlib.crc32(ids.astype("<u4").tobytes()) if digest else ids.astype(np.int64))
                last = pa.array(last, pa.int64() if digest else pa.list_(pa.int64()))
                columns = [pa.array(ids_of, pa.int64()), pa.array(block["start"], pa.int64()), pa.array(counts, pa.int64()), last]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "start", "n_tokens", "ids_crc32" if digest else "ids"])
        if source:
            source.close()

    index = record_index(spark, path).select("file", "offset", "length", "start")
    if shuffle_seed is None:
        index = index.repartition("file", F.expr("offset div 8388608")).sortWithinPartitions("file", "offset")
    else:
        index = index.orderBy(F.xxhash64(F.lit(shuffle_seed), "file", "offset"), "file", "offset")
    schema = RECORD_SCHEMA.replace("ids array<bigint>", "ids_crc32 bigint") if digest else RECORD_SCHEMA
    return index.mapInArrow(read, schema)
