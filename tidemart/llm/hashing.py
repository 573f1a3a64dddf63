"""Word and shingle hashes of many texts at once, straight from Arrow's buffers.

A text is its UTF-8 bytes; letters A-Z are folded to lower case. Words are cut at ASCII characters
only, so cutting bytes is the same as cutting characters. The hash of a word is a polynomial over
random 64-bit values of its bytes, taken from running sums, then mixed. All of it is array work over
blocks of half a megabyte, which keeps the arrays beside them small.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

BLOCK_BYTES = 1 << 19
BASE = 0x9E3779B97F4A7C15
INVERSE = pow(BASE, -1, 1 << 64)


def mix(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser: every bit of the result depends on every bit of ``x``."""
    x = x.astype(np.uint64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def powers(base: int, count: int) -> np.ndarray:
    """base**0, base**1, ... modulo 2**64."""
    found = np.full(count, base, np.uint64)
    found[:1] = 1
    return np.multiply.accumulate(found)


def lower_bytes(letters_only: bool) -> np.ndarray:
    """Byte -> folded byte, 0 where words are cut.

    Words are cut at blanks and control white space; with ``letters_only`` at all ASCII characters that
    are neither letters nor digits.
    """
    table = np.arange(256, dtype=np.uint8)
    table[65:91] += 32
    table[[0x20, *range(0x09, 0x0E)]] = 0
    if letters_only:
        keep = np.zeros(256, bool)
        keep[128:] = keep[48:58] = keep[65:91] = keep[97:123] = True
        table[~keep] = 0
    else:
        table[0] = 1
    return table


WORDS = lower_bytes(False)
LETTERS = lower_bytes(True)
BYTE_VALUES = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(BASE))
_powers = {"up": powers(BASE, 1), "down": powers(INVERSE, 1)}


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """A string column's bytes and the n + 1 offsets of its texts; nulls are empty texts."""
    column = column.fill_null("") if column.null_count else column
    wide = pa.types.is_large_string(column.type)
    offsets = np.frombuffer(column.buffers()[1], np.int64 if wide else np.int32)
    offsets = offsets[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def text_blocks(batch: pa.RecordBatch, column: str = "text") -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """The batch in slices of about BLOCK_BYTES of text: slice, bytes, offsets."""
    if not batch.num_rows:
        return
    data, offsets = text_bytes(batch.column(batch.schema.get_field_index(column)))
    first = 0
    while first < batch.num_rows:
        last = int(np.searchsorted(offsets, offsets[first] + BLOCK_BYTES, "right")) - 1
        last = min(max(last, first + 1), batch.num_rows)
        start = offsets[first]
        yield batch.slice(first, last - first), data[start : offsets[last]], offsets[first : last + 1] - start
        first = last


def word_spans(data: np.ndarray, offsets: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Folded bytes, starts and ends of all words, and per text the number of its first word (n + 1)."""
    folded = table[data]
    inside = folded != 0
    opens = inside.copy()
    opens[1:] &= ~inside[:-1]
    closes = inside.copy()
    closes[:-1] &= ~inside[1:]
    # Neighbouring texts touch in the buffer: a word ends where its text ends.
    edges = np.unique(offsets[1:-1])
    edges = edges[(edges > 0) & (edges < len(data))]
    opens[edges] = inside[edges]
    closes[edges - 1] = inside[edges - 1]
    starts = np.flatnonzero(opens)
    ends = np.flatnonzero(closes) + 1
    return folded, starts, ends, np.searchsorted(starts, offsets)


def span_hashes(folded: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of stretches of folded bytes."""
    if len(_powers["up"]) < len(folded) + 1:
        _powers["up"] = powers(BASE, max(len(folded) + 1, BLOCK_BYTES + 1))
        _powers["down"] = powers(INVERSE, max(len(folded) + 1, BLOCK_BYTES + 1))
    sums = np.zeros(len(folded) + 1, np.uint64)
    np.cumsum(BYTE_VALUES[folded] * _powers["up"][: len(folded)], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * _powers["down"][starts])


def word_hashes(data: np.ndarray, offsets: np.ndarray, table: np.ndarray = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of all words in order, and per text the number of its first word (n + 1)."""
    folded, starts, ends, first = word_spans(data, offsets, table)
    return span_hashes(folded, starts, ends), first


def gram_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """Hashes of all runs of ``size`` words; runs that cross texts are the caller's to leave out."""
    if len(words) < size:
        return np.zeros(0, np.uint64)
    total = np.zeros(len(words) - size + 1, np.uint64)
    for k in range(size):
        total = total * np.uint64(BASE) + words[k : len(words) - size + 1 + k]
    return mix(total)


def shingle_sets(words: np.ndarray, first: np.ndarray, size: int) -> list[np.ndarray]:
    """Per text the sorted distinct hashes of its ``size``-word shingles.

    A text with fewer words has its whole sequence as one shingle; without words it has none.
    """
    grams = gram_hashes(words, size)
    found = []
    for start, end in zip(first[:-1], first[1:]):
        if end - start >= size:
            found.append(np.unique(grams[start : end - size + 1]))
        elif end > start:
            total = np.array([end - start], np.uint64)
            for word in words[start:end]:
                total = mix(total * np.uint64(BASE) + word)
            found.append(total)
        else:
            found.append(np.zeros(0, np.uint64))
    return found


def signed(x: np.ndarray) -> np.ndarray:
    """Unsigned hashes as Spark's bigint, bit for bit."""
    return np.ascontiguousarray(x, np.uint64).view(np.int64)
