"""Words, word hashes and shingles of whole Arrow text columns, without a loop over words.

Words are runs of bytes other than space and 0x09-0x0D, with A-Z lower-cased. Hashes are
64 bits wide: a polynomial over the bytes of a word, mixed, then chained over five words.
"""

from __future__ import annotations

import gc
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F

WORDS_PER_SHINGLE = 5
CHUNK_BYTES = 1 << 19  # of text worked on at a time: bounds a worker's memory, not a document
U64 = np.uint64
_BASE = 0x9E3779B97F4A7C15
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_IN_WORD = np.ones(256, dtype=bool)
_IN_WORD[[9, 10, 11, 12, 13, 32]] = False
# Letters, digits and all bytes of other scripts: words without their ASCII punctuation.
ALPHANUMERIC = np.array([b >= 128 or chr(b).isalnum() for b in range(256)])
KEPT: dict = {}  # what a worker keeps from task to task; hashing, which needs the memory, drops it
_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def remainder(doc_id: Column, parts: int) -> Column:
    """crc32 of the id as text, modulo `parts`; 0 for a null id."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")), F.lit(0)) % parts


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values over the whole range; one to one."""
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All UTF-8 bytes of a text column and the n+1 offsets of its rows; null counts as empty."""
    column = column.fill_null("").cast(pa.large_string())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    buffer = column.buffers()[2]
    data = np.frombuffer(buffer, np.uint8) if buffer is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def text_chunks(column: pa.Array, size: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """As `row_chunks`, for a text column that need not be copied for it; null counts as empty."""
    lengths = pc.binary_length(column).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    return row_chunks(np.concatenate(([0], np.cumsum(lengths))), size)


def row_chunks(offsets: np.ndarray, size: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of about `size` bytes; a longer row makes a range of its own."""
    start, rows = 0, len(offsets) - 1
    while start < rows:
        end = int(np.searchsorted(offsets, offsets[start] + size, side="right")) - 1
        end = min(rows, max(end, start + 1))
        yield start, end
        start = end


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the hash base and of its inverse, at least `n` of each."""
    if len(_powers[0]) < n:
        size = 1 << int(n).bit_length()
        for i, base in enumerate((_BASE, pow(_BASE, -1, 1 << 64))):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _powers[i] = np.cumprod(steps, dtype=np.uint64)
    return _powers[0], _powers[1]


def forget() -> None:
    """Give back what the worker keeps."""
    if KEPT:
        KEPT.clear()
        gc.collect()
        pa.default_memory_pool().release_unused()


def prefix_hashes(data: np.ndarray) -> np.ndarray:
    """Running sums from which `span_hashes` takes the hash of any span of bytes."""
    forget()
    up, _ = powers(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + U64(1)) * up[: len(data)], out=sums[1:])
    return sums


def span_hashes(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    _, down = powers(len(sums))
    return mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def words(
    data: np.ndarray, offsets: np.ndarray, in_word: np.ndarray = _IN_WORD
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Lower-cased bytes, then start, end and row of each word; a word never spans two rows."""
    data = _LOWER[data]
    inside = in_word[data]
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    begin = offsets[:-1][offsets[:-1] < len(data)]
    first[begin] |= inside[begin]
    end = offsets[1:][offsets[1:] > 0] - 1
    last[end] |= inside[end]
    starts = np.flatnonzero(first)
    return data, starts, np.flatnonzero(last) + 1, np.searchsorted(offsets, starts, side="right") - 1


def word_hashes(
    data: np.ndarray, offsets: np.ndarray, in_word: np.ndarray = _IN_WORD
) -> tuple[np.ndarray, np.ndarray]:
    """Row and 64-bit hash of each word, in reading order."""
    lowered, starts, ends, rows = words(data, offsets, in_word)
    return rows, span_hashes(prefix_hashes(lowered), starts, ends)


def shingles(rows: np.ndarray, hashes: np.ndarray, n: int, width: int = WORDS_PER_SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Row and hash of every run of `width` words; a row with fewer words is one run as a whole."""
    counts = np.bincount(rows, minlength=n)
    starts = np.concatenate(([0], np.cumsum(counts)))
    short = np.flatnonzero((counts > 0) & (counts < width))
    out_rows, out = [], []
    if len(hashes) >= width:
        chained = hashes[: len(hashes) - width + 1]
        for i in range(1, width):
            chained = mix(chained * U64(0xD6E8FEB86659FD93) + hashes[i : len(hashes) - width + 1 + i])
        whole = rows[: len(chained)] == rows[width - 1 :]
        out_rows.append(rows[: len(chained)][whole])
        out.append(chained[whole])
    if len(short):
        chained = np.zeros(len(short), np.uint64)
        for i in range(width - 1):
            more = counts[short] > i
            at = starts[short[more]] + i
            chained[more] = mix(chained[more] * U64(0xD6E8FEB86659FD93) + hashes[at])
        out_rows.append(short)
        out.append(mix(chained + counts[short].astype(np.uint64)))
    if not out:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    return np.concatenate(out_rows), np.concatenate(out)


def shingle_sets(column: pa.Array, width: int = WORDS_PER_SHINGLE) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """For row ranges of a text column: first row, end row, then row and hash of each distinct shingle.

    The hashes of a row are in ascending order; rows are counted from the first one of the range.
    """
    data, offsets = text_bytes(column)
    for start, end in row_chunks(offsets, CHUNK_BYTES // 2):  # hashes take many times the text's bytes
        part = data[offsets[start] : offsets[end]]
        rows, hashes = word_hashes(part, offsets[start : end + 1] - offsets[start])
        rows, hashes = shingles(rows, hashes, end - start, width)
        order = np.lexsort((hashes, rows))
        rows, hashes = rows[order], hashes[order]
        new = np.ones(len(rows), bool)
        new[1:] = (rows[1:] != rows[:-1]) | (hashes[1:] != hashes[:-1])
        yield start, end, rows[new], hashes[new]
