"""Bounded-space online packing: a fixed number of open windows per partition, leftovers merged in rounds."""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from obsledger.llm.text import text_chunks
from obsledger.llm.word_ids import kept_encoder
from obsledger.session import written

WINDOWS = 32  # open windows of a partition
MERGED = 64  # partitions whose leftovers one task of a round packs again
CHUNK_BYTES = 1 << 20  # of text encoded at a time
OUT_ROWS = 50_000
END_ID = np.ones(1, "<u4")
_NAMES = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "part", "place", "ids"]
_SCHEMA = (
    "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, offset bigint, "
    "part bigint, place bigint, ids binary"
)
RESULT = _NAMES[:7]


class Windows:
    """Open windows of one task: at most `most` of them, each of `capacity` ids.

    A piece goes whole into the window whose gap it fills best. Where none has room, a new window
    is opened, or the fullest one is topped up with the first ids of the piece and emitted, so
    that an emitted window has no padding. `rows` are those of emitted windows.
    """

    def __init__(self, capacity: int, most: int, first_id: int):
        self.capacity, self.most, self.next_id = capacity, most, first_id
        self.gaps: list[tuple[int, int]] = []  # (ids that still fit, window)
        self.open: dict[int, list[tuple]] = {}
        self.opened = 0
        self.rows: list[tuple] = []

    def _emit(self, pieces: list[tuple]) -> None:
        offset = 0
        for doc_id, start, ids, tokens in pieces:
            size = len(ids) >> 2
            self.rows.append((doc_id, start, size, zlib.crc32(ids), tokens, self.next_id, offset, None, None, None))
            offset += size
        self.next_id += 1

    def _put(self, at: int, piece: tuple, size: int) -> None:
        """Into the window at place `at` of the gaps; a window that is full then is emitted."""
        gap, window = self.gaps.pop(at)
        self.open[window].append(piece)
        if gap == size:
            self._emit(self.open.pop(window))
        else:
            insort(self.gaps, (gap - size, window))

    def add(self, doc_id: int | None, start: int, ids: bytes, tokens: int) -> None:
        """Place the packed ids that begin at `start` of a document of `tokens` ids."""
        while ids:
            size = len(ids) >> 2
            if size >= self.capacity:
                cut = self.capacity
                self._emit([(doc_id, start, ids[: 4 * cut], tokens)])
            else:
                cut = size
                at = bisect_left(self.gaps, (size, -1))
                if at == len(self.gaps) and len(self.gaps) < self.most:
                    insort(self.gaps, (self.capacity, self.opened))
                    self.open[self.opened] = []
                    at = bisect_left(self.gaps, (self.capacity, self.opened))
                    self.opened += 1
                elif at == len(self.gaps):  # none fits: the fullest takes what it can
                    at, cut = 0, self.gaps[0][0]
                self._put(at, (doc_id, start, ids[: 4 * cut], tokens), cut)
            start, ids = start + cut, ids[4 * cut :]

    def leftovers(self, part: int) -> list[tuple]:
        """Rows of the pieces in windows that are still open, with their ids, the fullest window first."""
        pieces = [piece for _, window in self.gaps for piece in self.open[window]]
        return [(doc_id, start, len(ids) >> 2, None, tokens, None, None, part, place, ids) for place, (doc_id, start, ids, tokens) in enumerate(pieces)]

    def close(self) -> None:
        """Merge the open windows: full ones by cutting, the last ids in runs of a power of two."""
        pieces = [piece for _, window in self.gaps for piece in self.open[window]]
        total = sum(len(ids) for _, _, ids, _ in pieces) >> 2
        sizes = [self.capacity] * (total // self.capacity)
        sizes += [1 << k for k in reversed(range(self.capacity.bit_length())) if total % self.capacity >> k & 1]
        held: list[tuple] = []
        for size in sizes:
            gap = size
            while gap:
                doc_id, start, ids, tokens = pieces.pop(0)
                cut = min(gap, len(ids) >> 2)
                held.append((doc_id, start, ids[: 4 * cut], tokens))
                if len(ids) > 4 * cut:
                    pieces.insert(0, (doc_id, start + cut, ids[4 * cut :], tokens))
                gap -= cut
            self._emit(held)
            held = []
        self.gaps, self.open = [], {}


def _table(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [()] * len(_NAMES)
    kinds = [pa.int64()] * 9 + [pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], _NAMES)


def _packed(docs: DataFrame, tokenizer_path: str, capacity: int, windows: int) -> DataFrame:
    """First pass: each partition packs what it encodes; rows with `part` are leftovers and hold their ids."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part = kept_encoder(tokenizer_path), TaskContext.get().partitionId()
        held = Windows(capacity, windows, part << 36)
        for batch in batches:
            for low, high in text_chunks(batch.column(1), CHUNK_BYTES):
                found, bounds = encoder.column(batch.column(1).slice(low, high - low))
                for row, doc_id in enumerate(batch.column(0).slice(low, high - low).to_pylist()):
                    ids = np.concatenate((found[bounds[row] : bounds[row + 1]], END_ID))
                    held.add(doc_id, 0, ids.tobytes(), len(ids))
                if len(held.rows) >= OUT_ROWS:
                    yield _table(held.rows)
                    held.rows.clear()
        yield _table(held.rows + held.leftovers(part))

    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(pack, _SCHEMA)


def _merged(left: DataFrame, capacity: int, windows: int, round_no: int, last: bool) -> DataFrame:
    """One round: leftovers of `MERGED` partitions are packed by one task; in the last round nothing stays open."""

    def merge(group: pa.Table) -> pa.Table:
        group = group.sort_by([("part", "ascending"), ("place", "ascending")])
        to = group.column("to")[0].as_py()
        held = Windows(capacity, windows, (1 << 62) + (round_no << 56) + (to << 24))
        for doc_id, start, tokens, ids in zip(*(group.column(c).to_pylist() for c in ("doc_id", "start", "doc_tokens", "ids"))):
            held.add(doc_id, start, ids, tokens)
        if last:
            held.close()
        return pa.Table.from_batches([_table(held.rows + held.leftovers(to))])

    return left.withColumn("to", F.floor(F.col("part") / MERGED)).groupBy("to").applyInArrow(merge, _SCHEMA)


def pack_online(docs: DataFrame, tokenizer_path: str, capacity: int, windows: int = WINDOWS) -> DataFrame:
    """Pack documents (doc_id, text) into sequences of at most `capacity` ids with almost no padding.

    A document is its ids and an end id (1). Every partition keeps `windows` open windows and
    places documents as they come, best fit first; where none fits, the fullest window is
    filled up with the first ids of the document and emitted. What is open at the end of a
    partition, at most `windows` windows, is stored with its ids and merged in the same way:
    `MERGED` partitions to a task, round after round, until one task is left, whose last ids
    become sequences that are powers of two long. Only such sequences are shorter than
    `capacity`, so a power of two needs no padding at all. A document is cut only where it is
    longer than a sequence or tops up a window.

    Rows (doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset), one per piece. Null
    and empty texts are the end id alone; rows with a null id and repeated rows are packed
    each; no rows give no rows; further columns are not used.
    """
    pieces = written(_packed(docs, tokenizer_path, capacity, windows), "windows")
    done = pieces.where("part IS NULL").select(RESULT)
    left, round_no = pieces.where("part IS NOT NULL"), 0
    most = left.agg(F.max("part")).first()[0]
    while most is not None:
        last = most < MERGED
        merged = written(_merged(left, capacity, windows, round_no, last), "windows")
        done = done.unionByName(merged.where("part IS NULL").select(RESULT))
        left, round_no = merged.where("part IS NOT NULL"), round_no + 1
        most = None if last else most // MERGED
    return done
