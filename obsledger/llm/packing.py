"""Exact-complement packing of token sequences: decided on the histogram of lengths, dealt by rank."""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from obsledger.llm.text import text_chunks
from obsledger.llm.word_ids import kept_encoder
from obsledger.session import written

ROWS_PER_BUCKET = 200_000
CHUNK_BYTES = 1 << 20  # of text encoded at a time
END_ID = np.zeros(1, "<u4")


def token_pieces(docs: DataFrame, tokenizer_path: str, capacity: int) -> DataFrame:
    """Rows (doc_id, piece, start, length, ids_crc32): each text's ids and an end id, cut at `capacity`."""
    names = ["doc_id", "piece", "start", "length", "ids_crc32"]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = kept_encoder(tokenizer_path)
        for batch in batches:
            out = []
            for low, high in text_chunks(batch.column(1), CHUNK_BYTES):
                found, bounds = encoder.column(batch.column(1).slice(low, high - low))
                for row, doc_id in enumerate(batch.column(0).slice(low, high - low).to_pylist()):
                    ids = np.concatenate((found[bounds[row] : bounds[row + 1]], END_ID)).tobytes()
                    for piece, start in enumerate(range(0, len(ids), 4 * capacity)):
                        part = ids[start : start + 4 * capacity]
                        out.append((doc_id, piece, start // 4, len(part) // 4, zlib.crc32(part)))
            columns = list(zip(*out)) or [()] * 5
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    return rows.mapInArrow(cut, "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint")


class _Stock:
    """Lengths still to be placed, with an index of the sums that one, two or three of them make."""

    def __init__(self, counts: dict[int, int], capacity: int):
        self.left = np.zeros(capacity + 1, np.int64)
        for length, n in counts.items():
            self.left[length] = n
        self.index()

    def index(self) -> None:
        """Sums of pairs and triples, as bits; later removals only make it too large, never too small."""
        keep = (1 << len(self.left)) - 1
        self.stale = 0
        self.pairs = self.triples = 0
        lengths = [int(x) for x in np.flatnonzero(self.left)]
        singles = sum(1 << x for x in lengths)
        for x in lengths:
            self.pairs |= (singles << x) & keep
        for x in lengths:
            self.triples |= (self.pairs << x) & keep

    def pair(self, total: int, taken: int = 0) -> list[int] | None:
        """Two lengths of that sum, the longer first and as long as can be; `taken` is in use once."""
        if total < 2 or not self.pairs >> total & 1:
            return None
        left = self.left
        if taken:
            left = left.copy()
            left[taken] -= 1
        first = np.arange(total - 1, (total - 1) // 2, -1)
        first = first[first < len(left)]
        second = total - first
        fits = (left[first] > 0) & (left[second] > 0) & ((first != second) | (left[first] > 1))
        at = int(fits.argmax()) if len(fits) else 0
        return [int(first[at]), int(second[at])] if len(fits) and fits[at] else None

    def fill(self, gap: int) -> list[int] | None:
        """One, two or three lengths that fill `gap` exactly."""
        if gap < len(self.left) and self.left[gap] > 0:
            return [gap]
        two = self.pair(gap)
        if two:
            return two
        if self.triples >> gap & 1:
            for a in np.flatnonzero(self.left[: gap - 1])[::-1]:
                two = self.pair(gap - int(a), int(a))
                if two:
                    return [int(a), *two]
        return None

    def take(self, lengths: list[int], times: int) -> None:
        for x in lengths:
            self.left[x] -= times
            self.stale += self.left[x] == 0
        if self.stale >= 16:
            self.index()


def packing_plan(counts: dict[int, int], capacity: int) -> list[tuple[list[int], int]]:
    """Patterns (lengths in one sequence, number of such sequences) that place all `counts`.

    From the longest length down, sequences are completed exactly by one, two or three other
    lengths, as often as the stock allows. What finds no exact complement is placed by
    best-fit decreasing, where bins of equal content are one group. At most `capacity`
    different lengths exist, so the work does not grow with the number of rows.
    """
    stock, done, rest = _Stock(counts, capacity), [], {}
    for length in sorted(counts, reverse=True):
        while stock.left[length] > 0:
            if length == capacity:
                others: list[int] | None = []
            else:
                stock.left[length] -= 1
                others = stock.fill(capacity - length)
                stock.left[length] += 1
            if others is None:
                rest[length] = int(stock.left[length])
                break
            pattern = [length, *others]
            times = min(int(stock.left[x]) // pattern.count(x) for x in pattern)
            stock.take(pattern, times)
            done.append((pattern, times))
    rest = {x: int(stock.left[x]) for x in rest if stock.left[x] > 0}
    gaps: list[int] = []
    bins: dict[int, list[tuple[list[int], int]]] = {}

    def put(pattern: list[int], n: int) -> None:
        gap = capacity - sum(pattern)
        if not bins.get(gap):
            insort(gaps, gap)
        bins.setdefault(gap, []).append((pattern, n))

    for length in sorted(rest, reverse=True):
        n = rest[length]
        while n:
            at = bisect_left(gaps, length)
            if at == len(gaps):
                each = capacity // length
                if n >= each:
                    put([length] * each, n // each)
                if n % each:
                    put([length] * (n % each), 1)
                break
            gap = gaps[at]
            pattern, m = bins[gap].pop()
            if not bins[gap]:
                gaps.pop(at)
            k = min(m, n)
            n -= k
            put([*pattern, length], k)
            if m > k:
                put(pattern, m - k)
    return done + [group for gap in gaps for group in bins[gap]]


def _runs(plan: list[tuple[list[int], int]]) -> tuple[np.ndarray, ...]:
    """For each place of each pattern: length and first rank, its sequences and offset; sorted."""
    used: dict[int, int] = {}
    runs, base = [], 0
    for pattern, times in plan:
        offset = 0
        for x in pattern:
            runs.append((x, used.get(x, 0), base, offset))
            used[x] = used.get(x, 0) + times
            offset += x
        base += times
    runs.sort()
    lengths, first, bases, offsets = (np.array(c, np.int64) for c in zip(*runs)) if runs else [np.zeros(0, np.int64)] * 4
    return (lengths << 44) + first, first, bases, offsets


def pack_documents(docs: DataFrame, tokenizer_path: str, capacity: int) -> DataFrame:
    """Pack documents (doc_id, text) into few sequences of at most `capacity` tokens.

    A document is its ids and an end id; only one that is longer is cut. Only the number of
    pieces of each length, at most `capacity` numbers, reaches the driver, where the plan is
    made. Pieces of one length are alike to the plan: each gets its rank among them, counted in
    hashed buckets so that a length that holds a third of all rows is spread, and the rank
    says sequence and offset. Null and empty texts are the end id alone; repeated rows are
    packed each; no rows give no rows; further columns are not used.
    """
    pieces = written(token_pieces(docs, tokenizer_path, capacity), "pieces")
    counts = {r["length"]: r["count"] for r in pieces.groupBy("length").count().collect()}
    buckets = -(-sum(counts.values()) // ROWS_PER_BUCKET) or 1
    pieces = pieces.withColumn("_bucket", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(buckets)).cast("int"))
    before = Window.partitionBy("length").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    shifts = pieces.groupBy("length", "_bucket").count().select(
        "length", "_bucket", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_shift")
    )
    within = F.row_number().over(Window.partitionBy("length", "_bucket").orderBy("doc_id", "piece"))
    ranked = pieces.withColumn("_rank", within).join(shifts, ["length", "_bucket"])
    ranked = ranked.withColumn("_rank", F.col("_rank") - 1 + F.col("_shift")).drop("_bucket", "_shift")
    keys, first, bases, offsets = _runs(packing_plan(counts, capacity))
    out = ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, rank = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("length", "_rank"))
            at = np.searchsorted(keys, (length << 44) + rank, side="right") - 1
            placed = [pa.array(bases[at] + rank - first[at], pa.int64()), pa.array(offsets[at], pa.int64())]
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in out[:5]], *placed], out)

    return ranked.mapInArrow(
        place, "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, sequence_id bigint, offset bigint"
    )
