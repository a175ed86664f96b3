"""Values known per distinct token, summed per document: block counts, a bounded dictionary, one join.

Tokens are bytes. A token that makes up at least 1 / `COMMON` of all occurrences is common; there
can be no more than `COMMON` of those, so their values travel as a broadcast dictionary. All other
tokens are rare by definition, so no key of the shuffle join that serves them is hot.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from obsledger.llm.text import U64, mix

COMMON = 500_000
LONGEST_COMMON = 64  # bytes of a token in the dictionary; longer ones always take the join
BLOCK_TOKENS = 500_000  # distinct tokens a task gathers before it hands them on
OUT_ROWS = 200_000
BLOCK_VALUES = 1 << 20  # distinct 64-bit values a task gathers before it hands on their counts
RANGE_BYTES = 8 << 20  # of text per range of hashes when values are counted

_small, _whole = zstandard.ZstdCompressor(level=1).compress, zstandard.ZstdDecompressor().decompress

Tokens = Callable[[bytes], list[bytes]]


def _encoded(column: pa.Array) -> list[bytes]:
    return [b"" if t is None else t for t in column.cast(pa.binary()).to_pylist()]


def token_counts(docs: DataFrame, tokens: Tokens) -> DataFrame:
    """Rows (token, n): occurrences over all whole texts of `docs` (text). Blocks are counted before the shuffle."""

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()

        def out() -> pa.RecordBatch:
            got = pa.RecordBatch.from_arrays([pa.array(seen.keys(), pa.binary()), pa.array(seen.values(), pa.int64())], ["token", "n"])
            seen.clear()
            return got

        for batch in batches:
            for text in _encoded(batch.column(0)):
                seen.update(tokens(text))
                if len(seen) >= BLOCK_TOKENS:
                    yield out()
        if seen:
            yield out()

    counted = docs.select("text").mapInArrow(blocks, "token binary, n bigint")
    return counted.groupBy("token").agg(F.sum("n").alias("n"))


def range_bits(total_bytes: int) -> int:
    """Ranges, as a power of two, among which the values of so much text are counted; their number follows the text."""
    return max(4, int(total_bytes // RANGE_BYTES).bit_length())


def summed(values: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values in order, with the sums of their counts."""
    order = np.argsort(values)
    values, counts = values[order], counts[order]
    starts = np.flatnonzero(np.concatenate(([True], values[1:] != values[:-1])))
    return values[starts], np.add.reduceat(counts, starts)


def hash_ranges(values: np.ndarray, bits: int) -> np.ndarray:
    """The range of each 64-bit value: the first `bits` bits of its hash."""
    return (mix(values) >> U64(64 - bits)).astype(np.uint16 if bits <= 16 else np.uint32)  # the narrow kind sorts faster


def pack(values: np.ndarray) -> bytes:
    """Numbers as bytes, all first bytes before all second ones and so on, compressed: what is sorted or small takes little room."""
    each = np.ascontiguousarray(values).view(np.uint8).reshape(len(values), values.itemsize)
    planes = np.empty(each.shape[::-1], np.uint8)
    for i in range(values.itemsize):  # byte by byte: several times as fast as a transposed copy
        planes[i] = each[:, i]
    return _small(planes)


def unpack(packed: bytes, kind: type) -> np.ndarray:
    size = np.dtype(kind).itemsize
    planes = np.frombuffer(_whole(packed), np.uint8).reshape(size, -1)
    each = np.empty(planes.shape[::-1], np.uint8)
    for i in range(size):
        each[:, i] = planes[i]
    return each.view(kind).ravel()


def packed_ranges(ranges: np.ndarray, *columns: np.ndarray) -> tuple[np.ndarray, list[list[bytes]]]:
    """The ranges that have values, and of each column the packed values of each of them, in the order given."""
    order = np.argsort(ranges, kind="stable")
    ranges = ranges[order]
    starts = np.flatnonzero(np.concatenate(([True], ranges[1:] != ranges[:-1]))) if len(ranges) else np.zeros(0, np.int64)
    ends = np.append(starts[1:], len(ranges))
    out = []
    for column in columns:
        column = column[order]
        out.append([pack(column[a:b]) for a, b in zip(starts.tolist(), ends.tolist())])
    return ranges[starts], out


def unpacked(column: pa.ChunkedArray, kind: type) -> np.ndarray:
    """All packed values of a column, in order."""
    return np.concatenate([np.zeros(0, kind), *[unpack(x, kind) for x in column.to_pylist()]])


def value_counts(
    docs: DataFrame, values: Callable[[pa.Array], Iterator[np.ndarray]], bits: int, counted: Column, ranges: Callable[[np.ndarray], np.ndarray]
) -> DataFrame:
    """Rows (_range, found, counts): how often each 64-bit value comes in what `values` makes of the texts of `docs` (text).

    Only rows with `counted` count; what others alone have is there with 0. Tasks hand on the counts
    of large blocks as packed arrays, one per range of the values' hash; a range is merged in one
    task. A frequent value is one entry per block, so no range is hot. The result is packed again,
    by `ranges` of its values; a value is in one row.
    """

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []

        def out() -> pa.RecordBatch:
            found, counts = summed(np.concatenate([v for v, _ in held]), np.concatenate([n for _, n in held]))
            held.clear()
            filled, columns = packed_ranges(hash_ranges(found, bits), found, counts)
            return pa.RecordBatch.from_arrays([pa.array(filled, pa.int32()), *[pa.array(c, pa.binary()) for c in columns]], ["_range", "found", "counts"])

        size = 0
        for batch in batches:
            for times in (1, 0):
                texts = batch.column("text").filter(pc.equal(batch.column("times"), times))
                for part in values(texts):
                    found, counts = np.unique(part, return_counts=True)
                    held.append((found, counts * times))
                    size += len(found)
                    if size >= BLOCK_VALUES:
                        yield out()
                        size = 0
        if size:
            yield out()

    def merge(group: pa.Table) -> pa.Table:
        found, counts = summed(unpacked(group.column("found"), np.uint64), unpacked(group.column("counts"), np.int64))
        filled, columns = packed_ranges(ranges(found), found, counts)
        return pa.table([pa.array(filled, pa.int32()), *[pa.array(c, pa.binary()) for c in columns]], ["_range", "found", "counts"])

    schema = "_range int, found binary, counts binary"
    return docs.select("text", counted.cast("int").alias("times")).mapInArrow(blocks, schema).groupBy("_range").applyInArrow(merge, schema)


def common_values(values: DataFrame, total: int, most: int = COMMON) -> dict[bytes, tuple[float, float]]:
    """The dictionary of common tokens, from rows (token, n, v, w); at most `most` entries."""
    common = values.where((F.col("n") * F.lit(most) >= F.lit(total)) & (F.octet_length("token") <= LONGEST_COMMON))
    return {bytes(r["token"]): (r["v"], r["w"]) for r in common.select("token", "v", "w").collect()}


def sums_by_document(docs: DataFrame, tokens: Tokens, values: DataFrame, common: dict) -> DataFrame:
    """For each row of `docs` (doc_id, text, further columns) the sums of `v` and `w` over its tokens.

    `values` has a row (token, v, w) per token; tokens it lacks are given to the caller as `missing`,
    their number of occurrences. Result: the columns of `docs` but text, then n_bytes, n_tokens,
    sum_v, sum_w, missing. Repeated rows keep a result each; a null text counts as empty.
    """
    kept = [f for f in docs.schema.fields if f.name != "text"]
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(common)
    numbered = docs.withColumn("_row", F.monotonically_increasing_id())
    names = ["_row", *[f.name for f in kept], "n_bytes", "n_tokens", "_v", "_w", "token", "_n"]
    types = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept)
    schema = f"_row bigint, {types}, n_bytes bigint, n_tokens bigint, _v double, _w double, token binary, _n bigint"

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in batches:
            rows = batch.column("_row").to_pylist()
            texts = _encoded(batch.column("text"))
            sums, owner, token, times = [], [], [], []
            for row, text in zip(rows, texts):
                found = tokens(text)
                v = w = 0.0
                for t, n in Counter(found).items():
                    value = known.get(t)
                    if value is None:
                        owner.append(row), token.append(t), times.append(n)
                    else:
                        v += value[0] * n
                        w += value[1] * n
                sums.append((len(text), len(found), v, w))
                if len(owner) >= OUT_ROWS:
                    yield rare(batch, owner, token, times)
                    owner, token, times = [], [], []
            n_bytes, n_tokens, v, w = zip(*sums) if sums else ((), (), (), ())
            # a document's own row has a key that no token has, spread over all partitions
            keys = [b"\n\n%d" % r for r in rows]
            yield pa.RecordBatch.from_arrays(
                [batch.column("_row"), *[batch.column(f.name) for f in kept], pa.array(n_bytes, pa.int64()), pa.array(n_tokens, pa.int64()),
                 pa.array(v, pa.float64()), pa.array(w, pa.float64()), pa.array(keys, pa.binary()), pa.nulls(len(rows), pa.int64())],
                names,
            )
            if owner:
                yield rare(batch, owner, token, times)

    def rare(batch, owner, token, times) -> pa.RecordBatch:
        n = len(owner)
        none = [pa.nulls(n, batch.schema.field(f.name).type) for f in kept]
        numbers = [pa.nulls(n, t) for t in (pa.int64(), pa.int64(), pa.float64(), pa.float64())]
        return pa.RecordBatch.from_arrays(
            [pa.array(owner, pa.int64()), *none, *numbers, pa.array(token, pa.binary()), pa.array(times, pa.int64())], names
        )

    rows = numbered.mapInArrow(split, schema)
    joined = rows.join(values.select("token", "v", "w"), "token", "left")
    rare_n = F.coalesce("_n", F.lit(0))
    return (
        joined.groupBy("_row")
        .agg(
            *[F.max(f.name).alias(f.name) for f in kept],
            F.max("n_bytes").alias("n_bytes"),
            F.max("n_tokens").alias("n_tokens"),
            F.sum(F.coalesce(F.col("_v"), F.col("v") * rare_n, F.lit(0.0))).alias("sum_v"),
            F.sum(F.coalesce(F.col("_w"), F.col("w") * rare_n, F.lit(0.0))).alias("sum_w"),
            F.sum(F.when(F.col("v").isNull(), rare_n).otherwise(0)).alias("missing"),
        )
        .drop("_row")
    )
