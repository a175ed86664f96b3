"""Improbable-feature digests: rare byte windows in chained Bloom filters, compared by bit overlap."""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from obsledger.llm.sharding import range_of
from obsledger.llm.text import U64, prefix_hashes, row_chunks, span_hashes, text_bytes

WINDOW = 64  # bytes of a feature
SPAN = 64  # neighbouring windows of which the rarest gets a vote
VOTES = 16  # that make a window a feature
CLASSES = 1000  # of entropy
LEAST_CLASS = 100  # windows of less entropy say nothing
FILTER_BITS, HASHES, PER_FILTER = 2048, 5, 160
ALPHA = 0.3  # share of the way from chance to full overlap that counts as none
FEW = 6  # elements below which a filter is not compared if there are others
BLOCK = 1 << 17  # bytes at a time, so that the work stays in the processor's cache
CHUNK = 1 << 20
BUCKET_BYTES, MOST_BUCKETS, SAMPLES = 64 << 20, 20_000, 64

_k = np.arange(WINDOW + 1)
_LOG = np.round(np.where(_k > 0, _k * np.log2(np.maximum(_k, 1)), 0) * 65536).astype(np.int64)
_MOST = int(_LOG[WINDOW])
_GAIN = np.diff(_LOG)  # of one more of the same byte


def _same_around(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """How often each byte comes again in the 63 places after it, and came in the 63 before it."""
    after, before = np.zeros(len(data), np.uint8), np.zeros(len(data), np.uint8)
    for low in range(0, len(data), BLOCK):
        part = data[low : low + BLOCK + WINDOW - 1]
        own = min(BLOCK, len(data) - low)
        for lag in range(1, min(WINDOW, len(part))):
            same = (part[lag:] == part[:-lag]).view(np.uint8)
            after[low : low + min(own, len(same))] += same[:own]
            before[low + lag : low + lag + min(own, len(same))] += same[:own]
    return after, before


def entropy_classes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start of each window inside a text, and its entropy from 0 to `CLASSES`; whole-number arithmetic."""
    sizes = np.diff(offsets)
    n = np.maximum(sizes - WINDOW + 1, 0)
    has = np.flatnonzero(n)
    if not len(has):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    after, before = _same_around(data)
    change = np.zeros(len(data) + 1, np.int64)  # from the window at s to the one at s + 1
    change[1 : len(data) - WINDOW + 1] = _GAIN[before[WINDOW:]] - _GAIN[after[: len(data) - WINDOW]]
    sums = np.cumsum(change)
    first = offsets[:-1][has]
    heads = data[first[:, None] + np.arange(WINDOW)].astype(np.int64) + (np.arange(len(has)) * 256)[:, None]
    counts = np.bincount(heads.ravel(), minlength=256 * len(has)).reshape(-1, 256)
    base = _LOG[counts].sum(1) - sums[first]
    starts = np.repeat(first - np.cumsum(n[has]) + n[has], n[has]) + np.arange(n.sum())
    repeats = sums[starts] + np.repeat(base, n[has])
    return starts, (_MOST - repeats) * CLASSES // _MOST


def class_ranks(counts: np.ndarray) -> np.ndarray:
    """Rank of each entropy class, 0 for the rarest in the corpus; classes below `LEAST_CLASS` have none (-1)."""
    order = np.lexsort((np.arange(CLASSES + 1), counts))
    ranks = np.empty(CLASSES + 1, np.int64)
    ranks[order] = np.arange(CLASSES + 1)
    ranks[:LEAST_CLASS] = -1
    return ranks


def select_features(data: np.ndarray, offsets: np.ndarray, ranks: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, start and end of each feature, in order of place.

    Of any `SPAN` neighbouring windows the first one of the rarest class gets a vote; windows
    with `VOTES` votes are features, or else the first with the most. A text without a window
    that counts is one feature as a whole; an empty text has none.
    """
    rows = len(offsets) - 1
    starts, classes = entropy_classes(data, offsets)
    n = np.maximum(np.diff(offsets) - WINDOW + 1, 0)
    row = np.repeat(np.arange(rows), n)
    rank = ranks[classes] if len(classes) else classes
    first = np.concatenate(([0], np.cumsum(n)))
    votes = np.zeros(len(starts), np.int64)
    if len(starts):
        wide = len(starts) >= 1 << 21
        kind, shift = (np.uint64, 40) if wide else (np.uint32, 21)
        key = (np.where(rank < 0, CLASSES + 1, rank).astype(kind) << kind(shift)) + np.arange(len(starts), dtype=kind)
        low = key.copy()
        step = 1
        while step < SPAN:
            low[: len(low) - step] = np.minimum(low[: len(low) - step], low[step:])
            step *= 2
        whole = np.arange(len(starts)) + SPAN <= first[row + 1]
        winners = low[whole]
        few = np.flatnonzero((n > 0) & (n < SPAN))
        if len(few):
            cuts = np.stack([first[few], first[few + 1]], 1).ravel()
            cuts = cuts[:-1] if cuts[-1] == len(key) else cuts
            winners = np.concatenate((winners, np.minimum.reduceat(key, cuts)[::2]))
        winners = winners[(winners >> kind(shift)) <= CLASSES]
        votes = np.bincount((winners & kind((1 << shift) - 1)).astype(np.int64), minlength=len(starts))
    enough = votes >= VOTES
    served = np.zeros(rows, bool)
    served[row[enough]] = True
    voted = np.flatnonzero((votes > 0) & ~served[row])
    if len(voted):
        order = voted[np.lexsort((voted, -votes[voted], row[voted]))]
        best = order[np.concatenate(([True], row[order][1:] != row[order][:-1]))]
        enough[best] = True
        served[row[best]] = True
    alone = np.flatnonzero(~served & (np.diff(offsets) > 0))
    out_row = np.concatenate((row[enough], alone))
    out_start = np.concatenate((starts[enough], offsets[:-1][alone]))
    out_end = np.concatenate((starts[enough] + WINDOW, offsets[1:][alone]))
    order = np.lexsort((out_start, out_row))
    return out_row[order], out_start[order], out_end[order]


Digest = list[tuple[int, int]]  # elements and bits of each filter


def digests(data: np.ndarray, offsets: np.ndarray, ranks: np.ndarray) -> list[Digest]:
    """For each text its chain of filters; equal features count once, in order of their first place."""
    rows = len(offsets) - 1
    row, starts, ends = select_features(data, offsets, ranks)
    hashes = span_hashes(prefix_hashes(data), starts, ends)
    order = np.lexsort((np.arange(len(row)), hashes, row))
    new = np.ones(len(row), bool)
    new[1:] = (row[order][1:] != row[order][:-1]) | (hashes[order][1:] != hashes[order][:-1])
    kept = np.sort(order[new])
    row, hashes = row[kept], hashes[kept]
    counts = np.bincount(row, minlength=rows)
    place = np.arange(len(row)) - (np.cumsum(counts) - counts)[row]
    filters = -(-counts // PER_FILTER)
    first = np.concatenate(([0], np.cumsum(filters)))
    at = first[row] + place // PER_FILTER
    bits = np.zeros((first[-1], FILTER_BITS), bool)
    for i in range(HASHES):
        bits[at, ((hashes >> U64(11 * i)) & U64(FILTER_BITS - 1)).astype(np.int64)] = True
    packed = np.packbits(bits, axis=1, bitorder="little")
    elements = np.bincount(at, minlength=first[-1])
    chains = [(int(e), int.from_bytes(b.tobytes(), "little")) for e, b in zip(elements, packed)]
    return [chains[first[i] : first[i + 1]] for i in range(rows)]


def as_text(digest: Digest) -> str:
    """Filters parted by dots, each as its number of elements and its bits in base64; empty without a feature."""
    size = FILTER_BITS // 8
    return ".".join(f"{n:03d}{base64.b64encode(bits.to_bytes(size, 'little')).decode()}" for n, bits in digest)


_q = 1 - 1 / FILTER_BITS


def _overlap(a: tuple[int, int], b: tuple[int, int]) -> float:
    """Common bits, from chance (0) to all that are possible (1)."""
    common = (a[1] & b[1]).bit_count()
    most = min(a[1].bit_count(), b[1].bit_count())
    x, y = HASHES * a[0], HASHES * b[0]
    chance = FILTER_BITS * (1 - _q**x - _q**y + _q ** (x + y))
    none = ALPHA * (most - chance) + chance
    return max(0.0, min(1.0, (common - none) / (most - none))) if most > none else float(common == most)


def likeness(a: Digest, b: Digest) -> float:
    """0 to 1: the mean over the shorter chain's filters of their best match in the other; two empty ones are alike."""
    if a == b:
        return 1.0
    if not a or not b:
        return 0.0
    a, b = sorted((a, b), key=lambda d: (len(d), sum(n for n, _ in d), d))
    used = [f for f in a if f[0] >= FEW] or a
    return sum(max(_overlap(f, g) for g in b) for f in used) / len(used)


def entropy_histogram(docs: DataFrame) -> np.ndarray:
    """How many windows of all whole texts of `docs` (text) have each entropy class."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(CLASSES + 1, np.int64)
        for batch in batches:
            data, offsets = text_bytes(batch.column(0))
            for start, end in row_chunks(offsets, CHUNK):
                _, classes = entropy_classes(data[offsets[start] : offsets[end]], offsets[start : end + 1] - offsets[start])
                total += np.bincount(classes, minlength=CLASSES + 1)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(CLASSES + 1)), pa.array(total)], ["c", "n"])

    counted = docs.select("text").mapInArrow(count, "c bigint, n bigint").groupBy("c").agg(F.sum("n").alias("n"))
    out = np.zeros(CLASSES + 1, np.int64)
    for r in counted.collect():
        out[r["c"]] = r["n"]
    return out


def _beside_next(docs: DataFrame) -> tuple[DataFrame, int]:
    """`docs` (doc_id, text, _k, _h) in ranges of descending id, each followed by the first row of the next.

    Adds `bucket` and `guest` (1: only there to follow the range's last row); the last range is
    followed by the very first row. Rows are dealt and sorted for `mapInArrow`.
    """
    spark = docs.sparkSession
    totals = docs.agg(F.count(F.lit(1)).alias("n"), F.sum(F.octet_length("text")).alias("bytes")).first()
    n, total = totals["n"], totals["bytes"] or 0
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    buckets = min(MOST_BUCKETS, max(partitions, -(-total // BUCKET_BYTES)))
    chance = F.pmod(F.xxhash64("_k", F.lit(1)), F.lit(1 << 31)) / F.lit(float(1 << 31))
    sample = sorted(r["_k"] for r in docs.select("_k").where(chance * max(n, 1) < SAMPLES * buckets).collect())
    splitters = sorted({sample[len(sample) * i // buckets] for i in range(1, buckets)}) if sample else []
    array = F.from_json(F.lit(str(splitters)), "array<bigint>")
    ranged = docs.withColumn("bucket", len(splitters) - (range_of(array, len(splitters), F.col("_k")) if splitters else F.lit(0)))
    heads = ranged.groupBy("bucket").agg(F.max(F.struct("_k", "_h")).alias("head")).orderBy("bucket").collect()
    rows = [(r["bucket"], r["head"]["_k"], r["head"]["_h"], heads[i - 1]["bucket"]) for i, r in enumerate(heads)]
    before = spark.createDataFrame(rows, "bucket int, _k bigint, _h bigint, before int")
    places = F.array(F.struct("bucket", F.lit(0).alias("guest")), F.struct(F.col("before").alias("bucket"), F.lit(1).alias("guest")))
    placed = ranged.join(F.broadcast(before), ["bucket", "_k", "_h"], "left").withColumn(  # one row per bucket
        "place", F.explode(F.when(F.col("before").isNull(), F.slice(places, 1, 1)).otherwise(places))
    )
    placed = placed.select("doc_id", "text", "_k", "_h", "place.bucket", "place.guest")
    dealt = placed.repartitionById(len(splitters) + 1, F.col("bucket"))
    return dealt.sortWithinPartitions("bucket", "guest", F.desc("_k"), F.desc("_h")).select("doc_id", "text", "bucket", "guest"), n


def fingerprint_documents(docs: DataFrame) -> DataFrame:
    """Fingerprints of all whole texts of `docs` (doc_id, text) and of their edited texts, and likenesses.

    Edited: the last third of the code points replaced by as many, or all, from the start of the
    next document by descending id (after the last: the first). Rarity of an entropy class is its
    frequency over all windows of all texts. Documents are dealt in ranges of ids, sorted, and
    streamed, so that each row is beside its next; a range takes the first row of the next range
    along. A null text counts as empty; an empty text has an empty fingerprint, like itself (1)
    and unlike others (0). Null ids come last; rows of one id follow each other by a hash of
    their text; no rows give no rows; further columns are not used.

    Columns: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.
    """
    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    ranks = class_ranks(entropy_histogram(docs))
    docs = docs.withColumn("_k", F.coalesce("doc_id", F.lit(-(1 << 63)))).withColumn("_h", F.xxhash64("text"))
    beside, _ = _beside_next(docs)
    names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]

    def encoded(texts: list[str]) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
        parts = [t.encode() for t in texts]
        return np.frombuffer(b"".join(parts), np.uint8), np.concatenate(([0], np.cumsum([len(p) for p in parts]))).astype(np.int64), parts

    def rows_of(run: list[tuple]) -> pa.RecordBatch:
        """Results for all but the last of a run of neighbours (doc_id, text)."""
        texts = [t for _, t in run]
        own = digests(*encoded(texts)[:2], ranks)
        edited = [t[: len(t) - len(t) // 3] + u[: len(t) // 3] for t, u in zip(texts, texts[1:])]
        data, offsets, parts = encoded(edited)
        changed = digests(data, offsets, ranks)
        columns = [
            pa.array([i for i, _ in run[:-1]], pa.int64()),
            pa.array([len(t) for t in texts[:-1]], pa.int64()),
            pa.array([hashlib.sha256(p).hexdigest() for p in parts], pa.string()),
            pa.array([as_text(d) for d in own[:-1]], pa.string()),
            pa.array([as_text(d) for d in changed], pa.string()),
            pa.array([likeness(d, e) for d, e in zip(own, changed)], pa.float64()),
            pa.array([likeness(d, e) for d, e in zip(own, own[1:])], pa.float64()),
        ]
        return pa.RecordBatch.from_arrays(columns, names)

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        run: list[tuple] = []
        size, bucket, closed = 0, None, False
        for batch in batches:
            for doc_id, text, b, guest in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "text", "bucket", "guest"))):
                if b != bucket:
                    run, size, bucket, closed = [], 0, b, False
                if closed:  # equal rows at the head of the next range: one of them is enough
                    continue
                run.append((doc_id, text))
                size += len(text)
                closed = guest == 1
                if len(run) > 1 and (closed or size >= CHUNK):
                    yield rows_of(run)
                    run, size = run[-1:], len(text)

    schema = "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
    return beside.mapInArrow(walk, schema)
