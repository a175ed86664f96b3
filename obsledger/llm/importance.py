"""Importance resampling towards a target text: features of distinct lines counted once, cross-line pairs added."""

from __future__ import annotations

import hashlib
import math
from collections import Counter
from collections.abc import Iterator
from itertools import repeat
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from obsledger.session import written

BUCKETS = 10_000
LEAST_WORDS = 20
DRAWN_PERCENT = 25
SEED = 7
COMMON = 100_000  # lines in the dictionary of common ones at most
BLOCK_BYTES = 16 << 20  # of distinct lines a task gathers before it hands on their counts
OUT_ROWS = 200_000
# Words are 0-9, a-z and all bytes of other scripts; A-Z counts as a-z, a newline stays.
_WORDS = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or chr(c).isalnum() or c == 10 else 32 for c in range(256))
_PAIR = b"\n"  # in front of a pair of words that a newline parts; no line holds one
_TOTALS = "digest binary, n bigint, buckets binary, part bigint, totals binary"
MERGED = 64  # vectors of totals that one task adds up


def _encoded(column: pa.Array) -> list[bytes]:
    return [b"" if t is None else t for t in column.cast(pa.binary()).to_pylist()]


def lines_and_pairs(text: bytes) -> tuple[list[bytes], list[bytes]]:
    """The lines of a text that hold words, and the pairs of words that meet across newlines."""
    lines = [line for part in text.translate(_WORDS).split(b"\n") if (line := part.strip())]
    pairs = [_PAIR + a.rsplit(b" ", 1)[-1] + b" " + b.split(b" ", 1)[0] for a, b in zip(lines, lines[1:])]
    return lines, pairs


def line_buckets(line: bytes) -> list[int]:
    """Checksums of the words of a line and of its pairs of neighbours."""
    words = line.split()
    single = list(map(crc32, words))
    return single + list(map(crc32, words[1:], map(crc32, repeat(b" "), single)))


def _digest(line: bytes) -> bytes:
    return hashlib.blake2b(line, digest_size=16).digest()


def line_features(texts: DataFrame, name: str) -> DataFrame:
    """Features of every distinct line, counted once: a stored table (digest, n, buckets, totals).

    Tasks count the lines of their texts in blocks; summed, each distinct line comes once, with
    its number of occurrences n, and the buckets of its features. Rows without a digest hold
    what a task counted per bucket: features of its lines times n, and pairs across lines.
    """

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()
        held = 0

        def out() -> pa.RecordBatch:
            got = pa.RecordBatch.from_arrays([pa.array(seen.keys(), pa.binary()), pa.array(seen.values(), pa.int64())], ["line", "n"])
            seen.clear()
            return got

        for batch in batches:
            for text in _encoded(batch.column(0)):
                lines, pairs = lines_and_pairs(text)
                seen.update(lines)
                seen.update(pairs)
                held += len(text)
                if held >= BLOCK_BYTES:
                    yield out()
                    held = 0
        if seen:
            yield out()

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = np.zeros(BUCKETS, "<i8")
        names = [f.split()[0] for f in _TOTALS.split(", ")]
        for batch in batches:
            digests, counts, buckets = [], [], []
            pairs, times = [], []
            for line, n in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if line[:1] == _PAIR:
                    pairs.append(crc32(line[1:]))
                    times.append(n)
                else:
                    digests.append(_digest(line))
                    counts.append(n)
                    buckets.append((np.array(line_buckets(line), np.uint32) % BUCKETS).astype(np.uint16))
            every = np.concatenate([*buckets, np.array(pairs, np.uint32) % BUCKETS]).astype(np.int64)
            weights = np.concatenate([np.repeat(np.array(counts, np.int64), [len(b) for b in buckets]), np.array(times, np.int64)])
            totals += np.bincount(every, weights, BUCKETS).astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(digests, pa.binary()), pa.array(counts, pa.int64()), pa.array([b.tobytes() for b in buckets], pa.binary()),
                 pa.nulls(len(digests), pa.int64()), pa.nulls(len(digests), pa.binary())], names,
            )
        part = TaskContext.get().partitionId()
        yield pa.RecordBatch.from_arrays(
            [pa.nulls(1, pa.binary()), pa.nulls(1, pa.int64()), pa.nulls(1, pa.binary()), pa.array([part], pa.int64()), pa.array([totals.tobytes()], pa.binary())], names
        )

    counted = texts.select("text").mapInArrow(blocks, "line binary, n bigint").groupBy("line").agg(F.sum("n").alias("n"))
    return written(counted.mapInArrow(features, _TOTALS), name)


def bucket_totals(features: DataFrame) -> np.ndarray:
    """Occurrences of each bucket's features: the tasks' vectors, added up `MERGED` to a task, round after round."""

    def added(vectors: list[bytes]) -> np.ndarray:
        return sum((np.frombuffer(v, "<i8") for v in vectors), np.zeros(BUCKETS, "<i8"))

    def merge(group: pa.Table) -> pa.Table:
        total = added(group.column("totals").to_pylist()).tobytes()
        return pa.table([pa.array([group.column("to")[0].as_py()], pa.int64()), pa.array([total], pa.binary())], ["part", "totals"])

    rows = features.where("digest IS NULL").select("part", "totals")
    most = rows.agg(F.max("part")).first()[0] or 0
    while most >= MERGED:
        rows = rows.withColumn("to", F.floor(F.col("part") / MERGED)).groupBy("to").applyInArrow(merge, "part bigint, totals binary")
        most //= MERGED
    return added([r["totals"] for r in rows.select("totals").collect()])


def bucket_gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the log ratio of smoothed shares in target and source, floored."""
    s_all, t_all = float(source.sum() + BUCKETS), float(target.sum() + BUCKETS)
    ratios = ((t + 1.0) * s_all / ((s + 1.0) * t_all) for s, t in zip(source.tolist(), target.tolist()))
    return np.array([math.floor(1000 * math.log(r)) for r in ratios], np.int64)


def _line_gains(features: DataFrame, gains: np.ndarray) -> DataFrame:
    """Rows (digest, n, gain): the summed gains of each distinct line's features."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = batch.column("buckets").to_pylist()
            ends = np.cumsum(np.array([len(p) // 2 for p in parts], np.int64))
            running = np.concatenate(([0], np.cumsum(gains[np.frombuffer(b"".join(parts), np.uint16)])))
            sums = running[ends] - running[np.concatenate(([0], ends[:-1]))] if parts else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays([batch.column("digest"), batch.column("n"), pa.array(sums, pa.int64())], ["digest", "n", "gain"])

    return features.where("digest IS NOT NULL").select("digest", "n", "buckets").mapInArrow(add, "digest binary, n bigint, gain bigint")


def document_gains(docs: DataFrame, features: DataFrame, gains: np.ndarray) -> DataFrame:
    """Rows (doc_id, n_words, gain): gains summed over all features of each row of `docs` (doc_id, text).

    Lines that make up at least 1 / `COMMON` of all are common: no more than `COMMON` of them
    exist, and their sums travel as a dictionary. All others are rare by definition and take
    one join by digest. Pairs across newlines are added where the text is cut.
    """
    spark = docs.sparkSession
    lines = _line_gains(features, gains)
    total = features.agg(F.sum("n")).first()[0] or 0
    common = lines.where(F.col("n") * F.lit(COMMON) >= F.lit(total)).select("digest", "gain")
    shared = spark.sparkContext.broadcast({bytes(r["digest"]): r["gain"] for r in common.collect()})
    names = ["_row", "doc_id", "n_words", "gain", "digest", "_n"]
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64()]

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, out = shared.value, []
        for batch in batches:
            for row, doc_id, text in zip(batch.column("_row").to_pylist(), batch.column("doc_id").to_pylist(), _encoded(batch.column("text"))):
                lines, pairs = lines_and_pairs(text)
                gain = sum(int(gains[crc32(p[1:]) % BUCKETS]) for p in pairs)
                for digest, n in Counter(map(_digest, lines)).items():
                    value = known.get(digest)
                    if value is None:
                        out.append((row, None, None, None, digest, n))
                    else:
                        gain += value * n
                # a document's own row has a key that no line has, spread over all partitions
                out.append((row, doc_id, sum(len(line.split()) for line in lines), gain, b"row %020d" % row, None))
                if len(out) >= OUT_ROWS:
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names)
                    out = []
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names)

    numbered = docs.select(F.monotonically_increasing_id().alias("_row"), F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    rows = numbered.mapInArrow(split, "_row bigint, doc_id bigint, n_words bigint, gain bigint, digest binary, _n bigint")
    joined = rows.join(lines.select("digest", F.col("gain").alias("line_gain")), "digest", "left")
    return (
        joined.groupBy("_row")
        .agg(F.max("doc_id").alias("doc_id"), F.max("n_words").alias("n_words"), F.sum(F.coalesce("gain", F.col("line_gain") * F.col("_n"))).alias("gain"))
        .drop("_row")
    )


def noise(doc_id: Column) -> Column:
    """The document's fixed draw from a Gumbel distribution, in thousandths, floored."""
    text = F.concat(F.lit(f"{SEED}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    part = F.conv(F.substring(F.sha2(text, 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((part + 0.5) / 4294967296.0))).cast("bigint")


def ranked(scored: DataFrame, percent: int = DRAWN_PERCENT) -> DataFrame:
    """`scored` with `rank`: 1, 2, 3, … for the best `percent` of the rows with enough words.

    Rows are counted per score. As a gain is at most the log of a share, in thousandths, there
    are some ten thousand scores at most, whatever the number of rows: their running total
    tells where each score's ranks begin, and each score is ordered by itself.
    """
    enough = F.col("n_words") >= LEAST_WORDS
    per_score = scored.where(enough).groupBy("score").count()
    drawn = scored.where(enough).count() * percent // 100
    before = F.coalesce(F.sum("count").over(Window.orderBy(F.desc("score")).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    begins = per_score.withColumn("_before", before).where(F.col("_before") < drawn).select("score", "_before")
    place = F.row_number().over(Window.partitionBy("score").orderBy(F.asc_nulls_last("doc_id")))
    tops = scored.where(enough).join(begins, "score").withColumn("rank", F.col("_before") + place)
    tops = tops.withColumn("rank", F.when(F.col("rank") <= drawn, F.col("rank"))).drop("_before")
    lowest = begins.agg(F.min("score")).first()[0]
    kept_out = F.lit(True) if lowest is None else ~enough | (F.col("score") < lowest)
    rest = scored.where(kept_out).withColumn("rank", F.lit(None).cast("bigint"))
    return tops.unionByName(rest)


def resample(docs: DataFrame, target: DataFrame) -> DataFrame:
    """Weigh documents (doc_id, text) by how much likelier their features are in `target` (text); draw the best.

    Features are words and pairs of neighbouring words of the lower-cased (A-Z) whole text,
    in `BUCKETS` hashed buckets. Newlines cut texts into lines; the features of each
    distinct line are counted once and multiplied by its occurrences, and pairs of words
    that meet across newlines (also across lines without words) are added by themselves.

    Rows (doc_id, n_words, n_features, weight, score, rank), one per row of `docs`: weight is the
    floored mean gain, score adds the document's fixed noise, rank numbers the best quarter of
    the rows with at least `LEAST_WORDS` words (null: not drawn). Ties go to the smaller
    id, nulls last; equal ids share their noise and get ranks in any order. Null and empty
    texts have no features, weight 0 and no rank; an empty `target` gives every bucket its
    prior share; no rows give no rows; further columns are not used.
    """
    features = line_features(docs, "lines")
    gains = bucket_gains(bucket_totals(features), bucket_totals(line_features(target, "target-lines")))
    sums = document_gains(docs, features, gains)
    n = F.greatest(2 * F.col("n_words") - 1, F.lit(0))
    scored = sums.withColumn("n_features", n)
    floored = F.expr("(gain - pmod(gain, n_features)) div n_features")
    scored = scored.withColumn("weight", F.when(F.col("n_features") > 0, floored).otherwise(F.lit(0)).cast("bigint"))
    scored = scored.withColumn("score", F.col("weight") + noise(F.col("doc_id")))
    return ranked(written(scored.drop("gain"), "importance"))
