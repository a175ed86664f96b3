"""Prediction by partial matching over bytes: a pretrained context trie scores whole texts.

Escape method D with symbol exclusion. What a context sees is a subset of what its shorter
suffix sees, so excluding the longer context's symbols takes fixed sums off the shorter one's:
they are kept with the trie, and a byte is scored by lookups alone.

The trie has every edge of the corpus and is never in one place. The longest grams meet in ranges
of their last `LOW` bytes of context, which hold all longer contexts of these grams; the orders
below, at most 256 ** `LOW` edges, go to every range. So each gram that any text has is scored once
per corpus, and texts look scores up: common grams in a dictionary, all others by a shuffle join.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from obsledger.llm.frequencies import (
    common_values,
    hash_ranges,
    pack,
    packed_ranges,
    range_bits,
    summed,
    sums_by_document,
    token_counts,
    unpack,
    unpacked,
    value_counts,
)
from obsledger.llm.text import U64, remainder, row_chunks, text_bytes
from obsledger.session import written

ORDER = 6  # bytes of context, 7 at most
LOW = 3  # orders below it are known in every range of contexts
EDGES = 4_000_000  # longest grams in the dictionary of common ones: those in at least 1/EDGES of all places
BLOCK_PLACES = 1 << 20  # of rare grams that a task gathers before it hands them on
GRAMS = 1 << 20  # scored at a time
PARTS, HELD_OUT = 5, 1
COMMON_WORDS = 200_000  # in the dictionary that stands in a worker's memory beside the trie
BEFORE, AFTER = 10, 255  # bytes put around a text: line ends before it, a byte that no text has after it
END = b" "  # the token after the last word; no word holds a space


def grams(data: np.ndarray, offsets: np.ndarray, order: int) -> tuple[np.ndarray, np.ndarray]:
    """For each byte of each text and its end: row, and the byte behind its `order` bytes of context, as one number."""
    sizes = np.diff(offsets) + order + 1
    begins = np.cumsum(sizes) - sizes
    ends = begins + sizes - 1
    stream = np.full(int(sizes.sum()), BEFORE, np.uint8)
    scored = np.ones(len(stream), bool)
    for i in range(order):
        scored[begins + i] = False
    scored[ends] = False
    stream[scored] = data
    stream[ends] = AFTER
    scored[ends] = True
    # eight bytes from any place of the reversed stream are a number whose lowest byte is the last one read
    back = np.concatenate((stream[::-1], np.zeros(8, np.uint8)))
    value = np.ndarray(len(stream), "<u8", back, strides=(1,))[::-1][scored]
    rows = np.repeat(np.arange(len(sizes), dtype=np.uint32), np.diff(offsets) + 1)
    return rows, value & U64((1 << 8 * (order + 1)) - 1)


@dataclass
class Trie:
    """By order: sorted grams with their counts, and sorted contexts with total, symbols and what they exclude below.

    A total counts every place with that context. What the kept edges do not make up of it went
    to symbols too rare for the trie: it is escape mass that was observed, beside the estimate.
    """

    order: int
    grams: list
    counts: list
    contexts: list
    totals: list
    symbols: list
    rare: list
    below: list

    @classmethod
    def of(cls, edges: list[tuple[np.ndarray, np.ndarray]], places: int, low: Trie | None = None) -> Trie:
        """`edges[k]`: sorted (k+1)-byte grams and counts, holding the suffixes of those of the next order.

        With `low`, the first orders are taken from there, and `edges` begin with the next one.
        """
        parts = ("grams", "counts", "contexts", "totals", "symbols", "rare", "below")
        known = low.order + 1 if low else 0
        out = cls(known + len(edges) - 1, *[list(getattr(low, p)) if low else [] for p in parts])
        for k, (keys, counts) in enumerate(edges, known):
            contexts, first = np.unique(keys >> U64(8), return_index=True)
            kept = np.add.reduceat(counts, first) if len(first) else counts
            if k == 0:
                total = np.full(len(contexts), places, np.int64)
            else:  # a context is a gram of the order below
                at = np.minimum(np.searchsorted(out.grams[k - 1], contexts), max(len(out.grams[k - 1]) - 1, 0))
                total = np.where(out.grams[k - 1][at] == contexts, out.counts[k - 1][at], 0) if len(contexts) else kept
            total = np.maximum(total, kept)  # a text's first contexts reach into what stands before it
            below = np.zeros(len(contexts), np.int64)
            if k and len(keys):
                suffix = keys & U64((1 << 8 * k) - 1)
                at = np.searchsorted(out.grams[k - 1], suffix)
                below = np.add.reduceat(out.counts[k - 1][at], first)
            out.grams.append(keys)
            out.counts.append(counts)
            out.contexts.append(contexts)
            out.totals.append(total)
            out.symbols.append(np.diff(np.append(first, len(keys))))
            out.rare.append(total - kept)
            out.below.append(below)
        return out

    def log10(self, grams: np.ndarray) -> np.ndarray:
        """Log10 probability of each gram's last byte behind the others."""
        out = np.zeros(len(grams))
        open_ = np.arange(len(grams))
        off_total = np.zeros(len(grams), np.int64)  # what the longer context excludes
        off_symbols = np.zeros(len(grams), np.int64)
        for k in range(self.order, -1, -1):
            if not len(open_) or not len(self.contexts[k]):
                continue
            own = grams[open_] & U64((1 << 8 * (k + 1)) - 1)
            context = own >> U64(8)
            at = np.minimum(np.searchsorted(self.contexts[k], context), len(self.contexts[k]) - 1)
            known = self.contexts[k][at] == context
            total = np.where(known, self.totals[k][at] - off_total[open_], 0)
            escapes = np.where(known, 2 * self.rare[k][at] + self.symbols[k][at] - off_symbols[open_], 0)
            edge = np.minimum(np.searchsorted(self.grams[k], own), len(self.grams[k]) - 1)
            found = known & (self.grams[k][edge] == own)
            out[open_[found]] += np.log10((2 * self.counts[k][edge[found]] - 1) / (2 * total[found]))
            escaped = known & ~found & (escapes > 0)
            out[open_[escaped]] += np.log10(escapes[escaped] / (2 * total[escaped]))
            off_total[open_[known]] = self.below[k][at[known]]
            off_symbols[open_[known]] = self.symbols[k][at[known]]
            open_ = open_[~found]
        out[open_] -= np.log10(256 - off_symbols[open_])  # a byte that the corpus does not have
        return out


def shorter(keys: np.ndarray, counts: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The (k+1)-byte ends of grams, sorted, with the sums of their counts."""
    keys = keys & U64((1 << 8 * (k + 1)) - 1)
    return summed(keys, counts) if len(keys) else (keys, counts)


def count_grams(docs: DataFrame, bits: int, order: int) -> DataFrame:
    """Rows (_range, found, counts): the longest grams of all whole texts of `docs` (text, held_out), counted where not held out.

    Packed by ranges of the last `LOW` bytes of context. A gram is in one row, however often it
    comes: a range has at most as many as there are grams with one such context.
    """

    def values(column: pa.Array) -> Iterator[np.ndarray]:
        data, offsets = text_bytes(column)
        for start, end in row_chunks(offsets):
            yield grams(data[offsets[start] : offsets[end]], offsets[start : end + 1] - offsets[start], order)[1]

    def ranges(found: np.ndarray) -> np.ndarray:
        return hash_ranges(found >> U64(8) & U64((1 << 8 * LOW) - 1), bits)

    return written(value_counts(docs, values, bits, ~F.col("held_out"), ranges), "grams")


def low_orders(counted: DataFrame) -> tuple[Trie, int]:
    """The trie of the orders below `LOW`, from all counted grams, and the number of places."""

    def ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, counts = unpacked(batch.column("found"), np.uint64), unpacked(batch.column("counts"), np.int64)
            keys, counts = shorter(keys[counts > 0], counts[counts > 0], LOW - 1)
            yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(counts)], ["gram", "n"])

    found = counted.select("found", "counts").mapInArrow(ends, "gram bigint, n bigint").groupBy("gram").agg(F.sum("n").alias("n")).toPandas()
    keys, counts = found["gram"].to_numpy(np.int64).view(np.uint64), found["n"].to_numpy(np.int64)
    places = int(counts.sum())
    return Trie.of([shorter(keys, counts, k) for k in range(LOW)], places), places


def score_grams(counted: DataFrame, low: Trie, places: int, bits: int, order: int) -> DataFrame:
    """Rows (_range, found, scores): the log10 probability of each gram under the whole trie.

    Packed by ranges of the gram's hash; those of common grams have the range -1.
    """
    shared = counted.sparkSession.sparkContext.broadcast(low)
    least = max(1, -(-places // EDGES))

    def score(group: pa.Table) -> pa.Table:
        keys, counts = unpacked(group.column("found"), np.uint64), unpacked(group.column("counts"), np.int64)
        by_key = np.argsort(keys)
        keys, counts = keys[by_key], counts[by_key]
        edges = [(keys[counts > 0], counts[counts > 0])]
        for k in range(order - 1, LOW - 1, -1):
            edges.insert(0, shorter(*edges[0], k))
        trie = Trie.of(edges, places, shared.value)
        scores = np.concatenate([trie.log10(keys[i : i + GRAMS]) for i in range(0, len(keys), GRAMS)])
        common = counts >= least
        filled, columns = packed_ranges(hash_ranges(keys[~common], bits), keys[~common], scores[~common])
        filled = filled.astype(np.int32)
        if common.any():
            filled = np.append(filled, np.int32(-1))
            columns = [columns[0] + [pack(keys[common])], columns[1] + [pack(scores[common])]]
        return pa.table([pa.array(filled), *[pa.array(c, pa.binary()) for c in columns]], ["_range", "found", "scores"])

    return written(counted.groupBy("_range").applyInArrow(score, "_range int, found binary, scores binary"), "scores")


def common_grams(scored: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Sorted common grams and their scores: at most `EDGES`, by what common means."""
    rows = scored.where("_range = -1").select("found", "scores").collect()
    keys = np.concatenate([np.zeros(0, np.uint64), *[unpack(bytes(r["found"]), np.uint64) for r in rows]])
    scores = np.concatenate([np.zeros(0), *[unpack(bytes(r["scores"]), np.float64) for r in rows]])
    order = np.argsort(keys)
    return keys[order], scores[order]


def gram_scores(texts: DataFrame, order: int = ORDER) -> DataFrame:
    """Rows (_key, score): for each `_key` of `texts` (text, held_out, _key) the score of its text.

    `_key` is a digest of the text. The trie is that of all texts that are not held out. Sums over
    common grams are taken where the text is; the places of rare ones travel in packed blocks to
    the range of the gram's hash, and sums per text and range come back to the block.
    """
    spark = texts.sparkSession
    bits = range_bits(texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0)
    counted = count_grams(texts, bits, order)
    scored = score_grams(counted, *low_orders(counted), bits, order)
    shared = spark.sparkContext.broadcast(common_grams(scored))
    schema = "_range int, block bigint, found binary, scores binary, rows binary, keys binary"
    names = ["_range", "block", "found", "scores", "rows", "keys"]
    kinds = [pa.int32(), pa.int64(), *[pa.binary()] * 4]

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        common, common_scores = shared.value
        block = TaskContext.get().partitionId() << 32
        keys, sums, rare, owners, n, size = [], [], [], [], 0, 0

        def out() -> pa.RecordBatch:
            values, rows = np.concatenate(rare), np.concatenate(owners)
            by_value = np.argsort(values)
            values, rows = values[by_value], rows[by_value]
            filled, packed = packed_ranges(hash_ranges(values, bits), values, rows)
            more = [None] * len(filled)
            own = [hash_ranges(np.array([block], np.uint64), bits)[0], None, pack(np.concatenate(sums)), None, b"".join(keys)]
            columns = [filled.tolist() + own[:1], [block] * (len(filled) + 1), packed[0] + own[1:2], more + own[2:3], packed[1] + own[3:4], more + own[4:]]
            for held in (keys, sums, rare, owners):
                held.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)

        for batch in batches:
            data, offsets = text_bytes(batch.column("text"))
            digests = batch.column("_key").to_pylist()
            for start, end in row_chunks(offsets):
                rows, values = grams(data[offsets[start] : offsets[end]], offsets[start : end + 1] - offsets[start], order)
                rows, values, new = by_gram(rows, values)
                times = np.diff(np.append(new, len(values)))
                own = values[new]
                at = np.minimum(np.searchsorted(common, own), max(len(common) - 1, 0))
                known = common[at] == own if len(common) else np.zeros(len(own), bool)
                score = np.zeros(len(own))
                score[known] = common_scores[at[known]]
                left = np.repeat(~known, times)
                sums.append(np.bincount(rows, weights=np.repeat(score, times), minlength=end - start))
                keys.extend(digests[start:end])
                rare.append(values[left])
                owners.append(rows[left] + np.uint32(n))
                n += end - start
                size += len(rare[-1])
                if size >= BLOCK_PLACES:
                    yield out()
                    block, n, size = block + 1, 0, 0
        if n:
            yield out()

    def resolve(group: pa.Table) -> pa.Table:
        is_score = pc.is_null(group.column("block"))
        table, asked = group.filter(is_score), group.filter(pc.invert(is_score))
        keys, scores = unpacked(table.column("found"), np.uint64), unpacked(table.column("scores"), np.float64)
        by_key = np.argsort(keys)
        keys, scores = keys[by_key], scores[by_key]
        out = []
        for row in asked.select(names[1:]).to_pylist():
            if row["keys"] is not None:  # what the block itself knows
                out.append((row["block"], None, row["scores"], row["keys"]))
                continue
            rows = unpack(row["rows"], np.uint32)
            found = scores[np.searchsorted(keys, unpack(row["found"], np.uint64))]
            rows, which = np.unique(rows, return_inverse=True)
            out.append((row["block"], pack(rows), pack(np.bincount(which, weights=found)), None))
        columns = list(zip(*out)) or [()] * 4
        return pa.table([pa.array(c, k) for c, k in zip(columns, [pa.int64(), *[pa.binary()] * 3])], ["block", "rows", "scores", "keys"])

    def gather(group: pa.Table) -> pa.Table:
        is_own = pc.is_valid(group.column("keys"))
        own, others = group.filter(is_own), group.filter(pc.invert(is_own))
        packed = own.column("keys")[0].as_py()
        score = unpacked(own.column("scores"), np.float64)
        rows = unpacked(others.column("rows"), np.uint32)
        score = score + np.bincount(rows, weights=unpacked(others.column("scores"), np.float64), minlength=len(score))
        width = len(packed) // len(score)
        keys = [packed[i : i + width] for i in range(0, len(packed), width)]
        return pa.table([pa.array(keys, pa.binary()), pa.array(score)], ["_key", "score"])

    asked = texts.select("text", "_key").mapInArrow(split, schema)
    none = [F.lit(None).cast(t).alias(c) for c, t in (("block", "bigint"), ("rows", "binary"), ("keys", "binary"))]
    table = scored.where("_range >= 0").select("_range", "found", "scores", *none).select(names)
    back = asked.unionByName(table).groupBy("_range").applyInArrow(resolve, "block bigint, rows binary, scores binary, keys binary")
    return back.groupBy("block").applyInArrow(gather, "_key binary, score double")


def by_gram(rows: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows and grams in the order of grams, and where a run of equal ones begins.

    In order, since what follows looks grams up in long sorted arrays.
    """
    order = np.argsort(values)
    values = values[order]
    return rows[order], values, np.flatnonzero(np.concatenate(([True], values[1:] != values[:-1])))


def text_scores(data: np.ndarray, offsets: np.ndarray, trie: Trie) -> np.ndarray:
    """Log10 probability of each text and its end. Equal grams are mostly looked up once."""
    rows, values, new = by_gram(*grams(data, offsets, trie.order))
    score = np.repeat(trie.log10(values[new]), np.diff(np.append(new, len(values))))
    return np.bincount(rows, weights=score, minlength=len(offsets) - 1)


def word_tokens(text: bytes) -> list[bytes]:
    words = text.lower().split()
    words.append(END)
    return words


def score_documents(docs: DataFrame) -> DataFrame:
    """Rows (doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) for `docs` (doc_id, text).

    Learns from all documents that are not held out, every edge of them, and scores every whole text.
    Texts are told apart by 128 bits. `score` is the trie's log10 probability of the text's bytes
    and its end, `base_score` that of its lower-cased words and an end under add-half unigram
    frequencies. Null texts count as empty, null ids are not held out, repeated rows are scored
    each; further columns are not used. No rows give no rows; without a training document all
    bytes are alike, and no token is known.
    """
    key = F.unhex(F.md5(F.coalesce(F.col("text"), F.lit("")).cast("binary")))
    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text", key.alias("_key"))
    docs = docs.withColumn("held_out", remainder(F.col("doc_id"), PARTS) == HELD_OUT)
    training = docs.where(~F.col("held_out"))
    # equal texts have equal scores, but for the last digits, which depend on the order of sums
    scores = gram_scores(docs).groupBy("_key").agg(F.max("score").alias("score"))

    counts = written(token_counts(training, word_tokens), "words")
    totals = counts.agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("v")).first()
    n, distinct = totals["n"] or 0, totals["v"]
    values = counts.select("token", "n", F.log10(F.col("n") + 0.5).alias("v"), F.lit(1.0).alias("w"))
    sums = sums_by_document(docs, word_tokens, values, common_values(values, n, COMMON_WORDS))
    each = F.log10(F.lit(n + 0.5 * (distinct + 1)))
    base = F.col("sum_v") + F.col("missing") * F.log10(F.lit(0.5)) - F.col("n_tokens") * each
    return sums.join(scores, "_key", "left").select(
        "doc_id",
        "held_out",
        "n_tokens",
        F.round("sum_w").cast("bigint").alias("n_known"),
        F.lit(n).cast("bigint").alias("train_tokens"),
        base.alias("base_score"),
        "score",
    )
