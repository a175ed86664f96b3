"""Benchmark decontamination: a BM25 index of test items, asked with every passage of every document."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from obsledger.llm.text import ALPHANUMERIC, U64, mix, row_chunks, text_bytes, word_hashes
from obsledger.session import written

K1, B = 1.2, 0.75
SCORE = 0.5  # share of an item's own BM25 score that a passage must reach
OVERLAP = 0.5  # share of the question's, and of the answer's, word trigrams that it must hold
BUCKET_WORDS = 64  # at least; a passage is two neighbouring buckets, so one that holds an item lies in a passage
COMMON_SHARE = 0.1  # terms in more of the items than that are left to the second step
BLOCK_ITEMS = 8  # neighbours in the index that share a bound
PART_ITEMS = 50_000  # items indexed at a time; more items mean more passes over the documents
CELLS = 2_000_000  # passage x block bounds held at a time
_SENTENCE_END = re.compile(r"(?<=[.!?])\s+")
_WORD = re.compile(r"[A-Za-z0-9\x80-\U0010ffff]")  # as in ALPHANUMERIC
GRAM = 3


def _with_words(pieces: list[str]) -> list[str]:
    """Pieces without a letter or digit joined to the one before them, first ones to the one after; none without words."""
    out, ahead = [], ""
    for piece in pieces:
        if _WORD.search(piece):
            out.append(f"{ahead} {piece}" if ahead else piece)
            ahead = ""
        elif out:
            out[-1] += f" {piece}"
        else:
            ahead = f"{ahead} {piece}" if ahead else piece
    return out


def question_and_answer(text: str) -> tuple[str, str]:
    """The answer is the last sentence; of a single sentence, its last third of words (one at least).

    What has no letter or digit, like a closing mark alone, is neither a sentence nor a word: it
    goes with its neighbour, so both parts of an item that has words have some.
    """
    sentences = _with_words(_SENTENCE_END.split(text.strip()))
    if len(sentences) > 1:
        return " ".join(sentences[:-1]), sentences[-1]
    words = _with_words(text.split())
    cut = max(1, len(words) - max(1, len(words) // 3))
    return " ".join(words[:cut]), " ".join(words[cut:] or words)


def _hashes(text: str) -> np.ndarray:
    data = np.frombuffer(text.encode(), np.uint8)
    return word_hashes(data, np.array([0, len(data)]), ALPHANUMERIC)[1]


def _grams(hashes: np.ndarray, width: int) -> np.ndarray:
    if len(hashes) < width or not width:
        return np.zeros(0, np.uint64)
    out = hashes[: len(hashes) - width + 1]
    for i in range(1, width):
        out = mix(out * U64(0xD6E8FEB86659FD93) + hashes[i : len(hashes) - width + 1 + i])
    return np.unique(out)


@dataclass
class Index:
    """Postings by term, impacts as shares of the item's own score, and bounds per term and block."""

    item_ids: list
    terms: np.ndarray  # sorted hashes
    common: np.ndarray  # by term: left out of the bounds
    posting_start: np.ndarray
    posting_item: np.ndarray
    posting_impact: np.ndarray
    bound_start: np.ndarray
    bound_block: np.ndarray
    bound_impact: np.ndarray
    common_in_block: np.ndarray  # the most that common terms add to an item of the block
    grams: list  # per item ((width, question grams), (width, answer grams))
    bucket: int


def _starts(keys: np.ndarray, n: int) -> np.ndarray:
    return np.searchsorted(keys, np.arange(n + 1))


def build_index(postings: pd.DataFrame, items: list[tuple], longest: int) -> Index:
    """`postings`: (item, term, impact, frequent) with the items numbered as in `items` (item_id, text)."""
    terms, term = np.unique(postings["term"].to_numpy(np.int64).view(np.uint64), return_inverse=True)
    item = postings["item"].to_numpy(np.int64)
    impact = postings["impact"].to_numpy(np.float64)
    frequent = postings["frequent"].to_numpy(bool)
    order = np.lexsort((item, term))
    term, item, impact, frequent = term[order], item[order], impact[order], frequent[order]
    common = np.zeros(len(terms), bool)
    common[term[frequent]] = True
    blocks = -(-len(items) // BLOCK_ITEMS)
    of_items = np.bincount(item, weights=impact * frequent, minlength=blocks * BLOCK_ITEMS)
    rare = ~frequent
    key = term[rare] * max(blocks, 1) + item[rare] // BLOCK_ITEMS
    first = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1]))) if len(key) else np.zeros(0, np.int64)
    grams = []
    for _, text in items:
        parts = [_hashes(part) for part in question_and_answer(text or "")]
        grams.append([(min(GRAM, len(h)), _grams(h, min(GRAM, len(h)))) for h in parts])
    return Index(
        item_ids=[i for i, _ in items],
        terms=terms,
        common=common,
        posting_start=_starts(term, len(terms)),
        posting_item=item,
        posting_impact=impact,
        bound_start=_starts(key[first] // max(blocks, 1), len(terms)),
        bound_block=key[first] % max(blocks, 1),
        bound_impact=np.maximum.reduceat(impact[rare], first) if len(first) else np.zeros(0),
        common_in_block=of_items.reshape(blocks, BLOCK_ITEMS).max(1) if blocks else np.zeros(0),
        grams=grams,
        bucket=max(BUCKET_WORDS, longest),
    )


def _ragged(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each range its number, and the positions it covers."""
    n = ends - starts
    which = np.repeat(np.arange(len(n)), n)
    return which, np.arange(len(which)) - np.repeat(np.cumsum(n) - n, n) + starts[which]


def search(index: Index, rows: np.ndarray, hashes: np.ndarray, n_rows: int) -> list[tuple]:
    """(row, item, score, question overlap, answer overlap, first word) of all passages that hold an item.

    Block-max: sums of block bounds leave out every (passage, block) that cannot reach `SCORE`;
    items of the blocks left are scored in full, over the passage's distinct terms.
    """
    if not len(index.terms) or not len(hashes):
        return []
    at = np.minimum(np.searchsorted(index.terms, hashes), len(index.terms) - 1)
    known = np.flatnonzero(index.terms[at] == hashes)
    if not len(known):
        return []
    first_word = np.concatenate(([0], np.cumsum(np.bincount(rows, minlength=n_rows))))
    place = (np.arange(len(hashes)) - first_word[rows]) // index.bucket
    most = int(place.max()) + 2
    # distinct (bucket, term); a bucket's number leaves a gap after the last one of a row
    key = np.unique((rows[known] * most + place[known]) * len(index.terms) + at[known])
    bucket, term = key // len(index.terms), key % len(index.terms)
    buckets, bucket = np.unique(bucket, return_inverse=True)
    cuts = _starts(bucket, len(buckets))
    blocks = len(index.common_in_block)
    step = max(1, CELLS // max(blocks, 1))
    out = []
    for low in range(0, len(buckets), step):
        high = min(len(buckets), low + step + 1)  # one more: a passage reaches into the next bucket
        owner, t = bucket[cuts[low] : cuts[high]] - low, term[cuts[low] : cuts[high]]
        which, where = _ragged(index.bound_start[t], index.bound_start[t + 1])
        cell = owner[which] * blocks + index.bound_block[where]
        bound = np.bincount(cell, weights=index.bound_impact[where], minlength=(high - low) * blocks).reshape(-1, blocks)
        follows = np.zeros(high - low + 1, bool)  # whether a bucket goes on where the one before it ends
        follows[1 : high - low] = buckets[low + 1 : high] == buckets[low : high - 1] + 1
        ahead = np.flatnonzero(follows) - 1
        bound[ahead] += bound[ahead + 1]
        open_ = bound + index.common_in_block >= SCORE - 1e-9
        open_[min(step, high - low) :] = False
        # distinct terms of the passages that have an open block, their postings in these blocks, and the sums of those
        second = follows[owner]
        passage, t = np.concatenate((owner, owner[second] - 1)), np.concatenate((t, t[second]))
        wanted = open_.any(1)[passage]
        pair = np.unique(passage[wanted] * len(index.terms) + t[wanted])
        passage, t = pair // len(index.terms), pair % len(index.terms)
        which, where = _ragged(index.posting_start[t], index.posting_start[t + 1])
        passage, item = passage[which], index.posting_item[where]
        left = open_[passage, item // BLOCK_ITEMS]
        cell, at_cell = np.unique(passage[left] * (blocks * BLOCK_ITEMS) + item[left], return_inverse=True)
        score = np.bincount(at_cell, weights=index.posting_impact[where[left]], minlength=len(cell))
        for key, value in zip(cell[score >= SCORE].tolist(), score[score >= SCORE].tolist()):
            passage_no, item_no = divmod(key, blocks * BLOCK_ITEMS)
            row, nth = divmod(int(buckets[low + passage_no]), most)
            begin = first_word[row] + nth * index.bucket
            words = hashes[begin : min(begin + 2 * index.bucket, first_word[row + 1])]
            shares = [float(np.isin(g, _grams(words, width)).mean()) if len(g) else 0.0 for width, g in index.grams[item_no]]
            if min(shares) >= OVERLAP:
                out.append((row, item_no, value, *shares, int(nth * index.bucket)))
    return out


def _best(hits: list[tuple]) -> list[tuple]:
    """One hit per row and item: the highest score, then the earliest passage."""
    best: dict[tuple, tuple] = {}
    for hit in hits:
        old = best.get(hit[:2])
        if old is None or hit[2] > old[2] + 1e-12:
            best[hit[:2]] = hit
    return list(best.values())


def _terms(items: DataFrame) -> DataFrame:
    """Rows (item, item_id, text, term, tf, words); an item without a word has no row."""

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_bytes(batch.column("text"))
            rows, hashes = word_hashes(data, offsets, ALPHANUMERIC)
            words = np.bincount(rows, minlength=batch.num_rows)
            order = np.lexsort((hashes, rows))
            rows, hashes = rows[order], hashes[order]
            new = np.flatnonzero(np.concatenate(([True], (rows[1:] != rows[:-1]) | (hashes[1:] != hashes[:-1])))) if len(rows) else rows
            tf = np.diff(np.append(new, len(rows)))
            yield pa.RecordBatch.from_arrays(
                [batch.column("item").take(pa.array(rows[new])), pa.array(hashes[new].view(np.int64)), pa.array(tf, pa.int64()), pa.array(words[rows[new]], pa.int64())],
                ["item", "term", "tf", "words"],
            )

    return items.select("item", "text").mapInArrow(split, "item bigint, term bigint, tf bigint, words bigint")


def _indexes(spark: SparkSession, benchmark: DataFrame) -> Iterator[Broadcast]:
    """The index of all items of `benchmark` (item_id, text), in parts of at most about `PART_ITEMS` items."""
    items = written(
        benchmark.select(F.monotonically_increasing_id().alias("item"), F.col("item_id").cast("bigint").alias("item_id"), "text"), "items"
    )
    terms = written(_terms(items), "terms")
    about = terms.groupBy("item").agg(F.first("words").alias("words"))
    totals = about.agg(F.count(F.lit(1)).alias("n"), F.avg("words").alias("mean"), F.max("words").alias("longest")).first()
    n, mean, longest = totals["n"], totals["mean"] or 1.0, totals["longest"] or 0
    df = terms.groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    norm = F.col("tf") + K1 * (1 - B + B * F.col("words") / F.lit(mean))
    impact = F.log(1 + (F.lit(n) - F.col("df") + 0.5) / (F.col("df") + 0.5)) * F.col("tf") * (K1 + 1) / norm
    scored = terms.join(df, "term").select("item", "term", impact.alias("impact"), (F.col("df") > COMMON_SHARE * n).alias("frequent"))
    own = scored.groupBy("item").agg(F.sum("impact").alias("own"))
    scored = scored.join(own, "item").select("item", "term", (F.col("impact") / F.col("own")).alias("impact"), "frequent")
    parts = -(-n // PART_ITEMS)
    part = F.pmod(F.xxhash64("item"), F.lit(max(parts, 1)))
    for p in range(parts):
        held = items.where(part == p).orderBy("item").collect()
        number = {r["item"]: i for i, r in enumerate(held)}
        postings = scored.where(part == p).toPandas()
        postings["item"] = postings["item"].map(number)
        yield spark.sparkContext.broadcast(build_index(postings, [(r["item_id"], r["text"]) for r in held], longest))


def _hits(index: Index, texts: pa.Array) -> list[tuple]:
    """Hits of `search` in a column of texts, the best of each row and item."""
    data, offsets = text_bytes(texts)
    hits = []
    for start, end in row_chunks(offsets):
        rows, hashes = word_hashes(data[offsets[start] : offsets[end]], offsets[start : end + 1] - offsets[start], ALPHANUMERIC)
        hits += [(start + h[0], *h[1:]) for h in _best(search(index, rows, hashes, end - start))]
    return hits


def contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Rows (doc_id, item_id, score, question_overlap, answer_overlap, first_word): items that documents hold.

    docs: (doc_id, text), benchmark: (item_id, text), further columns are not used. The items'
    index is built from all of them and sent out in parts of at most `PART_ITEMS` items, each
    asked with every passage; documents are never shuffled. A passage (two buckets of words)
    retrieves the items of which it reaches `SCORE` of the BM25 score they have for themselves,
    and holds one when `OVERLAP` of its question's and of its answer's trigrams are there too.
    Null and empty texts on either side match nothing; repeated rows give hits each; an empty
    table on either side gives no rows.
    """
    schema = "doc_id bigint, item_id bigint, score double, question_overlap double, answer_overlap double, first_word bigint"
    spark = docs.sparkSession
    out = spark.createDataFrame([], schema)
    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    for shared in _indexes(spark, benchmark):

        def ask(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            index = shared.value
            for batch in batches:
                row, item, *rest = list(zip(*_hits(index, batch.column("text")))) or [()] * 6
                ids = batch.column("doc_id").take(pa.array(row, pa.int64()))
                kinds = [pa.float64(), pa.float64(), pa.float64(), pa.int64()]
                columns = [ids, pa.array([index.item_ids[i] for i in item], pa.int64()), *[pa.array(c, k) for c, k in zip(rest, kinds)]]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "item_id", "score", "question_overlap", "answer_overlap", "first_word"])

        out = out.unionByName(docs.mapInArrow(ask, schema))
    return out


def decontaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Rows of `docs`, with all their columns, whose text holds no item by the rule of `contaminated`."""
    for shared in _indexes(docs.sparkSession, benchmark):

        def clean(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                keep = np.ones(batch.num_rows, bool)
                keep[[h[0] for h in _hits(shared.value, batch.column("text"))]] = False
                yield batch.filter(pa.array(keep))

        docs = docs.mapInArrow(clean, docs.schema)
    return docs
