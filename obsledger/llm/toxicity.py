"""Toxicity: dense text features, gradient-boosted trees, isotonic calibration."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from obsledger.llm.text import ALPHANUMERIC, U64, mix, prefix_hashes, remainder, row_chunks, span_hashes, text_bytes
from obsledger.session import written

SAMPLE = 40_000  # labelled rows the classifier is fitted on, at most: those with the smallest hash of their id
HELD_OUT_PARTS, HELD_OUT = 3, 1
LEXICON = 5_000  # entries at most
LEAST_Z = 3.0  # of a lexicon entry's log odds between toxic and other texts
TREES, DEPTH, STEP, SEED = 30, 3, 0.2, 7
CALIBRATION_PARTS = 4  # one part in so many calibrates, the others grow the trees
THRESHOLD = 0.7
NEAR = 5  # words
PREFIX = 6  # bytes of the word beginnings that the lexicon may hold too

# Second-person words of the corpus's languages, and look-alike characters.
SECOND_PERSON = (
    "you your yours yourself u du dich dir dein deine deinen euch ihr tu te toi ton ta tes vous votre vos tú ti usted ustedes vosotros su"
).split()
LOOK_ALIKES = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s", "!": "i", "|": "i"}

FEATURES = (
    "hit_weight_density hit_count hit_max prefix_weight_density prefix_count hidden_density hidden_count "
    "near_density near_count second_density capital_share capital_words punctuation exclamation symbols digits "
    "mixed_words letters_alone long_runs log_words word_length"
).split()

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_FROM_LOOK_ALIKE = _LOWER.copy()
for _a, _b in LOOK_ALIKES.items():
    _FROM_LOOK_ALIKE[ord(_a)] = ord(_b)
_LETTER = np.array([chr(b).isalpha() and b < 128 or b >= 128 for b in range(256)])
_UPPER = np.array([65 <= b <= 90 for b in range(256)])
_DIGIT = np.array([48 <= b <= 57 for b in range(256)])
_HIDING = ALPHANUMERIC.copy()
_HIDING[[ord(c) for c in LOOK_ALIKES]] = True
_PUNCTUATION = np.array([chr(b) in ".,;:!?'\"()-" for b in range(256)])
_SYMBOL = np.array([chr(b) in "#$%&*+/<=>@[\\]^_`{|}~" for b in range(256)])
PREFIX_SALT = U64(0x2545F4914F6CDD1D)


def _lowered(data: np.ndarray) -> np.ndarray:
    """Lower case of A-Z and of the accented letters whose UTF-8 begins with 0xC3."""
    out = _LOWER[data]
    if len(out) > 1:
        accented = (data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] <= 0x9E) & (data[1:] != 0x97)
        out[1:][accented] += 32
    return out


def _spans(inside: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and row of each run; runs end where rows do."""
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    begin = offsets[:-1][offsets[:-1] < len(inside)]
    first[begin] |= inside[begin]
    end = offsets[1:][offsets[1:] > 0] - 1
    last[end] |= inside[end]
    starts = np.flatnonzero(first)
    return starts, np.flatnonzero(last) + 1, np.searchsorted(offsets, starts, side="right") - 1


def _keys(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each word, and of its beginning (0 where the word is not longer than that)."""
    sums = prefix_hashes(data)
    long = ends - starts > PREFIX
    heads = np.zeros(len(starts), np.uint64)
    heads[long] = mix(span_hashes(sums, starts[long], starts[long] + PREFIX) ^ PREFIX_SALT)
    return span_hashes(sums, starts, ends), heads


def word_key(word: str) -> int:
    data = _lowered(np.frombuffer(word.encode(), np.uint8))
    return int(span_hashes(prefix_hashes(data), np.array([0]), np.array([len(data)]))[0])


SECOND_PERSON_KEYS = np.sort(np.array([word_key(w) for w in SECOND_PERSON], np.uint64))


@dataclass
class Lexicon:
    """Sorted keys of words and word beginnings that are frequent in toxic texts, with their log odds."""

    keys: np.ndarray
    weights: np.ndarray

    def of(self, keys: np.ndarray) -> np.ndarray:
        if not len(self.keys):
            return np.zeros(len(keys))
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where(self.keys[at] == keys, self.weights[at], 0.0)


def _once(rows: np.ndarray, keys: np.ndarray, where: np.ndarray) -> np.ndarray:
    """Of the marked words of a text, each distinct one once: a repeated word is no stronger sign."""
    at = np.flatnonzero(where)
    order = at[np.lexsort((keys[at], rows[at]))]
    new = np.ones(len(order), bool)
    new[1:] = (rows[order][1:] != rows[order][:-1]) | (keys[order][1:] != keys[order][:-1])
    out = np.zeros(len(rows), bool)
    out[order[new]] = True
    return out


def features(data: np.ndarray, offsets: np.ndarray, lexicon: Lexicon) -> np.ndarray:
    """A row of `FEATURES` per text; all zero for a text without a byte."""
    n = len(offsets) - 1
    row_of = np.repeat(np.arange(n), np.diff(offsets))

    def count(where: np.ndarray, rows: np.ndarray, weights: np.ndarray | None = None) -> np.ndarray:
        return np.bincount(rows[where], None if weights is None else weights[where], minlength=n).astype(float)

    lowered = _lowered(data)
    starts, ends, rows = _spans(ALPHANUMERIC[data], offsets)
    keys, heads = _keys(lowered, starts, ends)
    weight, head_weight = lexicon.of(keys), lexicon.of(heads)
    hit, head_hit = _once(rows, keys, weight > 0), _once(rows, heads, head_weight > 0)
    any_hit = (weight > 0) | (head_weight > 0)
    words = np.bincount(rows, minlength=n).astype(float)
    at = np.searchsorted(SECOND_PERSON_KEYS, keys)
    second = SECOND_PERSON_KEYS[np.minimum(at, len(SECOND_PERSON_KEYS) - 1)] == keys
    # words with a second-person word at most NEAR words away, by running counts
    upto = np.concatenate(([0], np.cumsum(second)))
    first_word = np.concatenate(([0], np.cumsum(words))).astype(np.int64)
    place = np.arange(len(rows))
    low = np.maximum(place - NEAR, first_word[rows])
    high = np.minimum(place + NEAR + 1, first_word[rows + 1])
    near = any_hit & (upto[high] > upto[low])

    hidden_starts, hidden_ends, hidden_rows = _spans(_HIDING[data], offsets)
    disguised = _FROM_LOOK_ALIKE[data]
    plain = np.concatenate(([0], np.cumsum(disguised != _LOWER[data])))
    changed = plain[hidden_ends] > plain[hidden_starts]
    hidden_keys, _ = _keys(disguised, hidden_starts[changed], hidden_ends[changed])
    hidden = np.zeros(n) + np.bincount(hidden_rows[changed], lexicon.of(hidden_keys) > 0, minlength=n)

    letters = np.concatenate(([0], np.cumsum(_LETTER[data])))
    capitals = np.concatenate(([0], np.cumsum(_UPPER[data])))
    length = ends - starts
    has_letters, has_capitals = letters[ends] - letters[starts], capitals[ends] - capitals[starts]
    mixed = (has_letters > 0) & (has_letters < length)
    run = np.zeros(len(data), bool)
    run[2:] = (data[2:] == data[1:-1]) & (data[1:-1] == data[:-2]) & _LETTER[data[2:]]
    size = np.maximum(np.diff(offsets), 1)
    per_word = np.maximum(words, 1)
    best = np.zeros(n)
    np.maximum.at(best, rows[hit], weight[hit])
    return np.stack(
        [
            count(hit, rows, weight) / per_word,
            np.log1p(count(hit, rows)),
            best,
            count(head_hit, rows, head_weight) / per_word,
            np.log1p(count(head_hit, rows)),
            hidden / per_word,
            np.log1p(hidden),
            count(near, rows) / per_word,
            np.log1p(count(near, rows)),
            count(second, rows) / per_word,
            count(_UPPER[data], row_of) / np.maximum(count(_LETTER[data], row_of), 1),
            count((has_capitals == length) & (length > 1), rows) / per_word,
            count(_PUNCTUATION[data], row_of) / size,
            count(data == ord("!"), row_of) / size,
            count(_SYMBOL[data], row_of) / size,
            count(_DIGIT[data], row_of) / size,
            count(mixed, rows) / per_word,
            count((length == 1) & (has_letters == 1), rows) / per_word,
            count(run, row_of) / size,
            np.log1p(words),
            (np.bincount(rows, length, minlength=n)) / per_word,
        ],
        1,
    )


def _with_features(docs: DataFrame, lexicons: list[Lexicon]) -> DataFrame:
    """The columns of `docs` but text, and `x`; column `fold` says which lexicon a row's features come from."""
    kept = [f for f in docs.schema.fields if f.name != "text"]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept) + ", x array<double>"
    shared = docs.sparkSession.sparkContext.broadcast(lexicons)

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_bytes(batch.column("text"))
            fold = batch.column("fold").to_numpy(zero_copy_only=False)
            for start, end in row_chunks(offsets, 1 << 19):
                part, inner = data[offsets[start] : offsets[end]], offsets[start : end + 1] - offsets[start]
                values = np.zeros((end - start, len(FEATURES)))
                for i in np.unique(fold[start:end]):
                    values = np.where((fold[start:end] == i)[:, None], features(part, inner, shared.value[i]), values)
                x = pa.ListArray.from_arrays(pa.array(np.arange(end - start + 1) * len(FEATURES), pa.int32()), pa.array(values.ravel()))
                yield pa.RecordBatch.from_arrays([*[batch.column(f.name).slice(start, end - start) for f in kept], x], [*[f.name for f in kept], "x"])

    return docs.mapInArrow(look, schema)


def _lexicons(sample: DataFrame) -> list[Lexicon]:
    """Three lexicons from `sample` (text, toxic, fold): for rows of fold 0 from the others, of fold 1 likewise, and from all."""

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_bytes(batch.column("text"))
            for start, end in row_chunks(offsets, 1 << 19):
                part, inner = data[offsets[start] : offsets[end]], offsets[start : end + 1] - offsets[start]
                starts, ends, rows = _spans(ALPHANUMERIC[part], inner)
                keys, heads = _keys(_lowered(part), starts, ends)
                long = heads != 0
                rows, keys = np.concatenate((rows, rows[long])), np.concatenate((keys, heads[long]))
                order = np.lexsort((keys, rows))
                rows, keys = rows[order], keys[order]
                new = np.ones(len(rows), bool)
                new[1:] = (rows[1:] != rows[:-1]) | (keys[1:] != keys[:-1])
                at = pa.array(rows[new] + start)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys[new].view(np.int64)), batch.column("toxic").take(at), batch.column("fold").take(at)],
                    ["key", "toxic", "fold"],
                )

    sizes = {(r["toxic"], r["fold"]): r["count"] for r in sample.groupBy("toxic", "fold").count().collect()}
    seen = sample.mapInArrow(split, "key bigint, toxic int, fold int").groupBy("key").agg(
        *[F.count_if((F.col("toxic") == t) & (F.col("fold") == f)).alias(f"n{t}{f}") for t in (0, 1) for f in (0, 1)]
    )
    seen = written(seen.where("n10 + n11 > 0"), "lexicon")  # what no toxic text has is in no lexicon
    out = []
    for folds in ((1,), (0,), (0, 1)):
        n = [F.lit(0) + sum(F.col(f"n{t}{f}") for f in folds) for t in (0, 1)]
        total = [sum(sizes.get((t, f), 0) for f in folds) for t in (0, 1)]
        odds = F.log((n[1] + 0.5) / (total[1] + 1)) - F.log((n[0] + 0.5) / (total[0] + 1))
        z = odds / F.sqrt(1 / (n[1] + 0.5) + 1 / (n[0] + 0.5))
        best = seen.select("key", odds.alias("w"), z.alias("z")).where(F.col("z") >= LEAST_Z)
        best = best.orderBy(F.desc("z"), "key").limit(LEXICON).toPandas()
        keys = best["key"].to_numpy(np.int64).view(np.uint64)
        order = np.argsort(keys)
        out.append(Lexicon(keys[order], best["w"].to_numpy(np.float64)[order]))
    return out


def _fitted(rows: DataFrame, labels: DataFrame) -> Callable[[DataFrame], DataFrame]:
    """Learn from the labelled of `rows` (doc_id, text) that are not held out.

    The result adds `score` to frames with a column `text`, which it takes away.
    """
    votes = labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL").select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
    votes = votes.where(remainder(F.col("doc_id"), HELD_OUT_PARTS) != HELD_OUT).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    votes = votes.orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE)
    sample = written(rows.join(F.broadcast(votes), "doc_id").withColumn("_h", F.xxhash64("text")), "labelled")
    distinct = sample.groupBy("_h").agg(F.min("doc_id").alias("doc_id"), (F.avg("toxic") >= 0.5).cast("int").alias("toxic"))
    sample = sample.select("doc_id", "text", "_h").join(F.broadcast(distinct), ["_h", "doc_id"])  # at most SAMPLE rows
    sample = sample.dropDuplicates(["_h"]).withColumn("fold", F.pmod("_h", F.lit(2)).cast("int")).select("text", "toxic", "fold", "_h")
    sample = written(sample, "training")
    classes = {r["toxic"]: r["count"] for r in sample.groupBy("toxic").count().collect()}
    if len(classes) < 2:
        share = 1.0 if classes.get(1) else 0.0
        return lambda docs: docs.drop("text").withColumn("score", F.lit(share))
    lexicons = _lexicons(sample.select("text", "toxic", "fold"))
    known = _with_features(sample.withColumn("toxic", F.col("toxic").cast("double")), lexicons)
    known = written(known.select("_h", array_to_vector("x").alias("x"), "toxic").repartition(4, "_h").sortWithinPartitions("_h"), "features")
    part = F.pmod(F.shiftright("_h", 8), F.lit(CALIBRATION_PARTS))
    grow, calibrate = known.where(part > 0), known.where(part == 0)
    if grow.select("toxic").distinct().count() < 2:
        grow = known
    if not calibrate.take(1):
        calibrate = known
    trees = GBTClassifier(featuresCol="x", labelCol="toxic", maxIter=TREES, maxDepth=DEPTH, stepSize=STEP, seed=SEED, minInstancesPerNode=5)
    trees = trees.fit(grow)
    raw = vector_to_array("probability")[1].alias("raw")
    steps = IsotonicRegression(featuresCol="raw", labelCol="toxic", predictionCol="score").fit(trees.transform(calibrate).select(raw, "toxic"))

    def score(docs: DataFrame) -> DataFrame:
        kept = [c for c in docs.columns if c != "text"]
        x = _with_features(docs.withColumn("fold", F.lit(2)), lexicons).select(*kept, array_to_vector("x").alias("x"))
        scored = steps.transform(trees.transform(x).select(*kept, raw))
        return scored.select(*kept, F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.col("score"))).alias("score"))

    return score


def score_toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Rows (doc_id, held_out, score, predicted) for every whole text of `docs` (doc_id, text).

    Learns from `labels` (doc_id, toxic 0/1) of documents that are not held out, at most `SAMPLE`
    of them, each distinct text once. The lexicon, the `LEXICON` words and word beginnings whose
    log odds are surest, at most, is learned from this sample too; a training row's features come from a lexicon learned without its
    fold. Three quarters of the rows grow the trees, the others calibrate their probability by
    isotonic regression. Inputs of a score are the features of the text alone.

    A null text counts as empty and gets the score of an empty text. Rows with a null id are
    not held out and carry no label; repeated rows are scored each; conflicting labels of one
    text count by their majority. Without labelled texts of both classes the score is that of
    the only one (0 without any). Further columns are not used.
    """
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    scored = _fitted(rows, labels)(rows)
    held_out = remainder(F.col("doc_id"), HELD_OUT_PARTS) == HELD_OUT
    return scored.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def without_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Rows of `docs`, with all their columns, that `score_toxicity` does not predict to be toxic."""
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    scored = _fitted(rows, labels)(docs.select(F.struct("*").alias("_doc"), "text"))
    return scored.where(F.col("score") < THRESHOLD).select("_doc.*")
