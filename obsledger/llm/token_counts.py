"""Token counts without ids: pieces counted once per distinct pre-token, then summed per document."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from obsledger.llm.frequencies import common_values, sums_by_document, token_counts
from obsledger.session import written

SPACE = "▁".encode()  # how the vocabulary writes a space
_RUNS = re.compile(rb" *[^ \n]+| +")
_NEWLINE = re.compile(rb"\n")
_models: dict = {}


def _model(path: str):
    import sentencepiece

    if path not in _models:
        _models[path] = sentencepiece.SentencePieceProcessor(model_file=path)
    return _models[path]


def check_vocabulary(path: str) -> None:
    """Raise unless no piece has a space after another character, or a newline together with anything.

    Only then is a text's encoding the chain of the encodings of its pre-tokens: merges never reach
    across such a place, so each side is merged as if it stood alone.
    """
    model = _model(path)
    for i in range(model.vocab_size()):
        piece = model.id_to_piece(i)
        if re.search("[^▁]▁", piece) or ("\n" in piece and len(piece) > 1):
            raise ValueError(f"piece {piece!r} spans two pre-tokens")


def pre_tokens(text: bytes) -> list[bytes]:
    """Cut before each run of spaces and around newlines; the encoder's own leading space is put in.

    A key is what follows the first space of a pre-token; one without a space (after a newline)
    has a newline in front instead, and a newline itself is the key b"\\n".
    """
    if not text:
        return []
    text = b" " + text.replace(SPACE, b" ")
    if b"  " in text:
        out = [t[1:] if t[0] == 32 else b"\n" + t for t in _RUNS.findall(text)]
        return out + [b"\n"] * text.count(b"\n")
    lines = text.split(b"\n")
    out = [b"\n"] * (len(lines) - 1)
    for line in lines:
        parts = line.split(b" ")
        if parts[0]:
            parts[0] = b"\n" + parts[0]
            out += parts
        else:
            out += parts[1:]
    return out


def piece_counts(keys: list[bytes], path: str) -> list[int]:
    """Pieces of each pre-token key."""
    ids = _model(path).encode([k.decode() for k in keys], num_threads=1)
    # a newline in front costs its own piece and the encoder's leading space
    return [1 if k in (b"", b"\n") else len(x) - 2 * (k[0] == 10) for k, x in zip(keys, ids)]


def count_pieces(docs: DataFrame, model_path: str) -> DataFrame:
    """Rows (doc_id, n_bytes, n_tokens): pieces of every whole text of `docs` (doc_id, text).

    1. Every task counts the pre-tokens of its texts; summed over all tasks, each distinct one
       comes once, and its pieces are counted once.
    2. Documents meet these counts by their per-document pre-token frequencies and sum. Ids are
       never kept. Null and empty texts have 0 bytes and 0 tokens; repeated rows stay apart;
       an empty table gives no rows; extra columns are not used.
    """
    check_vocabulary(model_path)

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counted = pa.array(piece_counts(batch.column("token").to_pylist(), model_path), pa.float64())
            zero = pa.array([0.0] * len(counted), pa.float64())
            yield pa.RecordBatch.from_arrays([batch.column("token"), batch.column("n"), counted, zero], ["token", "n", "v", "w"])

    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    counts = token_counts(docs, pre_tokens)
    values = written(counts.mapInArrow(pieces, "token binary, n bigint, v double, w double"), "pieces")
    total = values.agg(F.sum("n")).first()[0] or 0
    sums = sums_by_document(docs, pre_tokens, values, common_values(values, total))
    return sums.select("doc_id", "n_bytes", F.col("sum_v").cast("bigint").alias("n_tokens"))
