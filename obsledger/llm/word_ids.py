"""Token ids of whole Arrow text columns, chained from the ids of their words."""

from __future__ import annotations

import os
from array import array

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from obsledger.llm.text import KEPT

WORDS_KEPT = 100_000  # words in each of a worker's two generations
LONGEST_KEPT = 64  # bytes of a word that is kept
# ASCII marks at the end of a word; not those that contractions and special tokens have.
_CLOSING = bytes(c for c in range(33, 127) if chr(c) in "!\"#$%&()*+,-./:;=?@[\\]^_`{}~")
_tokenizers: dict = {}


def load_tokenizer(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallel part
    from tokenizers import Tokenizer

    if path not in _tokenizers:
        _tokenizers[path] = Tokenizer.from_file(path)
    return _tokenizers[path]


def byte_signs() -> dict[int, int]:
    """What stands for each byte in a byte-level vocabulary: itself where printable, else the next free sign from 256 on."""
    printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = [b for b in range(256) if b not in printable]
    return {b: b for b in printable} | {b: 256 + i for i, b in enumerate(others)}


class WordIds:
    """Ids of texts, as little-endian 32-bit numbers, chained from the ids of their words.

    Exact for a vocabulary that drops white space, lower-cases, and parts letters from
    punctuation before it merges. Arrow cuts a column into words and numbers the distinct ones;
    only these are looked up. A worker keeps two generations of at most `WORDS_KEPT` words: a
    word found in the older one moves to the younger, and a full younger one becomes the older,
    so frequent words are never lost. Words of lower-case Latin letters go to the merges directly;
    all others, with texts that may spell a special token, through the whole library.
    """

    MARK = b"0"  # a digit is a token of its own: it parts words that are encoded together
    TOGETHER = 64

    def __init__(self, path: str):
        self.tokenizer = load_tokenizer(path)
        self.merges = self.tokenizer.model.tokenize
        self.young: dict[bytes, bytes] = {}
        self.old: dict[bytes, bytes] = {}
        self.signs = byte_signs()
        self.mark = self._library(self.MARK)
        self.joinable = len(self.mark) == 1

    def _library(self, text: bytes) -> list[int]:
        return self.tokenizer.encode(text.decode(), add_special_tokens=False).ids

    def _encoded(self, words: list[bytes]) -> dict[bytes, bytes]:
        """Ids of distinct words without a closing mark."""
        out, rest, merges = {}, [], self.merges
        for word in words:
            if word.isalpha() and word.islower():  # ASCII
                out[word] = array("I", [t.id for t in merges(word.decode())]).tobytes()
                continue
            text = word.decode()
            if text.isalpha() and text.islower() and max(text) < "ƀ":
                out[word] = array("I", [t.id for t in merges(word.decode("latin-1").translate(self.signs))]).tobytes()
            else:
                rest.append(word)
        together = [w for w in rest if self.joinable and self.MARK not in w and b"<" not in w]
        for start in range(0, len(together), self.TOGETHER):
            part = together[start : start + self.TOGETHER]
            ids = np.array(self._library(b" 0 ".join(part)), "<u4")
            cuts = np.flatnonzero(ids == self.mark[0])
            if len(cuts) != len(part) - 1:  # another sign for the same digit: one by one
                continue
            raw, starts, ends = ids.tobytes(), [0, *(4 * cuts + 4).tolist()], [*(4 * cuts).tolist(), 4 * len(ids)]
            out.update((w, raw[x:y]) for w, x, y in zip(part, starts, ends))
        out.update((w, np.array(self._library(w), "<u4").tobytes()) for w in rest if w not in out)
        return out

    def _look_up(self, words: list[bytes]) -> tuple[list[bytes | None], list[int]]:
        """What is known of some words, and the places of those that are not."""
        found = list(map(self.young.get, words))
        missing, young, old = [], self.young, self.old
        for at in [i for i, ids in enumerate(found) if ids is None]:
            found[at] = ids = old.get(words[at])
            if ids is None:
                missing.append(at)
            else:
                young[words[at]] = ids
        return found, missing

    def ids_of(self, words: list[bytes]) -> list[bytes]:
        """Ids of each of some distinct words."""
        found, missing = self._look_up(words)
        whole, closed = {}, {}
        for at in missing:
            word = words[at]
            head = word.rstrip(_CLOSING)
            if head and len(head) < len(word) and 97 <= head[-1] <= 122 and b"<" not in word:
                closed[at] = (head, word[len(head) :])
            else:
                whole[at] = word
        parts = list({p for cut in closed.values() for p in cut}.difference(whole.values()))
        known, unknown = self._look_up(parts)
        new = self._encoded([*whole.values(), *(parts[i] for i in unknown)])
        known = {p: ids for p, ids in zip(parts, known) if ids is not None} | new
        for at, word in whole.items():
            found[at] = known[word]
        for at, (head, marks) in closed.items():
            found[at] = new[words[at]] = known[head] + known[marks]
        self.young.update((w, ids) for w, ids in new.items() if len(w) <= LONGEST_KEPT)
        if len(self.young) > WORDS_KEPT:
            self.young, self.old = {}, self.young
        return found

    def column(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, one after the other, and the n+1 places where the rows begin; null counts as empty."""
        texts = pa.concat_arrays([texts.cast(pa.large_string())]).fill_null("")  # a slice of its own: kernels misread offsets of a cast one
        special = pc.match_substring(texts, "<|")
        lowered = pc.ascii_lower(texts)
        if pc.any(special).as_py():
            lowered = pc.if_else(special, texts, lowered)
        split = pc.ascii_split_whitespace(lowered)
        words = split.flatten().dictionary_encode()
        ids = self.ids_of(words.dictionary.cast(pa.large_binary()).to_pylist())
        chained = pa.array(ids, pa.large_binary()).take(words.indices)
        ends = np.frombuffer(chained.buffers()[1], np.int64)[: len(chained) + 1] >> 2
        bounds = split.offsets.to_numpy()
        return np.frombuffer(chained.buffers()[2] or b"", "<u4")[: ends[-1]], ends[bounds - bounds[0]]

    def encode(self, texts: list[bytes]) -> list[bytes]:
        """Ids of each text, packed."""
        ids, bounds = self.column(pa.array([t.decode() for t in texts], pa.large_string()))
        return [ids[a:b].tobytes() for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist())]


def kept_encoder(path: str) -> WordIds:
    """The worker's encoder, with the words it knows, until a hashing operator needs the memory."""
    if path not in KEPT:
        pa.default_memory_pool().release_unused()  # what other operators had
        KEPT[path] = WordIds(path)
    return KEPT[path]
