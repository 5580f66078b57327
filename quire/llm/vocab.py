"""Public vocabulary files for tasks.

A file is read once on the driver and broadcast: its size is that of the
vocabulary (1 to 4 MB), whatever the input, and is checked.  Workers build their
tokenizer once from the broadcast bytes; they need no file of their own.
"""

from __future__ import annotations

import base64
import functools
import json
import os
import re
from array import array
from itertools import chain

import numpy as np
from pyspark.sql import SparkSession

MAX_BYTES = 64 << 20


def broadcast_file(spark: SparkSession, path: str):
    """The bytes of the vocabulary file at ``path`` as a broadcast variable."""
    if os.path.getsize(path) > MAX_BYTES:
        raise ValueError(f"{path} is larger than {MAX_BYTES} bytes: not a vocabulary to broadcast")
    with open(path, "rb") as f:
        return spark.sparkContext.broadcast(f.read())


def ranks_of(data: bytes) -> dict[bytes, int]:
    """Token bytes and ids of a rank file (a base64 token and its id a line)."""
    return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, data.splitlines())}


@functools.lru_cache(maxsize=2)
def byte_bpe(data: bytes, pattern: str):
    import tiktoken

    return tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks_of(data), special_tokens={})


@functools.lru_cache(maxsize=2)
def token_bytes(data: bytes) -> list[bytes]:
    """The bytes of each id; ids without a token are empty."""
    ranks = ranks_of(data)
    table = [b""] * (max(ranks.values(), default=-1) + 1)
    for token, rank in ranks.items():
        table[rank] = token
    return table


@functools.lru_cache(maxsize=2)
def _word_bpe(data: bytes):
    from tokenizers import Tokenizer

    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
    return WordBpe(Tokenizer.from_str(data.decode()))


class _Codes(dict):
    """Words to codes; words without one yet get the next and are noted."""

    def __init__(self):
        self.new: list[str] = []

    def __missing__(self, word):
        self[word] = code = len(self)
        self.new.append(word)
        return code


#: Steps before the model that leave a lower-case word of Latin letters as it is, in the
#: byte alphabet, and cut it from the signs after it.
_NORMALIZERS = [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]
_PRETOKENIZERS = [
    {"type": "Split", "pattern": {"Regex": "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"}, "behavior": "Removed", "invert": True},
    {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
]
_WORD_AND_SIGNS = re.compile("([A-Za-zÀ-ÖØ-öø-ÿ]+)([!-/:-@\\[-`{-~]*)")


def _byte_alphabet() -> dict[int, str]:
    """Bytes to the characters that byte-level vocabularies write them as."""
    printed = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in printed]
    return {b: chr(b) for b in printed} | {b: chr(256 + i) for i, b in enumerate(others)}


_BYTES = _byte_alphabet()


class WordBpe:
    """Ids of texts by a tokenizer that drops white space and never lets a
    token cross it: texts are cut at space, tab and line feed, and each distinct
    stretch between them is encoded once, as long as it is remembered.

    New stretches are encoded together, set apart by a special token, whose id
    marks where each one ends; one that holds special tokens itself is encoded
    alone, as ordinary text.

    Where the tokenizer's steps before its model are known to change nothing but
    their case, Latin words go to the model directly, once for all cases and signs
    that follow them."""

    REMEMBERED = 600_000
    TOGETHER = 64

    def __init__(self, tokenizer):
        special = [t for t in tokenizer.get_added_tokens_decoder().values() if t.special]
        if not special:
            raise ValueError("the tokenizer has no special token to set words apart by")
        self.tokenizer, self.marks = tokenizer, [t.content for t in special]
        self.mark = tokenizer.token_to_id(self.marks[0])
        steps = json.loads(tokenizer.to_str())
        known = [steps[s] or {} for s in ("normalizer", "pre_tokenizer")]
        self.direct = known[0].get("normalizers") == _NORMALIZERS and known[1].get("pretokenizers") == _PRETOKENIZERS and all(t["special"] for t in steps["added_tokens"])
        self.model = tokenizer.model
        self._forget()

    def _forget(self):
        self.latin: dict[str, bytes] = {}
        self.signs: dict[str, bytes] = {"": b""}
        self.codes, self.start, self.size, self.ids = _Codes(), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, "<u4")

    def _encode(self, texts: list[str], special: bool) -> list[list[int]]:
        self.tokenizer.encode_special_tokens = not special
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _latin(self, word: str) -> bytes:
        """The ids of a lower-case word of Latin letters."""
        if (ids := self.latin.get(word)) is None:
            written = word if word.isascii() else "".join(map(_BYTES.__getitem__, word.encode()))
            ids = self.latin[word] = array("I", [t.id for t in self.model.tokenize(written)]).tobytes()
        return ids

    def _signs(self, signs: str) -> bytes:
        if (ids := self.signs.get(signs)) is None:
            ids = self.signs[signs] = array("I", self._encode([signs], False)[0]).tobytes()
        return ids

    def _learn(self):
        words = self.codes.new
        self.codes.new = []
        found = [self.direct and _WORD_AND_SIGNS.fullmatch(w) for w in words]
        latin = np.fromiter(map(bool, found), bool, len(words))
        ids = [self._latin(m[1].lower()) + self._signs(m[2]) for m in found if m]
        size, start = np.zeros(len(words), np.int64), np.zeros(len(words), np.int64)
        size[latin] = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
        start[latin] = len(self.ids) + np.cumsum(size[latin]) - size[latin]
        self.ids = np.concatenate([self.ids, np.frombuffer(b"".join(ids), np.uint32).astype("<u4")])
        size[~latin], start[~latin] = self._learnt([w for w, m in zip(words, found) if not m])
        self.start = np.concatenate([self.start, start])
        self.size = np.concatenate([self.size, size])

    def _learnt(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The sizes of the words' ids and where they start, once ``ids`` holds them."""
        size = np.zeros(len(words), np.int64)
        mark = re.compile("|".join(map(re.escape, self.marks))).search
        odd = [i for i, w in enumerate(words) if mark(w)]
        is_odd = np.zeros(len(words), bool)
        is_odd[odd] = True
        # ids of words with special tokens in them come last, after all others
        plain = [words[i] for i in np.flatnonzero(~is_odd).tolist()]
        groups = [plain[i : i + self.TOGETHER] for i in range(0, len(plain), self.TOGETHER)]
        joined = self._encode([self.marks[0].join(g) for g in groups], True) if groups else []
        ids = np.fromiter(chain.from_iterable((*found, self.mark) for found in joined), np.dtype("<u4"))
        ends = np.flatnonzero(ids == self.mark)
        assert len(ends) == len(plain)
        alone = self._encode([words[i] for i in odd], False)
        size[~is_odd] = np.diff(ends, prepend=-1) - 1
        size[odd] = [len(x) for x in alone]
        start, known = np.empty_like(size), len(self.ids)
        start[~is_odd] = known + np.cumsum(size[~is_odd]) - size[~is_odd]
        start[odd] = known + size[~is_odd].sum() + np.cumsum(size[odd]) - size[odd]
        self.ids = np.concatenate([self.ids, ids[ids != self.mark], np.array(list(chain.from_iterable(alone)), "<u4")])
        return size, start

    def __call__(self, texts: list[str], end: int | None = None) -> list[np.ndarray]:
        if len(self.codes) > self.REMEMBERED:
            self._forget()
        look = self.codes.__getitem__
        coded = [np.fromiter(map(look, t.replace("\n", " ").replace("\t", " ").split(" ")), np.int64) for t in texts]
        if self.codes.new:
            self._learn()
        out, tail = [], np.array([] if end is None else [end], "<u4")
        for codes in coded:
            size = self.size[codes]
            total = np.cumsum(size)
            at = np.arange(total[-1]) + np.repeat(self.start[codes] - total + size, size)
            out.append(np.concatenate([self.ids[at], tail]))
        return out


def word_bpe_tokens(spark: SparkSession, path: str, end: int | None = None):
    """For ``pack_documents``: texts to ids by the tokenizer file at ``path``,
    without special tokens, then id ``end`` if given."""
    data = broadcast_file(spark, path)

    def tokenize():
        encode = _word_bpe(data.value)
        return lambda texts: encode(texts, end)

    return tokenize
