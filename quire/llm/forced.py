"""BPE with word ends, by forced-boundary splitting, and its inverse.

A tokenizer file gives merges of symbols, which are bytes; the last byte of a
pre-token is a symbol of its own kind, with the word-end mark.  A pair of symbols
that stands inside no vocabulary token can never be within one: between the two
there is a certain cut.  White space is in no token either, nor are two pre-tokens
or a special token and its neighbours.  Texts are cut at all these places.  Merges
left and right of a cut have nothing to do with each other, so the fragments are
encoded independently, and the ids of a text are those of its fragments in order.

Fragments are short (a few bytes, also where a text has no blanks, as base64 does)
and repeat far more often than words do, so a task remembers each one's ids, and
those of words, up to a bounded number.  Texts stay in their rows: there is no
exchange, no state between tasks, and a lost task is simply run again.

Normalising and pre-tokenising are those of the tokenizers library, as the file
names them; the merges are applied here.  Ids are binary, little-endian unsigned
32-bit.
"""

from __future__ import annotations

import functools
import heapq
import json
import os
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.llm import vocab

#: Bytes of text whose ids are held at a time, after at most one text beyond it.
SLICE = 4 << 20
#: Of a longer text, no list of all its words is made.
LONG_TEXT = 1 << 20
WORDS, FRAGMENTS = 400_000, 400_000
#: Words that are normalised and cut into pre-tokens together.
TOGETHER = 256
#: Up to this length the best merge is looked up among all, beyond it in a heap.
SHORT = 48
_NO_MERGE = (1 << 62, -1)
_U4 = np.dtype("<u4")
#: Characters that stand for special tokens (none of them stands for a byte).
_SPECIAL = 0xE000


def _byte_of_char() -> dict[str, int]:
    """The printable characters that byte-level files write bytes as: those of
    Latin-1 that can be seen are themselves, the other bytes follow from 256 on."""
    seen = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in seen]
    return {chr(b): b for b in seen} | {chr(256 + i): b for i, b in enumerate(hidden)}


class _Known:
    """Ids of strings that are met, by code: the strings' order of appearance."""

    def __init__(self):
        self.codes, self.start, self.size, self.ids = vocab._Codes(), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, _U4)

    def add(self, size: np.ndarray, ids: np.ndarray):
        self.start = np.concatenate([self.start, len(self.ids) + np.cumsum(size) - size])
        self.size = np.concatenate([self.size, size])
        self.ids = np.concatenate([self.ids, ids])

    def gather(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """How many ids each code has, and all of them in order."""
        size = self.size[codes]
        total = np.cumsum(size)
        n = int(total[-1]) if len(total) else 0
        return size, self.ids[np.arange(n) + np.repeat(self.start[codes] - total + size, size)]


class ForcedBpe:
    """Ids of texts, and texts of ids, by the tokenizer file ``data``."""

    def __init__(self, data: str):
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        spec, tokenizer = json.loads(data), Tokenizer.from_str(data)
        model = spec["model"]
        end = model.get("end_of_word_suffix") or ""
        odd = [k for k in ("dropout", "continuing_subword_prefix", "fuse_unk", "byte_fallback", "ignore_merges") if model.get(k)]
        added = spec["added_tokens"]
        if model["type"] != "BPE" or not end or odd or spec["decoder"] or any(t["normalized"] or t["lstrip"] or t["rstrip"] or t["single_word"] for t in added):
            raise ValueError(f"not a byte-level BPE with word ends whose tokens are plain ({odd})")
        self.normalize, self.pre_tokenize = tokenizer.normalizer.normalize_str, tokenizer.pre_tokenizer.pre_tokenize_str
        self.special = {t["content"]: i for i, t in enumerate(added)}
        self.find_special = re.compile("|".join(map(re.escape, sorted(self.special, key=len, reverse=True)))) if added else None
        ids, bytes_ = model["vocab"], _byte_of_char()
        # symbols: 256 bytes, 256 bytes that end a word, special tokens
        n = 512 + len(added)
        self.base = np.array([*(ids[c] for c, _ in sorted(bytes_.items(), key=lambda x: x[1])), *(ids[c + end] for c, _ in sorted(bytes_.items(), key=lambda x: x[1])), *(t["id"] for t in added)], _U4)
        self.symbol_of = np.full(_SPECIAL + len(added), -1, np.int64)
        for c, b in bytes_.items():
            self.symbol_of[ord(c)] = b
        self.symbol_of[_SPECIAL:] = np.arange(512, n)
        # a merge joins the last symbol of one token with the first of the other
        first = {ids[c + e]: b + 256 * (e != "") for c, b in bytes_.items() for e in ("", end)}
        last, self.merges = dict(first), {}
        self.inside = np.zeros((n, n), bool)
        for rank, pair in enumerate(model["merges"]):
            left, right = pair if isinstance(pair, list) else pair.split(" ")
            a, b, new = ids[left], ids[right], ids[left + right]
            self.merges[a, b] = (rank, new)
            self.inside[last[a], first[b]] = True
            first[new], last[new] = first[a], last[b]
        self.tokens = [""] * (max([*ids.values(), *(t["id"] for t in added)]) + 1)
        for token, i in (*ids.items(), *((t["content"], t["id"]) for t in added)):
            self.tokens[i] = token
        self.words, self.fragments = _Known(), _Known()

    def _merged(self, ids: list[int]) -> list[int]:
        """Adjacent ids merged in order of rank, of equal ranks the leftmost first."""
        if len(ids) > SHORT:
            return self._merged_long(ids)
        merge = self.merges.get
        found = [merge(pair, _NO_MERGE) for pair in zip(ids, ids[1:])]
        while found and (best := min(found)) is not _NO_MERGE:
            i = found.index(best)
            ids[i : i + 2] = [best[1]]
            del found[i]
            if i:
                found[i - 1] = merge((ids[i - 1], ids[i]), _NO_MERGE)
            if i < len(found):
                found[i] = merge((ids[i], ids[i + 1]), _NO_MERGE)
        return ids

    def _merged_long(self, ids: list[int]) -> list[int]:
        """The same for a fragment of any length, in n log n steps."""
        after, before = list(range(1, len(ids) + 1)), list(range(-1, len(ids) - 1))
        merges, n = self.merges, len(ids)
        heap = [(m[0], i, m[1], a, b) for i, (a, b) in enumerate(zip(ids, ids[1:])) if (m := merges.get((a, b)))]
        heapq.heapify(heap)
        while heap:
            _, i, new, a, b = heapq.heappop(heap)
            j = after[i]
            if ids[i] != a or j >= n or ids[j] != b:
                continue  # one of the two was merged before
            ids[i], ids[j], after[i] = new, -1, after[j]
            if after[j] < n:
                before[after[j]] = i
            for left, right in ((before[i], i), (i, after[i])):
                if left >= 0 and right < n and (m := merges.get((ids[left], ids[right]))):
                    heapq.heappush(heap, (m[0], left, m[1], ids[left], ids[right]))
        return [x for x in ids if x >= 0]

    def _pieces(self, word: str) -> list[str]:
        """Pre-tokens of a stretch of text, as byte characters; special tokens as
        their characters."""
        found, at = [], 0
        for m in self.find_special.finditer(word) if self.find_special else ():
            found += [*self._plain(word[at : m.start()]), chr(_SPECIAL + self.special[m.group()])]
            at = m.end()
        return found + self._plain(word[at:])

    def _plain(self, text: str) -> list[str]:
        return [piece for piece, _ in self.pre_tokenize(self.normalize(text))]

    def _all_pieces(self, words: list[str]) -> tuple[list[str], np.ndarray]:
        """The pre-tokens of all words and how many characters each word has."""
        pieces, sizes = [], []
        for first in range(0, len(words), TOGETHER):
            group = words[first : first + TOGETHER]
            text = " ".join(group)
            alike = text.split() == group and not (self.find_special and self.find_special.search(text))
            parts = self.normalize(text).split(" ") if alike else []
            if len(parts) != len(group):  # special tokens, other blanks or empty words among them
                found = [self._pieces(w) for w in group]
                pieces += [p for f in found for p in f]
                sizes += [sum(map(len, f)) for f in found]
                continue
            cut = self.pre_tokenize(" ".join(parts))
            own, places = zip(*cut) if cut else ((), ())
            pieces += own
            lengths = np.fromiter(map(len, own), np.int64, len(own))
            ends = np.cumsum(np.fromiter(map(len, parts), np.int64, len(parts)) + 1)
            of = np.searchsorted(ends, np.fromiter((a for a, _ in places), np.int64, len(own)), "right")
            sizes += np.bincount(of, lengths, len(group)).astype(np.int64).tolist()
        return pieces, np.array(sizes, np.int64)

    def fragments_of(self, words: list[str]) -> tuple[str, np.ndarray, np.ndarray, np.ndarray]:
        """The words' byte characters, their symbols, the fragments' ends among them
        and the number of fragments of each word."""
        pieces, sizes = self._all_pieces(words)
        flat = "".join(pieces)
        symbols = self.symbol_of[np.frombuffer(flat.encode("utf-32-le"), np.uint32)]
        ends = np.cumsum(np.fromiter(map(len, pieces), np.int64, len(pieces)))
        symbols[ends[symbols[ends - 1] < 256] - 1] += 256
        cut = np.ones(len(symbols), bool)
        cut[:-1] = ~self.inside[symbols[:-1], symbols[1:]]
        stops = np.flatnonzero(cut) + 1
        return flat, symbols, stops, np.diff(np.searchsorted(stops, np.cumsum(sizes), "right"), prepend=0)

    def _learn(self):
        words, self.words.codes.new = self.words.codes.new, []
        if len(self.fragments.codes) > FRAGMENTS:
            self.fragments = _Known()
        known = self.fragments
        flat, symbols, stops, n_fragments = self.fragments_of(words)
        starts = np.concatenate([[0], stops[:-1]]).astype(np.int64)
        # the same characters are another fragment where they end a word
        ending = symbols[stops - 1] >= 256
        look = known.codes.__getitem__
        codes = np.fromiter((look(flat[a:b] + "\n" if e else flat[a:b]) for a, b, e in zip(starts.tolist(), stops.tolist(), ending.tolist())), np.int64, len(stops))
        if known.codes.new:
            new, known.codes.new = len(known.codes.new), []
            _, where = np.unique(codes, return_index=True)
            found = [self._merged(self.base[symbols[starts[i] : stops[i]]].tolist()) for i in where[-new:].tolist()]
            known.add(np.array([len(f) for f in found], np.int64), np.array([x for f in found for x in f], _U4))
        size, ids = known.gather(codes)
        upto = np.concatenate([[0], np.cumsum(size)])
        bounds = np.concatenate([[0], np.cumsum(n_fragments)])
        self.words.add(np.diff(upto[bounds]), ids)

    def _stretches(self, text: str):
        """The text between blanks; of a long text, piece by piece."""
        if len(text) <= LONG_TEXT:
            yield text.replace("\n", " ").replace("\t", " ").split(" ")
            return
        at = 0
        while at < len(text):
            blank = re.compile("[ \n\t]").search(text, min(at + LONG_TEXT, len(text)))
            stop = blank.end() if blank else len(text)
            yield text[at:stop].replace("\n", " ").replace("\t", " ").split(" ")
            at = stop

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        out, coded = [], []
        if len(self.words.codes) > WORDS:
            self.words = _Known()
        look = self.words.codes.__getitem__
        for text in texts:
            coded.append([np.fromiter(map(look, stretch), np.int64, len(stretch)) for stretch in self._stretches(text)])
        if self.words.codes.new:
            self._learn()
        for parts in coded:
            out.append(np.concatenate([self.words.gather(codes)[1] for codes in parts] or [np.zeros(0, _U4)]))
        return out

    def decode(self, ids: np.ndarray) -> str:
        """The tokens, set apart by blanks: what a file without a decoder gives."""
        return " ".join(filter(None, map(self.tokens.__getitem__, ids.tolist())))


@functools.lru_cache(maxsize=2)
def _loaded(data: bytes) -> ForcedBpe:
    return ForcedBpe(data.decode())


def _slices(batches, text: str):
    """Batches of a bounded number of text bytes."""
    for batch in batches:
        first, held = 0, 0
        sizes = pc.binary_length(batch.column(text)).to_pylist()
        for row, size in enumerate(sizes):
            held += size or 0
            if held >= SLICE or row + 1 == batch.num_rows:
                yield batch.slice(first, row + 1 - first)
                first, held = row + 1, 0


def encode(docs: DataFrame, text_col: str, path: str, decoded: bool = False) -> DataFrame:
    """The columns of ``docs`` but the text, and ``ids`` (binary) of the whole text
    by the tokenizer file at ``path``, without added special tokens; special tokens
    that stand in a text are encoded as such.  With ``decoded`` also the text
    that the ids decode to, special tokens included.

    Null and empty texts have empty ids and decode to the empty string.  Rows come
    once each, repeated rows too; columns may have any names and be null (``ids``
    and ``decoded`` are replaced).  An empty table gives no rows.
    """
    file = vocab.broadcast_file(docs.sparkSession, path)
    kept = [c for c in docs.columns if c not in (text_col, "ids", "decoded")]
    keep = [f"k{i}" for i in range(len(kept))]
    source = docs.select(*(docs[c].alias(k) for c, k in zip(kept, keep)), docs[text_col].alias("text"))
    types = "".join(f"{f.name} {f.dataType.simpleString()}, " for f in source.schema if f.name != "text")
    names = [*keep, "ids", *(["decoded"] if decoded else [])]

    def run(batches):
        bpe = _loaded(file.value)
        for batch in _slices(batches, "text"):
            ids = bpe.encode([t or "" for t in batch.column("text").to_pylist()])
            made = [pa.array([i.tobytes() for i in ids], pa.binary())]
            if decoded:
                made.append(pa.array([bpe.decode(i) for i in ids], pa.string()))
            yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in keep), *made], names=names)

    out = source.mapInArrow(run, f"{types}ids binary" + ", decoded string" * decoded)
    return out.select(*(F.col(k).alias(c) for c, k in zip(kept, keep)), *names[len(keep) :])


def decode(ids: Column, spark, path: str) -> Column:
    """The text of a column of ids (null: null)."""
    file = vocab.broadcast_file(spark, path)

    @F.arrow_udf("string")
    def joined(column: pa.Array) -> pa.Array:
        bpe = _loaded(file.value)
        return pa.array([None if i is None else bpe.decode(np.frombuffer(i, _U4)) for i in column.to_pylist()], pa.string())

    return joined(ids)
