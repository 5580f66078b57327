"""Byte-level BPE by a global shuffle of distinct words, and its inverse.

1.  Each task cuts its texts into pre-tokens (matches of the pattern) in blocks of
    rows of bounded size.  A block keeps its pre-tokens in order of position as
    codes, numbers in its list of distinct words.
2.  One exchange deals out both: codes by block, and a block's distinct words by
    the hash of the word.  So every distinct word of the corpus is encoded in one
    place, once, whatever the number of its occurrences.
3.  Its ids go back to the blocks that have it (cogroup by block), where codes are
    replaced by ids in order of position.

A word is sent once a block, not once an occurrence, and no group grows with the
corpus: a block is bounded, and a word hash's share shrinks with the number of
shuffle partitions.  Decoding joins ids to the token-byte table, whose size is
the vocabulary's, inside the tasks.

Ids are binary, little-endian unsigned 32-bit.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
import regex
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.llm import vocab

#: A block ends with its Arrow batch, or with the document that gives it so many pre-tokens.
BLOCK_TOKENS = 2_000_000
#: Words whose ids a task remembers; beyond that it begins anew (and encodes again).
KNOWN_WORDS = 200_000
_LONG_TEXT = 1 << 22
_U4 = np.dtype("<u4")
_DOC, _CODES, _WORDS = 0, 1, 2


def _squeeze(x: np.ndarray) -> bytes:
    """Unsigned 32-bit numbers, compressed byte plane by byte plane."""
    planes = np.ascontiguousarray(x.astype(_U4).view(np.uint8).reshape(-1, 4).T)
    return len(x).to_bytes(8, "little") + (pa.compress(planes.tobytes(), codec="zstd", asbytes=True) if len(x) else b"")


def _expand(data: bytes) -> np.ndarray:
    n = int.from_bytes(data[:8], "little")
    if not n:
        return np.zeros(0, _U4)
    planes = np.frombuffer(pa.decompress(data[8:], 4 * n, codec="zstd", asbytes=True), np.uint8).reshape(4, n)
    return np.ascontiguousarray(planes.T).view(_U4).reshape(n)


class _Codes(dict):
    """Words to codes 0, 1, ... in the order in which they are first met."""

    def __missing__(self, word):
        self[word] = code = len(self)
        return code


def _block(block: int, columns: pa.RecordBatch, docs: list[np.ndarray], words: _Codes, buckets: int, names: list[str]) -> pa.RecordBatch:
    """A block's rows: its documents' columns, its codes, its words by bucket."""
    codes = np.concatenate(docs)
    # frequent words get small codes, which compress better
    by_count = np.argsort(-np.bincount(codes, minlength=len(words)), kind="stable")
    code_of = np.empty(len(words), np.int64)
    code_of[by_count] = np.arange(len(words))
    words = [w for w, _ in sorted(zip(words, code_of.tolist()), key=lambda x: x[1])]
    bucket = np.fromiter((zlib.crc32(w.encode()) for w in words), np.uint32, len(words)) % buckets
    n, rows = columns.num_rows, []
    for b in np.unique(bucket).tolist():
        own = np.flatnonzero(bucket == b)
        texts = [words[i] for i in own.tolist()]
        text = "".join(texts).encode()
        rows.append((-1 - b, _WORDS, block, _squeeze(np.diff(own, prepend=0)), _squeeze(np.fromiter(map(len, texts), _U4)), len(text).to_bytes(8, "little") + pa.compress(text, codec="zstd", asbytes=True)))
    rows.append((block, _CODES, 0, _squeeze(code_of[codes]), _squeeze(np.array([len(d) for d in docs])), None))
    key, kind, at, a, b, c = (list(x) for x in zip(*rows))
    arrays = [pa.concat_arrays([x, pa.nulls(len(rows), x.type)]) for x in columns.columns]
    arrays += [
        pa.array([block] * n + key, pa.int64()),
        pa.array([_DOC] * n + kind, pa.int32()),
        pa.array([*range(n), *at], pa.int64()),
        *(pa.array([None] * n + x, pa.binary()) for x in (a, b, c)),
    ]
    return pa.RecordBatch.from_arrays(arrays, names=names)


def _cut(batches, keep: list[str], pattern: str, buckets: int, names: list[str]):
    find, block = regex.compile(pattern), TaskContext.get().partitionId() << 32
    for batch in batches:
        words, docs, first, size = _Codes(), [], 0, 0
        columns = batch.select(keep)
        for row, text in enumerate(batch.column("text")):
            text = text.as_py() or ""
            # of a very long text, no list of all its pre-tokens
            found = find.findall(text) if len(text) <= _LONG_TEXT else (m.group() for m in find.finditer(text))
            docs.append(np.fromiter(map(words.__getitem__, found), _U4))
            size += len(docs[-1])
            if size >= BLOCK_TOKENS or row + 1 == batch.num_rows:
                yield _block(block, columns.slice(first, row + 1 - first), docs, words, buckets, names)
                block += 1
                words, docs, first, size = _Codes(), [], row + 1, 0


def _encode_words(batches, ranks, pattern: str, names: list[str]):
    """A block's words of one bucket to their ids."""
    encoding, known = vocab.byte_bpe(ranks.value, pattern), {}
    for batch in batches:
        rows = []
        for kind, block, a, b, c in zip(*(batch.column(n).to_pylist() for n in ("kind", "at", "a", "b", "c"))):
            if kind != _WORDS:
                continue
            text = pa.decompress(c[8:], int.from_bytes(c[:8], "little"), codec="zstd", asbytes=True).decode()
            ends = np.cumsum(_expand(b), dtype=np.int64).tolist()
            if len(known) > KNOWN_WORDS:
                known = {}
            found = []
            for lo, hi in zip([0, *ends], ends):
                word = text[lo:hi]
                if (ids := known.get(word)) is None:
                    known[word] = ids = np.array(encoding.encode_ordinary(word), _U4)
                found.append(ids)
            rows.append((block, a, _squeeze(np.fromiter(map(len, found), _U4)), _squeeze(np.concatenate(found))))
        if rows:
            key, *blobs = (list(x) for x in zip(*rows))
            yield pa.RecordBatch.from_arrays([pa.array(key, pa.int64()), *(pa.array(x, pa.binary()) for x in blobs)], names=names)


def _joined(ids: np.ndarray, table: list[bytes]) -> bytes:
    return b"".join(map(table.__getitem__, ids.tolist()))


def _assemble(keep: list[str], ranks, decoded: bool):
    names = ["ids", "decoded"] if decoded else ["ids"]

    def run(block: pa.Table, words: pa.Table) -> pa.Table:
        kind = block.column("kind").to_numpy()
        docs = block.filter(pa.array(kind == _DOC)).sort_by("at")
        coded = block.filter(pa.array(kind == _CODES))
        if not coded.num_rows:  # words on their way to be encoded
            return pa.Table.from_arrays([pa.array([], f.type) for f in docs.select(keep).schema] + [pa.array([], pa.binary()) for _ in names], names=keep + names)
        parts = list(zip(*(words.column(n).to_pylist() for n in ("a", "b", "c"))))
        code = np.concatenate([np.cumsum(_expand(a), dtype=np.int64) for a, _, _ in parts] or [np.zeros(0, np.int64)])
        size = np.concatenate([_expand(b) for _, b, _ in parts] or [np.zeros(0, _U4)]).astype(np.int64)
        ids = np.concatenate([_expand(c) for _, _, c in parts] or [np.zeros(0, _U4)])
        start = np.cumsum(size) - size
        size_of, start_of = np.empty_like(size), np.empty_like(start)
        size_of[code], start_of[code] = size, start
        codes, lengths = _expand(coded.column("a")[0].as_py()), _expand(coded.column("b")[0].as_py())
        out, texts, lo = [], [], 0
        table = vocab.token_bytes(ranks.value) if decoded else []
        for n in lengths.tolist():
            at = codes[lo : lo + n]
            lo += n
            count = size_of[at]
            here = np.repeat(start_of[at] - (np.cumsum(count) - count), count)
            found = ids[here + np.arange(len(here))]
            out.append(found.tobytes())
            if decoded:
                texts.append(_joined(found, table))
        rows = docs.select(keep).append_column("ids", pa.array(out, pa.binary()))
        return rows.append_column("decoded", pa.array(texts, pa.binary())) if decoded else rows

    return run


def encode(docs: DataFrame, text_col: str, ranks_path: str, pattern: str, decoded: bool = False) -> DataFrame:
    """The columns of ``docs`` but the text, and ``ids`` (binary); with
    ``decoded`` also the bytes that the ids decode to.

    Every match of ``pattern`` is encoded by the merge ranks of the file at
    ``ranks_path``, without special tokens.  Null and empty texts have empty
    ids.  Rows come once each, repeated rows too; columns may have any names
    and be null (``ids`` and ``decoded`` are replaced).  An empty table gives no rows.
    """
    spark = docs.sparkSession
    ranks = vocab.broadcast_file(spark, ranks_path)
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    kept = [c for c in docs.columns if c not in (text_col, "ids", "decoded")]
    keep = [f"k{i}" for i in range(len(kept))]
    source = docs.select(*(docs[c].alias(k) for c, k in zip(kept, keep)), docs[text_col].alias("text"))
    types = "".join(f"{f.name} {f.dataType.simpleString()}, " for f in source.schema if f.name != "text")
    names, blobs = [*keep, "key", "kind", "at", "a", "b", "c"], "a binary, b binary, c binary"

    cut = source.mapInArrow(lambda batches: _cut(batches, keep, pattern, buckets, names), f"{types}key bigint, kind int, at bigint, {blobs}")
    # both branches read this one exchange
    dealt = cut.repartition(buckets, "key")
    encoded = dealt.mapInArrow(lambda batches: _encode_words(batches, ranks, pattern, ["key", "a", "b", "c"]), f"key bigint, {blobs}")
    out = dealt.groupBy("key").cogroup(encoded.groupBy("key")).applyInArrow(_assemble(keep, ranks, decoded), f"{types}ids binary" + ", decoded binary" * decoded)
    return out.select(*(F.col(k).alias(c) for c, k in zip(kept, keep)), *out.columns[len(keep) :])


def decode(ids: Column, spark, ranks_path: str) -> Column:
    """The bytes of a column of ids (null: null), from the token-byte table."""
    ranks = vocab.broadcast_file(spark, ranks_path)

    @F.arrow_udf("binary")
    def joined(column: pa.Array) -> pa.Array:
        table = vocab.token_bytes(ranks.value)
        return pa.array([None if i is None else _joined(np.frombuffer(i, _U4), table) for i in column.to_pylist()], pa.binary())

    return joined(ids)
