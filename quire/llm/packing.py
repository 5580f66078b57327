"""Packing by Karmarkar-Karp multiway differencing.

Documents become sequences of at most ``length`` = 2048 token ids.  A document
of that size or more gives full sequences of its own; what is left of it is cut
into pieces of at most ``piece`` ids and joins the pool of its task.  When the
pool holds ``windows`` sequences' worth of ids, it is partitioned: every piece
starts as a partial partition of k windows, one of which holds it; the two
partial partitions with the largest imbalance merge, the fullest windows of the
one onto the emptiest of the other, until one partition is left, whose windows
are near-equal.  k begins at the least number that could hold the pool and
rises by one whenever a window exceeds the capacity.

Pools are made of the rows a task reads, in their order: no group that could be
hot, and a pool's memory is bounded by ``windows`` x ``length`` ids and ``ROWS``
rows.  A pool that is not full when its rows end stays open: the pieces of all
open pools are exchanged into few tasks, ``GATHERED`` sequences' worth of ids
each, and pooled there, so that padding depends neither on the number of
partitions nor on how many ids a document has.  Sequence ids are the partition's
number and a running number within it (gathered ones have ``_GATHERED`` set),
so that a repeated task gives the same ones.
"""

from __future__ import annotations

import heapq
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.session import materialize

LENGTH = 2048
PIECE = 512
WINDOWS = 64
#: Rows of an Arrow batch that are held as texts, ids and pieces at a time.
ROWS = 2000
#: Sequences' worth of ids that a task which gathers open pools gets (67 million ids).
GATHERED = 32768

_GATHERED = 1 << 62
_OPEN = -1
_PIECES = [("start", "bigint"), ("length", "bigint"), ("ids", "binary"), ("doc_tokens", "bigint"), ("sequence_id", "bigint"), ("offset", "bigint")]


def difference(sizes: list[int], k: int) -> list[list[int]]:
    """Items 0 .. len(sizes) - 1 in ``k`` windows of near-equal sums (largest
    differencing; of partitions with equal imbalance the earlier made goes
    first, windows with equal sums keep their order)."""
    if not sizes:
        return [[] for _ in range(k)]
    # a partial partition: the windows' sums, ascending, and their items as a
    # tree of pairs; windows that are still empty are not held
    heap = [(-size, i, [size], [i]) for i, size in enumerate(sizes)]
    if k == 1:
        return [list(range(len(sizes)))]
    heapq.heapify(heap)
    made = len(heap)
    while len(heap) > 1:
        _, _, sums, trees = heapq.heappop(heap)
        _, _, others, other_trees = heapq.heappop(heap)
        free = k - len(sums)
        if len(others) <= free:  # onto empty windows only
            merged, joined = sums + others, trees + other_trees
        else:
            # the fullest of the others meets an empty window first, then the emptiest
            merged, joined = sums[::-1] + [0] * free, trees[::-1] + [None] * free
            for j, (s, t) in enumerate(zip(others, other_trees)):
                at = k - len(others) + j
                merged[at] += s
                joined[at] = t if joined[at] is None else (joined[at], t)
        order = sorted(range(len(merged)), key=merged.__getitem__)
        merged, joined = [merged[i] for i in order], [joined[i] for i in order]
        heapq.heappush(heap, ((merged[0] if len(merged) == k else 0) - merged[-1], made, merged, joined))
        made += 1
    _, _, _, trees = heap[0]
    return [_flat(t) for t in trees] + [[] for _ in range(k - len(trees))]


def _flat(tree) -> list[int]:
    items, left = [], [tree]
    while left:
        t = left.pop()
        if isinstance(t, tuple):
            left += t
        else:
            items.append(t)
    return sorted(items)


def windows_of(sizes: list[int], length: int = LENGTH) -> list[list[int]]:
    """Items in as few windows of at most ``length`` as differencing finds from
    the least number that could hold them; no item may exceed ``length``."""
    k = -(-sum(sizes) // length)
    while True:
        found = difference(sizes, max(1, k))
        if all(sum(sizes[i] for i in w) <= length for w in found):
            return [w for w in found if w]
        k += 1


def _placed(tokens: Iterator[tuple[pa.RecordBatch, list[np.ndarray]]], length: int, piece: int, windows: int, leave_open: bool):
    """For each batch of document columns with their ids (one array a row): the
    batch, the ids, and the pieces in order of sequence and offset, as arrays of
    row, start, size, sequence and offset.  No sequence crosses batches; with
    ``leave_open`` the pieces of a batch's last pool have sequence ``_OPEN``."""
    sequence = TaskContext.get().partitionId() << 40
    for batch, docs in tokens:
        pool: list[tuple[int, int, int]] = []  # row, start, size
        pooled = 0
        rows: list[tuple] = []

        def close():
            nonlocal sequence, pool, pooled
            for window in windows_of([p[2] for p in pool], length):
                offset = 0
                for i in window:
                    rows.append((*pool[i], sequence, offset))
                    offset += pool[i][2]
                sequence += 1
            pool, pooled = [], 0

        for row, ids in enumerate(docs):
            n, whole = len(ids), len(ids) // length * length
            for start in range(0, whole, length):
                rows.append((row, start, length, sequence, 0))
                sequence += 1
            if rest := n - whole:
                parts = -(-rest // piece)
                cuts = [whole + rest * i // parts for i in range(parts + 1)]
                pool += [(row, a, b - a) for a, b in zip(cuts, cuts[1:])]
                pooled += rest
                if pooled >= windows * length:
                    close()
        if pool and leave_open:
            rows += [(*p, _OPEN, 0) for p in pool]
        elif pool:
            close()
        yield batch, docs, *((np.array(c, np.int64) for c in zip(*rows)) if rows else [np.zeros(0, np.int64)] * 5)


def _whole(tokens, length: int, piece: int, windows: int):
    """The ids of each sequence, and the sequences' ids, batch by batch; a piece of
    a pool that is not full is one of its own, with sequence ``_OPEN``."""
    for _, docs, row, start, size, seq, _ in _placed(tokens, length, piece, windows, True):
        firsts = np.flatnonzero((np.diff(seq, prepend=-2) != 0) | (seq == _OPEN))
        parts = [docs[r][a : a + n] for r, a, n in zip(row, start, size)]
        yield [np.concatenate(parts[a:b]) for a, b in zip(firsts, [*firsts[1:], len(parts)])], seq[firsts]


def pack(tokens: Iterator[tuple[pa.RecordBatch, list[np.ndarray]]], length: int, piece: int, windows: int) -> Iterator[tuple[pa.RecordBatch, dict]]:
    """Batches of document columns with their ids (one array a row) to batches
    of the documents' columns, one row a piece, and the pieces' own columns.
    Pieces of pools that are not full have sequence ``_OPEN``."""
    for batch, docs, row, start, size, seq, offset in _placed(tokens, length, piece, windows, True):
        yield (
            batch.take(pa.array(row)),
            {
                "start": pa.array(start),
                "length": pa.array(size),
                "ids": pa.array([docs[r][a : a + n].tobytes() for r, a, n in zip(row, start, size)], pa.binary()),
                "doc_tokens": pa.array(np.fromiter((len(docs[r]) for r in row), np.int64, len(row))),
                "sequence_id": pa.array(seq),
                "offset": pa.array(offset),
            },
        )


def _closed(pool: list[pa.RecordBatch], length: int, sequence: int) -> tuple[pa.Table, int]:
    """The pieces of a pool, in order of sequence and offset, and the next sequence."""
    table = pa.Table.from_batches(pool)
    sizes = table.column("length").to_pylist()
    found = windows_of(sizes, length)
    order = [i for window in found for i in window]
    sequences = np.repeat(np.arange(sequence, sequence + len(found)), [len(w) for w in found])
    ends = np.cumsum([sizes[i] for i in order]) - [sizes[i] for i in order]
    firsts = np.flatnonzero(np.diff(sequences, prepend=-1))
    offsets = ends - np.repeat(ends[firsts], np.diff(np.append(firsts, len(order))))
    table = table.take(pa.array(order, pa.int64()))
    for name, values in (("sequence_id", sequences), ("offset", offsets)):
        table = table.set_column(table.schema.get_field_index(name), name, pa.array(values, pa.int64()))
    return table, sequence + len(found)


def _pools(batches: Iterator[pa.RecordBatch], length: int, windows: int) -> Iterator[pa.Table]:
    """Batches of open pieces as pools of ``windows`` sequences' worth of ids, over
    the bounds of batches, with their sequences; the task's last one may be smaller."""
    sequence = None
    pool: list[pa.RecordBatch] = []
    pooled, full = 0, windows * length
    for batch in batches:
        if sequence is None and batch.num_rows:
            sequence = batch.column("sequence_id")[0].as_py()  # the task's first
        while batch.num_rows:
            total = pooled + np.cumsum(batch.column("length").to_numpy())
            n = min(int(np.searchsorted(total, full)) + 1, batch.num_rows)  # with the piece that fills the pool
            pool.append(batch.slice(0, n))
            pooled = int(total[n - 1])
            batch = batch.slice(n)
            if pooled >= full:
                table, sequence = _closed(pool, length, sequence)
                yield table
                pool, pooled = [], 0
    if pool:
        yield _closed(pool, length, sequence)[0]


def gather(batches: Iterator[pa.RecordBatch], length: int, windows: int) -> Iterator[pa.RecordBatch]:
    """Batches of open pieces with their sequences."""
    for table in _pools(batches, length, windows):
        yield from table.to_batches()


def _dealt(stored: DataFrame, at: str, length: int) -> DataFrame | None:
    """The open pieces of a stored table in few tasks, in the order of ``at``, with
    their task's first sequence: that of the exchange, wherever its rows go on."""
    is_open = F.col("sequence_id") == _OPEN
    open_ids = stored.where(is_open).agg(F.sum("length")).first()[0] or 0
    if not open_ids:
        return None
    tasks = -(-open_ids // (GATHERED * length))
    dealt = stored.where(is_open).repartition(tasks, at).sortWithinPartitions(at).drop(at)
    first = F.shiftleft(F.spark_partition_id().cast("bigint"), 40).bitwiseOR(F.lit(_GATHERED))
    return dealt.withColumn("sequence_id", first)


def _slices(batches):
    for batch in batches:
        for first in range(0, batch.num_rows, ROWS):
            yield batch.slice(first, ROWS)


def pack_documents(docs: DataFrame, text_col: str, tokenize: Callable[[], Callable[[list[str]], list[np.ndarray]]], length: int = LENGTH, piece: int = PIECE, windows: int = WINDOWS) -> DataFrame:
    """One row per piece: the columns of ``docs`` but the text, and ``start``
    (ids of the document before the piece), ``length``, ``ids`` (little-endian
    unsigned 32-bit), ``doc_tokens``, ``sequence_id``, ``offset`` (in the
    sequence, gapless from 0).  Columns of ``docs`` with these names are dropped.

    ``tokenize()`` is called once a task and gives a function from texts to
    arrays of ids (``<u4``).  Null text counts as empty; a document without ids
    gives no piece.  Repeated rows and equal ids are packed like any others.  An
    empty table gives no rows.

    Texts are tokenised once: the pieces are stored, and those of open pools are
    exchanged (fewer than ``windows`` x ``length`` ids for each ``ROWS`` rows).
    """
    named = {n for n, _ in _PIECES}
    kept = [c for c in docs.columns if c not in named | {text_col}]
    source = docs.select(*kept, docs[text_col].alias("ids"))
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in source.schema if f.name != "ids"] + [f"{n} {t}" for n, t in _PIECES])

    def run(batches):
        ids_of = tokenize()

        def tokens():
            for batch in _slices(batches):
                yield batch.select(kept), ids_of([t or "" for t in batch.column("ids").to_pylist()])

        for columns, pieces in pack(tokens(), length, piece, windows):
            arrays = list(columns.columns) + list(pieces.values())
            yield pa.RecordBatch.from_arrays(arrays, names=kept + list(pieces))

    # the place of an open piece tells rows that are equal apart and gives a repeated task the same order
    at = "_at"
    while at in (c.lower() for c in kept):
        at += "_"
    stored = materialize(source.mapInArrow(run, schema).withColumn(at, F.monotonically_increasing_id()), "pieces")
    dealt = _dealt(stored, at, length)
    if dealt is None:
        return stored.drop(at)
    return stored.where(F.col("sequence_id") != _OPEN).drop(at).union(dealt.mapInArrow(lambda batches: gather(batches, length, windows), dealt.schema))


def packed_sequences(docs: DataFrame, text_col: str, tokenize: Callable[[], Callable[[list[str]], list[np.ndarray]]], form: Callable[[np.ndarray], bytes], length: int = LENGTH, piece: int = PIECE, windows: int = WINDOWS) -> DataFrame:
    """The sequences that ``pack_documents`` packs, one row each, as stored tables:
    ``sequence_id, n_ids, bytes``, the last being ``form`` of its ids (``<u4``), and
    ``_row``, the sequence's task << 33 and its position among the task's, gapless.
    Ids leave their task in whole sequences, but for the pieces of open pools.
    Nulls, repeated rows and empty tables as there."""
    source = docs.select(docs[text_col].alias("text"))
    names = ["sequence_id", "length", "bytes"]

    def rows(seq, sizes, data):
        return pa.RecordBatch.from_arrays([pa.array(seq, pa.int64()), pa.array(sizes, pa.int32()), pa.array(data, pa.binary())], names=names)

    def run(batches):
        ids_of = tokenize()
        tokens = ((batch.select([]), ids_of([t or "" for t in batch.column("text").to_pylist()])) for batch in _slices(batches))
        for ids, seq in _whole(tokens, length, piece, windows):
            yield rows(seq, [len(i) for i in ids], [i.tobytes() if s == _OPEN else form(i) for i, s in zip(ids, seq)])

    def close(batches):
        opened = (b.append_column("offset", pa.array(np.zeros(b.num_rows, np.int64))) for b in batches)
        for table in _pools(opened, length, windows):
            seq, data = table.column("sequence_id").to_numpy(), table.column("bytes").to_pylist()
            firsts = np.flatnonzero(np.diff(seq, prepend=-1))
            ids = [np.frombuffer(b"".join(data[a:b]), "<u4") for a, b in zip(firsts, [*firsts[1:], len(data)])]
            yield rows(seq[firsts], [len(i) for i in ids], [form(i) for i in ids])

    schema = "sequence_id bigint, length int, bytes binary"
    stored = materialize(source.mapInArrow(run, schema).withColumn("_at", F.monotonically_increasing_id()), "sequences")
    dealt = _dealt(stored, "_at", length)
    whole = stored.where(F.col("sequence_id") != _OPEN).drop("_at")
    if dealt is not None:
        whole = whole.union(materialize(dealt.mapInArrow(close, schema), "gathered"))
    row = F.shiftleft(F.shiftright("sequence_id", 40), 33) + F.col("sequence_id").bitwiseAND(F.lit((1 << 40) - 1))
    return whole.select("sequence_id", F.col("length").alias("n_ids"), "bytes", row.alias("_row"))
