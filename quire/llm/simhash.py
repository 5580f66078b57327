"""SimHash near-duplicates by anchor-point covering.

A document's fingerprint has one bit per bit of a 64-bit hash: 1 if the bit is
set in over half of the hashes of its word shingles.  Two fingerprints link if
they differ in at most ``max_bits`` = 3 bits.

Candidate search.  Two 64-bit words that differ in at most 3 bits differ in at
most 1 bit in their left or in their right 32 bits.  For each half the anchors
are a covering code: the Hamming code of length 31 (perfect, covering radius 1)
with the 32nd bit free, 2^27 anchors a half.  Every fingerprint has one home
anchor a half, at distance 1 at most, and is replicated to every anchor within
covering radius plus threshold, 1 + 1 = 2 bits: 17 anchors at most.  If x and y
differ in at most 1 bit of a half, y is within 2 bits of x's home, so the pair
meets there; it is then compared on all 64 bits.  Nothing is capped or sampled.

Only distinct fingerprints are replicated, so copies, however many, are one row
in the search.  Homes meet replicas in an equi-join on the anchor, whose large
partitions AQE can split; the links go to ``components``.  Neither side is ever
broadcast: Spark sizes the 34 rows that a fingerprint is exploded into as one.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.llm.components import components
from quire.session import materialize

SHINGLE_WORDS = 3
MAX_BITS = 3
SEED = 42
_CHUNK = 1 << 16


def simhash64(data: bytes, shingle: int = SHINGLE_WORDS, seed: int = SEED) -> int:
    """Unsigned SimHash of UTF-8 text: ``bytes.lower`` changes A-Z only and
    ``bytes.split`` cuts at space and U+0009..U+000D only, as asked for."""
    words = data.lower().split()
    if not words:
        return 0
    joined, shingle = b" ".join(words), min(shingle, len(words))
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(sizes + 1) - 1
    starts = ends - sizes
    total = len(words) - shingle + 1
    ones = np.zeros(64, np.int64)
    digest = xxhash.xxh64_intdigest
    for lo in range(0, total, _CHUNK):
        hi = min(lo + _CHUNK, total)
        spans = zip(starts[lo:hi].tolist(), ends[lo + shingle - 1 : hi + shingle - 1].tolist())
        hashes = np.array([digest(joined[s:e], seed) for s, e in spans], np.dtype("<u8"))
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > total, bitorder="little").view("<u8")[0])


def fingerprint(text: Column, shingle: int = SHINGLE_WORDS, seed: int = SEED) -> Column:
    """SimHash of a string column as a signed bigint (null: as the empty text)."""

    @F.arrow_udf("bigint")
    def signed(texts: pa.Array) -> pa.Array:
        found = (simhash64(t.as_py(), shingle, seed) for t in texts)
        return pa.array([f - (1 << 64) if f >> 63 else f for f in found], pa.int64())

    return signed(F.coalesce(text, F.lit("")).cast("binary"))


def hex16(fp: Column) -> Column:
    """16 lowercase hex digits of a bigint."""
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


# --- covering code of one 32-bit half -----------------------------------------
# Bits 0..30 are positions 1..31 of the Hamming code, bit 31 is free.  The
# syndrome (xor of the positions of the set bits) is 0 for a code word and else
# the position of the one bit to flip.


def _syndrome(half: str) -> str:
    masks = [sum(1 << (p - 1) for p in range(1, 32) if p >> j & 1) for j in range(5)]
    return "(" + " | ".join(f"shiftleft(bit_count({half} & {m}L) & 1, {j})" for j, m in enumerate(masks)) + ")"


def _flip(half: str, *positions: str) -> str:
    return " ^ ".join([half, *(f"if({p} = 0, 0L, shiftleft(1L, {p} - 1))" for p in positions)])


def _halves(fp: str) -> list[str]:
    return [f"({fp} & 4294967295L)", f"shiftrightunsigned({fp}, 32)"]


def _key(side: int, anchor: str) -> str:
    return f"(({anchor}) | {side << 32}L)"


def homes(fps: DataFrame) -> DataFrame:
    """``fp, anchor``: the nearest anchor of each half."""
    halves = fps.selectExpr("fp", *(f"{h} AS h{i}" for i, h in enumerate(_halves("fp"))))
    halves = halves.selectExpr("*", *(f"{_syndrome(f'h{i}')} AS s{i}" for i in (0, 1)))
    keys = ", ".join(_key(i, _flip(f"h{i}", f"s{i}")) for i in (0, 1))
    return halves.selectExpr("fp", f"explode(array({keys})) AS anchor")


def replicas(fps: DataFrame) -> DataFrame:
    """``fp, anchor``: every anchor within 2 bits of each half.

    An anchor at distance 2 at most comes from flips whose positions xor to the
    syndrome s: s alone, s and the free bit, or two positions i < j, i ^ j = s.
    """
    halves = fps.selectExpr("fp", *(f"{h} AS h{i}" for i, h in enumerate(_halves("fp"))))
    halves = halves.selectExpr("*", *(f"{_syndrome(f'h{i}')} AS s{i}" for i in (0, 1)))
    reached = []
    for i in (0, 1):
        h, s = f"h{i}", f"s{i}"
        pairs = f"transform(filter(sequence(1, 31), i -> {s} <> 0 AND i < (i ^ {s})), i -> {_key(i, _flip(h, 'i', f'(i ^ {s})'))})"
        near = _flip(h, s)
        reached += [f"array({_key(i, near)}, {_key(i, f'({near}) ^ 2147483648L')})", pairs]
    return halves.selectExpr("fp", f"explode(concat({', '.join(reached)})) AS anchor")


def fingerprint_links(fps: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """``a, b``: pairs a < b of distinct fingerprints (column ``fp``, without
    repeats) that differ in at most ``max_bits`` <= 3 bits; pairs that meet at
    two anchors come twice."""
    if not 0 <= max_bits <= 3:
        raise ValueError("the two covering codes prove at most 3 differing bits")
    x, y = homes(fps).hint("merge").alias("x"), replicas(fps).alias("y")
    close = F.bit_count(F.col("x.fp").bitwiseXOR(F.col("y.fp"))) <= max_bits
    met = x.join(y, (F.col("x.anchor") == F.col("y.anchor")) & (F.col("x.fp") < F.col("y.fp")) & close)
    return met.select(F.col("x.fp").alias("a"), F.col("y.fp").alias("b"))


def simhash_groups(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle: int = SHINGLE_WORDS,
    max_bits: int = MAX_BITS,
    keep: dict[str, Column] | None = None,
) -> DataFrame:
    """One row per input row: ``id, fp`` (bigint), ``component`` (the smallest
    id among the documents that can be reached over links), ``root`` (the smallest
    fingerprint among them, which tells groups apart where ids repeat or are
    null) and the columns of ``keep`` (name to expression over ``docs``).

    Null text counts as empty; a text without words has fingerprint zero and
    links like any other.  Equal fingerprints are one node, so repeated rows
    share a component.  Null ids are never the smallest; a component with null
    ids only has a null ``component``.  An empty table gives an empty result.
    """
    marked = docs.select(F.col(id_col).alias("id"), fingerprint(F.col(text_col), shingle).alias("fp"), *((c.alias(n)) for n, c in (keep or {}).items()))
    marked = materialize(marked, "simhash")
    nodes = materialize(marked.groupBy("fp").agg(F.min("id").alias("least")), "fingerprints")
    roots = components(fingerprint_links(nodes.select("fp"), max_bits))
    rooted = nodes.join(roots, nodes.fp == roots.node, "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    rooted = materialize(rooted, "rooted")
    least = rooted.groupBy("root").agg(F.min("least").alias("component"))
    classes = materialize(rooted.join(least, "root").select("fp", "component", "root"), "classes")
    return marked.join(classes, "fp").select("id", "fp", "component", "root", *(keep or {}))


def one_per_group(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE_WORDS, max_bits: int = MAX_BITS) -> DataFrame:
    """The rows of ``docs`` with one document of each near-duplicate group: the
    one with the smallest id (nulls last, then by a hash of the row).  Columns
    are those of ``docs``; of rows that are equal in every column one stays.
    """
    # 128 bits tell rows apart; rows equal in every column are one
    whole = [F.col(c) for c in docs.columns]
    row = {"_row": F.xxhash64(*whole), "_row2": F.xxhash64(F.lit(1), *whole)}
    groups = materialize(simhash_groups(docs, id_col, text_col, shingle, max_bits, row), "grouped")
    first = F.min(F.struct(F.col("id").isNull().alias("unnamed"), F.col("id"), F.col("_row"), F.col("_row2"))).alias("first")
    # a group is its root: ids may repeat over groups or be null; minima are
    # taken on the map side first, so that a large group sends a row a task
    kept = groups.groupBy("root").agg(first).select("first._row", "first._row2")
    copies = groups.groupBy(*row).agg(F.count(F.lit(1)).alias("_copies"))
    kept = materialize(kept.join(copies, list(row)), "kept")
    out = docs.withColumns(row).join(kept, list(row))
    once = out.where("_copies = 1").select(*docs.columns)
    several = out.where("_copies > 1").dropDuplicates(list(row)).select(*docs.columns)
    return once.unionByName(several)
