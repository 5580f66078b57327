"""Sharding by histogram sort (DataFrame functions only).

Rows are ordered by a key of two bigints; shard boundaries (splitters) are keys.
Each round proposes candidate boundaries (probes) within every open splitter's
key interval, counts the exact bytes and rows below each probe with one
aggregate over the stored keys, and narrows the intervals; it ends when every
splitter is within ``tolerance`` bytes of its share, or when only one key is
left between its bounds, of which the nearer is taken.  Then all rows are
exchanged once, by range on (shard, key).

The driver holds probes and their counts only, at most ``PROBES`` a round
whatever the input.  A hot first key is split by the second one.  Rows equal in
both are split as well where a boundary falls among them: the bytes before each of
them, summed up by range partitions, tell on which side it is.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quire.llm.numbering import numbered
from quire.session import materialize

SHARDS = 8
PROBES = 128

_HALF, _WORD = 1 << 63, 1 << 64


def _key(k1: int, k2: int) -> int:
    """A pair of bigints as one integer of the same order."""
    return (k1 + _HALF) * _WORD + k2 + _HALF


def _pair(key: int) -> tuple[int, int]:
    return key // _WORD - _HALF, key % _WORD - _HALF


def _below(key: int) -> str:
    k1, k2 = _pair(key)
    if k1 >= _HALF:  # past the largest key
        return "true"
    lit = lambda k: f"{k}L" if k > -_HALF else "(-9223372036854775807L - 1L)"
    return f"k1 < {lit(k1)} OR (k1 = {lit(k1)} AND k2 < {lit(k2)})"


def interval_of(bounds: list[int]) -> Column:
    """How many of the ascending ``bounds`` are at or below the row's key
    (k1, k2): a binary search as nested conditions."""

    def search(lo: int, hi: int) -> str:
        if lo == hi:
            return str(lo)
        mid = (lo + hi) // 2
        return f"IF({_below(bounds[mid])}, {search(lo, mid)}, {search(mid + 1, hi)})"

    return F.expr(search(0, len(bounds)))


class _Splitter:
    """Bounds lo, hi of one splitter with the exact bytes below each."""

    def __init__(self, target: int, lo: int, hi: int, total: int):
        self.target, self.lo, self.hi, self.below_lo, self.below_hi = target, lo, hi, 0, total

    def open(self, tolerance: int, n: int) -> bool:
        return self.hi - self.lo > 1 and min(self.target - n * self.below_lo, n * self.below_hi - self.target) > n * tolerance

    def open_to_rows(self, tolerance: int, n: int) -> bool:
        """Whether neither bound is near enough."""
        return min(self.target - n * self.below_lo, n * self.below_hi - self.target) > n * tolerance

    def choice(self, n: int) -> int:
        return self.lo if self.target - n * self.below_lo <= n * self.below_hi - self.target else self.hi


def splitters(keys: DataFrame, shards: int = SHARDS, tolerance: int = 0, probes: int = PROBES) -> list[int]:
    """The ``shards`` - 1 boundaries (ascending integers of ``_key``) that cut
    ``keys(k1, k2, size)`` into shares of near-equal bytes: each is the key whose
    bytes below it are nearest to its share (the smaller key of two as near), or
    within ``tolerance`` bytes of it.  An empty table gives no boundaries."""
    return sorted(s.choice(shards) for s in _search(keys, shards, tolerance, probes))


def _search(keys: DataFrame, shards: int, tolerance: int, probes: int) -> list[_Splitter]:
    """Splitters whose bounds are as near as they need be."""
    all_rows = keys.agg(F.sum("size"), *(f(k) for k in ("k1", "k2") for f in (F.min, F.max))).first()
    total = all_rows[0]
    if total is None:
        return []
    first, last = _key(all_rows[1], all_rows[3]), _key(all_rows[2], all_rows[4])
    found = [_Splitter(total * j, first, last + 1, total) for j in range(1, shards)]
    while still := [s for s in found if s.open(tolerance, shards)]:
        tried = set()
        for s in still:
            step = max(2, probes // len(still)) + 1
            tried |= {s.lo, s.hi} | {s.lo + (s.hi - s.lo) * i // step for i in range(1, step)}
        bounds = sorted(tried)
        counted = keys.groupBy(interval_of(bounds).alias("i")).agg(F.sum("size").alias("size"), *(f(k).alias(f.__name__ + k) for k in ("k1", "k2") for f in (F.min, F.max))).collect()
        at = {r.i: r for r in counted}
        below, so_far = {}, 0
        for i, b in enumerate(bounds):
            so_far += at[i].size if i in at else 0
            below[b] = so_far
        for s in still:
            for b in bounds:
                if s.lo <= b <= s.hi:
                    if shards * below[b] <= s.target:
                        s.lo, s.below_lo = b, below[b]
                    else:
                        s.hi, s.below_hi = b, below[b]
                        break
            inside = [at[i] for i in range(bounds.index(s.lo) + 1, bounds.index(s.hi) + 1) if i in at]
            if not inside:  # no key between the bounds: they cut the rows alike
                s.hi = s.lo + 1 if s.below_lo == s.below_hi else s.hi
                continue
            # close in on the keys that are there
            low = min(_key(r.mink1, r.mink2 if r.mink1 == r.maxk1 else -_HALF) for r in inside)
            high = max(_key(r.maxk1, r.maxk2 if r.mink1 == r.maxk1 else _HALF - 1) for r in inside)
            s.lo, s.hi = max(s.lo, low), min(s.hi, high + 1)
    return found


def histogram_shards(df: DataFrame, key: Column, tie: Column, size: Column, shards: int = SHARDS, tolerance: int = 0) -> DataFrame:
    """``df`` with ``shard`` (int, 0 to ``shards`` - 1) and ``slot`` (bigint,
    gapless from 0 within its shard, in key order).

    ``key`` and ``tie`` are bigint expressions over ``df`` (null: the smallest
    value), ``size`` a bigint one (null: 0).  Shards hold near-equal sums of
    ``size``: each boundary is where a row begins, as near to its share as rows
    allow.  Rows equal in key and tie come in any order, in one shard or, where a
    boundary falls among them, in consecutive ones; with fewer rows than shards some
    shards stay empty.  Columns ``shard`` and ``slot`` of ``df`` are replaced.
    """
    smallest = F.lit(-_HALF).cast("bigint")
    keyed = df.select(*(c for c in df.columns if c not in ("shard", "slot")))
    order = {"k1": F.coalesce(key, smallest), "k2": F.coalesce(tie, smallest)}
    keys = materialize(df.select(*(c.alias(n) for n, c in order.items()), F.coalesce(size, F.lit(0)).alias("size")), "keys")
    found = _search(keys, shards, tolerance, PROBES)
    inner = df.select(F.struct(*keyed.columns).alias("row"), *(c.alias(n) for n, c in order.items()), F.coalesce(size, F.lit(0)).cast("bigint").alias("size"), F.monotonically_increasing_id().alias("tie"))
    # boundaries that are left inside a key of several rows, by key
    inside: dict[int, list[_Splitter]] = {}
    for s in found:
        if s.hi - s.lo == 1 and s.open_to_rows(tolerance, shards):
            inside.setdefault(s.lo, []).append(s)
    if inside:
        again = keys.where(_one_of(inside)).groupBy("k1", "k2").agg(F.count(F.lit(1)).alias("n")).where("n > 1").collect()  # at most a row a boundary
        inside = {k: inside[k] for k in (_key(r.k1, r.k2) for r in again)}
    bounds = sorted(s.hi if s.lo in inside and s in inside[s.lo] else s.choice(shards) for s in found)
    sharded = inner.withColumn("shard", interval_of(bounds).cast("int"))
    if inside:
        which = F.lit(None).cast("bigint")
        for i, k in enumerate(inside):
            which = F.when(_is(k), i).otherwise(which)
        runs = _running(sharded.where(_one_of(inside)).withColumn("run", which))
        after = F.lit(0)
        for i, (k, cuts) in enumerate(inside.items()):
            for s in cuts:
                end = (F.col("so_far") + s.below_lo) * shards
                begin = end - F.col("size") * shards
                # of two ends as near to the share the first is the boundary
                after = after + F.when((F.col("run") == i) & ((begin >= s.target) | ((end > s.target) & (s.target - begin <= end - s.target))), 1).otherwise(0)
        sharded = sharded.where(~_one_of(inside)).unionByName(runs.withColumn("shard", (F.col("shard") + after).cast("int")).select(sharded.columns))
    placed = numbered(sharded, ["k1", "k2", "tie"], "slot", group="shard")
    return placed.select("row.*", "shard", "slot")


def _running(rows: DataFrame) -> DataFrame:
    """``rows`` with ``so_far``: the sizes of the rows of the same ``run`` up to and
    with each, in the order of ``tie``.  A run spans range partitions; sums are taken
    within each, and those before it come from a table of at most partitions + runs
    rows, hence broadcast."""
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = rows.repartitionByRange(parts, "run", "tie").sortWithinPartitions("run", "tie")
    placed = materialize(placed.withColumns({"_at_part": F.spark_partition_id(), "_at_row": F.monotonically_increasing_id()}), "runs")
    ahead = Window.partitionBy("run").orderBy("_at_part").rowsBetween(Window.unboundedPreceding, -1)
    sums = placed.groupBy("_at_part", "run").agg(F.sum("size").alias("_at_sum"))
    sums = sums.select("_at_part", "run", F.coalesce(F.sum("_at_sum").over(ahead), F.lit(0)).alias("_at_ahead"))
    within = Window.partitionBy("_at_part", "run").orderBy("_at_row").rowsBetween(Window.unboundedPreceding, 0)
    met = placed.withColumn("so_far", F.sum("size").over(within)).join(F.broadcast(sums), ["_at_part", "run"])
    return met.withColumn("so_far", F.col("so_far") + F.col("_at_ahead"))


def _is(key: int) -> Column:
    k1, k2 = _pair(key)
    return (F.col("k1") == F.lit(k1)) & (F.col("k2") == F.lit(k2))


def _one_of(keys) -> Column:
    out = F.lit(False)
    for k in keys:
        out = out | _is(k)
    return out
