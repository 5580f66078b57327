"""Ranking within groups: full 1..N ranks, top-k, two-stage (hybrid) ranks,
rank lookup with a default.

``rank_within`` never puts one group into one task: rows are range-partitioned
on (group, order key) so a hot group spreads over many partitions; each
partition numbers its rows locally and a small table of per-partition counts
gives the offsets.  ``top_k`` uses ``row_number() <= k``, which Spark plans as
a WindowGroupLimit on both sides of the shuffle, so at most k rows per group
leave each map task.
"""

from __future__ import annotations

import weakref
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quire.session import materialize

# Upper bound (bytes) for a side that is broadcast explicitly.  Larger sides
# are left to AQE, which broadcasts at run time when the measured size is
# below spark.sql.adaptive.autoBroadcastJoinThreshold and shuffles otherwise.
BROADCAST_MAX_BYTES = 32 << 20
# What a row is counted as besides its strings.
ROW_BYTES = 64
# Narrow rows that a task may hold as a hash table (about 100 MB).
HASHED_MAX_ROWS = 1_000_000

# Fixed values that must equal the job's original behaviour: the number of
# first-stage documents re-scored, and the blend weights of the two stages.
TOP_RERANK = 10
RERANK_WEIGHT = 0.6
FIRST_STAGE_WEIGHT = 0.4


def bounded_broadcast(df: DataFrame, max_bytes: int | None = None, witness: DataFrame | None = None) -> DataFrame:
    """Broadcast ``df`` only when its bytes are proven to be at most ``max_bytes``.

    The strings of ``witness`` (default: ``df`` itself) are measured, plus a
    fixed size a row; a witness is a cheap table with a row and the strings of
    every row of ``df``, whose other columns are numbers.  Beyond the bound the
    plain DataFrame is returned and AQE plans the join, so callers keep the
    other side narrow.
    """
    return F.broadcast(df) if fits_broadcast(witness if witness is not None else df, max_bytes) else df


def join_in_blocks(df: DataFrame, small: DataFrame, on: Sequence[str], max_bytes: int | None = None, witness: DataFrame | None = None) -> DataFrame:
    """Inner join that never exchanges ``df``, whatever the size of ``small``.

    ``small`` is broadcast where it is proven to fit (see ``bounded_broadcast``);
    beyond that it is cut by a hash of its join keys into blocks that do, and
    ``df`` is read once a block.  For a wide ``df`` (texts) and a ``small`` that
    is bounded by collections, not by documents.
    """
    bound = BROADCAST_MAX_BYTES if max_bytes is None else max_bytes
    size = bytes_of(witness if witness is not None else small)
    if size <= bound:
        return df.join(F.broadcast(small), list(on))
    # blocks are about half the bound, so that an uneven one fits as well
    n = -(-2 * size // max(bound, 1))
    block = F.pmod(F.xxhash64(*on), F.lit(n))
    out = None
    for i in range(n):
        part = df.join(F.broadcast(small.where(block == i)), list(on))
        out = part if out is None else out.unionByName(part)
    return out


def hashed_where_small(stored: DataFrame, max_rows: int | None = None) -> DataFrame:
    """``stored`` as the hashed side of an exchanged join, which sorts neither side,
    where its rows are proven to be at most ``max_rows`` a shuffle partition; beyond
    that, and where it may be broadcast, Spark plans the join.  For a stored table
    (its files count their rows) of narrow rows, unique in the join's keys."""
    n = stored.count()
    partitions = int(stored.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    held = HASHED_MAX_ROWS if max_rows is None else max_rows
    return stored.hint("shuffle_hash") if n * ROW_BYTES > BROADCAST_MAX_BYTES and n <= held * partitions else stored


_BYTES: "weakref.WeakKeyDictionary" = weakref.WeakKeyDictionary()


def fits_broadcast(df: DataFrame, max_bytes: int | None = None) -> bool:
    """Whether the rows of ``df`` take at most ``max_bytes``."""
    return bytes_of(df) <= (BROADCAST_MAX_BYTES if max_bytes is None else max_bytes)


def bytes_of(df: DataFrame) -> int:
    """What the rows of ``df`` take; measured once per DataFrame object (its plan
    and file listing are fixed once it is built)."""
    if df not in _BYTES:
        size = F.lit(ROW_BYTES).cast("bigint")
        for f in df.schema:
            if f.dataType.typeName() == "string":
                size = size + F.coalesce(F.octet_length(F.col(f"`{f.name}`")), F.lit(0))
            elif f.dataType.typeName() in ("array", "map", "struct", "binary"):
                size = size + F.coalesce(F.octet_length(F.to_json(F.struct(F.col(f"`{f.name}`")))), F.lit(0))
        _BYTES[df] = df.agg(F.sum(size)).first()[0] or 0
    return _BYTES[df]


def _order_cols(order: Sequence) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in order]


def rank_within(df: DataFrame, group: Sequence[str], order: Sequence, name: str = "rank", partitions: int | None = None) -> DataFrame:
    """Add ``name`` = 1..N per group in ``order`` (which must be a total order,
    e.g. end with a unique id).  Skew-safe: see the module doc.

    The range-sorted rows with their partition id and position are written
    once as a table under ``spark.checkpoint.dir``; the per-partition counts
    and the numbering both read that table, so they cannot disagree, and the
    upstream plan is not re-run for the second consumer.
    """
    group = list(group)
    keys = [F.col(g) for g in group] + _order_cols(order)
    spark = df.sparkSession
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    s = materialize(
        df.repartitionByRange(n, *keys)
        .sortWithinPartitions(*keys)
        .withColumn("_rp", F.spark_partition_id())
        .withColumn("_ri", F.monotonically_increasing_id()),
        "rank",
    )
    firsts = s.groupBy("_rp", *group).agg(F.min("_ri").alias("_rfirst"), F.count(F.lit(1)).alias("_rn"))
    w = Window.partitionBy(*group).orderBy("_rp").rowsBetween(Window.unboundedPreceding, -1)
    offsets = firsts.withColumn("_roff", F.coalesce(F.sum("_rn").over(w), F.lit(0)))
    return (
        s.join(offsets.drop("_rn"), ["_rp", *group])
        .withColumn(name, (F.col("_ri") - F.col("_rfirst") + F.col("_roff") + 1).cast("int"))
        .drop("_rp", "_ri", "_rfirst", "_roff")
    )


def top_k(df: DataFrame, group: Sequence[str], order: Sequence, k: int, name: str = "_k") -> DataFrame:
    """First ``k`` rows per group in ``order`` (row_number column ``name``)."""
    w = Window.partitionBy(*group).orderBy(*_order_cols(order))
    return df.withColumn(name, F.row_number().over(w)).where(F.col(name) <= k)


def rank_documents(scored: DataFrame, score: str = "score", group: str = "collection", ord_col: str = "doc_ord", key: str = "doc_id", name: str = "bi_rank") -> DataFrame:
    """First-stage rank: score descending, ties in input (``doc_ord``) order."""
    return rank_within(scored, [group], [F.col(score).desc(), F.col(ord_col).asc(), F.col(key).asc()], name)


def hybrid_rank(
    scored: DataFrame,
    score: str = "score",
    rerank: str = "rerank",
    group: str = "collection",
    ord_col: str = "doc_ord",
    key: str = "doc_id",
    top: int = TOP_RERANK,
    rerank_weight: float = RERANK_WEIGHT,
    first_weight: float = FIRST_STAGE_WEIGHT,
    digits: int = 9,
    with_bi_rank: bool = True,
) -> DataFrame:
    """Two-stage rank.

    Stage 1 orders by ``score`` (ties by ``doc_ord``).  The first ``top`` rows
    of each group get ``rerank_weight * rerank + first_weight * score``, the
    others keep ``score`` (scales are mixed on purpose, so a tail row can pass
    a re-ranked one).  Stage 2 ranks by that blended score, ties keep stage-1
    order.  Adds final_score, importance_rank and (``with_bi_rank``) bi_rank.

    Only the final rank needs a full ranking: membership of the first stage's
    top rows is a top-k (WindowGroupLimit), and ordering by (blended desc,
    stage-1 rank) equals ordering by (blended desc, in-top desc, score desc,
    doc_ord, key).
    """
    stage1 = [F.col(score).desc(), F.col(ord_col).asc(), F.col(key).asc()]
    if with_bi_rank:
        r1 = rank_within(scored, [group], stage1, "bi_rank")
        in_top = F.col("bi_rank") <= top
    else:
        heads = top_k(scored.select(group, key, score, ord_col), [group], stage1, top).select(group, key, F.lit(True).alias("_top"))
        r1 = scored.join(heads, [group, key], "left")
        in_top = F.coalesce(F.col("_top"), F.lit(False))
    blended = F.when(
        in_top,
        F.lit(rerank_weight).cast("double") * F.col(rerank) + F.lit(first_weight).cast("double") * F.col(score),
    ).otherwise(F.col(score))
    r1 = r1.withColumn("final_score", F.round(blended, digits)).withColumn("_in_top", in_top)
    order = [F.col("final_score").desc(), F.col("_in_top").desc(), *stage1]
    return rank_within(r1, [group], order, "importance_rank").drop("_in_top", "_top")


def shared_names(ranks: DataFrame, group: str = "collection", name_col: str = "filename", rank_col: str = "importance_rank") -> DataFrame:
    """(group, name, rank) of the file names listed more than once: such a name
    carries the rank assigned last, the larger one."""
    by_name = ranks.groupBy(group, name_col).agg(F.max(rank_col).alias("_r"), F.count(F.lit(1)).alias("_n"))
    return by_name.where("_n > 1").drop("_n")


def rank_lookup(manifest: DataFrame, ranks: DataFrame, group: str = "collection", name_col: str = "filename",
                rank_col: str = "importance_rank", groups_witness: DataFrame | None = None) -> DataFrame:
    """Rank of each manifest entry by file name, default ``n + 1`` (n = entries
    in the collection's manifest).  A file name listed twice takes the larger
    (later-assigned) rank for every entry carrying it.

    ``groups_witness`` (e.g. the jobs table) bounds the number of collections;
    with it the per-collection counts are broadcast, otherwise AQE plans the
    collection-keyed join (broadcast at run time or skew-split)."""
    by_name = ranks.groupBy(group, name_col).agg(F.max(rank_col).alias("_r"))
    n = manifest.groupBy(group).agg(F.count(F.lit(1)).alias("_n"))
    if groups_witness is not None:
        n = bounded_broadcast(n, witness=groups_witness)
    return (
        manifest.join(by_name, [group, name_col], "left")
        .join(n, group)
        .withColumn(rank_col, F.coalesce(F.col("_r"), F.col("_n") + 1).cast("int"))
        .drop("_r", "_n")
    )
