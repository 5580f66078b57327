"""Gapless numbers over all rows of a table, in an order, without one big sort.

Rows are range-partitioned on (group, order), sorted within partitions and
stored once with their position; a table of the partitions' counts (at most
partitions + groups rows, hence broadcast) turns positions into numbers.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quire.session import materialize


def numbered(df: DataFrame, order: Sequence[str], name: str, group: str | None = None) -> DataFrame:
    """``df`` with the bigint column ``name`` = 0, 1, ... in ``order`` (nulls
    first; rows equal in it come in any order), for each ``group`` if given.
    ``df`` must not have columns that start with ``_at_``."""
    groups = [group] if group else []
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = materialize(
        df.repartitionByRange(parts, *groups, *order)
        .sortWithinPartitions(*groups, *order)
        .withColumns({"_at_part": F.spark_partition_id(), "_at_row": F.monotonically_increasing_id()}),
        "numbered",
    )
    ahead = Window.partitionBy(*groups).orderBy("_at_part").rowsBetween(Window.unboundedPreceding, -1)
    counts = placed.groupBy("_at_part", *groups).agg(F.min("_at_row").alias("_at_first"), F.count(F.lit(1)).alias("_at_n"))
    shift = counts.select(
        F.col("_at_part").alias("_at_of"),
        *(F.col(g).alias("_at_group") for g in groups),
        (F.coalesce(F.sum("_at_n").over(ahead), F.lit(0)) - F.col("_at_first")).alias("_at_shift"),
    )
    keys = [F.col("_at_part") == F.col("_at_of")] + [F.col(g).eqNullSafe(F.col("_at_group")) for g in groups]
    return placed.join(F.broadcast(shift), keys).select(*df.columns, (F.col("_at_row") + F.col("_at_shift")).alias(name))
