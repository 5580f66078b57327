"""Running sums within groups, in an order, without a group in one task.

Rows are range-partitioned on (group, order), so that a group with very many rows
spans partitions; each task adds up its own rows while it reads them.  Of a group
that begins in an earlier partition, the sums reached there are added: a table
with at most one row a partition, hence broadcast.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quire.session import materialize


def _add_up(batches, group: str, values: list[str], names: list[str]):
    part, row, last, reached = TaskContext.get().partitionId(), 0, None, None
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        of = batch.column(group).to_numpy(zero_copy_only=False)
        total = np.cumsum(np.stack([batch.column(v).to_numpy(zero_copy_only=False) for v in values]), axis=1)
        first = np.flatnonzero(np.concatenate([[True], of[1:] != of[:-1]]))
        before = np.concatenate([np.zeros((len(values), 1), np.int64), total[:, first[1:] - 1]], axis=1)
        total -= np.repeat(before, np.diff(np.append(first, n)), axis=1)
        if of[0] == last:
            total[:, : first[1] if len(first) > 1 else n] += reached[:, None]
        last, reached = of[-1], total[:, -1].copy()
        sums = [pa.array(total[i], pa.int64()) for i in range(len(values))]
        place = [pa.array(np.full(n, part, np.int32)), pa.array(np.arange(row, row + n, dtype=np.int64))]
        row += n
        yield pa.RecordBatch.from_arrays([*batch.columns, *sums, *place], names=names)


def running_sums(df: DataFrame, group: str, order: Sequence[str | Column], values: Sequence[str]) -> DataFrame:
    """``df`` with ``run_<v>`` for each bigint column v of ``values``: the sum of v
    over the rows of the same ``group`` (a bigint) up to and with the row.

    Rows equal in ``order`` come in the order in which they are read.  Group and
    values must not be null; sums must fit a bigint.  ``df`` is read twice (its
    ranges are sampled) and has no columns that start with ``_at_``.
    """
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    runs = [f"run_{v}" for v in values]
    keys = [F.col(group), *(F.col(o) if isinstance(o, str) else o for o in order), F.col("_at_tie")]
    ranged = df.withColumn("_at_tie", F.monotonically_increasing_id()).repartitionByRange(parts, *keys).sortWithinPartitions(*keys).drop("_at_tie")
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema] + [f"`{r}` bigint" for r in runs] + ["_at_part int", "_at_row bigint"])
    names = [*df.columns, *runs, "_at_part", "_at_row"]
    placed = materialize(ranged.mapInArrow(lambda batches: _add_up(batches, group, list(values), names), schema), "running")
    # of each partition its first group, its last, and the sums that one reaches
    ends = placed.groupBy("_at_part").agg(F.min(group).alias("_at_lo"), F.max(F.struct(F.col(group).alias("of"), "_at_row", *runs)).alias("_at_hi"))
    up_to = Window.partitionBy("_at_hi.of").orderBy("_at_part").rowsBetween(Window.unboundedPreceding, 0)
    ahead = Window.orderBy("_at_part")
    ends = ends.select("_at_part", "_at_lo", F.col("_at_hi.of").alias("_at_of"), *(F.sum(F.col("_at_hi")[r]).over(up_to).alias(f"_at_{r}") for r in runs))
    carried = ends.select("_at_part", "_at_lo", F.lag("_at_of").over(ahead).alias("_at_of"), *(F.lag(f"_at_{r}").over(ahead).alias(f"_at_{r}") for r in runs)).where("_at_of = _at_lo")
    met = placed.join(F.broadcast(carried), "_at_part", "left")
    begun = F.col(group) == F.col("_at_lo")
    return met.select(*df.columns, *((F.col(r) + F.when(begun, F.col(f"_at_{r}")).otherwise(0)).alias(r) for r in runs))
