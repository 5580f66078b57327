"""Training-order materialisation of token sequences.

Sequence number i of N gets the global slot F(i), where F is a keyed Feistel
permutation of 2^(2b) >= N values, applied again while its value is N or more
(cycle-walking): a bijection of 0 .. N - 1 that needs no shuffle to compute, no
table, and only the key to repeat or invert.  Slots are cut into ranges of
``per_shard``; each range is one shard file of fixed-stride records in order of
slot, so the record of any slot is found by arithmetic and a reader resumes
anywhere.  The sequences are exchanged once, by range: a task gets consecutive
shards, as many as ``SHARDS_A_TASK`` at most unless there are more tasks than that
needs anyway.  Until they are written, records are compressed one by one.

A record is ``length`` ids of ``width`` bytes, little-endian, padded with
``PAD``, and one line feed (Spark's text writer, whose commit protocol makes the
files survive lost executors, ends records so): ``length * width + 1`` bytes.  A
manifest table holds, for each slot, the sequence and how many ids are its own.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quire.session import materialize

LENGTH, WIDTH, PAD = 2048, 2, 0
PER_SHARD = 4096
#: Level at which records are compressed.
COMPRESSION = 3
#: Shards of a writing task (8 of 4096 records of 4 KB: 134 MB, which it sorts).
SHARDS_A_TASK = 8
ROUNDS = 6


def _mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit affects every output bit."""
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def _bits(n: int) -> int:
    return max(1, -(-max(n - 1, 1).bit_length() // 2))


def permuted(i: np.ndarray, n: int, key: int, inverse: bool = False) -> np.ndarray:
    """The slots of numbers 0 .. n - 1 (or the numbers of slots)."""
    b = np.uint64(_bits(n))
    low = (np.uint64(1) << b) - np.uint64(1)
    out = np.asarray(i).astype(np.uint64)
    walking = np.ones(len(out), bool)
    keys = [np.uint64((key * 0x9E3779B97F4A7C15 + r * 0xD1B54A32D192ED03) % (1 << 64)) for r in range(ROUNDS)]
    while walking.any():
        left, right = out[walking] >> b, out[walking] & low
        for k in reversed(keys) if inverse else keys:
            if inverse:
                left, right = right ^ (_mix(left ^ k) & low), left
            else:
                left, right = right, left ^ (_mix(right ^ k) & low)
        out[walking] = (left << b) | right
        walking = out >= np.uint64(n)
    return out.astype(np.int64)


def slot_of(number: Column, n: int, key: int) -> Column:
    @F.arrow_udf("bigint")
    def slots(numbers: pa.Array) -> pa.Array:
        return pa.array(permuted(numbers.to_numpy(zero_copy_only=False), n, key), pa.int64())

    return slots(number)


def record(ids: np.ndarray, length: int = LENGTH, width: int = WIDTH) -> bytes:
    """Ids as a record (without its line feed)."""
    if len(ids) > length or (ids >> np.uint32(8 * width - 1) >> np.uint32(1)).any():
        raise ValueError(f"a sequence has more than {length} ids, or one that does not fit {width} bytes")
    padded = np.full(length, PAD, f"<u{width}")
    padded[: len(ids)] = ids
    return padded.tobytes()


def compressed_record(ids: np.ndarray, length: int = LENGTH, width: int = WIDTH) -> bytes:
    return pa.Codec("zstd", COMPRESSION).compress(record(ids, length, width), asbytes=True)


def _compressed_records(ids: Column, length: int, width: int) -> Column:
    """Little-endian 32-bit ids as compressed records."""

    @F.arrow_udf("binary")
    def records(column: pa.Array) -> pa.Array:
        return pa.array([compressed_record(np.frombuffer(data or b"", "<u4"), length, width) for data in column.to_pylist()], pa.binary())

    return records(ids)


def _expanded(records: Column, size: int) -> Column:
    @F.arrow_udf("binary")
    def plain(column: pa.Array) -> pa.Array:
        return pa.array([pa.decompress(data, size, codec="zstd", asbytes=True) for data in column.to_pylist()], pa.binary())

    return plain(records)


def _numbered_as_read(df: DataFrame) -> tuple[DataFrame, int]:
    """``df`` stored, with ``number`` = 0, 1, ... in the order of its tasks and
    their rows, and the number of rows.  No exchange: the counts of the tasks (a
    row each, hence broadcast) shift their rows' positions.  With a column ``_row``
    (task << 33 and the position in it, gapless) it is a stored table already."""
    if "_row" in df.columns:
        placed, df = df, df.drop("_row")
    else:
        placed = materialize(df.withColumn("_row", F.monotonically_increasing_id()), "sequences")
    task = F.shiftright("_row", 33)
    counts = placed.groupBy(task.alias("task")).agg(F.count(F.lit(1)).alias("n"))
    ahead = Window.orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    shift = counts.select("task", F.coalesce(F.sum("n").over(ahead), F.lit(0)).alias("shift"))
    met = placed.withColumn("task", task).join(F.broadcast(shift), "task")
    row = F.col("_row").bitwiseAND(F.lit((1 << 33) - 1))
    return met.select(*df.columns, (row + F.col("shift")).alias("number")), placed.count()


def write_shards(seqs: DataFrame, path: str, key: int, id_col: str = "sequence_id", ids_col: str = "ids", length: int = LENGTH, width: int = WIDTH, per_shard: int = PER_SHARD) -> int:
    """Writes ``path/shards/shard=<n>`` (one file each) and ``path/manifest``
    (``slot, shard, record, number, sequence_id, n_ids``); returns the number of
    sequences.

    Sequences are numbered as they are read, then permuted.  Null ids of a
    sequence are a sequence without ids; null or repeated sequence ids are
    written like any others.  More ids than ``length``, or ids too large for
    ``width`` bytes, are errors.  An empty table writes an empty manifest.
    """
    held = seqs.select(
        F.col(id_col).cast("bigint").alias("sequence_id"),
        (F.length(F.coalesce(ids_col, F.lit(b""))) / 4).cast("int").alias("n_ids"),
        _compressed_records(F.col(ids_col), length, width).alias("bytes"),
    )
    return write_records(held, path, key, length, width, per_shard)


def write_records(held: DataFrame, path: str, key: int, length: int = LENGTH, width: int = WIDTH, per_shard: int = PER_SHARD) -> int:
    """``write_shards`` for sequences that are compressed records already:
    ``sequence_id, n_ids, bytes`` (of ``compressed_record``), stored or not (see
    ``_numbered_as_read``)."""
    parts = int(held.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    numbered, total = _numbered_as_read(held)
    slotted = numbered.withColumn("slot", slot_of(F.col("number"), max(total, 1), key))
    place = {"shard": F.floor(F.col("slot") / per_shard).cast("bigint"), "record": (F.col("slot") % per_shard).cast("int")}
    slotted = slotted.withColumns(place)
    slotted.select("slot", "shard", "record", "number", "sequence_id", "n_ids").write.parquet(f"{path}/manifest")
    shards = max(1, -(-total // per_shard))
    tasks = min(shards, max(parts, -(-shards // SHARDS_A_TASK)))
    task = F.floor(F.col("shard") * tasks / shards).cast("int")
    ranged = slotted.select("shard", "slot", "bytes").repartitionById(tasks, task)
    plain = ranged.select("shard", "slot", _expanded(F.col("bytes"), length * width).cast("string").alias("value")).sortWithinPartitions("shard", "slot")
    plain.select("shard", "value").write.partitionBy("shard").text(f"{path}/shards")
    return total


def read_records(spark: SparkSession, path: str, first_slot: int = 0, length: int = LENGTH, width: int = WIDTH, per_shard: int = PER_SHARD) -> DataFrame:
    """``slot, shard, record, bytes`` from ``first_slot`` on: whole shards before
    it are not read, and records are cut by their stride."""
    stride = length * width + 1
    schema = "path string NOT NULL, modificationTime timestamp NOT NULL, length bigint NOT NULL, content binary, shard bigint"
    files = spark.read.format("binaryFile").schema(schema).load(f"{path}/shards")
    found = files.where(F.col("shard") >= first_slot // per_shard).select("shard", "content", (F.length("content") / stride).cast("int").alias("n"))
    each = found.select("shard", "content", F.explode(F.sequence(F.lit(0), F.col("n") - 1)).alias("record"))
    cut = each.select((F.col("shard") * per_shard + F.col("record")).alias("slot"), "shard", "record", F.substring("content", F.col("record") * stride + 1, F.lit(stride - 1)).alias("bytes"))
    return cut.where(F.col("slot") >= first_slot)
