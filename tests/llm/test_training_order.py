import uuid
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from quire.llm import catalog, packing, training_order
from quire.session import checkpoint_dir
from tests.conftest import SF_SMALL


def folder(spark):
    return f"{checkpoint_dir(spark)}/order-{uuid.uuid4().hex}"


@pytest.mark.parametrize("n", [1, 2, 3, 5, 16, 17, 255, 1000, 4097, 65536])
def test_permutation(n):
    for key in (0, 1, 12345678901234567890):
        out = training_order.permuted(np.arange(n), n, key)
        assert sorted(out.tolist()) == list(range(n))
        assert training_order.permuted(out, n, key, inverse=True).tolist() == list(range(n))
    if n > 200:
        a, b = training_order.permuted(np.arange(n), n, 1), training_order.permuted(np.arange(n), n, 2)
        assert (a == b).mean() < 0.05 and abs(np.corrcoef(np.arange(n), a)[0, 1]) < 0.2


def test_round_trip_and_resuming(spark):
    rng = np.random.default_rng(3)
    seqs = [(i if i % 7 else None, rng.integers(0, 1 << 16, rng.integers(0, 9)).astype("<u4").tobytes() if i % 5 else None) for i in range(103)] + [(50, b"\n\0\0\0\r\0\0\0")] * 3
    df = spark.createDataFrame(seqs, "sequence_id bigint, ids binary").withColumn("slot", F.lit("clash")).repartition(5)
    path, shape = folder(spark), {"length": 8, "width": 2, "per_shard": 10}
    assert training_order.write_shards(df, path, 9, **shape) == 106
    records = {r.slot: r for r in training_order.read_records(spark, path, **shape).collect()}
    manifest = spark.read.parquet(f"{path}/manifest").collect()
    assert sorted(records) == list(range(106)) == sorted(m.slot for m in manifest)
    want, got = defaultdict(int), defaultdict(int)
    for s, ids in seqs:
        want[s, ids or b""] += 1
    for m in manifest:
        data = np.frombuffer(bytes(records[m.slot].bytes), "<u2")
        assert len(data) == 8 and not data[m.n_ids :].any() and (m.shard, m.record) == (m.slot // 10, m.slot % 10)
        got[m.sequence_id, data[: m.n_ids].astype("<u4").tobytes()] += 1
        assert training_order.permuted(np.array([m.number]), 106, 9)[0] == m.slot
    assert got == want
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(f"{path}/shards").select("length").collect()
    assert sorted(f.length for f in files) == sorted([10 * 17] * 10 + [6 * 17])
    rest = training_order.read_records(spark, path, 57, **shape).collect()
    assert sorted((r.slot, bytes(r.bytes)) for r in rest) == sorted((s, bytes(r.bytes)) for s, r in records.items() if s >= 57)


def test_bad_and_empty_input(spark):
    wide = spark.createDataFrame([(1, np.array([70000], "<u4").tobytes())], "sequence_id bigint, ids binary")
    with pytest.raises(Exception, match="does not fit"):
        training_order.write_shards(wide, folder(spark), 1)
    path = folder(spark)
    assert training_order.write_shards(wide.limit(0), path, 1) == 0 and spark.read.parquet(f"{path}/manifest").count() == 0
    path = folder(spark)
    assert training_order.write_shards(wide, path, 1, width=4) == 1
    assert [r.slot for r in training_order.read_records(spark, path, width=4).collect()] == [0]


def test_query(spark):
    pieces = packing.pack_documents(catalog.table(spark, SF_SMALL, "documents"), "text", catalog._tokenizer(spark)).collect()
    ids = defaultdict(list)
    for p in sorted(pieces, key=lambda p: p.offset):
        ids[p.sequence_id].append(bytes(p.ids))
    got = catalog.op10_training_order(spark, SF_SMALL).collect()
    assert sorted(r.slot for r in got) == list(range(len(ids)))
    for r in got:
        own = np.frombuffer(b"".join(ids[r.sequence_id]), "<u4")
        record = np.zeros(2048, "<u2")
        record[: len(own)] = own
        assert r.n_ids == len(own) and r.record_crc32 == zlib.crc32(record.tobytes()) and r.record_bytes == 4096


@pytest.mark.parametrize("parts", ["2", "64"])
def test_shards_are_written_in_order_by_ranges(spark, monkeypatch, parts):
    """More shards than tasks and fewer; each file holds its slots in order."""
    monkeypatch.setattr(training_order, "SHARDS_A_TASK", 3)
    df = spark.range(1000).select(F.col("id").alias("sequence_id"), F.unhex(F.concat(F.lpad(F.hex(F.col("id") % 250 + 1), 2, "0"), F.lit("000000"))).alias("ids"))
    old = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", parts)
        path = folder(spark)
        assert training_order.write_shards(df, path, 5, length=1, per_shard=30) == 1000
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    manifest = {m.slot: m.sequence_id for m in spark.read.parquet(f"{path}/manifest").collect()}
    records = training_order.read_records(spark, path, length=1, per_shard=30).collect()
    assert len(records) == 1000 and all(bytes(r.bytes) == (manifest[r.slot] % 250 + 1).to_bytes(2, "little") for r in records)
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(f"{path}/shards").count()
    assert files == 34  # one a shard
