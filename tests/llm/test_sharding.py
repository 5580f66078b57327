import random
import zlib
from collections import Counter

import duckdb
from pyspark.sql import functions as F

from quire.llm import catalog, sharding
from tests.conftest import SF_SMALL

SCHEMA = "doc_id bigint, size bigint, shard string, _tie bigint"


def cut(rows, n):
    """Rows of (key, size) in order of key: the shards of each key's rows, by sums
    of sizes.  Rows of one key come in any order, so of them only those of equal
    size are told here."""
    rows = sorted(rows, key=lambda r: r[0])
    total, before, at = sum(s for _, s in rows), [], 0
    for k, s in rows:
        before.append((at, k))
        at += s
    ends = [b for b, _ in before] + [total]
    cuts = [min(ends, key=lambda b: (abs(n * b - j * total), b)) for j in range(1, n)]
    shards = {}
    for b, k in before:
        shards.setdefault(k, []).append(sum(b >= c for c in cuts))
    return shards


def test_query_equals_duckdb(spark):
    duckdb.sql(f"create or replace view documents as select * from '{SF_SMALL}/documents.parquet'")
    want = duckdb.sql(catalog.ORACLE_SHARDING).fetchall()
    out = catalog.op3_sharding(spark, SF_SMALL)
    assert sorted(map(tuple, out.collect()), key=str) == sorted(want, key=str)
    texts = dict(duckdb.sql("select doc_id, text from documents").fetchall())
    assert all(r.text_crc32 == zlib.crc32(texts[r.doc_id].encode()) for r in out.collect())


def check(spark, rows, n):
    df = spark.createDataFrame(rows, SCHEMA)
    out = sharding.histogram_shards(df, F.col("doc_id"), F.col("_tie"), F.col("size"), n)
    assert out.columns == ["doc_id", "size", "_tie", "shard", "slot"]
    low = -(1 << 63)
    key = lambda d, t: (low if d is None else d, low if t is None else t)
    want = cut([(key(d, t), s or 0) for d, s, _, t in rows], n)
    got = out.collect()
    assert sorted((str(r.doc_id), str(r.size), str(r._tie)) for r in got) == sorted((str(d), str(s), str(t)) for d, s, _, t in rows)
    own = {}
    for r in got:
        own.setdefault(key(r.doc_id, r._tie), []).append((r.shard, r.size or 0))
    for k, found in own.items():
        if len({s for _, s in found}) == 1:
            assert sorted(s for s, _ in found) == want[k]
    # no boundary is further from its share than half of a row
    sizes, total, at = Counter(), sum(s or 0 for _, s, _, _ in rows), 0
    for r in got:
        sizes[r.shard] += r.size or 0
    for j in range(1, n):
        at += sizes[j - 1]
        assert 2 * abs(n * at - j * total) <= n * max((s or 0 for _, s, _, _ in rows), default=0)
    for s in {r.shard for r in got}:
        own = sorted((r for r in got if r.shard == s), key=lambda r: r.slot)
        assert [r.slot for r in own] == list(range(len(own)))
        keys = [key(r.doc_id, r._tie) for r in own]
        assert keys == sorted(keys)


def test_hot_null_tied_and_extreme_keys(spark):
    rng = random.Random(1)
    top = (1 << 63) - 1
    rows = [(7, rng.randrange(1, 50), "x", rng.randrange(-top, top)) for _ in range(150)]
    rows += [(rng.choice([None, -top - 1, top, 0, 3]), rng.randrange(1, 50), None, rng.choice([None, 1, top, -top - 1])) for _ in range(100)]
    rows += [(rng.randrange(-top, top), rng.choice([1, 900]), "", 0) for _ in range(150)]
    check(spark, rows, 8)


def test_few_rows_and_empty(spark):
    check(spark, [(1, 5, None, 1), (1, 5, None, 1), (2, 5, None, 1)], 8)
    check(spark, [], 3)
    out = sharding.histogram_shards(spark.createDataFrame([(4, None, None, 1), (9, 0, None, 1)], SCHEMA), F.col("doc_id"), F.col("_tie"), F.col("size"), 3)
    assert sorted(r.doc_id for r in out.collect()) == [4, 9]


def test_tolerance_is_kept(spark):
    rows = [(i, 1 + i % 7, "", 0) for i in range(4000)]
    out = sharding.histogram_shards(spark.createDataFrame(rows, SCHEMA), F.col("doc_id"), F.col("_tie"), F.col("size"), 4, tolerance=40)
    sums = [r.s for r in out.groupBy("shard").agg(F.sum("size").alias("s")).collect()]
    assert len(sums) == 4 and max(sums) - min(sums) <= 4 * 40


def test_repeated_rows_are_split(spark):
    """900 of 1,000 rows are equal in key, tie and size."""
    rows = [(7, 100, "x", 5)] * 900 + [(i, 100, "y", i) for i in range(100, 200)]
    check(spark, rows, 8)
    out = sharding.histogram_shards(spark.createDataFrame(rows, SCHEMA), F.col("doc_id"), F.col("_tie"), F.col("size"))
    counts = [r["count"] for r in out.groupBy("shard").count().collect()]
    assert len(counts) == 8 and max(counts) - min(counts) <= 1
    # repeated rows of different sizes, with a boundary in each run
    rng = random.Random(9)
    check(spark, [(k, rng.choice([0, 1, 30]), None, None) for k in (1, 2, None) for _ in range(200)], 5)
