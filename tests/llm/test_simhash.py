import random

import duckdb
from pyspark.sql import functions as F

from quire.llm import catalog, components, simhash
from tests.conftest import SF_SMALL
from tests.llm import brute

SCHEMA = "doc_id bigint, text string"


def key(r):
    return tuple((x is None, x) for x in r)


def test_query_equals_brute_force(spark):
    rows = duckdb.sql(f"select doc_id, text from '{SF_SMALL}/documents.parquet'").fetchall()
    got = [tuple(r) for r in catalog.op1_simhash(spark, SF_SMALL).collect()]
    assert sorted(got) == sorted(brute.simhash_components(rows))


def test_edge_rows(spark):
    base = " ".join(f"word{i}" for i in range(300))
    rows = [(5, None), (3, ""), (9, " \t\n"), (1, base), (2, base), (2, base), (4, base.upper()), (None, "lone text"), (None, "lone text"), (7, "KK Äx y"), (8, "one"), (6, base + " tail")]
    df = spark.createDataFrame(rows, SCHEMA).withColumn("fp", F.lit(1)).withColumn("component", F.lit("x"))
    got = [(r.id, f"{r.fp & (2**64 - 1):016x}", r.component) for r in simhash.simhash_groups(df).collect()]
    assert sorted(got, key=key) == sorted(brute.simhash_components(rows), key=key)
    assert simhash.simhash_groups(df.limit(0)).count() == 0


def test_links_equal_all_pairs(spark):
    rng = random.Random(3)
    fps = {0, (1 << 64) - 1}
    for _ in range(40):
        c = rng.getrandbits(64)
        fps.add(c)
        for _ in range(30):
            x = c
            for b in rng.sample(range(64), rng.randint(1, 6)):
                x ^= 1 << b
            fps.add(x)
    signed = lambda f: f - (1 << 64) if f >> 63 else f
    df = spark.createDataFrame([(signed(f),) for f in fps], "fp bigint")
    got = {(r.a, r.b) for r in simhash.fingerprint_links(df).collect()}
    want = {(signed(a), signed(b)) for a in fps for b in fps if signed(a) < signed(b) and bin(a ^ b).count("1") <= 3}
    assert got == want and len(want) > 200


def test_replicas_are_not_broadcast(spark):
    fps = spark.createDataFrame([(1 << i,) for i in range(40)], "fp bigint")
    links = simhash.fingerprint_links(fps)
    plan = lambda: links._jdf.queryExecution().executedPlan().toString()
    # however small Spark holds the sides to be, before the run and in it
    assert "Broadcast" not in plan()
    assert len({tuple(r) for r in links.collect()}) == 40 * 39 // 2
    assert "isFinalPlan=true" in plan() and "Broadcast" not in plan()


def test_components(spark):
    rng = random.Random(5)
    chain = [(i, i + 1) for i in range(100, 140)]
    star = [(500, i) for i in range(501, 560)]
    rand = [(rng.randrange(1000, 1400), rng.randrange(1000, 1400)) for _ in range(300)]
    links = chain + star + rand + [(7, 7), (None, 3), (9, 8), (8, 9)]
    got = {r.node: r.root for r in components.components(spark.createDataFrame(links, "a bigint, b bigint")).collect()}
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in links:
        if a is not None and a != b:
            x, y = sorted((find(a), find(b)))
            root[y] = x
    assert got == {x: find(x) for x in root}
    assert components.components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def test_one_per_group(spark):
    base = " ".join(f"word{i}" for i in range(300))
    rows = [(4, base, "a"), (2, base + " x", "b"), (2, base + " x", "b"), (2, base + " x", "c"), (9, "another text here", None), (None, "null id", "d"), (None, "null id", "d"), (None, "second null id text", "e")]
    out = simhash.one_per_group(spark.createDataFrame(rows, SCHEMA + ", lang string"))
    assert out.columns == ["doc_id", "text", "lang"]
    got = [tuple(r) for r in out.collect()]
    assert len(got) == 4
    assert [g[0] for g in sorted(got, key=key)] == [2, 9, None, None]
    assert simhash.one_per_group(spark.createDataFrame([], SCHEMA + ", lang string")).count() == 0


def test_one_per_group_with_one_id_or_none(spark):
    rng = random.Random(3)
    text = lambda: " ".join(f"word{rng.randrange(10**6)}" for _ in range(600))
    near = [(None, text(), "b")]
    near += [(None, near[0][1] + end, "b") for end in (" x", " y")]
    fps = [simhash.simhash64(t.encode()) for _, t, _ in near]
    assert len(set(fps)) > 1 and all((f ^ fps[0]).bit_count() <= 3 for f in fps)
    other = [(0, text(), "a") for _ in range(6)]
    got = [tuple(r) for r in simhash.one_per_group(spark.createDataFrame(other + near, SCHEMA + ", lang string")).collect()]
    assert sorted(g for g in got if g[0] == 0) == sorted(other)
    assert sum(g[0] is None for g in got) == 1
