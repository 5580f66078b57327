import collections
import hashlib
import random
import zlib

import duckdb
import pytest
from pyspark.sql import functions as F

from quire.llm import catalog, contraction, running, tries
from tests.conftest import SF_SMALL


def brute_sums(parent, value):
    total = dict(value)
    order, seen = [], set()
    for n in parent:
        path = []
        while n is not None and n in parent and n not in seen:
            seen.add(n)
            path.append(n)
            n = parent[n]
        order = path + order  # children before parents
    for n in order:
        if parent[n] in parent:
            total[parent[n]] += total[n]
    return total


def shapes():
    rng = random.Random(4)
    yield "chain", {i: i - 1 if i else None for i in range(60)}
    yield "star", {i: 0 if i else None for i in range(200)}
    yield "bushy", {i: rng.randrange(i) if i else None for i in range(150)}
    yield "deep", {i: max(0, i - rng.choice([1, 1, 1, 1, 2, 9])) if i else None for i in range(150)}
    yield "forest", {i: rng.choice([None, 900, rng.randrange(i)]) if i else None for i in range(100)}
    yield "comb", {i: (None if i == 0 else i - 2 if i % 2 == 0 else i - 1) for i in range(60)}


@pytest.mark.parametrize("name,parent", list(shapes()), ids=[n for n, _ in shapes()])
def test_subtree_sums_equal_brute_force(spark, name, parent):
    rng = random.Random(name)
    value = {n: rng.randrange(-5, 50) for n in parent}
    rows = [(n, p, value[n], 1, "x") for n, p in parent.items()]
    df = spark.createDataFrame(rows, "node bigint, parent bigint, a bigint, b bigint, rest string")
    got = {r.node: (r.a, r.b) for r in contraction.subtree_sums(df, ["a", "b"]).collect()}
    a, b = brute_sums(parent, value), brute_sums(parent, dict.fromkeys(parent, 1))
    assert got == {n: (a[n], b[n]) for n in parent}


def test_odd_forests(spark):
    schema = "id string, up string, a bigint"
    df = spark.createDataFrame([("r", None, None), ("x", "r", 4), (None, "r", 100), ("y", "x", 3)], schema)
    out = contraction.subtree_sums(df, ["a"], "id", "up")
    assert out.columns == ["id", "a"] and {tuple(r) for r in out.collect()} == {("r", 7), ("x", 7), ("y", 3)}
    assert contraction.subtree_sums(df.limit(0), ["a"], "id", "up").count() == 0
    with pytest.raises(ValueError, match="repeated"):
        contraction.subtree_sums(df.unionByName(df), ["a"], "id", "up")
    with pytest.raises(ValueError, match="circle"):
        contraction.subtree_sums(spark.createDataFrame([("a", "b", 1), ("b", "a", 1)], schema), ["a"], "id", "up")


@pytest.mark.parametrize("parts", ["1", "7"])
def test_running_sums(spark, parts):
    """One group with most rows spans partitions; ties and repeated rows too."""
    rng = random.Random(5)
    rows = [(5 if rng.random() < 0.7 else rng.randrange(12), rng.choice([None, 1, 2, 2, 3]), rng.randrange(9), "x") for _ in range(3000)]
    old = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", parts)
        df = spark.createDataFrame(rows, "g bigint, o int, v bigint, row string").withColumn("one", F.lit(1).cast("bigint"))
        got = running.running_sums(df, "g", [F.col("o").asc_nulls_first()], ["v", "one"]).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    by_group = collections.defaultdict(list)
    for r in got:
        by_group[r.g].append(r)
    assert len(got) == 3000
    for g, found in by_group.items():
        found.sort(key=lambda r: r.run_one)
        assert [r.run_one for r in found] == list(range(1, len(found) + 1))
        assert [r.o is not None and r.o for r in found] == sorted((o is not None and o for x, o, _, _ in rows if x == g))
        total = 0
        for r in found:
            total += r.v
            assert r.run_v == total
    assert running.running_sums(df.limit(0), "g", ["o"], ["v"]).count() == 0


def brute_trie(rows, rebuild=True):
    """rows of (conv, turn, role, text) -> the sorted rows of the query."""
    own = collections.defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            own[conv].append(((turn is not None, turn or 0), role or "", text or ""))
    own = {c: [(r, t) for _, r, t in sorted(x, key=lambda y: y[0])] for c, x in own.items()}
    convs = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 9 if rebuild else 0
        convs[c] = tuple(own.get(c - c % 5, [])[:h] + turns[h:])
    members = collections.defaultdict(list)
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members[turns[:d]].append(c)
    children = collections.Counter(n[:-1] for n in members if n)
    leaves, saved = collections.Counter(), collections.Counter()
    for n, m in members.items():
        for d in range(len(n) + 1):
            leaves[n[:d]] += not children[n]
            saved[n[:d]] += (len(m) - 1) * len(n[-1][1].encode()) if n else 0
    out = []
    for n, m in members.items():
        ends = ",".join(map(str, sorted(c for c in m if len(convs[c]) == len(n))))
        out.append((min(m), len(n), min(members[n[:-1]]) if n else None, len(m), children[n], leaves[n], saved[n], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out)


COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def test_query_equals_brute_force(spark):
    rows = duckdb.sql(f"select conv_id, turn, role, text from '{SF_SMALL}/conversations.parquet'").fetchall()
    got = catalog.op13_conversation_trie(spark, SF_SMALL).select(*COLUMNS).collect()
    assert sorted(map(tuple, got)) == brute_trie(rows)


def conversations(rng):
    """Long chains, shared beginnings, copies, conversations cut short, gaps."""
    rows = []
    for c in rng.sample(range(200), 120):
        n = rng.choice([1, 1, 2, 3, 9, 12]) if c != 35 else 150
        for t in range(n):
            turn = t if t or rng.random() < 0.7 else None
            rows.append((c, turn, rng.choice(["user", "user", None]), rng.choice(["", "ja", "é日", None, "no"]) if t > 3 else "same"))
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed", range(2))
def test_odd_conversations_equal_brute_force(spark, seed, tmp_path):
    rows = conversations(random.Random(seed))
    rows += [(None, 1, "user", "nobody's"), (7000, None, None, None), (10**15 + 2, 3, "a", "b"), (10**15, 3, "a", "b")]
    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    for name in ("conv", "size", "one", "depth"):  # clashing names
        df = df.withColumn(name, F.lit("z"))
    df.write.parquet(f"{tmp_path}/conversations.parquet")
    got = catalog.op13_conversation_trie(spark, str(tmp_path)).select(*COLUMNS).collect()
    assert sorted(map(tuple, got)) == brute_trie(rows)


def test_trie_of_conversations_as_they_are(spark):
    """The operator's own interface: no rebuilding; ties and repeated turns have one
    order, a conversation without turns ends at the root."""
    rows = [(3, 1, "u", "a"), (3, 2, "u", "b"), (1, 1, "u", "a"), (1, 2, "u", "c"), (2, 1, "u", "a"), (2, 2, "u", "b"), (2, 3, "u", "b" * 100000)]
    df = spark.createDataFrame(rows, "conv_id bigint, turn int, role string, text string")
    turns = tries.turn_rows(df)
    convs = spark.createDataFrame([(1,), (2,), (3,), (9,)], "conv bigint")
    got = {(r.conv, r.depth): r for r in tries.prefix_trie(turns, convs).collect()}
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    assert set(got) == {(1, 0), (1, 1), (1, 2), (2, 2), (2, 3)}
    assert got[1, 0].ends_sha256 == sha("9") and got[1, 0].n_convs == 4 and got[1, 0].saved == 3 and got[1, 0].n_leaves == 2
    assert got[2, 2].ends_sha256 == sha("3") and got[2, 2].saved == 1 and got[1, 1].ends_sha256 == sha("") == tries.EMPTY_DIGEST
    tied = [(c, 1, "u", t) for c in (1, 2) for t in ("abac" if c == 1 else "caba")]
    once = tries.prefix_trie(tries.turn_rows(spark.createDataFrame(tied, df.schema)), convs.where("conv < 3"))
    assert [(r.depth, r.n_convs) for r in once.sort("depth").collect()] == [(d, 2) for d in range(5)]
    assert tries.prefix_trie(tries.turn_rows(df.limit(0)), convs.limit(0)).count() == 0
    alone = tries.prefix_trie(tries.turn_rows(df.limit(0)), convs).collect()
    assert [(r.conv, r.depth, r.n_convs, r.n_leaves, r.ends_sha256) for r in alone] == [(1, 0, 4, 1, sha("1,2,3,9"))]
