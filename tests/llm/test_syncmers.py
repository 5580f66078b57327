import hashlib
import random

import duckdb
from pyspark.sql import functions as F

from quire.llm import catalog, syncmers
from tests.conftest import SF_SMALL
from tests.llm import brute


def edits(rows):
    """rows in order of id -> (id, n_chars, sha256 of the edited text, edited text, next text)."""
    out = []
    for i, (d, t) in enumerate(rows):
        t, nxt = t or "", rows[(i + 1) % len(rows)][1] or ""
        edited = t[: len(t) - len(t) // 2] + nxt[: len(t) // 2]
        out.append((d, len(t), hashlib.sha256(edited.encode()).hexdigest(), edited, nxt))
    return out


def chosen(spark, texts, k, s):
    """Brute force over words as tuples, hashed by Spark's xxhash64 of the words' hashes."""
    words = sorted({w for t in texts for w in brute.words(t)})
    one = dict(spark.createDataFrame([(w,) for w in words] or [("",)], "w string").select("w", F.xxhash64("w")).collect())
    smers = sorted({tuple(brute.words(t)[i : i + s]) for t in texts for i in range(len(brute.words(t)) - s + 1)})
    df = spark.createDataFrame([([one[w] for w in m],) for m in smers] or [([0] * s,)], "m array<bigint>")
    h = dict((tuple(r.m), r.h) for r in df.select("m", F.xxhash64(*(F.get("m", i) for i in range(s))).alias("h")).collect())
    out = []
    for t in texts:
        w = [one[x] for x in brute.words(t)]
        if len(w) < k:
            out.append([0] if w else [])
            continue
        found = []
        for i in range(len(w) - k + 1):
            inner = [h[tuple(w[i + j : i + j + s])] for j in range(k - s + 1)]
            if inner.index(min(inner)) in (0, k - s):
                found.append(i)
        out.append(found)
    return out


def test_query_edits_and_likeness(spark):
    rows = duckdb.sql(f"select doc_id, text from '{SF_SMALL}/documents.parquet' order by doc_id").fetchall()
    got = sorted(map(tuple, catalog.op9_syncmers(spark, SF_SMALL).collect()))
    want = edits(rows)
    assert [g[:3] for g in got] == [w[:3] for w in want]
    by_text = {}
    for g, (_, t) in zip(got, rows):
        assert by_text.setdefault(t, g[3]) == g[3] and 0 <= g[5] <= 1 and 0 <= g[6] <= 1
    long = [g for g in got if len(g[3]) >= 16 * 40]
    assert len(long) > 50 and all(g[5] > 0.25 for g in long) and sum(g[6] < 0.2 for g in long) > 0.9 * len(long)
    prints = [{f[i : i + 16] for i in range(0, len(f), 16)} for f in (g[3] for g in got)]
    for i, g in enumerate(got):
        a, b = prints[i], prints[(i + 1) % len(got)]
        assert abs(g[6] - (2 * len(a & b) / (len(a) + len(b)) if a or b else 1)) < 1e-3


def test_likeness_of_edited_texts_equals_brute_force(spark):
    """``near_edited`` and ``edited_fingerprint`` from the chosen windows of words."""
    rows = duckdb.sql(f"select doc_id, text from '{SF_SMALL}/documents.parquet' order by doc_id limit 60").fetchall()
    edited = [e[3] for e in edits(rows)]
    k, s = syncmers.K, syncmers.S
    texts = [t for _, t in rows] + edited
    sets = []
    for t, found in zip(texts, chosen(spark, texts, k, s)):
        w = brute.words(t)
        sets.append([tuple(w[i : i + k]) for i in found] if found and len(w) >= k else [tuple(w)] if w else [])
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = syncmers.against_next(df).orderBy("id").select("own", "edited_own", syncmers.likeness(F.col("own"), F.col("edited_own")).alias("near")).collect()
    for i, r in enumerate(got):
        a, b = list(dict.fromkeys(sets[i])), list(dict.fromkeys(sets[len(rows) + i]))
        assert (len(r.own), len(r.edited_own)) == (len(a), len(b))
        assert [x in r.edited_own for x in r.own] == [x in b for x in a]
        assert abs(r.near - (2 * len(set(a) & set(b)) / (len(a) + len(b)) if a or b else 1)) < 1e-12


def test_anchors_equal_brute_force(spark):
    rng = random.Random(12)
    texts = [" ".join(rng.choice("a b c d e f g h".split()) for _ in range(rng.randrange(60))) for _ in range(80)] + ["", " \n", None, "one two", "w " * 500]
    texts += [t[0] for t in duckdb.sql(f"select text from '{SF_SMALL}/documents.parquet' limit 20").fetchall()]
    for k, s in ((12, 2), (5, 3), (4, 1)):
        df = spark.createDataFrame(list(enumerate(texts)), "i int, text string")
        got = {r.i: [a.position for a in r.a] for r in df.select("i", syncmers.anchors(F.col("text"), k, s).alias("a")).collect()}
        assert [got[i] for i in range(len(texts))] == chosen(spark, [t or "" for t in texts], k, s)


def test_anchors_do_not_depend_on_context(spark):
    rng = random.Random(13)
    words = [f"w{rng.randrange(10**6)}" for _ in range(400)]
    inside, alone = " ".join(words), " ".join(words[100:300])
    df = spark.createDataFrame([(inside, alone)], "x string, y string").select(*(syncmers.anchors(F.col(c)).alias(c) for c in "xy"))
    r = df.first()
    assert [(a.position - 100, a.hash) for a in r.x if 100 <= a.position <= 300 - syncmers.K] == [(a.position, a.hash) for a in r.y]
    at = [a.position for a in r.x]
    assert max(b - a for a, b in zip(at, at[1:])) <= syncmers.K - syncmers.S + 1


def test_edge_rows(spark):
    rows = [(5, "e" * 11), (5, "e" * 11), (5, "e" * 11), (1, None), (2, ""), (3, "äöü😀x"), (None, "null id here"), (9, "last one of all"), (7, "a b c " * 9000)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("at", F.lit("clash"))
    got = [(r.id, r.n_chars, hashlib.sha256(r.edited.encode()).hexdigest()) for r in syncmers.against_next(df).collect()]
    ordered = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))
    key = lambda g: (g[0] is not None, g[0] or 0, g[1:])
    assert sorted(got, key=key) == sorted((e[:3] for e in edits(ordered)), key=key)
    assert syncmers.against_next(df.limit(0)).count() == 0
    one = syncmers.against_next(spark.createDataFrame([(1, "abcd")], "doc_id bigint, text string")).collect()
    assert [r.edited for r in one] == ["abab"]


def test_near_copies_keep_their_likeness(spark):
    """Windows of 10 words fit between edits 12 words apart."""
    rng = random.Random(15)
    words = [f"w{rng.randrange(10**6)}" for _ in range(3000)]
    edited = [f"new{i}" if i % 12 == 0 else w for i, w in enumerate(words)]
    df = spark.createDataFrame([(" ".join(words), " ".join(edited))], "a string, b string")
    near = df.select(syncmers.likeness(*(syncmers.hashes(syncmers.anchors(F.col(c))) for c in "ab"))).first()[0]
    assert syncmers.K == 10 and near > 0.1
    texts = [" ".join(rng.choice("abcdefgh") for _ in range(rng.randrange(60))) for _ in range(40)]
    got = [[a.position for a in r.a] for r in spark.createDataFrame(list(enumerate(texts)), "i int, text string").orderBy("i").select(syncmers.anchors(F.col("text"), 10, 2).alias("a")).collect()]
    assert got == chosen(spark, texts, 10, 2)


def test_neighbours_over_many_blocks(spark):
    rng = random.Random(16)
    for n in (syncmers.BLOCK, 2 * syncmers.BLOCK + 1, 5 * syncmers.BLOCK - 1):
        rows = [(i * 3, " ".join(f"w{rng.randrange(50)}" for _ in range(rng.randrange(40)))) for i in range(n)]
        out = syncmers.against_next(spark.createDataFrame(rows, "doc_id bigint, text string")).orderBy("id").collect()
        assert [(r.id, r.n_chars, r.edited) for r in out] == [(d, c, e) for d, c, _, e, _ in edits(rows)]
        assert all(r.next == out[(i + 1) % n].own for i, r in enumerate(out))


def test_short_texts_have_fingerprints(spark):
    """Texts of K to 2 K - S - 1 words without a closed syncmer are told apart."""
    rng = random.Random(17)
    k, s = syncmers.K, syncmers.S
    texts = [" ".join(f"w{rng.randrange(10**6)}" for _ in range(rng.randrange(k, 2 * k - s))) for _ in range(60)]
    assert [] in chosen(spark, texts, k, s)
    out = syncmers.against_next(spark.createDataFrame(list(enumerate(texts)) + [(100, " ")], "doc_id bigint, text string")).orderBy("id").collect()
    assert all(r.own for r in out[:60]) and not out[60].own
    assert len({tuple(r.own) for r in out[:60]}) == 60
    assert all(not set(r.own) & set(r.next) for r in out)
