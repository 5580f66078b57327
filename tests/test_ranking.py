"""Ranking: skew-safe full ranks, two-stage ranks, lookups."""
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from quire.operators import ranking as R
from quire.operators import similarity as S


def test_rank_within_equals_row_number_with_hot_group(spark):
    # one group holds most rows, with many tied scores
    data = [("hot", i, float(i % 7)) for i in range(3000)] + [(f"g{j}", i, float(i % 3)) for j in range(20) for i in range(15)]
    df = spark.createDataFrame(data, "grp string, id long, score double").repartition(6)
    got = R.rank_within(df, ["grp"], [F.col("score").desc(), F.col("id").asc()], "r", partitions=7)
    w = Window.partitionBy("grp").orderBy(F.col("score").desc(), F.col("id").asc())
    want = df.withColumn("r", F.row_number().over(w))
    diff = got.select("grp", "id", "r").exceptAll(want.select("grp", "id", "r"))
    assert diff.count() == 0
    assert got.count() == df.count()


def test_top_k_per_group(spark):
    df = spark.createDataFrame([("a", i) for i in range(50)] + [("b", i) for i in range(3)], "g string, v long")
    got = R.top_k(df, ["g"], [F.col("v").desc()], 5)
    assert sorted((r.g, r.v) for r in got.collect()) == sorted([("a", v) for v in range(45, 50)] + [("b", v) for v in range(3)])


def test_hybrid_rank_tail_overtakes_and_ties_keep_stage_one(spark):
    # 12 docs; rerank scores negative for the top ten, so tail rows (raw score) can pass them
    rows = [("c", i, i, round(1.0 - i * 0.05, 9), -1.0 if i < 10 else 0.0) for i in range(12)]
    df = spark.createDataFrame(rows, "collection string, doc_id long, doc_ord long, score double, rerank double")
    got = {r.doc_id: (r.bi_rank, r.importance_rank) for r in R.hybrid_rank(df).collect()}
    # stage one: by score
    assert [got[i][0] for i in range(12)] == list(range(1, 13))
    # tail rows (ids 10, 11) keep positive raw scores and overtake the blended (negative) top ten
    assert got[10][1] == 1 and got[11][1] == 2
    # within the top ten the blended order follows the score order
    assert [got[i][1] for i in range(10)] == list(range(3, 13))


def test_hybrid_rank_small_collection(spark):
    df = spark.createDataFrame([("c", 1, 1, 0.5, 0.1)], "collection string, doc_id long, doc_ord long, score double, rerank double")
    r = R.hybrid_rank(df).first()
    assert (r.bi_rank, r.importance_rank) == (1, 1)


def test_rank_lookup_default_and_duplicates(spark):
    man = spark.createDataFrame([("c", "a.pdf"), ("c", "b.pdf"), ("c", "a.pdf"), ("c", "z.pdf")], "collection string, filename string")
    ranks = spark.createDataFrame([("c", "a.pdf", 1), ("c", "b.pdf", 2), ("c", "a.pdf", 3)], "collection string, filename string, importance_rank int")
    got = sorted((r.filename, r.importance_rank) for r in R.rank_lookup(man, ranks).collect())
    assert got == [("a.pdf", 3), ("a.pdf", 3), ("b.pdf", 2), ("z.pdf", 5)]


def test_term_freqs_in_row(spark):
    df = spark.createDataFrame([("Alpha beta alpha GAMMA beta alpha xx",), ("",)], "t string")
    got = [sorted((x.term, x.tf) for x in r.f) for r in df.select(S.term_freqs("t").alias("f")).collect()]
    assert got == [[("alpha", 3), ("beta", 2), ("gamma", 1)], []]


def test_tfidf_cosine_hand_computed(spark):
    import math
    docs = spark.createDataFrame([("c", 1, "apple banana"), ("c", 2, "apple cherry cherry")], "collection string, doc_id long, text string")
    q = spark.createDataFrame([("c", "banana cherry")], "collection string, query string")
    got = {r.doc_id: (r.score, r.overlap) for r in S.tfidf_scores(docs, q).collect()}
    idf_a, idf_u = math.log(1 + 2 / 2), math.log(1 + 2 / 1)
    qn = math.sqrt(2) * idf_u
    s1 = idf_u * idf_u / (math.sqrt(idf_a ** 2 + idf_u ** 2) * qn)
    s2 = 2 * idf_u * idf_u / (math.sqrt(idf_a ** 2 + (2 * idf_u) ** 2) * qn)
    assert abs(got[1][0] - s1) < 1e-8 and abs(got[2][0] - s2) < 1e-8
    assert got[1][1] == 0.5 and got[2][1] == 0.5


def test_dense_cosine_and_centroids(spark):
    df = spark.createDataFrame([(0, [1.0, 0.0]), (0, [0.0, 1.0])], "label int, v array<double>")
    c = S.centroids(df, "label", "v").first()["centroid"]
    assert c == [0.5, 0.5]
    r = spark.createDataFrame([([1.0, 0.0], [1.0, 1.0])], "a array<double>, b array<double>").select(S.cosine("a", "b")).first()[0]
    assert abs(r - 1 / 2 ** 0.5) < 1e-12


def test_hybrid_rank_paths_agree(spark):
    import random
    rnd = random.Random(7)
    rows = []
    for g, n in [("hot", 400), ("a", 12), ("b", 3), ("c", 10)]:
        for i in range(n):
            rows.append((g, len(rows), rnd.randint(0, 50), float(rnd.randint(0, 6)) / 7, float(rnd.randint(-3, 3)) / 5))
    df = spark.createDataFrame(rows, "collection string, doc_id long, doc_ord long, score double, rerank double").repartition(5)
    a = {r.doc_id: r.importance_rank for r in R.hybrid_rank(df, with_bi_rank=True).collect()}
    b = {r.doc_id: r.importance_rank for r in R.hybrid_rank(df, with_bi_rank=False).collect()}
    assert a == b and len(a) == len(rows)


def test_salted_idf_join_gives_same_scores(spark):
    from quire.sources import testdata as TD
    sf = "/root/testdata/sf0.001"
    d = TD.docs(spark, sf)
    dt = S.term_counts(d, ["collection", "doc_id"], "text")
    q = TD.jobs(spark, sf).select("collection", F.col("task").alias("query"))
    keys = d.select("collection", "doc_id")
    a = {(r.collection, r.doc_id): (r.score, r.overlap) for r in S.tfidf_from_terms(dt, keys, q).collect()}
    b = {(r.collection, r.doc_id): (r.score, r.overlap) for r in S.tfidf_from_terms(dt, keys, q, salt=7).collect()}
    assert a.keys() == b.keys()
    assert all(abs(a[k][0] - b[k][0]) < 1e-9 and a[k][1] == b[k][1] for k in a)


@pytest.mark.parametrize("n", [9, 10, 11])
def test_rerank_depth_is_min_10_n(spark, n):
    # re-rank scores push every re-ranked row below any raw score, so exactly
    # min(10, n) rows end up last, in stage-1 order
    rows = [("c", i, i, round(0.9 - i * 0.01, 9), -5.0) for i in range(n)]
    df = spark.createDataFrame(rows, "collection string, doc_id long, doc_ord long, score double, rerank double")
    got = {r.doc_id: r.importance_rank for r in R.hybrid_rank(df).collect()}
    top = min(10, n)
    tail = list(range(top, n))
    assert [got[i] for i in tail] == list(range(1, len(tail) + 1))
    assert [got[i] for i in range(top)] == list(range(len(tail) + 1, n + 1))


def test_rank_within_more_partitions_than_rows(spark):
    df = spark.createDataFrame([("g", i, float(i % 3)) for i in range(6)] + [("h", 0, 1.0)], "grp string, id long, s double")
    got = R.rank_within(df, ["grp"], [F.col("s").desc(), F.col("id").asc()], "r", partitions=50)
    w = Window.partitionBy("grp").orderBy(F.col("s").desc(), F.col("id").asc())
    want = df.withColumn("r", F.row_number().over(w))
    assert sorted(map(tuple, got.select("grp", "id", "r").collect())) == sorted(map(tuple, want.select("grp", "id", "r").collect()))


def test_idf_join_is_hashed_where_it_fits(spark, monkeypatch):
    """No side of the join by terms is sorted, unless a partition's idf rows are too many; same scores."""
    monkeypatch.setattr(R, "BROADCAST_MAX_BYTES", -1)
    docs = spark.createDataFrame([(f"c{i % 3}", i, f"alpha beta word{i % 7} word{i % 5} beta") for i in range(60)], "collection string, doc_id long, text string")
    queries = spark.createDataFrame([("c0", "alpha word1"), ("c1", "word2 beta"), ("c3", "none")], "collection string, query string")
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    got = {}
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        for most in (R.HASHED_MAX_ROWS, 0):
            monkeypatch.setattr(R, "HASHED_MAX_ROWS", most)
            s = S.tfidf_scores(docs, queries)
            assert ("ShuffledHashJoin [term" in s._jdf.queryExecution().executedPlan().toString()) == (most > 0)
            got[most] = sorted(map(tuple, s.collect()))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    first, second = got.values()
    assert first == second and len(first) == 60 and any(r[2] > 0 for r in first)
