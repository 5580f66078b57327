import random
import re
from collections import Counter

import duckdb
from pyspark.sql import functions as F

from quire.llm import catalog, quality
from tests.conftest import SF_SMALL
from tests.llm import brute


def base(text):
    w = brute.words(text)
    wins = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
    n = Counter(wins)
    covered = {i + j for i, x in enumerate(wins) if n[x] > 1 for j in range(3)}
    lines = [x for x in (text or "").split("\n") if brute.words(x)]
    failed = len(w) < 50 or 100 * len(covered) > 50 * len(w)
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(covered), failed


def test_query_equals_duckdb_and_brute_force(spark):
    duckdb.sql(f"create or replace view documents as select * from '{SF_SMALL}/documents.parquet'")
    out = catalog.op6_quality(spark, SF_SMALL)
    got = sorted(map(tuple, out.collect()))
    assert got == sorted(duckdb.sql(catalog.ORACLE_QUALITY).fetchall())
    texts = dict(duckdb.sql("select doc_id, text from documents").fetchall())
    assert all(r[1:7] == base(texts[r[0]]) for r in got)
    assert sum(r[-1] for r in got) > 100


def test_labelled_documents(spark):
    """Nearly all documents labelled good stay, most of the bad ones go."""
    sf = "/root/testdata/sf0.01"
    kept = {r.doc_id for r in catalog.op6_quality(spark, sf).where("kept").collect()}
    labels = duckdb.sql(f"select l.doc_id, quality from '{sf}/labels.parquet' l join '{sf}/documents.parquet' d using (doc_id) where len(string_split(trim(text), ' ')) >= 60").fetchall()
    good = [d in kept for d, q in labels if q == 1]
    bad = [d in kept for d, q in labels if q == 0]
    assert sum(good) / len(good) > 0.99 and sum(bad) / len(bad) < 0.05


def test_edge_rows(spark):
    prose = " ".join(f"the word{i % 40} of line{i}" for i in range(60))
    rep = "a b c " * 40
    rows = [(1, None, None), (2, "", "en"), (3, " \n\t\n ", "en"), (4, prose, "en"), (4, prose, "en"), (None, rep, "xx"), (6, "ä ö\x0bü x <|> a a a a b a a a\nq\n\nq\nq ", None), (7, "x" * 5000, "en"), (8, " ".join(["z"] * 70), "en"), (9, "# " * 300, None)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string").withColumn("words", F.lit("clash"))
    out = quality.judge(df, F.col("text"), F.col("lang"), {"id": F.col("doc_id"), "words": F.col("words")}).collect()
    want = sorted((str(d), *base(t)) for d, t, _ in rows)
    assert sorted((str(r.id), r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in out) == want
    assert all(not r.kept for r in out if r.base_failed)
    none = quality.judge(df.withColumn("lang", F.lit(None)), F.col("text"), F.col("lang"), {"id": F.col("doc_id")})
    assert all(r.kept != r.base_failed and r.word_distance is None for r in none.collect())
    assert quality.judge(df.limit(0), F.col("text"), F.col("lang"), {"id": F.col("doc_id")}).count() == 0
    kept = quality.good_documents(df)
    assert kept.columns == df.columns and [r.doc_id for r in kept.collect()] == [4, 4]


def test_more_languages_than_literals(spark):
    """Clean documents of every language stay, however many there are."""
    rng = random.Random(18)
    rows = []
    for i in range(quality.LANGUAGES + 8):
        own = ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(6)) for _ in range(60)]
        rows += [(f"l{i}", " ".join(rng.sample(own, 60))) for _ in range(2)]
    df = spark.createDataFrame(rows, "lang string, text string").withColumn("doc_id", F.monotonically_increasing_id())
    assert quality.good_documents(df).count() == len(rows)


def test_blocks_equal_literals(spark, monkeypatch):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    judged = lambda: quality.judge(docs, F.col("text"), F.col("lang"), {"doc_id": F.col("doc_id")}).orderBy("doc_id").collect()
    want = judged()
    monkeypatch.setattr(quality, "LANGUAGES", 1)
    monkeypatch.setattr(quality, "REFERENCES", 3)
    got = judged()
    near = lambda x, y: x == y if x is None or y is None else abs(x - y) < 1e-9
    assert len(got) == len(want) > 100
    for g, w in zip(got, want):
        assert near(g.class_distance, w.class_distance) and near(g.word_distance, w.word_distance)
        assert (g.doc_id, g.n_words, g.base_failed, g.kept) == (w.doc_id, w.n_words, w.base_failed, w.kept)
