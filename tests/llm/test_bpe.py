import base64
import hashlib
import random

import duckdb
import numpy as np
import public_tokenizers
import tiktoken
from pyspark.sql import functions as F

from quire.llm import bpe, catalog
from tests.conftest import SF_SMALL

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def encoding():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_query_equals_tiktoken(spark):
    enc = encoding()
    texts = duckdb.sql(f"select doc_id, text from '{SF_SMALL}/documents.parquet'").fetchall()
    sha = lambda b: hashlib.sha256(b).hexdigest()
    want = []
    for d, t in texts:
        ids = enc.encode_ordinary(t)
        want.append((d, len(ids), sha(np.array(ids, "<u4").tobytes()), sha(t.encode())))
    assert sorted(map(tuple, catalog.op8_byte_bpe(spark, SF_SMALL).collect())) == sorted(want)


def test_one_exchange_feeds_both_branches(spark):
    df = spark.createDataFrame([(1, "a b c")], "id bigint, text string")
    out = bpe.encode(df, "text", RANKS, public_tokenizers.PATTERN)
    out.collect()
    assert "ReusedExchange" in out._jdf.queryExecution().executedPlan().toString()


def test_odd_texts_and_rows(spark, monkeypatch):
    rng = random.Random(6)
    odd = "aB1' \t\n\r ́ßİ ​日한😀é\x1c\x85\x00.,#<|>d'sT "
    texts = ["".join(rng.choice(odd) for _ in range(rng.randrange(80))) for _ in range(400)]
    texts += [None, "", " ", "\n\n  ", "tok " * 50000, "x" * 20000, "\x00\x00", "same", "same"]
    rows = [(i if i % 5 else None, t, "k", b"z") for i, t in enumerate(texts)] + [(7, "same", "k", b"z")] * 2
    df = spark.createDataFrame(rows, "key bigint, text string, ids string, a binary")
    out = bpe.encode(df, "text", RANKS, public_tokenizers.PATTERN)
    assert out.columns == ["key", "a", "ids"]
    got = out.withColumn("bytes", bpe.decode(F.col("ids"), spark, RANKS)).collect()
    enc = encoding()
    want = sorted((str(k), np.array(enc.encode_ordinary(t or ""), "<u4").tobytes(), (t or "").encode()) for k, t, _, _ in rows)
    assert sorted((str(r.key), bytes(r.ids), bytes(r.bytes)) for r in got) == want
    assert bpe.encode(df.limit(0), "text", RANKS, public_tokenizers.PATTERN).count() == 0
    assert bpe.encode(df.select("text").limit(3), "text", RANKS, public_tokenizers.PATTERN).count() == 3


def test_numbers_are_kept():
    x = np.array([0, 1, 70000, (1 << 32) - 1], "<u4")
    assert bpe._expand(bpe._squeeze(x)).tolist() == x.tolist() and bpe._expand(bpe._squeeze(x[:0])).tolist() == []
