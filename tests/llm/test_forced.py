import hashlib
import random

import duckdb
import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from quire.llm import catalog, forced
from tests.conftest import SF_SMALL

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    t = Tokenizer.from_file(PATH)
    t.no_truncation()
    t.no_padding()
    return t


@pytest.fixture(scope="module")
def bpe():
    return forced.ForcedBpe(open(PATH).read())


def sha(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


def test_query_equals_the_library(spark, library):
    want = []
    for doc_id, text in duckdb.sql(f"select doc_id, text from '{SF_SMALL}/documents.parquet'").fetchall():
        ids = library.encode(text or "", add_special_tokens=False).ids
        want.append((doc_id, len(ids), sha(np.array(ids, "<u4").tobytes()), sha(library.decode(ids, skip_special_tokens=False).encode())))
    assert sorted(map(tuple, catalog.op11_forced_bpe(spark, SF_SMALL).collect())) == sorted(want)


ODD = [*"aB1'é \t\n\r ́ßİ ​日한😀\x1c\x85\x00.,#<|>d'sTǅﬁΣσςẞͅẛ̣ᾳΐ", "<|endoftext|>", "<|startoftext|>", "<|ENDOFTEXT|>", "</w>", "'ll", "'S", " ", "﻿", "　", "ä", "￿", "", "\U0010ffff"]


def odd_texts():
    rng = random.Random(11)
    texts = ["".join(rng.choice(ODD) for _ in range(rng.randrange(70))) for _ in range(1500)]
    letters = "abcdefghijklmnopqrstuvwxyz"
    long = ["a" * 9000, "ab" * 9000, "".join(rng.choice(letters) for _ in range(40000)), "日本" * 3000, "tok " * 50000, "".join(rng.choice(letters + "ABC0123456789+/") for _ in range(40000))]
    return [None, "", " ", "\n\n  ", "\x00\x00", "same", "same", *texts, *long]


def test_odd_texts_equal_the_library(spark, library, monkeypatch):
    rows = [(i if i % 5 else None, t, "k", b"z") for i, t in enumerate(odd_texts())] + [(7, "same", "k", b"z")] * 2
    df = spark.createDataFrame(rows, "key bigint, text string, ids string, a binary")
    out = forced.encode(df, "text", PATH, decoded=True)
    assert out.columns == ["key", "a", "ids", "decoded"]
    got = out.withColumn("again", forced.decode(F.col("ids"), spark, PATH)).collect()
    assert all(r.again == r.decoded and bytes(r.a) == b"z" for r in got)
    want = []
    for key, text, _, _ in rows:
        ids = library.encode(text or "", add_special_tokens=False).ids
        want.append((str(key), np.array(ids, "<u4").tobytes(), library.decode(ids, skip_special_tokens=False)))
    assert sorted((str(r.key), bytes(r.ids), r.decoded) for r in got) == sorted(want)
    assert forced.encode(df.limit(0), "text", PATH).count() == 0
    assert forced.encode(df.select("text").limit(3), "text", PATH).columns == ["ids"]
    assert spark.createDataFrame([(None,)], "x binary").select(forced.decode(F.col("x"), spark, PATH)).first()[0] is None
    assert "Exchange" not in out._jdf.queryExecution().executedPlan().toString()


def test_small_memory_and_pieces_of_long_texts(bpe, library, monkeypatch):
    """Words and fragments are forgotten all the time, texts are cut into pieces."""
    monkeypatch.setattr(forced, "WORDS", 5)
    monkeypatch.setattr(forced, "FRAGMENTS", 5)
    monkeypatch.setattr(forced, "LONG_TEXT", 16)
    monkeypatch.setattr(forced, "TOGETHER", 3)
    texts = [t or "" for t in odd_texts()[:400]]
    for text in texts:
        assert bpe.encode([text])[0].tolist() == library.encode(text, add_special_tokens=False).ids
    assert [x.tolist() for x in bpe.encode(texts)] == [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]


def test_no_token_stands_across_a_cut(bpe, library):
    """Every token of the file is one fragment; merges of both kinds agree."""
    vocabulary = library.get_vocab()
    for token in random.Random(1).sample(sorted(vocabulary), 3000):
        if token.endswith("</w>") and len(token) > 4:
            inner = [bpe.symbol_of[ord(c)] for c in token[:-4]]
            inner[-1] += 256
            assert bpe.inside[inner[:-1], inner[1:]].all(), token
    flat, symbols, stops, n = bpe.fragments_of(["hello", "", "qxzvkq", "a1b", "x<|endoftext|>y"])
    assert int(n.sum()) == len(stops) and n[1] == 0 and n[0] == 1 and n[3] == 3 and n[4] == 3
    assert n[2] > 1  # pairs that no token has


def test_merges_short_and_long_agree(bpe):
    rng = random.Random(2)
    for _ in range(300):
        ids = bpe.base[[rng.choice([97, 98, 101, 110, 116, 104]) for _ in range(rng.randrange(1, 45))]].tolist()
        assert bpe._merged(list(ids)) == bpe._merged_long(list(ids))


def test_other_files_are_refused():
    with pytest.raises(ValueError, match="word ends"):
        forced.ForcedBpe(open(public_tokenizers.path("byte_bpe_50k.json")).read())
