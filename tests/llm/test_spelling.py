import collections
import random
import re
import zlib

import duckdb
import pytest
from pyspark.sql import functions as F

from quire.llm import catalog, spelling
from tests.conftest import SF_SMALL


def one_edit(word):
    """What is left of a word when a code point is deleted, by place."""
    return {(i, word[:i] + word[i + 1 :]) for i in range(len(word))}


def brute(counts, ratio=10, least=spelling.MIN_CHARS):
    """{word: (n, n_near, form, form_n, root)} from {word: n}."""
    by_cut = collections.defaultdict(set)
    for w in counts:
        for cut in one_edit(w):
            by_cut[cut].add(w)
    near = collections.defaultdict(set)
    for w in counts:
        if len(w) < least:
            continue
        for i, c in one_edit(w):
            found = {x for x in by_cut[i, c] if x != w} | ({c} if c in counts and len(c) >= least else set())
            near[w] |= found
            for x in found:
                near[x].add(w)
    form = {}
    for w in counts:
        best = min(near[w], key=lambda x: (-counts[x], x), default=None)
        if best is not None and counts[best] >= ratio * counts[w]:
            form[w] = best
    out = {}
    for w, n in counts.items():
        root = w
        while root in form:
            root = form[root]
        out[w] = (n, len(near[w]), form.get(w), counts[form[w]] if w in form else None, root)
    return out


def found(spark, counts, **kw):
    df = spark.createDataFrame([(w, n, "x", 1) for w, n in counts.items()], "word string, n bigint, key string, pivot int")
    rows = spelling.variants(df, **kw).collect()
    assert len(rows) == len(counts)
    return {r.word: (r.n, r.n_near, r.form, r.form_n, r.root) for r in rows}


def test_query_equals_brute_force(spark):
    counts = collections.Counter()
    for doc_id, text in duckdb.sql(f"select doc_id, text from '{SF_SMALL}/documents.parquet'").fetchall():
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m.group().lower(), run)
            h = zlib.crc32(f"{doc_id}:{run}".encode())
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    want = brute({w: n for w, n in counts.items() if len(w) >= 7 and n >= 2})
    rows = catalog.op12_spelling(spark, SF_SMALL).collect()
    assert {r.word: (r.n, r.n_near, r.form, r.form_n, r.root) for r in rows} == want and len(rows) == len(want)
    assert sum(r.form is not None for r in rows) > 5


@pytest.mark.parametrize("seed", range(4))
def test_dense_words_equal_brute_force(spark, seed):
    """Few letters, so that bigrams repeat, tie and stand at every position."""
    rng = random.Random(seed)
    letters = ["ab", "abc", "aàé日😀", "abcdefgh"][seed]
    words = set()
    while len(words) < 400:
        w = "".join(rng.choice(letters) for _ in range(rng.randrange(2, 9)))
        words.add(w)
        if rng.random() < 0.5 and len(w) > 3:
            i = rng.randrange(len(w))
            words.add(rng.choice([w[:i] + w[i + 1 :], w[:i] + rng.choice(letters) + w[i:], w[:i] + rng.choice(letters) + w[i + 1 :]]))
        if len(words) > 2 ** len(letters) * 60:
            break
    counts = {w: rng.choice([1, 2, 3, 20, 30, 500, 20000]) for w in words}
    assert found(spark, counts) == brute(counts)
    assert found(spark, counts, ratio=2) == brute(counts, ratio=2)


def test_paths_ties_and_rows_left_out(spark):
    counts = {"colour": 5, "colours": 50, "colourse": 500, "colourses": 5000, "alone": 9, "abd": 1, "abde": 90, "kitten": 1, "mitten": 30, "bitten": 30, "": 4, "a" * 5000: 1, "a" * 4999: 10}
    got = found(spark, counts)
    assert got == brute(counts)
    assert got["colour"][4] == "colourses" and got["kitten"][2] == "bitten"
    assert got["abd"][1] == 0  # too short to take part
    df = spark.createDataFrame([(None, 3), ("alone", None), ("words", 1)], "word string, n bigint")
    assert [r.word for r in spelling.variants(df).collect()] == ["words"]
    assert spelling.variants(df.limit(0)).count() == 0
    with pytest.raises(ValueError):
        spelling.variants(df, ratio=1)


def test_words_of_null_empty_and_long_texts(spark):
    df = spark.createDataFrame([(1, None), (None, "Ähnliche ähnliche ÄHNLICHE ähnliche"), (2, ""), (3, "word " * 9 + "longword " * 30000), (3, "x" * 300000)], "doc_id bigint, text string").withColumn("word", F.lit("z")).withColumn("n", F.lit(1))
    got = {r.word: r.n for r in catalog._misspelt_words(df).collect()}
    assert got == {"longword": 30000, "ähnliche": 2, "Ähnliche": 2}  # only A-Z are lower-cased


def test_pivots_are_disjoint_and_least(spark):
    counts = {"ab": 5, "bc": 1, "cd": 1, "de": 3, "ef": 9}
    order = lambda g: (counts[g], g)
    # the three rarest are bc, cd, de; bc and cd overlap
    assert spelling.pivots_and_prefix("abcdef", order) == ((1, 3), [1, 2, 3])
