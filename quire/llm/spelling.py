"""Grouping of spelling variants by pivotal grams.

Two words are near if they differ by exactly one inserted, deleted or replaced
code point.  A word's bigrams are put in a global order, rare ones first.  Its
*prefix* is its three first bigrams, and all others that tie with the third; its
*pivots* are the two disjoint bigrams of the prefix whose counts have the least
sum, found by dynamic programming over their positions.

One edit destroys at most one of two disjoint bigrams, so of two near words the
one whose prefix ends earlier in the order has a pivot that stands in the other
word too, and there it is part of the prefix.  More exactly: an edit that lies
before or in the left pivot leaves the right pivot and all that follows it as it
was, any other edit leaves the left pivot and all before it.  So pivots meet
other words' prefix bigrams under position limits: the left pivot at the same
position from the start behind equal text, the right pivot at the same position
from the end before equal text, in words of one code point more, fewer or none.
The edit is in the rest of the word then, and leaves either the part of the rest
next to the bigram or the part at the word's other end as it was; so either of the
two must be equal as well.  What meets is verified by its edit distance.

Each word gives twelve pivot rows and about as many prefix rows; both are narrow,
and one join on a 64-bit key of (side, length, equal parts) finds the candidates.  A
key collision only adds a candidate.  Both sides are stored tables, so that AQE
splits the partition of a key with very many rows.
"""

from __future__ import annotations

import functools
import math
import zlib

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.session import materialize

#: Words with fewer code points have no two disjoint bigrams.
MIN_CHARS = 4
#: Bigram counts are kept by hash: as many numbers as this, whatever the alphabet.
BUCKETS = 1 << 16
PREFIX = 3


def _bucket_counts(words: DataFrame) -> list[int]:
    """How many bigrams of the words fall into each bucket."""
    starts = F.sequence(F.lit(1), F.length("word") - 1)
    grams = words.where(F.length("word") >= MIN_CHARS).select(F.explode(F.transform(starts, lambda i: F.substring("word", i, F.lit(2)))).alias("gram"))
    counted = grams.groupBy((F.crc32(F.col("gram").cast("binary")) % BUCKETS).cast("int").alias("bucket")).agg(F.count(F.lit(1)).alias("n"))
    counts = [0] * BUCKETS
    for row in counted.collect():  # at most BUCKETS rows
        counts[row.bucket] = row.n
    return counts


def pivots_and_prefix(word: str, order) -> tuple[tuple[int, int], list[int]]:
    """Positions of the two pivots (ascending) and of the prefix bigrams of a
    word of at least four code points; ``order(gram)`` is (count, gram)."""
    ranked = sorted((order(word[p : p + 2]), p) for p in range(len(word) - 1))
    last = ranked[min(PREFIX, len(ranked)) - 1][0]
    prefix = sorted((p, rank[0]) for rank, p in ranked if rank <= last)
    # over positions: the least single one that ends before, and the least pair
    best_pair, best_single, ahead = (math.inf, 0, 0), (math.inf, 0), 0
    for p, cost in prefix:
        while prefix[ahead][0] + 2 <= p:
            best_single = min(best_single, (prefix[ahead][1], prefix[ahead][0]))
            ahead += 1
        best_pair = min(best_pair, (best_single[0] + cost, best_single[1], p))
    return best_pair[1:], [p for p, _ in prefix]


def _keys(word: str, n: int, left: int | None, right: int | None) -> set[int]:
    """Keys of ``word`` with a word of ``n`` code points by what is equal: all up to
    the bigram at ``left`` or from that at ``right``, and one end of the rest.

    Of a rest that has at least twice as many code points as an end in both words,
    one edit cannot reach both ends."""
    parts = []
    if left is not None:
        at = left + 2
        end = max(0, (n - at - 1) // 2)
        parts += [f"<{n}:{word[: at + end]}", f"<{n}:{word[:at]}:{word[len(word) - end :]}"] if end else [f"<{n}:{word[:at]}"]
    if right is not None:
        end = max(0, (right + n - len(word) - 1) // 2)
        parts += [f">{n}:{word[right - end :]}", f">{n}:{word[right:]}:{word[:end]}"] if end else [f">{n}:{word[right:]}"]
    return {xxhash.xxh64_intdigest(p) - (1 << 63) for p in parts}


def _index_rows(batches, counts):
    @functools.lru_cache(maxsize=BUCKETS)
    def order(gram: str):
        return counts.value[zlib.crc32(gram.encode()) % BUCKETS], gram

    for batch in batches:
        rows, pivot, keys = [], [], []
        for i, word in enumerate(batch.column("word").to_pylist()):
            (left, right), prefix = pivots_and_prefix(word, order)
            n = len(word)
            own = [key for d in (-1, 0, 1) for key in _keys(word, n + d, left, right)]
            other = list({key for p in prefix for key in _keys(word, n, p, p)})
            rows += [i] * (len(own) + len(other))
            pivot += [True] * len(own) + [False] * len(other)
            keys += own + other
        yield pa.RecordBatch.from_arrays([*batch.take(pa.array(rows, pa.int64())).columns, pa.array(pivot, pa.bool_()), pa.array(keys, pa.int64())], names=["word", "n", "pivot", "key"])


def near_pairs(words: DataFrame) -> DataFrame:
    """``a, a_n, b, b_n``: every pair of near words of ``words(word, n)``, once, a < b."""
    counts = words.sparkSession.sparkContext.broadcast(_bucket_counts(words))
    long_enough = words.where(F.length("word") >= MIN_CHARS)
    index = materialize(long_enough.mapInArrow(lambda batches: _index_rows(batches, counts), "word string, n bigint, pivot boolean, key bigint"), "grams")
    left = index.where("pivot").select("key", F.col("word").alias("a"), F.col("n").alias("a_n"))
    right = index.where("NOT pivot").select("key", F.col("word").alias("b"), F.col("n").alias("b_n"))
    met = left.join(right, "key").where("a <> b").where(F.levenshtein("a", "b", 1) == 1)
    first = F.col("a") < F.col("b")
    ordered = {"a": F.least("a", "b"), "a_n": F.when(first, F.col("a_n")).otherwise(F.col("b_n")), "b": F.greatest("a", "b"), "b_n": F.when(first, F.col("b_n")).otherwise(F.col("a_n"))}
    return met.select(*(c.alias(name) for name, c in ordered.items())).distinct()


def _roots(forms: DataFrame) -> DataFrame:
    """``word, root``: the last word reached from each word of ``forms(word,
    form)``.  A form occurs several times as often as its word, so paths are
    shorter than the digits of a count; each round doubles the step."""
    paths = materialize(forms.select("word", F.col("form").alias("root")), "forms")
    while True:
        on = paths.select(F.col("word").alias("root"), F.col("root").alias("next"))
        longer = materialize(paths.join(on, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "forms")
        paths = longer.select("word", "root")
        if longer.where("moved").isEmpty():
            return paths


def variants(words: DataFrame, ratio: int = 10) -> DataFrame:
    """``word, n, n_near, form, form_n, root`` for every row of ``words(word
    string, n bigint)``, whose words are distinct.

    ``form`` is the near word of largest n (ties: the smallest in code-point
    order), if that n is at least ``ratio`` (2 or more) times the word's own, else
    null; ``root`` is the last word when forms are followed, the word itself if it
    has none.  Words of fewer than ``MIN_CHARS`` code points take no part and have
    no near words; null words and null counts are left out.  Further columns are
    dropped.  An empty table gives no rows.
    """
    if ratio < 2:
        raise ValueError("forms must be more frequent than their words")
    words = materialize(words.select("word", F.col("n").cast("bigint").alias("n")).where("word IS NOT NULL AND n IS NOT NULL"), "words")
    pairs = materialize(near_pairs(words), "near")
    both = pairs.select(F.col("a").alias("word"), F.col("b").alias("near"), F.col("b_n").alias("near_n")).unionByName(pairs.select(F.col("b").alias("word"), F.col("a").alias("near"), F.col("a_n").alias("near_n")))
    # most frequent first, then in code-point order
    by_word = both.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), F.col("near"))).alias("best"))
    frequent = -F.col("best.less") >= ratio * F.col("n")
    found = words.join(by_word, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0).cast("bigint")).alias("n_near"),
        F.when(frequent, F.col("best.near")).alias("form"), F.when(frequent, -F.col("best.less")).alias("form_n"),
    )
    found = materialize(found, "variants")
    roots = _roots(found.where("form IS NOT NULL"))
    return found.join(roots, "word", "left").withColumn("root", F.coalesce("root", "word"))
