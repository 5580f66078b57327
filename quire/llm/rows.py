"""In-row helpers as column expressions (no Python on the executors)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from quire.functions.text import let

#: Space and U+0009 to U+000D, the white space between words.
BLANKS = r"[\x20\x09-\x0D]+"


def words(text: Column) -> Column:
    """The words of a text, in order: what stands between blanks."""
    return F.filter(F.split(text, BLANKS), lambda w: w != "")


def runs(ordered: Column) -> Column:
    """Values of a sorted array with their counts: ``array<struct<value, n>>``."""

    def of(s: Column) -> Column:
        at = F.transform(s, lambda v, i: F.struct(v.alias("value"), i.alias("i")))
        firsts = F.filter(at, lambda e, i: (i == 0) | (e["value"] != F.get(s, i - 1)))
        return let(firsts, lambda f: F.transform(f, lambda e, j: F.struct(e["value"].alias("value"), (F.coalesce(F.get(f, j + 1)["i"], F.size(s)) - e["i"]).alias("n"))))

    return let(ordered, of)


def windows_hashed(ws: Column, size: int) -> Column:
    """A 64-bit hash of every window of ``size`` words, by position."""
    n = F.greatest(F.size(ws) - (size - 1), F.lit(0))
    return F.transform(F.slice(ws, 1, n), lambda w, i: F.xxhash64(w, *(F.get(ws, i + j) for j in range(1, size))))


_BLOCK = 256


def _folds_before(values: Column, zero: Column, fold: Callable[[Column, Column], Column]) -> Column:
    start = F.struct(zero.alias("all"), F.array().cast("array<int>").alias("each"))
    return F.aggregate(values, start, lambda a, v: F.struct(fold(a["all"], v).alias("all"), F.concat(a["each"], F.array(a["all"])).alias("each")), lambda a: a["each"])


def folds_before(values: Column, zero: Column, fold: Callable[[Column, Column], Column]) -> Column:
    """For each element of an int array, the fold of those before it (``zero`` for
    the first; ``fold`` is associative): within blocks of elements and over the
    blocks, as appending copies an array."""

    def blocked(v: Column) -> Column:
        blocks = F.transform(F.sequence(F.lit(0), F.greatest((F.size(v) - 1) / _BLOCK, F.lit(0)).cast("int")), lambda b: F.slice(v, b * _BLOCK + 1, F.lit(_BLOCK)))

        def shifted(bs: Column) -> Column:
            ahead = _folds_before(F.transform(bs, lambda b: F.aggregate(b, zero, fold)), zero, fold)
            return F.flatten(F.zip_with(bs, ahead, lambda b, o: F.transform(_folds_before(b, zero, fold), lambda x: fold(x, o))))

        return let(blocks, shifted)

    return let(values, blocked)


def sums_before(values: Column) -> Column:
    """For each element of an int array, the sum of those before it."""
    return folds_before(values, F.lit(0), lambda x, y: x + y)


def most_before(values: Column) -> Column:
    """For each element of an array of ints from 0 on, the largest of those before it (-1 for the first)."""
    return folds_before(values, F.lit(-1), lambda x, y: F.greatest(x, y))


#: Code points of a text's chunk.
_CHUNK = 4096


def chunks(text: Column) -> Column:
    """The text in chunks of 4096 code points, for ``between``."""
    return F.regexp_extract_all(text, F.lit(f"(?s).{{1,{_CHUNK}}}"), F.lit(0))


def between(parts: Column, start: Column, end: Column) -> Column:
    """Code points ``start`` to ``end`` (exclusive) of the text that was cut into
    ``parts`` by ``chunks``, without a pass over what stands before them."""
    first, last = F.floor(start / _CHUNK).cast("int"), F.floor((end - 1) / _CHUNK).cast("int")
    one = F.substring(F.get(parts, first), start % _CHUNK + 1, end - start)
    several = F.concat(
        F.substring(F.get(parts, first), start % _CHUNK + 1, F.lit(_CHUNK)),
        F.array_join(F.slice(parts, first + 2, F.greatest(last - first - 1, F.lit(0))), ""),
        F.substring(F.get(parts, last), F.lit(1), end - last * _CHUNK),
    )
    return F.when(start >= end, "").when(first == last, one).otherwise(several)


def matches(text: Column, pattern: str) -> Column:
    """Leftmost non-overlapping matches of a pattern that never matches the
    empty string: ``array<struct<found, start, end, before, after>>``, positions
    in code points, end exclusive; ``before`` and ``after`` are the text up to
    the neighbouring matches.  (Spark returns matches without positions; the
    texts between them come from a split at the same matches.)"""
    empty = F.array().cast("array<struct<found:string,start:int,end:int,before:string,after:string>>")

    def placed(found: Column) -> Column:
        def between(parts: Column) -> Column:
            sizes = F.zip_with(parts, found, lambda p, m: F.length(p) + F.coalesce(F.length(m), F.lit(0)))
            return let(
                sums_before(sizes),
                lambda at: F.transform(
                    found,
                    lambda m, i: F.struct(
                        m.alias("found"),
                        (F.get(at, i) + F.length(F.get(parts, i))).alias("start"),
                        (F.get(at, i) + F.length(F.get(parts, i)) + F.length(m)).alias("end"),
                        F.get(parts, i).alias("before"),
                        F.get(parts, i + 1).alias("after"),
                    ),
                ),
            )

        return F.when(F.size(found) > 0, let(F.split(text, pattern, -1), between)).otherwise(empty)

    return let(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), placed)
