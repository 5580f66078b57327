"""Quality rules by distribution divergence (DataFrame functions only).

A document's histogram of character classes and its histogram of common words
are compared to those of language references by Jensen-Shannon distance (the
root of the divergence to base 2, 0 to 1).  References are counted over the
whole table, one per value of the language column: the shares of the classes
among all characters, and the shares of the ``COMMON_WORDS`` most frequent words
(ties by word) and of all others among all words.  A document is held against
every reference and the nearest counts, so a wrong or missing language is no
fault of the text.  Minimum-length guards: a histogram is judged only with
enough words or characters to be one; the rest is kept.

Base rules (too few words, too many words in repeated 3-word windows) reject
besides.  Windows are compared by a 64-bit hash within one document.

What the driver collects is bounded by ``LANGUAGES`` x (``COMMON_WORDS`` +
classes), whatever the input.  With more languages than ``LANGUAGES`` the
references stay a table, against which documents are judged in blocks of
``REFERENCES`` languages; the least distance over all blocks counts.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.functions.text import let
from quire.llm import rows
from quire.llm.numbering import numbered
from quire.operators.ranking import top_k
from quire.session import materialize

MIN_WORDS = 50
MAX_REPEATED = 50  # percent of the words
SYMBOLS = r"[#*$%&|<>]"
WINDOW = 3

COMMON_WORDS = 64
#: Up to so many languages references are literals in the plan.
LANGUAGES = 32
#: So many references are broadcast at once beyond that.
REFERENCES = 128
MIN_CHARS = 200
MAX_CLASS_DISTANCE = 0.28
MAX_WORD_DISTANCE = 0.45

#: Characters that are not in the class; what is in none of them is the last
#: class.  None of them has a-z, so they are counted in texts without these.
CLASSES = {
    "upper": r"[^A-Z]+",
    "digit": r"[^0-9]+",
    "blank": r"[^\x20\x09-\x0D]+",
    "stop": r"[^.,;:!?'\"()-]+",
    "symbol": r"[^#*$%&|<>=+/\\_@^~`{}\[\]]+",
    "wide": r"[\x00-\x7F]+",
}


def _repeat_words(hashes: Column) -> Column:
    """Words in windows whose hash occurs twice or more: a window covers
    ``WINDOW`` words, or those up to the next such window."""

    def covered(s: Column) -> Column:
        twice = F.filter(s, lambda e, i: (e["h"] == F.get(s, i - 1)["h"]) | (e["h"] == F.get(s, i + 1)["h"]))
        at = F.array_sort(F.transform(twice, lambda e: e["i"]))
        return let(at, lambda p: F.aggregate(F.transform(p, lambda a, j: F.least(F.lit(WINDOW), F.coalesce(F.get(p, j + 1) - a, F.lit(WINDOW)))), F.lit(0), lambda x, y: x + y))

    ordered = F.array_sort(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    # a missing neighbour equals nothing
    return F.when(F.size(F.array_distinct(hashes)) < F.size(hashes), let(ordered, covered)).otherwise(0)


def languages(docs: DataFrame, lang: Column) -> list[str] | None:
    """The languages in order of name; None if they are more than ``LANGUAGES``."""
    held = docs.select(lang.cast("string").alias("lang")).where("lang IS NOT NULL")
    found = [r.lang for r in held.distinct().orderBy("lang").limit(LANGUAGES + 1).collect()]
    return found if len(found) <= LANGUAGES else None


def _top_words(held: DataFrame) -> DataFrame:
    """``lang, word, n``: the most frequent words of ``held(lang, word)`` by language,
    each as its 64-bit hash: a word may be as long as a text."""
    counts = held.groupBy("lang", "word").agg(F.count(F.lit(1)).alias("n"))
    top = top_k(counts, ["lang"], [F.col("n").desc(), F.col("word")], COMMON_WORDS)
    return top.select("lang", F.xxhash64("word").alias("word"), "n")


def common_words(docs: DataFrame, text: Column, lang: Column, names: list[str]) -> dict[str, dict[int, int]]:
    """By language, the hashes of its ``COMMON_WORDS`` most frequent words with
    their counts: three numbers a word, whatever the words."""
    held = docs.select(lang.cast("string").alias("lang"), F.explode(rows.words(text)).alias("word")).where(F.col("lang").isin(names))
    found: dict[str, dict[int, int]] = {n: {} for n in names}
    for r in _top_words(held).collect():
        found[r.lang][r.word] = r.n
    return found


def reference_blocks(docs: DataFrame, text: Column, lang: Column, found: DataFrame) -> DataFrame:
    """``block`` (0, 1, ...), ``refs`` (the references of at most ``REFERENCES``
    languages) and ``known`` (their common words), a row a block."""
    own = found.where("row._lang IS NOT NULL").groupBy(F.col("row._lang").alias("lang"))
    n_chars = F.sum("n_chars")
    shares = F.array(*(F.sum(F.col("classes")[i]) / n_chars for i in range(len(CLASSES) + 1)))
    # a language without words has no characters that count
    sums = materialize(own.agg(F.sum("n_words").alias("total"), F.when(n_chars > 0, shares).alias("classes")).where("total > 0"), "languages")
    words = docs.select(lang.cast("string").alias("lang"), F.explode(rows.words(text)).alias("word")).where("lang IS NOT NULL")
    shared = _top_words(words).join(sums, "lang").select("lang", "classes", F.struct("word", (F.col("n") / F.col("total")).alias("q")).alias("share"))
    listed = F.map_from_entries(F.sort_array(F.collect_list("share")))
    refs = numbered(materialize(shared.groupBy("lang").agg(F.first("classes").alias("classes"), listed.alias("words")), "references"), ["lang"], "at")
    refs = refs.withColumn("listed", F.aggregate(F.map_values("words"), F.lit(0.0), lambda a, q: a + q))
    blocks = refs.groupBy(F.floor(F.col("at") / REFERENCES).alias("block")).agg(F.collect_list(F.struct("classes", "words", "listed")).alias("refs"))
    known = F.array_distinct(F.flatten(F.transform("refs", lambda r: F.map_keys(r["words"]))))
    return materialize(blocks.withColumn("known", known), "blocks")


def features(docs: DataFrame, text: Column, keep: dict[str, Column], common: set[int] | None) -> DataFrame:
    """``row`` (a struct of ``keep``) and, for each row, the base features, the
    counts of the classes and those of the ``common`` words it has, by their hashes
    (of all its words for None) (null: empty text)."""
    held = docs.select(F.struct(*(c.alias(n) for n, c in keep.items())).alias("row"), F.coalesce(text, F.lit("")).alias("text"))
    cut = held.select("*", rows.words(F.col("text")).alias("words"), F.regexp_replace("text", "[a-z]+", "").alias("others"))
    counted = cut.select(
        "*",
        rows.windows_hashed(F.col("words"), WINDOW).alias("hashes"),
        F.filter(F.split("text", "\n", -1), lambda line: line.rlike(r"[^\x20\x09-\x0D]")).alias("lines"),
        F.length("text").alias("n_chars"),
        *(F.length(F.regexp_replace("others", rest, "")).alias(f"n_{c}") for c, rest in CLASSES.items()),
    )
    hashed = F.transform("words", lambda w: F.xxhash64(w))
    wanted = [F.lit(w).cast("bigint") for w in sorted(common or ())]
    known = hashed if common is None else F.filter(hashed, lambda w: w.isin(*wanted)) if common else F.array().cast("array<bigint>")
    return counted.select(
        "row",
        F.size("words").cast("bigint").alias("n_words"),
        (F.col("n_chars") - F.col("n_blank")).cast("bigint").alias("word_chars"),
        (F.size(F.split("text", SYMBOLS, -1)) - 1).cast("bigint").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("bigint").alias("n_dup_lines"),
        _repeat_words(F.col("hashes")).cast("bigint").alias("n_repeat_words"),
        F.col("n_chars").cast("bigint").alias("n_chars"),
        F.array(*(F.col(f"n_{c}") for c in CLASSES), F.col("n_chars") - sum(F.col(f"n_{c}") for c in CLASSES)).alias("classes"),
        rows.runs(F.array_sort(known)).alias("common"),
    )


def _divergence(p: Column, q: Column | float) -> Column:
    """What one class adds to the Jensen-Shannon divergence of shares p and q."""
    q = q if isinstance(q, Column) else F.lit(float(q))
    part = lambda x: F.when(x > 0, x * F.log2(2 * x / (p + q))).otherwise(0.0)
    return (part(p) + part(q)) / 2


def class_distance(classes: Column, n_chars: Column, shares: list[float] | list[Column]) -> Column:
    total = reduce(lambda x, y: x + y, (_divergence(classes[i] / n_chars, q) for i, q in enumerate(shares)))
    return F.sqrt(F.greatest(total, F.lit(0.0)))


def word_distance(common: Column, n_words: Column, shares: dict[int, float]) -> Column:
    """Common words that the document lacks add half their share."""
    share = F.create_map(*(x for w, q in shares.items() for x in (F.lit(w).cast("bigint"), F.lit(q))))
    return _word_distance(common, n_words, share, F.lit(float(sum(shares.values()))))


def _word_distance(common: Column, n_words: Column, share: Column, listed: Column) -> Column:
    own = let(share, lambda m: F.filter(F.transform(common, lambda c: F.struct((c["n"] / n_words).alias("p"), F.element_at(m, c["value"]).alias("q"))), lambda c: c["q"].isNotNull()))
    zero = F.struct(F.lit(0.0).alias("d"), F.lit(0.0).alias("p"), F.lit(0.0).alias("q"))
    sums = F.aggregate(own, zero, lambda a, c: F.struct((a["d"] + _divergence(c["p"], c["q"])).alias("d"), (a["p"] + c["p"]).alias("p"), (a["q"] + c["q"]).alias("q")))
    rest = lambda a: _divergence(F.greatest(1 - a["p"], F.lit(0.0)), F.greatest(1 - listed, F.lit(0.0)))
    return F.sqrt(F.greatest(let(sums, lambda a: a["d"] + (listed - a["q"]) / 2 + rest(a)), F.lit(0.0)))


def judge(docs: DataFrame, text: Column, lang: Column, keep: dict[str, Column]) -> DataFrame:
    """One row per row of ``docs``: the columns of ``keep``, ``n_words``,
    ``word_chars``, ``n_symbols``, ``n_dup_lines``, ``n_repeat_words`` (bigint),
    ``base_failed``, ``class_distance``, ``word_distance`` (to the nearest
    reference; null without one or under the minimum lengths), ``kept``.

    Null text counts as empty and fails the base rules, as does any text with
    fewer than ``MIN_WORDS`` words.  Equal rows get equal results.  A table
    without any language has no reference, and base rules alone decide.  An
    empty table gives no rows.  ``keep`` must not use the names above.
    """
    names = languages(docs, lang)
    common = common_words(docs, text, lang, names) if names else {}
    found = features(docs, text, {**keep, "_lang": lang.cast("string")}, None if names is None else {w for own in common.values() for w in own})
    found = materialize(found, "quality")
    if names is None:
        by_class, by_word = [], []
        blocks = reference_blocks(docs, text, lang, found)
        for b in range(blocks.count()):
            found = found.crossJoin(F.broadcast(blocks.where(F.col("block") == b).select(F.col("refs").alias(f"_refs{b}"), F.col("known").alias(f"_known{b}"))))
            by_class.append(_nearest_class(F.col(f"_refs{b}")))
            by_word.append(_nearest_words(F.col(f"_refs{b}"), F.col(f"_known{b}")))
        return _verdicts(found, by_class, by_word, keep)
    sums = {r["_lang"]: r for r in found.where(F.col("row._lang").isin(names)).groupBy("row._lang").agg(F.sum("n_words").alias("n_words"), F.sum("n_chars").alias("n_chars"), *(F.sum(F.col("classes")[i]).alias(f"c{i}") for i in range(len(CLASSES) + 1))).collect()} if names else {}
    refs = [n for n in names if n in sums and sums[n].n_words]
    by_class = [class_distance(F.col("classes"), F.col("n_chars"), [sums[n][f"c{i}"] / sums[n].n_chars for i in range(len(CLASSES) + 1)]) for n in refs]
    by_word = [word_distance(F.col("common"), F.col("n_words"), {w: c / sums[n].n_words for w, c in common[n].items()}) for n in refs]
    return _verdicts(found, by_class, by_word, keep)


def _nearest_class(refs: Column) -> Column:
    shares = lambda r: [r["classes"][i] for i in range(len(CLASSES) + 1)]
    return F.array_min(F.transform(refs, lambda r: class_distance(F.col("classes"), F.col("n_chars"), shares(r))))


def _nearest_words(refs: Column, known: Column) -> Column:
    """Only words that a reference of the block lists are looked up in it."""
    met = F.array_intersect(F.transform("common", lambda c: c["value"]), known)
    own = let(met, lambda m: F.filter("common", lambda c: F.array_contains(m, c["value"])))
    return let(own, lambda c: F.array_min(F.transform(refs, lambda r: _word_distance(c, F.col("n_words"), r["words"], r["listed"]))))


def _verdicts(found: DataFrame, by_class: list[Column], by_word: list[Column], keep: dict[str, Column]) -> DataFrame:
    nearest = lambda found: F.least(*found) if len(found) > 1 else found[0] if found else F.lit(None).cast("double")
    enough = F.col("n_words") >= MIN_WORDS
    judged = found.select(
        "row",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        (~enough | (100 * F.col("n_repeat_words") > MAX_REPEATED * F.col("n_words"))).alias("base_failed"),
        F.when(enough & (F.col("n_chars") >= MIN_CHARS), nearest(by_class)).alias("class_distance"),
        F.when(enough, nearest(by_word)).alias("word_distance"),
    )
    far = F.coalesce(F.col("class_distance") > MAX_CLASS_DISTANCE, F.lit(False)) | F.coalesce(F.col("word_distance") > MAX_WORD_DISTANCE, F.lit(False))
    judged = judged.withColumn("kept", ~F.col("base_failed") & ~far)
    return judged.select(*(F.col("row")[n].alias(n) for n in keep), *(c for c in judged.columns if c != "row"))


def good_documents(docs: DataFrame, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """The rows of ``docs`` that ``judge`` keeps, all columns as they are."""
    held = {f"_c{i}": F.col(c) for i, c in enumerate(docs.columns)}
    judged = judge(docs, F.col(text_col), F.col(lang_col), held)
    return judged.where("kept").select(*(F.col(k).alias(c) for k, c in zip(held, docs.columns)))
