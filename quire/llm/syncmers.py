"""Document fingerprints from closed syncmers (DataFrame functions only).

A text is a sequence of words.  A k-mer of ``K`` words is a closed syncmer if
the smallest of the hashes of its inner s-mers (``S`` words; of equal ones the
first) stands at its first or last position.  Whether a k-mer is chosen depends
on its own words only, so an unchanged passage gives the same anchors wherever
it stands; of 2 in K - S + 1 k-mers one is chosen, and every window of
K - S + 1 of them has one.  A text with fewer words than ``K`` has itself as its
only anchor, one without words has none.  A text of ``K`` to 2 K - S - 1 words can
be without a closed syncmer; in a fingerprint it has itself as its only anchor too.

Anchors are (position, 64-bit hash) in text order; the likeness of two texts is
the share of anchor hashes that they have in common (Dice): 1 for equal sets, 0
for none in common, and by definition 1 for two texts without words.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quire.functions.text import let
from quire.llm import rows
from quire.llm.numbering import numbered
from quire.session import materialize

K = 10
S = 2
#: So many neighbours by position are sent to one place.
BLOCK = 32


def anchors(text: Column, k: int = K, s: int = S, always: bool = False) -> Column:
    """``array<struct<position, hash>>`` of the closed syncmers of a text;
    null text has none.  Positions count words from 0.  With ``always``, a text
    with words but without a closed syncmer has itself as its only anchor."""
    inner = k - s + 1

    def of(ws: Column) -> Column:
        hashed = F.transform(ws, lambda w: F.xxhash64(w))

        def chosen(h: Column) -> Column:
            n = F.size(h)
            smers = F.transform(F.slice(h, 1, F.greatest(n - (s - 1), F.lit(0))), lambda x, i: F.xxhash64(x, *(F.get(h, i + j) for j in range(1, s))))

            def edges(m: Column) -> Column:
                least = lambda i: let(F.slice(m, i + 1, F.lit(inner)), lambda w: F.array_position(w, F.array_min(w)))
                starts = F.filter(F.sequence(F.lit(0), n - k), lambda i: least(i).isin(1, inner))
                return F.transform(starts, lambda i: F.struct(i.cast("int").alias("position"), F.xxhash64(F.slice(h, i + 1, F.lit(k))).alias("hash")))

            whole = F.array(F.struct(F.lit(0).alias("position"), F.xxhash64(h).alias("hash")))
            none = F.array().cast("array<struct<position:int,hash:bigint>>")
            closed = let(smers, edges)
            if always:
                closed = let(closed, lambda found: F.when(F.size(found) > 0, found).otherwise(whole))
            return F.when(n >= k, closed).when(n > 0, whole).otherwise(none)

        return let(hashed, chosen)

    return let(rows.words(F.coalesce(text, F.lit(""))), of)


def hashes(found: Column) -> Column:
    """The distinct hashes of anchors, in order of first position."""
    return F.array_distinct(F.transform(found, lambda a: a["hash"]))


def fingerprint(text: Column, k: int = K, s: int = S) -> Column:
    """The distinct hashes of a text's anchors; empty only without words."""
    return hashes(anchors(text, k, s, always=True))


def likeness(a: Column, b: Column) -> Column:
    """Dice coefficient of two arrays of distinct hashes."""
    both = F.size(a) + F.size(b)
    return F.when(both > 0, 2.0 * F.size(F.array_intersect(a, b)) / both).otherwise(1.0)


def printed(found: Column) -> Column:
    """A fingerprint as text: 16 hex digits of each distinct hash, in order."""
    return F.array_join(F.transform(found, lambda h: F.lower(F.lpad(F.hex(h), 16, "0"))), "")


def against_next(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = K, s: int = S) -> DataFrame:
    """Each document beside its edited text and the next document.

    ``id, n_chars, own, next`` (hashes of its anchors and of the next document's)
    ``, edited`` (the text with its last floor(n_chars / 2) code points replaced
    by the next document's first as many, or all it has) and ``edited_own``.
    The next document is the one with the next greater id (the first after the
    last).  Null ids come first, and rows with equal ids are ordered by a hash
    of their text; repeated rows follow each other.  Null text counts as empty.
    An only row is its own next; an empty table gives no rows.

    Rows are numbered by id without their texts; a document's text is joined to
    its number and sent to the block of ``BLOCK`` numbers that it is in, the first
    of a block also to the block before.  Anchors are found where the texts
    arrive, so none are sent.
    """
    held = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    # a row's key; rows that are equal in it are equal
    keyed = held.select(F.col("id").isNotNull().alias("named"), F.coalesce("id", F.lit(0)).alias("key"), F.xxhash64("text").alias("tie"), "id", "text")
    names = ["named", "key", "tie"]
    keys = keyed.groupBy(*names).agg(F.count(F.lit(1)).alias("copies"))
    placed = materialize(numbered(keys, names, "at"), "positions")
    total, most = placed.agg(F.count(F.lit(1)), F.max("copies")).first()
    if not total:
        total = 1

    texts = keyed.join(placed.where("copies = 1"), names)
    if most and most > 1:
        texts = texts.unionByName(keyed.join(placed.where("copies > 1"), names).dropDuplicates(["at"]))
    block_of = lambda at: F.floor(at / BLOCK).cast("bigint")
    # the first of a block also ends the block before (row 0: the last block)
    end = F.when(F.col("at") == 0, F.lit(total)).otherwise(F.col("at"))
    here = F.struct(block_of(F.col("at")).alias("block"), F.col("at").alias("place"), F.lit(False).alias("ends"))
    before = F.struct(block_of(end - 1).alias("block"), end.alias("place"), F.lit(True).alias("ends"))
    places = F.when(F.col("at") % BLOCK == 0, F.array(here, before)).otherwise(F.array(here))
    sent = texts.select("id", "copies", "text", F.explode(places).alias("p")).select("p.*", "id", "copies", "text").repartition("block")
    found = sent.withColumn("own", fingerprint(F.col("text"), k, s))
    following = Window.partitionBy("block").orderBy("place")
    met = found.withColumns({"ahead_text": F.lead("text").over(following), "ahead_own": F.lead("own").over(following)}).where("NOT ends")

    # each of several equal rows but the last is followed by its equal
    some = 1 << 12
    rest = F.least(F.col("copies") - F.col("b") * some, F.lit(some))
    each = met.select("*", F.explode(F.sequence(F.lit(0), ((F.col("copies") - 1) / some).cast("int"))).alias("b"))
    each = each.select("*", F.explode(F.sequence(F.lit(1), rest.cast("int"))).alias("i"))
    last = F.col("b") * some + F.col("i") == F.col("copies")
    n_chars = F.length("text")
    half = F.floor(n_chars / 2).cast("int")
    out = each.select(
        "id",
        n_chars.cast("bigint").alias("n_chars"),
        "own",
        F.when(last, F.col("ahead_own")).otherwise(F.col("own")).alias("next"),
        F.concat(F.left("text", n_chars - half), F.left(F.when(last, F.col("ahead_text")).otherwise(F.col("text")), half)).alias("edited"),
    )
    return out.select("*", fingerprint(F.col("edited"), k, s).alias("edited_own"))
