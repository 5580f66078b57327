"""Pages, lines, headings and section pages.

A document row carries its pages as ``array<struct<page_number, page_seq,
text>>`` built in-row from the text, so per-document work (first pages,
headings, title search) runs inside one task without any shuffle.  Tables of
pages or lines are produced by exploding that column only where a per-page
result is needed.

* ``page_number``: 1-based position of the page in the document, blank pages
  included (numbers may have gaps).
* ``page_seq``: 1-based position among the non-blank pages; "first five pages"
  always means ``page_seq <= 5``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.functions import text as T

PAGE_TYPE = "array<struct<page_number:int,page_seq:int,text:string>>"


def page_array(text_col, lines_per_page: int | None = None, page_break: str = "\f") -> Column:
    """Non-blank, stripped pages of a document as an array of structs.

    With ``lines_per_page`` every N lines form a page; with ``None`` the text is
    split on ``page_break`` (form feed by default).
    """
    text = F.coalesce(T._col(text_col), F.lit(""))
    if lines_per_page:
        def paginate(lines):
            n_pages = F.ceil(F.size(lines) / F.lit(lines_per_page)).cast("int")
            return F.transform(
                F.sequence(F.lit(0), n_pages - 1),
                lambda i: F.struct(
                    (i + 1).cast("int").alias("page_number"),
                    T.ustrip(F.array_join(F.slice(lines, i * lines_per_page + 1, lines_per_page), "\n")).alias("text"),
                ),
            )

        raw = T.let(F.split(text, "\n", -1), paginate)
    else:
        raw = F.transform(
            F.split(text, page_break, -1),
            lambda p, i: F.struct((i + 1).cast("int").alias("page_number"), T.ustrip(p).alias("text")),
        )
    kept = F.filter(raw, lambda p: p["text"] != "")
    return F.transform(
        kept,
        lambda p, k: F.struct(
            p["page_number"].alias("page_number"), (k + 1).cast("int").alias("page_seq"), p["text"].alias("text")
        ),
    )


def first_pages(pages_col, n: int = T.FIRST_PAGES) -> Column:
    """The first ``n`` non-blank pages."""
    return F.filter(T._col(pages_col), lambda p: p["page_seq"] <= n)


def explode_pages(df: DataFrame, keys: list[str], pages_col: str = "pages") -> DataFrame:
    """One row per page: keys + page_number, page_seq, text.

    An outer explode, with its empty rows filtered above it: an inner one makes
    Spark infer filters on the array below, each with a copy of the paging."""
    return df.select(*keys, F.explode_outer(pages_col).alias("_p")).where(F.col("_p").isNotNull()).select(
        *keys, "_p.page_number", "_p.page_seq", "_p.text"
    )


def once(df: DataFrame, name: str, value: Column) -> DataFrame:
    """``df`` with a column that is computed once: as the element of a generated
    array it is not copied into filters that are pushed below a projection."""
    return df.select("*", F.explode_outer(F.array(value)).alias(name))


def page_table(docs: DataFrame, keys=("collection", "doc_id"), text_col: str = "text", lines_per_page: int | None = None) -> DataFrame:
    """pages(collection, doc_id, page_number, page_seq, text) from a document table."""
    keys = list(keys)
    return explode_pages(docs.select(*keys, page_array(text_col, lines_per_page).alias("pages")), keys)


def lines_of(text_col) -> Column:
    """Lines of a text, each stripped."""
    return F.transform(F.split(T._col(text_col), "\n", -1), T.ustrip)


# --------------------------------------------------------------------------- headings

def heading_titles(pages_col, max_titles: int = T.MAX_TITLES, first_n: int = T.FIRST_PAGES) -> Column:
    """Up to ``max_titles`` distinct heading titles of the first ``first_n``
    pages, longest first (ties by title).

    A stripped line qualifies when it matches the heading pattern and has
    10 < length < 100; the title (pattern group, stripped) must not contain any
    excluded word.
    """
    pages = first_pages(pages_col, first_n)
    lines = F.flatten(F.transform(pages, lambda p: lines_of(p["text"])))
    # lines is the argument array of the filter below: evaluated once
    cand = F.filter(
        lines,
        lambda l: l.rlike(T.HEADING_RX)
        & (F.length(l) > T.HEADING_LINE_MIN)
        & (F.length(l) < T.HEADING_LINE_MAX),
    )
    titles = F.transform(cand, lambda l: T.ustrip(F.regexp_extract(l, T.HEADING_RX, 1)))
    excluded = "|".join(T.EXCLUDED_HEADING_WORDS)
    titles = F.array_distinct(F.filter(titles, lambda t: ~F.lower(t).rlike(excluded)))
    ordered = F.array_sort(F.transform(titles, lambda t: F.struct((-F.length(t)).alias("k"), t.alias("t"))))
    return F.transform(F.slice(ordered, 1, max_titles), lambda s: s["t"])


def fallback_titles(doc_type, task, persona) -> Column:
    """The titles of a document without heading, best first."""
    return F.array(*(T.fill(t, doc_type=doc_type, task=task, persona=persona) for t in T.FALLBACK_TITLE_TEMPLATES))


def section_page(pages_col, title_col) -> Column:
    """Page of a section title among all non-blank pages, in page order.

    1. first page whose lower-cased text contains the lower-cased title;
    2. else first page containing at least half of the title's words longer
       than three characters (lower-cased, duplicates counted; no such words
       means every page qualifies);
    3. else page 1.
    """
    pages = T._col(pages_col)
    title = T._col(title_col)
    # one lower-cased copy of each page, bound once per row
    low_pages = F.transform(pages, lambda p: F.struct(p["page_number"].alias("n"), F.lower(p["text"]).alias("t")))
    kws = F.transform(F.filter(T.split_words(title), lambda w: F.length(w) > T.TITLE_KEYWORD_MIN_LEN), F.lower)

    def search(b):
        exact = F.filter(b["pages"], lambda p: p["t"].contains(b["title"]))
        by_words = F.filter(
            b["pages"],
            lambda p: F.size(F.filter(b["kws"], lambda k: p["t"].contains(k))) * 2 >= F.size(b["kws"]),
        )
        return F.coalesce(F.get(exact, 0)["n"], F.get(by_words, 0)["n"], F.lit(1))

    bound = F.struct(low_pages.alias("pages"), F.lower(title).alias("title"), kws.alias("kws"))
    return T.let(bound, search).cast("int")
