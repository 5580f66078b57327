"""Pages, headings and section pages."""
from pyspark.sql import functions as F

from quire.operators import pages as P


def page_rows(spark, text, lpp=4):
    df = spark.createDataFrame([(text,)], "text string")
    return [tuple(p) for p in df.select(P.page_array("text", lpp).alias("p")).first()["p"]]


def test_blank_page_keeps_number_gap(spark):
    text = "a\nb\nc\nd\n\n \n\t\n\ne\nf"
    assert page_rows(spark, text) == [(1, 1, "a\nb\nc\nd"), (3, 2, "e\nf")]


def test_form_feed_pages(spark):
    df = spark.createDataFrame([("p1\fp2\f \fp4",)], "text string")
    got = [tuple(p) for p in df.select(P.page_array("text", None).alias("p")).first()["p"]]
    assert got == [(1, 1, "p1"), (2, 2, "p2"), (4, 3, "p4")]


def test_empty_and_null_text(spark):
    df = spark.createDataFrame([("",), (None,)], "text string")
    assert [len(r.p) for r in df.select(P.page_array("text").alias("p")).collect()] == [0, 0]


def headings(spark, lines):
    text = "\n".join(lines)
    df = spark.createDataFrame([(text,)], "text string")
    return df.select(P.heading_titles(P.page_array("text", 1000)).alias("h")).first()["h"]


def test_heading_rules(spark):
    lines = [
        "Overview Section. Next",   # title before ". "
        "Overview Section.",        # ends with a full stop: no match
        "Intro – Part 2: x",        # en dash allowed, stops at colon
        "Étude Générale Une",       # non-ASCII first letter: no match
        "Visit the page Now",       # excluded word
        "A" * 10,                   # length 10: too short
        "B" * 99,                   # length 99: kept
        "C" * 100,                  # length 100: too long
        "Short Ones",               # 10 chars
    ]
    got = headings(spark, lines)
    assert got == ["B" * 99, "Overview Section", "Intro – Part 2"]


def test_heading_nel_is_stripped_first(spark):
    assert headings(spark, ["Heading Text One\u0085"]) == ["Heading Text One"]


def test_headings_only_first_five_pages(spark):
    text = "\n".join(["x"] * 20 + ["Late Heading Here"])  # page 6 with 4 lines per page
    df = spark.createDataFrame([(text,)], "text string")
    assert df.select(P.heading_titles(P.page_array("text", 4)).alias("h")).first()["h"] == []


def section_page(spark, pages, title):
    text = "\f".join(pages)
    df = spark.createDataFrame([(text, title)], "text string, title string")
    return df.select(P.section_page(P.page_array("text", None), F.col("title")).alias("p")).first()["p"]


def test_section_page_branches(spark):
    pages = ["intro text", "", "nothing here", "more", "", "", "the Grand Canal guide"]
    assert section_page(spark, pages, "Grand Canal") == 7                 # exact hit on page 7
    assert section_page(spark, pages, "Canal Venice") == 7                # 1 of 2 keywords (>= half)
    assert section_page(spark, pages, "Canal tour of Venice") == 1        # 1 of 3 keywords: not enough
    assert section_page(spark, pages, "a b c") == 1                       # no keyword: first non-blank page
    assert section_page(spark, ["", "x", "y"], "a b c") == 2             # first non-blank page is 2
    assert section_page(spark, pages, "Zebra Crossing Quietly") == 1      # nothing hits


def test_relevance_length_boundary(spark):
    from quire.operators import extract as X
    p149, p150 = "visit " + "x" * 143, "visit " + "x" * 144
    assert (len(p149), len(p150)) == (149, 150)
    df = spark.createDataFrame([(p149,), (p150,)], "t string")
    assert [r[0] for r in df.select(X.keyword_relevant("t")).collect()] == [False, True]


def test_section_search_reaches_sixth_page(spark):
    pages = ["one", "two", "three", "four", "five", "the Hidden Chapter is here"]
    assert section_page(spark, pages, "Hidden Chapter") == 6
