"""Column helpers on hand-checked rows (FIXTURES.md edge rows and more).

Expected values are written out; the property tests in test_properties.py
compare the helpers that re-express Python built-ins with those built-ins.
"""
import pytest
from pyspark.sql import functions as F

from quire.functions import text as T

DOC_TYPES = [
    ('South of France - Tips and_Tricks.pdf', 'Tips and Tricks'),
    ('travel-guide2b.pdf', 'Travel-Guide2B'),
    ('.bashrc', '.Bashrc'),
    ('a.tar.gz', 'A.Tar'),
    ("o'neil_report v2.PDF", "O'Neil Report V2"),
    ('x - y - z_w.pdf', 'z w'),
    ('a.', 'A'),
    ('..', '..'),
    ('x..y', 'X.'),
    ('plain', 'Plain'),
    ('Ünïcode_ñame.txt', 'Ünïcode Ñame'),
]

CLEANED = [
    ('Answer: "x  y"\n z', 'x y" z'),
    ('Summary: a Answer: b', 'b'),
    ('Answer:a Answer:b', 'a Answer:b'),
    ('Context: \'"a"\'', '"a"'),
    ('"\'a\'" ', 'a\'"'),
    (' plain\u200b text ', 'plain text'),
    ('Response:   Summary:  q ', 'q'),
    ('""', ''),
    ('Information:\n\n', ''),
    ('a\xa0b\u2003 c\x1c', 'a b c'),
    ('no prefix at all', 'no prefix at all'),
    ('Answer: Response: Summary: Information: Context: deep', 'deep'),
]

TITLE_LISTS = [
    ('1. First title here\n2. Second title\n- x\n*** Third one is fine\n4. Fourth title', ['First title here', 'Second title', 'Third one is fine']),
    ('short\nab', []),
    ('12.5 Numbered', ['Numbered']),
]


def one_col(spark, values, expr):
    df = spark.createDataFrame([(v,) for v in values], "v string")
    return [r[0] for r in df.select(expr(F.col("v"))).collect()]


def test_document_type(spark):
    assert one_col(spark, [n for n, _ in DOC_TYPES], T.document_type) == [t for _, t in DOC_TYPES]


def test_clean_response(spark):
    assert one_col(spark, [r for r, _ in CLEANED], T.clean_response) == [c for _, c in CLEANED]


@pytest.mark.parametrize("s", ["   x \u0085\x1c\t", "  ", "a\nb\n", "  a b ", "\x1d\x1eq\x1f"])
def test_ustrip_matches_python_strip(spark, s):
    assert one_col(spark, [s], T.ustrip) == [s.strip()]


def test_parse_titles(spark):
    assert one_col(spark, [r for r, _ in TITLE_LISTS], T.parse_titles) == [t for _, t in TITLE_LISTS]


def test_split_words_and_terms(spark):
    assert one_col(spark, ["  a  bb\tccc\n"], T.split_words) == [["a", "bb", "ccc"]]
    assert one_col(spark, ["Über-Straße and the, théâtre 123 abc"], T.terms) == [["über", "straße", "théâtre"]]


def test_contains_any_and_verdict(spark):
    assert one_col(spark, ["Plan explanation", "nothing"], lambda c: T.contains_any(c, ["plan"])) == [True, False]
    assert one_col(spark, ["x"], lambda c: T.contains_any(c, [])) == [False]
    assert one_col(spark, ["YES indeed", "no"], T.verdict) == [True, False]


def test_let_binds_once(spark):
    got = one_col(spark, ["a b c"], lambda c: T.let(F.split(c, " "), lambda a: F.size(a) * 10 + F.size(a)))
    assert got == [33]


def test_strip_extension_with_line_separators(spark):
    import os
    names = ["\x85\x85..", "a b.txt", "x\ny.pdf"]
    assert one_col(spark, names, T.strip_extension) == [os.path.splitext(n)[0] for n in names]


def test_heading_blanks_and_extensions_equal_python(spark):
    import os
    import re

    from quire.functions import text as T

    blanks = [" ", "\t", "\u00a0", "\u2003", "\u3000", "\x1c", "\x85", "x", ""]
    lines = [f"Overview Section.{b}Next part" for b in blanks] + ["Overview Section:", "Overview Section", "overview", "Über uns."]
    df = spark.createDataFrame([(x,) for x in lines], "l string")
    got = [r[0] for r in df.select(F.col("l").rlike(T.HEADING_RX)).collect()]
    python = re.compile(T.HEADING_PATTERN.replace(r"\z", r"\Z"))
    assert got == [bool(python.match(x)) for x in lines]
    names = ["a.b/c", "d/.bashrc", "d/a.tar.gz", ".bashrc", "..a.b", "...", "a.", "a", "", "x/y.z/", "x.y/z.w", "a\n.b"]
    df = spark.createDataFrame([(x,) for x in names], "n string")
    assert [r[0] for r in df.select(T.strip_extension("n")).collect()] == [os.path.splitext(x)[0] for x in names]


def test_sentences_are_not_cut_inside_numbers(spark):
    from quire.operators import extract as X

    text = "The release 2.5 of the reporting tool adds charts. Nothing else."
    df = spark.createDataFrame([(text, ["reporting", "charts"])], "t string, terms array<string>")
    assert df.select(X.summary_sentences("t", "terms")).first()[0] == "The release 2.5 of the reporting tool adds charts."


def test_title_case_of_every_cased_character(spark):
    """Alone, after a cased and after an uncased character.  What differs are letters
    that became cased after Unicode 13, the version of Java 17's patterns."""
    cased = [c for c in map(chr, [*range(0xD800), *range(0xE000, 0x110000)]) if (c + "a").title() != c + "A"]
    values = [v for c in cased for v in (c, f"a{c}b", f"1{c}b")]
    got = one_col(spark, values, T.title_case)
    wrong = {values[i // 3 * 3] for i, v in enumerate(values) if got[i] != v.title()}
    assert len(cased) > 4500 and len(wrong) < 250
    late = [(0x19B, 0x19B), (0x264, 0x264), (0x10FC, 0x10FC), (0x1C89, 0x1C8A), (0x2C2F, 0x2C5F), (0xA7C0, 0xA7FF), (0xAB69, 0xAB69), (0x10570, 0x107BF), (0x1DF00, 0x1E08F)]
    assert not [c for c in wrong if not any(a <= ord(c) <= b for a, b in late)]
    some = ["aªb", "xⓐy", "ʰello", "ᾳβ", "1ǆa", "ΐx"]
    assert one_col(spark, some, T.title_case) == [v.title() for v in some]
