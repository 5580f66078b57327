"""Property tests: helpers that re-express Python built-ins equal those built-ins."""
import os

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from quire.functions import text as T

ALPHABET = list("aZé ßx.-_'\"*:\n\t1 ") + ["\u00a0", "\u2003", "\u0085", "\x1c", "\x1f", " - ", "..", "ǆ", "ﬁ"]
texts = st.lists(st.lists(st.sampled_from(ALPHABET), max_size=12).map("".join), min_size=20, max_size=40)
SETTINGS = settings(max_examples=4, deadline=None, suppress_health_check=list(HealthCheck))


def run(spark, values, fn):
    df = spark.createDataFrame([(v,) for v in values], "v string")
    return [r[0] for r in df.select(fn("v")).collect()]


@SETTINGS
@given(texts)
def test_strip_is_str_strip(spark, values):
    assert run(spark, values, T.ustrip) == [v.strip() for v in values]


@SETTINGS
@given(texts)
def test_split_words_is_str_split(spark, values):
    assert run(spark, values, T.split_words) == [v.split() for v in values]


@SETTINGS
@given(texts)
def test_title_case_is_str_title(spark, values):
    assert run(spark, values, T.title_case) == [v.title() for v in values]


@SETTINGS
@given(texts)
def test_strip_extension_is_splitext(spark, values):
    names = [v.replace("\n", " ").replace("/", "_") for v in values]
    assert run(spark, names, T.strip_extension) == [os.path.splitext(n)[0] for n in names]


@SETTINGS
@given(texts)
def test_collapse_ws_is_split_join_of_runs(spark, values):
    import re
    assert run(spark, values, T.collapse_ws) == [re.sub(r"\s+", " ", v) for v in values]


@SETTINGS
@given(texts)
def test_lines_of_is_split_then_strip(spark, values):
    from quire.operators.pages import lines_of
    assert run(spark, values, lines_of) == [[l.strip() for l in v.split("\n")] for v in values]


@SETTINGS
@given(texts)
def test_contains_any_is_lowered_substring(spark, values):
    words = ["zé", "ss", ". "]
    got = run(spark, values, lambda c: T.contains_any(c, words))
    assert got == [any(w in v.lower() for w in words) for v in values]


def _py_pages(text, n=4):
    lines = text.split("\n")
    chunks = ["\n".join(lines[i:i + n]).strip() for i in range(0, len(lines), n)]
    kept = [(k + 1, t) for k, t in enumerate(chunks) if t]
    return [(num, seq + 1, t) for seq, (num, t) in enumerate(kept)]


@SETTINGS
@given(st.lists(st.lists(st.sampled_from(ALPHABET + ["\n", "\n", "word"]), max_size=30).map("".join), min_size=20, max_size=40))
def test_page_array_is_four_line_chunks(spark, values):
    from quire.operators.pages import page_array
    got = [[tuple(p) for p in ps] for ps in run(spark, values, lambda c: page_array(c, 4))]
    assert got == [_py_pages(v) for v in values]


@SETTINGS
@given(st.lists(st.lists(st.sampled_from(["abcd", "Abcd", "ÉTÉS", "straße", "ab", " ", "-", "\n", "1", "xyzw"]), max_size=25).map("".join),
                min_size=20, max_size=40))
def test_term_freqs_count_letter_runs(spark, values):
    import re
    from collections import Counter
    from quire.operators.similarity import term_freqs
    got = [sorted((x["term"], x["tf"]) for x in r) for r in run(spark, values, term_freqs)]
    want = [sorted(Counter(w for w in re.findall(r"[^\W\d_]+", v.lower()) if len(w) >= 4).items()) for v in values]
    assert got == want
