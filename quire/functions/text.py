"""Column-level text helpers.

All helpers return ``pyspark.sql.Column`` expressions built from Spark's own
functions (regex, higher-order array functions), so they run inside the JVM and
need no Python worker.  Semantics follow Python string methods where the job
description depends on them (``str.strip``, ``str.title``, ``os.path.splitext``).
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Fixed values that must equal the job's original behaviour.
# ---------------------------------------------------------------------------
# Heading line pattern: capital ASCII letter, then letters/digits/space/hyphen/
# en dash; followed by a colon, a full stop plus blank, or the end of the line.
HEADING_PATTERN = r"^([A-Z][A-Za-z0-9 \-–]+)(?::|\.\s|\z)"
# Words that disqualify a heading (substring test on the lower-cased title).
EXCLUDED_HEADING_WORDS = ["page", "copyright", "figure", "table"]
# Default relevance keywords (substring test on the lower-cased page).
DEFAULT_RELEVANCE_KEYWORDS = [
    "travel", "trip", "itinerary", "plan", "visit",
    "destination", "activity", "guide", "recommend",
]
# Default action words that mark a line worth extracting.
DEFAULT_ACTION_WORDS = ["how to", "step", "guide", "itinerary", "visit", "recommend"]
# Prefixes removed from generated responses, in this order.
RESPONSE_PREFIXES = ["Answer:", "Response:", "Summary:", "Information:", "Context:"]
# Text templates.
QUERY_TEMPLATE = "{persona} needs to {task}"
RETRIEVAL_TEMPLATE = "Document titled '{filename}' about {doc_type} with potential relevance to travel planning"
RERANK_TEMPLATE = (
    "Document titled '{filename}' about {doc_type}. "
    "Contents may include travel destinations, activities, or cultural information."
)
FALLBACK_TITLE_TEMPLATES = [
    "Key Information about {doc_type}",
    "Important Details for {task}",
    "Practical Guidance for {persona}s",
]
FALLBACK_SUMMARY_TEMPLATE = "Relevant information about {doc_type} for {task}."
TITLES_PROMPT_TEMPLATE = (
    'What are 3 most relevant section titles from a "{doc_type}" document that would help a '
    "{persona} accomplish: {task}?\nProvide only the titles, one per line, without numbering."
)
RELEVANCE_PROMPT_TEMPLATE = (
    'Is this content from "{filename}" relevant for a {persona} working on {task}?\n'
    "Content: {context}\nAnswer only YES or NO."
)
SUMMARY_PROMPT_TEMPLATE = (
    'Summarize the most relevant information from this "{doc_type}" document content for a '
    "{persona} working on {task}:\n{context}\nProvide a concise 1-2 sentence summary focusing only "
    "on information that would help accomplish the task."
)
RELEVANCE_CONTEXT_CHARS = 500
SUMMARY_CONTEXT_CHARS = 1000
# Length bounds (exclusive, in code points).
HEADING_LINE_MIN, HEADING_LINE_MAX = 10, 100
ACTION_LINE_MIN, ACTION_LINE_MAX = 20, 200
TITLE_MIN, TITLE_MAX = 5, 100
MIN_RELEVANT_PAGE_CHARS = 150
MAX_TITLES = 3
# Pages searched for headings and page extracts (the first non-blank pages).
FIRST_PAGES = 5
# Section-page search: title words longer than this count as keywords.
TITLE_KEYWORD_MIN_LEN = 3
# Extracted lines joined into a page extract.
MAX_KEY_LINES = 3
# ---------------------------------------------------------------------------

# Characters whose title case differs from their upper case, by Unicode's data.
TITLECASE_SPECIAL = {c: c.title() for c in map(chr, range(0x80, 0xD800)) if c.title() != c.upper()} | {
    c: c.title() for c in map(chr, range(0xE000, 0x10000)) if c.title() != c.upper()
}

# Python's str.isspace() set: Unicode White_Space plus the four separators
# U+001C..U+001F.  Java's (?U)\s is White_Space only.
_WS = r"[\s\x1c-\x1f]"
_STRIP_RX = rf"(?U)^{_WS}+|{_WS}+\z"
_WS_RUN_RX = rf"(?U){_WS}+"
# The heading pattern with the blanks of Python's re, which are Unicode's.
HEADING_RX = HEADING_PATTERN.replace(r"\s", r"[\p{IsWhite_Space}\x1c-\x1f]")
# Cased, as str.title() has it: the properties, not the categories (ª and ⓐ are lower case).
_CASED = r"\p{IsLowercase}\p{IsUppercase}\p{Lt}"
_CASE_RUNS_RX = rf"([{_CASED}]+|[^{_CASED}]+)"
_BIG = 1 << 30


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def let(value, body) -> Column:
    """Evaluate ``value`` once and pass it to ``body`` as a lambda variable.

    Spark evaluates an outer expression referenced inside a higher-order
    function's lambda once per element; binding it through a one-element
    ``transform`` evaluates it once per row instead.
    """
    return F.get(F.transform(F.array(_col(value)), body), 0)


def ustrip(c) -> Column:
    """Python ``str.strip()``: remove Unicode blanks (and U+001C..U+001F) at both ends."""
    return F.regexp_replace(_col(c), _STRIP_RX, "")


def collapse_ws(c) -> Column:
    """Python ``re.sub(r'\\s+', ' ', s)`` for str patterns."""
    return F.regexp_replace(_col(c), _WS_RUN_RX, " ")


def split_words(c) -> Column:
    """Python ``str.split()`` (no argument): words between blank runs, no empties."""
    return F.filter(F.split(_col(c), _WS_RUN_RX), lambda w: w != "")


def title_case(c) -> Column:
    """Python ``str.title()``: a cased letter is upper-cased when the previous
    character is not cased, lower-cased otherwise (``initcap`` only looks at spaces)."""
    runs = F.regexp_extract_all(_col(c), F.lit(_CASE_RUNS_RX), 1)
    special = F.create_map(*[F.lit(x) for kv in TITLECASE_SPECIAL.items() for x in kv])

    def head(first):
        return F.coalesce(F.try_element_at(special, first), F.upper(first))

    fixed = F.transform(
        runs,
        lambda r: F.when(
            r.rlike(rf"^[{_CASED}]"),
            F.concat(head(F.substring(r, 1, 1)), F.lower(F.substring(r, 2, _BIG))),
        ).otherwise(r),
    )
    return F.array_join(fixed, "")


def strip_extension(c) -> Column:
    """``os.path.splitext(name)[0]``: drop the last extension; names made of a
    leading-dot run plus one word (``.bashrc``) keep theirs."""
    return F.regexp_replace(_col(c), r"(?s)^((?:.*/)?\.*[^./][^/]*)\.[^./]*\z", "$1")


def document_type(filename) -> Column:
    """Readable document type from a file name.

    With ``" - "`` in the stem: the last ``" - "`` part, underscores to spaces
    (case kept).  Otherwise: underscores to spaces, then title case.
    """
    stem = strip_extension(filename)
    return (
        F.when(F.instr(stem, " - ") > 0, F.regexp_replace(F.element_at(F.split(stem, " - "), -1), "_", " "))
        .otherwise(title_case(F.regexp_replace(stem, "_", " ")))
    )


def fill(template: str, **cols) -> Column:
    """Fill a ``str.format``-style template with columns (``{name}`` fields)."""
    parts: list[Column] = []
    pos = 0
    for m in re.finditer(r"\{(\w+)\}", template):
        if m.start() > pos:
            parts.append(F.lit(template[pos:m.start()]))
        parts.append(_col(cols[m.group(1)]).cast("string"))
        pos = m.end()
    if pos < len(template):
        parts.append(F.lit(template[pos:]))
    return F.concat(*parts) if parts else F.lit("")


def _java_literal(s: str) -> str:
    return re.sub(r"([\\.\[\]{}()*+?^$|\-&~#])", r"\\\1", s)


def contains_any(c, words: Sequence[str], bind: bool = False) -> Column:
    """True when the lower-cased text contains any of ``words`` as a substring.

    ``bind=True`` lower-cases once via ``let`` (use inside lambdas, where
    common subexpressions are not shared); in plain projections whole-stage
    codegen shares ``lower(c)`` already.
    """
    words = [w.lower() for w in words]
    if not words:
        return F.lit(False)

    def any_of(low):
        out = None
        for w in words:
            t = low.contains(w)
            out = t if out is None else (out | t)
        return out

    return let(F.lower(_col(c)), any_of) if bind else any_of(F.lower(_col(c)))


def clean_response(c) -> Column:
    """Normalise a generated response.

    Blank runs become one space; U+FFFD and U+200B are deleted; for each of the
    prefixes in order, when present the text after its first occurrence is kept
    and stripped; finally surrounding double quotes, then single quotes, then
    blanks are removed.  Each step references its input once, so the
    expression stays linear in size.
    """
    t = collapse_ws(c)
    t = F.regexp_replace(t, "[�​]", "")
    for p in RESPONSE_PREFIXES:
        t = F.regexp_replace(t, rf"(?sU)^.*?{_java_literal(p)}{_WS}*(.*?){_WS}*\z", "$1")
    t = F.regexp_replace(t, r'^"+|"+\z', "")
    t = F.regexp_replace(t, r"^'+|'+\z", "")
    return ustrip(t)


def parse_titles(c, limit: int = MAX_TITLES) -> Column:
    """Title list from a multi-line response: drop a leading run of digits,
    dots, hyphens and asterisks, strip, keep 5 < length < 100, first ``limit``."""
    lines = F.split(_col(c), "\n", -1)
    cleaned = F.transform(lines, lambda l: ustrip(F.regexp_replace(l, r"(?U)^[\d.\-*]+", "")))
    kept = F.filter(cleaned, lambda l: (F.length(l) > TITLE_MIN) & (F.length(l) < TITLE_MAX))
    return F.slice(kept, 1, limit)


def verdict(c, word: str = "yes") -> Column:
    """Yes/no verdict of a response: the lower-cased text contains ``word``."""
    return F.lower(_col(c)).contains(word.lower())


def terms(c, min_len: int = 4) -> Column:
    """Lower-cased letter runs of at least ``min_len`` code points."""
    return F.regexp_extract_all(F.lower(_col(c)), F.lit(rf"\p{{L}}{{{max(min_len, 1)},}}"), F.lit(0))
