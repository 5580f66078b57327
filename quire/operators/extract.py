"""Page relevance and extraction of refined page text.

A page of the first five non-blank pages is *relevant* when it has at least
150 characters and contains one of the relevance keywords; optionally a page
without keyword can qualify by its term overlap with the job
(``min_overlap``) or by a supplied verdict column.  Its *refined text* is, in
order of preference:

1. the first three actionable lines (stripped lines with an action word and
   20 < length < 200) joined by one space;
2. an extractive summary: the sentences of the first 1000 characters that
   share most terms with the job, best two, in text order;
3. the template ``Relevant information about {doc_type} for {task}.``
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from quire.functions import text as T
from quire.operators.pages import lines_of

# A sentence ends at a run of . ! ? before a blank, or at the end of the text.
SENTENCE_END = r"(?<=[.!?])\x20"
SUMMARY_SENTENCES = 2


def keyword_relevant(text_col, keywords: Sequence[str] = T.DEFAULT_RELEVANCE_KEYWORDS, min_chars: int = T.MIN_RELEVANT_PAGE_CHARS) -> Column:
    text = T._col(text_col)
    return (F.length(text) >= min_chars) & T.contains_any(text, keywords)


def relevant(text_col, keywords=T.DEFAULT_RELEVANCE_KEYWORDS, min_chars: int = T.MIN_RELEVANT_PAGE_CHARS,
             overlap_col=None, min_overlap: float | None = None, verdict_col=None) -> Column:
    """Keyword relevance, then (for pages still out) the cheaper-to-supply
    fallbacks: term overlap with the job >= ``min_overlap`` and/or a verdict."""
    text = T._col(text_col)
    long_enough = F.length(text) >= min_chars
    fallback = F.lit(False)
    if overlap_col is not None and min_overlap is not None:
        fallback = fallback | (T._col(overlap_col) >= F.lit(min_overlap))
    if verdict_col is not None:
        fallback = fallback | F.coalesce(T._col(verdict_col), F.lit(False))
    return long_enough & (T.contains_any(text, keywords) | fallback)


def actionable_lines(text_col, action_words: Sequence[str] = T.DEFAULT_ACTION_WORDS) -> Column:
    """Stripped lines with an action word and 20 < length < 200, in order."""
    return F.filter(
        lines_of(text_col),
        lambda l: T.contains_any(l, action_words, bind=True) & (F.length(l) > T.ACTION_LINE_MIN) & (F.length(l) < T.ACTION_LINE_MAX),
    )


def key_lines(text_col, action_words: Sequence[str] = T.DEFAULT_ACTION_WORDS, n: int = T.MAX_KEY_LINES) -> Column:
    """First ``n`` actionable lines joined by a space; NULL when there is none."""
    return T.let(
        actionable_lines(text_col, action_words),
        lambda act: F.when(F.size(act) > 0, F.array_join(F.slice(act, 1, n), " ")),
    )


def summary_sentences(text_col, job_terms_col, n: int = SUMMARY_SENTENCES, context_chars: int = T.SUMMARY_CONTEXT_CHARS) -> Column:
    """Extractive summary of the first ``context_chars`` characters.

    Sentences (cut at a blank after ``.``, ``!`` or ``?``; blanks collapsed)
    are scored by the number of distinct job terms they contain; the best
    ``n`` with a score above 0 (ties: earlier first) are joined in text order.
    NULL when no sentence shares a term with the job.
    """
    ctx = T.collapse_ws(F.substring(T._col(text_col), 1, context_chars))
    sents = F.filter(F.transform(F.split(ctx, SENTENCE_END, -1), T.ustrip), lambda s: s != "")

    def score_all(jt):
        return F.transform(
            sents,
            lambda s, i: F.struct(
                (-F.size(F.array_intersect(F.array_distinct(T.terms(s)), jt))).alias("neg"),
                i.alias("pos"),
                s.alias("s"),
            ),
        )

    def pick(best):
        ordered = F.array_sort(F.transform(best, lambda x: F.struct(x["pos"].alias("pos"), x["s"].alias("s"))))
        return F.when(F.size(best) > 0, F.array_join(F.transform(ordered, lambda x: x["s"]), " "))

    scored = T.let(F.array_distinct(T._col(job_terms_col)), score_all)
    return T.let(F.slice(F.array_sort(F.filter(scored, lambda x: x["neg"] < 0)), 1, n), pick)


def refined_text(text_col, doc_type_col, task_col, job_terms_col=None,
                 action_words: Sequence[str] = T.DEFAULT_ACTION_WORDS, summarize: bool = True,
                 generated_col=None) -> Column:
    """Key lines, else a supplied generated summary, else the extractive
    summary, else the fallback template."""
    options = [key_lines(text_col, action_words)]
    if generated_col is not None:
        options.append(T._col(generated_col))
    if summarize and job_terms_col is not None:
        options.append(summary_sentences(text_col, job_terms_col))
    options.append(T.fill(T.FALLBACK_SUMMARY_TEMPLATE, doc_type=doc_type_col, task=task_col))
    return F.coalesce(*options)
