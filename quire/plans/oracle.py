"""DuckDB SQL equivalents of the registered queries (the correctness oracle).

Written independently of the Spark plans, relationally where that is natural
(lines, headings, pages as rows) and with DuckDB list lambdas elsewhere.
Views ``documents benchmark labels conversations embeddings`` are expected.
"""

from __future__ import annotations

from quire.functions import text as T
from quire.sources import testdata as TD
from quire.plans import catalog as C


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def strip(x: str) -> str:
    return f"regexp_replace({x}, '^\\s+|\\s+$', '', 'g')"


def terms(x: str) -> str:
    return f"list_filter(regexp_extract_all(lower({x}), '(\\p{{L}}+)', 1), lambda w: length(w) >= 4)"


def contains_any(x: str, words) -> str:
    if not words:
        return "false"
    return "(" + " OR ".join(f"contains(lower({x}), {_q(w.lower())})" for w in words) + ")"


def title_case(x: str) -> str:
    cased = "\\p{Lu}\\p{Ll}\\p{Lt}"
    return (
        f"array_to_string(list_transform(regexp_extract_all({x}, '([{cased}]+|[^{cased}]+)', 1), "
        f"lambda r: CASE WHEN regexp_matches(r, '^[{cased}]') THEN upper(substr(r, 1, 1)) || lower(substr(r, 2)) ELSE r END), '')"
    )


def doc_type(fn: str) -> str:
    stem = f"regexp_replace({fn}, '^(.*[^.].*)\\.[^.]*$', '\\1')"
    return (
        f"(CASE WHEN contains({stem}, ' - ') THEN replace(string_split({stem}, ' - ')[-1], '_', ' ') "
        f"ELSE {title_case(f'replace({stem}, ' + _q('_') + ', ' + _q(' ') + ')')} END)"
    )


def fill(template: str, **exprs) -> str:
    import re
    parts = []
    pos = 0
    for m in re.finditer(r"\{(\w+)\}", template):
        if m.start() > pos:
            parts.append(_q(template[pos:m.start()]))
        parts.append(f"CAST({exprs[m.group(1)]} AS VARCHAR)")
        pos = m.end()
    if pos < len(template):
        parts.append(_q(template[pos:]))
    return "(" + " || ".join(parts) + ")"


HEAD = _q(T.HEADING_PATTERN)
EXCL = _q("|".join(T.EXCLUDED_HEADING_WORDS))
LPP = TD.LINES_PER_PAGE

DOCS = f"""docs AS (
  SELECT source AS collection, doc_id, doc_id AS doc_ord,
         CASE WHEN doc_id % 2 = 0 THEN source || ' - ' || lang || '_' || CAST(doc_id AS VARCHAR) || '.txt'
              ELSE lang || '_' || CAST(doc_id AS VARCHAR) || '-v2b.txt' END AS filename,
         coalesce(text, '') AS text
  FROM documents)"""

JOBS = f"""jobs AS (
  SELECT 'src' || CAST(item_id AS VARCHAR) AS collection, {_q(TD.TEST_PERSONA)} AS persona, text AS task,
         {fill(T.QUERY_TEMPLATE, persona=_q(TD.TEST_PERSONA), task='text')} AS query
  FROM benchmark)"""

PAGES = f"""raw_pages AS (
  SELECT collection, doc_id, CAST(i + 1 AS BIGINT) AS page_number,
         {strip(f"array_to_string(list_slice(lines, i * {LPP} + 1, i * {LPP} + {LPP}), chr(10))")} AS text
  FROM (SELECT collection, doc_id, string_split(text, chr(10)) AS lines,
               unnest(range(0, CAST(ceil(len(string_split(text, chr(10))) / {LPP}.0) AS BIGINT))) AS i
        FROM docs) t),
pages AS (
  SELECT collection, doc_id, page_number,
         CAST(row_number() OVER (PARTITION BY collection, doc_id ORDER BY page_number) AS BIGINT) AS page_seq, text
  FROM raw_pages WHERE text <> '')"""

# pages of documents whose collection has a job, with job and type columns
JPAGES = f"""jdocs AS (
  SELECT d.*, j.persona, j.task, j.query, {doc_type('d.filename')} AS doc_type
  FROM docs d JOIN jobs j USING (collection)),
fp AS (
  SELECT p.*, d.doc_ord, d.filename, d.doc_type, d.persona, d.task, d.query
  FROM pages p JOIN jdocs d USING (collection, doc_id) WHERE p.page_seq <= 5)"""


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


def tfidf(src: str, queries: str = "jobs") -> str:
    """CTEs ending in ``scores(collection, doc_id, score, overlap)`` for ``src(collection, doc_id, text)``."""
    return f"""dterm AS (SELECT collection, doc_id, unnest({terms('text')}) AS term FROM {src}),
dt AS (SELECT collection, doc_id, term, count(*) AS tf FROM dterm GROUP BY collection, doc_id, term),
ndocs AS (SELECT collection, count(*) AS n_docs FROM {src} GROUP BY collection),
dfreq AS (SELECT collection, term, count(*) AS df FROM dt GROUP BY collection, term),
idf AS (SELECT f.collection, f.term, ln(1.0 + CAST(n.n_docs AS DOUBLE) / f.df) AS idf FROM dfreq f JOIN ndocs n USING (collection)),
norms AS (SELECT collection, doc_id, sqrt(sum(pow(tf * idf, 2))) AS dnorm FROM dt JOIN idf USING (collection, term) GROUP BY collection, doc_id),
qterm AS (SELECT collection, unnest({terms('query')}) AS term FROM {queries}),
qt AS (SELECT collection, term, count(*) AS qtf FROM qterm GROUP BY collection, term),
nq AS (SELECT collection, count(*) AS n_qterms FROM qt GROUP BY collection),
qw AS (SELECT qt.collection, qt.term, coalesce(qt.qtf * idf.idf, 0.0) AS qw, idf.idf FROM qt LEFT JOIN idf USING (collection, term)),
qn AS (SELECT collection, sqrt(sum(pow(qw, 2))) AS qnorm FROM qw GROUP BY collection),
hits AS (SELECT dt.collection, dt.doc_id, sum(dt.tf * qw.idf * qw.qw) AS dot, count(*) AS n_hit
         FROM dt JOIN qw USING (collection, term) GROUP BY dt.collection, dt.doc_id),
scores AS (
  SELECT s.collection, s.doc_id,
         round(CASE WHEN coalesce(dnorm * qnorm, 0.0) > 0 THEN coalesce(dot, 0.0) / (dnorm * qnorm) ELSE 0.0 END, 9) AS score,
         round(CASE WHEN coalesce(n_qterms, 0) > 0 THEN CAST(coalesce(n_hit, 0) AS DOUBLE) / n_qterms ELSE 0.0 END, 9) AS overlap
  FROM {src} s LEFT JOIN norms USING (collection, doc_id) LEFT JOIN hits USING (collection, doc_id)
       LEFT JOIN qn USING (collection) LEFT JOIN nq USING (collection))"""


def hybrid(scored: str, group: str = "collection", ord_col: str = "doc_ord", key: str = "doc_id",
           score: str = "score", rerank: str = "overlap") -> str:
    """CTEs r1 (bi_rank) and ranked (final_score, importance_rank) over ``scored``."""
    return f"""r1 AS (SELECT *, row_number() OVER (PARTITION BY {group} ORDER BY {score} DESC, {ord_col}, {key}) AS bi_rank FROM {scored}),
r2 AS (SELECT *, round(CASE WHEN bi_rank <= 10 THEN CAST(0.6 AS DOUBLE) * {rerank} + CAST(0.4 AS DOUBLE) * {score} ELSE {score} END, 9) AS final_score FROM r1),
ranked AS (SELECT *, row_number() OVER (PARTITION BY {group} ORDER BY final_score DESC, bi_rank) AS importance_rank FROM r2)"""


def key_lines(x: str, words) -> str:
    acts = (
        f"list_filter(list_transform(string_split({x}, chr(10)), lambda l: {strip('l')}), "
        f"lambda l: {contains_any('l', words)} AND length(l) > {T.ACTION_LINE_MIN} AND length(l) < {T.ACTION_LINE_MAX})"
    )
    return f"(CASE WHEN len({acts}) > 0 THEN array_to_string(list_slice({acts}, 1, 3), ' ') END)"


def summary(x: str, q: str) -> str:
    ctx = f"regexp_replace(substr({x}, 1, {T.SUMMARY_CONTEXT_CHARS}), '\\s+', ' ', 'g')"
    # a mark is put after every sentence end that a blank follows, then the text is cut at the marks
    marked = f"regexp_replace({ctx}, '([.!?]) ', '\\1' || chr(1), 'g')"
    sents = f"list_filter(list_transform(string_split({marked}, chr(1)), lambda s: {strip('s')}), lambda s: s <> '')"
    jt = f"list_distinct({terms(q)})"
    scored = f"list_transform({sents}, lambda s, i: {{'neg': -len(list_intersect(list_distinct({terms('s')}), {jt})), 'pos': i, 's': s}})"
    best = f"list_slice(list_sort(list_filter({scored}, lambda x: x.neg < 0)), 1, 2)"
    return (
        f"(CASE WHEN len({best}) > 0 THEN array_to_string(list_transform(list_sort(list_transform({best}, "
        f"lambda x: {{'pos': x.pos, 's': x.s}})), lambda x: x.s), ' ') END)"
    )


def overlap(x: str, q: str) -> str:
    jt = f"list_distinct({terms(q)})"
    return f"(CASE WHEN len({jt}) > 0 THEN CAST(len(list_intersect({jt}, list_distinct({terms(x)}))) AS DOUBLE) / len({jt}) ELSE 0.0 END)"


def headings_ctes(src_pages: str) -> str:
    """CTEs ending in ``titles(collection, doc_id, title, rn)`` over the first five pages."""
    return f"""hl AS (SELECT collection, doc_id, {strip('l')} AS line
       FROM (SELECT collection, doc_id, unnest(string_split(text, chr(10))) AS l FROM {src_pages} WHERE page_seq <= 5) x),
ht AS (SELECT DISTINCT collection, doc_id, {strip(f'regexp_extract(line, {HEAD}, 1)')} AS title
       FROM hl WHERE regexp_matches(line, {HEAD}) AND length(line) > {T.HEADING_LINE_MIN} AND length(line) < {T.HEADING_LINE_MAX}),
titles AS (SELECT collection, doc_id, title,
                  row_number() OVER (PARTITION BY collection, doc_id ORDER BY length(title) DESC, title) AS rn
           FROM ht WHERE NOT regexp_matches(lower(title), {EXCL}))"""


def section_page_ctes(titled: str, src_pages: str = "pages") -> str:
    """CTE ``spage(collection, doc_id, page_number)`` for ``titled(collection, doc_id, section_title)``."""
    return f"""kw AS (SELECT collection, doc_id, section_title,
              list_transform(list_filter(string_split_regex(section_title, '\\s+'), lambda w: length(w) > 3), lambda w: lower(w)) AS kws
       FROM {titled}),
pp AS (SELECT k.collection, k.doc_id,
              min(p.page_number) FILTER (WHERE contains(lower(p.text), lower(k.section_title))) AS exact_page,
              min(p.page_number) FILTER (WHERE len(list_filter(k.kws, lambda w: contains(lower(p.text), w))) * 2 >= len(k.kws)) AS kw_page
       FROM kw k JOIN {src_pages} p USING (collection, doc_id) GROUP BY k.collection, k.doc_id),
spage AS (SELECT k.collection, k.doc_id, CAST(coalesce(exact_page, kw_page, 1) AS BIGINT) AS page_number
          FROM kw k LEFT JOIN pp USING (collection, doc_id))"""


def analysis_ctes(default: bool = False, rerank: bool = True, min_overlap: float | None = None, restrict: bool = False) -> str:
    """Sections and subsections: CTEs ``sections`` and ``subsections``.

    Test configuration (body-text ranking, test keyword lists), or with
    ``default`` the job's defaults (file-name templates, travel lists)."""
    if default:
        kws, acts = T.DEFAULT_RELEVANCE_KEYWORDS, T.DEFAULT_ACTION_WORDS
        ret = fill(T.RETRIEVAL_TEMPLATE, filename="filename", doc_type="doc_type")
        rer = fill(T.RERANK_TEMPLATE, filename="d.filename", doc_type="d.doc_type")
        rank_ctes = [
            f"rdocs AS (SELECT collection, doc_id, {ret} AS text FROM jdocs)",
            tfidf("rdocs"),
            f"""scored AS (SELECT s.collection, s.doc_id, s.score, d.doc_ord, d.filename,
                   round({overlap(rer, 'd.query')}, 9) AS rerank
            FROM scores s JOIN jdocs d USING (collection, doc_id))""",
            hybrid("scored", rerank="rerank"),
        ]
    else:
        kws, acts = TD.TEST_RELEVANCE_KEYWORDS, TD.TEST_ACTION_WORDS
        rank_ctes = [
            "rdocs AS (SELECT collection, doc_id, text FROM jdocs)",
            tfidf("rdocs"),
            "scored AS (SELECT s.*, d.doc_ord, d.filename FROM scores s JOIN jdocs d USING (collection, doc_id))",
            hybrid("scored") if rerank else "ranked AS (SELECT *, row_number() OVER (PARTITION BY collection ORDER BY score DESC, doc_ord, doc_id) AS importance_rank FROM scored)",
        ]
    return with_(
        DOCS, JOBS, PAGES, JPAGES,
        *rank_ctes,
        f"""has_text AS (SELECT DISTINCT collection, doc_id FROM pages),
cand AS (SELECT r.collection, r.doc_id, r.doc_ord, r.filename, r.importance_rank,
                row_number() OVER (PARTITION BY r.collection ORDER BY r.importance_rank, r.doc_ord, r.doc_id) AS k
         FROM ranked r JOIN has_text USING (collection, doc_id)),
top AS (SELECT * FROM cand WHERE k <= 5),
tpages AS (SELECT p.* FROM pages p JOIN top USING (collection, doc_id))""",
        headings_ctes("tpages"),
        f"""titled AS (SELECT t.*, coalesce(h.title, {fill(T.FALLBACK_TITLE_TEMPLATES[0], doc_type=doc_type('t.filename'))}) AS section_title
           FROM top t LEFT JOIN (SELECT * FROM titles WHERE rn = 1) h USING (collection, doc_id))""",
        section_page_ctes("titled", "tpages"),
        """sections AS (SELECT t.collection, t.filename AS document, t.section_title, CAST(t.importance_rank AS BIGINT) AS importance_rank,
                    s.page_number, t.doc_ord, t.doc_id FROM titled t JOIN spage s USING (collection, doc_id))""",
        f"""rel AS (SELECT fp.*, coalesce({key_lines('text', acts)}, {summary('text', 'query')},
                          {fill(T.FALLBACK_SUMMARY_TEMPLATE, doc_type='doc_type', task='task')}) AS refined_text
        FROM fp WHERE length(text) >= {T.MIN_RELEVANT_PAGE_CHARS} AND ({contains_any('text', kws)}{f" OR {overlap('text', 'query')} >= {min_overlap}" if min_overlap else ""})),
subcand AS (SELECT rel.*, r.importance_rank,
                   row_number() OVER (PARTITION BY rel.collection ORDER BY r.importance_rank, rel.page_number, rel.doc_ord, rel.doc_id) AS k
            FROM rel JOIN ranked r USING (collection, doc_id) WHERE refined_text IS NOT NULL AND refined_text <> ''
              {"AND EXISTS (SELECT 1 FROM sections s WHERE s.collection = rel.collection AND s.doc_id = rel.doc_id)" if restrict else ""}),
subsections AS (SELECT collection, filename AS document, refined_text, page_number, CAST(importance_rank AS BIGINT) AS importance_rank,
                       doc_ord, doc_id FROM subcand WHERE k <= 5)""",
    )


def responses_cte() -> str:
    pre = ", ".join(_q(x) for x in ["", 'Answer: "', "Summary: Response: ", "Context: '", "Information:", ' "'])
    return f"""responses AS (SELECT conv_id, turn, role, [{pre}][CAST(turn % 6 + 1 AS BIGINT)] || text AS response
              FROM conversations)"""


def clean(x: str) -> str:
    t = f"replace(replace(regexp_replace({x}, '\\s+', ' ', 'g'), chr(65533), ''), chr(8203), '')"
    for p in T.RESPONSE_PREFIXES:
        t = f"regexp_replace({t}, '(?s)^.*?{p}\\s*(.*?)\\s*$', '\\1')"
    t = f"regexp_replace({t}, '^\"+|\"+$', '', 'g')"
    t = f"regexp_replace({t}, '^''+|''+$', '', 'g')"
    return strip(t)


def vectors_ctes() -> str:
    return """dims AS (SELECT label, vec_id, generate_subscripts(embedding, 1) AS dim, unnest(embedding) AS v FROM embeddings),
cent AS (SELECT label, dim, avg(CAST(v AS DOUBLE)) AS c FROM dims GROUP BY label, dim),
vecs AS (
  SELECT d.label, d.vec_id,
         sum(CAST(d.v AS DOUBLE) * c.c) AS dotp,
         sqrt(sum(CAST(d.v AS DOUBLE) * CAST(d.v AS DOUBLE))) AS na,
         sqrt(sum(c.c * c.c)) AS nb,
         sqrt(sum((CAST(d.v AS DOUBLE) - c.c) * (CAST(d.v AS DOUBLE) - c.c))) AS dist
  FROM dims d JOIN cent c USING (label, dim) GROUP BY d.label, d.vec_id),
vscore AS (SELECT label, vec_id, round(CASE WHEN na * nb > 0 THEN dotp / (na * nb) ELSE 0.0 END, 9) AS score,
                  round(-dist, 9) AS rerank FROM vecs)"""


def build() -> dict[str, str]:
    kws = TD.TEST_RELEVANCE_KEYWORDS
    acts = TD.TEST_ACTION_WORDS
    q: dict[str, str] = {}
    base = with_(DOCS, JOBS, PAGES)
    jbase = with_(DOCS, JOBS, PAGES, JPAGES)

    q["q_collections"] = with_(DOCS, JOBS) + "SELECT collection, persona, task FROM jobs WHERE collection IN (SELECT collection FROM docs)"
    specs = f"""specs AS (
  SELECT item_id, 'src' || item_id AS collection, 'file:/root/src' || item_id || '/challenge1b_input.json' AS path, text AS task, item_id % 7 AS k, item_id % 4 + 1 AS n
  FROM benchmark)"""
    q["q_job_specs"] = with_(specs) + f"SELECT collection, {_q(TD.TEST_PERSONA)} AS persona, md5(task) AS task_md5, CAST(n AS BIGINT) AS n_listed FROM specs WHERE k NOT IN (2, 4, 5)"
    q["q_bad_specs"] = with_(specs) + (
        "SELECT collection, path, CASE k WHEN 2 THEN 'malformed json' WHEN 4 THEN 'missing persona.role' ELSE 'missing job_to_be_done.task' END AS reason "
        "FROM specs WHERE k IN (2, 4, 5)"
    )
    q["q_manifest"] = with_(specs) + (
        "SELECT collection, CAST(i AS BIGINT) AS doc_ord, 'f' || i || '.txt' AS filename, 't' AS title "
        "FROM (SELECT collection, unnest(range(n)) AS i FROM specs WHERE k NOT IN (2, 4, 5)) x"
    )
    q["q_failed_documents"] = """
WITH d AS (SELECT *, 'c' || (page_id % 8) AS collection, page_id || '.html' AS filename FROM pages)
SELECT collection, filename, CAST(p AS BIGINT) AS page_number, md5(CASE p WHEN 1 THEN substr(html, 1, 500) ELSE substr(html, 501) END) AS text_md5, NULL::VARCHAR AS error
FROM d, (VALUES (1), (2)) v(p) WHERE page_id % 10 <> 3
UNION ALL
SELECT collection, filename, NULL, NULL, 'unreadable' FROM d WHERE page_id % 10 = 3"""
    ft = [fill(t, doc_type=doc_type("filename"), task="task", persona="persona") for t in T.FALLBACK_TITLE_TEMPLATES]
    q["q_fallback_titles"] = with_(DOCS, JOBS) + (
        f"SELECT collection, CAST(doc_id AS BIGINT) AS doc_id, {ft[0]} AS title_1, md5({ft[1]}) AS title_2_md5, {ft[2]} AS title_3 FROM docs JOIN jobs USING (collection)"
    )
    q["q_pages"] = base + "SELECT collection, CAST(doc_id AS BIGINT) AS doc_id, page_number, page_seq, CAST(length(text) AS BIGINT) AS n_chars, md5(text) AS text_md5 FROM pages"
    q["q_first_pages"] = base + "SELECT collection, CAST(doc_id AS BIGINT) AS doc_id, page_number, page_seq FROM pages WHERE page_seq <= 5"
    q["q_lines"] = base + (
        "SELECT collection, CAST(doc_id AS BIGINT) AS doc_id, page_number, "
        "CAST(len(string_split(text, chr(10))) AS BIGINT) AS n_lines, "
        f"CAST(len(list_filter(string_split(text, chr(10)), lambda l: {strip('l')} = '')) AS BIGINT) AS n_blank_lines FROM pages"
    )
    q["q_missing_docs"] = with_(DOCS) + "SELECT collection, CAST(doc_id AS BIGINT) AS doc_id, filename FROM docs WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE doc_id IS NOT NULL)"
    q["q_textless_docs"] = with_(DOCS) + (
        "SELECT collection, CAST(doc_id AS BIGINT) AS doc_id, filename FROM docs WHERE NOT regexp_matches("
        "CASE doc_id % 3 WHEN 0 THEN regexp_replace(text, '[^ \\n]', '', 'g') WHEN 1 THEN regexp_replace(text, '[^ \\n0-9]', '', 'g') ELSE text END, '[^\\s]')"
    )
    q["q_input_documents"] = with_(DOCS, JOBS) + (
        "SELECT collection, CAST(doc_ord AS BIGINT) AS doc_ord, filename FROM docs WHERE collection IN (SELECT collection FROM jobs)"
    )
    q["q_no_output"] = with_(DOCS, JOBS) + "SELECT collection FROM jobs WHERE collection NOT IN (SELECT collection FROM docs)"
    q["q_doc_type"] = with_(DOCS) + f"SELECT collection, CAST(doc_id AS BIGINT) AS doc_id, filename, {doc_type('filename')} AS doc_type FROM docs"
    q["q_query_text"] = with_(JOBS) + "SELECT collection, query FROM jobs"
    q["q_doc_text"] = with_(DOCS, "td AS (SELECT *, " + doc_type("filename") + " AS doc_type FROM docs)") + (
        f"SELECT collection, CAST(doc_id AS BIGINT) AS doc_id, {fill(T.RETRIEVAL_TEMPLATE, filename='filename', doc_type='doc_type')} AS retrieval_text, "
        f"{fill(T.RERANK_TEMPLATE, filename='filename', doc_type='doc_type')} AS rerank_text FROM td"
    )
    rel_p = fill(T.RELEVANCE_PROMPT_TEMPLATE, filename="filename", persona="persona", task="task", context=f"substr(text, 1, {T.RELEVANCE_CONTEXT_CHARS})")
    sum_p = fill(T.SUMMARY_PROMPT_TEMPLATE, doc_type="doc_type", persona="persona", task="task", context=f"substr(text, 1, {T.SUMMARY_CONTEXT_CHARS})")
    tit_p = fill(T.TITLES_PROMPT_TEMPLATE, doc_type="doc_type", persona="persona", task="task")
    q["q_prompts"] = jbase + (
        f"SELECT collection, CAST(doc_id AS BIGINT) AS doc_id, page_number, md5({rel_p}) AS relevance_prompt_md5, "
        f"CAST(length({rel_p}) AS BIGINT) AS relevance_prompt_len, md5({sum_p}) AS summary_prompt_md5, "
        f"CAST(length({sum_p}) AS BIGINT) AS summary_prompt_len, md5({tit_p}) AS titles_prompt_md5 FROM fp"
    )
    q["q_generation_requests"] = with_(DOCS, JOBS, PAGES, JPAGES, headings_ctes("pages")) + f"""
SELECT d.collection, CAST(d.doc_id AS BIGINT) AS doc_id, CAST(NULL AS BIGINT) AS page_number, 'titles' AS kind, md5({tit_p}) AS prompt_md5
FROM jdocs d
WHERE EXISTS (SELECT 1 FROM pages p WHERE p.collection = d.collection AND p.doc_id = d.doc_id)
  AND NOT EXISTS (SELECT 1 FROM titles t WHERE t.collection = d.collection AND t.doc_id = d.doc_id)
UNION ALL
SELECT collection, CAST(doc_id AS BIGINT), page_number, 'relevance', md5({rel_p}) FROM fp
WHERE length(text) >= {T.MIN_RELEVANT_PAGE_CHARS} AND NOT {contains_any('text', kws)}
UNION ALL
SELECT collection, CAST(doc_id AS BIGINT), page_number, 'summary', md5({sum_p}) FROM fp
WHERE length(text) >= {T.MIN_RELEVANT_PAGE_CHARS} AND {contains_any('text', kws)} AND {key_lines('text', acts)} IS NULL"""
    q["q_clean"] = with_(responses_cte()) + f"SELECT CAST(conv_id AS BIGINT) AS conv_id, CAST(turn AS BIGINT) AS turn, role, {clean('response')} AS cleaned FROM responses"
    resp = "CASE WHEN conv_id % 2 = 0 THEN '1. ' || replace(text, chr(10), chr(10) || '2. ') ELSE text END"
    tl = (
        f"list_slice(list_filter(list_transform(string_split({resp}, chr(10)), "
        f"lambda l: {strip("regexp_replace(l, '^[0-9.*-]+', '')")}), "
        f"lambda l: length(l) > {T.TITLE_MIN} AND length(l) < {T.TITLE_MAX}), 1, {T.MAX_TITLES})"
    )
    q["q_title_parse"] = (
        f"SELECT CAST(conv_id AS BIGINT) AS conv_id, CAST(turn AS BIGINT) AS turn, role, CAST(len({tl}) AS BIGINT) AS n_titles, "
        f"array_to_string({tl}, '|') AS titles FROM conversations"
    )
    q["q_verdict"] = with_(responses_cte()) + (
        f"SELECT CAST(conv_id AS BIGINT) AS conv_id, CAST(turn AS BIGINT) AS turn, role, "
        f"CAST(CASE WHEN contains(lower({clean('response')}), {_q(C.VERDICT_WORD)}) THEN 1 ELSE 0 END AS BIGINT) AS verdict FROM responses"
    )
    q["q_headings"] = with_(DOCS, PAGES, headings_ctes("pages")) + (
        "SELECT d.collection, CAST(d.doc_id AS BIGINT) AS doc_id, CAST(count(t.title) AS BIGINT) AS n_titles, "
        "coalesce(string_agg(t.title, '|' ORDER BY t.rn), '') AS titles, min(t.title) FILTER (WHERE t.rn = 1) AS best_title "
        "FROM docs d LEFT JOIN (SELECT * FROM titles WHERE rn <= 3) t USING (collection, doc_id) GROUP BY d.collection, d.doc_id"
    )
    q["q_section_page"] = with_(
        DOCS, JOBS, PAGES, JPAGES, headings_ctes("pages"),
        f"""titled AS (SELECT d.collection, d.doc_id, coalesce(h.title, {fill(T.FALLBACK_TITLE_TEMPLATES[0], doc_type='d.doc_type')}) AS section_title
           FROM jdocs d JOIN (SELECT DISTINCT collection, doc_id FROM pages) ht USING (collection, doc_id)
           LEFT JOIN (SELECT * FROM titles WHERE rn = 1) h USING (collection, doc_id))""",
        section_page_ctes("titled"),
    ) + "SELECT t.collection, CAST(t.doc_id AS BIGINT) AS doc_id, t.section_title, s.page_number FROM titled t JOIN spage s USING (collection, doc_id)"
    q["q_section_page_job"] = with_(
        DOCS, JOBS, PAGES, JPAGES,
        """titled AS (SELECT d.collection, d.doc_id, d.task AS section_title
           FROM jdocs d JOIN (SELECT DISTINCT collection, doc_id FROM pages) ht USING (collection, doc_id))""",
        section_page_ctes("titled"),
    ) + "SELECT collection, CAST(doc_id AS BIGINT) AS doc_id, page_number FROM spage"
    q["q_relevant_pages"] = jbase + (
        f"SELECT collection, CAST(doc_id AS BIGINT) AS doc_id, page_number, page_seq FROM fp "
        f"WHERE length(text) >= {T.MIN_RELEVANT_PAGE_CHARS} AND {contains_any('text', kws)}"
    )
    q["q_relevant_pages_sim"] = jbase + (
        f"SELECT collection, CAST(doc_id AS BIGINT) AS doc_id, page_number, CAST({contains_any('text', kws)} AS BIGINT) AS by_keyword, "
        f"round(round({overlap('text', 'query')}, 9), 6) AS overlap FROM fp "
        f"WHERE length(text) >= {T.MIN_RELEVANT_PAGE_CHARS} AND ({contains_any('text', kws)} OR round({overlap('text', 'query')}, 9) >= {C.TEST_MIN_OVERLAP})"
    )
    q["q_key_lines"] = jbase + (
        f"SELECT collection, CAST(doc_id AS BIGINT) AS doc_id, page_number, key_text FROM "
        f"(SELECT *, {key_lines('text', acts)} AS key_text FROM fp) x WHERE key_text IS NOT NULL"
    )
    q["q_summary_sentences"] = jbase + (
        f"SELECT collection, CAST(doc_id AS BIGINT) AS doc_id, page_number, summary FROM "
        f"(SELECT *, {summary('text', 'query')} AS summary FROM fp) x WHERE summary IS NOT NULL"
    )
    sbase = with_(DOCS, JOBS, "rdocs AS (SELECT collection, doc_id, text FROM docs)", tfidf("rdocs"),
                  "scored AS (SELECT s.*, d.doc_ord FROM scores s JOIN docs d USING (collection, doc_id))")
    q["q_tfidf"] = sbase + "SELECT collection, CAST(doc_id AS BIGINT) AS doc_id, round(score, 6) AS score, round(overlap, 6) AS overlap FROM scored"
    q["q_rank_documents"] = sbase.rstrip("\n") + ",\n" + hybrid("scored") + "\n" + (
        "SELECT collection, CAST(doc_id AS BIGINT) AS doc_id, round(score, 6) AS score, CAST(bi_rank AS BIGINT) AS bi_rank FROM r1"
    )
    q["q_hybrid_rank"] = sbase.rstrip("\n") + ",\n" + hybrid("scored") + "\n" + (
        "SELECT collection, CAST(doc_id AS BIGINT) AS doc_id, CAST(bi_rank AS BIGINT) AS bi_rank, round(final_score, 6) AS final_score, "
        "CAST(importance_rank AS BIGINT) AS importance_rank FROM ranked"
    )
    ret = fill(T.RETRIEVAL_TEMPLATE, filename="filename", doc_type="doc_type")
    rer = fill(T.RERANK_TEMPLATE, filename="filename", doc_type="doc_type")
    q["q_template_rank"] = with_(
        DOCS, JOBS,
        f"td AS (SELECT *, {doc_type('filename')} AS doc_type FROM docs)",
        f"rdocs AS (SELECT collection, doc_id, {ret} AS text FROM td)",
        tfidf("rdocs"),
        f"""scored AS (SELECT s.collection, s.doc_id, s.score, t.doc_ord,
                   round({overlap(rer, 'j.query')}, 9) AS rerank
            FROM scores s JOIN td t USING (collection, doc_id) JOIN jobs j USING (collection))""",
        hybrid("scored", rerank="rerank"),
    ) + (
        "SELECT collection, CAST(doc_id AS BIGINT) AS doc_id, round(score, 6) AS score, round(rerank, 6) AS rerank, "
        "CAST(bi_rank AS BIGINT) AS bi_rank, CAST(importance_rank AS BIGINT) AS importance_rank FROM ranked"
    )
    q["q_rank_lookup"] = with_(
        "docs AS (SELECT source AS collection, doc_id, doc_id AS doc_ord, substr(md5(coalesce(text, '')), 1, 12) || '.txt' AS filename, coalesce(text, '') AS text FROM documents)",
        JOBS,
        "rdocs AS (SELECT collection, doc_id, text FROM docs WHERE doc_id IN (SELECT doc_id FROM labels))",
        tfidf("rdocs"),
        """rk AS (SELECT s.collection, d.filename, row_number() OVER (PARTITION BY s.collection ORDER BY s.score DESC, d.doc_ord, d.doc_id) AS r
        FROM scores s JOIN docs d USING (collection, doc_id)),
byname AS (SELECT collection, filename, max(r) AS r FROM rk GROUP BY collection, filename),
n AS (SELECT collection, count(*) AS n FROM docs GROUP BY collection)""",
    ) + (
        "SELECT d.collection, CAST(d.doc_id AS BIGINT) AS doc_id, d.filename, CAST(coalesce(b.r, n.n + 1) AS BIGINT) AS importance_rank "
        "FROM docs d JOIN n USING (collection) LEFT JOIN byname b USING (collection, filename)"
    )
    vb = with_(vectors_ctes())
    q["q_cosine"] = vb + "SELECT CAST(label AS BIGINT) AS label, CAST(vec_id AS BIGINT) AS vec_id, round(score, 6) AS score FROM vscore"
    q["q_rank_threshold"] = vb + (
        f"SELECT CAST(label AS BIGINT) AS label, CAST(vec_id AS BIGINT) AS vec_id, round(score, 6) AS score, "
        f"CAST(row_number() OVER (PARTITION BY label ORDER BY score DESC, vec_id) AS BIGINT) AS rank FROM vscore WHERE score >= {C.SIMILARITY_THRESHOLD}"
    )
    q["q_hybrid_rank_vec"] = vb.rstrip("\n") + ",\n" + hybrid("vscore", group="label", ord_col="vec_id", key="vec_id", rerank="rerank") + "\n" + (
        "SELECT CAST(label AS BIGINT) AS label, CAST(vec_id AS BIGINT) AS vec_id, CAST(bi_rank AS BIGINT) AS bi_rank, "
        "round(final_score, 6) AS final_score, CAST(importance_rank AS BIGINT) AS importance_rank FROM ranked"
    )
    vcut = "cutoff AS (SELECT * FROM vscore WHERE score >= " + str(C.SIMILARITY_THRESHOLD) + "),\n"
    q["q_rank_vectors"] = vb.rstrip("\n") + ",\n" + vcut + hybrid("cutoff", group="label", ord_col="vec_id", key="vec_id", rerank="rerank") + "\n" + (
        "SELECT 'label' || label AS collection, CAST(vec_id AS BIGINT) AS doc_id, round(score, 6) AS score, "
        "round(final_score, 6) AS final_score, CAST(importance_rank AS BIGINT) AS importance_rank FROM ranked"
    )
    k1, b = C.TEST_CONFIG.bm25_k1, C.TEST_CONFIG.bm25_b
    q["q_rank_bm25"] = with_(
        DOCS, JOBS, "jdocs AS (SELECT d.* FROM docs d JOIN jobs j USING (collection))", "rdocs AS (SELECT collection, doc_id, text FROM jdocs)", tfidf("rdocs"),
        f"""lens AS (SELECT collection, doc_id, count(*) AS len FROM dterm GROUP BY collection, doc_id),
means AS (SELECT n.collection, n_docs, CAST(sum(len) AS DOUBLE) / n_docs AS mean FROM ndocs n LEFT JOIN lens USING (collection) GROUP BY n.collection, n_docs),
bm AS (SELECT dt.collection, dt.doc_id, round(sum(ln(1 + (n_docs - df + 0.5) / (df + 0.5)) * tf * ({k1} + 1) / (tf + {k1} * (1 - {b} + {b} * len / mean))), 9) AS bm25
       FROM dt JOIN qt USING (collection, term) JOIN dfreq USING (collection, term) JOIN lens USING (collection, doc_id) JOIN means USING (collection)
       GROUP BY dt.collection, dt.doc_id),
scored AS (SELECT s.*, d.doc_ord, coalesce(bm25, 0.0) AS rerank FROM scores s JOIN jdocs d USING (collection, doc_id) LEFT JOIN bm USING (collection, doc_id))""",
        hybrid("scored", rerank="rerank"),
    ) + (
        "SELECT collection, CAST(doc_id AS BIGINT) AS doc_id, CASE WHEN bi_rank <= 10 THEN round(rerank, 6) END AS rerank, "
        "round(final_score, 6) AS final_score, CAST(importance_rank AS BIGINT) AS importance_rank FROM ranked"
    )
    q["q_sections_min_similarity"] = with_(DOCS, JOBS, "jdocs AS (SELECT d.* FROM docs d JOIN jobs j USING (collection))",
                                           "rdocs AS (SELECT collection, doc_id, text FROM jdocs)", tfidf("rdocs")) + (
        "SELECT collection, CAST(doc_id AS BIGINT) AS doc_id, CAST(row_number() OVER (PARTITION BY collection ORDER BY score DESC, doc_id) AS BIGINT) AS importance_rank "
        f"FROM scores WHERE score >= {C.TEST_MIN_SIMILARITY}"
    )
    q["q_sections_first_stage"] = analysis_ctes(rerank=False) + "SELECT collection, document, section_title, importance_rank, page_number FROM sections"
    sub = "SELECT collection, document, refined_text, page_number, importance_rank FROM subsections"
    q["q_subsections_overlap"] = analysis_ctes(min_overlap=C.TEST_MIN_OVERLAP) + sub
    q["q_subsections_restricted"] = analysis_ctes(restrict=True) + sub
    pl = analysis_ctes()
    q["q_sections"] = pl + "SELECT collection, document, section_title, importance_rank, page_number FROM sections"
    q["q_sections_from_pages"] = q["q_sections_from_files"] = q["q_sections"]
    q["q_sections_default"] = analysis_ctes(default=True) + (
        "SELECT collection, document, section_title, importance_rank, page_number FROM sections "
        "UNION ALL SELECT collection, document, refined_text, importance_rank, page_number FROM subsections"
    )
    q["q_subsections"] = pl + "SELECT collection, document, refined_text, page_number, importance_rank FROM subsections"
    results = pl.rstrip("\n") + """,
nd AS (SELECT collection, count(*) AS n FROM jdocs GROUP BY collection),
sa AS (SELECT collection, count(*) AS n_sections,
              string_agg(document || '#' || CAST(page_number AS VARCHAR), '|' ORDER BY importance_rank, doc_ord, doc_id) AS section_keys
       FROM sections GROUP BY collection),
ua AS (SELECT collection, count(*) AS n_subsections,
              string_agg(document || '#' || CAST(page_number AS VARCHAR), '|' ORDER BY importance_rank, page_number, doc_ord, doc_id) AS subsection_keys
       FROM subsections GROUP BY collection)
SELECT j.collection, j.persona, md5(j.task) AS task_md5, CAST(nd.n AS BIGINT) AS n_input_documents,
       CAST(coalesce(sa.n_sections, 0) AS BIGINT) AS n_sections, CAST(coalesce(ua.n_subsections, 0) AS BIGINT) AS n_subsections,
       coalesce(sa.section_keys, '') AS section_keys, coalesce(ua.subsection_keys, '') AS subsection_keys
FROM jobs j JOIN nd USING (collection) LEFT JOIN sa USING (collection) LEFT JOIN ua USING (collection)"""
    # the input documents too, in manifest order
    q["q_result_document"] = results.replace(
        "nd AS (SELECT collection, count(*) AS n FROM",
        "nd AS (SELECT collection, count(*) AS n, string_agg(filename, '|' ORDER BY doc_ord NULLS FIRST, doc_id NULLS FIRST, filename) AS names FROM",
    ).replace("AS subsection_keys\nFROM jobs", "AS subsection_keys,\n       coalesce(nd.names, '') AS input_documents\nFROM jobs")
    q["q_written_results"] = "SELECT *, CAST(1 AS BIGINT) AS n_results FROM (" + results + ") r"
    q["q_counts"] = pl.rstrip("\n") + """,
pd AS (SELECT d.collection, count(*) AS n_documents, count(h.doc_id) AS n_with_text
       FROM jdocs d LEFT JOIN has_text h USING (collection, doc_id) GROUP BY d.collection),
nc AS (SELECT collection, count(*) AS n FROM rel WHERE refined_text IS NOT NULL AND refined_text <> '' GROUP BY collection),
ns AS (SELECT collection, count(*) AS n FROM sections GROUP BY collection),
nu AS (SELECT collection, count(*) AS n FROM subsections GROUP BY collection)
SELECT pd.collection, CAST(n_documents AS BIGINT) AS n_documents, CAST(n_with_text AS BIGINT) AS n_with_text,
       CAST(coalesce(ns.n, 0) AS BIGINT) AS n_sections, CAST(coalesce(nc.n, 0) AS BIGINT) AS n_candidates,
       CAST(coalesce(nu.n, 0) AS BIGINT) AS n_subsections
FROM pd LEFT JOIN nc USING (collection) LEFT JOIN ns USING (collection) LEFT JOIN nu USING (collection)"""
    return q


ORACLE_SQL = build()
