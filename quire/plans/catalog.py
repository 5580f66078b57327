"""Registered queries: one callable per operator of the inventory.

Each callable takes ``(spark, sf_dir)``, reads the driver's tables and returns
a DataFrame whose work grows with those tables.  Integer outputs are bigint,
scores are rounded to 6 decimals, so results compare exactly with the DuckDB
oracle in ``quire.plans.oracle``.
"""

from __future__ import annotations

import dataclasses
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.functions import text as T
from quire.operators import extract as X
from quire.operators import pages as P
from quire.operators import similarity as S
from quire.operators.ranking import bounded_broadcast, hybrid_rank, rank_documents, rank_lookup, rank_within
from quire.plans import analysis as PL
from quire.session import checkpoint_dir, materialize
from quire.sources import collections as CO
from quire.sources import sinks
from quire.sources import testdata as TD

TEST_CONFIG = PL.JobConfig(
    relevance_keywords=TD.TEST_RELEVANCE_KEYWORDS,
    action_words=TD.TEST_ACTION_WORDS,
    lines_per_page=TD.LINES_PER_PAGE,
    rank_text="body",
    rerank=True,
)
# Page relevance fallback: share of distinct job terms found on the page.
TEST_MIN_OVERLAP = 0.1
# Documented first-stage cut-off.
SIMILARITY_THRESHOLD = 0.3
# First-stage cut-off of the pipeline run on document texts.
TEST_MIN_SIMILARITY = 0.05
# Verdict word.
VERDICT_WORD = "yes"


def _big(c):
    return F.col(c).cast("bigint") if isinstance(c, str) else c.cast("bigint")


def _r6(c):
    return F.round(F.col(c) if isinstance(c, str) else c, 6)


def _docs(spark, sf):
    return TD.docs(spark, sf)


def _jobs(spark, sf):
    return TD.jobs(spark, sf)


def _pages(spark, sf):
    return P.page_table(_docs(spark, sf), keys=("collection", "doc_id", "doc_ord", "filename"), lines_per_page=TD.LINES_PER_PAGE)


# --------------------------------------------------------------------------- sources / ingestion

def q_collections(spark, sf):
    """SRC1: collections having both a job and documents."""
    return CO.discover(_jobs(spark, sf), _docs(spark, sf)).select("collection", "persona", "task")


def _raw_specs(spark, sf):
    """Job specs as their JSON text, serialised from ``benchmark``: of every
    seven the third is cut short, the fifth lacks its persona and the sixth its
    task; documents are those of the source of the same number."""
    b = TD.table(spark, sf, "benchmark").select("item_id", "text")
    k = F.col("item_id") % 7
    spec = F.to_json(F.struct(
        F.struct(F.lit("c").alias("challenge_id"), F.col("item_id").cast("string").alias("test_case_name")).alias("challenge_info"),
        F.transform(F.sequence(F.lit(0), (F.col("item_id") % 4).cast("int")), lambda i: F.struct(F.concat(F.lit("f"), i, F.lit(".txt")).alias("filename"), F.lit("t").alias("title"))).alias("documents"),
        F.when(k != 4, F.struct(F.lit(TD.TEST_PERSONA).alias("role"))).alias("persona"),
        F.when(k != 5, F.struct(F.col("text").alias("task"))).alias("job_to_be_done"),
    ))
    return b.select(F.when(k == 2, F.left(spec, F.length(spec) - 5)).otherwise(spec).alias("json"), F.format_string("file:/root/src%d/challenge1b_input.json", "item_id").alias("path"))


def _specs(spark, sf):
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"}
    raw = _raw_specs(spark, sf).select(F.from_json("json", CO.SPEC_SCHEMA, options).alias("s"), "path")
    return CO.split_specs(raw.select("s.*", "path"))


def q_job_specs(spark, sf):
    """SRC2: good job specs."""
    good, _ = _specs(spark, sf)
    return good.select("collection", "persona", F.md5("task").alias("task_md5"), _big(F.size("documents")).alias("n_listed"))


def q_bad_specs(spark, sf):
    """SRC8: specs that stop at their own collection, with the reason."""
    _, bad = _specs(spark, sf)
    return bad.select("collection", "path", "reason")


def q_manifest(spark, sf):
    """SRC3: listed documents in list order."""
    good, _ = _specs(spark, sf)
    return CO.manifest(good).select("collection", "doc_ord", "filename", "title")


def q_failed_documents(spark, sf):
    """SRC7: documents with a page that could not be read go as a whole (web
    pages as documents of two pages; the second fails where its id ends in 3)."""
    p = TD.table(spark, sf, "pages")
    halves = F.array(F.left("html", F.lit(500)), F.when(F.col("page_id") % 10 != 3, F.substring("html", 501, 1 << 30)))
    rows = p.select(F.concat(F.lit("c"), F.col("page_id") % 8).alias("collection"), F.concat("page_id", F.lit(".html")).alias("filename"), F.posexplode(halves).alias("i", "text"))
    parsed = rows.select("collection", "filename", (F.col("i") + 1).alias("page_number"), "text", F.when(F.col("text").isNull(), F.lit("unreadable")).alias("error"))
    good, failed = CO.split_page_errors(parsed)
    shown = good.select("collection", "filename", _big("page_number").alias("page_number"), F.md5("text").alias("text_md5"), F.lit(None).cast("string").alias("error"))
    return shown.unionByName(failed.select("collection", "filename", "error"), allowMissingColumns=True)


def q_fallback_titles(spark, sf):
    """PRJ11: the three titles used where a document has no heading."""
    d = PL.with_job(_docs(spark, sf).withColumn("doc_type", T.document_type("filename")).drop("text"), PL.jobs_with_query(_jobs(spark, sf)), "persona", "task")
    titles = P.fallback_titles("doc_type", "task", "persona")
    return d.select("collection", _big("doc_id").alias("doc_id"), F.get(titles, 0).alias("title_1"), F.md5(F.get(titles, 1)).alias("title_2_md5"), F.get(titles, 2).alias("title_3"))


def q_pages(spark, sf):
    """SRC4/PRJ2/FLT1: non-blank stripped pages."""
    p = _pages(spark, sf)
    return p.select(
        "collection", _big("doc_id").alias("doc_id"), _big("page_number").alias("page_number"),
        _big("page_seq").alias("page_seq"), _big(F.length("text")).alias("n_chars"), F.md5("text").alias("text_md5"),
    )


def q_first_pages(spark, sf):
    """WN5: first five non-blank pages."""
    d = _docs(spark, sf)
    first = d.select("collection", "doc_id", P.first_pages(P.page_array("text", TD.LINES_PER_PAGE), 5).alias("pages"))
    p = P.explode_pages(first, ["collection", "doc_id"])
    return p.select("collection", _big("doc_id").alias("doc_id"), _big("page_number").alias("page_number"), _big("page_seq").alias("page_seq"))


def q_lines(spark, sf):
    """PRJ3: lines per page and blank lines among them."""
    p = _pages(spark, sf)
    lines = P.lines_of("text")
    return p.select(
        "collection", _big("doc_id").alias("doc_id"), _big("page_number").alias("page_number"),
        _big(F.size(lines)).alias("n_lines"), _big(F.size(F.filter(lines, lambda l: l == ""))).alias("n_blank_lines"),
    )


def q_missing_docs(spark, sf):
    """SRC5: manifest entries whose file is absent (files = labelled documents)."""
    d = _docs(spark, sf)
    present = d.join(TD.present_files(spark, sf), "doc_id", "left_semi")
    return CO.missing_documents(d, present).select("collection", _big("doc_id").alias("doc_id"), "filename")


def q_textless_docs(spark, sf):
    """SRC6: documents without any non-blank page.  A third of the texts are
    reduced to their blanks and another third to their blanks and digits, so
    that there are such documents."""
    d = _docs(spark, sf)
    kept = F.when(F.col("doc_id") % 3 == 0, F.regexp_replace("text", "[^ \\n]", "")).when(F.col("doc_id") % 3 == 1, F.regexp_replace("text", "[^ \\n0-9]", "")).otherwise(F.col("text"))
    pages = P.once(d.withColumn("text", kept), "n_pages", F.size(P.page_array("text", TD.LINES_PER_PAGE)))
    return pages.where("n_pages = 0").select("collection", _big("doc_id").alias("doc_id"), "filename")


def q_input_documents(spark, sf):
    """AG5: the input documents of each collection with a job, in manifest
    order, as rows (what the sink writes next to each result)."""
    d = _docs(spark, sf).join(_jobs(spark, sf).select("collection"), "collection", "left_semi")
    return d.select("collection", _big("doc_ord").alias("doc_ord"), "filename")


def q_no_output(spark, sf):
    """SNK3: jobs whose collection produced no result (no documents)."""
    # a result has a row for every collection with a job and documents
    return sinks.collections_without_output(_jobs(spark, sf), _docs(spark, sf))


# --------------------------------------------------------------------------- projections

def q_doc_type(spark, sf):
    """PRJ1."""
    d = _docs(spark, sf)
    return d.select("collection", _big("doc_id").alias("doc_id"), "filename", T.document_type("filename").alias("doc_type"))


def q_query_text(spark, sf):
    """PRJ5."""
    return PL.jobs_with_query(_jobs(spark, sf)).select("collection", "query")


def q_doc_text(spark, sf):
    """PRJ6/PRJ7: retrieval and re-rank texts from file name and type."""
    d = _docs(spark, sf).withColumn("doc_type", T.document_type("filename"))
    return d.select(
        "collection", _big("doc_id").alias("doc_id"),
        T.fill(T.RETRIEVAL_TEMPLATE, filename="filename", doc_type="doc_type").alias("retrieval_text"),
        T.fill(T.RERANK_TEMPLATE, filename="filename", doc_type="doc_type").alias("rerank_text"),
    )


def q_prompts(spark, sf):
    """PRJ8: prompt table for an external generator (first five pages)."""
    d = PL.prepare(_docs(spark, sf), _jobs(spark, sf), TEST_CONFIG)
    keys = ["collection", "doc_id", "filename", "doc_type"]
    first = d.select(*keys, P.first_pages(P.page_array("text", TD.LINES_PER_PAGE), 5).alias("pages"))
    p = PL.with_job(P.explode_pages(first, keys), PL.jobs_with_query(_jobs(spark, sf)), "persona", "task")
    rel = T.fill(T.RELEVANCE_PROMPT_TEMPLATE, filename="filename", persona="persona", task="task",
                 context=F.substring("text", 1, T.RELEVANCE_CONTEXT_CHARS))
    summ = T.fill(T.SUMMARY_PROMPT_TEMPLATE, doc_type="doc_type", persona="persona", task="task",
                  context=F.substring("text", 1, T.SUMMARY_CONTEXT_CHARS))
    titles = T.fill(T.TITLES_PROMPT_TEMPLATE, doc_type="doc_type", persona="persona", task="task")
    return p.select(
        "collection", _big("doc_id").alias("doc_id"), _big("page_number").alias("page_number"),
        F.md5(rel).alias("relevance_prompt_md5"), _big(F.length(rel)).alias("relevance_prompt_len"),
        F.md5(summ).alias("summary_prompt_md5"), _big(F.length(summ)).alias("summary_prompt_len"),
        F.md5(titles).alias("titles_prompt_md5"),
    )


def q_generation_requests(spark, sf):
    """PRJ8/PL3/FLT8/VS5 contract: prompts only where the pipeline would ask a generator."""
    feats = PL.features(PL.prepare(_docs(spark, sf), _jobs(spark, sf), TEST_CONFIG), TEST_CONFIG)
    r = PL.generation_requests(feats, TEST_CONFIG, PL.jobs_with_query(_jobs(spark, sf)))
    return r.select("collection", _big("doc_id").alias("doc_id"), _big("page_number").alias("page_number"), "kind",
                    F.md5("prompt").alias("prompt_md5"))


def _responses(spark, sf):
    """All turns as generator responses; a prefix is chosen from the turn
    number so every cleaning branch is exercised."""
    c = TD.table(spark, sf, "conversations")
    prefixes = F.array(*[F.lit(x) for x in ["", 'Answer: "', "Summary: Response: ", "Context: '", "Information:", ' "']])
    return c.select("conv_id", "turn", "role", F.concat(F.element_at(prefixes, (F.col("turn") % 6 + 1).cast("int")), F.col("text")).alias("response"))


def q_clean(spark, sf):
    """PRJ9."""
    r = _responses(spark, sf)
    return r.select(_big("conv_id").alias("conv_id"), _big("turn").alias("turn"), "role", T.clean_response("response").alias("cleaned"))


def q_title_parse(spark, sf):
    """PRJ10/FLT10: title list from the raw multi-line response (numbered on even conversations)."""
    c = TD.table(spark, sf, "conversations")
    resp = F.when(F.col("conv_id") % 2 == 0, F.concat(F.lit("1. "), F.regexp_replace("text", "\n", "\n2. "))).otherwise(F.col("text"))
    titles = T.parse_titles(resp)
    return c.select(
        _big("conv_id").alias("conv_id"), _big("turn").alias("turn"), "role",
        _big(F.size(titles)).alias("n_titles"), F.array_join(titles, "|").alias("titles"),
    )


def q_verdict(spark, sf):
    """PRJ13: yes/no verdict of a response."""
    r = _responses(spark, sf)
    return r.select(_big("conv_id").alias("conv_id"), _big("turn").alias("turn"), "role",
                    _big(T.verdict(T.clean_response("response"), VERDICT_WORD).cast("int")).alias("verdict"))


# --------------------------------------------------------------------------- pages / headings

def q_headings(spark, sf):
    """PL2: up to three headings per document and the best one."""
    d = _docs(spark, sf)
    t = d.select("collection", "doc_id", P.heading_titles(P.page_array("text", TD.LINES_PER_PAGE)).alias("titles"))
    return t.select(
        "collection", _big("doc_id").alias("doc_id"), _big(F.size("titles")).alias("n_titles"),
        F.array_join("titles", "|").alias("titles"), F.get("titles", 0).alias("best_title"),
    )


def _paged(spark, sf):
    """Documents with text, their pages computed once."""
    d = PL.prepare(_docs(spark, sf), _jobs(spark, sf), TEST_CONFIG)
    return P.once(d, "pages", P.page_array("text", TD.LINES_PER_PAGE)).where(F.size("pages") > 0)


def q_section_page(spark, sf):
    """PL4/PL3: best title (heading, else the fallback template) and its page, every document with text."""
    d = _paged(spark, sf)
    title = F.coalesce(F.get(P.heading_titles("pages"), 0), T.fill(T.FALLBACK_TITLE_TEMPLATES[0], doc_type="doc_type"))
    d = d.withColumn("section_title", title)
    return d.select("collection", _big("doc_id").alias("doc_id"), "section_title",
                    _big(P.section_page("pages", "section_title")).alias("page_number"))


def q_section_page_job(spark, sf):
    """PL4 with the job text as title: exercises the word-count branch."""
    d = PL.with_job(_paged(spark, sf), PL.jobs_with_query(_jobs(spark, sf)), "task")
    return d.select("collection", _big("doc_id").alias("doc_id"), _big(P.section_page("pages", "task")).alias("page_number"))


# --------------------------------------------------------------------------- relevance / extraction

def _first_page_rows(spark, sf):
    d = PL.prepare(_docs(spark, sf), _jobs(spark, sf), TEST_CONFIG)
    keys = ["collection", "doc_id", "doc_type"]
    first = d.select(*keys, P.first_pages(P.page_array("text", TD.LINES_PER_PAGE), 5).alias("pages"))
    return PL.with_job(P.explode_pages(first, keys), PL.jobs_with_query(_jobs(spark, sf)), "task", "query")


def q_relevant_pages(spark, sf):
    """PL5/FLT4/FLT5: keyword relevance of the first five pages."""
    p = _first_page_rows(spark, sf)
    return p.where(X.keyword_relevant("text", TD.TEST_RELEVANCE_KEYWORDS)).select(
        "collection", _big("doc_id").alias("doc_id"), _big("page_number").alias("page_number"), _big("page_seq").alias("page_seq")
    )


def q_relevant_pages_sim(spark, sf):
    """FLT8: pages relevant by keyword or, failing that, by job-term overlap."""
    p = P.once(_first_page_rows(spark, sf), "overlap", F.round(S.term_overlap("text", "query"), 9))
    kw = T.contains_any("text", TD.TEST_RELEVANCE_KEYWORDS)
    rel = X.relevant("text", TD.TEST_RELEVANCE_KEYWORDS, overlap_col="overlap", min_overlap=TEST_MIN_OVERLAP)
    return p.where(rel).select(
        "collection", _big("doc_id").alias("doc_id"), _big("page_number").alias("page_number"),
        _big(kw.cast("int")).alias("by_keyword"), _r6("overlap").alias("overlap"),
    )


def q_key_lines(spark, sf):
    """FLT6/WN8/PRJ17: first three actionable lines of each first page."""
    p = P.once(_first_page_rows(spark, sf), "key_text", X.key_lines("text", TD.TEST_ACTION_WORDS))
    return p.where(F.col("key_text").isNotNull()).select(
        "collection", _big("doc_id").alias("doc_id"), _big("page_number").alias("page_number"), "key_text"
    )


def q_summary_sentences(spark, sf):
    """VS5: extractive two-sentence summary of each first page."""
    p = _first_page_rows(spark, sf)
    p = P.once(p, "summary", X.summary_sentences("text", T.terms(F.col("query"))))
    return p.where(F.col("summary").isNotNull()).select(
        "collection", _big("doc_id").alias("doc_id"), _big("page_number").alias("page_number"), "summary"
    )


# --------------------------------------------------------------------------- similarity / ranking

def _scores(spark, sf):
    d = _docs(spark, sf)
    jq = PL.jobs_with_query(_jobs(spark, sf))
    s = S.tfidf_scores(d.select("collection", "doc_id", "text"), jq.select("collection", "query"))
    return s.join(d.select("collection", "doc_id", "doc_ord", "filename"), ["collection", "doc_id"])


def q_tfidf(spark, sf):
    """VS2/AG8/AG9: TF-IDF cosine of every document to its collection's job."""
    s = _scores(spark, sf)
    return s.select("collection", _big("doc_id").alias("doc_id"), _r6("score").alias("score"), _r6("overlap").alias("overlap"))


def q_rank_documents(spark, sf):
    """PL1/WN1/JN1: first-stage rank."""
    r = rank_documents(_scores(spark, sf))
    return r.select("collection", _big("doc_id").alias("doc_id"), _r6("score").alias("score"), _big("bi_rank").alias("bi_rank"))


def q_hybrid_rank(spark, sf):
    """WN2-4/VS3-4/JN4: two-stage rank (term overlap re-scores the top ten)."""
    r = hybrid_rank(_scores(spark, sf).withColumnRenamed("overlap", "rerank"))
    return r.select(
        "collection", _big("doc_id").alias("doc_id"), _big("bi_rank").alias("bi_rank"),
        _r6("final_score").alias("final_score"), _big("importance_rank").alias("importance_rank"),
    )


def q_template_rank(spark, sf):
    """PL1 default path (D10): both stages see only text made from the file
    name -- retrieval template for TF-IDF, re-rank template for the overlap."""
    d = _docs(spark, sf).withColumn("doc_type", T.document_type("filename"))
    jq = PL.jobs_with_query(_jobs(spark, sf))
    bi = d.select("collection", "doc_id", T.fill(T.RETRIEVAL_TEMPLATE, filename="filename", doc_type="doc_type").alias("text"))
    s = S.tfidf_scores(bi, jq.select("collection", "query"))
    re_text = T.fill(T.RERANK_TEMPLATE, filename="filename", doc_type="doc_type")
    base = s.join(d.select("collection", "doc_id", "doc_ord", "filename", "doc_type"), ["collection", "doc_id"])
    base = PL.with_job(base, jq, "query").withColumn("rerank", F.round(S.term_overlap(re_text, "query"), 9))
    r = hybrid_rank(base.select("collection", "doc_id", "doc_ord", "score", "rerank"))
    return r.select(
        "collection", _big("doc_id").alias("doc_id"), _r6("score").alias("score"), _r6("rerank").alias("rerank"),
        _big("bi_rank").alias("bi_rank"), _big("importance_rank").alias("importance_rank"),
    )


def q_rank_lookup(spark, sf):
    """JN2: rank by file name for every manifest entry; ranks exist only for
    present (labelled) files, others get n + 1; a name shared by copies takes
    the larger rank.  File names here are content hashes, so exact copies
    share one."""
    d = _docs(spark, sf).withColumn("filename", F.concat(F.substring(F.md5("text"), 1, 12), F.lit(".txt")))
    present = d.join(TD.present_files(spark, sf), "doc_id", "left_semi")
    jq = PL.jobs_with_query(_jobs(spark, sf))
    s = S.tfidf_scores(present.select("collection", "doc_id", "text"), jq.select("collection", "query"))
    r = rank_documents(s.join(present.select("collection", "doc_id", "doc_ord", "filename"), ["collection", "doc_id"]), name="importance_rank")
    out = rank_lookup(d.select("collection", "doc_id", "filename"), r.select("collection", "filename", "importance_rank"))
    return out.select("collection", _big("doc_id").alias("doc_id"), "filename", _big("importance_rank").alias("importance_rank"))


def _vectors(spark, sf):
    e = TD.table(spark, sf, "embeddings")
    c = S.centroids(e, "label", "embedding")
    # a centroid has a row a label and a number a dimension: measured, then broadcast
    return e.join(bounded_broadcast(c), "label")


def q_cosine(spark, sf):
    """VS1: dense cosine of every vector to its label centroid."""
    v = _vectors(spark, sf)
    return v.select(_big("label").alias("label"), _big("vec_id").alias("vec_id"), _r6(S.cosine("embedding", "centroid")).alias("score"))


def q_rank_threshold(spark, sf):
    """FLT7: documented cut-off -- vectors with cosine >= 0.3, ranked."""
    v = _vectors(spark, sf).withColumn("score", F.round(S.cosine("embedding", "centroid"), 9))
    v = v.where(F.col("score") >= SIMILARITY_THRESHOLD)
    r = rank_within(v, ["label"], [F.col("score").desc(), F.col("vec_id").asc()], "rank")
    return r.select(_big("label").alias("label"), _big("vec_id").alias("vec_id"), _r6("score").alias("score"), _big("rank").alias("rank"))


def q_hybrid_rank_vec(spark, sf):
    """VS4 on vectors: cosine first stage, negative distance to the centroid as
    second-stage score (mixed scales: tail rows can overtake)."""
    v = _vectors(spark, sf).select(
        "label", "vec_id",
        F.round(S.cosine("embedding", "centroid"), 9).alias("score"),
        F.round(-S.euclidean("embedding", "centroid"), 9).alias("rerank"),
    )
    r = hybrid_rank(v, group="label", ord_col="vec_id", key="vec_id")
    return r.select(
        _big("label").alias("label"), _big("vec_id").alias("vec_id"), _big("bi_rank").alias("bi_rank"),
        _r6("final_score").alias("final_score"), _big("importance_rank").alias("importance_rank"),
    )


def q_rank_vectors(spark, sf):
    """VS2/VS3/FLT7 through the pipeline: supplied vectors ranked by their cosine to
    the job's (the centroid of their label), cut off, and re-scored by a supplied
    column (negative distance to it)."""
    v = _vectors(spark, sf)
    name = F.concat(F.lit("label"), F.col("label"))
    docs = v.select(
        name.alias("collection"), F.col("vec_id").alias("doc_id"), F.col("vec_id").alias("doc_ord"), F.concat(F.lit("vector_"), "vec_id", F.lit(".txt")).alias("filename"),
        F.lit(None).cast("string").alias("text"), F.col("embedding").alias("vector"), F.round(-S.euclidean("embedding", "centroid"), 9).alias("rerank_score"),
    )
    jobs = S.centroids(TD.table(spark, sf, "embeddings"), "label", "embedding").select(
        name.alias("collection"), F.lit(TD.TEST_PERSONA).alias("persona"), F.concat(F.lit("find "), name).alias("task"), F.col("centroid").alias("vector")
    )
    cfg = PL.JobConfig(rank_text="vector", rerank="given", min_similarity=SIMILARITY_THRESHOLD)
    r = PL.run(docs, jobs, cfg)["ranks"]
    return r.select("collection", _big("doc_id").alias("doc_id"), _r6("score").alias("score"), _r6("final_score").alias("final_score"), _big("importance_rank").alias("importance_rank"))


def q_rank_bm25(spark, sf):
    """VS3 as BM25 of the first stage's top ten documents."""
    r = _sections_with(spark, sf, rerank="bm25")["ranks"]
    return r.select("collection", _big("doc_id").alias("doc_id"), _r6("rerank").alias("rerank"), _r6("final_score").alias("final_score"), _big("importance_rank").alias("importance_rank"))


# --------------------------------------------------------------------------- pipeline

def _run(spark, sf):
    return PL.run(_docs(spark, sf), _jobs(spark, sf), TEST_CONFIG)


def q_sections(spark, sf):
    """PL3/PL7/WN7/WN9/JN6: top five sections per collection."""
    s = _run(spark, sf)["sections"]
    return s.select("collection", "document", "section_title", _big("importance_rank").alias("importance_rank"),
                    _big("page_number").alias("page_number"))


def q_sections_default(spark, sf):
    """PL8 with the job's defaults (file-name ranking texts, travel keyword
    lists; 4 lines per page): sections, plus subsections (none match here)."""
    out = PL.run(_docs(spark, sf), _jobs(spark, sf), PL.JobConfig(lines_per_page=TD.LINES_PER_PAGE))
    cols = ["collection", "document", "section_title", "importance_rank", "page_number"]
    sec = out["sections"].select(*cols)
    sub = out["subsections"].select("collection", "document", F.col("refined_text").alias("section_title"), "importance_rank", "page_number")
    u = sec.unionByName(sub)
    return u.select("collection", "document", "section_title", _big("importance_rank").alias("importance_rank"),
                    _big("page_number").alias("page_number"))


def q_sections_from_pages(spark, sf):
    """PL7/PL8 with documents given as page rows (no document is one row):
    same result as q_sections."""
    d = _docs(spark, sf)
    pages = P.page_table(d, keys=("collection", "doc_id"), lines_per_page=TD.LINES_PER_PAGE)
    out = PL.run(d.drop("text"), _jobs(spark, sf), TEST_CONFIG, pages=pages)
    return out["sections"].select("collection", "document", "section_title", _big("importance_rank").alias("importance_rank"),
                                  _big("page_number").alias("page_number"))


def q_sections_from_files(spark, sf):
    """PL9 with texts by file: the feature pass is keyed by file, and only its
    narrow result meets the manifest; same result as q_sections."""
    d = _docs(spark, sf)
    out = PL.run(d.drop("text"), _jobs(spark, sf), TEST_CONFIG, files=d.select("collection", "filename", "text"))
    return out["sections"].select("collection", "document", "section_title", _big("importance_rank").alias("importance_rank"),
                                  _big("page_number").alias("page_number"))


def _sections_with(spark, sf, **options):
    cfg = dataclasses.replace(TEST_CONFIG, **options)
    out = PL.run(_docs(spark, sf), _jobs(spark, sf), cfg)
    return out


def q_sections_min_similarity(spark, sf):
    """FLT7 through the pipeline: documents under the first-stage cut-off are
    not ranked."""
    r = _sections_with(spark, sf, min_similarity=TEST_MIN_SIMILARITY, rerank=False)["ranks"]
    return r.select("collection", _big("doc_id").alias("doc_id"), _big("importance_rank").alias("importance_rank"))


def q_sections_first_stage(spark, sf):
    """WN9 with ``rerank=False``: sections by first-stage rank."""
    s = _sections_with(spark, sf, rerank=False)["sections"]
    return s.select("collection", "document", "section_title", _big("importance_rank").alias("importance_rank"), _big("page_number").alias("page_number"))


def _subsection_rows(s):
    return s.select("collection", "document", "refined_text", _big("page_number").alias("page_number"), _big("importance_rank").alias("importance_rank"))


def q_subsections_overlap(spark, sf):
    """FLT8 through the pipeline: pages without keyword count by job-term overlap."""
    return _subsection_rows(_sections_with(spark, sf, min_overlap=TEST_MIN_OVERLAP)["subsections"])


def q_subsections_restricted(spark, sf):
    """PL7 with subsections of the section documents only."""
    return _subsection_rows(_sections_with(spark, sf, restrict_to_sections=True)["subsections"])


def q_subsections(spark, sf):
    """PL6/PL7/WN10/FLT9/PRJ12: five refined page extracts per collection."""
    s = _run(spark, sf)["subsections"]
    return s.select("collection", "document", "refined_text", _big("page_number").alias("page_number"),
                    _big("importance_rank").alias("importance_rank"))


def q_result_document(spark, sf):
    """SNK1/AG5/AG7/PRJ16/PL8/PL9: one nested result per collection (its input
    documents and the keys of its arrays compared)."""
    r = PL.result_documents(_docs(spark, sf), _jobs(spark, sf), TEST_CONFIG)
    return _result_rows(r, F.array_join("metadata.input_documents", "|").alias("input_documents"))


def _result_rows(r, *more):
    key = lambda s: F.concat(s["document"], F.lit("#"), s["page_number"].cast("string"))
    return r.select(
        "collection",
        F.col("metadata.persona").alias("persona"),
        F.md5(F.col("metadata.job_to_be_done")).alias("task_md5"),
        _big("metadata.input_document_count").alias("n_input_documents"),
        _big(F.size("extracted_sections")).alias("n_sections"),
        _big(F.size("subsection_analysis")).alias("n_subsections"),
        F.array_join(F.transform("extracted_sections", key), "|").alias("section_keys"),
        F.array_join(F.transform("subsection_analysis", key), "|").alias("subsection_keys"),
        *more,
    )


def q_written_results(spark, sf):
    """SNK2: results as the sink writes them, one output a collection, read back with
    their schema.  They are written twice: writing again replaces, and adds nothing."""
    results = materialize(PL.result_documents(_docs(spark, sf), _jobs(spark, sf), TEST_CONFIG), "results")
    out = f"{checkpoint_dir(spark).rstrip('/')}/quire-written-{uuid.uuid4().hex}"
    for _ in range(2):
        sinks.write_results(results, out, replace=True)
    written = sinks.read_results(spark, out, results.schema)
    n = written.groupBy("collection").agg(F.count(F.lit(1)).alias("n_results"))
    return _result_rows(written).join(n, "collection")


def q_counts(spark, sf):
    """AG6: per-collection counts."""
    return PL.counts(_docs(spark, sf), _jobs(spark, sf), TEST_CONFIG)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    name: fn for name, fn in sorted(globals().items()) if name.startswith("q_") and callable(fn)
}
