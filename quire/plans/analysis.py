"""The collection analysis as one DataFrame plan over all collections.

Inputs (canonical tables)
  docs(collection, doc_id, doc_ord, filename, text)   -- the manifest joined to document text
  jobs(collection, persona, task)

Text comes in one of three forms: a column of ``docs``; ``files`` (collection,
filename, text), of which ``docs`` lists those to analyse, some perhaps twice; or
``pages``, a row a page, keyed by document or by file.  Vectors and scores of other
models are columns of ``docs`` and ``jobs`` (see ``JobConfig``).

Outputs
  documents    (collection, doc_id, doc_ord, filename, doc_type, n_pages, has_heading, section_title, section_page)
  features     documents with their first pages
  ranks        (collection, doc_id, doc_ord, filename, score, rerank, final_score, importance_rank)
  sections     (collection, document, section_title, importance_rank, page_number)  <= top_sections per collection
  subsections  (collection, document, refined_text, page_number, importance_rank)   <= top_subsections per collection
  results      one row per collection: metadata struct + the two arrays

Plan notes
  * Outputs are built when they are first asked for, and once.
  * One pass over the text writes a per-document feature table (terms, page
    count, best title and its page, first pages); nothing reads the text again.
  * The pass is keyed by file where text comes as files, so that no text is
    exchanged to meet the manifest; its narrow results are.
  * Subsections are cut on narrow keys; text and job fields are fetched for the
    winners, by a broadcast of their keys.
  * Per-document work (pages, headings, section page, key lines) is in-row.
  * Full ranks use the skew-safe ``rank_within``; the top-k cuts use
    WindowGroupLimit, so a hot collection sends at most k rows per map task.
  * Arrays of sections and subsections are bounded by k.  The list of input
    documents grows with its collection, as the result holds all their names; it
    stays on the executors, and the sink writes it as rows next to the result too.
"""

from __future__ import annotations

import dataclasses
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass, field
from functools import cached_property

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.functions import text as T
from quire.operators import extract as X
from quire.operators import pages as P
from quire.operators.ranking import TOP_RERANK, bounded_broadcast, bytes_of, fits_broadcast, hybrid_rank, join_in_blocks, rank_documents, shared_names, top_k
from quire.operators.similarity import SCORE_DIGITS, bm25_scores, cosine, norm, term_freqs, term_overlap, tfidf_from_terms
from quire.session import materialize, materialize_bucketed


@dataclass
class JobConfig:
    relevance_keywords: Sequence[str] = field(default_factory=lambda: list(T.DEFAULT_RELEVANCE_KEYWORDS))
    action_words: Sequence[str] = field(default_factory=lambda: list(T.DEFAULT_ACTION_WORDS))
    lines_per_page: int | None = None  # None: form-feed pages; n: every n lines
    # first stage -- "template": TF-IDF of file-name templates (job default); "body": of the
    # text; "vector": cosine of the ``vector`` columns of docs and jobs (none: score 0)
    rank_text: str = "template"
    # second stage on the top ``rerank_top`` documents -- True or "overlap": job terms found;
    # "bm25": BM25 of the text; "given": the ``rerank_score`` column of docs (none: 0); False: none
    rerank: bool | str = True
    rerank_top: int = TOP_RERANK
    bm25_k1: float = 1.2
    bm25_b: float = 0.75
    top_sections: int = 5
    top_subsections: int = 5
    summarize: bool = True             # extractive summary before the template fallback
    min_overlap: float | None = None   # page relevance fallback on job-term overlap
    min_similarity: float | None = None  # documented cut-off on the first-stage score (off by default)
    restrict_to_sections: bool = False  # subsections only from section documents
    first_pages: int = T.FIRST_PAGES
    idf_salt: int = 1                  # >1: salt the (collection, term) idf join (see tfidf_from_terms)

    def __post_init__(self):
        if self.rank_text not in ("template", "body", "vector") or self.rerank not in (True, False, "overlap", "bm25", "given"):
            raise ValueError(f"rank_text={self.rank_text!r}, rerank={self.rerank!r}")

    @property
    def body_terms(self) -> bool:
        """Whether the terms of the text are needed (else those of the file name)."""
        return self.rank_text == "body" or self.rerank == "bm25"


@dataclass
class Responses:
    """Outputs of an external generator for the requests of
    ``generation_requests``: titles (collection, doc_id, response); verdicts
    and summaries (collection, doc_id, page_number, response).  Where text comes
    as files, or pages keyed by file, filename stands for doc_id."""
    titles: DataFrame | None = None
    verdicts: DataFrame | None = None
    summaries: DataFrame | None = None


DOC_COLUMNS = ["collection", "doc_id", "doc_ord", "filename", "doc_type"]
FOUND_COLUMNS = ["n_pages", "has_heading", "section_title", "section_page"]


def _meta(df: DataFrame, cfg: JobConfig) -> list[str]:
    """The columns of a document that are carried on."""
    given = ["vector"] * (cfg.rank_text == "vector") + ["rerank_score"] * (cfg.rerank == "given")
    return [c for c in DOC_COLUMNS if c in df.columns] + given


def prepare(docs: DataFrame, jobs: DataFrame, cfg: JobConfig) -> DataFrame:
    """Documents with their type; those of collections without a job are dropped
    here only where the names can be broadcast -- whole texts are never shuffled to
    meet their job.  What is published meets the jobs once more, as narrow rows."""
    d = docs.join(F.broadcast(jobs.select("collection")), "collection", "left_semi") if fits_broadcast(jobs) else docs
    return d.withColumn("doc_type", T.document_type("filename"))


def features(prepared: DataFrame, cfg: JobConfig, title_responses: DataFrame | None = None) -> DataFrame:
    """The feature pass (``feature_plan``) written once as a stored table."""
    return materialize(feature_plan(prepared, cfg, title_responses), "features")


def feature_plan(prepared: DataFrame, cfg: JobConfig, title_responses: DataFrame | None = None) -> DataFrame:
    """One pass over the document text.

    Per document (or file): term frequencies of the ranking text, number of
    non-blank pages, whether a heading was found, best section title (first heading,
    else the first generated title when ``title_responses`` (collection, doc_id or
    filename, response) is given, else the fallback template) and its page,
    and the first pages.  Everything downstream reads this table; the text
    column is not scanned again.
    """
    if cfg.body_terms:
        rank_text = F.col("text")
    else:
        rank_text = T.fill(T.RETRIEVAL_TEMPLATE, filename="filename", doc_type="doc_type")
    fallback = T.fill(T.FALLBACK_TITLE_TEMPLATES[0], doc_type="doc_type")
    generated = F.lit(None)
    if title_responses is not None:
        keys = ["collection", "doc_id" if "doc_id" in prepared.columns else "filename"]
        # a response is cleaned first (blank runs become one space), then parsed
        gen = title_responses.select(*keys, T.parse_titles(T.clean_response("response")).alias("_gen"))
        # usually few documents lack a heading: broadcast when the table is small
        prepared = prepared.join(bounded_broadcast(gen), keys, "left")
        generated = F.get(F.col("_gen"), 0)

    def per_doc(pages):
        def with_headings(heads):
            title = F.coalesce(F.get(heads, 0), generated, fallback)
            return T.let(
                title,
                lambda t: F.struct(
                    F.size(pages).alias("n_pages"),
                    (F.size(heads) > 0).alias("has_heading"),
                    t.alias("section_title"),
                    P.section_page(pages, t).alias("section_page"),
                    # only pages long enough to be relevant are ever used downstream
                    F.filter(
                        P.first_pages(pages, cfg.first_pages),
                        lambda p: F.length(p["text"]) >= T.MIN_RELEVANT_PAGE_CHARS,
                    ).alias("first_pages"),
                ),
            )

        return T.let(P.heading_titles(pages, first_n=cfg.first_pages), with_headings)

    f = prepared.select(
        *_meta(prepared, cfg),
        T.let(P.page_array("text", cfg.lines_per_page), per_doc).alias("_f"),
        term_freqs(rank_text).alias("terms"),
    )
    return f.select("*", "_f.*").drop("_f")


#: Pages of one document that stay together; a longer document is split.
PAGE_BLOCK = 1000


@dataclass
class Source:
    """What the feature pass found, whatever form the text came in.

    ``documents``: a narrow row a document; ``terms``: (*key, term, tf[, listed]);
    ``pages``: the first pages that are long enough, as rows (*key, page_number,
    page_seq, text); ``features``: documents with their first pages.  ``key`` is
    (collection, doc_id), or (collection, filename) where several documents of
    the manifest may share one file: ``listed`` then counts them."""
    key: list[str]
    documents: DataFrame
    terms: DataFrame
    pages: DataFrame
    features: DataFrame


def _exploded(terms: DataFrame, *cols: str) -> DataFrame:
    return terms.select(*cols, F.explode("terms").alias("_t")).select(*cols, F.col("_t.term").alias("term"), F.col("_t.tf").alias("tf"))


def _asked(df: DataFrame, jobs: DataFrame) -> DataFrame:
    """Rows of collections with a job."""
    return df.join(bounded_broadcast(jobs.select("collection"), witness=jobs), "collection", "left_semi")


def from_texts(docs: DataFrame, jobs: DataFrame, cfg: JobConfig, titles: DataFrame | None = None) -> Source:
    """Documents with a ``text`` column."""
    stored = features(prepare(docs, jobs, cfg), cfg, titles)
    key = ["collection", "doc_id"]
    return Source(
        key, _asked(stored.select(*_meta(stored, cfg), *FOUND_COLUMNS), jobs), _exploded(stored, *key),
        P.explode_pages(stored.select(*key, F.col("first_pages").alias("pages")), key), _asked(stored, jobs),
    )


def _template_terms(documents: DataFrame) -> DataFrame:
    text = T.fill(T.RETRIEVAL_TEMPLATE, filename="filename", doc_type="doc_type")
    return _exploded(documents.select("collection", "doc_id", term_freqs(text).alias("terms")), "collection", "doc_id")


def _with_pages(documents: DataFrame, pages: DataFrame, key: list[str]) -> DataFrame:
    first = pages.groupBy(*key).agg(F.array_sort(F.collect_list(F.struct("page_number", "page_seq", "text"))).alias("first_pages"))
    return documents.join(first, key, "left").withColumn("first_pages", F.coalesce("first_pages", F.array().cast(P.PAGE_TYPE)))


def _manifest(docs: DataFrame, jobs: DataFrame, cfg: JobConfig) -> DataFrame:
    """The documents to analyse, without text."""
    listed = _asked(docs, jobs).withColumn("doc_type", T.document_type("filename"))
    return listed.select(*_meta(listed, cfg))


def _found(documents: DataFrame, found: DataFrame, key: list[str], generated=None) -> DataFrame:
    """Documents with what was found in their text; one without pages has the
    fallback title and page 1."""
    title = F.coalesce("section_title", T.fill(T.FALLBACK_TITLE_TEMPLATES[0], doc_type="doc_type"))
    return documents.join(found, key, "left").select(
        *documents.columns, F.coalesce("n_pages", F.lit(0)).alias("n_pages"), F.coalesce("has_heading", F.lit(False)).alias("has_heading"),
        title.alias("section_title"), F.coalesce("section_page", F.lit(1)).alias("section_page"),
    )


def from_files(docs: DataFrame, files: DataFrame, jobs: DataFrame, cfg: JobConfig, titles: DataFrame | None = None) -> Source:
    """Texts as ``files`` (collection, filename, text), a row a file; ``docs``
    (without text) lists the documents to analyse.

    The feature pass is keyed by file, so text never leaves its scan task to meet
    the manifest; narrow rows of the result do.  Files that no document lists are
    left out of the pass where the manifest can be broadcast, and dropped from its
    result in any case.  A listed file that is missing is a document without pages."""
    key = ["collection", "filename"]
    documents = _manifest(docs, jobs, cfg)
    names = documents.select(*key).distinct()
    texts = files.select(*key, "text")
    if fits_broadcast(names):
        texts = texts.join(F.broadcast(names), key, "left_semi")
    stored = features(texts.withColumn("doc_type", T.document_type("filename")), _without_given(cfg), titles)
    documents = materialize(_found(documents, stored.select(*key, *FOUND_COLUMNS), key), "documents")
    pages = P.explode_pages(stored.select(*key, F.col("first_pages").alias("pages")), key)
    if cfg.body_terms:
        listed = documents.groupBy(*key).agg(F.count(F.lit(1)).alias("listed"))
        terms = _exploded(stored.select(*key, "terms").join(bounded_broadcast(listed), key), *key, "listed")
    else:
        terms = _template_terms(documents)
    return Source(key, documents, terms, pages, _with_pages(documents, pages, key))


def _without_given(cfg: JobConfig) -> JobConfig:
    """The configuration of the pass over files, which have no vectors or scores."""
    return dataclasses.replace(cfg, rank_text="body" if cfg.body_terms else "template", rerank=False)


def from_pages(docs: DataFrame, pages: DataFrame, jobs: DataFrame, cfg: JobConfig, titles: DataFrame | None = None,
               failed: DataFrame | None = None) -> Source:
    """Texts as page rows (collection, doc_id or filename, page_number, text);
    ``docs`` (without text) lists the documents to analyse, ``failed`` (the same key)
    those that have no pages whatever rows there are.

    A document is never one row here.  Page rows are exchanged once, by document and
    block of ``PAGE_BLOCK`` pages, and stored in buckets; after that no text is
    exchanged: counts, titles, the section-page search and the choice of first pages
    move narrow rows, and what must meet a page's text comes to its bucket.  Results
    equal those of the same text in one row.
    """
    key = ["collection", "doc_id" if "doc_id" in pages.columns else "filename"]
    at = [*key, "block"]
    documents = _manifest(docs, jobs, cfg)
    number = F.col("page_number").cast("int")
    paged = pages.select(*key, F.floor((number - 1) / PAGE_BLOCK).cast("int").alias("block"), number.alias("page_number"), T.ustrip("text").alias("text"))
    held = materialize_bucketed(paged.where(F.col("text") != ""), at, "pages")
    # blocks of documents that are analysed: the text side of this join stays where it is
    wanted = held.select(*at).distinct().join(documents.select(*key).distinct(), key, "left_semi")
    if failed is not None:
        wanted = wanted.join(failed.select(*key), key, "left_anti")
    pg = held.join(wanted, at, "left_semi")

    numbers = materialize(pg.select(*at, "page_number"), "page-numbers")
    n_pages = numbers.groupBy(*key).agg(F.count(F.lit(1)).cast("int").alias("n_pages"))
    firsts = top_k(numbers, key, ["page_number"], cfg.first_pages, name="page_seq")
    chosen = firsts.groupBy(*at).agg(F.map_from_entries(F.collect_list(F.struct("page_number", F.col("page_seq").cast("int")))).alias("_seq"))
    first = held.join(chosen, at).where(F.map_contains_key("_seq", F.col("page_number")))
    first = materialize(first.select(*key, "page_number", F.element_at("_seq", F.col("page_number")).alias("page_seq"), "text"), "first-pages")

    # the longest titles of a document are among the longest of its pages
    one_page = F.array(F.struct("page_number", F.lit(1).alias("page_seq"), "text")).cast(P.PAGE_TYPE)
    heads = first.select(*key, F.explode(P.heading_titles(one_page, first_n=1)).alias("title"))
    best = heads.groupBy(*key).agg(F.min(F.struct((-F.length("title")).alias("k"), "title"))["title"].alias("heading"))
    generated = F.lit(None).cast("string")
    if titles is not None:
        gen = titles.select(*key, F.get(T.parse_titles(T.clean_response("response")), 0).alias("_gen"))
        documents = documents.join(bounded_broadcast(gen), key, "left")
        generated = F.col("_gen")
    names = documents.join(best, key, "left").select(
        *key, F.col("heading").isNotNull().alias("has_heading"), F.coalesce("heading", generated, T.fill(T.FALLBACK_TITLE_TEMPLATES[0], doc_type="doc_type")).alias("section_title")
    ).distinct()
    names = materialize(names, "titles")
    documents = documents.drop("_gen")
    # section page: first page containing the title, else the first with half
    # of its longer words -- minimum page numbers, aggregated over page rows
    words = F.transform(F.filter(T.split_words("section_title"), lambda w: F.length(w) > T.TITLE_KEYWORD_MIN_LEN), F.lower)
    sought = numbers.select(*at).distinct().join(names.select(*key, F.lower("section_title").alias("_lt"), words.alias("_kw")), key)
    low = F.lower("text")
    hits = F.size(F.filter("_kw", lambda k: low.contains(k)))
    pages_of = held.join(sought, at).groupBy(*key).agg(
        F.min(F.when(low.contains(F.col("_lt")), F.col("page_number"))).alias("_exact"),
        F.min(F.when(hits * 2 >= F.size("_kw"), F.col("page_number"))).alias("_kwp"),
    )
    found = names.join(n_pages, key, "left").join(pages_of, key, "left").select(
        *key, F.coalesce("n_pages", F.lit(0)).alias("n_pages"), "has_heading", "section_title", F.coalesce("_exact", "_kwp", F.lit(1)).cast("int").alias("section_page")
    )
    documents = materialize(_found(documents, found, key), "documents")
    # only pages long enough to be relevant are ever used downstream
    first = first.where(F.length("text") >= T.MIN_RELEVANT_PAGE_CHARS)
    if cfg.body_terms:
        # counted by block, in its bucket; only documents of several blocks are exchanged
        tf = _exploded(pg.select(*at, term_freqs(F.col("text")).alias("terms")), *at)
        terms = materialize(tf.groupBy(*at, "term").agg(F.sum("tf").alias("tf")), "block-terms")
        split = numbers.select(*at).distinct().groupBy(*key).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select(*key)
        terms = terms.drop("block") if not bytes_of(split) else _over_blocks(terms, split, key)
        if key[1] == "filename":
            listed = documents.groupBy(*key).agg(F.count(F.lit(1)).alias("listed"))
            terms = materialize(terms.join(bounded_broadcast(listed), key), "terms")
    else:
        terms = _template_terms(documents)
    return Source(key, documents, terms, first, _with_pages(documents, first, key))


def _over_blocks(terms: DataFrame, split: DataFrame, key: list[str]) -> DataFrame:
    """Terms counted by block as those of documents, of which ``split`` have several blocks."""
    names = bounded_broadcast(split)
    sums = terms.join(names, key, "left_semi").groupBy(*key, "term").agg(F.sum("tf").alias("tf"))
    return terms.join(names, key, "left_anti").drop("block").unionByName(materialize(sums, "terms"))


def first_stage(source: Source, jobs_q: DataFrame, cfg: JobConfig) -> DataFrame:
    """(collection, doc_id, score, overlap) of every document; overlap is null
    where the text's terms are not those that are ranked."""
    if cfg.rank_text == "vector":
        of_job = jobs_q.select("collection", F.col("vector").alias("_jv"), norm("vector").alias("_jn"))
        # norms once a vector, not once a pair
        d = P.once(source.documents.select("collection", "doc_id", "vector"), "_dn", norm("vector"))
        d = d.join(bounded_broadcast(of_job), "collection", "left")
        score = F.coalesce(cosine("vector", "_jv", "_dn", "_jn"), F.lit(0.0))
        return d.select("collection", "doc_id", F.round(score, SCORE_DIGITS).alias("score"), F.lit(None).cast("double").alias("overlap"))
    weight = "listed" if "listed" in source.terms.columns else None
    if cfg.rank_text == "template" and cfg.body_terms:
        terms, key, weight = _template_terms(source.documents), "doc_id", None
    else:
        terms, key = source.terms, "filename" if weight else "doc_id"
    keys = source.documents.select(*dict.fromkeys(["collection", key, "doc_id"]))
    scores = tfidf_from_terms(terms, keys, jobs_q, key=key, salt=cfg.idf_salt, weight=weight)
    return scores.select("collection", "doc_id", "score", "overlap" if cfg.rank_text == "body" else F.lit(None).cast("double").alias("overlap"))


def second_stage(base: DataFrame, source: Source, jobs_q: DataFrame, cfg: JobConfig) -> DataFrame:
    """``base`` (with score, overlap) with the ``rerank`` score; BM25 is that of
    the first stage's top documents only, others have none."""
    if cfg.rerank == "given":
        return base.withColumn("rerank", F.coalesce(F.col("rerank_score").cast("double"), F.lit(0.0)))
    if cfg.rerank == "bm25":
        order = [F.col("score").desc(), "doc_ord", "doc_id"]
        weight = "listed" if "listed" in source.terms.columns else None
        key = "filename" if weight else "doc_id"
        heads = top_k(base.select(*dict.fromkeys(["collection", key, "doc_id", "doc_ord", "score"])), ["collection"], order, cfg.rerank_top)
        heads = materialize(heads.select(*dict.fromkeys(["collection", key, "doc_id"])), "heads")
        keys = source.documents.select("collection", key)
        scored = bm25_scores(source.terms, keys, jobs_q, heads, cfg.bm25_k1, cfg.bm25_b, key=key, weight=weight)
        return base.join(scored.select("collection", "doc_id", F.col("bm25").alias("rerank")), ["collection", "doc_id"], "left")
    if cfg.rank_text == "body":
        return base.withColumn("rerank", F.col("overlap"))
    re_text = T.fill(T.RERANK_TEMPLATE, filename="filename", doc_type="doc_type")
    return with_job(base, jobs_q, "query").withColumn("rerank", F.round(term_overlap(re_text, "query"), SCORE_DIGITS)).drop("query")


def rank(source: Source, jobs_q: DataFrame, cfg: JobConfig) -> DataFrame:
    """Importance rank of every document of every collection."""
    documents = source.documents.select("collection", "doc_id", "doc_ord", "filename", "doc_type", *["rerank_score"] * (cfg.rerank == "given"))
    base = documents.join(first_stage(source, jobs_q, cfg), ["collection", "doc_id"])
    if cfg.min_similarity is not None:
        base = base.where(F.col("score") >= cfg.min_similarity)
    if cfg.rerank:
        base = materialize(base, "scores")  # read for its top documents, then for the ranks
        base = second_stage(base, source, jobs_q, cfg)
        # keep the stored rank table narrow
        base = base.select("collection", "doc_id", "doc_ord", "filename", "score", "rerank")
        r = hybrid_rank(base, top=cfg.rerank_top, with_bi_rank=False)
    else:
        r = rank_documents(base, name="importance_rank").withColumn("final_score", F.col("score"))
        r = r.withColumn("rerank", F.lit(None).cast("double"))
    r = r.select("collection", "doc_id", "doc_ord", "filename", "score", "rerank", "final_score", "importance_rank")
    # a file name listed twice carries the rank assigned last (the larger one)
    r = materialize(r, "ranks")
    looked = r.join(shared_names(r), ["collection", "filename"], "left")
    return materialize(looked.withColumn("importance_rank", F.coalesce("_r", "importance_rank")).drop("_r"), "ranks")


def jobs_with_query(jobs: DataFrame) -> DataFrame:
    """The jobs with their query text (and vector, if they have one)."""
    query = T.fill(T.QUERY_TEMPLATE, persona="persona", task="task").alias("query")
    return jobs.select("collection", "persona", "task", query, *["vector"] * ("vector" in jobs.columns))


def with_job(df: DataFrame, jobs_q: DataFrame, *cols: str) -> DataFrame:
    """Attach job fields by collection.  Job texts are not stored per document;
    they are broadcast where needed, in blocks if need be, as ``df`` may hold texts."""
    return join_in_blocks(df, jobs_q.select("collection", *cols), ["collection"], witness=jobs_q)


def sections(documents: DataFrame, ranks: DataFrame, cfg: JobConfig) -> DataFrame:
    """Best section of each collection's top documents (documents with text only)."""
    cand = documents.where(F.col("n_pages") > 0).select("collection", "doc_id", "filename", "section_title", "section_page").join(
        ranks.select("collection", "doc_id", "doc_ord", "importance_rank"), ["collection", "doc_id"]
    )
    top = top_k(cand, ["collection"], ["importance_rank", "doc_ord", "doc_id"], cfg.top_sections)
    return top.select(
        "collection",
        F.col("filename").alias("document"),
        "section_title",
        "importance_rank",
        F.col("section_page").alias("page_number"),
        "doc_id",
        "doc_ord",
    )


def first_page_rows(feats: DataFrame, jobs_q: DataFrame) -> DataFrame:
    keys = ["collection", "doc_id", "doc_ord", "filename", "doc_type"]
    pg = P.explode_pages(feats.select(*keys, F.col("first_pages").alias("pages")), keys)
    return with_job(pg, jobs_q, "persona", "task", "query")


def subsection_candidates(source: Source, cfg: JobConfig, jobs_q: DataFrame, responses: Responses) -> DataFrame:
    """Relevant first pages that have an extract, of all documents, as narrow rows:
    the documents' columns and ``page_number``.

    Optional generator outputs, keyed (collection, doc_id or filename, page_number,
    response): verdicts decide pages of >= 150 characters without keyword ("yes" in
    the cleaned response); summaries come after key lines and before the extractive
    summary.
    """
    on_page = [*source.key, "page_number"]
    pg = source.pages
    overlap = None
    if cfg.min_overlap is not None:
        pg = with_job(pg, jobs_q, "query")
        overlap = term_overlap("text", "query")
    rel = X.relevant("text", cfg.relevance_keywords, overlap_col=overlap, min_overlap=cfg.min_overlap)
    if responses.verdicts is None:
        rows = pg.where(rel).select(*on_page)
    else:
        said = responses.verdicts.select(*on_page, T.verdict(T.clean_response("response")).alias("_verdict"))
        rows = pg.where(F.length("text") >= T.MIN_RELEVANT_PAGE_CHARS).select(*on_page, rel.alias("_rel"))
        rows = rows.join(said, on_page, "left").where(F.col("_rel") | F.coalesce("_verdict", F.lit(False))).select(*on_page)
    has_task = jobs_q.select("collection", F.col("task").isNotNull().alias("_task"))
    meta = source.documents.select(*DOC_COLUMNS).join(bounded_broadcast(has_task, witness=jobs_q), "collection")
    # the template makes every extract non-empty unless a field of it is null;
    # pages of such documents are looked at with their job
    filled = F.col("doc_type").isNotNull() & F.col("_task")
    certain = rows.join(meta.where(filled).drop("_task"), source.key)
    certain = certain.select(*DOC_COLUMNS, "page_number")
    rest = meta.where(~filled).drop("_task")
    if not bytes_of(rest):
        return certain
    looked = with_job(join_in_blocks(pg.drop("query").select(*on_page, "text"), rest, source.key), jobs_q, "task", "query")
    if responses.summaries is not None:
        looked = looked.join(_summaries(responses, on_page), on_page, "left")
    extract = refined(cfg, responses.summaries is not None)
    found = looked.where(F.coalesce(extract != "", F.lit(False))).select(*dict.fromkeys([*DOC_COLUMNS, "page_number"]))
    found = found.join(rows.distinct(), on_page, "left_semi")
    return certain.unionByName(found)


def _summaries(responses: Responses, on_page: list[str]) -> DataFrame:
    return responses.summaries.select(*on_page, T.clean_response("response").alias("_summary"))


def refined(cfg: JobConfig, generated: bool = False) -> Column:
    """The refined text of a candidate page."""
    job_terms = F.array_distinct(T.terms(F.col("query")))
    return X.refined_text("text", "doc_type", "task", job_terms if cfg.summarize else None, cfg.action_words, cfg.summarize,
                          generated_col=F.nullif(F.col("_summary"), F.lit("")) if generated else None)


def generation_requests(feats: DataFrame, cfg: JobConfig, jobs_q: DataFrame) -> DataFrame:
    """Prompts for an external generator, only where the pipeline would ask one:
    documents with text but no heading (titles), first pages of >= 150
    characters without keyword (relevance), relevant pages without key lines
    (summary).  (collection, doc_id, page_number, kind, prompt)."""
    docs = with_job(feats.where((F.col("n_pages") > 0) & ~F.col("has_heading")), jobs_q, "persona", "task").select(
        "collection", "doc_id", F.lit(None).cast("int").alias("page_number"), F.lit("titles").alias("kind"),
        T.fill(T.TITLES_PROMPT_TEMPLATE, doc_type="doc_type", persona="persona", task="task").alias("prompt"),
    )
    pg = first_page_rows(feats, jobs_q)
    long_enough = F.length("text") >= T.MIN_RELEVANT_PAGE_CHARS
    keyword = T.contains_any("text", cfg.relevance_keywords)
    rel = pg.where(long_enough & ~keyword).select(
        "collection", "doc_id", "page_number", F.lit("relevance").alias("kind"),
        T.fill(T.RELEVANCE_PROMPT_TEMPLATE, filename="filename", persona="persona", task="task",
               context=F.substring("text", 1, T.RELEVANCE_CONTEXT_CHARS)).alias("prompt"),
    )
    summ = pg.where(long_enough & keyword & X.key_lines("text", cfg.action_words).isNull()).select(
        "collection", "doc_id", "page_number", F.lit("summary").alias("kind"),
        T.fill(T.SUMMARY_PROMPT_TEMPLATE, doc_type="doc_type", persona="persona", task="task",
               context=F.substring("text", 1, T.SUMMARY_CONTEXT_CHARS)).alias("prompt"),
    )
    return docs.unionByName(rel).unionByName(summ)


def subsections(source: Source, ranks: DataFrame, cfg: JobConfig, jobs_q: DataFrame, candidates: DataFrame,
                section_rows: DataFrame | None = None, responses: Responses | None = None) -> DataFrame:
    """The top extracts.  The cut is on narrow rows; the text of the winners, at
    most ``top_subsections`` a collection, is fetched by a broadcast of their keys,
    in blocks if need be, and only they meet the fields of their job."""
    responses = responses or Responses()
    cand = candidates.join(ranks.select("collection", "doc_id", "importance_rank"), ["collection", "doc_id"])
    if cfg.restrict_to_sections and section_rows is not None:
        cand = cand.join(section_rows.select("collection", "doc_id"), ["collection", "doc_id"], "left_semi")
    top = top_k(cand, ["collection"], ["importance_rank", "page_number", "doc_ord", "doc_id"], cfg.top_subsections)
    on_page = [*source.key, "page_number"]
    winners = materialize(top.drop("_k"), "winners")
    fetched = join_in_blocks(source.pages.select(*on_page, "text"), winners, on_page)
    if responses.summaries is not None:
        own = join_in_blocks(_summaries(responses, on_page), winners.select(*on_page).distinct(), on_page, witness=winners)
        fetched = fetched.join(bounded_broadcast(own), on_page, "left")
    return with_job(fetched, jobs_q, "task", "query").select(
        "collection",
        F.col("filename").alias("document"),
        refined(cfg, responses.summaries is not None).alias("refined_text"),
        "page_number",
        "importance_rank",
        "doc_id",
        "doc_ord",
    )


class Outputs(Mapping):
    """Tables by name, each built when it is first asked for."""

    def __init__(self, docs: DataFrame, jobs: DataFrame, cfg: JobConfig, responses: Responses, **texts):
        self.docs, self.cfg, self.responses, self.texts = docs, cfg, responses, texts
        self.jobs = jobs_with_query(jobs)

    @cached_property
    def source(self) -> Source:
        if self.texts.get("pages") is not None:
            return from_pages(self.docs, self.texts["pages"], self.jobs, self.cfg, self.responses.titles, self.texts.get("failed"))
        if self.texts.get("files") is not None:
            return from_files(self.docs, self.texts["files"], self.jobs, self.cfg, self.responses.titles)
        return from_texts(self.docs, self.jobs, self.cfg, self.responses.titles)

    @property
    def features(self) -> DataFrame:
        return self.source.features

    @property
    def documents(self) -> DataFrame:
        return self.source.documents

    @cached_property
    def ranks(self) -> DataFrame:
        return rank(self.source, self.jobs, self.cfg)

    @cached_property
    def sections(self) -> DataFrame:
        return sections(self.documents, self.ranks, self.cfg)

    @cached_property
    def candidates(self) -> DataFrame:
        return subsection_candidates(self.source, self.cfg, self.jobs, self.responses)

    @cached_property
    def subsections(self) -> DataFrame:
        chosen = self.sections if self.cfg.restrict_to_sections else None
        return subsections(self.source, self.ranks, self.cfg, self.jobs, self.candidates, chosen, self.responses)

    NAMES = ("features", "documents", "ranks", "sections", "subsections", "candidates", "jobs")

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self.NAMES:
            raise KeyError(name)
        return getattr(self, name)

    def __iter__(self) -> Iterator[str]:
        return iter(self.NAMES)

    def __len__(self) -> int:
        return len(self.NAMES)


def run(docs: DataFrame, jobs: DataFrame, cfg: JobConfig | None = None, responses: Responses | None = None,
        pages: DataFrame | None = None, files: DataFrame | None = None, failed: DataFrame | None = None) -> Outputs:
    """All outputs of the analysis, built as they are asked for.

    With ``pages`` or ``files`` the text comes from these (see ``from_pages`` and
    ``from_files``) and ``docs`` needs no text column."""
    return Outputs(docs, jobs, cfg or JobConfig(), responses or Responses(), pages=pages, files=files, failed=failed)


def model_label(cfg: JobConfig) -> str:
    first = "vector-cosine" if cfg.rank_text == "vector" else "tfidf-cosine"
    second = {False: "", "bm25": " + bm25 rerank", "given": " + given rerank"}.get(cfg.rerank, " + term-overlap rerank")
    return first + second


def generator_label(cfg: JobConfig, responses: Responses) -> str:
    """What wrote the texts that are not in the documents."""
    if any(r is not None for r in (responses.titles, responses.verdicts, responses.summaries)):
        return "given responses"
    return "extractive summary" if cfg.summarize else "templates"


def result_documents(docs: DataFrame, jobs: DataFrame, cfg: JobConfig | None = None, outputs: Mapping | None = None) -> DataFrame:
    """One row per collection (with a job and documents): metadata + arrays.

    The metadata list all input documents of the collection, in manifest order,
    whether or not they have a file or text; one listed twice stands there twice."""
    cfg = cfg or JobConfig()
    out = outputs or run(docs, jobs, cfg)
    n_docs = out["documents"].groupBy("collection").agg(
        F.count(F.lit(1)).alias("n_input_documents"),
        F.array_sort(F.collect_list(F.struct("doc_ord", "doc_id", "filename"))).alias("_d"),
    )
    sec = out["sections"].groupBy("collection").agg(
        F.array_sort(
            F.collect_list(F.struct("importance_rank", "doc_ord", "doc_id", "document", "section_title", "page_number"))
        ).alias("_s")
    )
    sub = out["subsections"].groupBy("collection").agg(
        F.array_sort(
            F.collect_list(F.struct("importance_rank", "page_number", "doc_ord", "doc_id", "document", "refined_text"))
        ).alias("_u")
    )
    # Spark sizes a list as one name, so the lists are kept from being broadcast
    res = (
        out["jobs"].join(n_docs.hint("merge"), "collection")
        .join(sec, "collection", "left")
        .join(sub, "collection", "left")
    )
    sections_arr = F.transform(
        F.coalesce(F.col("_s"), F.array()),
        lambda s: F.struct(
            s["document"].alias("document"), s["section_title"].alias("section_title"),
            s["importance_rank"].alias("importance_rank"), s["page_number"].alias("page_number"),
        ),
    )
    subs_arr = F.transform(
        F.coalesce(F.col("_u"), F.array()),
        lambda s: F.struct(
            s["document"].alias("document"), s["refined_text"].alias("refined_text"), s["page_number"].alias("page_number"),
        ),
    )
    meta = F.struct(
        F.col("n_input_documents").alias("input_document_count"),
        F.transform("_d", lambda d: d["filename"]).alias("input_documents"),
        F.col("persona").alias("persona"),
        F.col("task").alias("job_to_be_done"),
        F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("processing_timestamp"),
        F.lit(out["documents"].sparkSession.sparkContext.defaultParallelism).alias("parallel_workers"),
        F.lit(generator_label(cfg, getattr(out, "responses", Responses()))).alias("model_used"),
        F.lit("cpu").alias("device"),
        F.lit(model_label(cfg)).alias("similarity_model"),
    )
    return res.select(
        "collection",
        meta.alias("metadata"),
        sections_arr.alias("extracted_sections"),
        subs_arr.alias("subsection_analysis"),
    )


def counts(docs: DataFrame, jobs: DataFrame, cfg: JobConfig | None = None, outputs: Mapping | None = None) -> DataFrame:
    """Per collection: documents, documents with text, sections, subsection
    candidates and subsections kept."""
    cfg = cfg or JobConfig()
    out = outputs or run(docs, jobs, cfg)
    per_doc = out["documents"].select("collection", F.lit(1).alias("n_documents"), (F.col("n_pages") > 0).cast("int").alias("n_with_text"))
    # sections kept are the least of the cut and of the documents with text,
    # subsections likewise of the candidates; a similarity cut-off drops
    # documents from the ranks, so what is kept is counted
    cands = out["candidates"].select("collection", F.lit(1).alias("n_candidates"))
    cut = cfg.min_similarity is not None
    if cfg.restrict_to_sections or cut:
        picked = out["subsections"].select("collection", F.lit(1).alias("n_picked"))
    else:
        picked = None
    rows = per_doc.unionByName(cands, allowMissingColumns=True)
    if picked is not None:
        rows = rows.unionByName(picked, allowMissingColumns=True)
    if cut:
        rows = rows.unionByName(out["sections"].select("collection", F.lit(1).alias("n_titled")), allowMissingColumns=True)
    names = [c for c in rows.columns if c != "collection"]
    res = rows.groupBy("collection").agg(*(F.coalesce(F.sum(c), F.lit(0)).cast("bigint").alias(c) for c in names)).where("n_documents > 0")
    return res.select(
        "collection",
        "n_documents",
        "n_with_text",
        (F.col("n_titled") if cut else F.least("n_with_text", F.lit(cfg.top_sections).cast("bigint"))).alias("n_sections"),
        "n_candidates",
        (F.col("n_picked") if picked is not None else F.least("n_candidates", F.lit(cfg.top_subsections).cast("bigint"))).alias("n_subsections"),
    )
