"""Similarity of documents to a job: sparse TF-IDF cosine, term overlap and
dense-vector cosine.

TF-IDF (per collection):
  terms      lower-cased letter runs of >= 4 code points
  tf(d, t)   occurrences of t in d
  df(c, t)   documents of collection c containing t;  N(c) documents in c
  idf(c, t)  ln(1 + N(c) / df(c, t))
  w(d, t)    tf * idf;   q(t) = qtf * idf for query terms with df > 0
  cosine     sum(w * q) / (|w| * |q|), 0 when either norm is 0
  overlap    distinct query terms found in d / distinct query terms

Plan shape: the document-term table is built in-row (no shuffle) and
restricted to collections that have a query (a broadcast semi join).  It is
shuffled once, on (term, collection), to meet its idf, a stored table -- a hot
term in a hot collection meets a one-row idf side, which AQE's skew join splits
(or ``salt`` spreads explicitly); neither side is sorted where the idf rows of a
partition can be held -- then left-joined to the broadcast query-term
table (one row per collection and query term, size-checked) and aggregated
per document: norm, dot product and hit count in one pass.  Scores are
rounded to ``SCORE_DIGITS`` decimals so that ties, and therefore ranks, do
not depend on the order of floating-point sums.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.functions import text as T
from quire.operators.ranking import bounded_broadcast, fits_broadcast, hashed_where_small
from quire.session import materialize

SCORE_DIGITS = 9


def term_freqs(text_col, min_len: int = 4) -> Column:
    """In-row term frequencies: ``array<struct<term, tf>>`` of a text.

    The document's terms are sorted and each run of equal terms becomes one
    entry, so (document, term) counts need no shuffle.
    """
    none = F.array().cast("array<struct<term:string,tf:bigint>>")

    def runs_of(ts):
        def emit(ends):
            return F.transform(
                ends,
                lambda e, j: F.struct(
                    F.get(ts, e).alias("term"),
                    (e - F.coalesce(F.get(ends, j - 1), F.lit(-1))).cast("long").alias("tf"),
                ),
            )

        ends = F.filter(F.sequence(F.lit(0), F.size(ts) - 1), lambda i: ~F.get(ts, i).eqNullSafe(F.get(ts, i + 1)))
        return F.when(F.size(ts) > 0, T.let(ends, emit)).otherwise(none)

    # sort_array compares natively; array_sort would by an interpreted lambda
    return T.let(F.sort_array(T.terms(T._col(text_col), min_len)), runs_of)


def term_counts(df: DataFrame, keys: list[str], text_col: str, min_len: int = 4) -> DataFrame:
    """keys + (term, tf), counted in-row (rows of one key set stay in its task)."""
    return df.select(*keys, F.explode(term_freqs(F.col(text_col), min_len)).alias("_t")).select(
        *keys, F.col("_t.term").alias("term"), F.col("_t.tf").alias("tf")
    )


def tfidf_scores(
    docs: DataFrame,
    queries: DataFrame,
    group: str = "collection",
    key: str = "doc_id",
    text_col: str = "text",
    query_col: str = "query",
    min_len: int = 4,
    salt: int = 1,
) -> DataFrame:
    """(group, key, score, overlap) for every document of ``docs``.

    ``queries`` has one row per group with the query text.  Scores are rounded
    to ``SCORE_DIGITS`` decimals so that ties are stable across engines.
    """
    # terms of documents without a query are not stored; where the queries are
    # too many to broadcast, whole texts would be shuffled for it, so they are
    asked = queries.select(group)
    held = docs.join(F.broadcast(asked), group, "left_semi") if fits_broadcast(asked) else docs
    dt = materialize(term_counts(held, [group, key], text_col, min_len), "terms")
    return tfidf_from_terms(dt, docs.select(group, key), queries, group, key, query_col, min_len, salt)


def tfidf_from_terms(
    dt: DataFrame,
    doc_keys: DataFrame,
    queries: DataFrame,
    group: str = "collection",
    key: str = "doc_id",
    query_col: str = "query",
    min_len: int = 4,
    salt: int = 1,
    weight: str | None = None,
) -> DataFrame:
    """TF-IDF cosine and overlap from a document-term table (group, key, term, tf).

    The result has the columns of ``doc_keys``, a row for each of its rows, and
    score and overlap.  Documents of the same text may share one set of terms:
    ``doc_keys`` then has its key once for each of them, and ``weight`` names the
    column of ``dt`` that counts them.

    ``salt > 1`` spreads each (collection, term) key of the idf join over
    ``salt`` buckets (documents hashed to a bucket, idf rows replicated per
    bucket), for a hot term in a hot collection when AQE's skew join is not
    available; results are the same.

    ``dt`` should be a stored table (see ``quire.session.materialize``): it is
    read twice -- for document frequencies and for the per-document aggregate
    (norm, dot product and hits in one pass, after the idf join and a left
    join to the broadcast, size-checked query-term table).
    """
    # Only collections with a query can score above 0.  Restricting the work
    # to them also bounds every per-collection table by the query table, so
    # the collection-keyed joins below broadcast instead of hashing a hot
    # collection into one task.
    qgroups = bounded_broadcast(queries.select(group).distinct(), witness=queries)
    dt = dt.join(qgroups, group, "left_semi")
    n_docs = bounded_broadcast(
        doc_keys.join(qgroups, group, "left_semi").groupBy(group).agg(F.count(F.lit(1)).alias("n_docs")),
        witness=queries,
    )
    idf = (
        dt.groupBy(group, "term")
        .agg((F.sum(weight) if weight else F.count(F.lit(1))).alias("df"))
        .join(n_docs, group)
        .select(group, "term", F.log(1.0 + F.col("n_docs") / F.col("df")).alias("idf"))
    )
    # a table of its own: AQE splits the partition of a hot term only where no
    # aggregate stands between a side's exchange and the join
    idf = materialize(idf, "idf")
    # term first: it tells rows apart, also by the first bytes that a sort compares
    on = ["term", group]
    qt = term_counts(queries, [group], query_col, min_len).withColumnRenamed("tf", "qtf")
    w = F.col("tf") * F.col("idf")
    qw = F.col("qtf") * F.col("idf")
    if salt > 1:
        dt_j = dt.withColumn("_salt", F.pmod(F.xxhash64(key), F.lit(salt)))
        idf_j = idf.withColumn("_salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(salt - 1).cast("long"))))
        joined = dt_j.join(idf_j, [*on, "_salt"]).drop("_salt")
    else:
        joined = dt.join(hashed_where_small(idf), on)
    per_doc = (
        joined
        .join(bounded_broadcast(qt), on, "left")
        .groupBy(group, key)
        .agg(
            F.sqrt(F.sum(F.pow(w, 2))).alias("dnorm"),
            F.sum(w * qw).alias("dot"),
            F.count("qtf").alias("n_hit"),
        )
    )
    per_query = (
        qt.join(idf, [group, "term"], "left")
        .groupBy(group)
        .agg(
            F.sqrt(F.sum(F.pow(F.coalesce(qw, F.lit(0.0)), 2))).alias("qnorm"),
            F.count(F.lit(1)).alias("n_qterms"),
        )
    )
    out = doc_keys.join(per_doc, [group, key], "left").join(
        bounded_broadcast(per_query, witness=queries), group, "left"
    )
    denom = F.col("dnorm") * F.col("qnorm")
    score = F.when(F.coalesce(denom, F.lit(0.0)) > 0, F.coalesce(F.col("dot"), F.lit(0.0)) / denom).otherwise(0.0)
    overlap = F.when(
        F.coalesce(F.col("n_qterms"), F.lit(0)) > 0, F.coalesce(F.col("n_hit"), F.lit(0)) / F.col("n_qterms")
    ).otherwise(0.0)
    return out.select(
        *doc_keys.columns,
        F.round(score, SCORE_DIGITS).alias("score"),
        F.round(overlap, SCORE_DIGITS).alias("overlap"),
    )


def term_overlap(doc_text, query_text, min_len: int = 4) -> Column:
    """In-row overlap: distinct query terms present in the text / distinct query terms."""
    def ratio(q):
        hit = F.size(F.array_intersect(q, F.array_distinct(T.terms(doc_text, min_len))))
        return F.when(F.size(q) > 0, hit / F.size(q)).otherwise(F.lit(0.0))

    return T.let(F.array_distinct(T.terms(query_text, min_len)), ratio)


def bm25_scores(
    dt: DataFrame,
    doc_keys: DataFrame,
    queries: DataFrame,
    candidates: DataFrame,
    k1: float,
    b: float,
    group: str = "collection",
    key: str = "doc_id",
    query_col: str = "query",
    min_len: int = 4,
    weight: str | None = None,
) -> DataFrame:
    """BM25 of ``candidates`` (``group``, ``key`` and any other columns, which are
    kept) to their group's query: ``bm25``, rounded to ``SCORE_DIGITS`` decimals.

      idf(t)   ln(1 + (N - df + 0.5) / (df + 0.5)), over the documents of the group
      score    sum over the query's distinct terms in the document of
               idf * tf * (k1 + 1) / (tf + k1 * (1 - b + b * length / mean length))

    A length is the number of terms; documents without terms count in N and in the
    mean.  ``dt`` (group, key, term, tf), ``doc_keys`` and ``weight`` as in
    ``tfidf_from_terms``.  Only rows of query terms are joined, and only those of
    candidates are scored; a candidate without any query term has score 0.
    """
    asked = bounded_broadcast(queries.select(group).distinct(), witness=queries)
    n_docs = doc_keys.join(asked, group, "left_semi").groupBy(group).agg(F.count(F.lit(1)).alias("n_docs"))
    qt = term_counts(queries, [group], query_col, min_len).drop("tf")
    hits = dt.join(bounded_broadcast(qt), [group, "term"])
    listed = F.col(weight) if weight else F.lit(1)
    # the terms of a document leave its task as one length
    lengths = dt.join(asked, group, "left_semi").groupBy(group, key).agg(F.sum("tf").alias("length"), F.max(listed).alias("_listed"))
    mean = lengths.groupBy(group).agg(F.sum(F.col("length") * F.col("_listed")).alias("_terms"))
    mean = n_docs.join(mean, group, "left").select(group, "n_docs", (F.col("_terms") / F.col("n_docs")).alias("mean_length"))
    df = hits.groupBy(group, "term").agg(F.sum(listed).alias("df"))
    idf = df.join(bounded_broadcast(mean, witness=queries), group).select(
        group, "term", "mean_length", F.log(1 + (F.col("n_docs") - F.col("df") + 0.5) / (F.col("df") + 0.5)).alias("idf")
    )
    among = bounded_broadcast(candidates.select(group, key).distinct())
    met = hits.join(among, [group, key], "left_semi").join(idf, [group, "term"]).join(lengths.join(among, [group, key], "left_semi"), [group, key])
    saturated = F.col("tf") * (k1 + 1) / (F.col("tf") + k1 * (1 - b + b * F.col("length") / F.col("mean_length")))
    scored = met.groupBy(group, key).agg(F.round(F.sum(F.col("idf") * saturated), SCORE_DIGITS).alias("bm25"))
    return candidates.join(scored, [group, key], "left").withColumn("bm25", F.coalesce("bm25", F.lit(0.0)))


# --------------------------------------------------------------------------- dense vectors

def dot(a, b) -> Column:
    """Dot product of two numeric arrays, accumulated in double."""
    return F.aggregate(
        F.zip_with(T._col(a), T._col(b), lambda x, y: x.cast("double") * y.cast("double")),
        F.lit(0.0),
        lambda acc, v: acc + v,
    )


def norm(a) -> Column:
    """Length of a dense vector."""
    return F.sqrt(dot(a, a))


def cosine(a, b, a_norm=None, b_norm=None) -> Column:
    """Cosine similarity of two dense vectors (0 when a norm is 0 or a vector is
    null); norms that are stored need not be computed again."""
    n = (norm(a) if a_norm is None else T._col(a_norm)) * (norm(b) if b_norm is None else T._col(b_norm))
    return F.when(n > 0, dot(a, b) / n).otherwise(F.lit(0.0))


def euclidean(a, b) -> Column:
    diff = F.zip_with(T._col(a), T._col(b), lambda x, y: x.cast("double") - y.cast("double"))
    return F.sqrt(F.aggregate(diff, F.lit(0.0), lambda acc, v: acc + v * v))


def centroids(vectors: DataFrame, group: str, vec_col: str) -> DataFrame:
    """(group, centroid array<double>): element-wise mean per group.

    Vectors are exploded to (group, dim, value) and averaged with map-side
    partial aggregation, so a hot group is combined inside each task before
    the shuffle; the re-assembled array has one entry per dimension.
    """
    per_dim = (
        vectors.select(group, F.posexplode(vec_col).alias("dim", "v"))
        .groupBy(group, "dim")
        .agg(F.avg(F.col("v").cast("double")).alias("v"))
    )
    return per_dim.groupBy(group).agg(
        F.transform(F.array_sort(F.collect_list(F.struct("dim", "v"))), lambda s: s["v"]).alias("centroid")
    )
