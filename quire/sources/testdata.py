"""Adapters from the driver's parquet tables to the canonical tables.

``documents(doc_id, text, lang, source, n_chars)`` becomes the document table
of many collections (``collection = source``); ``benchmark(item_id, text)``
gives one job per collection ``src{item_id}``.  File names are derived so that
both document-type branches occur (with and without ``" - "``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed persona of the test jobs.
TEST_PERSONA = "Research Analyst"
# Keyword lists that match this corpus (the travel defaults match nothing here).
TEST_RELEVANCE_KEYWORDS = ["when", "queue", "schen"]
TEST_ACTION_WORDS = ["what", "when", "schen"]
LINES_PER_PAGE = 4


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def spread(df: DataFrame, key: str) -> DataFrame:
    """The table as scanned, unless the session sets ``spark.quire.spread`` to a
    number of partitions (the test tables are single-row-group files, which one
    task reads; ``bench.py`` sets it for its small local inputs)."""
    n = int(df.sparkSession.conf.get("spark.quire.spread", "0"))
    return df.repartition(n, key) if n else df


def filename_col(doc_id="doc_id", source="source", lang="lang"):
    d, s, l = F.col(doc_id), F.col(source), F.col(lang)
    return F.when(d % 2 == 0, F.concat(s, F.lit(" - "), l, F.lit("_"), d.cast("string"), F.lit(".txt"))).otherwise(
        F.concat(l, F.lit("_"), d.cast("string"), F.lit("-v2b.txt"))
    )


def docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """docs(collection, doc_id, doc_ord, filename, text)."""
    d = spread(table(spark, sf_dir, "documents"), "doc_id")
    return d.select(
        F.col("source").alias("collection"),
        F.col("doc_id"),
        F.col("doc_id").alias("doc_ord"),
        filename_col().alias("filename"),
        F.coalesce(F.col("text"), F.lit("")).alias("text"),
    )


def jobs(spark: SparkSession, sf_dir: str, persona: str = TEST_PERSONA) -> DataFrame:
    """jobs(collection, persona, task): one job per benchmark item."""
    b = table(spark, sf_dir, "benchmark")
    return b.select(
        F.concat(F.lit("src"), F.col("item_id").cast("string")).alias("collection"),
        F.lit(persona).alias("persona"),
        F.col("text").alias("task"),
    )


def present_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents whose file exists: the labelled ones (doc_id)."""
    return table(spark, sf_dir, "labels").select("doc_id")
