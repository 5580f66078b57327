"""The corpus pipeline: documents in, training sequences out.

``STAGES`` are applied in order; each function takes (spark, docs, sf_dir) and
returns a DataFrame that is written as Parquet and read again as the next one's
``docs``.  All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.llm import catalog, pii, quality, simhash
from quire.session import materialize


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go."""
    return quality.good_documents(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group stays: 3-word shingles, 3 bits."""
    return simhash.one_per_group(docs)


def without_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is replaced by its kind; ``n_chars`` follows the text."""
    clean = pii.redact(docs)
    return clean.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(*docs.columns)


def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of at most 2048 ids, one row a piece."""
    return catalog.packed(spark, docs)


STAGES = [
    ("quality rules", good_quality),
    ("simhash near-dedup", near_duplicates),
    ("pii", without_personal_data),
    ("packing", sequences),
]

# Stages tokenise and fingerprint whole texts, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages applied to ``documents``, each stored before the next."""
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = materialize(docs, "stage")
    return docs
