"""Result sinks: one JSON result per collection, plus side tables.

``write_results`` writes the nested result rows partitioned by collection
(``<out>/collection=<name>/part-*.json``), one output per collection.  The
list of input documents grows with the collection, so it is written as rows
(``<out>/_input_documents``) rather than collected into the result row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame


def _write_by_collection(rows: DataFrame, path: str, replace: bool) -> None:
    """Overwrites the whole folder or, with ``replace``, the folders of the
    collections in ``rows`` only: writing the same rows again changes nothing."""
    kind = "dynamic" if replace else "static"
    rows.write.mode("overwrite").option("partitionOverwriteMode", kind).partitionBy("collection").json(path)


def write_results(results: DataFrame, out: str, replace: bool = False) -> None:
    _write_by_collection(results.repartition("collection"), f"{out.rstrip('/')}/results", replace)


def write_input_documents(manifest: DataFrame, out: str, replace: bool = False) -> None:
    _write_by_collection(manifest.select("collection", "doc_ord", "filename"), f"{out.rstrip('/')}/_input_documents", replace)


def write_quarantine(rows: DataFrame, out: str, name: str, mode: str = "overwrite") -> None:
    rows.write.mode(mode).json(f"{out.rstrip('/')}/_quarantine/{name}")


def collections_without_output(collections: DataFrame, results: DataFrame) -> DataFrame:
    """Discovered collections that produced no result row."""
    return collections.select("collection").join(results.select("collection"), "collection", "left_anti")


def read_results(spark, out: str, schema=None) -> DataFrame:
    """Read written results; pass the written schema so that the partition
    column keeps its string type (a collection named ``007`` stays ``007``)."""
    reader = spark.read.schema(schema) if schema is not None else spark.read
    return reader.json(f"{out.rstrip('/')}/results")
