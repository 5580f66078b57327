"""Real-input path: collection folders with a JSON job spec and documents.

Layout::

    <root>/<collection>/challenge1b_input.json   job spec
    <root>/<collection>/PDFs/<file>              documents

The collection name is the spec's parent folder, taken from the file path
Spark records for every row (``_metadata.file_path``).  Everything is read
for all collections at once; malformed specs and unreadable documents are
split into quarantine tables instead of stopping the run.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quire.operators.ranking import ROW_BYTES, fits_broadcast
from quire.session import materialize

# Fixed values of the input layout (file name of a job spec, document folder);
# both are parameters of the readers.
SPEC_NAME = "challenge1b_input.json"
DOCS_FOLDER = "PDFs"

SPEC_SCHEMA = T.StructType([
    T.StructField("challenge_info", T.StructType([
        T.StructField("challenge_id", T.StringType()),
        T.StructField("test_case_name", T.StringType()),
    ])),
    T.StructField("documents", T.ArrayType(T.StructType([
        T.StructField("filename", T.StringType()),
        T.StructField("title", T.StringType()),
    ]))),
    T.StructField("persona", T.StructType([T.StructField("role", T.StringType())])),
    T.StructField("job_to_be_done", T.StructType([T.StructField("task", T.StringType())])),
    T.StructField("_corrupt_record", T.StringType()),
])

# Page texts gathered before they are passed on by a parsing task.
PAGES_BYTES = 16 << 20
PAGE_COLUMNS = ["path", "page_number", "text", "error"]
PAGE_SCHEMA = "path string, page_number int, text string, error string"


def _parsed(parser: Callable[[bytes], Iterable[str]], path: str, content) -> Iterator[tuple]:
    """Rows of one document, as the parser yields its pages."""
    try:
        for i, page in enumerate(parser(bytes(content)), 1):
            if not isinstance(page, str):
                raise TypeError(f"page {i} is {type(page).__name__}, not str")
            page.encode("utf-8")
            yield path, i, page, None
    except Exception as e:  # noqa: BLE001 -- isolate one document
        yield path, None, None, f"{type(e).__name__}: {e}".encode("utf-8", "backslashreplace").decode()


def _decode(part):
    """File paths come as URIs (``%20`` for a blank); keep a literal ``+``."""
    return F.url_decode(F.regexp_replace(part, r"\+", "%2B"))


def _parent_dir(path_col, levels: int = 1):
    """Name of the folder ``levels`` above the file (1 = its own folder)."""
    parts = F.split(path_col, "/")
    return _decode(F.element_at(parts, -1 - levels))


def _basename(path_col):
    return _decode(F.element_at(F.split(path_col, "/"), -1))


def read_specs(spark: SparkSession, root: str, spec_name: str = SPEC_NAME) -> tuple[DataFrame, DataFrame]:
    """(specs, quarantine).

    specs: (collection, persona, task, documents); quarantine: (collection,
    path, reason) for files that are not valid JSON or lack persona/task.
    """
    raw = (
        spark.read.schema(SPEC_SCHEMA)
        .option("multiLine", True)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", "_corrupt_record")
        .json(f"{root.rstrip('/')}/*/{spec_name}")
        .select("*", F.col("_metadata.file_path").alias("path"))
    )
    return split_specs(raw)


def split_specs(raw: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Good/quarantine split of raw spec rows (SPEC_SCHEMA plus ``path``)."""
    raw = raw.withColumn("collection", _parent_dir(F.col("path")))
    reason = (
        F.when(F.col("_corrupt_record").isNotNull(), F.lit("malformed json"))
        .when(F.col("persona.role").isNull(), F.lit("missing persona.role"))
        .when(F.col("job_to_be_done.task").isNull(), F.lit("missing job_to_be_done.task"))
    )
    raw = raw.withColumn("reason", reason)
    good = raw.where(F.col("reason").isNull()).select(
        "collection",
        F.col("persona.role").alias("persona"),
        F.col("job_to_be_done.task").alias("task"),
        F.coalesce(F.col("documents"), F.array().cast(SPEC_SCHEMA["documents"].dataType)).alias("documents"),
    )
    bad = raw.where(F.col("reason").isNotNull()).select("collection", "path", "reason")
    return good, bad


def jobs(specs: DataFrame) -> DataFrame:
    """jobs(collection, persona, task)."""
    return specs.select("collection", "persona", "task")


def manifest(specs: DataFrame) -> DataFrame:
    """manifest(collection, doc_ord, filename, title): listed documents in list order."""
    return specs.select("collection", F.posexplode("documents").alias("doc_ord", "d")).select(
        "collection", F.col("doc_ord").cast("bigint").alias("doc_ord"), F.col("d.filename").alias("filename"),
        F.col("d.title").alias("title"),
    )


def _files(reader, root: str, folder: str, pattern: str, collections: str) -> DataFrame:
    """The files in the document folders; a folder may be empty."""
    return reader.option("pathGlobFilter", pattern).load(f"{root.rstrip('/')}/{collections}/{folder}")


def list_documents(spark: SparkSession, root: str, folder: str = DOCS_FOLDER, pattern: str = "*",
                   collections: str = "*") -> DataFrame:
    """(collection, filename) of every document file, from the file listing
    only (a binaryFile scan that selects no content reads no bytes).
    ``collections`` is a glob over collection folder names."""
    files = _files(spark.read.format("binaryFile"), root, folder, pattern, collections).select("path")
    return files.select(_parent_dir(F.col("path"), 2).alias("collection"), _basename(F.col("path")).alias("filename"))


# Names whose folders are looked up between two writes.
FOLDERS_AT_ONCE = 10_000


def empty_folders(specs: DataFrame, documents: DataFrame, root: str, folder: str = DOCS_FOLDER) -> DataFrame:
    """(collection) of the specs that have no files but a document folder.

    A listing of files does not show these, so the folder of each spec without
    files is looked up in the file system.  Names pass the driver in pieces and are
    stored; the collections that do have files never do."""
    spark = specs.sparkSession
    bare = specs.select("collection").distinct().join(documents.select("collection"), "collection", "left_anti")
    hadoop, conf = spark.sparkContext._jvm.org.apache.hadoop.fs, spark.sparkContext._jsc.hadoopConfiguration()
    found, stored = [], None

    def store():
        part = materialize(spark.createDataFrame([(n,) for n in found], "collection string"), "folders")
        return part if stored is None else stored.unionByName(part)

    for row in bare.toLocalIterator():
        path = hadoop.Path(f"{root.rstrip('/')}/{row.collection}/{folder}")
        fs = path.getFileSystem(conf)
        if fs.exists(path) and fs.getFileStatus(path).isDirectory():
            found.append(row.collection)
        if len(found) >= FOLDERS_AT_ONCE:
            stored, found = store(), []
    return store() if found or stored is None else stored


def read_text_documents(spark: SparkSession, root: str, folder: str = DOCS_FOLDER, pattern: str = "*",
                        collections: str = "*") -> DataFrame:
    """(collection, filename, text) from plain-text documents; pages are
    separated by form feeds.  ``collections`` is a glob over folder names."""
    df = _files(spark.read.format("text").option("wholetext", True), root, folder, pattern, collections)
    path = F.col("_metadata.file_path")
    return df.select(_parent_dir(path, 2).alias("collection"), _basename(path).alias("filename"), F.col("value").alias("text"))


def parse_binary_documents(
    spark: SparkSession,
    root: str,
    parser: Callable[[bytes], Iterable[str]],
    folder: str = DOCS_FOLDER,
    pattern: str = "*",
    listed: DataFrame | None = None,
) -> DataFrame:
    """Page rows from binary documents through a user-supplied parser.

    ``parser(content) -> iterable of page texts`` runs inside
    ``mapInPandas`` (one Python worker per task, batches of files).  Pages are passed
    on while the parser yields them, in pieces of about ``PAGES_BYTES``, so a task
    holds no document's pages as a whole.  What a parser raises, and pages that are
    no strings or no valid Unicode, end the document with a row that has ``error``
    set; it voids the pages passed on before (see ``split_page_errors``).  With
    ``listed`` (collection, filename) files that are not listed are not parsed,
    where the list can be broadcast.  Returns (collection, filename, page_number,
    text, error).
    """
    files = _files(spark.read.format("binaryFile"), root, folder, pattern, "*").select("path", "content")
    names = [_parent_dir(F.col("path"), 2).alias("collection"), _basename(F.col("path")).alias("filename")]
    if listed is not None and fits_broadcast(listed := listed.select("collection", "filename").distinct()):
        files = files.select("*", *names).join(F.broadcast(listed), ["collection", "filename"], "left_semi").select("path", "content")

    def run(batches: Iterable[pd.DataFrame]) -> Iterable[pd.DataFrame]:
        rows, size = [], 0
        for b in batches:
            for path, content in zip(b["path"], b["content"]):
                for row in _parsed(parser, path, content):
                    rows.append(row)
                    # a row counts for itself, as many pages may be empty
                    size += ROW_BYTES + len(row[2] or "")
                    if size >= PAGES_BYTES:
                        yield pd.DataFrame(rows, columns=PAGE_COLUMNS)
                        rows, size = [], 0
        if rows:
            yield pd.DataFrame(rows, columns=PAGE_COLUMNS)

    pages = files.mapInPandas(run, PAGE_SCHEMA)
    path = F.col("path")
    return pages.select(_parent_dir(path, 2).alias("collection"), _basename(path).alias("filename"), "page_number", "text", "error")


def split_page_errors(pages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(good pages, failed(collection, filename, error)): a document with any
    error row is excluded as a whole (anti join) and reported."""
    failed = failed_documents(pages)
    ok = pages.where(F.col("error").isNull()).join(failed, ["collection", "filename"], "left_anti")
    return ok.drop("error"), failed


def failed_documents(pages: DataFrame) -> DataFrame:
    """failed(collection, filename, error) of documents with any error row; of
    several errors the first in code-point order."""
    return pages.where(F.col("error").isNotNull()).groupBy("collection", "filename").agg(F.min("error").alias("error"))


def discover(specs: DataFrame, documents: DataFrame, folders: DataFrame | None = None) -> DataFrame:
    """Collections having both a job spec and a document folder: files in it, or a
    row in ``folders`` (see ``empty_folders``)."""
    there = documents.select("collection")
    if folders is not None:
        there = there.unionByName(folders.select("collection"))
    return specs.join(there.distinct(), "collection", "left_semi")


def missing_documents(man: DataFrame, documents: DataFrame) -> DataFrame:
    """Manifest entries whose file is not in the document folder."""
    return man.join(documents.select("collection", "filename"), ["collection", "filename"], "left_anti")


def analysis_docs(man: DataFrame) -> DataFrame:
    """docs(collection, doc_id, doc_ord, filename) for the analysis, whose texts or
    pages come by file.  Every manifest entry is kept (a file listed twice appears
    twice): a missing file is still ranked, but has no pages and yields no section
    or subsection."""
    return man.select("collection", F.col("doc_ord").alias("doc_id"), "doc_ord", "filename")
