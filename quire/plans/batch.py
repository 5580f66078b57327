"""Batch over all collection folders: discover, read, rank, extract, write.

The whole root is one Spark job graph -- collections are a key, not a loop.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession

from quire.plans import analysis as PL
from quire.session import materialize
from quire.sources import collections as C
from quire.sources import sinks


def run_root(
    spark: SparkSession,
    root: str,
    out: str,
    cfg: PL.JobConfig | None = None,
    parser: Callable[[bytes], Iterable[str]] | None = None,
) -> dict[str, DataFrame]:
    """Process every collection under ``root`` and write results to ``out``.

    Documents are plain text with form-feed page breaks unless ``parser``
    (bytes -> page texts) is given for binary files.  Returns the tables
    written, for inspection.
    """
    cfg = cfg or PL.JobConfig(lines_per_page=None)
    specs, bad_specs = C.read_specs(spark, root)
    documents = C.list_documents(spark, root)   # names only, for discovery and checks
    collections = C.discover(specs, documents, C.empty_folders(specs, documents, root))
    man = C.manifest(collections)
    jobs = C.jobs(collections)
    docs, failed = C.analysis_docs(man), None
    if parser is None:
        outputs = PL.run(docs, jobs, cfg, files=C.read_text_documents(spark, root))
    else:
        # parsed documents stay page rows all the way (no document is one row);
        # parse once: quarantine and the analysis both read the stored pages
        parsed = materialize(C.parse_binary_documents(spark, root, parser, listed=man), "parsed")
        # files that no manifest lists may or may not have been parsed
        failed = C.failed_documents(parsed).join(man.select("collection", "filename"), ["collection", "filename"], "left_semi")
        pages = parsed.where("error IS NULL").select("collection", "filename", "page_number", "text")
        outputs = PL.run(docs, jobs, cfg, pages=pages, failed=failed)
    results = PL.result_documents(docs, jobs, cfg, outputs)
    sinks.write_results(results, out)
    sinks.write_input_documents(man, out)
    missing = C.missing_documents(man, documents)
    sinks.write_quarantine(bad_specs, out, "specs")
    sinks.write_quarantine(missing, out, "missing_documents")
    if failed is not None:
        sinks.write_quarantine(failed, out, "unreadable_documents")
    written = sinks.read_results(spark, out, results.schema)
    no_output = sinks.collections_without_output(specs, written)
    sinks.write_quarantine(no_output, out, "no_output")
    return {
        "results": written, "specs": specs, "bad_specs": bad_specs, "missing": missing,
        "no_output": no_output, "manifest": man, **outputs,
    }
