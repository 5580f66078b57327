"""Command line: process every collection folder under a root.

    python -m quire <root> <out> [--body] [--no-rerank] [--lines-per-page N]
                    [--keywords a,b,c] [--actions a,b,c] [--min-similarity X]

``<root>/<collection>/challenge1b_input.json`` plus ``<root>/<collection>/PDFs/*``
(plain text, form feed = page break) in; ``<out>/results/collection=<name>/``
JSON, ``<out>/_input_documents`` and ``<out>/_quarantine`` out.
"""

from __future__ import annotations

import argparse
import time

from quire.plans import analysis as PL
from quire.plans import batch
from quire.session import drop_stored, get_session


def main(argv: list[str] | None = None) -> None:
    ap = argparse.ArgumentParser(prog="quire", description=__doc__.split("\n\n")[0])
    ap.add_argument("root")
    ap.add_argument("out")
    ap.add_argument("--master", default=None, help="Spark master (default: from the environment)")
    ap.add_argument("--body", action="store_true", help="rank on document text instead of file-name templates")
    ap.add_argument("--no-rerank", action="store_true")
    ap.add_argument("--lines-per-page", type=int, default=None, help="N lines per page instead of form feeds")
    ap.add_argument("--keywords", default=None, help="comma-separated relevance keywords")
    ap.add_argument("--actions", default=None, help="comma-separated action words")
    ap.add_argument("--min-similarity", type=float, default=None)
    a = ap.parse_args(argv)
    cfg = PL.JobConfig(
        lines_per_page=a.lines_per_page,
        rank_text="body" if a.body else "template",
        rerank=not a.no_rerank,
        min_similarity=a.min_similarity,
    )
    if a.keywords:
        cfg.relevance_keywords = [w for w in a.keywords.split(",") if w]
    if a.actions:
        cfg.action_words = [w for w in a.actions.split(",") if w]
    spark = get_session(a.master)
    t0 = time.time()
    res = batch.run_root(spark, a.root, a.out, cfg)
    n = res["results"].count()
    print(f"{n} collection result(s) written to {a.out} in {time.time() - t0:.1f} s")
    missing = res["no_output"].count()
    if missing:
        print(f"{missing} collection(s) produced no output; see {a.out}/_quarantine/no_output")
    drop_stored(spark)


if __name__ == "__main__":
    main()
