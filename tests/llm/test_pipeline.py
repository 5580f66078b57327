import re

import duckdb
import numpy as np
from pyspark.sql import functions as F

import corpus_pipeline
from quire.llm import catalog
from quire.session import materialize
from tests.conftest import SF_SMALL
from tests.llm import brute
from tests.llm.test_packing import check, ids_of
from tests.llm.test_pii import base_spans


def stages(spark, docs, sf=SF_SMALL):
    out = []
    for _, f in corpus_pipeline.STAGES:
        docs = materialize(f(spark, docs, sf), "test-stage")
        out.append(docs)
    return out


def test_stages_against_brute_force(spark):
    docs = catalog.table(spark, SF_SMALL, "documents")
    good, single, clean, packed = stages(spark, docs)
    assert good.columns == single.columns == clean.columns == docs.columns
    verdict = {r.doc_id for r in catalog.op6_quality(spark, SF_SMALL).where("kept").collect()}
    rows = {r.doc_id: r for r in good.collect()}
    assert set(rows) == verdict and all(rows[d.doc_id] == d for d in docs.collect() if d.doc_id in verdict)
    groups = brute.simhash_components([(d, r.text) for d, r in rows.items()])
    assert sorted(r.doc_id for r in single.collect()) == sorted({g[2] for g in groups})
    texts = {}
    for r in clean.collect():
        before, texts[r.doc_id] = rows[r.doc_id].text, r.text
        assert not base_spans(re.sub(r"\[[A-Z_]+\]", "", r.text)) or r.text != before
        assert r.n_chars == len(r.text) and (r.text == before or "[" in r.text)
        assert (r.text != before) >= bool(base_spans(before))
    pieces = packed.collect()
    ids = {d: ids_of(t) for d, t in texts.items()}
    check([(p.doc_id, p.start, p.length, np.array(ids[p.doc_id][p.start : p.start + p.length], "<u4").tobytes(), p.doc_tokens, p.sequence_id, p.offset) for p in pieces], ids)
    # the registered query runs the same stages
    key = lambda found: sorted((r.doc_id, r.start, r.length, r.ids_crc32, r.doc_tokens) for r in found)
    assert key(corpus_pipeline.run(spark, SF_SMALL).collect()) == key(pieces)


def test_null_and_empty_rows(spark):
    prose = duckdb.sql(f"select text from '{SF_SMALL}/documents.parquet' where doc_id = 1").fetchall()[0][0]
    rows = [(None, prose, None, None, None), (1, None, "en", "s", 0), (2, "", "en", "s", 0), (3, prose, "en", None, 1), (3, prose, "en", None, 1)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint").withColumn("spans", F.lit("clash"))
    out = stages(spark, docs)
    assert [o.count() for o in out[:3]] == [3, 1, 1] and out[2].columns == docs.columns
    assert [o.count() for o in stages(spark, docs.limit(0))] == [0, 0, 0, 0]
