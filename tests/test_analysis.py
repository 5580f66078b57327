"""End to end: collection folders -> nested JSON results, plus pipeline properties."""
import json
import os

import pytest

from pyspark.sql import functions as F

from quire.plans import batch
from quire.plans import analysis as PL

PERSONA = "Travel Planner"
TASK = "Plan a trip of 4 days for a group of 10 college friends."


def page(*lines):
    return "\n".join(lines)


DOC_A = "\f".join([
    page("Coastal Guide: beaches", "How to visit the coast in spring with friends and family.", "x" * 100),
    "",
    page("Nightlife Tips. Bars and clubs", "Recommend the old town for an evening walk, step by step."),
    page("A longer page of text " * 8, "visit the market and plan the day"),
])
DOC_B = "\f".join([page("no headings here", "just words"), page("Packing list", "short")])


def make_root(tmp_path):
    root = tmp_path / "in"
    good = root / "Collection 1"
    (good / "PDFs").mkdir(parents=True)
    (good / "PDFs" / "South of France - Coast.txt").write_text(DOC_A)
    (good / "PDFs" / "packing_list.txt").write_text(DOC_B)
    spec = {
        "challenge_info": {"challenge_id": "x", "test_case_name": "t"},
        "documents": [{"filename": "South of France - Coast.txt", "title": "a"},
                      {"filename": "packing_list.txt", "title": "b"},
                      {"filename": "missing.txt", "title": "c"}],
        "persona": {"role": PERSONA},
        "job_to_be_done": {"task": TASK},
    }
    (good / "challenge1b_input.json").write_text(json.dumps(spec, indent=2))
    bad = root / "Broken"
    (bad / "PDFs").mkdir(parents=True)
    (bad / "PDFs" / "x.txt").write_text("x")
    (bad / "challenge1b_input.json").write_text("{ not json")
    nodocs = root / "NoDocs"
    nodocs.mkdir()
    (nodocs / "challenge1b_input.json").write_text(json.dumps({**spec, "documents": []}))
    return root


def test_collections_end_to_end(spark, tmp_path):
    root = make_root(tmp_path)
    out = tmp_path / "out"
    res = batch.run_root(spark, str(root), str(out))
    results = res["results"].collect()
    assert [r.collection for r in results] == ["Collection 1"]
    r = results[0]
    assert r.metadata.persona == PERSONA and r.metadata.job_to_be_done == TASK
    assert r.metadata.input_document_count == 3
    secs = r.extracted_sections
    assert {s.document for s in secs} == {"South of France - Coast.txt", "packing_list.txt"}
    ranks = [s.importance_rank for s in secs]
    assert ranks == sorted(ranks) and set(ranks) <= {1, 2, 3}
    coast = [s for s in secs if s.document.startswith("South")][0]
    assert coast.section_title == "Nightlife Tips" and coast.page_number == 3
    packing = [s for s in secs if s.document == "packing_list.txt"][0]
    assert packing.section_title == "Packing list" and packing.page_number == 2
    subs = r.subsection_analysis
    assert all(s.document == "South of France - Coast.txt" for s in subs)
    assert [s.page_number for s in subs] == [1, 4]   # page 3 is under 150 characters
    assert subs[0].refined_text == "Coastal Guide: beaches How to visit the coast in spring with friends and family."
    assert subs[1].refined_text == "visit the market and plan the day"
    # quarantine and side outputs
    assert [x.reason for x in res["bad_specs"].collect()] == ["malformed json"]
    assert [x.filename for x in res["missing"].collect()] == ["missing.txt"]
    assert sorted(x.collection for x in res["no_output"].collect()) == ["NoDocs"]
    assert os.path.isdir(out / "results" / "collection=Collection 1")
    assert spark.read.json(str(out / "_input_documents")).count() == 3


def test_pipeline_properties_on_testdata(spark):
    from quire.plans import catalog as C
    from quire.sources import testdata as TD
    sf = "/root/testdata/sf0.001"
    out = PL.run(TD.docs(spark, sf), TD.jobs(spark, sf), C.TEST_CONFIG)
    ranks = out["ranks"]
    per = ranks.groupBy("collection").agg(F.count("*").alias("n"), F.min("importance_rank").alias("lo"),
                                          F.max("importance_rank").alias("hi"), F.countDistinct("importance_rank").alias("d"))
    for r in per.collect():
        assert (r.lo, r.hi, r.d) == (1, r.n, r.n)
    sec = out["sections"].groupBy("collection").count().collect()
    assert all(r["count"] <= 5 for r in sec)
    sub = out["subsections"].groupBy("collection").count().collect()
    assert all(r["count"] <= 5 for r in sub)
    # every section page is an existing non-blank page of its document, or 1
    feats = out["features"].select("collection", "doc_id", F.col("first_pages"), "n_pages")
    assert out["sections"].where(F.col("page_number") < 1).count() == 0
    assert feats.count() > 0


def test_result_lists_its_input_documents(spark):
    docs = spark.createDataFrame(
        [("c", 11, 3, "a.txt", "Some Heading Here: visit"), ("c", 12, 1, "z.txt", ""), ("c", 13, 2, "m.txt", "plain"), ("c", 14, 10, "z.txt", "plain"), ("d", 15, 1, "b.txt", "")]
        + [("e", 100 + i, 500 - i, f"{i}.txt", "") for i in range(200)] + [("no job", 16, 1, "n.txt", "")],
        "collection string, doc_id long, doc_ord long, filename string, text string").repartition(3)
    jobs = spark.createDataFrame([(c, "Analyst", "find things") for c in ("c", "d", "e", "no documents")], "collection string, persona string, task string")
    res = PL.result_documents(docs, jobs, PL.JobConfig(rank_text="body"))
    got = {r.collection: r.metadata for r in res.collect()}
    # in manifest order; without text or listed twice, they are in the list
    assert {c: m.input_documents for c, m in got.items()} == {"c": ["z.txt", "m.txt", "a.txt", "z.txt"], "d": ["b.txt"], "e": [f"{i}.txt" for i in reversed(range(200))]}
    assert all(m.input_document_count == len(m.input_documents) for m in got.values())
    m = got["c"]
    assert m.parallel_workers >= 1 and (m.model_used, m.device) == ("extractive summary", "cpu")


def test_result_invariant_to_partitioning(spark):
    from quire.plans import catalog as C
    from quire.sources import testdata as TD
    sf = "/root/testdata/sf0.001"
    a = PL.run(TD.docs(spark, sf), TD.jobs(spark, sf), C.TEST_CONFIG)["sections"]
    b = PL.run(TD.docs(spark, sf).repartition(3), TD.jobs(spark, sf), C.TEST_CONFIG)["sections"]
    cols = ["collection", "document", "section_title", "importance_rank", "page_number"]
    assert sorted(map(tuple, a.select(cols).collect())) == sorted(map(tuple, b.select(cols).collect()))


def test_generator_hooks(spark):
    long_plain = "plain words only " * 10          # 170 characters, no keyword
    docs = spark.createDataFrame(
        [("c", 1, 1, "notes_a.txt", "lower case start\nno heading here"),
         ("c", 2, 2, "notes_b.txt", "Real Heading Here: intro\n" + long_plain)],
        "collection string, doc_id long, doc_ord long, filename string, text string")
    jobs = spark.createDataFrame([("c", "Analyst", "find things")], "collection string, persona string, task string")
    cfg = PL.JobConfig(lines_per_page=100, rank_text="body")
    feats = PL.features(PL.prepare(docs, jobs, cfg), cfg)
    req = {(r.doc_id, r.kind) for r in PL.generation_requests(feats, cfg, PL.jobs_with_query(jobs)).collect()}
    assert req == {(1, "titles"), (2, "relevance")}
    responses = PL.Responses(
        titles=spark.createDataFrame([("c", 1, 'Answer: "Generated Title Here"\nsecond line')], "collection string, doc_id long, response string"),
        verdicts=spark.createDataFrame([("c", 2, 1, "Yes.")], "collection string, doc_id long, page_number int, response string"),
        summaries=spark.createDataFrame([("c", 2, 1, "Summary: the gist.")], "collection string, doc_id long, page_number int, response string"),
    )
    out = PL.run(docs, jobs, cfg, responses)
    titles = {r.document: r.section_title for r in out["sections"].collect()}
    # the cleaned response is one line, so the parsed list has one title
    assert titles == {"notes_a.txt": "Generated Title Here\" second line", "notes_b.txt": "Real Heading Here"}
    subs = [(r.document, r.refined_text) for r in out["subsections"].collect()]
    assert subs == [("notes_b.txt", "the gist.")]


def test_command_line(spark, tmp_path, capsys):
    from quire.__main__ import main
    root = make_root(tmp_path)
    main([str(root), str(tmp_path / "cli-out"), "--keywords", "visit,plan"])
    assert "1 collection result(s)" in capsys.readouterr().out
    assert spark.read.json(str(tmp_path / "cli-out" / "results")).count() == 1


def _pages_parser(content: bytes):
    if content.startswith(b"BAD"):
        raise ValueError("cannot parse")
    return content.decode("utf-8").split("\f")


def list_documents(root, *names, collection="Collection 1"):
    spec = root / collection / "challenge1b_input.json"
    job = json.loads(spec.read_text())
    job["documents"] += [{"filename": n, "title": n} for n in names]
    spec.write_text(json.dumps(job))


def test_parser_keeps_collections_and_isolates_bad_strings(spark, tmp_path):
    """A collection whose only document fails still has its result; blank and
    unreadable documents are not missing; a page that is no valid Unicode, or
    no string, fails its own document only."""
    root = make_root(tmp_path)
    folder = root / "B"
    (folder / "PDFs").mkdir(parents=True)
    for name in ("bad.bin", "surrogate.bin", "number.bin", "blank.bin"):
        (folder / "PDFs" / name).write_text(name)
    (folder / "challenge1b_input.json").write_text(json.dumps({"documents": [], "persona": {"role": PERSONA}, "job_to_be_done": {"task": TASK}}))
    list_documents(root, "bad.bin", "surrogate.bin", "number.bin", "blank.bin", "gone.bin", collection="B")

    def parser(content: bytes):
        kind = content.decode("utf-8")
        if kind == "bad.bin":
            raise ValueError("cannot parse")
        return {"surrogate.bin": ["fine", "lone \ud800"], "number.bin": [7], "blank.bin": [" "]}.get(kind, kind.split("\f"))

    out = tmp_path / "out-b"
    res = batch.run_root(spark, str(root), str(out), parser=parser)
    by_name = {r.collection: r for r in res["results"].collect()}
    assert set(by_name) == {"B", "Collection 1"}
    assert by_name["B"].metadata.input_document_count == 5
    failed = spark.read.json(str(out / "_quarantine" / "unreadable_documents")).collect()
    assert sorted(r.filename for r in failed) == ["bad.bin", "number.bin", "surrogate.bin"]
    assert sorted(r.filename for r in res["missing"].collect()) == ["gone.bin", "missing.txt"]
    assert {r.collection for r in spark.read.json(str(out / "_quarantine" / "no_output")).collect()} == {"NoDocs"}


def test_parser_hook_isolates_failed_documents(spark, tmp_path):
    root = make_root(tmp_path)
    (root / "Collection 1" / "PDFs" / "broken.bin").write_bytes(b"BAD\x00\x01")
    (root / "Collection 1" / "PDFs" / "unlisted.bin").write_bytes(b"BAD: the job does not list it")
    list_documents(root, "broken.bin")
    out = tmp_path / "out-bin"
    res = batch.run_root(spark, str(root), str(out), parser=_pages_parser)
    failed = spark.read.json(str(out / "_quarantine" / "unreadable_documents")).collect()
    assert [(r.filename, r.error) for r in failed] == [("broken.bin", "ValueError: cannot parse")]
    r = res["results"].collect()[0]
    assert {s.document for s in r.extracted_sections} == {"South of France - Coast.txt", "packing_list.txt"}
    coast = [s for s in r.extracted_sections if s.document.startswith("South")][0]
    assert coast.page_number == 3   # form-feed pages survive the parser round trip


def test_options_restrict_and_min_similarity(spark):
    from dataclasses import replace
    from quire.plans import catalog as C
    from quire.sources import testdata as TD
    sf = "/root/testdata/sf0.001"
    docs, jobs = TD.docs(spark, sf), TD.jobs(spark, sf)
    out = PL.run(docs, jobs, replace(C.TEST_CONFIG, restrict_to_sections=True))
    sec = {(r.collection, r.document) for r in out["sections"].collect()}
    sub = {(r.collection, r.document) for r in out["subsections"].collect()}
    assert sub and sub <= sec
    out = PL.run(docs, jobs, replace(C.TEST_CONFIG, min_similarity=0.05))
    r = out["ranks"]
    assert r.where(F.col("score") < 0.05).count() == 0
    per = r.groupBy("collection").agg(F.count("*").alias("n"), F.max("importance_rank").alias("hi")).collect()
    assert all(x.n == x.hi for x in per)
    assert PL.model_label(C.TEST_CONFIG) == "tfidf-cosine + term-overlap rerank"


def test_document_without_text_gets_no_section(spark, tmp_path):
    root = tmp_path / "in"
    c = root / "C"
    (c / "PDFs").mkdir(parents=True)
    (c / "PDFs" / "empty.txt").write_text("  \f \n ")
    (c / "PDFs" / "full.txt").write_text("Main Heading Here\nsome words to visit")
    (c / "challenge1b_input.json").write_text(json.dumps({
        "documents": [{"filename": "empty.txt"}, {"filename": "full.txt"}],
        "persona": {"role": PERSONA}, "job_to_be_done": {"task": TASK}}))
    res = batch.run_root(spark, str(root), str(tmp_path / "out"))
    r = res["results"].collect()[0]
    assert [s.document for s in r.extracted_sections] == ["full.txt"]
    assert r.metadata.input_document_count == 2
    # the text-less document is still ranked
    assert res["ranks"].count() == 2


@pytest.mark.parametrize("mode", ["body", "template"])
def test_page_rows_path_equals_in_row_path(spark, mode):
    from dataclasses import replace
    from quire.operators import pages as P
    from quire.plans import catalog as C
    from quire.sources import testdata as TD
    sf = "/root/testdata/sf0.001"
    cfg = replace(C.TEST_CONFIG, rank_text=mode)
    docs, jobs = TD.docs(spark, sf), TD.jobs(spark, sf)
    pages = P.page_table(docs, keys=("collection", "doc_id"), lines_per_page=TD.LINES_PER_PAGE)
    a = PL.run(docs, jobs, cfg)
    b = PL.run(docs.drop("text"), jobs, cfg, pages=pages)
    for key, cols in [("sections", ["collection", "document", "section_title", "importance_rank", "page_number"]),
                      ("subsections", ["collection", "document", "refined_text", "importance_rank", "page_number"]),
                      ("ranks", ["collection", "doc_id", "score", "importance_rank"])]:
        assert sorted(map(tuple, a[key].select(cols).collect())) == sorted(map(tuple, b[key].select(cols).collect())), key
    fa = a["features"].select("collection", "doc_id", "n_pages", "has_heading", "section_title", "section_page", "first_pages")
    fb = b["features"].select(*fa.columns)
    assert fa.exceptAll(fb).count() == 0 and fb.exceptAll(fa).count() == 0


def test_numeric_looking_collection_name(spark, tmp_path):
    root = tmp_path / "in"
    c = root / "007"
    (c / "PDFs").mkdir(parents=True)
    (c / "PDFs" / "a.txt").write_text("Main Heading Here\nsome words")
    (c / "challenge1b_input.json").write_text(json.dumps({
        "documents": [{"filename": "a.txt"}], "persona": {"role": PERSONA}, "job_to_be_done": {"task": TASK}}))
    res = batch.run_root(spark, str(root), str(tmp_path / "out"))
    assert [r.collection for r in res["results"].collect()] == ["007"]
    assert res["no_output"].count() == 0


def test_parser_runs_once_per_file(spark, tmp_path):
    log = tmp_path / "calls.log"

    def counting_parser(content: bytes):
        with open(log, "a") as f:
            f.write("x\n")
        return content.decode("utf-8").split("\f")

    root = make_root(tmp_path)
    batch.run_root(spark, str(root), str(tmp_path / "out-count"), parser=counting_parser)
    listed = {d["filename"] for d in json.loads((root / "Collection 1" / "challenge1b_input.json").read_text())["documents"]}
    n_files = sum(1 for p in root.glob("Collection 1/PDFs/*") if p.name in listed)
    assert len(log.read_text().splitlines()) == n_files


def test_counts_with_min_similarity(spark):
    from collections import Counter
    from dataclasses import replace
    from quire.plans import catalog as C
    from quire.sources import testdata as TD
    sf = "/root/testdata/sf0.001"
    docs, jobs = TD.docs(spark, sf), TD.jobs(spark, sf)
    for least in (0.2, 2.0):
        cfg = replace(C.TEST_CONFIG, min_similarity=least)
        out = PL.run(docs, jobs, cfg)
        got = PL.counts(docs, jobs, cfg, out).collect()
        sec, sub = (Counter(r.collection for r in out[k].select("collection").collect()) for k in ("sections", "subsections"))
        assert got and all((r.n_sections, r.n_subsections) == (sec[r.collection], sub[r.collection]) for r in got)
    assert not sec and not sub


def test_empty_document_folder_is_a_collection(spark, tmp_path):
    """A folder without files is a collection whose documents are all missing; a
    spec without a folder is none."""
    root = make_root(tmp_path)
    (root / "Hollow +1" / "PDFs").mkdir(parents=True)
    job = {"documents": [{"filename": "a.txt"}, {"filename": "b.txt"}], "persona": {"role": PERSONA}, "job_to_be_done": {"task": TASK}}
    (root / "Hollow +1" / "challenge1b_input.json").write_text(json.dumps(job))
    out = tmp_path / "out-hollow"
    res = batch.run_root(spark, str(root), str(out))
    hollow = {r.collection: r for r in res["results"].collect()}["Hollow +1"]
    assert hollow.metadata.input_document_count == 2 and not hollow.extracted_sections and not hollow.subsection_analysis
    assert sorted((r.collection, r.filename) for r in res["missing"].collect()) == [("Collection 1", "missing.txt"), ("Hollow +1", "a.txt"), ("Hollow +1", "b.txt")]
    assert [r.collection for r in res["no_output"].collect()] == ["NoDocs"]
    only = tmp_path / "only"
    (only / "X" / "PDFs").mkdir(parents=True)
    (only / "X" / "challenge1b_input.json").write_text(json.dumps(job))
    assert batch.run_root(spark, str(only), str(tmp_path / "out-only"))["missing"].count() == 2


def test_empty_folders_in_pieces(spark, tmp_path, monkeypatch):
    from quire.sources import collections as C

    for i in range(7):
        (tmp_path / f"c{i}" / ("PDFs" if i % 3 else "other")).mkdir(parents=True)
    specs = spark.createDataFrame([(f"c{i}",) for i in range(8)], "collection string")
    files = spark.createDataFrame([("c1", "x.txt")], "collection string, filename string")
    monkeypatch.setattr(C, "FOLDERS_AT_ONCE", 2)
    got = C.empty_folders(specs, files, str(tmp_path))
    assert sorted(r.collection for r in got.collect()) == ["c2", "c4", "c5"]


def test_pages_are_passed_on_while_they_are_parsed(spark, tmp_path, monkeypatch):
    """A document of 100,000 pages: the parser is never far ahead of what has left
    it, and an error at its end voids all of them."""
    from quire.sources import collections as C

    ahead, taken = [], 0

    def parser(content: bytes):
        for i in range(100_000):
            ahead.append(i - taken)
            yield "page " * 20
        if content == b"bad":
            raise ValueError("last page")

    monkeypatch.setattr(C, "PAGES_BYTES", 1 << 20)
    for row in C._parsed(parser, "p", b"good"):
        taken += 1
    assert taken == 100_000 and max(ahead) <= 1
    folder = tmp_path / "c" / "PDFs"
    folder.mkdir(parents=True)
    (folder / "good.bin").write_bytes(b"good")
    (folder / "bad.bin").write_bytes(b"bad")

    def plain(content: bytes):
        for i in range(100_000):
            yield f"page {i}"
        if content == b"bad":
            raise ValueError("last page")

    pages = C.parse_binary_documents(spark, str(tmp_path), plain)
    ok, failed = C.split_page_errors(pages)
    assert [tuple(r) for r in failed.collect()] == [("c", "bad.bin", "ValueError: last page")]
    assert [tuple(r) for r in ok.groupBy("filename").agg(F.count("*"), F.max("page_number")).collect()] == [("good.bin", 100_000, 100_000)]


def test_files_listed_twice_equal_documents_with_text(spark):
    """Texts by file give what the same texts give as a column of each document:
    term statistics count a file as often as it is listed."""
    from dataclasses import replace

    from quire.plans import catalog as C
    from quire.sources import testdata as TD
    sf = "/root/testdata/sf0.001"
    once = TD.docs(spark, sf)
    docs = once.unionByName(once.where("doc_id % 3 = 0").withColumns({"doc_id": F.col("doc_id") + 5000, "doc_ord": F.col("doc_ord") + 5000}))
    files = once.select("collection", "filename", "text").unionByName(once.select(F.lit("nowhere").alias("collection"), "filename", "text")).unionByName(
        once.select("collection", F.concat(F.lit("unlisted"), "filename").alias("filename"), "text"))
    for options in ({}, {"rerank": "bm25"}, {"rank_text": "template", "min_overlap": 0.1}):
        cfg = replace(C.TEST_CONFIG, **options)
        a = PL.run(docs, TD.jobs(spark, sf), cfg)
        b = PL.run(docs.drop("text"), TD.jobs(spark, sf), cfg, files=files)
        for key in ("ranks", "sections", "subsections", "documents"):
            cols = sorted(a[key].columns)
            assert sorted(map(str, a[key].select(cols).collect())) == sorted(map(str, b[key].select(cols).collect())), (key, options)


def test_long_documents_as_pages_are_split(spark, monkeypatch):
    from quire.operators import pages as P
    from quire.plans import catalog as C

    text = "\n".join(f"Chapter {'ABCDEFGHIJ'[i % 10]}{i}: of words when queue number {i} is read and told " * 3 for i in range(400))
    schema = "collection string, doc_id bigint, doc_ord bigint, filename string, text string"
    docs = spark.createDataFrame([("c", 1, 1, "long.txt", text), ("c", 2, 2, "short.txt", "\n" * 100 + "Title Given Here: x\n" + "when the queue is long " * 20), ("c", 3, 3, None, "when the queue " * 20)], schema)
    jobs = spark.createDataFrame([("c", "Analyst", "read number words")], "collection string, persona string, task string")
    monkeypatch.setattr(PL, "PAGE_BLOCK", 7)
    pages = P.page_table(docs, lines_per_page=4)
    a = PL.run(docs, jobs, C.TEST_CONFIG)
    b = PL.run(docs.drop("text"), jobs, C.TEST_CONFIG, pages=pages)
    for key in ("documents", "ranks", "sections", "subsections"):
        cols = sorted(a[key].columns)
        assert sorted(map(str, a[key].select(cols).collect())) == sorted(map(str, b[key].select(cols).collect())), key
    import quire.session as session
    held = spark.table(session._TABLES[-1])
    assert held.where("doc_id = 1").select(F.spark_partition_id()).distinct().count() > 1
    assert held.count() == pages.count() == 102


def test_vectors_and_given_scores(spark):
    """Supplied vectors and scores: null, zero and missing ones score 0."""
    schema = "collection string, doc_id bigint, doc_ord bigint, filename string, text string, vector array<float>, rerank_score double"
    docs = spark.createDataFrame([
        ("c", 1, 1, "a.txt", "x", [1.0, 0.0], 0.0), ("c", 2, 2, "b.txt", "x", [3.0, 4.0], None), ("c", 3, 3, "c.txt", "x", None, 5.0),
        ("c", 4, 4, "d.txt", "x", [0.0, 0.0], -1.0), ("n", 5, 5, "e.txt", "x", [1.0, 0.0], 2.0)], schema)
    jobs = spark.createDataFrame([("c", "p", "t", [2.0, 0.0]), ("n", "p", "t", None)], "collection string, persona string, task string, vector array<double>")
    r = {x.doc_id: x for x in PL.run(docs, jobs, PL.JobConfig(rank_text="vector", rerank="given"))["ranks"].collect()}
    assert {k: x.score for k, x in r.items()} == {1: 1.0, 2: 0.6, 3: 0.0, 4: 0.0, 5: 0.0}
    assert [k for k in sorted(r, key=lambda k: (r[k].collection, r[k].importance_rank))] == [3, 1, 2, 4, 5]
    r = PL.run(docs, jobs, PL.JobConfig(rank_text="vector", rerank=False, min_similarity=0.5))["ranks"].collect()
    assert sorted((x.doc_id, x.importance_rank) for x in r) == [(1, 1), (2, 2)]
    files = docs.select("collection", "filename", "text")
    b = {x.doc_id: x.importance_rank for x in PL.run(docs.drop("text"), jobs, PL.JobConfig(rank_text="vector", rerank="given"), files=files)["ranks"].collect()}
    assert b == {1: 2, 2: 3, 3: 1, 4: 4, 5: 1}
    with pytest.raises(ValueError):
        PL.JobConfig(rerank="magic")


def test_bm25(spark):
    from math import log

    from quire.operators import similarity as S

    rows = [("c", 1, "alpha", 3), ("c", 1, "beta", 1), ("c", 2, "alpha", 1), ("c", 3, "gamma", 4), ("d", 1, "alpha", 2)]
    dt = spark.createDataFrame(rows, "collection string, doc_id bigint, term string, tf bigint")
    keys = spark.createDataFrame([("c", i) for i in (1, 2, 3, 4)] + [("d", 1)], "collection string, doc_id bigint")
    jobs = spark.createDataFrame([("c", "alpha beta beta nowhere"), ("d", "none here")], "collection string, query string")
    got = {(r.collection, r.doc_id): r.bm25 for r in S.bm25_scores(dt, keys, jobs, keys.where("doc_id <> 2"), 1.5, 0.5).collect()}
    mean = 9 / 4
    part = lambda n, df, tf, length: log(1 + (n - df + 0.5) / (df + 0.5)) * tf * 2.5 / (tf + 1.5 * (0.5 + 0.5 * length / mean))
    assert got == {("c", 1): round(part(4, 2, 3, 4) + part(4, 1, 1, 4), 9), ("c", 3): 0.0, ("c", 4): 0.0, ("d", 1): 0.0}
    assert S.bm25_scores(dt.limit(0), keys, jobs, keys, 1.2, 0.75).where("bm25 <> 0").count() == 0
