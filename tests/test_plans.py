"""Plan properties of the registered queries (the scale claims, checked)."""
import pytest

import __spark_entry__ as E
from quire.operators import pages as P
from quire.plans import analysis as PL
from quire.plans import catalog
from tests.conftest import SF_SMALL

FORBIDDEN = ["CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython"]


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_no_cross_join_no_python_udf(spark, name):
    plan = plan_of(E.queries()[name](spark, SF_SMALL))
    for op in FORBIDDEN:
        assert op not in plan, f"{name}: {op}"


@pytest.mark.parametrize("name", ["q_sections", "q_subsections"])
def test_top_k_is_limited_before_the_shuffle(spark, name, monkeypatch):
    """The cut of the query's own plan, or of the stored table of winners it reads."""
    from quire.plans import analysis

    plans, store = [], analysis.materialize

    def recording(df, table="stage"):
        if table == "winners":
            plans.append(df._jdf.queryExecution().sparkPlan().toString())
        return store(df, table)

    monkeypatch.setattr(analysis, "materialize", recording)
    df = E.queries()[name](spark, SF_SMALL)
    plan = plans[0] if name == "q_subsections" else df._jdf.queryExecution().sparkPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan and "Final" in plan


def test_feature_pass_is_one_narrow_stage(spark):
    from quire.plans import analysis as PL
    from quire.plans import catalog as C
    from quire.sources import testdata as TD
    prepared = PL.prepare(TD.docs(spark, SF_SMALL), TD.jobs(spark, SF_SMALL), C.TEST_CONFIG)
    plan = plan_of(PL.feature_plan(prepared, C.TEST_CONFIG))
    assert "SortMergeJoin" not in plan and "BroadcastHashJoin" in plan
    assert "Exchange hashpartitioning" not in plan and "HashAggregate" not in plan and "Window" not in plan


@pytest.mark.parametrize("name", ["q_pages", "q_first_pages", "q_key_lines", "q_summary_sentences", "q_relevant_pages", "q_section_page", "q_section_page_job", "q_prompts"])
def test_pages_are_computed_once(spark, name):
    plan = E.queries()[name](spark, SF_SMALL)._jdf.queryExecution().optimizedPlan().toString()
    # each copy of the paging expression has its own sequence of page numbers
    assert plan.count("sequence(0, (cast(ceil(") + plan.count("sequence(0, (cast(CEIL(") == 1, plan[:3000]


def test_hot_term_is_split(spark):
    """A term in every document of one collection: AQE splits its partition."""
    from pyspark.sql import functions as F

    from quire.operators import similarity as S

    dt = spark.range(40000).select(F.lit("c").alias("collection"), F.col("id").alias("doc_id"), F.explode(F.array(F.lit("common"), F.concat(F.lit("word"), F.col("id") % 997))).alias("term"), F.lit(1).cast("long").alias("tf"))
    from quire.session import materialize

    dt = materialize(dt, "test-terms")
    keys = dt.select("collection", "doc_id").distinct()
    queries = spark.createDataFrame([("c", "common words here word55")], "collection string, query string")
    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "10k", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.2", "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.shuffle.partitions": "16",
    }
    old = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        out = S.tfidf_from_terms(dt, keys, queries)
        out.collect()
        assert "skew=true" in out._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def exchanged(df) -> set[str]:
    """Names of the columns that any exchange of the query carries."""
    found = set()

    def seq(s):
        return [s.apply(i) for i in range(s.length())]

    def walk(p):
        name = p.getClass().getSimpleName()
        if name == "AdaptiveSparkPlanExec":
            return walk(p.initialPlan())
        if name == "ShuffleExchangeExec":
            found.update(a.name() for a in seq(p.output()))
        for child in seq(p.children()):
            walk(child)

    walk(df._jdf.queryExecution().executedPlan())
    return found


@pytest.fixture
def no_broadcasts(spark, monkeypatch):
    """No side is small: Spark broadcasts nothing by itself, nothing fits the
    library's bound.  Yields the columns exchanged on the way to stored tables."""
    import quire.session as session
    from quire.operators import ranking, similarity
    from quire.plans import analysis, batch

    carried = set()

    def recording(stored):
        def store(df, *args, **kw):
            carried.update(exchanged(df))
            return stored(df, *args, **kw)

        return store

    for module in (ranking, similarity, analysis, batch):
        monkeypatch.setattr(module, "materialize", recording(session.materialize))
    monkeypatch.setattr(ranking, "BROADCAST_MAX_BYTES", 4000)
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}
    for k, v in conf.items():
        spark.conf.set(k, v)
    yield carried
    for k in conf:
        spark.conf.unset(k)


@pytest.mark.parametrize("name", ["q_subsections", "q_subsections_restricted", "q_subsections_overlap", "q_result_document"])
def test_no_text_is_exchanged(spark, no_broadcasts, name):
    df = E.queries()[name](spark, SF_SMALL)
    carried = no_broadcasts | exchanged(df)
    assert "importance_rank" in carried
    # results are one row a collection: there the job itself is a column
    assert not carried & ({"text", "query", "first_pages"} | ({"task"} if name != "q_result_document" else set()))


def test_blocks_give_the_same_rows(spark, no_broadcasts):
    from quire.operators import ranking

    small = catalog._jobs(spark, SF_SMALL)
    assert ranking.bytes_of(small) > 4000
    cols = ["collection", "document", "refined_text", "page_number", "importance_rank"]
    got = sorted(map(tuple, E.queries()["q_subsections_overlap"](spark, SF_SMALL).select(*cols).collect()))
    ranking.BROADCAST_MAX_BYTES = 32 << 20
    want = sorted(map(tuple, E.queries()["q_subsections_overlap"](spark, SF_SMALL).select(*cols).collect()))
    assert got == want and got


def small_root(tmp_path, n=6):
    """Collections of text files; some listed twice, some missing, some unlisted,
    one collection whose job is broken."""
    import json

    root = tmp_path / "in"
    for c in range(n):
        (root / f"c{c}" / "PDFs").mkdir(parents=True)
        names = [f"file_{i}.txt" for i in range(4)]
        for i, name in enumerate(names):
            text = "\f".join(f"Heading Number {'ABCDE'[i]}{p}: visit\n" + f"plan the trip to place{c} and stay{i * p} a while " * 5 for p in range(3))
            (root / f"c{c}" / "PDFs" / name).write_text(text if (c, i) != (1, 0) else "BAD")
        (root / f"c{c}" / "PDFs" / "unlisted.txt").write_text("BAD")
        job = {"persona": {"role": "Planner"}, "job_to_be_done": {"task": f"Plan the trip to place{c} with stay{c}"}, "documents": [{"filename": f} for f in [*names, names[1], "gone.txt"]]}
        (root / f"c{c}" / "challenge1b_input.json").write_text(json.dumps(job) if c else "{")
    return root


RESULT = ["collection", "metadata.persona", "metadata.input_document_count", "extracted_sections", "subsection_analysis"]


def as_pages(content: bytes):
    if content == b"BAD":
        raise ValueError("bad")
    return content.decode().split("\f")


@pytest.mark.parametrize("parser", [None, as_pages], ids=["texts", "parsed"])
@pytest.mark.parametrize("mode", ["body", "template"])
def test_folders_without_broadcasts(spark, no_broadcasts, tmp_path, parser, mode):
    """Texts do not move to meet the manifest, and sizes do not change what is written."""
    from quire.operators import ranking
    from quire.plans import analysis as PL
    from quire.plans import batch

    root = small_root(tmp_path)

    def written(out):
        res = batch.run_root(spark, str(root), str(out), PL.JobConfig(rank_text=mode), parser=parser)
        tables = {name: sorted(map(str, res[name].select(*cols).collect())) for name, cols in {
            "results": RESULT, "documents": res["documents"].columns, "ranks": res["ranks"].columns, "missing": ["collection", "filename"],
            "features": [c for c in res["features"].columns if c != "terms"],
        }.items()}
        if parser:
            tables["failed"] = sorted(map(str, spark.read.json(f"{out}/_quarantine/unreadable_documents").collect()))
        return tables, res

    got, res = written(tmp_path / "a")
    # the page rows of the parser move once, to the buckets they are stored in
    assert not no_broadcasts & {"text", "query", "first_pages"}
    assert len(got["documents"]) == 5 * 6 and len(got["missing"]) == 5 and "Heading" in got["results"][0]
    if parser:
        assert len(got["failed"]) == 1
    ranking.BROADCAST_MAX_BYTES = 32 << 20
    want, _ = written(tmp_path / "b")
    assert got == want


def test_unasked_documents_are_not_published(spark, no_broadcasts):
    from quire.plans import analysis as PL

    docs = spark.createDataFrame([("a", 1, 1, "x.txt", "t"), ("b", 1, 1, "x.txt", "t")], "collection string, doc_id bigint, doc_ord bigint, filename string, text string")
    jobs = spark.createDataFrame([("a", "p", "t" * 9000)], "collection string, persona string, task string")
    out = PL.run(docs, jobs)
    assert [r.collection for r in out["features"].collect()] == ["a"] == [r.collection for r in out["documents"].collect()]


def test_outputs_are_built_on_demand(spark, monkeypatch):
    from quire.plans import analysis as PL

    monkeypatch.setattr(PL, "rank", None)  # would fail if it were called
    assert catalog.q_counts(spark, SF_SMALL).count() > 0


def test_scores_and_block_terms_are_made_once(spark, monkeypatch):
    """Scores are stored before the two passes of the rank over them; the terms of
    page rows are counted in their buckets, without an exchange of a row a term."""
    stored = {}

    def noted(df, name="stage"):
        stored.setdefault(name, []).append(df._jdf.queryExecution().executedPlan().toString())
        return materialize(df, name)

    materialize = PL.materialize
    monkeypatch.setattr(PL, "materialize", noted)
    docs = catalog._docs(spark, SF_SMALL)
    pages = P.page_table(docs, keys=("collection", "doc_id"), lines_per_page=2)
    PL.run(docs.drop("text"), catalog._jobs(spark, SF_SMALL), catalog.TEST_CONFIG, pages=pages)["ranks"]
    assert len(stored["scores"]) == 1 and len(stored["block-terms"]) == 1
    assert not [x for x in stored["block-terms"][0].splitlines() if "Exchange hashpartitioning" in x and "term#" in x]
