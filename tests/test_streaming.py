"""Incremental runner: a second spec arriving later is processed once."""
import json

from quire.streaming.collections import stream_collections
from tests.test_analysis import make_root, PERSONA


def test_stream_processes_new_collections_once(spark, tmp_path):
    root = make_root(tmp_path)
    out, ckpt = tmp_path / "out", tmp_path / "ckpt"
    q = stream_collections(spark, str(root), str(out), str(ckpt))
    q.awaitTermination()
    first = spark.read.json(str(out / "results"))
    assert [r.collection for r in first.collect()] == ["Collection 1"]
    # a new collection lands
    extra = root / "Collection 2"
    (extra / "PDFs").mkdir(parents=True)
    (extra / "PDFs" / "guide.txt").write_text("Travel Guide Overview\nvisit " + "words " * 40)
    (extra / "challenge1b_input.json").write_text(json.dumps({
        "documents": [{"filename": "guide.txt", "title": "g"}],
        "persona": {"role": PERSONA}, "job_to_be_done": {"task": "see things"}}))
    q = stream_collections(spark, str(root), str(out), str(ckpt))
    q.awaitTermination()
    res = spark.read.json(str(out / "results"))
    assert sorted(r.collection for r in res.collect()) == ["Collection 1", "Collection 2"]


def test_a_batch_that_fails_after_its_write_leaves_one_result(spark, tmp_path, monkeypatch):
    from quire.sources import sinks

    root = make_root(tmp_path)
    lone = root / "No Folder"
    lone.mkdir()
    (lone / "challenge1b_input.json").write_text(json.dumps({"documents": [], "persona": {"role": PERSONA}, "job_to_be_done": {"task": "t"}}))
    out, ckpt = tmp_path / "out", tmp_path / "ckpt"

    def fail(*args, **kwargs):
        raise RuntimeError("after the write")

    with monkeypatch.context() as m:
        m.setattr(sinks, "write_input_documents", fail)
        q = stream_collections(spark, str(root), str(out), str(ckpt))
        try:
            q.awaitTermination()
        except Exception as e:
            assert "after the write" in str(e)
    assert spark.read.json(str(out / "results")).count() == 1
    stream_collections(spark, str(root), str(out), str(ckpt)).awaitTermination()
    assert [r.collection for r in spark.read.json(str(out / "results")).collect()] == ["Collection 1"]
    recorded = spark.read.json(str(out / "_quarantine" / "no_output"))
    assert "No Folder" in {r.collection for r in recorded.collect()}
