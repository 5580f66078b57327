"""Checkpoint folder and stored tables."""
from quire.session import checkpoint_dir, materialize


def test_checkpoint_dir_is_the_configured_folder(spark):
    conf = spark.conf.get("spark.checkpoint.dir")
    assert checkpoint_dir(spark) == conf == checkpoint_dir(spark)


def test_materialize_writes_under_checkpoint_dir(spark):
    df = materialize(spark.range(7).withColumnRenamed("id", "x"), "unit")
    assert sorted(r.x for r in df.collect()) == list(range(7))
    assert all(checkpoint_dir(spark).rstrip("/") in f for f in df.inputFiles())
