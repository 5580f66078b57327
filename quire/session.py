"""SparkSession construction for tests, bench and local runs.

On a cluster the session comes from the platform; the library only reads its
settings (shuffle partitions, checkpoint directory).  ``get_session`` is for
local runs and sets defaults only where the caller has not.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

_LOCAL_DEFAULTS = {
    "spark.sql.shuffle.partitions": "8",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    # small local inputs: keep all cores busy (split small files, do not merge
    # small shuffle partitions into one task)
    "spark.sql.files.openCostInBytes": str(128 * 1024),
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": str(256 * 1024),
    "spark.driver.memory": "8g",
}


def get_session(master: str | None = None, app: str = "quire", conf: dict | None = None) -> SparkSession:
    """Local session with sane defaults (UI off, AQE on, UTC)."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    settings = dict(_LOCAL_DEFAULTS)
    settings.update(conf or {})
    for k, v in settings.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder the cluster names in ``spark.checkpoint.dir``.

    Only when the session has none (local tests) a private scratch folder is
    created and registered; on a cluster the configured shared folder is used.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if d:
        return d
    current = spark.sparkContext.getCheckpointDir()
    if current:  # registered earlier in this application
        return current
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    spark.sparkContext.setCheckpointDir(
        tempfile.mkdtemp(prefix="quire-ckpt-", dir=os.environ.get("QUIRE_SCRATCH", "/tmp"))
    )
    return spark.sparkContext.getCheckpointDir()


def materialize(df, name: str = "stage"):
    """Write ``df`` as a parquet table under the checkpoint folder and read it back.

    Cuts the lineage (a lost executor does not re-run the upstream plan) and
    lets several consumers read one computed result.
    """
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/quire-{name}-{uuid.uuid4().hex}"
    _STORED.append(path)
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def materialize_bucketed(df, keys: list[str], name: str = "bucketed"):
    """``df`` exchanged once by ``keys``, stored in as many buckets as there are
    shuffle partitions, and read back: joins and aggregates on exactly these keys
    exchange it no more.  (A table of the session's catalog, as only those keep
    their buckets; its files are under the checkpoint folder.)"""
    spark = df.sparkSession
    n, unique = int(spark.conf.get("spark.sql.shuffle.partitions")), uuid.uuid4().hex
    path, table = f"{checkpoint_dir(spark).rstrip('/')}/quire-{name}-{unique}", f"quire_{name}_{unique}"
    _STORED.append(path)
    _TABLES.append(table)
    df.repartition(n, *keys).write.format("parquet").bucketBy(n, *keys).option("path", path).saveAsTable(table)
    return spark.table(table)


_STORED: list[str] = []
_TABLES: list[str] = []


def drop_stored(spark) -> int:
    """Deletes the tables that ``materialize`` and ``materialize_bucketed`` have
    stored in this process and returns their number; DataFrames that read them can
    no longer be used."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    for table in [_TABLES.pop() for _ in range(len(_TABLES))]:
        spark.sql(f"DROP TABLE IF EXISTS `{table}`")
    paths = [_STORED.pop() for _ in range(len(_STORED))]
    for p in paths:
        path = jvm.org.apache.hadoop.fs.Path(p)
        path.getFileSystem(conf).delete(path, True)
    return len(paths)
