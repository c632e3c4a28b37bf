"""Session helpers for tests and benchmarks, and the shared work folder."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession


def local_session(app: str, cores: str = "*", shuffle_partitions: int = 8,
                  driver_memory: str = "8g") -> SparkSession:
    """A local session for tests and benchmarks.  Jobs on a cluster bring their own."""
    return (
        SparkSession.builder.master(f"local[{cores}]").appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", driver_memory)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.sources.partitionOverwriteMode", "dynamic")
        .getOrCreate()
    )


def _is_local(spark: SparkSession) -> bool:
    master = spark.sparkContext.master
    return master == "local" or master.startswith("local[")


_local_roots: dict[str, str] = {}


def _local_root(spark: SparkSession) -> str:
    """One temporary folder per local session, removed when the process ends."""
    app = spark.sparkContext.applicationId
    if app not in _local_roots:
        _local_roots[app] = tempfile.mkdtemp(prefix="spark-work-")
        atexit.register(shutil.rmtree, _local_roots[app], ignore_errors=True)
    return _local_roots[app]


def work_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh folder that every executor can reach.

    The cluster names its shared folder in ``spark.checkpoint.dir``.  Only a local
    master, as in tests, may do without and gets a temporary folder of the machine.
    """
    conf = spark.sparkContext.getConf()
    shared = conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.checkpoint.dir", None)
    if not shared and not _is_local(spark):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    return f"{(shared or _local_root(spark)).rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


def checkpointed(df, purpose: str):
    """Write ``df`` once to the shared folder and read it back.

    Used where a frame feeds an iterative fit or many branches: the written table
    cuts the lineage and survives the loss of executors.
    """
    path = work_dir(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
