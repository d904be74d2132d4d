"""Session settings for local runs and the shared scratch folder."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def local_session(cpus: int | str = 8, app: str = "coursepulse") -> SparkSession:
    """Session for tests and the benchmark; a cluster brings its own."""
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.dataFrameQueryContext.enabled", "false")
        .config("spark.sql.codegen.hugeMethodLimit", "8000")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def scratch_root(spark: SparkSession) -> str:
    """Folder that every executor can reach: the session's ``spark.checkpoint.dir``.

    Only a local master may fall back to a folder of this machine, which goes with the process.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return shared.rstrip("/")
    if spark.sparkContext.master.startswith("local"):
        root = tempfile.mkdtemp(prefix="coursepulse-")
        atexit.register(shutil.rmtree, root, ignore_errors=True)
        spark.conf.set("spark.checkpoint.dir", root)
        return root
    raise RuntimeError("spark.checkpoint.dir must name a folder shared by the cluster")


_scopes: list[list[str]] = []


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the scratch folder; nothing is created."""
    path = os.path.join(scratch_root(spark), "coursepulse", f"{name}-{uuid.uuid4().hex}")
    for paths in _scopes:
        paths.append(path)
    return path


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """Remove, at the end, all scratch data made inside.

    Frames that read it must have been written or collected by then.
    """
    paths: list[str] = []
    _scopes.append(paths)
    try:
        yield
    finally:
        _scopes.remove(paths)
        hadoop = spark._jvm.org.apache.hadoop.fs
        conf = spark._jsparkSession.sessionState().newHadoopConf()
        for path in paths:
            folder = hadoop.Path(path)
            folder.getFileSystem(conf).delete(folder, True)


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Cuts lineage, survives the loss of executors and, unlike a cache, pins values that
    depend on the physical layout.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
