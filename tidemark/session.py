"""Session settings and the shared work folder."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

# Settings the operators assume. On a cluster, pass these with spark-submit and
# size the shuffle partitions so that one holds 100-200 MB.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a hot join partition even when the next step then has to shuffle again.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.ui.enabled": "false",
    # Rule lists generate long methods, which Java would otherwise leave interpreted.
    "spark.driver.extraJavaOptions": "-XX:-DontCompileHugeMethods",
    "spark.executor.extraJavaOptions": "-XX:-DontCompileHugeMethods",
}


def build_session(master: str = "local[*]", shuffle_partitions: int = 8, **extra: str) -> SparkSession:
    builder = SparkSession.builder.master(master).appName("tidemark")
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions)).getOrCreate()


def work_dir(spark: SparkSession) -> str:
    """Shared folder named by ``spark.checkpoint.dir``.

    Only a local session may fall back to a temporary folder: on a cluster a
    path on one machine would not be visible to the other executors.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base:
        return base
    if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    base = tempfile.mkdtemp(prefix="tidemark-")
    spark.conf.set("spark.checkpoint.dir", base)
    return base


_RUN = ContextVar("tidemark_run", default="")


@contextmanager
def run_folder(spark: SparkSession) -> Iterator[str]:
    """Intermediate results of the block go to a folder of their own, deleted when it ends.

    What the block returns must not read them any more.
    """
    folder = f"{work_dir(spark)}/run-{uuid.uuid4().hex}"
    token = _RUN.set(folder)
    try:
        yield folder
    finally:
        _RUN.reset(token)
        delete(spark, folder)


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh folder name below the shared work folder, or that of the current run."""
    return f"{_RUN.get() or work_dir(spark)}/{label}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Cuts the lineage in a way that survives lost executors, and gives the planner
    the true size, so that a later join broadcasts only what was measured small.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def bucketed(df: DataFrame, col: str, buckets: int, label: str) -> DataFrame:
    """``df`` written to the shared folder in buckets of ``col``, and read with that layout.

    Windows, groups and joins by ``col`` (and more) then need no shuffle.
    """
    spark = df.sparkSession
    name = f"tidemark_{uuid.uuid4().hex}"
    df.write.bucketBy(buckets, col).option("path", scratch_path(spark, label)).saveAsTable(name)
    out = spark.table(name)
    spark.sql(f"drop table {name}")  # the files stay; what was read keeps the layout
    return out


def _folder(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()), at


def list_names(spark: SparkSession, path: str) -> list[str]:
    """Names directly below a folder; none if it does not exist."""
    fs, at = _folder(spark, path)
    return [s.getPath().getName() for s in fs.listStatus(at)] if fs.exists(at) else []


def delete(spark: SparkSession, path: str) -> None:
    """Remove a folder that this library wrote."""
    fs, at = _folder(spark, path)
    fs.delete(at, True)
