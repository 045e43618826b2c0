"""Session settings and the checkpoint folder."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

import mendframe

SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
}

_SHIPPED: set[str] = set()


def local_session(cpus: int = 8, name: str = "mendframe", extra: dict[str, str] | None = None) -> SparkSession:
    """Session for tests and single-machine runs; on a cluster pass your own session instead."""
    builder = SparkSession.builder.master(f"local[{cpus}]").appName(name)
    for key, value in {**SETTINGS, "spark.sql.shuffle.partitions": str(cpus), **(extra or {})}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_checkpoint_dir(spark: SparkSession) -> str:
    """Folder for checkpoints: the session's `spark.checkpoint.dir`; a temporary one only on local masters."""
    context = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get("spark.checkpoint.dir")
    current = context.getCheckpointDir()
    if current:
        return current
    if not configured:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="mendframe-checkpoint-")
    context.setCheckpointDir(configured)
    return context.getCheckpointDir() or configured


def materialized(df: DataFrame, name: str = "stage") -> DataFrame:
    """The rows written once as a table in the shared folder and read back.

    Later plans start from the files: they survive lost executors and read only the columns they
    need, and the upstream plan runs once however many scans follow.
    """
    spark = df.sparkSession
    path = f"{shared_checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def ship(spark: SparkSession) -> None:
    """Give the executors' Python this package, once per application, unless their path has it already."""
    context, root = spark.sparkContext, Path(mendframe.__file__).resolve().parent.parent
    if str(root) in os.environ.get("PYTHONPATH", "").split(os.pathsep) or context.applicationId in _SHIPPED:
        return
    archive = Path(tempfile.mkdtemp(prefix="mendframe-package-")) / "mendframe.zip"
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as file:
        for source in sorted((root / "mendframe").rglob("*.py")):
            file.write(source, source.relative_to(root))
    context.addPyFile(str(archive))
    _SHIPPED.add(context.applicationId)


@contextmanager
def temporary(df: DataFrame, name: str = "stage") -> Iterator[DataFrame]:
    """The rows stored for the scans of a block and removed after it."""
    spark = df.sparkSession
    path = f"{shared_checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"
    try:
        df.write.parquet(path)
        yield spark.read.schema(df.schema).parquet(path)
    finally:
        removed(spark, path)


def removed(spark: SparkSession, path: str) -> None:
    """Delete a folder that this session wrote."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def spread(df: DataFrame) -> DataFrame:
    """Rebalance an input that has fewer splits than there are cores; larger inputs stay as they are."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df
