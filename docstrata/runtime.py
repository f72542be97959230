"""Session helpers shared by every operator."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"
_owned: set[str] = set()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One parquet table of a data directory."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """Folder for reliable checkpoints: the one the cluster names, else (tests on
    one machine) a temporary folder of this process."""
    found = spark.conf.get(CHECKPOINT_CONF, None)
    if found:
        return found
    master = spark.sparkContext.master
    if not master.startswith("local"):
        raise ValueError(f"set {CHECKPOINT_CONF} to a folder all executors share")
    path = os.path.join(tempfile.gettempdir(), f"docstrata-{os.getpid()}")
    os.makedirs(path, exist_ok=True)
    return f"file://{path}"


def checkpoint(df: DataFrame, partitions: int | None = None) -> DataFrame:
    """Cut the lineage with a table written to the shared folder. Unlike an RDD
    checkpoint it is compressed and columnar, and later reads prune its columns. The
    application's folder is deleted when its driver ends."""
    spark = df.sparkSession
    root = f"{shared_dir(spark).rstrip('/')}/docstrata-{spark.sparkContext.applicationId}"
    if root not in _owned:
        _owned.add(root)
        folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(root)
        folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(folder)
    path = f"{root}/{uuid.uuid4().hex}.parquet"
    (df.coalesce(partitions) if partitions else df).write.parquet(path)
    stored = spark.read.schema(df.schema).parquet(path)
    stored._stored_at = path
    return stored


def release(df: DataFrame) -> None:
    """Delete the table behind a checkpoint that no later plan reads (a finished round of an iteration). Other frames
    are left alone."""
    path = getattr(df, "_stored_at", None)
    if path:
        folder = df.sparkSession.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(df.sparkSession.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
