"""Shared storage for intermediate results."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def scratch_root(spark: SparkSession) -> str:
    """The folder that the cluster names in ``spark.checkpoint.dir``.

    Only a local session without one gets a folder beside its warehouse.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    root = root or spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        root = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "-scratch"
        spark.sparkContext.setCheckpointDir(root)
    return root


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path under the scratch folder."""
    return f"{scratch_root(spark).rstrip('/')}/{name}-{uuid.uuid4()}"


def materialize(df: DataFrame, name: str = "kept") -> DataFrame:
    """Compute ``df`` once and keep it in shared storage, lineage cut.

    Parquet and not a checkpoint of the rows, so that later reads prune columns
    and know the size. Whoever ends the session's work clears the folder.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def kept(df: DataFrame, name: str = "kept") -> Iterator[DataFrame]:
    """``materialize`` for the length of a block, after which the files go."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    try:
        yield spark.read.schema(df.schema).parquet(path)
    finally:
        place, store = in_store(spark, path)
        store.delete(place, True)


def holds_files(spark: SparkSession, path: str) -> bool:
    """Whether a folder is there and not empty, in whatever store."""
    place, store = in_store(spark, path)
    return bool(store.exists(place)) and len(store.listStatus(place)) > 0


def in_store(spark: SparkSession, path: str) -> tuple:
    """A path and its file system, as Hadoop objects."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark._jsc.hadoopConfiguration())
