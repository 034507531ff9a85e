"""Staged tables: results written once to the shared folder and read back.

An operator that needs several passes over an expensive result stages it
instead of recomputing it. The table lives in the folder the cluster names in
``spark.checkpoint.dir``, so it outlives lost executors, cuts the lineage, and
gives the planner true sizes to choose joins by.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

_made: ContextVar[list[str] | None] = ContextVar("made", default=None)


def shared_folder(spark: SparkSession) -> str:
    """The cluster's checkpoint folder; for a session in one process without it, a folder beside its warehouse."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder is None:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise RuntimeError("Set spark.checkpoint.dir to a folder that all executors share.")
        folder = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/staged"
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


def fresh_path(spark: SparkSession, name: str) -> str:
    path = f"{shared_folder(spark)}/clearbook/{name}-{uuid.uuid4().hex}"
    made = _made.get()
    if made is not None:
        made.append(path)
    return path


@contextmanager
def staged_until_done(spark: SparkSession) -> Iterator[None]:
    """What is staged inside the block is deleted when it ends; for jobs whose output is written by then."""
    paths: list[str] = []
    token = _made.set(paths)
    try:
        yield
    finally:
        _made.reset(token)
        for path in paths:
            folder = spark._jvm.org.apache.hadoop.fs.Path(path)
            folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def stage(df: DataFrame, name: str, *partition_by: str, compression: str | None = None) -> DataFrame:
    """Write a frame to the shared folder and return it as a scan of what was written.

    With ``partition_by`` there is a folder for each value of these columns, and
    a filter on them reads no other. ``compression`` is for whole raw tables,
    which take most of the disk; all else is written as the session has it.
    """
    spark = df.sparkSession
    path = fresh_path(spark, name)
    df.write.partitionBy(*partition_by).parquet(path, compression=compression)
    return spark.read.schema(df.schema).parquet(path).select(df.columns)
