"""Intermediate tables in the shared folder that the cluster names."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_CONF = "spark.checkpoint.dir"
_CLEAN = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_own: dict[str, str] = {}  # application id -> folder of a local session


def shared_dir(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``; only a local session without it gets a folder of its own."""
    folder = spark.conf.get(_CONF, None)
    if folder:
        return folder.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise ValueError(f"set {_CONF} to a folder that all executors share")
    if context.applicationId not in _own:
        _own[context.applicationId] = tempfile.mkdtemp(prefix="llm-")
    return _own[context.applicationId]


def new_folder(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/llm-{uuid.uuid4().hex}/{name}"


def staged(df: DataFrame, name: str, clean: bool = False) -> DataFrame:
    """Write a frame that several jobs read, and read it back.

    A written table outlives lost executors, cuts the lineage and has a known size.  ``clean``
    has Spark delete the shuffle files of the write as it ends, not whenever the driver's
    collector finds them unused.
    """
    spark, path = df.sparkSession, new_folder(df.sparkSession, name)
    before = spark.conf.get(_CLEAN, None)
    if clean:
        spark.conf.set(_CLEAN, "true")
    try:
        (df.select("*") if clean else df).write.parquet(path)  # a frame made under the setting
    finally:
        if clean and before is None:
            spark.conf.unset(_CLEAN)
        elif clean:
            spark.conf.set(_CLEAN, before)
    return spark.read.schema(df.schema).parquet(path)


def width(spark: SparkSession) -> int:
    """The number of tasks a shuffle of this session is meant for."""
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
