"""Writing results: findings, new table versions and staged intermediate tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

CHECKPOINT_CONF = "spark.checkpoint.dir"


def write_version(df: DataFrame, path: str, partition_by: Sequence[str] = ("site_id",)) -> None:
    """Write a new version of a table to a folder of its own.

    The old version stays until the caller drops it, so a lost executor or a failed
    job never leaves a half-updated table.  ``rebalance`` gathers the rows of a
    partition value into files of a good size and lets adaptive execution cut a
    large site into several tasks and files.
    """
    if partition_by:
        df = df.hint("rebalance", *partition_by)
        df.write.mode("errorifexists").partitionBy(*partition_by).parquet(path)
    else:
        df.hint("rebalance").write.mode("errorifexists").parquet(path)


def replace_partitions(
    df: DataFrame, path: str, partition_by: Sequence[str] = ("site_id",)
) -> None:
    """Swap only those partitions of a stored table that occur in ``df``.

    ``df`` may be computed from the table itself: the new files are complete before
    the old ones go.  The swap of several partitions is not one atomic step, so use
    ``write_version`` where readers cannot pause.
    """
    (
        df.hint("rebalance", *partition_by)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partition_by)
        .parquet(path)
    )


def touched_files(spark: SparkSession, path: str, decisions: DataFrame, keys: Sequence[str]) -> list[str]:
    """The files of a stored table that hold a row some decision matches by ``keys``.

    Found by Spark itself (``_metadata.file_path`` of the matching rows), one row per file to
    the driver: a file list, as the driver holds for every scan anyway.  Keys with a NULL
    match nothing.
    """
    wanted = decisions.select(*keys).dropna().distinct()
    stored = spark.read.parquet(path).select(*keys, F.col("_metadata.file_path").alias("_file"))
    found = stored.join(wanted, list(keys), "left_semi").select("_file").distinct()
    return sorted(row._file for row in found.collect())


def rewrite_files(
    spark: SparkSession,
    path: str,
    files: Sequence[str],
    correct: Callable[[DataFrame], DataFrame],
    partition_by: Sequence[str] = ("site_id",),
) -> list[str]:
    """Replace the given files of a stored table by ``correct`` of their rows; others stay.

    For updates, whose every row depends on itself and its decision alone: with ``files`` from
    ``touched_files`` the table then equals the update of the whole table, and every file
    without a decided row is left as it was.  The new files are written to a hidden folder in
    the table first (readers skip names starting with ``_``), then moved beside the old ones,
    which go last: a failed job leaves the table as it was or, between the two steps, with
    both versions of the touched files, which a second run with the same files cleans.
    Readers must pause for the swap, as for ``replace_partitions``.  Returns the new files.
    """
    if not files:
        return []
    jvm = spark.sparkContext._jvm
    hadoop = spark.sparkContext._jsc.hadoopConfiguration()
    root = jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(hadoop)
    rows = spark.read.option("basePath", path).parquet(*files)
    staging = f"{path}/_rewrite-{uuid.uuid4().hex}"
    correct(rows).select(*rows.columns).write.partitionBy(*partition_by).parquet(staging)
    moved = []
    listing = fs.listFiles(jvm.org.apache.hadoop.fs.Path(staging), True)
    while listing.hasNext():
        made = listing.next().getPath()
        name = made.getName()
        if name.startswith("_") or name.startswith("."):
            continue
        inner = made.toUri().getPath()[len(jvm.org.apache.hadoop.fs.Path(staging).toUri().getPath()) + 1 :]
        target = jvm.org.apache.hadoop.fs.Path(root, inner)
        fs.mkdirs(target.getParent())
        if not fs.rename(made, target):
            raise OSError(f"could not move {made} to {target}")
        moved.append(target.toString())
    for old in files:
        fs.delete(jvm.org.apache.hadoop.fs.Path(old), False)
    fs.delete(jvm.org.apache.hadoop.fs.Path(staging), True)
    return moved


def stage_dir(spark: SparkSession) -> str:
    """The shared folder for intermediate tables, as the session names it."""
    folder = spark.conf.get(CHECKPOINT_CONF, None)
    if not folder:
        raise ValueError(f"set {CHECKPOINT_CONF} to a folder that all executors share")
    return folder


def stage_folder(spark: SparkSession) -> str:
    """A new folder for tables that are staged, and removed, together."""
    return f"{stage_dir(spark)}/staged-{uuid.uuid4().hex}"


def stage(
    df: DataFrame, name: str, partition_by: Sequence[str] = (), folder: str | None = None
) -> DataFrame:
    """Write a frame that several jobs share and read it back.

    A written table survives the loss of executors, cuts the lineage, and has a
    known size, so Spark can choose a broadcast join for it by itself.  Each task writes
    its own files of a partition: no shuffle, and no task that gets a whole partition.
    """
    spark = df.sparkSession
    path = f"{folder or stage_folder(spark)}/{name}"
    df.write.mode("errorifexists").partitionBy(*partition_by).parquet(path)
    return spark.read.schema(df.schema).parquet(path).select(*df.columns)


def stage_bucketed(
    df: DataFrame,
    name: str,
    by: Sequence[str],
    buckets: int,
    partition_by: Sequence[str] = (),
    folder: str | None = None,
) -> tuple[DataFrame, str]:
    """Write a frame as a table bucketed by ``by`` and read it back; also the table's name.

    The rows are exchanged once, by the bucket columns, and each task writes one bucket, so
    joins and groupings on exactly those columns read the table without another exchange.
    The table is external, its files in the shared folder; ``drop_staged_table`` removes it.
    """
    spark = df.sparkSession
    path = f"{folder or stage_folder(spark)}/{name}"
    table = f"staged_{name}_{uuid.uuid4().hex}"
    (
        df.repartition(buckets, *by)
        .write.mode("errorifexists")
        .option("path", path)
        .partitionBy(*partition_by)
        .bucketBy(buckets, *by)
        .saveAsTable(table)
    )
    return spark.table(table).select(*df.columns), table


def drop_staged_table(spark: SparkSession, table: str) -> None:
    spark.sql(f"DROP TABLE IF EXISTS {table}")


def remove_folder(spark: SparkSession, path: str) -> bool:
    """Delete a staged folder through Spark's own file system."""
    jvm = spark.sparkContext._jvm
    place = jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)
