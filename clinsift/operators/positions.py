"""Order as a column: the global position of each row, computed without one task for all rows.

``row_number()`` over the whole table puts every row in one task.  Here the rows are range
partitioned by the sort order (Spark samples the bounds), the partition of each row is written
down with it, every partition is counted (one row per partition to a small table), and the
running sum of the counts before a partition is its offset.  A row's position is its offset
plus its number within its own partition.  The sort order is made total by adding every column
as a tie-breaker, so positions do not depend on how rows arrive; identical rows take
neighbouring positions, which of them which is immaterial.

The ranged rows are written to the shared folder (``spark.checkpoint.dir``) where the session
names one, so counting and numbering see the same partitions even after lost executors; without
it the two read one exchange that Spark reuses.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clinsift.sources.sinks import CHECKPOINT_CONF, stage


def _ascending(c: str | Column) -> Column:
    return F.col(c).asc_nulls_first() if isinstance(c, str) else c


def with_position(df: DataFrame, order: Sequence[str | Column], name: str = "position", parts: int | None = None) -> DataFrame:
    """``df`` with ``name``: 1 for the first row by ``order`` (then every column, NULL first)."""
    spark = df.sparkSession
    total = [_ascending(c) for c in order] + [F.col(c).asc_nulls_first() for c in df.columns]
    count = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = df.repartitionByRange(count, *total).withColumn("_part", F.spark_partition_id())
    if spark.conf.get(CHECKPOINT_CONF, None):
        ranged = stage(ranged, "ranged")
    sizes = ranged.groupBy("_part").agg(F.count(F.lit(1)).alias("_rows"))  # one row per partition
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_offset"))
    within = Window.partitionBy("_part").orderBy(*total)
    return (
        ranged.join(F.broadcast(offsets), "_part")  # as many rows as partitions
        .withColumn(name, (F.col("_offset") + F.row_number().over(within)).cast("long"))
        .select(*df.columns, name)
    )
