"""Numbers for new rows, given out by many tasks."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

_BUCKET_DIGITS = 3  # hex digits, so 4096 buckets: the size of the offset table


def with_new_ids(rows: DataFrame, table: DataFrame, id_column: str) -> DataFrame:
    """Number distinct ``rows`` on from the highest id of ``table``, without gaps.

    The numbers follow the MD5 of the row content, so they do not depend on
    partitioning, and rows of one client or day land in different buckets.  Rows are
    numbered within their bucket; a table with one row per bucket says where each
    bucket starts.
    """
    columns = rows.columns
    content = F.concat_ws("|", *(F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns))
    digested = rows.withColumn("_digest", F.md5(content)).withColumn(
        "_bucket", F.substring("_digest", 1, _BUCKET_DIGITS)
    )
    # ranks and bucket sizes from the same window, so the rows are computed and sent once
    by_bucket = Window.partitionBy("_bucket")
    numbered = digested.select(
        "*",
        F.row_number().over(by_bucket.orderBy("_digest", *columns)).alias("_rank"),
        F.count(F.lit(1)).over(by_bucket).alias("_rows"),
    )

    bucket_order = Window.partitionBy(F.lit(0)).orderBy("_bucket")  # at most 4096 rows
    starts = (
        numbered.where("_rank = 1")
        .select("_bucket", "_rows")
        .select("_bucket", (F.sum("_rows").over(bucket_order) - F.col("_rows")).alias("_start"))
    )

    highest = table.select(F.coalesce(F.max(id_column), F.lit(0))).scalar()
    new_id = highest + F.col("_start") + F.col("_rank")
    return numbered.join(F.broadcast(starts), on="_bucket").select(
        new_id.cast("bigint").alias(id_column), *columns
    )
