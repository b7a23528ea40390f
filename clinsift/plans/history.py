"""Reviewed decisions as a log with history: versions of a row's decided values over time.

A decision log holds rows ``keys..., values..., decided_on, seq``: on day ``decided_on`` a
reviewer decided ``values`` for the row named by ``keys``; ``seq`` orders the decisions of one
day (a later one wins).  ``versions`` folds the log into intervals: each decision is valid from
its day until the next decision for the same key (``valid_to`` exclusive, NULL while it holds).
``known_on`` gives, per key, the decision in force on a day - the input a correction takes - and
``corrections`` then never meets two decisions for one row.

The fold is a function of the set of log rows: batches appended in any order, or replayed,
give the same versions.  Ties are broken by the values themselves, so even two decisions with
the same day and ``seq`` give one result; exact repeats are one decision.  Rows with a NULL key,
day or ``seq`` are not decisions and are left out.

On Spark: ``known_on`` is a newest-row-per-key query, which Spark limits to one row per key on
both sides of the exchange, so a key with a third of all decisions is reduced on the map side.
``versions`` needs every decision of a key in order: a window over the key, sorted and spilled
by Spark within one task per key; its output is as large as the log.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

DAY, SEQ = "decided_on", "seq"


def _order(values: Sequence[str], newest_first: bool = False) -> list[Column]:
    """Day, then ``seq``, then the values (NULL lowest); or all of it reversed."""
    if newest_first:
        return [F.col(DAY).desc(), F.col(SEQ).desc(), *(F.col(v).desc_nulls_last() for v in values)]
    return [F.col(DAY).asc(), F.col(SEQ).asc(), *(F.col(v).asc_nulls_first() for v in values)]


def _decisions(log: DataFrame, keys: Sequence[str], values: Sequence[str]) -> DataFrame:
    rows = log.select(*keys, *values, F.col(DAY).cast("date").alias(DAY), F.col(SEQ).cast("long").alias(SEQ))
    for c in (*keys, DAY, SEQ):
        rows = rows.where(F.col(c).isNotNull())
    return rows.distinct()  # a replayed batch is the same decisions


def versions(log: DataFrame, keys: Sequence[str], values: Sequence[str]) -> DataFrame:
    """``keys, values, valid_from, valid_to``: each decision while it was the one in force."""
    rows = _decisions(log, keys, values)
    later = Window.partitionBy(*keys).orderBy(*_order(values))
    folded = rows.withColumn("valid_to", F.lead(DAY).over(later))
    held = folded.where(F.col("valid_to").isNull() | (F.col("valid_to") > F.col(DAY)))
    return held.select(*keys, *values, F.col(DAY).alias("valid_from"), "valid_to")


def known_on(log: DataFrame, keys: Sequence[str], values: Sequence[str], day: date | Column) -> DataFrame:
    """``keys, values`` of the decision in force on ``day`` (the last one made by then)."""
    on = F.lit(day) if isinstance(day, date) else day
    rows = _decisions(log, keys, values).where(F.col(DAY) <= on)
    newest = Window.partitionBy(*keys).orderBy(*_order(values, newest_first=True))
    first = rows.withColumn("_nth", F.row_number().over(newest)).where(F.col("_nth") == 1)
    return first.select(*keys, *values)
