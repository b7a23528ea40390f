"""Equi-joins that stay even when one key holds a large share of the rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_SALT = "_salt"


def salt_column(salts: int) -> str:
    """Name of a salt in ``[0, salts)`` that facts may carry from where they were stored."""
    return f"_salt_of_{salts}"


def dealt(facts: DataFrame, spread_by: Sequence[str | Column], salts: int) -> DataFrame:
    """The facts with a column ``salt_column(salts)``: a hash of row content, never ``rand``."""
    return facts.withColumn(salt_column(salts), F.pmod(F.xxhash64(*spread_by), F.lit(salts)).cast("int"))


def skew_join(
    facts: DataFrame,
    keyed: DataFrame,
    on: Sequence[str],
    spread_by: Sequence[str | Column],
    salts: int,
    how: str = "inner",
) -> DataFrame:
    """Join a large fact side with a much smaller side (``inner`` or ``left``).

    The facts of one key are dealt into ``salts`` groups and the small side is copied
    once per group, so a client with a third of all observations is shared by several
    tasks.  The salt is a hash of row content (never ``rand``): a recomputed task deals
    its rows the same way.

    The salted key has a second effect.  It keeps later operators from reusing the
    join's partitioning, and both join inputs get an exchange of their own - the shape
    adaptive execution needs to cut what is still a skewed partition into pieces.

    No broadcast is asked for: Spark takes one where all copies of the small side are
    known to be under ``spark.sql.autoBroadcastJoinThreshold``, at planning or at run time.

    Facts that already carry ``salt_column(salts)`` (a table stored bucketed by key and that
    salt, see ``plans.run.prepare``) keep it, and a join on the bucket columns needs no
    exchange of the facts.  Any deal of the facts gives the same result, as the small side is
    copied for every salt.
    """
    if how not in ("inner", "left"):
        raise ValueError(f"skew_join cannot do a {how} join")
    if salts < 2:
        return facts.join(keyed, on=list(on), how=how).drop(*(c for c in facts.columns if c.startswith("_salt_of_")))
    carried = salt_column(salts)
    spread = facts.drop(*(c for c in facts.columns if c.startswith("_salt_of_") and c != carried))
    if carried not in spread.columns:
        spread = dealt(spread, spread_by, salts)
    spread = spread.withColumnRenamed(carried, _SALT)
    # every copy is a column before it is a row, so Spark's size estimate counts all of them
    copies = [
        F.struct(*keyed.columns, F.lit(n).alias(_SALT)).alias(f"_copy_{n}") for n in range(salts)
    ]
    names = [f"_copy_{n}" for n in range(salts)]
    copied = keyed.select(*copies).select(F.inline(F.array(*names)))
    return spread.join(copied, on=[*on, _SALT], how=how).drop(_SALT)


def hot_keys(facts: DataFrame, on: Sequence[str], share: float, fraction: float = 0.01) -> DataFrame:
    """Keys that hold at least ``share`` of the facts, found in a sample of them.

    At most ``1 / share`` keys can pass, so the list has a proven bound and may be broadcast.
    The list only decides which keys are salted; a key missed or listed wrongly changes work,
    never a result.  The sample is seeded, so a recomputed task finds the same list.
    """
    keys = facts.select(*on).sample(fraction=fraction, seed=17)
    for c in on:
        keys = keys.where(F.col(c).isNotNull())
    seen = keys.count()  # one number to the driver
    counts = keys.groupBy(*on).agg(F.count(F.lit(1)).alias("_seen"))
    return counts.where(F.col("_seen") >= F.lit(max(share * seen, 1.0))).select(*on)


def hot_key_join(
    facts: DataFrame,
    keyed: DataFrame,
    on: Sequence[str],
    spread_by: Sequence[str | Column],
    salts: int,
    share: float,
    how: str = "inner",
) -> DataFrame:
    """``skew_join`` that salts only the keys found hot (``hot_keys``); the rest join as they are.

    The small side is copied ``salts`` times for the listed keys only, once for all others; the
    facts of a listed key are dealt over the salts by a hash of row content.  Same result as a
    plain join.
    """
    if how not in ("inner", "left"):
        raise ValueError(f"hot_key_join cannot do a {how} join")
    if salts < 2:
        return facts.join(keyed, on=list(on), how=how)
    hot = F.broadcast(hot_keys(facts, on, share).withColumn("_hot", F.lit(True)))  # <= 1/share rows
    facts = facts.drop(*(c for c in facts.columns if c.startswith("_salt_of_")))
    dealt_facts = facts.join(hot, list(on), "left").withColumn(
        _SALT, F.when(F.col("_hot"), F.pmod(F.xxhash64(*spread_by), F.lit(salts))).otherwise(F.lit(0)).cast("int")
    )
    copies = F.when(F.col("_hot"), F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))
    copied = keyed.join(hot, list(on), "left").withColumn(_SALT, F.explode(copies)).drop("_hot")
    return dealt_facts.drop("_hot").join(copied, on=[*on, _SALT], how=how).drop(_SALT)


def client_join(
    facts: DataFrame,
    keyed: DataFrame,
    on: Sequence[str],
    spread_by: Sequence[str | Column],
    salts: int,
    hot_share: float | None,
    how: str = "inner",
) -> DataFrame:
    """The join of facts to clients: hot keys found where ``hot_share`` is set, else all salted."""
    if hot_share is None:
        return skew_join(facts, keyed, on, spread_by, salts, how)
    return hot_key_join(facts, keyed, on, spread_by, salts, hot_share, how)


def within_days(
    facts: DataFrame,
    keyed: DataFrame,
    on: Sequence[str],
    fact_time: str,
    keyed_day: str,
    days: int,
    spread_by: Sequence[str | Column],
    salts: int,
    *,
    undated: bool,
) -> DataFrame:
    """``skew_join`` of pairs at most ``days`` days apart.

    Time is cut into spans as long as the window, and the span becomes a join key: a
    fact lies in one, the window of a keyed row in two at most.  A client with very many
    facts and very many dates is then compared within neighbouring spans, not date by
    fact.  ``undated`` also pairs keyed rows without a date with every fact of the key.
    """
    width = 2 * days + 1
    any_time = -(2**31)  # no real span is that low

    def span(day: Column) -> Column:
        return F.floor(F.unix_date(day) / F.lit(width)).cast("int")

    day, centre = F.to_date(fact_time), F.to_date(keyed_day)
    first, last = F.date_sub(centre, days), F.date_add(centre, days)
    spans = F.sequence(span(first), span(last))
    if undated:
        facts = facts.withColumn("_span", F.explode(F.array(span(day), F.lit(any_time))))
        spans = F.when(centre.isNull(), F.array(F.lit(any_time))).otherwise(spans)
    else:
        facts = facts.withColumn("_span", span(day))
    keyed = keyed.withColumn("_span", F.explode(spans))
    near = day.between(first, last)
    return (
        skew_join(facts, keyed, [*on, "_span"], spread_by, salts)
        .where(centre.isNull() | near if undated else near)
        .drop("_span")
    )


def keep_matching(df: DataFrame, keys: DataFrame, on: Sequence[str]) -> DataFrame:
    """Rows whose key occurs in ``keys`` (EXISTS)."""
    return df.join(_key_set(keys, on), on=list(on), how="left_semi")


def drop_matching(df: DataFrame, keys: DataFrame, on: Sequence[str]) -> DataFrame:
    """Rows whose key does not occur in ``keys`` (NOT EXISTS)."""
    return df.join(_key_set(keys, on), on=list(on), how="left_anti")


def _key_set(keys: DataFrame, on: Sequence[str]) -> DataFrame:
    """One row per key: a key with very many rows collapses before the shuffle.

    NULL keys can never match and would only crowd into one partition.
    """
    return present(keys.select(*on), on).distinct()


def present(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows in which none of the columns is NULL."""
    for c in columns:
        df = df.where(F.col(c).isNotNull())
    return df
