"""One client with a third of all rows: same results, shared work."""

from contextlib import contextmanager

import pytest
from conftest import AS_OF, SF
from pyspark.sql import functions as F

from checks.fixture import CONFIG, record_tables
from clinsift import CENTRAL, DETECTION, run_rule
from clinsift.config import Config
from clinsift.operators import skew_join, within_days
from clinsift.operators.joins import hot_key_join, hot_keys
from clinsift.sources import stage


@contextmanager
def settings(spark, **values):
    names = {k.replace("__", "."): v for k, v in values.items()}
    before = {k: spark.conf.get(k, None) for k in names}
    for k, v in names.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def shuffled(spark, **more):
    return settings(
        spark,
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__shuffle__partitions="8",
        **more,
    )


@pytest.fixture(scope="module")
def skewed(spark):
    """The fixture with a third of observations and visits moved to two clients."""
    t = record_tables(spark, SF)
    hot = F.when(F.col("encounter_id") % 3 == 0, F.col("encounter_id") % 2 + 60)

    def move(df, column):
        return df.withColumn(column, F.coalesce(hot, F.col(column)).cast("bigint")).withColumn(
            "site_id", F.when(hot.isNotNull(), 2).otherwise(F.col("site_id")).cast("int")
        )

    # several files, so several map tasks: adaptive execution cuts between their outputs
    t = t.with_table("obs", stage(move(t.obs, "person_id").repartition(8), "obs"))
    encounter = move(t.encounter, "patient_id").repartition(8)
    return t.with_table("encounter", stage(encounter, "encounter"))


def rows(df):
    return sorted(map(str, df.collect()))


@pytest.mark.parametrize("variant", [DETECTION, CENTRAL])
@pytest.mark.parametrize(
    "name",
    ["r02_visit_after_death", "r04_male_pregnancy", "r05_female_age_range",
     "r07_peds_missing_vitals", "r09_pregnant_at_art_start", "r10_breastfeeding"],
)
def test_salting_changes_nothing(spark, skewed, name, variant):
    plain = rows(run_rule(name, skewed, Config(salts=1), as_of=AS_OF, variant=variant))
    with shuffled(spark):
        salted = rows(run_rule(name, skewed, Config(salts=5), as_of=AS_OF, variant=variant))
    assert plain == salted and plain


def test_hot_client_is_dealt_over_the_salts(spark, skewed):
    facts = skewed.obs.select("obs_id", F.col("person_id").alias("patient_id"), "site_id")
    clients = facts.select("patient_id", "site_id").distinct()
    joined = skew_join(facts, clients, ["patient_id", "site_id"], ["obs_id"], 8)
    with shuffled(spark, spark__sql__adaptive__coalescePartitions__enabled="false"):
        sizes = [
            r["count"]
            for r in joined.where("patient_id = 60 and site_id = 2")
            .groupBy(F.spark_partition_id())
            .count()
            .collect()
        ]
    assert len(sizes) > 1 and max(sizes) < 0.7 * sum(sizes)
    assert joined.count() == facts.count()


def test_adaptive_execution_can_cut_the_hot_partition(spark, skewed):
    with shuffled(
        spark,
        spark__sql__files__maxPartitionBytes="200KB",
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="10KB",
        spark__sql__adaptive__skewJoin__skewedPartitionFactor="1.2",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="10KB",
        spark__sql__adaptive__coalescePartitions__parallelismFirst="false",
    ):
        found = run_rule("r04_male_pregnancy", skewed, Config(salts=2), as_of=AS_OF)
        found.collect()
        final = found._jdf.queryExecution().executedPlan().toString()
    assert "isFinalPlan=true" in final
    assert "skew=true" in final


def test_large_table_left_join_keeps_rows_without_a_key(spark):
    facts = spark.createDataFrame([(1, 1), (2, None), (3, 9)], "obs_id int, k int")
    names = spark.createDataFrame([(1, "a"), (1, "b")], "k int, name string")
    out = skew_join(facts, names, ["k"], ["obs_id"], 4, how="left")
    assert rows(out.select("obs_id", "name")) == [
        "Row(obs_id=1, name='a')", "Row(obs_id=1, name='b')",
        "Row(obs_id=2, name=None)", "Row(obs_id=3, name=None)",
    ]
    with pytest.raises(ValueError, match="full"):
        skew_join(facts, names, ["k"], ["obs_id"], 4, how="full")
    assert CONFIG.salts > 1


@pytest.mark.parametrize("undated", [True, False])
def test_window_join_against_all_pairs(spark, undated):
    """Dates on both sides of the epoch, many per key, some missing."""
    facts = spark.range(700).select(
        F.col("id").alias("obs_id"),
        (F.col("id") % 3).alias("k"),
        F.when(F.col("id") % 50 != 0, F.expr("date '1969-10-01' + cast(id * 37 % 211 as int)"))
        .cast("timestamp_ntz")
        .alias("at"),
    )
    keyed = spark.range(60).select(
        F.col("id").alias("n"),
        (F.col("id") % 3).alias("k"),
        F.when(F.col("id") % 20 != 0, F.expr("date '1969-10-01' + cast(id * 13 % 211 as int)"))
        .alias("day"),
    )
    joined = within_days(
        facts, keyed, ["k"], "at", "day", 30, ["obs_id"], 4, undated=undated
    )
    assert joined.columns == ["k", "obs_id", "at", "n", "day"]
    expected = [
        (f.obs_id, n.n)
        for f in facts.collect()
        for n in keyed.collect()
        if f.k == n.k
        and (
            (n.day is None and undated)
            or (n.day and f.at and abs((f.at.date() - n.day).days) <= 30)
        )
    ]
    assert sorted((r.obs_id, r.n) for r in joined.collect()) == sorted(expected)


@pytest.mark.parametrize("variant", [DETECTION, CENTRAL])
@pytest.mark.parametrize("name", ["r02_visit_after_death", "r04_male_pregnancy", "r07_peds_missing_vitals", "r10_breastfeeding"])
def test_found_hot_keys_change_nothing(spark, skewed, name, variant):
    plain = rows(run_rule(name, skewed, Config(salts=1), as_of=AS_OF, variant=variant))
    with shuffled(spark):
        found = rows(run_rule(name, skewed, Config(salts=5, hot_share=0.05), as_of=AS_OF, variant=variant))
    assert plain == found and plain


def test_only_listed_keys_are_copied(spark, skewed):
    facts = skewed.obs.select("obs_id", F.col("person_id").alias("patient_id"), "site_id")
    clients = facts.select("patient_id", "site_id").distinct()
    listed = sorted(tuple(r) for r in hot_keys(facts, ["patient_id", "site_id"], 0.05).collect())
    assert listed == [(60, 2), (61, 2)]  # the two clients that hold a third of the rows
    joined = hot_key_join(facts, clients, ["patient_id", "site_id"], ["obs_id"], 8, 0.05)
    assert joined.count() == facts.count()
    with shuffled(spark, spark__sql__adaptive__coalescePartitions__enabled="false"):
        sizes = [r["count"] for r in joined.where("patient_id = 60 and site_id = 2").groupBy(F.spark_partition_id()).count().collect()]
    assert len(sizes) > 1 and max(sizes) < 0.7 * sum(sizes)
