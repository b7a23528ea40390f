"""What the physical plans must and must not contain, over stored tables."""

import re

import pytest
from conftest import AS_OF, SF

from checks.fixture import CONFIG, record_tables
from checks.registry import table_queries
from clinsift import CENTRAL, DETECTION, RULES, corrections, read_parquet, run_rule
from clinsift.operators import skew_join, with_new_ids
from clinsift.sources import TABLES


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("records"))
    t = record_tables(spark, SF)
    for table in TABLES:
        getattr(t, table).write.parquet(f"{folder}/{table}.parquet")
    return read_parquet(spark, folder)


def plan(df) -> str:
    text = df.sparkSession._jvm.PythonSQLUtils.explainString(
        df._jdf.queryExecution(), "formatted"
    )
    return re.sub(r"\s+", " ", text)


@pytest.mark.parametrize("name", table_queries())
def test_no_pairing_and_no_python(stored, name):
    text = plan(table_queries()[name](stored))
    for node in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "Pandas"):
        assert node not in text


@pytest.mark.parametrize("variant", [DETECTION, CENTRAL])
@pytest.mark.parametrize("name", ["r04_male_pregnancy", "r05_female_age_range",
                                  "r09_pregnant_at_art_start", "r10_breastfeeding",
                                  "r07_peds_missing_vitals", "r08_adult_no_height"])
def test_observation_filters_reach_the_scan(stored, name, variant):
    text = plan(run_rule(name, stored, CONFIG, as_of=AS_OF, variant=variant))
    scans = re.findall(r"PushedFilters: \[(.*?)\],? ReadSchema: struct<(.*?)>", text)
    obs = [(pushed, read) for pushed, read in scans if "value_numeric" in read or "value_coded" in read]
    assert len(obs) == 1  # one pass over the observations
    pushed, read = obs[0]
    assert "In(concept_id, [" in pushed or "EqualTo(concept_id," in pushed
    assert "EqualTo(voided,0)" in pushed
    assert "void_reason" not in read and "creator" not in read


def test_height_is_an_anti_join(stored):
    assert "LeftAnti" in plan(run_rule("r08_adult_no_height", stored, CONFIG, as_of=AS_OF))


def test_ranking_is_limited_before_the_shuffle(stored):
    text = plan(run_rule("r10_breastfeeding", stored, CONFIG, as_of=AS_OF))
    order = [text.index("WindowGroupLimit"), text.rindex("WindowGroupLimit")]
    assert order[0] < order[1]


def test_large_sides_are_not_forced_into_a_broadcast(spark, stored):
    """With automatic broadcasts off, only the bounded table of id offsets is broadcast."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for name in RULES:
            for variant in (DETECTION, CENTRAL):
                text = plan(run_rule(name, stored, CONFIG, as_of=AS_OF, variant=variant))
                assert "Broadcast" not in text, name
        for name, query in table_queries().items():
            if name[0] == "c" and "insert" not in name:
                assert "Broadcast" not in plan(query(stored)), name
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_reviewed_decisions_leave_the_large_table_in_place(spark, stored, tmp_path):
    """Decisions from a file: a broadcast by Spark's own choice, no shuffle of obs."""
    keys = stored.obs.select("obs_id", "site_id").distinct().limit(50)
    path = f"{tmp_path}/decisions"
    keys.selectExpr("*", "50D correct_value", "7L user_id").write.parquet(path)
    decisions = spark.read.parquet(path)
    fixed = corrections.set_obs_value(stored.obs, decisions, CONFIG, as_of=AS_OF, site_safe=True)
    tree = plan(fixed).split("(1) Scan")[0]  # the tree comes before the details of its nodes
    assert "BroadcastHashJoin LeftOuter BuildRight" in tree
    assert tree.count("Exchange") == 2  # of the decisions: one per key, one broadcast


def test_own_ids_leave_the_large_table_in_place(spark, stored, tmp_path):
    """Decisions with ids from a file: their keys go to the scan of obs, which is not shuffled."""
    path = f"{tmp_path}/heights"
    spark.range(50).selectExpr(
        "id obs_id", "id patient_id", "1 site_id", "date '2001-01-01' visit_date",
        "150D height_value", "7L user_id",
    ).write.parquet(path)
    new = corrections.insert_height(
        stored.obs, spark.read.parquet(path), CONFIG, as_of=AS_OF, only_new=True
    )
    tree = plan(new).split("(1) Scan")[0]
    of_obs = tree[tree.index("LeftSemi") :]
    assert "BroadcastHashJoin LeftSemi BuildRight" in tree
    table = of_obs[: of_obs.index("BroadcastExchange")]
    assert "Scan" in table and "Exchange" not in table


def test_equal_visits_go_without_an_exchange_of_their_own(spark, stored):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(run_rule("r07_peds_missing_vitals", stored, CONFIG, as_of=AS_OF))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert len(re.findall(r"[+:]- (?:Exchange|ReusedExchange)", text.split("(1) Scan")[0])) == 9


def test_a_named_part_reads_its_own_folders(spark, stored, tmp_path):
    stored.person.write.partitionBy("site_id").parquet(f"{tmp_path}/person")
    person = spark.read.parquet(f"{tmp_path}/person")
    named = plan(corrections.at_sites(person, [2]).rows)
    assert re.search(r"PartitionFilters: \[.*site_id", named)
    decisions = spark.createDataFrame([(1, 2)], "person_id bigint, site_id int")
    assert "LeftSemi" in plan(corrections.at_decided_sites(person, decisions).rows)


def test_copies_count_in_the_size_that_a_broadcast_is_chosen_by(spark, tmp_path):
    """A side just under the limit is over it eight times."""
    spark.range(20_000).selectExpr("id k", "uuid() s").write.parquet(f"{tmp_path}/keyed")
    keyed = spark.read.parquet(f"{tmp_path}/keyed")
    size = keyed._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    facts = spark.range(1_000_000).selectExpr("id obs_id", "id % 20000 k")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", str(int(str(size)) * 2))
    try:
        joined = skew_join(facts, keyed, ["k"], ["obs_id"], 8)
        assert joined.count() == 1_000_000
        rows = skew_join(facts, keyed, ["k"], ["obs_id"], 8)
        rows.write.format("noop").mode("overwrite").save()
        rows.tail(1)
        final = rows._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "isFinalPlan=true" in final and "BroadcastHashJoin" not in final


def test_new_numbers_come_from_one_exchange_of_the_rows(stored):
    """Ranks and bucket starts read the same shuffle."""
    text = plan(with_new_ids(stored.person.select("person_id"), stored.obs, "obs_id"))
    assert len(re.findall(r"Arguments: hashpartitioning\(_bucket", text)) in (1, 2)
