"""All rules over shared, staged inputs give what each rule gives alone."""

import os
import re
from dataclasses import replace

import pytest
from conftest import AS_OF, SF

from checks.fixture import CONFIG, record_tables
from clinsift import CENTRAL, DETECTION, RULES, prepare, run_all, run_rule


@pytest.fixture(scope="module")
def tables(spark):
    return record_tables(spark, SF)


@pytest.mark.parametrize("variant", [DETECTION, CENTRAL])
def test_staged_run_equals_single_rules(tables, variant):
    together = run_all(tables, CONFIG, variant=variant, as_of=AS_OF, site_safe=False)
    assert list(together) == list(RULES)
    for name, df in together.items():
        alone = run_rule(name, tables, CONFIG, as_of=AS_OF, variant=variant)
        assert df.columns == alone.columns
        assert sorted(map(str, df.collect())) == sorted(map(str, alone.collect())), name


def test_chosen_rules_without_staging(tables):
    some = run_all(tables, CONFIG, rules=["r01_gender"], as_of=AS_OF, staged=False)
    assert list(some) == ["r01_gender"]
    assert some["r01_gender"].count() == 251


def test_staged_observations_are_pruned_by_concept(tables):
    shared = prepare(tables, CONFIG)
    heights = run_rule("r08_adult_no_height", shared, CONFIG, as_of=AS_OF)
    text = heights._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(concept_id" in text
    newer = shared.with_table("person", tables.person)
    assert newer.clients == {}  # prepared clients belong to the old person table


def test_detection_over_many_sites_must_be_chosen(tables):
    with pytest.raises(ValueError, match="site_safe"):
        run_all(tables, CONFIG, variant=DETECTION, as_of=AS_OF)
    some = run_all(
        tables, CONFIG, variant=DETECTION, rules=["r01_gender"], as_of=AS_OF, staged=False
    )
    assert list(some) == ["r01_gender"]


@pytest.mark.parametrize(
    "other", [{"hiv_program": 3}, {"height": 1}, {"yes": 2}, {"adult_age": 16}]
)
def test_prepared_inputs_refuse_other_settings(tables, other):
    shared = prepare(tables, CONFIG, rules=["r01_gender", "r03_art_before_birth"])
    with pytest.raises(ValueError, match="other settings"):
        run_rule("r01_gender", shared, replace(CONFIG, **other), as_of=AS_OF)
    run_rule("r01_gender", shared, replace(CONFIG, salts=3), as_of=AS_OF)
    shared.drop_prepared()


def test_prepared_inputs_refuse_other_rules(tables):
    shared = prepare(tables, CONFIG, rules=["r08_adult_no_height", "r07_peds_missing_vitals"])
    with pytest.raises(ValueError, match="without the concepts"):
        run_rule("r04_male_pregnancy", shared, CONFIG, as_of=AS_OF)
    shared.drop_prepared()


def test_only_what_is_shared_is_written(spark, tables):
    one = prepare(tables, CONFIG, rules=["r01_gender"])
    assert one.obs is tables.obs and not one.clients and not os.path.exists(one.prepared.folder)
    two = prepare(tables, CONFIG, rules=["r01_gender", "r08_adult_no_height"])
    assert two.obs is tables.obs and set(two.clients) == {CONFIG.state_on_art}
    assert os.listdir(two.prepared.folder) == [f"clients_{CONFIG.state_on_art}"]
    heights = prepare(tables, CONFIG, rules=["r07_peds_missing_vitals", "r08_adult_no_height"])
    parts = [x for x in os.listdir(f"{heights.prepared.folder}/obs") if "=" in x]
    assert sorted(parts) == sorted(f"concept_id={c}" for c in CONFIG.measures)
    heights.drop_prepared()
    assert not os.path.exists(heights.prepared.folder)


def _ancestors(plan: str, marker: str) -> list[list[str]]:
    """For each line holding ``marker``: the operators above it, nearest first."""
    lines = plan.splitlines()

    def depth(line: str) -> int:
        stripped = line.lstrip(" :|+-")
        return len(line) - len(stripped)

    out = []
    for n, line in enumerate(lines):
        if marker in line:
            above, level = [], depth(line)
            for prior in reversed(lines[:n]):
                if prior.strip() and depth(prior) < level:
                    above.append(re.sub(r"^[\s:|+-]*(\*\(\d+\)\s*)?", "", prior))
                    level = depth(prior)
            out.append(above)
    return out


@pytest.mark.parametrize("name", ["r04_male_pregnancy", "r05_female_age_range", "r10_breastfeeding"])
def test_observations_are_exchanged_once_for_all_rules(spark, tables, name):
    shared = prepare(tables, CONFIG)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as if the clients were large
    try:
        found = run_rule(name, shared, CONFIG, as_of=AS_OF)
        found.collect()
        plan = found._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
        shared.drop_prepared()
    scans = _ancestors(plan, "FileScan parquet spark_catalog.default.staged_obs")
    assert scans
    for above in scans:
        upto = next(i for i, op in enumerate(above) if op.startswith("SortMergeJoin"))
        assert not any("Exchange" in op or "ShuffleQueryStage" in op for op in above[:upto]), above[:upto]
