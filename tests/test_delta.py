"""Findings after a change set equal the difference of two full runs."""

from collections import Counter

import pytest
from conftest import SF
from pyspark.sql import functions as F

from checks.fixture import AS_OF, CONFIG, record_tables
from clinsift import CENTRAL, DETECTION, RULES, run_rule
from clinsift.plans.delta import CHANGE, CLEARED, NEW, current, findings_delta, touched_clients


def rows(df):
    return Counter(map(str, df.collect()))


def change(table, when, **values):
    """The table after changing matching rows, and the change rows (old and new versions)."""
    old = table.where(when)
    new = old.withColumns({k: v for k, v in values.items()})
    return table.where(~when | when.isNull()).unionByName(new), old.unionByName(new)


@pytest.fixture(scope="module")
def versions(spark):
    old = record_tables(spark, SF)
    person, p_rows = change(old.person, F.col("person_id") % 37 == 0, gender=F.lit("X"), birthdate=F.date_add("birthdate", 400))
    obs, o_rows = change(old.obs, F.col("person_id") % 29 == 0, voided=F.lit(1).cast(old.obs.schema["voided"].dataType))
    state, s_rows = change(old.patient_state, F.col("patient_program_id") % 31 == 0, end_date=F.to_date(F.lit("2000-01-01")))
    visits, e_rows = change(old.encounter, F.col("patient_id") % 41 == 0, voided=F.lit(1).cast(old.encounter.schema["voided"].dataType))
    new = old.with_table("person", person).with_table("obs", obs).with_table("patient_state", state).with_table("encounter", visits)
    changes = {"person": p_rows, "obs": o_rows, "patient_state": s_rows, "encounter": e_rows}
    return old, new, changes


@pytest.mark.parametrize("variant", [DETECTION, CENTRAL])
def test_delta_equals_two_full_runs(versions, variant):
    old, new, changes = versions
    before = {n: run_rule(n, old, CONFIG, as_of=AS_OF, variant=variant, site_safe=False) for n in RULES}
    delta = findings_delta(new, changes, before, CONFIG, variant=variant, as_of=AS_OF, site_safe=False)
    moved = 0
    for name in RULES:
        after = run_rule(name, new, CONFIG, as_of=AS_OF, variant=variant, site_safe=False)
        got = delta[name].cache()
        assert rows(current(got)) == rows(after), name
        assert rows(got.where(F.col(CHANGE) == NEW).drop(CHANGE)) == rows(after.exceptAll(before[name])), name
        assert rows(got.where(F.col(CHANGE) == CLEARED).drop(CHANGE)) == rows(before[name].exceptAll(after)), name
        moved += got.where(F.col(CHANGE) != "unchanged").count()
    assert moved > 0


def test_observations_are_cut_before_any_shuffle(versions):
    old, new, changes = versions
    before = {"r04_male_pregnancy": run_rule("r04_male_pregnancy", old, CONFIG, as_of=AS_OF)}
    delta = findings_delta(new, changes, before, CONFIG, rules=["r04_male_pregnancy"], as_of=AS_OF)
    plan = delta["r04_male_pregnancy"]._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "LeftSemi" in plan


def test_lookup_changes_touch_everyone_and_no_changes_touch_nobody(spark, versions):
    old, new, _ = versions
    assert touched_clients(new, {"concept_name": old.concept_name}) is None
    assert touched_clients(new, {}).count() == 0
    before = {"r01_gender": run_rule("r01_gender", old, CONFIG, as_of=AS_OF)}
    same = findings_delta(old, {}, before, CONFIG, rules=["r01_gender"], as_of=AS_OF)["r01_gender"]
    assert set(r[0] for r in same.select(CHANGE).distinct().collect()) == {"unchanged"}
    with pytest.raises(ValueError, match="client key"):
        touched_clients(new, {"visits": old.encounter})


def test_each_side_is_computed_once_and_copies_are_counted(spark, versions, tmp_path, monkeypatch):
    from clinsift.plans import delta as module

    monkeypatch.setattr(module, "_BLOCK", 3)
    frame = lambda rows: spark.createDataFrame(rows, "patient_id long, site_id int, flag string")
    now = frame([(1, 1, "a")] * 8 + [(1, 1, None)] * 2 + [(2, 1, "b")]).withColumn("_judged", F.lit(True))
    earlier = frame([(1, 1, "a")] + [(1, 1, None)] * 5 + [(3, 1, "c")] * 7)
    judged = F.when(F.col("patient_id") < 3, F.lit(True))
    got = Counter(tuple(r) for r in module._compare(now, earlier.withColumn("_judged", judged)).collect())
    assert got == {
        (1, 1, "a", "unchanged"): 1, (1, 1, "a", "new"): 7, (1, 1, None, "unchanged"): 2, (1, 1, None, "cleared"): 3,
        (2, 1, "b", "new"): 1, (3, 1, "c", "unchanged"): 7,
    }
    old, new, changes = versions
    name, at = "r07_peds_missing_vitals", str(tmp_path / "before")
    run_rule(name, old, CONFIG, as_of=AS_OF).write.parquet(at)
    delta = findings_delta(new, changes, {name: spark.read.parquet(at)}, CONFIG, rules=[name], as_of=AS_OF)[name]
    plan = delta._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("DQ_flag") and sum("Relation" in line and "DQ_flag" in line for line in plan.split("\n")) == 1
    assert plan.count("max(") == 3  # one pivot of the measurements, of the new tables
