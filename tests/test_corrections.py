"""Guards, audit columns, uniqueness, repeatability, and detect - correct - detect."""

from datetime import date, datetime

import pytest
from conftest import AS_OF, frame, values
from pyspark.sql import functions as F

from clinsift import CENTRAL, DETECTION, corrections, run_rule, texts
from clinsift.operators import with_new_ids

AT = datetime(2020, 1, 2, 9)


def same_rows(a, b) -> bool:
    return sorted(map(str, a.collect())) == sorted(map(str, b.collect()))


def people(spark, *rows):
    return frame(spark, "person", [{"site_id": 1, **r} for r in rows])


def observations(spark, *rows):
    return frame(spark, "obs", [{"site_id": 1, "person_id": 1, **r} for r in rows])


# --- person -----------------------------------------------------------------------


def test_gender_spellings(spark, cfg):
    given = ["M", "F", "m", "MALE", "Female", "f", "U", "x", None]
    rows = [{"person_id": i, "gender": g} for i, g in enumerate(given)]
    rows.append({"person_id": 99, "gender": "male", "voided": 1})
    fixed = corrections.normalise_genders(people(spark, *rows), cfg)
    assert [r.gender for r in fixed.orderBy("person_id").collect()] == [
        "M", "F", "M", "M", "F", "F", "U", "x", None, "male",
    ]


def test_clear_death_of_live_rows(spark, cfg):
    person = people(
        spark,
        {"person_id": 1, "dead": 1, "death_date": AS_OF},
        {"person_id": 2, "dead": 1, "death_date": AS_OF, "voided": 1},
        {"person_id": 3, "dead": 1, "death_date": AS_OF},
        {"person_id": 1, "site_id": 2, "dead": 1, "death_date": AS_OF},
    )
    decisions = spark.createDataFrame([(1, 1), (2, 1), (77, 1)], "person_id bigint, site_id int")
    fixed = corrections.clear_death(person, decisions, cfg)
    assert fixed.columns == person.columns and fixed.dtypes == person.dtypes
    assert values(fixed, "person_id", "site_id", "dead", "death_date") == [
        (1, 1, 0, None), (1, 2, 1, AS_OF), (2, 1, 1, AS_OF), (3, 1, 1, AS_OF),
    ]


def test_birthdate_also_of_voided_rows(spark, cfg):
    old = date(1990, 1, 1)
    person = people(
        spark,
        {"person_id": 1, "birthdate": old, "voided": 1},
        {"person_id": 2, "birthdate": old},
        {"person_id": 3, "birthdate": old},
    )
    decisions = spark.createDataFrame(
        [(1, 1, "1991-02-03"), (2, 1, None)], "person_id bigint, site_id int, birthdate string"
    )
    fixed = corrections.set_birthdate(person, decisions, cfg)
    assert values(fixed, "person_id", "birthdate") == [
        (1, date(1991, 2, 3)), (2, None), (3, old),
    ]


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_an_unreadable_value_stops_the_job(spark, cfg, ansi):
    person = people(spark, {"person_id": 1, "birthdate": date(1990, 1, 1)})
    decisions = spark.createDataFrame(
        [(1, 1, "3 Feb")], "person_id bigint, site_id int, birthdate string"
    )
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        with pytest.raises(Exception, match="cannot read birthdate as date: 3 Feb"):
            corrections.set_birthdate(person, decisions, cfg).collect()
    finally:
        spark.conf.unset("spark.sql.ansi.enabled")


def test_gender_female(spark, cfg):
    person = people(
        spark, {"person_id": 1, "gender": "M"}, {"person_id": 2, "gender": "M", "voided": 1}
    )
    decisions = person.select("person_id", "site_id")
    fixed = corrections.set_gender_female(person, decisions, cfg)
    assert values(fixed, "person_id", "gender") == [(1, "F"), (2, "M")]


# --- audit columns ------------------------------------------------------------------


def test_void_visits_has_no_guard(spark, cfg):
    visits = frame(
        spark,
        "encounter",
        [{"encounter_id": i, "site_id": 1, "voided": int(i == 2)} for i in (1, 2, 3)],
    )
    decisions = spark.createDataFrame(
        [(1, 1, 7), (2, 1, 7)], "encounter_id bigint, site_id int, user_id bigint"
    )
    fixed = corrections.void_visits(visits, decisions, cfg, as_of=AS_OF)
    reason = texts.VOID_VISIT_REASON
    assert values(fixed, "encounter_id", "voided", "voided_by", "date_voided", "void_reason") == [
        (1, 1, 7, AS_OF, reason), (2, 1, 7, AS_OF, reason), (3, 0, None, None, None),
    ]


def test_state_start_only_of_live_treatment_states(spark, cfg):
    old = date(1980, 1, 1)
    states = frame(
        spark,
        "patient_state",
        [
            {"patient_state_id": 1, "site_id": 1, "state": 7, "start_date": old},
            {"patient_state_id": 2, "site_id": 1, "state": 3, "start_date": old},
            {"patient_state_id": 3, "site_id": 1, "state": 7, "start_date": old, "voided": 1},
        ],
    )
    decisions = states.select(
        "patient_state_id", "site_id", F.lit("2001-02-03").alias("correct_date"),
        F.lit(7).alias("user_id"),
    )
    fixed = corrections.set_state_start(states, decisions, cfg, as_of=AS_OF)
    assert values(fixed, "patient_state_id", "start_date", "date_changed", "changed_by") == [
        (1, date(2001, 2, 3), AS_OF, 7), (2, old, None, None), (3, old, None, None),
    ]


def test_observation_updates(spark, cfg):
    obs = observations(
        spark,
        {"obs_id": 1, "obs_datetime": AT, "value_numeric": 1.0},
        {"obs_id": 2, "obs_datetime": AT, "value_numeric": 1.0, "voided": 1},
        {"obs_id": 1, "site_id": 2, "obs_datetime": AT, "value_numeric": 1.0},
    )
    new = datetime(2021, 1, 1, 8)
    decisions = spark.createDataFrame(
        [(1, 1, 1, new, 5.0, 7), (2, 1, 1, new, 5.0, 7)],
        "obs_id bigint, site_id int, person_id bigint, obs_datetime timestamp_ntz,"
        " correct_value double, user_id bigint",
    )
    moved = corrections.set_obs_datetime(obs, decisions, cfg)
    assert values(moved, "obs_id", "site_id", "obs_datetime", "date_changed") == [
        (1, 1, new, None), (1, 2, AT, None), (2, 1, AT, None),
    ]
    wrong_person = decisions.withColumn("person_id", F.lit(2))
    assert same_rows(corrections.set_obs_datetime(obs, wrong_person, cfg), obs)

    # the number is changed at every site with that obs_id, unless the site is asked for
    valued = corrections.set_obs_value(obs, decisions, cfg, as_of=AS_OF)
    assert values(valued, "obs_id", "site_id", "value_numeric", "changed_by") == [
        (1, 1, 5.0, 7), (1, 2, 5.0, 7), (2, 1, 1.0, None),
    ]
    valued = corrections.set_obs_value(obs, decisions, cfg, as_of=AS_OF, site_safe=True)
    assert values(valued, "obs_id", "site_id", "value_numeric") == [
        (1, 1, 5.0), (1, 2, 1.0), (2, 1, 1.0),
    ]

    voided = corrections.void_observations(obs, decisions, cfg, as_of=AS_OF)
    assert values(voided, "obs_id", "site_id", "voided", "void_reason") == [
        (1, 1, 1, texts.VOID_OBS_REASON), (1, 2, 0, None), (2, 1, 1, None),
    ]
    again = corrections.void_observations(voided, decisions, cfg, as_of=date(2021, 1, 1))
    assert same_rows(again, voided)


# --- decisions ------------------------------------------------------------------------


def test_two_decisions_for_one_row_stop_the_job(spark, cfg):
    person = people(spark, {"person_id": 1})
    decisions = spark.createDataFrame([(1, 1), (1, 1)], "person_id bigint, site_id int")
    with pytest.raises(Exception, match="more than one decision"):
        corrections.clear_death(person, decisions, cfg).collect()


def test_missing_decision_column(spark, cfg):
    person = people(spark, {"person_id": 1})
    with pytest.raises(ValueError, match="birthdate"):
        corrections.set_birthdate(person, person.select("person_id", "site_id"), cfg)


def test_site_specific_columns_are_carried_along(spark, cfg):
    person = people(spark, {"person_id": 1, "gender": "M"}).withColumn("uuid", F.lit("abc"))
    fixed = corrections.set_gender_female(person, person.select("person_id", "site_id"), cfg)
    assert fixed.columns == person.columns
    assert values(fixed, "gender", "uuid") == [("F", "abc")]


# --- inserts --------------------------------------------------------------------------

HEIGHT_DECISION = (
    "patient_id bigint, visit_date timestamp_ntz, site_id int, height_value double, user_id bigint"
)


def test_insert_height(spark, cfg):
    obs = observations(spark, {"obs_id": 40}).withColumn("uuid", F.lit("abc"))
    rows = [(i, AT, 1, 100.0 + i, 7) for i in range(20)]
    decisions = spark.createDataFrame(rows, HEIGHT_DECISION)
    result = corrections.insert_height(obs, decisions, cfg, as_of=AS_OF)
    assert result.columns == obs.columns and result.dtypes == obs.dtypes
    assert result.count() == 21
    new = result.where("obs_id > 40")
    assert values(new, "obs_id") == list(range(41, 61))
    assert values(
        new.where("person_id = 3"),
        "concept_id", "obs_datetime", "value_numeric", "creator", "date_created", "voided",
        "encounter_id", "uuid",
    ) == [(5090, AT, 103.0, 7, AS_OF, 0, None, None)]
    only_new = corrections.insert_height(obs, decisions, cfg, as_of=AS_OF, only_new=True)
    assert same_rows(only_new, new)


def test_new_numbers_do_not_depend_on_partitioning(spark):
    rows = spark.range(3000).select((F.col("id") % 7).alias("person_id"), F.col("id").alias("v"))
    table = spark.createDataFrame([(5,)], "obs_id bigint")
    one = with_new_ids(rows.repartition(1), table, "obs_id")
    many = with_new_ids(rows.repartition(13), table, "obs_id")
    assert same_rows(one, many)
    assert values(one, "obs_id") == sorted(range(6, 3006), key=str)
    assert one.select("person_id", "v").distinct().count() == 3000
    empty = spark.createDataFrame([], "obs_id bigint")
    assert with_new_ids(rows, empty, "obs_id").agg(F.min("obs_id")).first()[0] == 1


def test_given_numbers_make_the_insert_repeatable(spark, cfg):
    obs = observations(spark, {"obs_id": 40}, {"obs_id": 41, "site_id": 2})
    decisions = spark.createDataFrame(
        [(41, 1, AT, 1, 150.0, 7), (42, 2, AT, 1, 151.0, 7)], "obs_id bigint, " + HEIGHT_DECISION
    )
    once = corrections.insert_height(obs, decisions, cfg, as_of=AS_OF)
    assert values(once, "obs_id", "site_id") == [(40, 1), (41, 1), (41, 2), (42, 1)]
    assert same_rows(corrections.insert_height(once, decisions, cfg, as_of=AS_OF), once)


def test_the_same_insert_twice_stops_the_job(spark, cfg):
    obs = observations(spark, {"obs_id": 40})
    decisions = spark.createDataFrame([(1, AT, 1, 150.0, 7)] * 2, HEIGHT_DECISION)
    with pytest.raises(Exception, match="occurs more than once"):
        corrections.insert_height(obs, decisions, cfg).collect()


# --- detect, correct, detect again ------------------------------------------------------


def found(name, t, cfg, variant=CENTRAL):
    return run_rule(name, t, cfg, as_of=AS_OF, variant=variant)


def test_gender_round_trip(clinic, cfg):
    for i, g in enumerate(["male", "f", "x"], 1):
        clinic.client(i, gender=g)
    t = clinic.tables()
    assert found("r01_gender", t, cfg).count() == 3
    t = t.with_table("person", corrections.normalise_genders(t.person, cfg))
    assert values(found("r01_gender", t, cfg), "gender") == ["x"]


def test_visit_after_death_round_trip(clinic, cfg):
    clinic.client(1, state=3, start_date=date(2019, 5, 1))
    clinic.visit(1, 1, datetime(2019, 5, 4))
    t = clinic.tables()
    finding = found("r02_visit_after_death", t, cfg)
    cleared = corrections.clear_death(
        t.person, finding.select(F.col("patient_id").alias("person_id"), "site_id"), cfg
    )
    # the rule reads the state, not person.dead
    assert found("r02_visit_after_death", t.with_table("person", cleared), cfg).count() == 1
    decisions = finding.select("encounter_id", "site_id", F.lit(7).alias("user_id"))
    voided = corrections.void_visits(t.encounter, decisions, cfg, as_of=AS_OF)
    assert found("r02_visit_after_death", t.with_table("encounter", voided), cfg).count() == 0


def test_birth_round_trip(clinic, cfg):
    clinic.client(1, birthdate=date(2000, 1, 11), start_date=date(2000, 1, 1))
    clinic.obs(1, 6131, datetime(1999, 1, 1), obs_id=1)
    t = clinic.tables()
    finding = found("r03_art_before_birth", t, cfg)
    moved = corrections.set_obs_datetime(
        t.obs,
        t.obs.select("obs_id", "site_id", "person_id", F.lit(AS_OF).alias("obs_datetime")),
        cfg,
    )
    assert found("r03_art_before_birth", t.with_table("obs", moved), cfg).count() == 1
    decisions = finding.select(
        F.col("patient_id").alias("person_id"), "site_id", F.lit("1980-01-01").alias("birthdate")
    )
    fixed = corrections.set_birthdate(t.person, decisions, cfg)
    assert found("r03_art_before_birth", t.with_table("person", fixed), cfg).count() == 0


def test_male_and_age_round_trips(clinic, cfg):
    clinic.client(1, gender="M", birthdate=date(1990, 1, 1))
    clinic.client(2, gender="F", birthdate=date(2019, 1, 1))
    for number in (1, 2):
        clinic.obs(number, 6131, datetime(2019, 5, 4), value_coded=1065)
    t = clinic.tables()
    who = [F.col("patient_id").alias("person_id"), "site_id"]
    men = found("r04_male_pregnancy", t, cfg).select(*who)
    female = corrections.set_gender_female(t.person, men, cfg)
    assert found("r04_male_pregnancy", t.with_table("person", female), cfg).count() == 0
    which = t.obs.where("person_id = 1").select("obs_id", "site_id", F.lit(7).alias("user_id"))
    voided = corrections.void_observations(t.obs, which, cfg, as_of=AS_OF)
    assert found("r04_male_pregnancy", t.with_table("obs", voided), cfg).count() == 0
    young = found("r05_female_age_range", t, cfg).select(
        *who, F.lit("1999-01-01").alias("birthdate")
    )
    fixed = corrections.set_birthdate(t.person, young, cfg)
    assert found("r05_female_age_range", t.with_table("person", fixed), cfg).count() == 0


def test_treatment_date_round_trip(clinic, cfg):
    clinic.client(1, start_date=date(1980, 1, 1))
    t = clinic.tables()
    decisions = t.patient_state.select(
        "patient_state_id", "site_id", F.lit("2001-02-03").alias("correct_date"),
        F.lit(7).alias("user_id"),
    )
    assert found("r06_art_date_implausible", t, cfg).count() == 1
    fixed = corrections.set_state_start(t.patient_state, decisions, cfg, as_of=AS_OF)
    assert found("r06_art_date_implausible", t.with_table("patient_state", fixed), cfg).count() == 0


def test_height_round_trips(clinic, cfg):
    clinic.client(1, birthdate=date(2010, 1, 1))
    clinic.client(2, birthdate=date(1980, 1, 1), date_enrolled=date(2010, 1, 1))
    clinic.visit(1, 1, AT)
    for concept in (5089, 2137):
        clinic.obs(1, concept, AT, encounter_id=1, value_numeric=10.0)
    t = clinic.tables()
    name = "r07_peds_missing_vitals"
    assert values(found(name, t, cfg), "DQ_flag") == ["Height missing at this visit"]
    user = F.lit(7).alias("user_id")
    without_visit = found(name, t, cfg, DETECTION).select(
        "patient_id", "visit_date", "site_id", F.lit(90.0).alias("height_value"), user
    )
    t7b = t.with_table("obs", corrections.insert_height(t.obs, without_visit, cfg))
    assert found(name, t7b, cfg).count() == 1  # a height without a visit does not help
    at_visit = found(name, t, cfg, DETECTION).select(
        "patient_id", F.col("visit_date").alias("encounter_datetime"), "encounter_id", "site_id",
        F.lit(90.0).alias("height_in_cm"), user,
    )
    t8 = t.with_table("obs", corrections.insert_height_at_visit(t.obs, at_visit, cfg))
    assert found(name, t8, cfg).count() == 0

    adults = found("r08_adult_no_height", t, cfg).select(
        "patient_id", F.lit(AS_OF).alias("visit_date"), "site_id",
        F.lit(170.0).alias("height_value"), user,
    )
    assert values(adults, "patient_id") == [2]
    fixed = t.with_table("obs", corrections.insert_height(t.obs, adults, cfg))
    assert found("r08_adult_no_height", fixed, cfg).count() == 0


def test_breastfeeding_no_does_not_clear(clinic, cfg):
    clinic.client(1, gender="F", start_date=date(2015, 1, 1))
    clinic.obs(1, 7965, datetime(2015, 5, 4), value_coded=1065)
    t = clinic.tables()
    decisions = found("r10_breastfeeding", t, cfg).select(
        "patient_id", F.lit(AS_OF).alias("current_encounter_datetime"),
        F.lit(5).alias("encounter_id"), "site_id", F.lit(7).alias("user_id"),
    )
    new = corrections.insert_breastfeeding_no(t.obs, decisions, cfg, as_of=AS_OF)
    assert values(new.where("value_coded = 1066"), "concept_id", "encounter_id") == [(7965, 5)]
    assert found("r10_breastfeeding", t.with_table("obs", new), cfg).count() == 1


# --- parts of a table ---------------------------------------------------------------


UPDATES = {
    "clear_death": ("person", "person_id", {}),
    "set_birthdate": ("person", "person_id", {"birthdate": date(1990, 1, 1)}),
    "set_gender_female": ("person", "person_id", {}),
    "void_visits": ("encounter", "encounter_id", {"user_id": 7}),
    "set_state_start": ("patient_state", "patient_state_id",
                        {"correct_date": date(1999, 1, 1), "user_id": 7}),
    "set_obs_datetime": ("obs", "obs_id", {"person_id": 1, "obs_datetime": AT}),
    "void_observations": ("obs", "obs_id", {"user_id": 7}),
    "set_obs_value": ("obs", "obs_id", {"correct_value": 5.0, "user_id": 7}),
}


@pytest.mark.parametrize("name", UPDATES)
def test_part_and_rest_make_the_whole(spark, cfg, name):
    table, key, values_given = UPDATES[name]
    extra = {"state": cfg.state_on_art} if table == "patient_state" else {}
    extra |= {"person_id": 1} if table == "obs" else {}
    rows = [{key: n, "site_id": site, **extra} for n in (1, 2) for site in (1, 2, 3)]
    whole = frame(spark, table, rows)
    given = {key: 1, "site_id": 2, **values_given}
    decisions = spark.createDataFrame([tuple(given.values())], list(given))
    correct = getattr(corrections, name)
    options = {"site_safe": True} if name == "set_obs_value" else {}
    want = correct(whole, decisions, cfg, **options)
    assert not same_rows(want, whole)
    for part in (
        corrections.at_decided_sites(whole, decisions),
        corrections.at_sites(whole, [2]),
    ):
        fixed = correct(part, decisions, cfg, **options)
        assert same_rows(fixed.unionByName(whole.where("site_id != 2")), want)


def test_a_part_is_refused_where_the_key_lacks_the_site(spark, cfg):
    obs = observations(spark, *({"obs_id": 1, "site_id": s} for s in (1, 2)))
    decisions = spark.createDataFrame([(1, 1, 5.0, 7)], "obs_id long, site_id int, correct_value double, user_id long")
    whole = corrections.set_obs_value(obs, decisions, cfg)
    assert values(whole, "site_id", "value_numeric") == [(1, 5.0), (2, 5.0)]
    with pytest.raises(ValueError, match="whole table"):
        corrections.set_obs_value(corrections.at_decided_sites(obs, decisions), decisions, cfg)
