"""Every branch and boundary of the ten rules on hand-made records."""

from datetime import date, datetime, timedelta

import pytest
from conftest import AS_OF, values
from pyspark.sql import functions as F

from clinsift import CENTRAL, DETECTION, run_rule


def run(name, clinic, cfg, variant=CENTRAL, **options):
    return run_rule(name, clinic.tables(), cfg, as_of=AS_OF, variant=variant, **options)


# --- client rules -----------------------------------------------------------------


def test_gender_values(clinic, cfg):
    for i, g in enumerate(["M", "F", "U", "m", "male", None], 1):
        clinic.client(i, gender=g)
    clinic.state(6)  # a second open state is not a second finding
    clinic.client(7, gender=None, person_voided=1)  # person.voided does not matter
    detection = run("r01_gender", clinic, cfg, DETECTION)
    assert detection.columns == ["patient_id", "gender", "site_id"]
    assert values(detection, "patient_id") == [4, 5, 6, 7]
    central = run("r01_gender", clinic, cfg)
    assert central.columns == [
        "patient_id", "site_id", "gender", "DQ_flag", "kahn_category", "severity",
    ]
    assert values(central, "patient_id", "DQ_flag", "severity") == [
        (3, "Non-standard gender value: U", "High"),
        (4, "Non-standard gender value: m", "High"),
        (5, "Non-standard gender value: male", "High"),
        (6, "Gender is NULL", "High"),
        (7, "Gender is NULL", "High"),
    ]


@pytest.mark.parametrize(
    "left_out",
    [
        {"patient_voided": 1},
        {"program_voided": 1},
        {"state_voided": 1},
        {"end_date": date(2019, 1, 1)},
        {"state": 3},
        {"program_id": 2},
    ],
)
def test_who_is_not_in_the_cohort(clinic, cfg, left_out):
    clinic.client(1, gender=None)
    clinic.client(2, gender=None, **left_out)
    assert values(run("r01_gender", clinic, cfg), "patient_id") == [1]


def test_same_number_at_two_sites(clinic, cfg):
    clinic.client(1, site=1, gender="M")
    clinic.client(1, site=2, gender="x")
    assert values(run("r01_gender", clinic, cfg), "patient_id", "site_id") == [(1, 2)]


def test_treatment_before_birth(clinic, cfg):
    clinic.client(1, birthdate=date(2000, 1, 11), start_date=date(2000, 1, 1))
    clinic.client(2, birthdate=date(2000, 1, 1), start_date=date(2000, 1, 1))
    clinic.client(3, birthdate=None, start_date=None)
    clinic.client(4, birthdate=date(2000, 1, 1), start_date=None)
    assert values(
        run("r03_art_before_birth", clinic, cfg),
        "patient_id", "days_before_birth", "DQ_flag", "severity",
    ) == [
        (1, 10, "ART initiated 10 day(s) before recorded birthdate", "High"),
        (3, None, "Birthdate is NULL - cannot verify", "Medium"),
        (4, None, "ART start date is NULL - cannot verify", "Medium"),
    ]
    assert values(
        run("r03_art_before_birth", clinic, cfg, DETECTION), "patient_id", "issue"
    ) == [
        (1, "ART started before birth"),
        (3, "Missing birthdate"),
        (4, "Missing ART start date"),
    ]


def test_implausible_treatment_dates(clinic, cfg):
    for i, day in enumerate(
        [None, date(1984, 12, 31), date(1985, 1, 1), AS_OF, AS_OF + timedelta(1)], 1
    ):
        clinic.client(i, start_date=day)
    clinic.client(6, start_date=None)
    clinic.rows["person"] = [p for p in clinic.rows["person"] if p["person_id"] != 6]
    assert values(run("r06_art_date_implausible", clinic, cfg), "patient_id", "DQ_flag") == [
        (1, "ART start date is NULL"),
        (2, "ART start date 1984-12-31 is before 1985 - predates existence of ART"),
        (5, "ART start date 2020-07-01 is in the future"),
        (6, "ART start date is NULL"),  # central does not ask for a person row
    ]
    assert values(
        run("r06_art_date_implausible", clinic, cfg, DETECTION), "patient_id", "issue"
    ) == [
        (1, "Missing ART start date"),
        (2, "ART start date before 1985"),
        (5, "ART start date in the future"),
    ]


def test_today_is_the_default_day(clinic, cfg):
    clinic.client(1, start_date=date.today() + timedelta(2))
    clinic.client(2, start_date=date.today() - timedelta(2))
    found = run_rule("r06_art_date_implausible", clinic.tables(), cfg)
    assert values(found, "patient_id") == [1]


def test_adults_without_height(clinic, cfg):
    old = date(1990, 1, 1)
    enrolled = date(2010, 1, 1)
    clinic.client(1, birthdate=old, date_enrolled=enrolled)
    clinic.client(2, birthdate=None, date_enrolled=None)
    clinic.client(3, birthdate=date(2005, 6, 30), date_enrolled=AS_OF)  # 15 today, enrolled at 15
    clinic.client(4, birthdate=date(2005, 7, 1), date_enrolled=AS_OF)  # still 14
    clinic.client(5, birthdate=date(1995, 1, 2), date_enrolled=enrolled)  # enrolled at 14
    clinic.client(6, birthdate=date(1900, 6, 30), date_enrolled=enrolled)  # 120 today
    clinic.client(7, birthdate=date(1899, 6, 30), date_enrolled=enrolled)  # 121
    clinic.client(8, birthdate=old, date_enrolled=None)  # enrolment unknown: not tested
    clinic.client(9, birthdate=old, date_enrolled=enrolled)
    clinic.obs(9, 5090, datetime(2011, 1, 1), value_numeric=160.0)
    clinic.client(10, birthdate=old, date_enrolled=enrolled)
    clinic.obs(10, 5090, datetime(2011, 1, 1), value_numeric=160.0, voided=1)
    clinic.obs(10, 5090, datetime(2011, 1, 1), value_numeric=None)
    clinic.obs(10, 5090, datetime(2011, 1, 1), site=2, value_numeric=160.0)
    found = run("r08_adult_no_height", clinic, cfg)
    assert values(found, "patient_id", "current_age", "age_at_enrolment", "DQ_flag") == [
        (1, 30, 20, "Height never recorded for adult patient enrolled on 2010-01-01"),
        (10, 30, 20, "Height never recorded for adult patient enrolled on 2010-01-01"),
        (2, None, None, "Height never recorded - birthdate unknown, age unverifiable"),
        (3, 15, 15, "Height never recorded for adult patient enrolled on 2020-06-30"),
        (6, 120, 109, "Height never recorded for adult patient enrolled on 2010-01-01"),
        (7, 121, 110, "Height never recorded - current age of 121 years is implausible"),
    ]
    assert values(run("r08_adult_no_height", clinic, cfg, DETECTION), "patient_id", "issue") == [
        (1, "Height never recorded"),
        (10, "Height never recorded"),
        (2, "Height missing - birthdate unknown, age unverifiable"),
        (3, "Height never recorded"),
        (6, "Height never recorded"),
        (7, "Height missing - implausible age"),
    ]


# --- visit rules ------------------------------------------------------------------


def test_visits_after_death(clinic, cfg):
    clinic.client(1, state=3, start_date=date(2019, 5, 1))
    clinic.visit(1, 1, datetime(2019, 5, 1))  # midnight of the day: not later
    clinic.visit(2, 1, datetime(2019, 5, 1, 8))  # same day counts
    clinic.visit(3, 1, datetime(2019, 5, 4, 8))
    clinic.visit(4, 1, datetime(2019, 5, 4, 8), voided=1)
    clinic.visit(5, 1, datetime(2019, 5, 4, 8), site=2)  # someone else, same number
    clinic.visit(6, 1, datetime(2019, 5, 4, 8), encounter_type=99)  # no such type
    central = run("r02_visit_after_death", clinic, cfg)
    assert values(central, "encounter_id", "days_after_death", "encounter_type", "DQ_flag") == [
        (2, 0, "VISIT",
         "Encounter recorded 0 day(s) after recorded death date of 2019-05-01"),
        (3, 3, "VISIT",
         "Encounter recorded 3 day(s) after recorded death date of 2019-05-01"),
    ]
    detection = run("r02_visit_after_death", clinic, cfg, DETECTION)
    assert detection.columns == [
        "patient_id", "state", "start_date", "end_date", "encounter_datetime",
        "encounter_type", "site_id",
    ]
    # site 2's visit is matched too and shown with the client's site
    assert values(detection, "encounter_datetime", "site_id") == [
        (datetime(2019, 5, 1, 8), 1),
        (datetime(2019, 5, 4, 8), 1),
        (datetime(2019, 5, 4, 8), 1),
    ]
    safe = run("r02_visit_after_death", clinic, cfg, DETECTION, site_safe=True)
    assert safe.count() == 2


def test_repeated_visit_rows(clinic, cfg):
    clinic.client(1, state=3, start_date=date(2019, 5, 1))
    clinic.visit(1, 1, datetime(2019, 5, 4, 8))
    clinic.visit(1, 1, datetime(2019, 5, 4, 8))
    assert run("r02_visit_after_death", clinic, cfg, DETECTION).count() == 2
    assert run("r02_visit_after_death", clinic, cfg).count() == 1


def test_children_missing_measures(clinic, cfg):
    born = date(2004, 6, 15)
    clinic.client(1, birthdate=born)
    flags = {
        1: ((), "Weight, Height and BMI all missing"),
        2: ((2137,), "Weight and Height missing"),
        3: ((5090,), "Weight missing"),  # BMI too, but weight is told first
        4: ((5089,), "Height missing"),
        5: ((5089, 5090), "BMI missing"),
        6: ((5089, 5090, 2137), None),
    }
    for encounter, (present, _) in flags.items():
        clinic.visit(encounter, 1, datetime(2019, 6, 14, 23))  # the last day at 14
        for concept in present:
            clinic.obs(1, concept, None, encounter_id=encounter, value_numeric=10.0)
    clinic.visit(7, 1, datetime(2019, 6, 15))  # 15 years old
    clinic.visit(8, 1, datetime(2019, 6, 14), voided=1)
    expected = [(e, f) for e, (_, f) in flags.items() if f]
    assert (
        values(run("r07_peds_missing_vitals", clinic, cfg, DETECTION), "encounter_id", "issue")
        == expected
    )
    central = run("r07_peds_missing_vitals", clinic, cfg)
    assert values(central, "encounter_id", "DQ_flag", "age_at_visit", "visit_date") == [
        (e, f + " at this visit", 14, date(2019, 6, 14)) for e, f in expected
    ]


def test_highest_value_counts_and_voided_or_empty_do_not(clinic, cfg):
    clinic.client(1, birthdate=None)
    clinic.visit(1, 1, datetime(2019, 6, 14))
    clinic.obs(1, 5089, None, encounter_id=1, value_numeric=10.0)
    clinic.obs(1, 5089, None, encounter_id=1, value_numeric=12.0)
    clinic.obs(1, 5090, None, encounter_id=1, value_numeric=80.0, voided=1)
    clinic.obs(1, 2137, None, encounter_id=1, value_numeric=None)
    clinic.obs(1, 2137, None, encounter_id=None, value_numeric=20.0)
    found = run("r07_peds_missing_vitals", clinic, cfg)
    assert values(found, "weight", "height_cm", "bmi", "DQ_flag", "age_at_visit") == [
        (12.0, None, None, "Height missing at this visit", None)
    ]


def test_measurement_of_another_site_hides_a_gap_as_written(clinic, cfg):
    clinic.client(1, birthdate=None)
    clinic.visit(1, 1, datetime(2019, 6, 14))
    for concept in cfg.measures:
        clinic.obs(9, concept, None, site=2, encounter_id=1, value_numeric=1.0)
    name = "r07_peds_missing_vitals"
    assert run(name, clinic, cfg).count() == 0
    assert run(name, clinic, cfg, site_safe=True).count() == 1
    assert run(name, clinic, cfg, DETECTION).count() == 1


# --- observation rules --------------------------------------------------------------


def test_men_with_pregnancy_answers(clinic, cfg):
    clinic.client(1, gender="M")
    clinic.client(2, gender="F")
    at = datetime(2019, 3, 1, 9)
    clinic.obs(1, 6131, at, value_coded=1065)
    clinic.obs(1, 6131, at + timedelta(hours=1), value_coded=1065)  # same day again
    clinic.obs(1, 7965, at, value_text=" YES ")
    clinic.obs(1, 1755, at, value_text="\tyes")  # a tab is not trimmed
    clinic.obs(1, 5632, at, value_coded=1065, voided=1)
    clinic.obs(1, 5632, at, value_coded=1066)
    clinic.obs(1, 490, at, value_coded=1065)  # no label for this question
    clinic.obs(1, 5089, at, value_coded=1065)  # not one of the questions
    clinic.obs(1, 6131, at, site=2, value_coded=1065)  # not a client of site 2
    clinic.obs(2, 6131, at, value_coded=1065)
    central = run("r04_male_pregnancy", clinic, cfg)
    flag = "Male patient has: {} - observation recorded as Yes on 2019-03-01"
    assert values(
        central, "concept_id", "observation_answer", "answer_source", "DQ_flag"
    ) == [
        (6131, "Yes", "Coded Yes", flag.format("Patient pregnant")),
        (7965, None, "Text Yes", flag.format("Breastfeeding")),
    ]
    assert run("r04_male_pregnancy", clinic, cfg, DETECTION).count() == 3


def test_two_labels_give_two_rows_and_other_locales_none(clinic, cfg):
    clinic.client(1, gender="M")
    clinic.obs(1, 6131, datetime(2019, 3, 1), value_coded=1065)
    full = {"locale": "en", "concept_name_type": "FULLY_SPECIFIED"}
    clinic.add("concept_name", concept_id=6131, name="Pregnant", **full)
    clinic.add("concept_name", concept_id=6131, name="Enceinte", **{**full, "locale": "fr"})
    clinic.add("concept_name", concept_id=1065, name="Y", locale="en", concept_name_type="SHORT")
    found = run("r04_male_pregnancy", clinic, cfg)
    assert values(found, "observation_question") == ["Patient pregnant", "Pregnant"]


def test_age_range_of_women(clinic, cfg):
    clinic.client(1, gender="F", birthdate=date(2000, 2, 29))
    clinic.client(2, gender="F", birthdate=None)
    for day in [
        datetime(2008, 2, 28), datetime(2008, 2, 29),  # 7 and 8 years
        datetime(2056, 2, 28), datetime(2056, 2, 29),  # 55 and 56 years
    ]:
        clinic.obs(1, 6131, day, value_numeric=1.0)
    clinic.obs(2, 6131, datetime(2019, 1, 1), value_datetime=datetime(2019, 9, 1))
    clinic.obs(2, 6131, datetime(2019, 1, 1), value_text="no")
    central = run("r05_female_age_range", clinic, cfg)
    assert values(central, "age_at_observation", "DQ_flag", "severity") == [
        (56, "Patient was 56 years old at obs - above maximum reproductive age of 55", "High"),
        (7, "Patient was 7 years old at obs - below minimum reproductive age of 8", "High"),
        (None, "Birthdate missing - age at observation unverifiable", "Medium"),
    ]
    detection = run("r05_female_age_range", clinic, cfg, DETECTION)
    assert values(detection, "age_at_observation", "issue") == [
        (56, "Age outside 8-55 at time of observation"),
        (7, "Age outside 8-55 at time of observation"),
        (None, "Missing birthdate"),
    ]


def test_pregnant_around_treatment_start(clinic, cfg):
    start = date(2019, 3, 1)
    clinic.client(1, gender="F", start_date=start)
    clinic.client(2, gender="F", start_date=None)
    noon = datetime(2019, 3, 1, 12)
    for days in (-31, -30, 0, 30, 31):
        clinic.obs(1, 6131, noon + timedelta(days), value_coded=1065)
    clinic.obs(1, 6131, noon, value_numeric=1.0)  # a number counts in detection only
    clinic.obs(1, 7965, noon, value_coded=1065)  # breastfeeding is not asked here
    clinic.obs(2, 6131, noon, value_datetime=noon)
    central = run("r09_pregnant_at_art_start", clinic, cfg)
    told = "Pregnancy observation recorded {} day(s) {} ART initiation date of 2019-03-01"
    assert values(central, "days_from_art_start", "DQ_flag", "severity") == [
        (-30, told.format(30, "before"), "Low"),
        (0, told.format(0, "after"), "Low"),
        (30, told.format(30, "after"), "Low"),
        (None, "ART start date missing - cannot verify pregnancy timing", "Medium"),
    ]
    detection = run("r09_pregnant_at_art_start", clinic, cfg, DETECTION)
    assert values(detection, "patient_id", "obs_date", "issue") == [
        (1, noon + timedelta(-30), "Pregnant at ART initiation"),
        (1, noon, "Pregnant at ART initiation"),
        (1, noon, "Pregnant at ART initiation"),  # coded and numeric answer differ
        (1, noon + timedelta(30), "Pregnant at ART initiation"),
    ]


def test_central_keeps_equal_pregnancy_rows(clinic, cfg):
    clinic.client(1, gender="F", start_date=date(2019, 3, 1))
    for _ in range(2):
        clinic.obs(1, 6131, datetime(2019, 3, 1, 12), value_coded=1065)
    assert run("r09_pregnant_at_art_start", clinic, cfg).count() == 2
    assert run("r09_pregnant_at_art_start", clinic, cfg, DETECTION).count() == 1


def test_latest_breastfeeding_answer(clinic, cfg):
    today = datetime(AS_OF.year, AS_OF.month, AS_OF.day, 7)
    clinic.client(1, gender="F", start_date=date(2015, 1, 1))
    clinic.client(2, gender="F", start_date=None)
    clinic.client(3, gender="F", start_date=date(2015, 1, 1))
    clinic.obs(1, 7965, today - timedelta(900), value_coded=1065)
    clinic.obs(1, 7965, today - timedelta(730), value_coded=1065)
    clinic.obs(1, 7965, today - timedelta(1), value_coded=1066)  # a later "no" is not ranked
    clinic.obs(1, 5632, today - timedelta(5), value_text="yes")
    clinic.obs(2, 7965, today - timedelta(731), value_coded=1065)
    clinic.obs(3, 7965, today - timedelta(9), value_coded=1065, voided=1)
    central = run("r10_breastfeeding", clinic, cfg)
    assert values(central, "patient_id", "concept_id", "days_since_obs", "severity", "DQ_flag") == [
        (1, 5632, 5, "Low",
         "Patient currently recorded as breastfeeding as of 2020-06-25"),
        (1, 7965, 730, "Low",
         "Patient currently recorded as breastfeeding as of 2018-07-01"),
        (2, 7965, 731, "High",
         "Breastfeeding status last confirmed: 731 days ago - exceeds 24 month biological"
         " limit, verify if still current"),
    ]
    detection = run("r10_breastfeeding", clinic, cfg, DETECTION)
    assert "obs_anser_text" in detection.columns
    # one question only, and only clients with a start date
    assert values(detection, "patient_id", "days_since_obs", "issue") == [
        (1, 730, "Currently breastfeeding")
    ]


def test_breastfeeding_ties_and_sites(clinic, cfg):
    at = datetime(2020, 1, 1)
    for site in (2, 1):
        clinic.client(1, site=site, gender="F", start_date=date(2015, 1, 1))
    clinic.obs(1, 7965, at, site=2, obs_id=1, value_coded=1065)
    clinic.obs(1, 7965, at, site=1, obs_id=9, value_text="yes")
    clinic.obs(1, 7965, at, site=1, obs_id=8, value_coded=1065)
    # equal times: smallest site, then smallest obs_id
    assert values(run("r10_breastfeeding", clinic, cfg), "site_id", "value_coded") == [(1, 1065)]
    safe = run("r10_breastfeeding", clinic, cfg, site_safe=True)
    assert values(safe, "site_id") == [1, 2]


# --- order and arguments ------------------------------------------------------------


def test_ordered_output(clinic, cfg):
    for number, site in [(3, 1), (1, 2), (2, 1)]:
        clinic.client(number, site=site, gender=None, birthdate=None)
        clinic.visit(number * 10 + 1, number, datetime(2019, 1, 2, 9), site=site)
        clinic.visit(number * 10, number, datetime(2019, 1, 2, 10), site=site)
    ordered = run("r01_gender", clinic, cfg, ordered=True)
    assert [r.patient_id for r in ordered.collect()] == [2, 3, 1]
    ordered = run("r01_gender", clinic, cfg, DETECTION, ordered=True)
    assert [r.patient_id for r in ordered.collect()] == [1, 2, 3]
    # the time decides although only the day is shown
    ordered = run("r07_peds_missing_vitals", clinic, cfg, ordered=True)
    assert [r.encounter_id for r in ordered.collect()] == [21, 20, 31, 30, 11, 10]


def test_start_dates_may_be_times(clinic, cfg):
    clinic.client(1, birthdate=None, start_date=date(2000, 1, 1))
    clinic.client(2, birthdate=date(2000, 1, 1), start_date=date(2000, 1, 1))
    t = clinic.tables()
    at = F.col("start_date").cast("timestamp_ntz") + F.expr("interval 5 hours")
    again = t.patient_state.withColumn("start_date", at)
    later = again.withColumn("start_date", F.col("start_date") + F.expr("interval 1 hour"))
    t = t.with_table("patient_state", again.unionByName(later))
    found = run_rule("r03_art_before_birth", t, cfg, as_of=AS_OF)
    assert values(found, "patient_id", "art_start_date") == [(1, date(2000, 1, 1))]


def test_unknown_variant(clinic, cfg):
    with pytest.raises(ValueError, match="variant"):
        run("r01_gender", clinic, cfg, "both")


def test_missing_column_is_reported_at_once(clinic):
    t = clinic.tables()
    with pytest.raises(ValueError, match="gender"):
        t.with_table("person", t.person.drop("gender"))
