"""Every registered query: (spark, folder of test data) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date
from functools import lru_cache, partial

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from checks.fixture import AS_OF, CONFIG, record_tables
from clinsift import CENTRAL, DETECTION, RULES, RecordTables, corrections, reviews, run_rule
from clinsift.config import Variant
from clinsift.functions import age_years, answer_source, has_answer
from clinsift.operators import (
    client_observations,
    cohort,
    label_obs,
    latest_per_group,
    measure_pivot,
    prepare_clients,
    skew_join,
    without_height,
)
from clinsift.operators.clients import CLIENT, live
from clinsift.operators.joins import present
from clinsift.operators.positions import with_position
from clinsift.plans import history
from clinsift.plans.delta import findings_delta
from clinsift.sources import TABLES, read_catalog

OWN_IDS = 10**15  # above every id of the fixture

Query = Callable[[RecordTables], DataFrame]


def _user() -> Column:
    return F.lit(7).alias("user_id")


def _with_own_ids(t: RecordTables, decisions: DataFrame, key: str, obs_key: str) -> DataFrame:
    """Decisions that bring ids; every seventh one, if it can, an id that the table has."""
    ids = present(t.obs, [obs_key]).groupBy(F.col(obs_key).alias(key), "site_id").agg(
        F.min("obs_id").alias("taken")
    )
    old = F.when(F.col(key) % 7 == 0, F.col("taken"))
    return decisions.join(ids, [key, "site_id"], "left").select(
        *decisions.columns, F.coalesce(old, F.col(key) + OWN_IDS).alias("obs_id")
    )


def rule(
    name: str, variant: Variant, site_safe: bool = False
) -> Callable[[RecordTables], DataFrame]:
    return lambda t: run_rule(
        name, t, CONFIG, as_of=AS_OF, variant=variant, site_safe=site_safe
    )


def _rules() -> dict[str, Query]:
    out: dict[str, Query] = {}
    for name in RULES:
        out[f"{name}_det"] = rule(name, DETECTION)
        out[f"{name}_cen"] = rule(name, CENTRAL)
    # the rules that leave the site out of a key, with the site put in
    out["r02_visit_after_death_det_site_safe"] = rule("r02_visit_after_death", DETECTION, True)
    out["r07_peds_missing_vitals_cen_site_safe"] = rule("r07_peds_missing_vitals", CENTRAL, True)
    out["r10_breastfeeding_det_site_safe"] = rule("r10_breastfeeding", DETECTION, True)
    out["r10_breastfeeding_cen_site_safe"] = rule("r10_breastfeeding", CENTRAL, True)
    return out


# A fixed change set over the fixture: some people get another gender and birthdate, and
# the observations of some people are voided.  Fixed values; the SQL states the same.
CHANGED_PERSON = 37
CHANGED_OBS = 29


def changed_tables(t: RecordTables) -> tuple[RecordTables, dict[str, DataFrame]]:
    """The tables after the change set, and the change rows (old and new versions)."""
    hit = F.col("person_id") % CHANGED_PERSON == 0
    people = t.person.where(hit)
    renamed = people.withColumns({"gender": F.lit("X"), "birthdate": F.date_add("birthdate", 400)})
    voided = F.col("person_id") % CHANGED_OBS == 0
    facts = t.obs.where(voided)
    void = facts.withColumn("voided", F.lit(1).cast(t.obs.schema["voided"].dataType))
    new = t.with_table("person", t.person.where(~hit | hit.isNull()).unionByName(renamed)).with_table(
        "obs", t.obs.where(~voided | voided.isNull()).unionByName(void)
    )
    return new, {"person": people.unionByName(renamed), "obs": facts.unionByName(void)}


def _deltas() -> dict[str, Query]:
    def delta(name: str) -> Query:
        def run(t: RecordTables) -> DataFrame:
            new, changes = changed_tables(t)
            before = {name: run_rule(name, t, CONFIG, as_of=AS_OF, variant=CENTRAL)}
            return findings_delta(new, changes, before, CONFIG, rules=[name], variant=CENTRAL, as_of=AS_OF)[name]

        return run

    return {f"{name}_cen_delta": delta(name) for name in RULES}


# A decision log over the fixture: birthdates decided on two days, a later decision of the same
# day winning, and one batch replayed.  Fixed values; the SQL states the same.
LOG_KEYS, LOG_VALUES = ["person_id", "site_id"], ["birthdate"]
KNOWN_ON = date(2001, 2, 15)


def decision_log(t: RecordTables) -> DataFrame:
    def decided(every: int, shift: int, day: date, seq: int) -> DataFrame:
        return t.person.where(F.col("person_id") % every == 0).select(
            "person_id",
            "site_id",
            F.date_add("birthdate", shift).alias("birthdate"),
            F.lit(day).alias("decided_on"),
            F.lit(seq).alias("seq"),
        )

    first, second = date(2001, 1, 10), date(2001, 2, 1)
    parts = [decided(5, -1, first, 1), decided(10, 30, second, 2), decided(20, 60, second, 1), decided(40, 30, second, 2)]
    log = parts[0]
    for part in parts[1:]:
        log = log.unionByName(part)
    return log


def _history() -> dict[str, Query]:
    def as_known(t: RecordTables) -> DataFrame:
        known = history.known_on(decision_log(t), LOG_KEYS, LOG_VALUES, KNOWN_ON)
        return corrections.set_birthdate(t.person, known, CONFIG)

    return {
        "h01_birthdate_versions": lambda t: history.versions(decision_log(t), LOG_KEYS, LOG_VALUES),
        "h02_birthdate_known_on": lambda t: history.known_on(decision_log(t), LOG_KEYS, LOG_VALUES, KNOWN_ON),
        "h03_birthdates_as_known": as_known,
    }


def _positions() -> dict[str, Query]:
    """The order of a result as a column (O1-O5), by distributed positions."""

    def at(name: str, variant: Variant, order: list[str], drop: tuple[str, ...] = ()) -> Query:
        def run(t: RecordTables) -> DataFrame:
            placed = with_position(rule(name, variant)(t), order)
            return placed.drop(*drop)

        return run

    return {
        "o1_by_patient": at("r01_gender", DETECTION, ["patient_id"]),
        "o2_by_site_patient": at("r01_gender", CENTRAL, ["site_id", "patient_id"]),
        "o3_by_encounter_date": at("r02_visit_after_death", CENTRAL, ["encounter_date"]),
        "o4_by_unshown_visit": at("r07_peds_missing_vitals", CENTRAL, ["site_id", "encounter_id"], ("encounter_id",)),
        "o5_by_patient_time": at("r04_male_pregnancy", DETECTION, ["patient_id", "obs_datetime"]),
    }


def _reviews() -> dict[str, Query]:
    return {
        "v03_birth_art_review": lambda t: reviews.birth_and_treatment(t, CONFIG),
        "v06_state_review": lambda t: reviews.treatment_states(
            t, rule("r06_art_date_implausible", CENTRAL)(t), CONFIG
        ),
        "v09_pmtct_gap": lambda t: reviews.not_in_pmtct(t, CONFIG),
    }


def _blocks() -> dict[str, Query]:
    def flags(t: RecordTables) -> DataFrame:
        def number(found):
            return F.when(found, 1).otherwise(0)

        return t.obs.select(
            "obs_id",
            "site_id",
            number(has_answer()).alias("said_yes"),
            number(has_answer(datetime=True)).alias("yes_or_date"),
            number(has_answer(datetime=True, numeric=True)).alias("yes_or_value"),
        )

    def ages(t: RecordTables) -> DataFrame:
        people = t.person.select(F.col("person_id").alias("patient_id"), "site_id", "birthdate")
        visits = skew_join(
            t.encounter.select("encounter_id", *CLIENT, "encounter_datetime"),
            people,
            CLIENT,
            spread_by=["encounter_id"],
            salts=CONFIG.salts,
        )
        age = age_years(F.col("birthdate"), F.col("encounter_datetime"))
        return visits.select(
            "encounter_id", "site_id", "birthdate", "encounter_datetime", age.alias("age_years")
        )

    return {
        "b1_cohort": lambda t: prepare_clients(t, CONFIG, CONFIG.state_on_art),
        "b2_label_obs": lambda t: label_obs(t.obs, t.concept_name, CONFIG).select(
            "obs_id", "site_id", "concept_id", "observation_question",
            "value_coded", "observation_answer",
        ),
        "b3_answer_source": lambda t: t.obs.select(
            "obs_id",
            "site_id",
            answer_source(F.col("value_coded"), F.col("value_text")).alias("answer_source"),
        ),
        "b4_has_answer": flags,
        "b5_age_years": ages,
        "b6_measure_pivot": lambda t: measure_pivot(t.obs, ["encounter_id", "site_id"], CONFIG),
        "b7_latest_obs": lambda t: latest_per_group(
            t.obs.select("person_id", "concept_id", "site_id", "obs_id", "obs_datetime"),
            ["person_id", "concept_id"],
            "obs_datetime",
            ["site_id", "obs_id"],
        ),
        "b8_no_height": lambda t: without_height(
            cohort(t, CONFIG, state=CONFIG.state_on_art), t.obs, CONFIG
        ),
    }


def _scans() -> dict[str, Query]:
    def scan(table: str) -> Query:
        def through_the_catalogue(t: RecordTables) -> DataFrame:
            for name in TABLES:
                getattr(t, name).createOrReplaceTempView(name)
            return getattr(read_catalog(t.person.sparkSession), table)

        return through_the_catalogue

    # not concept_name: the fixture states its few rows, they do not come from the data
    grown = [table for table in TABLES if table != "concept_name"]
    return {f"s{i}_{table}": scan(table) for i, table in enumerate(grown, 1)}


def _found_people(t: RecordTables, name: str) -> DataFrame:
    found = rule(name, CENTRAL)(t)
    return found.select(F.col("patient_id").alias("person_id"), "site_id").distinct()


def _corrections() -> dict[str, Query]:
    """Each correction with decisions for all findings of its rule."""

    def birthdates(t: RecordTables, name: str, day: str) -> DataFrame:
        found = rule(name, CENTRAL)(t).where(F.col(day).isNotNull())
        decisions = found.groupBy(F.col("patient_id").alias("person_id"), "site_id").agg(
            F.date_sub(F.min(day), 9000).alias("birthdate")
        )
        return corrections.set_birthdate(t.person, decisions, CONFIG)

    def void_visits(t: RecordTables) -> DataFrame:
        late = rule("r02_visit_after_death", CENTRAL)(t)
        decisions = late.select("encounter_id", "site_id").distinct().select("*", _user())
        return corrections.void_visits(t.encounter, decisions, CONFIG, as_of=AS_OF)

    def obs_before_birth(t: RecordTables) -> DataFrame:
        people = t.person.select("person_id", "site_id", "birthdate")
        facts = t.obs.select("obs_id", "site_id", "person_id", "obs_datetime")
        early = skew_join(
            facts, people, ["person_id", "site_id"], spread_by=["obs_id"], salts=CONFIG.salts
        ).where(F.col("obs_datetime") < F.col("birthdate"))
        decisions = early.groupBy("obs_id", "site_id", "person_id").agg(
            F.max(F.col("birthdate").cast("timestamp_ntz")).alias("obs_datetime")
        )
        return corrections.set_obs_datetime(t.obs, decisions, CONFIG)

    def void_obs(t: RecordTables) -> DataFrame:
        men = cohort(t, CONFIG, state=CONFIG.state_on_art, gender="M")
        found = client_observations(
            t.obs, men, has_answer(), CONFIG.maternal_questions, CONFIG
        )
        decisions = found.select("obs_id", "site_id").distinct().select("*", _user())
        return corrections.void_observations(t.obs, decisions, CONFIG, as_of=AS_OF)

    def state_start(t: RecordTables) -> DataFrame:
        found = rule("r06_art_date_implausible", CENTRAL)(t).select(*CLIENT).distinct()
        states = reviews.treatment_states(t, found, CONFIG).join(found, CLIENT, "left_semi")
        decisions = states.select(
            "patient_state_id", "site_id", F.lit("1999-01-01").alias("correct_date"), _user()
        )
        return corrections.set_state_start(t.patient_state, decisions, CONFIG, as_of=AS_OF)

    def obs_value(t: RecordTables, site_safe: bool) -> DataFrame:
        keys = ["obs_id", "site_id"] if site_safe else ["obs_id"]
        empty = t.obs.where(
            live() & F.col("concept_id").isin(*CONFIG.measures) & F.col("value_numeric").isNull()
        )
        decisions = empty.select(*keys).distinct().select(
            "*", F.lit(50.0).alias("correct_value"), _user()
        )
        return corrections.set_obs_value(
            t.obs, decisions, CONFIG, as_of=AS_OF, site_safe=site_safe
        )

    def height(t: RecordTables, name: str = "r08_adult_no_height", own_ids: bool = False) -> DataFrame:
        found = rule(name, CENTRAL)(t).select(*CLIENT).distinct()
        decisions = found.select(
            "*", F.lit(AS_OF).alias("visit_date"), F.lit(150.0).alias("height_value"), _user()
        )
        if own_ids:
            decisions = _with_own_ids(t, decisions, "patient_id", "person_id")
        return corrections.insert_height(t.obs, decisions, CONFIG, as_of=AS_OF)

    def height_at_last_visit(t: RecordTables) -> DataFrame:
        """Adults without a height, at their latest visit."""
        found = rule("r08_adult_no_height", CENTRAL)(t).select(*CLIENT).distinct()
        visits = t.encounter.where(live()).select(*CLIENT, "encounter_id", "encounter_datetime")
        last = latest_per_group(visits, CLIENT, "encounter_datetime", ["encounter_id"])
        decisions = found.join(last, CLIENT).select(
            *CLIENT, "encounter_id", "encounter_datetime", F.lit(150.0).alias("height_in_cm"), _user()
        )
        return corrections.insert_height_at_visit(t.obs, decisions, CONFIG, as_of=AS_OF)

    def height_at_visit(t: RecordTables, own_ids: bool = False) -> DataFrame:
        found = rule("r07_peds_missing_vitals", DETECTION)(t).where(F.col("height_cm").isNull())
        decisions = found.select(
            *CLIENT,
            "encounter_id",
            F.col("visit_date").alias("encounter_datetime"),
            F.lit(120.0).alias("height_in_cm"),
            _user(),
        ).distinct()
        if own_ids:
            decisions = _with_own_ids(t, decisions, "encounter_id", "encounter_id")
        return corrections.insert_height_at_visit(t.obs, decisions, CONFIG, as_of=AS_OF)

    def breastfeeding_no(t: RecordTables, own_ids: bool = False) -> DataFrame:
        found = rule("r10_breastfeeding", CENTRAL)(t).select(*CLIENT).distinct()
        visits = t.encounter.where(live()).select(*CLIENT, "encounter_id", "encounter_datetime")
        last = latest_per_group(visits, CLIENT, "encounter_datetime", ["encounter_id"])
        decisions = found.join(last, CLIENT).select(
            *CLIENT, "encounter_id", F.lit(AS_OF).cast("timestamp_ntz").alias("current_encounter_datetime"), _user()
        )
        if own_ids:
            decisions = _with_own_ids(t, decisions, "patient_id", "person_id")
        return corrections.insert_breastfeeding_no(t.obs, decisions, CONFIG, as_of=AS_OF)

    return {
        "c01_normalise_gender": lambda t: corrections.normalise_genders(t.person, CONFIG),
        "c02a_clear_death": lambda t: corrections.clear_death(
            t.person, _found_people(t, "r02_visit_after_death"), CONFIG
        ),
        "c02b_void_encounter": void_visits,
        "c03a_set_birthdate": lambda t: birthdates(t, "r03_art_before_birth", "art_start_date"),
        "c03b_set_obs_datetime": obs_before_birth,
        "c04a_set_gender_f": lambda t: corrections.set_gender_female(
            t.person, _found_people(t, "r04_male_pregnancy"), CONFIG
        ),
        "c04b_void_obs": void_obs,
        "c05_set_birthdate": lambda t: birthdates(t, "r05_female_age_range", "obs_date"),
        "c06_set_state_start": state_start,
        "c07a_set_obs_numeric": partial(obs_value, site_safe=False),
        "c07a_set_obs_numeric_site_safe": partial(obs_value, site_safe=True),
        "c07b_insert_height": height,
        "c08_insert_height_visit": height_at_visit,
        "c10_insert_bf_no": breastfeeding_no,
        "c07b_insert_height_own_ids": partial(height, own_ids=True),
        "c08_insert_height_visit_own_ids": partial(height_at_visit, own_ids=True),
        "c10_insert_bf_no_own_ids": partial(breastfeeding_no, own_ids=True),
        # the other of the two height rules
        "c07b_insert_height_children": partial(height, name="r07_peds_missing_vitals"),
        "c08_insert_height_adults": height_at_last_visit,
    }


def table_queries() -> dict[str, Query]:
    """Queries over record tables, however those were made."""
    return {**_rules(), **_reviews(), **_blocks(), **_scans(), **_corrections(), **_deltas(), **_history(), **_positions()}


@lru_cache(maxsize=8)
def _tables(spark: SparkSession, application: str, sf_dir: str) -> RecordTables:
    """The lazy frames of one folder, analysed once per session; no data is kept."""
    return record_tables(spark, sf_dir)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def over_test_data(query: Query) -> Callable[[SparkSession, str], DataFrame]:
        return lambda spark, sf_dir: query(
            _tables(spark, spark.sparkContext.applicationId, sf_dir)
        )

    return {name: over_test_data(query) for name, query in table_queries().items()}
