"""Rules over visits: 2 and 7."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clinsift import texts
from clinsift.functions import age_years, fill
from clinsift.operators.clients import CLIENT, cohort, live
from clinsift.operators.joins import client_join, skew_join
from clinsift.operators.observations import measure_pivot
from clinsift.plans.rules.common import BY_PATIENT, BY_SITE_AND_PATIENT, RuleContext, finding
from clinsift.sources.tables import RecordTables

VISIT = ["encounter_id", "site_id", "patient_id", "encounter_datetime"]


def visit_after_death(t: RecordTables, ctx: RuleContext) -> DataFrame:
    """Rule 2: visits later than the start of the open "died" state.

    The start day counts as its midnight, so a visit on that day is reported.  As
    written the detection variant matches clients by id alone: visits of other sites
    to a client of the same number count too, unless ``site_safe``.
    """
    dead = cohort(
        t, ctx.cfg, state=ctx.cfg.state_died, columns=["state", "start_date", "end_date"]
    )
    visits = t.encounter.where(live()).select(*VISIT, "encounter_type")
    if ctx.central or ctx.site_safe:
        matched = client_join(visits, dead, CLIENT, ["encounter_id"], ctx.cfg.salts, ctx.cfg.hot_share)
    else:
        visits = visits.drop("site_id")
        matched = client_join(visits, dead, ["patient_id"], ["encounter_id"], ctx.cfg.salts, ctx.cfg.hot_share)
    late = matched.where(F.col("encounter_datetime") > F.col("start_date"))
    # type names last: only findings meet the name table
    types = t.encounter_type.select(
        F.col("encounter_type_id").alias("encounter_type"), F.col("name").alias("type_name")
    )
    named = skew_join(late, types, ["encounter_type"], ["encounter_id"], ctx.cfg.salts).drop(
        "encounter_type"
    )

    if not ctx.central:
        out = named.select(
            "patient_id", "state", "start_date", "end_date", "encounter_datetime",
            F.col("type_name").alias("encounter_type"), "site_id",
        )
        return ctx.sort(out, BY_PATIENT, BY_SITE_AND_PATIENT)

    day = F.to_date("encounter_datetime")
    days = F.datediff(day, F.col("start_date"))
    flag = fill(texts.VISIT_AFTER_DEATH, days=days, death=F.col("start_date"))
    out = named.select(
        "patient_id",
        "site_id",
        F.col("start_date").alias("death_start_date"),
        "encounter_id",
        day.alias("encounter_date"),
        F.col("type_name").alias("encounter_type"),
        days.alias("days_after_death"),
        *finding(flag, texts.TEMPORAL, texts.HIGH),
    ).distinct()
    return ctx.sort(out, BY_PATIENT, [*BY_SITE_AND_PATIENT, "encounter_date"])


def child_missing_measures(t: RecordTables, ctx: RuleContext) -> DataFrame:
    """Rule 7: visits of children at which weight, height or BMI is missing.

    Measurements are reduced to one row per visit before they meet the visits.  As
    written the central variant finds them by visit number alone, so a measurement of
    another site can hide a gap; detection and ``site_safe`` add the site.
    """
    clients = cohort(t, ctx.cfg, state=ctx.cfg.state_on_art, columns=["birthdate"])
    age = age_years(F.col("birthdate"), F.col("encounter_datetime"))
    visits = (
        client_join(
            t.encounter.where(live()).select(*VISIT),
            clients,
            CLIENT,
            ["encounter_id"],
            ctx.cfg.salts,
            ctx.cfg.hot_share,
        )
        .where(F.col("birthdate").isNull() | (age < ctx.cfg.adult_age))
    )
    by_visit = ["encounter_id"]
    if ctx.site_safe or not ctx.central:
        by_visit = ["encounter_id", "site_id"]
    weight, height, bmi = (F.col(c).isNull() for c in ("weight", "height_cm", "bmi"))
    # equal rows go after the join: their key contains the join's, so they need no exchange
    found = (
        visits.join(measure_pivot(t.obs, by_visit, ctx.cfg), on=by_visit, how="left")
        .where(weight | height | bmi)
        .distinct()
    )
    found = ctx.sort(
        found,
        ["patient_id", "encounter_datetime"],
        [*BY_SITE_AND_PATIENT, "encounter_datetime"],
    )

    def describe(everything: str, both: str, no_weight: str, no_height: str, no_bmi: str) -> Column:
        return (
            F.when(weight & height & bmi, everything)
            .when(weight & height, both)
            .when(weight, no_weight)
            .when(height, no_height)
            .when(bmi, no_bmi)
        )

    measures = [age.alias("age_at_visit"), "weight", "height_cm", "bmi"]
    if ctx.central:
        flag = describe(
            texts.CEN_ALL_MISSING,
            texts.CEN_WEIGHT_HEIGHT_MISSING,
            texts.CEN_WEIGHT_MISSING,
            texts.CEN_HEIGHT_MISSING,
            texts.CEN_BMI_MISSING,
        )
        return found.select(
            "patient_id",
            "site_id",
            "encounter_id",
            F.to_date("encounter_datetime").alias("visit_date"),
            "birthdate",
            *measures,
            *finding(flag, texts.COMPLETENESS, texts.HIGH),
        )
    issue = describe(
        texts.DET_ALL_MISSING,
        texts.DET_WEIGHT_HEIGHT_MISSING,
        texts.DET_WEIGHT_MISSING,
        texts.DET_HEIGHT_MISSING,
        texts.DET_BMI_MISSING,
    )
    return found.select(
        "patient_id",
        "site_id",
        "encounter_id",
        F.col("encounter_datetime").alias("visit_date"),
        F.col("birthdate").alias("date_of_birth"),
        *measures,
        issue.alias("issue"),
    )
