"""Rules that look at client, programme and state rows only: 1, 3, 6 and 8."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clinsift import texts
from clinsift.functions import age_years, fill
from clinsift.operators.clients import cohort
from clinsift.operators.observations import without_height
from clinsift.plans.rules.common import BY_PATIENT, BY_SITE_AND_PATIENT, RuleContext, finding
from clinsift.sources.tables import RecordTables


def gender(t: RecordTables, ctx: RuleContext) -> DataFrame:
    """Rule 1: gender missing or not one of the accepted values (compared exactly)."""
    value = F.col("gender")
    strange = ~value.isin(*ctx.cfg.valid_genders[ctx.variant])
    found = cohort(t, ctx.cfg, state=ctx.cfg.state_on_art, columns=["gender"]).where(
        value.isNull() | strange
    )
    if ctx.central:
        flag = F.when(value.isNull(), texts.GENDER_NULL).when(
            strange, fill(texts.GENDER_NON_STANDARD, gender=value)
        )
        out = found.select(
            "patient_id", "site_id", "gender",
            *finding(flag, texts.VALUE_CONFORMANCE, texts.HIGH),
        )
    else:
        out = found.select("patient_id", "gender", "site_id")
    return ctx.sort(out, BY_PATIENT, BY_SITE_AND_PATIENT)


def treatment_before_birth(t: RecordTables, ctx: RuleContext) -> DataFrame:
    """Rule 3: treatment started before birth, or one of the two dates is missing."""
    birth, start = F.col("birthdate"), F.to_date("start_date")
    unknown = birth.isNull() | start.isNull()
    clients = cohort(
        t,
        ctx.cfg,
        state=ctx.cfg.state_on_art,
        columns=["birthdate", "birthdate_estimated", "start_date"],
    ).where(unknown | (birth > start))

    days = F.datediff(birth, start)
    shown = [
        F.col("patient_id"), F.col("site_id"), birth.alias("date_of_birth"),
        F.col("birthdate_estimated"), start.alias("art_start_date"),
    ]
    if ctx.central:
        flag = (
            F.when(birth.isNull(), texts.CEN_BIRTHDATE_NULL)
            .when(start.isNull(), texts.CEN_START_NULL)
            .when(birth > start, fill(texts.CEN_START_BEFORE_BIRTH, days=days))
        )
        level = F.when(unknown, texts.MEDIUM).otherwise(texts.HIGH)
        shown += [days.alias("days_before_birth"), *finding(flag, texts.TEMPORAL, level)]
    else:
        issue = (
            F.when(birth.isNull(), texts.DET_BIRTHDATE_MISSING)
            .when(start.isNull(), texts.DET_START_MISSING)
            .when(birth > start, texts.DET_START_BEFORE_BIRTH)
        )
        shown.append(issue.alias("issue"))
    return ctx.sort(_days_distinct(t, clients.select(*shown)), BY_PATIENT, BY_SITE_AND_PATIENT)


def treatment_date_implausible(t: RecordTables, ctx: RuleContext) -> DataFrame:
    """Rule 6: treatment date missing, before the first treatments, or in the future.

    The central variant does not ask for a person row.
    """
    start = F.to_date("start_date")
    early, future = start < F.lit(ctx.cfg.earliest_art), start > ctx.today
    clients = cohort(
        t,
        ctx.cfg,
        state=ctx.cfg.state_on_art,
        columns=["start_date"],
        with_person=not ctx.central,
    ).where(start.isNull() | early | future)

    def describe(missing: str, too_early: Column | str, too_late: Column | str) -> Column:
        return F.when(start.isNull(), missing).when(early, too_early).when(future, too_late)

    shown = [F.col("patient_id"), F.col("site_id"), start.alias("art_start_date")]
    if ctx.central:
        flag = describe(
            texts.CEN_START_IS_NULL,
            fill(texts.CEN_START_EARLY, start=start),
            fill(texts.CEN_START_FUTURE, start=start),
        )
        shown += finding(flag, texts.TEMPORAL, texts.HIGH)
    else:
        issue = describe(texts.DET_START_MISSING, texts.DET_START_EARLY, texts.DET_START_FUTURE)
        shown.append(issue.alias("issue"))
    return ctx.sort(_days_distinct(t, clients.select(*shown)), BY_PATIENT, BY_SITE_AND_PATIENT)


def adult_without_height(t: RecordTables, ctx: RuleContext) -> DataFrame:
    """Rule 8: adults, now and at enrolment, whose height was never recorded."""
    adult = ctx.cfg.adult_age
    clients = (
        cohort(
            t, ctx.cfg, state=ctx.cfg.state_on_art, columns=["birthdate", "date_enrolled"]
        )
        .withColumn("current_age", age_years(F.col("birthdate"), ctx.today))
        .withColumn("age_at_enrolment", age_years(F.col("birthdate"), F.col("date_enrolled")))
        .where(
            F.col("birthdate").isNull()
            | ((F.col("current_age") >= adult) & (F.col("age_at_enrolment") >= adult))
        )
    )
    found = without_height(clients, t.obs, ctx.cfg)

    unknown = F.col("birthdate").isNull()
    too_old = F.col("current_age") > ctx.cfg.oldest_plausible_age
    shown = [
        "patient_id", "site_id", F.col("birthdate").alias("date_of_birth"),
        "current_age", "age_at_enrolment",
    ]
    if ctx.central:
        flag = (
            F.when(unknown, texts.CEN_NO_HEIGHT_AGE_UNKNOWN)
            .when(too_old, fill(texts.CEN_NO_HEIGHT_OLD, age=F.col("current_age")))
            .otherwise(fill(texts.CEN_NO_HEIGHT, enrolled=F.col("date_enrolled")))
        )
        shown += [
            F.col("date_enrolled").alias("program_enrolment_date"),
            *finding(flag, texts.COMPLETENESS, texts.MEDIUM),
        ]
    else:
        issue = (
            F.when(unknown, texts.DET_NO_HEIGHT_AGE_UNKNOWN)
            .when(too_old, texts.DET_NO_HEIGHT_OLD)
            .otherwise(texts.DET_NO_HEIGHT)
        )
        shown.append(issue.alias("issue"))
    return ctx.sort(found.select(*shown), BY_PATIENT, BY_SITE_AND_PATIENT)


def _days_distinct(t: RecordTables, found: DataFrame) -> DataFrame:
    """Start *times* become days in the output: only then can rows fall together."""
    if dict(t.patient_state.dtypes)["start_date"] == "date":
        return found
    return found.distinct()
