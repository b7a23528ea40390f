"""Rules over pregnancy and breastfeeding observations: 4, 5, 9 and 10."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clinsift import texts
from clinsift.functions import age_years, answer_source, fill, has_answer
from clinsift.operators.clients import CLIENT, cohort
from clinsift.operators.joins import within_days
from clinsift.operators.observations import (
    answered_observations,
    client_observations,
    label_obs,
    latest_per_group,
)
from clinsift.plans.rules.common import BY_PATIENT, BY_SITE_AND_PATIENT, RuleContext, finding
from clinsift.sources.tables import RecordTables



def _answer_text() -> Column:
    return F.col("value_text").alias("obs_answer_text")


def _source(ctx: RuleContext) -> Column:
    return answer_source(F.col("value_coded"), F.col("value_text"), ctx.cfg).alias("answer_source")


def male_pregnancy(t: RecordTables, ctx: RuleContext) -> DataFrame:
    """Rule 4: pregnancy or breastfeeding answered "yes" for male clients.

    The central variant reports days, so equal answers of one day fall together.
    """
    men = cohort(t, ctx.cfg, state=ctx.cfg.state_on_art, gender="M")
    found = client_observations(
        t.obs, men, has_answer(cfg=ctx.cfg), ctx.cfg.maternal_questions, ctx.cfg
    )
    named = label_obs(found, t.concept_name, ctx.cfg)
    answer = ["value_coded", "observation_answer", _answer_text(), _source(ctx)]
    question = ["patient_id", "site_id", "concept_id", "observation_question"]
    if ctx.central:
        day = F.to_date("obs_datetime")
        flag = fill(texts.MALE_OBSERVATION, question=F.col("observation_question"), day=day)
        out = named.select(
            *question,
            day.alias("obs_date"),
            *answer,
            *finding(flag, texts.ATEMPORAL, texts.HIGH),
        )
    else:
        out = named.select(*question, "obs_datetime", *answer)
    return ctx.sort(out.distinct(), BY_PATIENT, BY_SITE_AND_PATIENT)


def female_age_range(t: RecordTables, ctx: RuleContext) -> DataFrame:
    """Rule 5: pregnancy or breastfeeding observations outside reproductive age."""
    women = cohort(
        t, ctx.cfg, state=ctx.cfg.state_on_art, gender="F", columns=["birthdate"]
    )
    youngest, oldest = ctx.cfg.reproductive_age
    unknown = F.col("birthdate").isNull()
    age = F.col("age_at_observation")
    found = (
        client_observations(
            t.obs,
            women,
            has_answer(datetime=True, numeric=True, cfg=ctx.cfg),
            ctx.cfg.maternal_questions,
            ctx.cfg,
        )
        .withColumn("age_at_observation", age_years(F.col("birthdate"), F.col("obs_datetime")))
        .where(unknown | ~age.between(youngest, oldest))
    )
    named = label_obs(found, t.concept_name, ctx.cfg)
    first = [
        "patient_id", "site_id", "birthdate", "age_at_observation",
        "concept_id", "observation_question",
    ]
    if ctx.central:
        flag = (
            F.when(unknown, texts.CEN_AGE_UNKNOWN)
            .when(age < youngest, fill(texts.CEN_AGE_BELOW, age=age))
            .when(age > oldest, fill(texts.CEN_AGE_ABOVE, age=age))
        )
        level = F.when(unknown, texts.MEDIUM).otherwise(texts.HIGH)
        out = named.select(
            *first,
            F.to_date("obs_datetime").alias("obs_date"),
            "value_coded",
            "observation_answer",
            _answer_text(),
            *finding(flag, texts.ATEMPORAL, level),
        )
    else:
        issue = F.when(unknown, texts.DET_BIRTHDATE_MISSING).otherwise(texts.DET_AGE_OUTSIDE)
        out = named.select(
            *first,
            "obs_datetime",
            "value_coded",
            "value_datetime",
            "value_numeric",
            "observation_answer",
            _answer_text(),
            issue.alias("issue"),
        )
    return ctx.sort(out.distinct(), BY_PATIENT, BY_SITE_AND_PATIENT)


def pregnant_at_treatment_start(t: RecordTables, ctx: RuleContext) -> DataFrame:
    """Rule 9: pregnancy observations around the start of treatment.

    Detection asks for a start date, counts numeric answers and reports distinct rows;
    the central variant keeps clients without a start date and every observation.
    """
    women = cohort(
        t,
        ctx.cfg,
        state=ctx.cfg.state_on_art,
        gender="F",
        columns=["start_date"],
        require_start=not ctx.central,
    )
    answered = has_answer(datetime=True, numeric=not ctx.central, cfg=ctx.cfg)
    day, start = F.to_date("obs_datetime"), F.to_date("start_date")
    found = within_days(
        answered_observations(t.obs, answered, ctx.cfg.pregnancy_questions),
        women,
        CLIENT,
        "obs_datetime",
        "start_date",
        ctx.cfg.pregnancy_window_days,
        spread_by=["obs_id"],
        salts=ctx.cfg.salts,
        undated=ctx.central,
    )
    named = label_obs(found, t.concept_name, ctx.cfg)

    first = [
        "patient_id", "site_id", start.alias("art_start_date"), "concept_id",
        "observation_question",
    ]
    if not ctx.central:
        out = named.select(
            *first,
            F.col("obs_datetime").alias("obs_date"),
            "value_coded",
            "observation_answer",
            _answer_text(),
            "value_datetime",
            F.lit(texts.DET_PREGNANT_AT_START).alias("issue"),
        ).distinct()
        return ctx.sort(out, BY_PATIENT, BY_SITE_AND_PATIENT)

    days = F.datediff(day, start)
    side = F.when(days < 0, texts.BEFORE).otherwise(texts.AFTER)
    flag = F.when(start.isNull(), texts.CEN_PREGNANT_START_NULL).otherwise(
        fill(texts.CEN_PREGNANT_AT_START, days=F.abs(days), side=side, start=start)
    )
    out = named.select(
        *first,
        day.alias("obs_date"),
        "value_coded",
        "observation_answer",
        _answer_text(),
        _source(ctx),
        days.alias("days_from_art_start"),
        *finding(
            flag, texts.ATEMPORAL, F.when(start.isNull(), texts.MEDIUM).otherwise(texts.LOW)
        ),
    )
    return ctx.sort(out, BY_PATIENT, BY_SITE_AND_PATIENT)


def breastfeeding(t: RecordTables, ctx: RuleContext) -> DataFrame:
    """Rule 10: the latest "yes" to breastfeeding, to be verified after two years.

    Only "yes" answers are ranked, so a later "no" does not clear the finding.  As
    written the groups leave the site out: one row survives per client number and
    question over all sites, unless ``site_safe``.
    """
    women = cohort(
        t,
        ctx.cfg,
        state=ctx.cfg.state_on_art,
        gender="F",
        require_start=not ctx.central,
    )
    answers = client_observations(
        t.obs,
        women,
        has_answer(cfg=ctx.cfg),
        ctx.cfg.breastfeeding_questions[ctx.variant],
        ctx.cfg,
    )
    group = ["patient_id", "concept_id"] + (["site_id"] if ctx.site_safe else [])
    latest = latest_per_group(answers, group, "obs_datetime", ["site_id", "obs_id"])
    named = label_obs(latest, t.concept_name, ctx.cfg)

    day = F.to_date("obs_datetime")
    days = F.datediff(ctx.today, day)
    old = days > ctx.cfg.breastfeeding_limit_days
    latest_day = day.alias("latest_obs_date")
    if ctx.central:
        flag = F.when(old, fill(texts.CEN_BREASTFEEDING_OLD, days=days)).otherwise(
            fill(texts.CEN_BREASTFEEDING, day=day)
        )
        out = named.select(
            "patient_id", "site_id", "concept_id", "observation_question", latest_day,
            "value_coded", "observation_answer", _answer_text(), _source(ctx),
            days.alias("days_since_obs"),
            *finding(flag, texts.TEMPORAL, F.when(old, texts.HIGH).otherwise(texts.LOW)),
        )
    else:
        issue = F.when(old, texts.DET_BREASTFEEDING_OLD).otherwise(texts.DET_BREASTFEEDING)
        out = named.select(
            "patient_id", "site_id", "observation_question", latest_day, "value_coded",
            "observation_answer", F.col("value_text").alias("obs_anser_text"),
            days.alias("days_since_obs"), issue.alias("issue"),
        )
    return ctx.sort(out, BY_PATIENT, BY_SITE_AND_PATIENT)
