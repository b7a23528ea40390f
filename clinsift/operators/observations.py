"""Building blocks over ``obs`` rows (one row per recorded fact)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clinsift.config import DEFAULT, Config
from clinsift.operators.clients import CLIENT, live
from clinsift.operators.joins import client_join, drop_matching, present, skew_join

MEASURES = ("weight", "height_cm", "bmi")


def answered_observations(obs: DataFrame, answered: Column, concepts: Sequence[int]) -> DataFrame:
    """Live observations of the wanted concepts and answers, keyed like ``patient``.

    All tests on ``obs`` come before any join, so they reach the scan and only
    candidate rows are shuffled.
    """
    return (
        obs.where(live() & F.col("concept_id").isin(*concepts) & answered)
        .withColumnRenamed("person_id", "patient_id")
        .drop("voided")
    )


def client_observations(
    obs: DataFrame, clients: DataFrame, answered: Column, concepts: Sequence[int], cfg: Config
) -> DataFrame:
    """Those observations that belong to the given clients, with the clients' columns."""
    facts = answered_observations(obs, answered, concepts)
    return client_join(facts, clients, CLIENT, ["obs_id"], cfg.salts, cfg.hot_share)


def labels(concept_name: DataFrame, cfg: Config = DEFAULT) -> DataFrame:
    """Full English names.  A concept may have several: each gives a row."""
    return concept_name.where(
        (F.col("locale") == cfg.label_locale) & (F.col("concept_name_type") == cfg.label_type)
    ).select("concept_id", "name")


def label_obs(obs: DataFrame, concept_name: DataFrame, cfg: Config = DEFAULT) -> DataFrame:
    """Add ``observation_question`` (required) and ``observation_answer`` (optional).

    Called last, on findings: a name table over the broadcast threshold then costs a
    shuffle of findings only, never of ``obs``.  Few questions and many missing coded
    answers make hot keys, so that shuffle is salted.
    """
    names = labels(concept_name, cfg)
    questions = names.withColumnRenamed("name", "observation_question")
    answers = names.select(
        F.col("concept_id").alias("value_coded"), F.col("name").alias("observation_answer")
    )
    asked = skew_join(obs, questions, ["concept_id"], ["obs_id"], cfg.salts)
    return skew_join(asked, answers, ["value_coded"], ["obs_id"], cfg.salts, how="left")


def measure_pivot(obs: DataFrame, keys: Sequence[str], cfg: Config = DEFAULT) -> DataFrame:
    """Highest live weight, height and BMI per key, one column each.

    ``max`` combines on the map side, so one key with very many measurements sends a
    single row per task.  Rows with a NULL key join nothing and are left out.
    """
    def highest(concept: int, name: str) -> Column:
        return F.max(F.when(F.col("concept_id") == concept, F.col("value_numeric"))).alias(name)

    return (
        present(obs.where(live() & F.col("concept_id").isin(*cfg.measures)), keys)
        .groupBy(*keys)
        .agg(
            highest(cfg.weight, "weight"),
            highest(cfg.height, "height_cm"),
            highest(cfg.bmi, "bmi"),
        )
    )


def latest_per_group(
    df: DataFrame, partition: Sequence[str], order: str, tie_breakers: Sequence[str]
) -> DataFrame:
    """Newest row per group; equal times are decided by the smallest tie-breakers.

    Spark turns the ``= 1`` test into a group limit on both sides of the shuffle, so a
    large group is reduced to one row per task before it is sent.
    """
    newest_first = Window.partitionBy(*partition).orderBy(F.desc(order), *tie_breakers)
    return (
        df.withColumn("row_num", F.row_number().over(newest_first))
        .where("row_num = 1")
        .drop("row_num")
    )


def without_height(clients: DataFrame, obs: DataFrame, cfg: Config = DEFAULT) -> DataFrame:
    """Clients for whom no live height with a value was ever recorded."""
    measured = obs.where(
        live() & (F.col("concept_id") == cfg.height) & F.col("value_numeric").isNotNull()
    ).withColumnRenamed("person_id", "patient_id")
    return drop_matching(clients, measured, on=CLIENT)
