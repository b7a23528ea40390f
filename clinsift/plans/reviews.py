"""Queries a facility runs before it corrects anything."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clinsift.config import DEFAULT, Config
from clinsift.operators.clients import CLIENT, PROGRAM, cohort, live, persons
from clinsift.operators.joins import drop_matching, keep_matching, skew_join
from clinsift.sources.tables import RecordTables


def birth_and_treatment(t: RecordTables, cfg: Config = DEFAULT) -> DataFrame:
    """Before correcting rule 3: the clients and how far the two dates are apart.

    Any programme and closed states count here, and every state row is shown.
    """
    start = F.to_date("start_date")
    states = t.patient_state.where(
        live() & (F.col("state") == cfg.state_on_art) & F.col("start_date").isNotNull()
    ).select("patient_state_id", *PROGRAM, "start_date")
    programs = t.patient_program.where(live()).select(*PROGRAM, "patient_id")
    people = persons(t).select(*CLIENT, "birthdate").where(F.col("birthdate").isNotNull())
    patients = t.patient.where(live()).select(*CLIENT)
    rows = skew_join(states, programs, PROGRAM, spread_by=["patient_state_id"], salts=cfg.salts)
    found = skew_join(
        rows,
        people.join(patients, on=CLIENT),
        CLIENT,
        spread_by=["patient_state_id"],
        salts=cfg.salts,
    ).where(F.col("birthdate") > start)
    return found.select(
        "patient_id",
        "birthdate",
        start.alias("art_start_date"),
        F.datediff(start, F.col("birthdate")).alias("days_difference"),
    )


def treatment_states(
    t: RecordTables, review: DataFrame, cfg: Config = DEFAULT
) -> DataFrame:
    """Before correcting rule 6: all live treatment states of the clients under review.

    ``review`` holds ``patient_id``; as written the site is not part of the choice, so
    clients of that number at every site are shown.
    """
    patients = keep_matching(t.patient.select(*CLIENT), review, ["patient_id"])
    programs = patients.join(t.patient_program.select(*PROGRAM, "patient_id"), on=CLIENT)
    states = t.patient_state.where(live() & (F.col("state") == cfg.state_on_art)).select(
        "patient_state_id", *PROGRAM, "start_date", "date_created", "date_changed"
    )
    rows = skew_join(states, programs, PROGRAM, spread_by=["patient_state_id"], salts=cfg.salts)
    return rows.select(
        "patient_program_id",
        "patient_state_id",
        "patient_id",
        "site_id",
        F.to_date("start_date").alias("current_wrong_start_date"),
        "date_created",
        "date_changed",
    )


def not_in_pmtct(t: RecordTables, cfg: Config = DEFAULT) -> DataFrame:
    """After rule 9: women on treatment without a live enrolment in ``cfg.pmtct_program``.

    No pregnancy test is part of it.  The two programme columns are always NULL.
    """
    if cfg.pmtct_program is None:
        raise ValueError("set Config.pmtct_program: its number differs between installations")
    women = cohort(
        t,
        cfg,
        state=cfg.state_on_art,
        gender="F",
        columns=["start_date"],
        require_start=True,
    )
    enrolled = t.patient_program.where(live() & (F.col("program_id") == cfg.pmtct_program))
    return drop_matching(women, enrolled, CLIENT).select(
        "patient_id",
        "site_id",
        F.to_date("start_date").alias("art_start_date"),
        F.lit(None).cast("int").alias("pmtct_program_id"),
        F.lit(None).cast("date").alias("pmtct_enrolment_date"),
    )
