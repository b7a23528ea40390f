"""Client sets: who is in a programme state (building block of nearly every rule)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clinsift.config import DEFAULT, Config
from clinsift.sources.tables import RecordTables

CLIENT = ["patient_id", "site_id"]
PROGRAM = ["patient_program_id", "site_id"]
PERSON_COLUMNS = ("gender", "birthdate", "birthdate_estimated")
PROGRAM_COLUMNS = ("state", "start_date", "end_date", "date_enrolled")


def live() -> Column:
    return F.col("voided") == 0


def persons(t: RecordTables) -> DataFrame:
    """``person`` keyed like ``patient``; its own ``voided`` is not looked at."""
    return t.person.select(F.col("person_id").alias("patient_id"), "site_id", *PERSON_COLUMNS)


def cohort(
    t: RecordTables,
    cfg: Config = DEFAULT,
    *,
    state: int,
    columns: Sequence[str] = (),
    gender: str | None = None,
    require_start: bool = False,
    with_person: bool = True,
) -> DataFrame:
    """Distinct clients with an open, live ``state`` in the HIV programme.

    Returns ``patient_id, site_id`` and ``columns``, which come from ``person``
    (gender, birthdate, birthdate_estimated) or from the programme and its state
    (state, start_date, end_date, date_enrolled).
    """
    clients = t.clients.get(state) if with_person else None
    if clients is None:
        clients = _enrolled(t, cfg, state, columns, require_start)
        if with_person:
            clients = clients.join(persons(t), on=CLIENT)
    elif require_start:
        clients = clients.where(F.col("start_date").isNotNull())
    if gender is not None:
        clients = clients.where(F.col("gender") == gender)
    return clients.select(*CLIENT, *columns).distinct()


def _enrolled(
    t: RecordTables, cfg: Config, state: int, columns: Sequence[str], require_start: bool
) -> DataFrame:
    """Open programme states of live patients, one row per distinct combination.

    The ``distinct`` comes before the client tables are joined: a client with very many
    state rows is reduced on the map side and cannot crowd one task of those joins.  The
    first join has exchanges on both sides and another one after it, so adaptive
    execution can cut a programme number with very many states.
    """
    states = t.patient_state.where(live() & (F.col("state") == state) & F.col("end_date").isNull())
    if require_start:
        states = states.where(F.col("start_date").isNotNull())
    programs = t.patient_program.where(live() & (F.col("program_id") == cfg.hiv_program))
    patients = t.patient.where(live())
    kept = [c for c in columns if c in PROGRAM_COLUMNS]
    return (
        states.select(*PROGRAM, "state", "start_date", "end_date")
        .join(programs.select(*PROGRAM, "patient_id", "date_enrolled"), on=PROGRAM)
        .select(*CLIENT, *kept)
        .distinct()
        .join(patients.select(*CLIENT), on=CLIENT, how="left_semi")
    )


def prepare_clients(t: RecordTables, cfg: Config, state: int) -> DataFrame:
    """All columns any rule asks ``cohort`` for, to be staged once for many rules."""
    return cohort(t, cfg, state=state, columns=[*PERSON_COLUMNS, *PROGRAM_COLUMNS])
