"""Declared schemas of the eight record tables.

Dates may arrive as timestamps (``patient_state.start_date`` does in some stores);
the rules cast where they need a day, so only column *names* are enforced by
``require_columns``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

# table -> column -> Spark type
SCHEMAS: dict[str, dict[str, str]] = {
    "patient": {
        "patient_id": "bigint",
        "site_id": "int",
        "voided": "int",
    },
    "person": {
        "person_id": "bigint",
        "site_id": "int",
        "gender": "string",
        "birthdate": "date",
        "birthdate_estimated": "int",
        "dead": "int",
        "death_date": "date",
        "voided": "int",
    },
    "patient_program": {
        "patient_program_id": "bigint",
        "patient_id": "bigint",
        "site_id": "int",
        "program_id": "int",
        "date_enrolled": "date",
        "voided": "int",
    },
    "patient_state": {
        "patient_state_id": "bigint",
        "patient_program_id": "bigint",
        "site_id": "int",
        "state": "int",
        "start_date": "date",
        "end_date": "date",
        "date_created": "date",
        "date_changed": "date",
        "changed_by": "bigint",
        "voided": "int",
    },
    "encounter": {
        "encounter_id": "bigint",
        "patient_id": "bigint",
        "site_id": "int",
        "encounter_type": "int",
        "encounter_datetime": "timestamp_ntz",
        "voided": "int",
        "voided_by": "bigint",
        "date_voided": "date",
        "void_reason": "string",
    },
    "encounter_type": {
        "encounter_type_id": "int",
        "name": "string",
    },
    "obs": {
        "obs_id": "bigint",
        "encounter_id": "bigint",
        "person_id": "bigint",
        "site_id": "int",
        "concept_id": "int",
        "obs_datetime": "timestamp_ntz",
        "value_coded": "int",
        "value_text": "string",
        "value_numeric": "double",
        "value_datetime": "timestamp_ntz",
        "voided": "int",
        "voided_by": "bigint",
        "date_voided": "date",
        "void_reason": "string",
        "date_changed": "date",
        "changed_by": "bigint",
        "creator": "bigint",
        "date_created": "date",
    },
    "concept_name": {
        "concept_id": "int",
        "name": "string",
        "locale": "string",
        "concept_name_type": "string",
    },
}
TABLES: tuple[str, ...] = tuple(SCHEMAS)

# filled in by corrections; no rule reads them
AUDIT_COLUMNS = frozenset(
    "voided_by date_voided void_reason date_changed changed_by creator date_created".split()
)


def require_columns(df: DataFrame, table: str, *, audit: bool = False) -> DataFrame:
    """Fail at once, not in the middle of a job, when a column is missing."""
    wanted = [c for c in SCHEMAS[table] if audit or c not in AUDIT_COLUMNS]
    missing = [c for c in wanted if c not in df.columns]
    if missing:
        raise ValueError(f"table {table} lacks the columns {missing}")
    return df


def ddl(columns: dict[str, str]) -> str:
    return ", ".join(f"{name} {kind}" for name, kind in columns.items())
