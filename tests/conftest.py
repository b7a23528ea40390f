from __future__ import annotations

import os
import sys
from datetime import date, datetime

import pyarrow as pa
import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession

from clinsift import Config, RecordTables
from clinsift.sources.schemas import SCHEMAS, ddl

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[8]")
        .appName("clinsift-tests")
        .config("spark.driver.memory", "6g")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def cfg():
    return Config(pmtct_program=3)


LABELS = [
    (6131, "Patient pregnant"),
    (7965, "Breastfeeding"),
    (1755, "Is patient pregnant"),
    (5632, "Is breast feeding"),
    (5090, "Height"),
    (1065, "Yes"),
    (1066, "No"),
]


ARROW = {
    "bigint": pa.int64(),
    "int": pa.int32(),
    "string": pa.string(),
    "double": pa.float64(),
    "date": pa.date32(),
    "timestamp_ntz": pa.timestamp("us"),
}


def frame(spark, table: str, rows: list[dict]):
    """Rows of one table; columns not given are NULL, ``voided`` is 0."""
    columns = {
        c: pa.array([r.get(c, 0 if c == "voided" else None) for r in rows], ARROW[kind])
        for c, kind in SCHEMAS[table].items()
    }
    return spark.createDataFrame(pa.table(columns), ddl(SCHEMAS[table]))


class Clinic:
    """A few hand-made records; ``client`` adds one person on treatment."""

    def __init__(self, spark):
        self.spark = spark
        self.rows: dict[str, list[dict]] = {table: [] for table in SCHEMAS}
        self.rows["encounter_type"] = [{"encounter_type_id": 1, "name": "VISIT"}]
        self.rows["concept_name"] = [
            {"concept_id": c, "name": n, "locale": "en", "concept_name_type": "FULLY_SPECIFIED"}
            for c, n in LABELS
        ]
        self._next = 0

    def add(self, table: str, **row) -> dict:
        self.rows[table].append(row)
        return row

    def client(self, number: int, site: int = 1, **given) -> None:
        get = given.get
        person = {"person_id": number, "site_id": site}
        for column in ("gender", "birthdate", "birthdate_estimated"):
            person[column] = get(column)
        person["voided"] = get("person_voided", 0)
        self.add("person", **person)
        self.add("patient", patient_id=number, site_id=site, voided=get("patient_voided", 0))
        self.add(
            "patient_program",
            patient_program_id=number * 10,
            patient_id=number,
            site_id=site,
            program_id=get("program_id", 1),
            date_enrolled=get("date_enrolled"),
            voided=get("program_voided", 0),
        )
        self.state(number, site, **given)

    def state(self, number: int, site: int = 1, **given) -> None:
        self._next += 1
        self.add(
            "patient_state",
            patient_state_id=self._next,
            patient_program_id=number * 10,
            site_id=site,
            state=given.get("state", 7),
            start_date=given.get("start_date"),
            end_date=given.get("end_date"),
            voided=given.get("state_voided", 0),
        )

    def visit(self, encounter: int, number: int, at: datetime, site: int = 1, **given) -> None:
        self.add(
            "encounter",
            encounter_id=encounter,
            patient_id=number,
            site_id=site,
            encounter_datetime=at,
            **{"encounter_type": 1, **given},
        )

    def obs(self, number: int, concept: int, at: datetime | None, site: int = 1, **given) -> None:
        self._next += 1
        given.setdefault("obs_id", self._next)
        self.add(
            "obs", person_id=number, site_id=site, concept_id=concept, obs_datetime=at, **given
        )

    def tables(self) -> RecordTables:
        return RecordTables(**{t: frame(self.spark, t, r) for t, r in self.rows.items()})


@pytest.fixture
def clinic(spark):
    return Clinic(spark)


AS_OF = date(2020, 6, 30)


def values(df, *columns) -> list:
    """Sorted rows of the chosen columns (bare values for a single one)."""
    rows = [tuple(r) for r in df.select(*columns).collect()]
    if len(columns) == 1:
        rows = [r[0] for r in rows]
    return sorted(rows, key=lambda r: str(r))
