"""The eight record tables as one value that rules and corrections take."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field, replace

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

from clinsift.config import Config
from clinsift.sources.schemas import AUDIT_COLUMNS, SCHEMAS, TABLES, ddl, require_columns
from clinsift.sources.sinks import drop_staged_table, remove_folder


@dataclass(frozen=True)
class Prepared:
    """What shared inputs were made for: they hold nothing for other rules or settings.

    ``concepts``: of the observations kept; None if ``obs`` is the whole table.
    """

    cfg: Config
    folder: str
    concepts: tuple[int, ...] | None
    tables: tuple[str, ...] = ()  # catalogue names of staged bucketed tables

    def check(self, rule: str, cfg: Config, concepts: Sequence[int]) -> None:
        """Stop a rule that would find less than over the tables themselves."""
        if replace(cfg, salts=self.cfg.salts, hot_share=self.cfg.hot_share) != self.cfg:
            raise ValueError(f"{rule}: the inputs were prepared with other settings")
        lacking = set(concepts) - set(self.concepts if self.concepts is not None else concepts)
        if lacking:
            raise ValueError(f"{rule}: the inputs were prepared without the concepts {sorted(lacking)}")


@dataclass(frozen=True)
class RecordTables:
    """Record tables of many sites; ids are unique within a site only."""

    patient: DataFrame
    person: DataFrame
    patient_program: DataFrame
    patient_state: DataFrame
    encounter: DataFrame
    encounter_type: DataFrame
    obs: DataFrame
    concept_name: DataFrame
    # filled by plans.run.prepare: state -> prepared client frame, and what it was made for
    clients: Mapping[int, DataFrame] = field(default_factory=dict)
    prepared: Prepared | None = None

    def __post_init__(self) -> None:
        for table in TABLES:
            require_columns(getattr(self, table), table)

    def with_table(self, table: str, df: DataFrame) -> RecordTables:
        """The same tables with a new version of one of them.

        Prepared client frames are dropped: they came from the old version.  Prepared
        observations stay as long as ``obs`` itself is not replaced.
        """
        prepared = None if table == "obs" else self.prepared
        return replace(self, **{table: df}, clients={}, prepared=prepared)

    def drop_prepared(self) -> None:
        """Remove the folder that ``prepare`` wrote; these tables cannot be read after that."""
        if self.prepared is not None:
            spark = self.patient.sparkSession
            for table in self.prepared.tables:
                drop_staged_table(spark, table)
            remove_folder(spark, self.prepared.folder)


def _stored_columns(spark: SparkSession, path: str) -> set[str] | None:
    """Column names in lower case; None for a folder without a file, an empty table."""
    try:
        return {c.lower() for c in spark.read.parquet(path).columns}
    except AnalysisException as e:
        if e.getCondition() == "UNABLE_TO_INFER_SCHEMA":
            return None
        raise


def read_parquet(
    spark: SparkSession, path: str, columns: Mapping[str, Mapping[str, str]] | None = None
) -> RecordTables:
    """Read ``<path>/<table>.parquet`` (file or folder) with declared schemas.

    ``columns`` (table -> column -> type) adds site-specific columns, which
    corrections then carry along, or states other types.

    A column that the files lack would be read as NULL, so the names are checked first:
    the stored schema (one footer and the folder names of a table, as Spark takes it; no data
    are read) must have every declared column.  Audit columns may be missing; corrections
    that write them ask for them.
    """
    extra = columns or {}
    found = {}
    for t in TABLES:
        file = f"{path}/{t}.parquet"
        wanted = {**SCHEMAS[t], **extra.get(t, {})}
        stored = _stored_columns(spark, file)
        missing = [c for c in wanted if stored is not None and c.lower() not in stored]
        if lacking := [c for c in missing if c not in AUDIT_COLUMNS or c in extra.get(t, {})]:
            raise ValueError(f"table {t} in {file} lacks the columns {lacking}")
        kept = {c: kind for c, kind in wanted.items() if c not in missing}
        found[t] = spark.read.schema(ddl(kept)).parquet(file)
    return RecordTables(**found)


def read_catalog(spark: SparkSession, database: str | None = None) -> RecordTables:
    """Read the eight tables of a catalogue database, or of the current one and its views."""
    prefix = f"{database}." if database else ""
    return RecordTables(**{t: spark.table(f"{prefix}{t}") for t in TABLES})
