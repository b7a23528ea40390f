from clinsift.sources.schemas import SCHEMAS, TABLES, require_columns
from clinsift.sources.sinks import (
    remove_folder,
    replace_partitions,
    stage,
    stage_dir,
    stage_folder,
    write_version,
)
from clinsift.sources.tables import Prepared, RecordTables, read_catalog, read_parquet

__all__ = [
    "SCHEMAS",
    "TABLES",
    "Prepared",
    "RecordTables",
    "read_catalog",
    "read_parquet",
    "remove_folder",
    "replace_partitions",
    "require_columns",
    "stage",
    "stage_dir",
    "stage_folder",
    "write_version",
]
