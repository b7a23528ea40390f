"""Data-quality rules and corrections for multi-site medical records, on Spark."""

from clinsift.config import CENTRAL, DETECTION, Config
from clinsift.plans import RULES, corrections, prepare, reviews, run_all, run_rule
from clinsift.sources import RecordTables, read_catalog, read_parquet, write_version

__all__ = [
    "CENTRAL",
    "DETECTION",
    "RULES",
    "Config",
    "RecordTables",
    "corrections",
    "prepare",
    "read_catalog",
    "read_parquet",
    "reviews",
    "run_all",
    "run_rule",
    "write_version",
]
