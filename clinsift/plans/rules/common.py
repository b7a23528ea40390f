"""What the ten rules share: signature, trailing finding columns, output order."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clinsift.config import CENTRAL, DEFAULT, DETECTION, Config, Variant, check_variant
from clinsift.functions import as_of_column


@dataclass(frozen=True)
class RuleContext:
    """Settings of one rule run.

    variant    ``detection`` (site-side query) or ``central`` (repository query with
               flag text, category and severity)
    as_of      the day taken as today; None means the current date
    site_safe  where a rule as written leaves the site out of a key, add it
    ordered    sort the result for presentation; leave off when writing tables
    """

    cfg: Config = DEFAULT
    variant: Variant = CENTRAL
    as_of: date | None = None
    site_safe: bool = False
    ordered: bool = False

    def __post_init__(self) -> None:
        check_variant(self.variant)

    @property
    def central(self) -> bool:
        return self.variant == CENTRAL

    @property
    def today(self) -> Column:
        return as_of_column(self.as_of)

    def sort(self, df: DataFrame, detection: Sequence[str], central: Sequence[str]) -> DataFrame:
        if not self.ordered:
            return df
        return df.orderBy(*(central if self.central else detection))


def finding(flag: Column, category: str, severity: Column | str) -> list[Column]:
    """The three trailing columns of every central rule."""
    level = F.lit(severity) if isinstance(severity, str) else severity
    return [
        flag.alias("DQ_flag"),
        F.lit(category).alias("kahn_category"),
        level.alias("severity"),
    ]


BY_PATIENT = ["patient_id"]
BY_SITE_AND_PATIENT = ["site_id", "patient_id"]

__all__ = [
    "BY_PATIENT",
    "BY_SITE_AND_PATIENT",
    "CENTRAL",
    "DETECTION",
    "RuleContext",
    "finding",
]
