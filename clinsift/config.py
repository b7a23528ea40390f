"""Domain settings shared by every rule and correction."""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import date
from typing import Literal

Variant = Literal["detection", "central"]
DETECTION: Variant = "detection"
CENTRAL: Variant = "central"


def check_variant(variant: str) -> Variant:
    if variant not in (DETECTION, CENTRAL):
        raise ValueError(f"variant must be 'detection' or 'central', not {variant!r}")
    return variant


@dataclass(frozen=True)
class Config:
    """Codes and limits of the HIV programme's data-quality rules.

    The defaults are fixed values: results depend on them.  ``salts`` and ``hot_share`` are the
    only execution settings; they never change a result (see ``operators.joins``).
    """

    hiv_program: int = 1
    pmtct_program: int | None = None
    state_on_art: int = 7
    state_died: int = 3

    valid_genders: dict[str, tuple[str, ...]] = field(
        default_factory=lambda: {DETECTION: ("M", "F", "U"), CENTRAL: ("M", "F")}
    )

    # concepts
    maternal_questions: tuple[int, ...] = (6131, 7965, 1755, 5632, 5630, 490, 1053)
    pregnancy_questions: tuple[int, ...] = (6131, 1755, 5630)
    breastfeeding_questions: dict[str, tuple[int, ...]] = field(
        default_factory=lambda: {DETECTION: (7965,), CENTRAL: (7965, 5632)}
    )
    breastfeeding: int = 7965
    weight: int = 5089
    height: int = 5090
    bmi: int = 2137
    yes: int = 1065
    no: int = 1066
    label_locale: str = "en"
    label_type: str = "FULLY_SPECIFIED"

    # limits
    adult_age: int = 15
    reproductive_age: tuple[int, int] = (8, 55)
    oldest_plausible_age: int = 120
    earliest_art: date = date(1985, 1, 1)
    pregnancy_window_days: int = 30
    breastfeeding_limit_days: int = 730

    salts: int = 8
    # where set, only keys holding at least this share of the facts are salted (found in a sample)
    hot_share: float | None = None

    @property
    def measures(self) -> tuple[int, ...]:
        return (self.bmi, self.weight, self.height)

    @property
    def rule_concepts(self) -> tuple[int, ...]:
        """Every concept some rule reads; nothing else of ``obs`` matters to them."""
        return tuple(dict.fromkeys(self.maternal_questions + self.measures))


DEFAULT = Config()
