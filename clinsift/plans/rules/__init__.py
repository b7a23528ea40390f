"""The ten data-quality rules, each in a detection and a central variant."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame

from clinsift.config import CENTRAL, DEFAULT, Config, Variant
from clinsift.plans.rules import clients, observations, visits
from clinsift.plans.rules.common import RuleContext
from clinsift.sources.tables import RecordTables

RULES: dict[str, Callable[[RecordTables, RuleContext], DataFrame]] = {
    "r01_gender": clients.gender,
    "r02_visit_after_death": visits.visit_after_death,
    "r03_art_before_birth": clients.treatment_before_birth,
    "r04_male_pregnancy": observations.male_pregnancy,
    "r05_female_age_range": observations.female_age_range,
    "r06_art_date_implausible": clients.treatment_date_implausible,
    "r07_peds_missing_vitals": visits.child_missing_measures,
    "r08_adult_no_height": clients.adult_without_height,
    "r09_pregnant_at_art_start": observations.pregnant_at_treatment_start,
    "r10_breastfeeding": observations.breastfeeding,
}


@dataclass(frozen=True)
class Reads:
    """The client state and the concepts a rule looks at."""

    state: int
    concepts: tuple[int, ...] = ()


def reads(name: str, cfg: Config, variant: Variant) -> Reads:
    """What one rule needs of the clients and of ``obs``."""
    concepts = {
        "r04_male_pregnancy": cfg.maternal_questions,
        "r05_female_age_range": cfg.maternal_questions,
        "r07_peds_missing_vitals": cfg.measures,
        "r08_adult_no_height": (cfg.height,),
        "r09_pregnant_at_art_start": cfg.pregnancy_questions,
        "r10_breastfeeding": cfg.breastfeeding_questions[variant],
    }
    state = cfg.state_died if name == "r02_visit_after_death" else cfg.state_on_art
    return Reads(state, tuple(concepts.get(name, ())))


def run_rule(
    name: str,
    tables: RecordTables,
    cfg: Config = DEFAULT,
    *,
    as_of: date | None = None,
    variant: Variant = CENTRAL,
    site_safe: bool = False,
    ordered: bool = False,
) -> DataFrame:
    """The findings of one rule."""
    if tables.prepared is not None:
        tables.prepared.check(name, cfg, reads(name, cfg, variant).concepts)
    return RULES[name](tables, RuleContext(cfg, variant, as_of, site_safe, ordered))


__all__ = ["RULES", "Reads", "RuleContext", "reads", "run_rule"]
