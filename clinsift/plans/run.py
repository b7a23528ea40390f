"""Running many rules over the same tables."""

from __future__ import annotations

from collections import Counter
from collections.abc import Sequence
from dataclasses import replace
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clinsift.config import CENTRAL, DEFAULT, DETECTION, Config, Variant
from clinsift.operators.clients import live, prepare_clients
from clinsift.plans.rules import RULES, reads, run_rule
from clinsift.sources.schemas import AUDIT_COLUMNS
from clinsift.operators.joins import dealt, salt_column
from clinsift.sources.sinks import stage, stage_bucketed, stage_folder
from clinsift.sources.tables import Prepared, RecordTables

SITE_PAIRING = "r02_visit_after_death"


def prepare(
    tables: RecordTables,
    cfg: Config = DEFAULT,
    *,
    rules: Sequence[str] | None = None,
    variant: Variant | None = None,
) -> RecordTables:
    """Write what several of the rules share once, and return tables that read it.

    Live observations of the concepts that the rules read are read once and exchanged once:
    written as a table bucketed by client and salt (the deal of ``skew_join``), in folders by
    concept.  Each rule scans its own folders only, and its salted joins of observations to
    clients read the buckets without another exchange, so a client with very many
    observations still spreads over ``salts`` buckets.  Clients of a state are joined once.  What only one
    of the rules reads is not written.  The result is good for these rules and
    settings; a rule that needs more stops.  ``drop_prepared`` of the result removes the folder.
    """
    chosen = list(rules or RULES)
    variants = [variant] if variant else [DETECTION, CENTRAL]
    needs = [[reads(name, cfg, v) for v in variants] for name in chosen]
    states = Counter(s for each in needs for s in {n.state for n in each})
    readers = [each for each in needs if any(n.concepts for n in each)]
    concepts = tuple(dict.fromkeys(c for each in needs for n in each for c in n.concepts))
    folder = stage_folder(tables.obs.sparkSession)
    clients = {
        state: stage(prepare_clients(tables, cfg, state), f"clients_{state}", folder=folder)
        for state, users in states.items()
        if users > 1
    }
    obs, staged_tables = tables.obs, ()
    if len(readers) > 1:
        facts = obs.where(live() & F.col("concept_id").isin(*concepts)).drop(*AUDIT_COLUMNS)
        if cfg.salts >= 2:
            # the one exchange of obs: by client and salt, as the salted client joins ask
            keys = ["person_id", "site_id", salt_column(cfg.salts)]
            width = int(facts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
            obs, table = stage_bucketed(dealt(facts, ["obs_id"], cfg.salts), "obs", keys, width, ["concept_id"], folder)
            staged_tables = (table,)
        else:
            obs = stage(facts, "obs", ["concept_id"], folder)
    kept = concepts if len(readers) > 1 else None
    return replace(tables, obs=obs, clients=clients, prepared=Prepared(cfg, folder, kept, staged_tables))


def run_all(
    tables: RecordTables,
    cfg: Config = DEFAULT,
    *,
    rules: Sequence[str] | None = None,
    variant: Variant = CENTRAL,
    as_of: date | None = None,
    site_safe: bool | None = None,
    ordered: bool = False,
    staged: bool = True,
) -> dict[str, DataFrame]:
    """Findings of the chosen rules (all ten by default), one frame per rule.

    The frames are lazy; only the shared inputs are written on the way.

    In detection, rule 2 as written matches clients by number alone: where S sites use the
    same numbers it returns about S x S as many rows per number as with the site in the key.
    So a detection run with that rule must say which one is meant; elsewhere ``site_safe``
    is off unless given.
    """
    chosen = list(rules or RULES)
    if site_safe is None:
        if variant == DETECTION and SITE_PAIRING in chosen:
            raise ValueError(
                f"say site_safe=True or False: {SITE_PAIRING} in detection pairs the sites"
            )
        site_safe = False
    shared = prepare(tables, cfg, rules=chosen, variant=variant) if staged else tables
    return {
        name: run_rule(
            name,
            shared,
            cfg,
            as_of=as_of,
            variant=variant,
            site_safe=site_safe,
            ordered=ordered,
        )
        for name in chosen
    }
