"""Findings after a change set: only the clients it touches are judged again.

A rule's findings for one client depend on that client's rows alone (and on the lookup tables),
so after a batch of changes the findings of untouched clients stay as they were.  ``findings_delta``
finds the touched clients, keeps of every client-keyed table only their rows - ``obs`` is
semi-joined to them before anything else happens to it - runs the rules over that slice, and
compares with the earlier findings of the same clients.  Each finding comes out as ``new``,
``cleared`` or ``unchanged``; ``current`` gives the findings as a full run over the new tables
would.

Defined cases and limits:

* The change set maps table names to rows that were inserted, updated or deleted; an update gives
  its old and its new row (either alone touches the same client unless the row moved to another
  client, which then needs both).  Rows of ``patient_state`` name their client through
  ``patient_program`` (new version and changed rows).
* A change of ``encounter_type`` or ``concept_name`` touches every client: the run is a full one.
* Earlier findings must come from the same settings, variant, day (``as_of``) and ``site_safe``;
  another day can change the findings of untouched clients (ages, days since).
* Rule 2 in detection without ``site_safe`` pairs clients of all sites by number, so for it a
  touched number is judged again at every site.
* Findings are multisets: repeated rows are compared by their number, as by ``exceptAll``.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import replace
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clinsift.config import CENTRAL, DEFAULT, DETECTION, Config, Variant
from clinsift.operators.clients import CLIENT
from clinsift.plans.rules import RULES, run_rule
from clinsift.sources.sinks import CHECKPOINT_CONF, stage
from clinsift.sources.tables import RecordTables

CHANGE = "change"
_JUDGED = "_judged"
_BLOCK = 10_000  # copies of a row made at once
NEW, CLEARED, UNCHANGED = "new", "cleared", "unchanged"
LOOKUPS = ("encounter_type", "concept_name")
# how the rows of each client-keyed table name their client
CLIENT_OF = {
    "patient": ("patient_id", "site_id"),
    "person": ("person_id", "site_id"),
    "patient_program": ("patient_id", "site_id"),
    "encounter": ("patient_id", "site_id"),
    "obs": ("person_id", "site_id"),
}
PROGRAM = ["patient_program_id", "site_id"]
BROADCAST_KEYS = 2_000_000  # touched clients sent whole to every task up to this many


def touched_clients(tables: RecordTables, changes: Mapping[str, DataFrame]) -> DataFrame | None:
    """``patient_id, site_id`` of the clients a change set touches; None if it touches all."""
    if any(name in changes for name in LOOKUPS):
        return None
    spark = tables.patient.sparkSession
    parts = [
        rows.select(F.col(key).alias("patient_id"), F.col(site).alias("site_id"))
        for name, rows in changes.items()
        if name in CLIENT_OF
        for key, site in [CLIENT_OF[name]]
    ]
    if "patient_state" in changes:
        programs = tables.patient_program.select(*PROGRAM, "patient_id")
        if "patient_program" in changes:
            programs = programs.unionByName(changes["patient_program"].select(*PROGRAM, "patient_id"))
        states = changes["patient_state"].select(*PROGRAM).distinct()
        parts.append(states.join(programs, PROGRAM).select("patient_id", "site_id"))
    unknown = set(changes) - set(CLIENT_OF) - {"patient_state"}
    if unknown:
        raise ValueError(f"no client key for the tables {sorted(unknown)}")
    if not parts:
        return spark.createDataFrame([], "patient_id bigint, site_id int")
    found = parts[0]
    for more in parts[1:]:
        found = found.unionByName(more)
    return found.where(F.col("patient_id").isNotNull() & F.col("site_id").isNotNull()).distinct()


def spark_conf_set(df: DataFrame) -> bool:
    return bool(df.sparkSession.conf.get(CHECKPOINT_CONF, None))


def _keep(df: DataFrame, keys: DataFrame, on: Sequence[str], small: bool) -> DataFrame:
    return df.join(F.broadcast(keys) if small else keys, list(on), "left_semi")


def restrict(tables: RecordTables, touched: DataFrame, small: bool, by: Sequence[str] = CLIENT) -> RecordTables:
    """The tables with the rows of the touched clients only (lookup tables whole).

    ``by`` is the client key or the client number alone (every site of a touched number).
    """
    keys = touched.select(*by).distinct()

    def own(df: DataFrame, key: str, site: str) -> DataFrame:
        named = keys.withColumnRenamed("patient_id", key).withColumnRenamed("site_id", site)
        return _keep(df, named, [key, *([site] if "site_id" in by else [])], small)

    cut = {name: own(getattr(tables, name), *CLIENT_OF[name]) for name in CLIENT_OF}
    cut["patient_state"] = _keep(tables.patient_state, cut["patient_program"].select(*PROGRAM), PROGRAM, False)
    return replace(tables, **cut, clients={}, prepared=None)


def _keys_of(name: str, variant: Variant, site_safe: bool) -> list[str]:
    paired_by_number = name == "r02_visit_after_death" and variant == DETECTION and not site_safe
    return ["patient_id"] if paired_by_number else list(CLIENT)


def findings_delta(
    tables: RecordTables,
    changes: Mapping[str, DataFrame],
    before: Mapping[str, DataFrame],
    cfg: Config = DEFAULT,
    *,
    rules: Sequence[str] | None = None,
    variant: Variant = CENTRAL,
    as_of: date | None = None,
    site_safe: bool = False,
) -> dict[str, DataFrame]:
    """Per rule: the findings with a column ``change`` (new, cleared or unchanged).

    ``tables`` are the new versions, ``before`` the findings of each rule over the old ones.
    The touched clients are written to the shared folder once (where the session names one);
    they are broadcast where there are at most ``BROADCAST_KEYS`` of them, else joined by a shuffle.
    """
    chosen = list(rules or RULES)
    touched = touched_clients(tables, changes)
    if touched is None:  # a lookup table changed: every client is judged again
        return {
            name: _compare(
                run_rule(name, tables, cfg, as_of=as_of, variant=variant, site_safe=site_safe).withColumn(_JUDGED, F.lit(True)),
                before[name].withColumn(_JUDGED, F.lit(True)),
            )
            for name in chosen
        }
    if spark_conf_set(touched):
        touched = stage(touched, "touched")  # cut from the change set's lineage, size known
    small = touched.count() <= BROADCAST_KEYS
    slices: dict[tuple[str, ...], RecordTables] = {}
    out = {}
    for name in chosen:
        by = tuple(_keys_of(name, variant, site_safe))
        if by not in slices:
            slices[by] = restrict(tables, touched, small, by)
        now = run_rule(name, slices[by], cfg, as_of=as_of, variant=variant, site_safe=site_safe)
        keys = touched.select(*by).distinct().withColumn(_JUDGED, F.lit(True))
        earlier = before[name].select(*now.columns).join(F.broadcast(keys) if small else keys, list(by), "left")
        out[name] = _compare(now.withColumn(_JUDGED, F.lit(True)), earlier)
    return out


def _compare(now: DataFrame, earlier: DataFrame) -> DataFrame:
    """Rows of both as new, cleared or unchanged, counting repeated rows.

    ``_JUDGED`` marks rows of clients that were judged again; other earlier rows are unchanged.
    One grouping of both sides: set operations would compute each side once per operation, and
    where both sides are partitioned alike, all in the same tasks.
    """
    columns = [c for c in now.columns if c != _JUDGED]
    both = now.withColumn("_now", F.lit(1)).unionByName(earlier.select(*now.columns).withColumn("_now", F.lit(0)))
    counted = both.groupBy(*columns, _JUDGED).agg(
        F.sum("_now").alias("_after"), F.sum(1 - F.col("_now")).alias("_before")
    )
    same = F.when(F.col(_JUDGED), F.least("_after", "_before")).otherwise(F.col("_before"))
    kinds = [(NEW, F.col("_after") - same), (CLEARED, F.col("_before") - same), (UNCHANGED, same)]
    # a count becomes rows block by block, so that no array holds very many copies
    return (
        counted.select(*columns, F.inline(F.array(*(F.struct(F.lit(k).alias(CHANGE), n.alias("_n")) for k, n in kinds))))
        .where("_n > 0")
        .select(*columns, CHANGE, "_n", F.explode(F.expr(f"sequence(0L, (_n - 1) div {_BLOCK})")).alias("_block"))
        .withColumn("_copy", F.explode(F.expr(f"array_repeat(1, cast(least({_BLOCK}, _n - _block * {_BLOCK}) as int))")))
        .select(*columns, CHANGE)
    )


def current(delta: DataFrame) -> DataFrame:
    """The findings after the change: new and unchanged ones."""
    return delta.where(F.col(CHANGE) != CLEARED).drop(CHANGE)
