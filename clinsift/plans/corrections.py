"""Corrections as set-based jobs: reviewed decisions in, a new table version out.

Each function takes the table and a frame of decisions (one row per decision) and
returns the whole table with the decisions applied; write it with
``sources.write_version``.  Updates keep the number of rows and can be repeated with
the same result.

On a large table this need not mean rewriting all of it.  Updates also take the part of
a table that ``at_sites`` (sites named by the caller) or ``at_decided_sites`` (sites that have
decisions) picks, and ``sources.replace_partitions`` swaps just those sites.  A part is
corrected as the whole table would be there: an update whose key lacks the site can
change rows of any site, so it refuses a part.  Inserts with ``only_new`` return the rows to
append.

Decisions are best read from the file they were reviewed in.  Spark then knows their
size and broadcasts them if they are under ``spark.sql.autoBroadcastJoinThreshold``,
which leaves the big table where it is; more decisions than that are joined by a
shuffle on the table's own key, which no row shares with many others.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clinsift import texts
from clinsift.config import CENTRAL, DEFAULT, Config
from clinsift.functions import as_of_column, normalise_gender
from clinsift.operators.clients import live
from clinsift.operators.ids import with_new_ids
from clinsift.operators.joins import drop_matching, keep_matching, present
from clinsift.sources.schemas import require_columns


@dataclass(frozen=True)
class SitePart:
    """All rows that a table has for some sites."""

    rows: DataFrame


def _rows(table: DataFrame | SitePart, keys: Sequence[str]) -> DataFrame:
    if not isinstance(table, SitePart):
        return table
    if "site_id" not in keys:
        raise ValueError(
            f"a correction matched by {list(keys)} reaches other sites too: give it the whole table"
        )
    return table.rows


def _columns(frame: DataFrame, wanted: Sequence[str]) -> DataFrame:
    missing = [c for c in wanted if c not in frame.columns]
    if missing:
        raise ValueError(f"the decisions lack the columns {missing}")
    return frame.select(*wanted)


def _typed(source: str, kind: str) -> Column:
    """The decided value in the table's type; one that cannot be read stops the job.

    A mistyped date must not erase the old one, whatever the session's ANSI mode.
    """
    given, value = F.col(source), F.col(source).try_cast(kind)
    message = F.concat(F.lit(f"cannot read {source} as {kind}: "), given.cast("string"))
    return F.when(given.isNull() | value.isNotNull(), value).otherwise(
        F.raise_error(message).cast(kind)
    )


def _only_one(decisions: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per key; a second decision for a key stops the job that meets it.

    Two decisions would otherwise double the table's row.
    """
    values = [c for c in decisions.columns if c not in keys]
    message = F.concat(
        F.lit(f"more than one decision for {list(keys)} = "),
        F.concat_ws(", ", *(F.col(k).cast("string") for k in keys)),
    )
    counted = present(decisions, keys).groupBy(*keys).agg(
        F.count(F.lit(1)).alias("_n"), *(F.min(v).alias(v) for v in values)
    )
    # the check is a column that the caller reads, so it is never pruned away
    once = F.when(F.col("_n") == 1, F.lit(True)).otherwise(F.raise_error(message).cast("boolean"))
    return counted.withColumn("_decided", once).drop("_n")


def _update(
    table: DataFrame | SitePart,
    decisions: DataFrame,
    keys: Sequence[str],
    values: Mapping[str, tuple[str, str]],
    fixed: Mapping[str, Column],
    guard: Column | None = None,
    audited: str | None = None,
) -> DataFrame:
    """Set columns where a decision matches and ``guard`` holds.

    ``values``: table column -> (decision column, type); no type: the table's own.
    ``fixed``: table column -> expression.
    ``audited``: the table's name, if its audit columns are written.
    """
    table = _rows(table, keys)
    if audited:
        require_columns(table, audited, audit=True)
    kinds = dict(table.dtypes)
    values = {c: (source, kind or kinds[c]) for c, (source, kind) in values.items()}
    sources = [source for source, _ in values.values()]
    chosen = _only_one(_columns(decisions, [*keys, *sources]), keys)
    chosen = chosen.select(
        *keys,
        "_decided",
        *(
            _typed(source, kind).alias(f"_new_{target}")
            for target, (source, kind) in values.items()
        ),
    )
    joined = table.join(chosen, on=list(keys), how="left")
    applies = F.col("_decided") if guard is None else F.col("_decided") & guard
    new = {**fixed, **{target: F.col(f"_new_{target}") for target in values}}
    return joined.select(
        *(
            F.when(applies, new[c]).otherwise(F.col(c)).cast(table.schema[c].dataType).alias(c)
            if c in new
            else F.col(c)
            for c in table.columns
        )
    )


def at_sites(table: DataFrame, sites: Sequence[int]) -> SitePart:
    """The rows of the sites the caller names; a table stored by site is read in their
    folders only."""
    return SitePart(table.where(F.col("site_id").isin(list(sites))))


def at_decided_sites(table: DataFrame, decisions: DataFrame) -> SitePart:
    """The rows of all sites with decisions, by a semi-join with one number per site.

    Spark reads the other sites' folders too; ``at_sites`` does not.
    """
    return SitePart(keep_matching(table, decisions, ["site_id"]).select(*table.columns))


# --- person ---------------------------------------------------------------------


def normalise_genders(person: DataFrame | SitePart, cfg: Config = DEFAULT) -> DataFrame:
    """Known spellings of live rows become M or F; NULL and unknown values stay."""
    person = _rows(person, ["site_id"])  # no decisions: each row by itself
    strange = ~F.col("gender").isin(*cfg.valid_genders[CENTRAL]) & live()
    fixed = F.when(strange, normalise_gender(F.col("gender"))).otherwise(F.col("gender"))
    return person.withColumn("gender", fixed)


def clear_death(
    person: DataFrame | SitePart, decisions: DataFrame, cfg: Config = DEFAULT
) -> DataFrame:
    """Take back a wrong death (decisions: person_id, site_id); live rows only.

    Rule 2 looks at the "died" state, so its finding stays.
    """
    fixed = {"death_date": F.lit(None), "dead": F.lit(0)}
    return _update(person, decisions, ["person_id", "site_id"], {}, fixed, live())


def set_birthdate(
    person: DataFrame | SitePart, decisions: DataFrame, cfg: Config = DEFAULT
) -> DataFrame:
    """Correct birthdates (decisions: person_id, site_id, birthdate)."""
    values = {"birthdate": ("birthdate", "date")}
    return _update(person, decisions, ["person_id", "site_id"], values, {})


def set_gender_female(
    person: DataFrame | SitePart, decisions: DataFrame, cfg: Config = DEFAULT
) -> DataFrame:
    """Male by mistake (decisions: person_id, site_id); live rows only."""
    return _update(
        person, decisions, ["person_id", "site_id"], {}, {"gender": F.lit("F")}, live()
    )


# --- encounter and patient_state ---------------------------------------------------


def _voiding(reason: str, as_of: date | None) -> dict[str, Column]:
    return {
        "voided": F.lit(1),
        "date_voided": as_of_column(as_of),
        "void_reason": F.lit(reason),
    }


def void_visits(
    encounter: DataFrame | SitePart,
    decisions: DataFrame,
    cfg: Config = DEFAULT,
    *,
    as_of: date | None = None,
) -> DataFrame:
    """Void visits after death (decisions: encounter_id, site_id, user_id)."""
    return _update(
        encounter,
        decisions,
        ["encounter_id", "site_id"],
        {"voided_by": ("user_id", "bigint")},
        _voiding(texts.VOID_VISIT_REASON, as_of),
        audited="encounter",
    )


def set_state_start(
    patient_state: DataFrame | SitePart,
    decisions: DataFrame,
    cfg: Config = DEFAULT,
    *,
    as_of: date | None = None,
) -> DataFrame:
    """Correct treatment start dates of live treatment states.

    Decisions: patient_state_id, site_id, correct_date, user_id.
    """
    return _update(
        patient_state,
        decisions,
        ["patient_state_id", "site_id"],
        {"start_date": ("correct_date", ""), "changed_by": ("user_id", "bigint")},
        {"date_changed": as_of_column(as_of)},
        live() & (F.col("state") == cfg.state_on_art),
        audited="patient_state",
    )


# --- obs ------------------------------------------------------------------------


def set_obs_datetime(
    obs: DataFrame | SitePart, decisions: DataFrame, cfg: Config = DEFAULT
) -> DataFrame:
    """Correct the time of live observations.

    Decisions: obs_id, site_id, person_id, obs_datetime.  Rule 3 does not look at
    observations, so its finding stays.
    """
    return _update(
        obs,
        decisions,
        ["obs_id", "site_id", "person_id"],
        {"obs_datetime": ("obs_datetime", "")},
        {},
        live(),
    )


def void_observations(
    obs: DataFrame | SitePart,
    decisions: DataFrame,
    cfg: Config = DEFAULT,
    *,
    as_of: date | None = None,
) -> DataFrame:
    """Void live observations of male clients (decisions: obs_id, site_id, user_id)."""
    return _update(
        obs,
        decisions,
        ["obs_id", "site_id"],
        {"voided_by": ("user_id", "bigint")},
        _voiding(texts.VOID_OBS_REASON, as_of),
        live(),
        audited="obs",
    )


def set_obs_value(
    obs: DataFrame | SitePart,
    decisions: DataFrame,
    cfg: Config = DEFAULT,
    *,
    as_of: date | None = None,
    site_safe: bool = False,
) -> DataFrame:
    """Correct the number of live observations.

    Decisions: obs_id, correct_value, user_id; as written the site is not part of the
    key, so all sites' rows with the number change; ``site_safe`` adds site_id.
    """
    return _update(
        obs,
        decisions,
        ["obs_id", "site_id"] if site_safe else ["obs_id"],
        {"value_numeric": ("correct_value", "double"), "changed_by": ("user_id", "bigint")},
        {"date_changed": as_of_column(as_of)},
        live(),
        audited="obs",
    )


def _insert(
    obs: DataFrame,
    decisions: DataFrame,
    values: Mapping[str, tuple[str, str]],
    fixed: Mapping[str, Column],
    as_of: date | None,
    only_new: bool,
) -> DataFrame:
    """One live observation per decision, after all others; columns not named are NULL.

    If the decisions bring an ``obs_id`` it is used, and one that the table already
    has at that site is left out, so the job can be repeated.  Otherwise numbers
    follow on from the highest one, which costs a pass over that column.
    """
    require_columns(obs, "obs", audit=True)
    own_ids = "obs_id" in decisions.columns
    if own_ids:
        values = {"obs_id": ("obs_id", "bigint"), **values}
    chosen = _columns(decisions, [source for source, _ in values.values()])
    fresh = chosen.select(*(_typed(source, kind).alias(c) for c, (source, kind) in values.items()))
    keys = ["obs_id", "site_id"] if own_ids else fresh.columns
    fresh = _each_once(fresh, keys).select(
        "*",
        *(value.alias(c) for c, value in fixed.items()),
        as_of_column(as_of).alias("date_created"),
        F.lit(0).alias("voided"),
    )
    if own_ids:
        # the few new keys go to the table, not the table's keys to them
        taken = keep_matching(obs.select(*keys), fresh, keys)
        fresh = drop_matching(fresh, taken, keys)
    else:
        fresh = with_new_ids(fresh, obs, "obs_id")
    columns = {c: F.lit(None) for c in obs.columns} | {c: F.col(c) for c in fresh.columns}
    new_rows = fresh.select(
        *(columns[c].cast(obs.schema[c].dataType).alias(c) for c in obs.columns)
    )
    return new_rows if only_new else obs.unionByName(new_rows)


def _each_once(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Stop on a row to insert that is there twice."""
    values = [c for c in rows.columns if c not in keys]
    counted = rows.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("_n"), *(F.min(v).alias(v) for v in values)
    )
    message = F.concat(
        F.lit("the same row to insert occurs more than once: "),
        F.to_json(F.struct(*keys)),
    )
    once = F.when(F.col("_n") == 1, F.lit(True)).otherwise(F.raise_error(message).cast("boolean"))
    return counted.where(once).select(*rows.columns)


def insert_height(
    obs: DataFrame,
    decisions: DataFrame,
    cfg: Config = DEFAULT,
    *,
    as_of: date | None = None,
    only_new: bool = False,
) -> DataFrame:
    """Add a height without a visit.

    Decisions: patient_id, visit_date, site_id, height_value, user_id.  It clears rule
    8; rule 7 looks for measurements by visit, so its finding stays.
    """
    values = {
        "person_id": ("patient_id", "bigint"),
        "obs_datetime": ("visit_date", dict(obs.dtypes)["obs_datetime"]),
        "site_id": ("site_id", "int"),
        "value_numeric": ("height_value", "double"),
        "creator": ("user_id", "bigint"),
    }
    fixed = {"concept_id": F.lit(cfg.height)}
    return _insert(obs, decisions, values, fixed, as_of, only_new)


def insert_height_at_visit(
    obs: DataFrame,
    decisions: DataFrame,
    cfg: Config = DEFAULT,
    *,
    as_of: date | None = None,
    only_new: bool = False,
) -> DataFrame:
    """Add a height taken at a visit.

    Decisions: patient_id, encounter_datetime, encounter_id, site_id, height_in_cm,
    user_id.
    """
    values = {
        "person_id": ("patient_id", "bigint"),
        "obs_datetime": ("encounter_datetime", dict(obs.dtypes)["obs_datetime"]),
        "encounter_id": ("encounter_id", "bigint"),
        "site_id": ("site_id", "int"),
        "value_numeric": ("height_in_cm", "double"),
        "creator": ("user_id", "bigint"),
    }
    fixed = {"concept_id": F.lit(cfg.height)}
    return _insert(obs, decisions, values, fixed, as_of, only_new)


def insert_breastfeeding_no(
    obs: DataFrame,
    decisions: DataFrame,
    cfg: Config = DEFAULT,
    *,
    as_of: date | None = None,
    only_new: bool = False,
) -> DataFrame:
    """Record that breastfeeding has ended.

    Decisions: patient_id, current_encounter_datetime, encounter_id, site_id, user_id.
    Rule 10 ranks "yes" answers only, so its finding stays.
    """
    values = {
        "person_id": ("patient_id", "bigint"),
        "obs_datetime": ("current_encounter_datetime", dict(obs.dtypes)["obs_datetime"]),
        "encounter_id": ("encounter_id", "bigint"),
        "site_id": ("site_id", "int"),
        "creator": ("user_id", "bigint"),
    }
    fixed = {"concept_id": F.lit(cfg.breastfeeding), "value_coded": F.lit(cfg.no)}
    return _insert(obs, decisions, values, fixed, as_of, only_new)
