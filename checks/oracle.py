"""The same results in DuckDB SQL, over the driver's registered views.

Each text starts with the record tables it needs as CTEs, then states the rule in its
own way; nothing here is used by the Spark code.
"""

from __future__ import annotations

import re

from checks.fixture import AS_OF, fixture_ctes
from clinsift import texts as tx

TODAY = f"date '{AS_OF}'"


# --- pieces -----------------------------------------------------------------------


def query(body: str, **ctes: str) -> str:
    """``body`` with the CTEs it mentions, directly or through other CTEs."""
    known = {**fixture_ctes(), **CTES, **ctes}

    def mentioned(text: str) -> list[str]:
        return [n for n in known if re.search(rf"\b(from|join)\s+{n}\b", text)]

    order: list[str] = []

    def add(name: str) -> None:
        if name not in order:
            for other in mentioned(known[name]):
                if other != name:
                    add(other)
            order.append(name)

    for name in mentioned(body):
        add(name)
    # "materialized" keeps the window functions of one CTE from being run once per use
    head = ",\n".join(f"{n} as materialized ({known[n].strip()})" for n in order)
    return f"with {head}\n{body.strip()}"


def text(template: str, **values: str) -> str:
    """A text with values put in; ``||`` is NULL if one of them is."""
    parts = re.split(r"\{(\w+)\}", template)
    out = [
        quote(p) if i % 2 == 0 else f"cast({values[p]} as varchar)"
        for i, p in enumerate(parts)
        if i % 2 == 1 or p
    ]
    return "(" + " || ".join(out) + ")"


def quote(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def age(a: str, b: str) -> str:
    """Completed years, truncated towards zero."""
    first, second = f"cast({a} as timestamp)", f"cast({b} as timestamp)"

    def elapsed(x: str, y: str) -> str:
        of_year = "'%m%d%H%M%S'"
        short = f"case when strftime({y}, {of_year}) < strftime({x}, {of_year}) then 1 else 0 end"
        return f"(year({y}) - year({x}) - {short})"

    return (
        f"cast(case when {second} >= {first} then {elapsed(first, second)}"
        f" else -{elapsed(second, first)} end as int)"
    )


def days(start: str, end: str) -> str:
    return f"cast(date_diff('day', cast({start} as date), cast({end} as date)) as int)"


def finding(flag: str, category: str, severity: str) -> str:
    level = severity if severity.startswith("case") else quote(severity)
    return f'{flag} as "DQ_flag", {quote(category)} as kahn_category, {level} as severity'


def clients(state: int, columns: str, where: str = "true", person: bool = True) -> str:
    """Distinct clients with an open live state in programme 1."""
    join = "join person h on h.person_id = g.patient_id and h.site_id = g.site_id" if person else ""
    return f"""
select distinct g.patient_id, g.site_id{", " if columns else ""}{columns}
from patient_state s
join patient_program g using (patient_program_id, site_id)
{join}
where s.state = {state} and s.voided = 0 and s.end_date is null
  and g.program_id = 1 and g.voided = 0
  and (g.patient_id, g.site_id) in (select patient_id, site_id from patient where voided = 0)
  and {where}"""


YES = "(o.value_coded = 1065 or lower(trim(o.value_text)) = 'yes')"
SOURCE = (
    f"coalesce(if(o.value_coded = 1065, '{tx.CODED_YES}', null),"
    f" if(lower(trim(o.value_text)) = 'yes', '{tx.TEXT_YES}', null))"
)
MATERNAL = "(6131, 7965, 1755, 5632, 5630, 490, 1053)"
LABELLED = """
join names q on q.concept_id = o.concept_id
left join names a on a.concept_id = o.value_coded"""

CTES: dict[str, str] = {
    "names": (
        "select concept_id, name from concept_name"
        " where locale = 'en' and concept_name_type = 'FULLY_SPECIFIED'"
    ),
    "dead": clients(3, "s.state, s.start_date, s.end_date"),
    "men": clients(7, "", "h.gender = 'M'"),
    "women": clients(7, "", "h.gender = 'F'"),
    "women_started": clients(7, "", "h.gender = 'F' and s.start_date is not null"),
    "women_born": clients(7, "h.birthdate", "h.gender = 'F'"),
    "women_start": clients(7, "s.start_date", "h.gender = 'F'"),
    "born": clients(7, "h.birthdate"),
    "born_enrolled": clients(7, "h.birthdate, g.date_enrolled"),
    "born_start": clients(7, "h.birthdate, h.birthdate_estimated, s.start_date"),
    "gendered": clients(7, "h.gender"),
    "started": clients(7, "s.start_date"),
    "started_anyone": clients(7, "s.start_date", person=False),
    "heights": (
        "select distinct person_id, site_id from obs"
        " where concept_id = 5090 and voided = 0 and value_numeric is not null"
    ),
}


# --- rules --------------------------------------------------------------------------


def _r01(central: bool) -> str:
    if not central:
        return query(
            "select patient_id, gender, site_id from gendered"
            " where gender is null or gender not in ('M', 'F', 'U')"
        )
    flag = (
        f"case when gender is null then {quote(tx.GENDER_NULL)}"
        f" else {text(tx.GENDER_NON_STANDARD, gender='gender')} end"
    )
    return query(
        f"select patient_id, site_id, gender, {finding(flag, tx.VALUE_CONFORMANCE, tx.HIGH)}"
        " from gendered where gender is null or gender not in ('M', 'F')"
    )


def _r02(central: bool, safe: bool = False) -> str:
    site = "and d.site_id = e.site_id" if central or safe else ""
    source = f"""
from dead d
join encounter e on e.patient_id = d.patient_id {site}
join encounter_type n on n.encounter_type_id = e.encounter_type
where e.voided = 0 and e.encounter_datetime > cast(d.start_date as timestamp)"""
    if not central:
        return query(
            "select d.patient_id, d.state, d.start_date, d.end_date, e.encounter_datetime,"
            f" n.name as encounter_type, d.site_id {source}"
        )
    late = days("d.start_date", "e.encounter_datetime")
    flag = text(tx.VISIT_AFTER_DEATH, days=late, death="d.start_date")
    return query(
        "select distinct d.patient_id, d.site_id, d.start_date as death_start_date,"
        " e.encounter_id, cast(e.encounter_datetime as date) as encounter_date,"
        f" n.name as encounter_type, {late} as days_after_death,"
        f" {finding(flag, tx.TEMPORAL, tx.HIGH)} {source}"
    )


def _r03(central: bool) -> str:
    first = (
        "patient_id, site_id, birthdate as date_of_birth, birthdate_estimated,"
        " start_date as art_start_date"
    )
    rows = (
        "from born_start where birthdate is null or start_date is null or birthdate > start_date"
    )
    before = days("start_date", "birthdate")
    if not central:
        return query(
            f"select {first}, case when birthdate is null then {quote(tx.DET_BIRTHDATE_MISSING)}"
            f" when start_date is null then {quote(tx.DET_START_MISSING)}"
            f" else {quote(tx.DET_START_BEFORE_BIRTH)} end as issue {rows}"
        )
    flag = (
        f"case when birthdate is null then {quote(tx.CEN_BIRTHDATE_NULL)}"
        f" when start_date is null then {quote(tx.CEN_START_NULL)}"
        f" else {text(tx.CEN_START_BEFORE_BIRTH, days=before)} end"
    )
    level = "case when birthdate > start_date then 'High' else 'Medium' end"
    return query(
        f"select {first}, {before} as days_before_birth, {finding(flag, tx.TEMPORAL, level)} {rows}"
    )


def _r04(central: bool) -> str:
    rows = f"""
from obs o join men c on c.patient_id = o.person_id and c.site_id = o.site_id {LABELLED}
where o.voided = 0 and o.concept_id in {MATERNAL} and {YES}"""
    question = "c.patient_id, c.site_id, o.concept_id, q.name as observation_question"
    answer = (
        "o.value_coded, a.name as observation_answer, o.value_text as obs_answer_text,"
        f" {SOURCE} as answer_source"
    )
    if not central:
        return query(f"select distinct {question}, o.obs_datetime, {answer} {rows}")
    day = "cast(o.obs_datetime as date)"
    flag = text(tx.MALE_OBSERVATION, question="q.name", day=day)
    return query(
        f"select distinct {question}, {day} as obs_date, {answer},"
        f" {finding(flag, tx.ATEMPORAL, tx.HIGH)} {rows}"
    )


def _r05(central: bool) -> str:
    years = age("c.birthdate", "o.obs_datetime")
    aged = f"""
select c.patient_id, c.birthdate, {years} as years, o.*
from obs o join women_born c on c.patient_id = o.person_id and c.site_id = o.site_id
where o.voided = 0 and o.concept_id in {MATERNAL}
  and ({YES} or o.value_datetime is not null or o.value_numeric is not null)"""
    rows = f"from aged o {LABELLED} where o.birthdate is null or o.years < 8 or o.years > 55"
    first = (
        "o.patient_id, o.site_id, o.birthdate, o.years as age_at_observation, o.concept_id,"
        " q.name as observation_question"
    )
    last = "a.name as observation_answer, o.value_text as obs_answer_text"
    if not central:
        return query(
            f"select distinct {first}, o.obs_datetime, o.value_coded, o.value_datetime,"
            f" o.value_numeric, {last}, case when o.birthdate is null"
            f" then {quote(tx.DET_BIRTHDATE_MISSING)} else {quote(tx.DET_AGE_OUTSIDE)} end as issue"
            f" {rows}",
            aged=aged,
        )
    flag = (
        f"case when o.birthdate is null then {quote(tx.CEN_AGE_UNKNOWN)}"
        f" when o.years < 8 then {text(tx.CEN_AGE_BELOW, age='o.years')}"
        f" else {text(tx.CEN_AGE_ABOVE, age='o.years')} end"
    )
    level = "case when o.birthdate is null then 'Medium' else 'High' end"
    return query(
        f"select distinct {first}, cast(o.obs_datetime as date) as obs_date, o.value_coded, {last},"
        f" {finding(flag, tx.ATEMPORAL, level)} {rows}",
        aged=aged,
    )


def _r06(central: bool) -> str:
    rows = f"where start_date is null or start_date < date '1985-01-01' or start_date > {TODAY}"
    first = "patient_id, site_id, start_date as art_start_date"

    def choose(missing: str, early: str, future: str) -> str:
        return (
            f"case when start_date is null then {quote(missing)}"
            f" when start_date < date '1985-01-01' then {text(early, start='start_date')}"
            f" else {text(future, start='start_date')} end"
        )

    if not central:
        issue = choose(tx.DET_START_MISSING, tx.DET_START_EARLY, tx.DET_START_FUTURE)
        return query(f"select {first}, {issue} as issue from started {rows}")
    flag = choose(tx.CEN_START_IS_NULL, tx.CEN_START_EARLY, tx.CEN_START_FUTURE)
    return query(
        f"select {first}, {finding(flag, tx.TEMPORAL, tx.HIGH)} from started_anyone {rows}"
    )


def _r07(central: bool, safe: bool = False) -> str:
    site = "and m.site_id = e.site_id" if safe or not central else ""
    years = age("c.birthdate", "e.encounter_datetime")
    measured = f"""
select e.patient_id, e.site_id, e.encounter_id, e.encounter_datetime, c.birthdate,
  {years} as age_at_visit,
  max(m.value_numeric) filter (where m.concept_id = 5089) as weight,
  max(m.value_numeric) filter (where m.concept_id = 5090) as height_cm,
  max(m.value_numeric) filter (where m.concept_id = 2137) as bmi
from encounter e
join born c on c.patient_id = e.patient_id and c.site_id = e.site_id
left join obs m on m.encounter_id = e.encounter_id {site}
  and m.voided = 0 and m.concept_id in (5089, 5090, 2137)
where e.voided = 0 and (c.birthdate is null or {years} < 15)
group by all"""
    issue = {
        "weight is null and height_cm is null and bmi is null": ("ALL_MISSING"),
        "weight is null and height_cm is null": "WEIGHT_HEIGHT_MISSING",
        "weight is null": "WEIGHT_MISSING",
        "height_cm is null": "HEIGHT_MISSING",
        "bmi is null": "BMI_MISSING",
    }
    prefix = "CEN_" if central else "DET_"
    case = " ".join(f"when {k} then {quote(getattr(tx, prefix + v))}" for k, v in issue.items())
    measures = "age_at_visit, weight, height_cm, bmi"
    rows = "from measured where weight is null or height_cm is null or bmi is null"
    if not central:
        return query(
            "select patient_id, site_id, encounter_id, encounter_datetime as visit_date,"
            f" birthdate as date_of_birth, {measures}, case {case} end as issue {rows}",
            measured=measured,
        )
    return query(
        "select patient_id, site_id, encounter_id, cast(encounter_datetime as date) as visit_date,"
        f" birthdate, {measures}, {finding(f'case {case} end', tx.COMPLETENESS, tx.HIGH)} {rows}",
        measured=measured,
    )


def _r08(central: bool) -> str:
    aged = (
        f"select *, {age('birthdate', TODAY)} as current_age,"
        f" {age('birthdate', 'date_enrolled')} as age_at_enrolment from born_enrolled"
    )
    rows = """
from aged left join heights on heights.person_id = aged.patient_id
  and heights.site_id = aged.site_id
where heights.person_id is null
  and (birthdate is null or least(current_age, age_at_enrolment) >= 15
       and current_age is not null and age_at_enrolment is not null)"""
    first = (
        "aged.patient_id, aged.site_id, birthdate as date_of_birth, current_age, age_at_enrolment"
    )

    def choose(unknown: str, old: str, other: str) -> str:
        return (
            f"case when birthdate is null then {quote(unknown)}"
            f" when current_age > 120 then {text(old, age='current_age')}"
            f" else {text(other, enrolled='date_enrolled')} end"
        )

    if not central:
        issue = choose(tx.DET_NO_HEIGHT_AGE_UNKNOWN, tx.DET_NO_HEIGHT_OLD, tx.DET_NO_HEIGHT)
        return query(f"select {first}, {issue} as issue {rows}", aged=aged)
    flag = choose(tx.CEN_NO_HEIGHT_AGE_UNKNOWN, tx.CEN_NO_HEIGHT_OLD, tx.CEN_NO_HEIGHT)
    return query(
        f"select {first}, date_enrolled as program_enrolment_date,"
        f" {finding(flag, tx.COMPLETENESS, tx.MEDIUM)} {rows}",
        aged=aged,
    )


def _r09(central: bool) -> str:
    away = days("c.start_date", "o.obs_datetime")
    number = "" if central else "or o.value_numeric is not null"
    missing = "c.start_date is null or" if central else ""
    rows = f"""
from obs o join women_start c on c.patient_id = o.person_id and c.site_id = o.site_id {LABELLED}
where o.voided = 0 and o.concept_id in (6131, 1755, 5630)
  and ({YES} or o.value_datetime is not null {number})
  and ({missing} abs({away}) <= 30)"""
    first = (
        "c.patient_id, c.site_id, c.start_date as art_start_date, o.concept_id,"
        " q.name as observation_question"
    )
    answer = "o.value_coded, a.name as observation_answer, o.value_text as obs_answer_text"
    if not central:
        return query(
            f"select distinct {first}, o.obs_datetime as obs_date, {answer}, o.value_datetime,"
            f" {quote(tx.DET_PREGNANT_AT_START)} as issue {rows}"
        )
    side = f"case when {away} < 0 then 'before' else 'after' end"
    told = text(tx.CEN_PREGNANT_AT_START, days=f"abs({away})", side=side, start="c.start_date")
    flag = f"case when c.start_date is null then {quote(tx.CEN_PREGNANT_START_NULL)} else {told} end"
    level = "case when c.start_date is null then 'Medium' else 'Low' end"
    return query(
        f"select {first}, cast(o.obs_datetime as date) as obs_date, {answer},"
        f" {SOURCE} as answer_source, {away} as days_from_art_start,"
        f" {finding(flag, tx.ATEMPORAL, level)} {rows}"
    )


def _r10(central: bool, safe: bool = False) -> str:
    who, concepts = ("women", "(7965, 5632)") if central else ("women_started", "(7965)")
    site = ", o.site_id" if safe else ""
    latest = f"""
select o.*
from obs o semi join {who} c on c.patient_id = o.person_id and c.site_id = o.site_id
where o.voided = 0 and o.concept_id in {concepts} and {YES}
qualify row_number() over (
  partition by o.person_id, o.concept_id{site}
  order by o.obs_datetime desc, o.site_id, o.obs_id) = 1"""
    day = "cast(o.obs_datetime as date)"
    since = days("o.obs_datetime", TODAY)
    rows = f"from latest o {LABELLED}"
    if not central:
        return query(
            "select o.person_id as patient_id, o.site_id, q.name as observation_question,"
            f" {day} as latest_obs_date, o.value_coded, a.name as observation_answer,"
            f" o.value_text as obs_anser_text, {since} as days_since_obs,"
            f" case when {since} > 730 then {quote(tx.DET_BREASTFEEDING_OLD)}"
            f" else {quote(tx.DET_BREASTFEEDING)} end as issue {rows}",
            latest=latest,
        )
    flag = (
        f"case when {since} > 730 then {text(tx.CEN_BREASTFEEDING_OLD, days=since)}"
        f" else {text(tx.CEN_BREASTFEEDING, day=day)} end"
    )
    level = f"case when {since} > 730 then 'High' else 'Low' end"
    return query(
        "select o.person_id as patient_id, o.site_id, o.concept_id,"
        f" q.name as observation_question, {day} as latest_obs_date, o.value_coded,"
        f" a.name as observation_answer, o.value_text as obs_answer_text,"
        f" {SOURCE} as answer_source, {since} as days_since_obs,"
        f" {finding(flag, tx.TEMPORAL, level)} {rows}",
        latest=latest,
    )


def _rules() -> dict[str, str]:
    made = {
        "r01_gender": _r01,
        "r02_visit_after_death": _r02,
        "r03_art_before_birth": _r03,
        "r04_male_pregnancy": _r04,
        "r05_female_age_range": _r05,
        "r06_art_date_implausible": _r06,
        "r07_peds_missing_vitals": _r07,
        "r08_adult_no_height": _r08,
        "r09_pregnant_at_art_start": _r09,
        "r10_breastfeeding": _r10,
    }
    out = {}
    for name, make in made.items():
        out[f"{name}_det"] = make(False)
        out[f"{name}_cen"] = make(True)
    out["r02_visit_after_death_det_site_safe"] = _r02(False, True)
    out["r07_peds_missing_vitals_cen_site_safe"] = _r07(True, True)
    out["r10_breastfeeding_det_site_safe"] = _r10(False, True)
    out["r10_breastfeeding_cen_site_safe"] = _r10(True, True)
    return out


# --- reviews and building blocks --------------------------------------------------------


def _reviews() -> dict[str, str]:
    return {
        "v03_birth_art_review": query(f"""
select g.patient_id, h.birthdate, s.start_date as art_start_date,
  {days("h.birthdate", "s.start_date")} as days_difference
from patient_state s
join patient_program g using (patient_program_id, site_id)
join person h on h.person_id = g.patient_id and h.site_id = g.site_id
join patient p on p.patient_id = g.patient_id and p.site_id = g.site_id
where s.state = 7 and s.voided = 0 and g.voided = 0 and p.voided = 0
  and h.birthdate > s.start_date"""),
        "v06_state_review": query(
            """
select patient_program_id, s.patient_state_id, patient_id, site_id,
  s.start_date as current_wrong_start_date, s.date_created, s.date_changed
from patient_state s
join patient_program using (patient_program_id, site_id)
join patient using (patient_id, site_id)
where s.state = 7 and s.voided = 0 and patient_id in (select patient_id from listed)""",
            listed=_r06(True),
        ),
        "v09_pmtct_gap": query("""
select patient_id, site_id, start_date as art_start_date,
  cast(null as int) as pmtct_program_id, cast(null as date) as pmtct_enrolment_date
from women_start c
where start_date is not null and not exists (
  from patient_program g where g.patient_id = c.patient_id and g.site_id = c.site_id
    and g.program_id = 3 and g.voided = 0)"""),
    }


def _blocks() -> dict[str, str]:
    return {
        "b1_cohort": query(
            "select * from everything",
            everything=clients(
                7,
                "h.gender, h.birthdate, h.birthdate_estimated, s.state, s.start_date,"
                " s.end_date, g.date_enrolled",
            ),
        ),
        "b2_label_obs": query(
            "select o.obs_id, o.site_id, o.concept_id, q.name as observation_question,"
            f" o.value_coded, a.name as observation_answer from obs o {LABELLED}"
        ),
        "b3_answer_source": query(
            f"select o.obs_id, o.site_id, {SOURCE} as answer_source from obs o"
        ),
        "b4_has_answer": query(f"""
select o.obs_id, o.site_id,
  cast(case when {YES} then 1 else 0 end as int) as said_yes,
  cast(case when {YES} or o.value_datetime is not null then 1 else 0 end as int) as yes_or_date,
  cast(case when {YES} or o.value_datetime is not null or o.value_numeric is not null
    then 1 else 0 end as int) as yes_or_value
from obs o"""),
        "b5_age_years": query(f"""
select e.encounter_id, e.site_id, h.birthdate, e.encounter_datetime,
  {age("h.birthdate", "e.encounter_datetime")} as age_years
from encounter e join person h on h.person_id = e.patient_id and h.site_id = e.site_id"""),
        "b6_measure_pivot": query("""
select encounter_id, site_id,
  max(value_numeric) filter (where concept_id = 5089) as weight,
  max(value_numeric) filter (where concept_id = 5090) as height_cm,
  max(value_numeric) filter (where concept_id = 2137) as bmi
from obs where voided = 0 and concept_id in (5089, 5090, 2137)
group by encounter_id, site_id"""),
        "b7_latest_obs": query("""
select person_id, concept_id, site_id, obs_id, obs_datetime from obs
qualify row_number() over (partition by person_id, concept_id
  order by obs_datetime desc, site_id, obs_id) = 1"""),
        "b8_no_height": query("""
select patient_id, site_id from everyone
where (patient_id, site_id) not in (select person_id, site_id from heights)""",
            everyone=clients(7, "")),
    }


SCANNED = "patient person patient_program patient_state encounter encounter_type obs".split()


def _scans() -> dict[str, str]:
    return {f"s{i}_{name}": query(f"select * from {name}") for i, name in enumerate(SCANNED, 1)}


# --- corrections ------------------------------------------------------------------------


def _updated(table: str, keys: str, decisions: str, guard: str, **new: str) -> str:
    """Every row of ``table``, columns replaced where a decision matches and guard holds."""
    on = " and ".join(f"t.{k} = d.{k}" for k in keys.split())
    first = keys.split()[0]
    hit = f"d.{first} is not null and ({guard})"
    changes = ", ".join(
        f"case when {hit} then {value} else t.{column} end as {column}"
        for column, value in new.items()
    )
    return query(
        f"select t.* replace ({changes}) from {table} t left join decisions d on {on}",
        decisions=decisions,
    )


def _inserted(decisions: str) -> str:
    """The observations and one more row per decision, numbered by content digest."""
    order = (
        "person_id obs_datetime encounter_id site_id value_numeric creator concept_id"
        " value_coded date_created voided"
    ).split()
    present = [c for c in order if f" as {c}" in decisions]
    content = ", ".join(f"coalesce(cast({c} as varchar), '')" for c in present)
    return query(
        f"""
select * from obs
union all by name
select (select max(obs_id) from obs) + row_number() over (
  order by md5(concat_ws('|', {content}))) as obs_id, *
from decisions""",
        decisions=decisions,
    )


def _inserted_with_ids(decisions: str, key: str) -> str:
    """The observations and a row per decision whose own id its site does not have yet."""
    return query(
        f"""
select * from obs
union all by name
select * from (
  select coalesce(if(d.{key} % 7 = 0, k.taken, null), d.{key} + 1000000000000000) as obs_id, d.*
  from decisions d left join (
    select {key}, site_id, min(obs_id) as taken from obs
    where {key} is not null group by {key}, site_id) k
  on k.{key} = d.{key} and k.site_id = d.site_id) n
where not exists (select 1 from obs o where o.obs_id = n.obs_id and o.site_id = n.site_id)""",
        decisions=decisions,
    )


def _corrections() -> dict[str, str]:
    void = {"voided": "1", "voided_by": "d.user_id", "date_voided": TODAY}
    r02, r03, r05 = _r02(True), _r03(True), _r05(True)
    live = "t.voided = 0"
    men_obs = f"""
select distinct o.obs_id, o.site_id, cast(7 as bigint) as user_id from obs o
join men c on c.patient_id = o.person_id and c.site_id = o.site_id
where o.voided = 0 and o.concept_id in {MATERNAL} and {YES}"""
    audit = f"cast(7 as bigint) as creator, {{}} {TODAY} as date_created, 0 as voided"
    height = audit.format("cast(5090 as int) as concept_id,")

    def heights(found: str) -> str:
        return (
            f"select distinct patient_id as person_id, cast({TODAY} as timestamp) as obs_datetime,"
            f" site_id as site_id, cast(150 as double) as value_numeric, {height} from ({found})"
        )

    at_visits = (
        "select distinct patient_id as person_id, visit_date as obs_datetime,"
        " encounter_id as encounter_id, site_id as site_id,"
        f" cast(120 as double) as value_numeric, {height}"
        f" from ({_r07(False)}) where height_cm is null"
    )
    last_visit = """join (
  select * from encounter where voided = 0
  qualify row_number() over (partition by patient_id, site_id
    order by encounter_datetime desc, encounter_id) = 1) e
  on e.patient_id = f.patient_id and e.site_id = f.site_id"""
    no_breastfeeding = (
        f"select distinct f.patient_id as person_id, cast({TODAY} as timestamp) as obs_datetime,"
        " e.encounter_id as encounter_id, f.site_id as site_id, "
        + audit.format("cast(7965 as int) as concept_id, cast(1066 as int) as value_coded,")
        + f" from ({_r10(True)}) f {last_visit}"
    )
    return {
        "c01_normalise_gender": query("""
select * replace (case
    when voided = 0 and gender not in ('M', 'F') and lower(gender) in ('m', 'male') then 'M'
    when voided = 0 and gender not in ('M', 'F') and lower(gender) in ('f', 'female') then 'F'
    else gender end as gender)
from person"""),
        "c02a_clear_death": _updated(
            "person",
            "person_id site_id",
            f"select distinct patient_id as person_id, site_id from ({r02})",
            live,
            death_date="null",
            dead="0",
        ),
        "c02b_void_encounter": _updated(
            "encounter",
            "encounter_id site_id",
            "select distinct encounter_id, site_id, cast(7 as bigint) as user_id"
            f" from ({r02})",
            "true",
            **void,
            void_reason=quote(tx.VOID_VISIT_REASON),
        ),
        "c03a_set_birthdate": _updated(
            "person",
            "person_id site_id",
            "select patient_id as person_id, site_id,"
            " cast(min(art_start_date) - 9000 as date) as birthdate"
            f" from ({r03}) where art_start_date is not null group by all",
            "true",
            birthdate="d.birthdate",
        ),
        "c03b_set_obs_datetime": _updated(
            "obs",
            "obs_id site_id person_id",
            "select o.obs_id, o.site_id, o.person_id,"
            " max(cast(h.birthdate as timestamp)) as obs_datetime"
            " from obs o join person h on h.person_id = o.person_id and h.site_id = o.site_id"
            " where o.obs_datetime < cast(h.birthdate as timestamp) group by all",
            live,
            obs_datetime="d.obs_datetime",
        ),
        "c04a_set_gender_f": _updated(
            "person",
            "person_id site_id",
            f"select distinct patient_id as person_id, site_id from ({_r04(True)})",
            live,
            gender="'F'",
        ),
        "c04b_void_obs": _updated(
            "obs", "obs_id site_id", men_obs, live, **void, void_reason=quote(tx.VOID_OBS_REASON)
        ),
        "c05_set_birthdate": _updated(
            "person",
            "person_id site_id",
            "select patient_id as person_id, site_id,"
            f" cast(min(obs_date) - 9000 as date) as birthdate from ({r05}) group by all",
            "true",
            birthdate="d.birthdate",
        ),
        "c06_set_state_start": _updated(
            "patient_state",
            "patient_state_id site_id",
            "select s.patient_state_id, s.site_id, date '1999-01-01' as correct_date,"
            " cast(7 as bigint) as user_id from patient_state s"
            " join patient_program g using (patient_program_id, site_id)"
            f" where (g.patient_id, g.site_id) in (select patient_id, site_id from ({_r06(True)}))",
            "t.voided = 0 and t.state = 7",
            start_date="d.correct_date",
            date_changed=TODAY,
            changed_by="d.user_id",
        ),
        **{
            f"c07a_set_obs_numeric{suffix}": _updated(
                "obs",
                keys,
                f"select distinct {keys.replace(' ', ', ')},"
                " cast(50 as double) as correct_value, cast(7 as bigint) as user_id from obs"
                " where voided = 0 and concept_id in (5089, 5090, 2137) and value_numeric is null",
                live,
                value_numeric="d.correct_value",
                date_changed=TODAY,
                changed_by="d.user_id",
            )
            for suffix, keys in (("", "obs_id"), ("_site_safe", "obs_id site_id"))
        },
        "c07b_insert_height": _inserted(heights(_r08(True))),
        "c07b_insert_height_own_ids": _inserted_with_ids(heights(_r08(True)), "person_id"),
        "c07b_insert_height_children": _inserted(heights(_r07(True))),
        "c08_insert_height_visit": _inserted(at_visits),
        "c08_insert_height_visit_own_ids": _inserted_with_ids(at_visits, "encounter_id"),
        "c08_insert_height_adults": _inserted(
            "select distinct f.patient_id as person_id, e.encounter_datetime as obs_datetime,"
            " e.encounter_id as encounter_id, f.site_id as site_id,"
            f" cast(150 as double) as value_numeric, {height}"
            f" from ({_r08(True)}) f {last_visit}"
        ),
        "c10_insert_bf_no": _inserted(no_breastfeeding),
        "c10_insert_bf_no_own_ids": _inserted_with_ids(no_breastfeeding, "person_id"),
    }


# --- findings after the registry's change set ---------------------------------------


def _changed(sql: str) -> str:
    """A rule's SQL over the tables after the change set: both changed tables wrap the originals."""
    ctes = fixture_ctes()
    person, obs = ctes["person"].strip(), ctes["obs"].strip()
    people = (
        "select * replace (case when person_id % 37 = 0 then 'X' else gender end as gender,"
        " case when person_id % 37 = 0 then birthdate + 400 else birthdate end as birthdate)"
        f" from ({person}) base"
    )
    facts = f"select * replace (case when person_id % 29 = 0 then 1 else voided end as voided) from ({obs}) base"
    return sql.replace(f"person as materialized ({person})", f"person as materialized ({people})").replace(
        f"obs as materialized ({obs})", f"obs as materialized ({facts})"
    )


def _deltas() -> dict[str, str]:
    out = {}
    for name, sql in _rules().items():
        if not name.endswith("_cen"):
            continue
        out[f"{name}_delta"] = f"""
with old_findings as ({sql}), new_findings as ({_changed(sql)})
select *, 'new' as change from (select * from new_findings except all select * from old_findings) a
union all
select *, 'cleared' as change from (select * from old_findings except all select * from new_findings) b
union all
select *, 'unchanged' as change from (select * from new_findings intersect all select * from old_findings) c
"""
    return out


# --- decision log with history ------------------------------------------------------

_LOG = """
select person_id, site_id, birthdate - 1 as birthdate, date '2001-01-10' as decided_on, 1 as seq
from person where person_id % 5 = 0
union all
select person_id, site_id, birthdate + 30, date '2001-02-01', 2 from person where person_id % 10 = 0
union all
select person_id, site_id, birthdate + 60, date '2001-02-01', 1 from person where person_id % 20 = 0
union all
select person_id, site_id, birthdate + 30, date '2001-02-01', 2 from person where person_id % 40 = 0
"""
_DECIDED = """
select distinct * from log
where person_id is not null and site_id is not null and decided_on is not null and seq is not null
"""
_KNOWN = """
select person_id, site_id, birthdate from (
    select *, row_number() over (partition by person_id, site_id
        order by decided_on desc, seq desc, birthdate desc nulls last) as n
    from decided where decided_on <= date '2001-02-15')
where n = 1
"""


def _history() -> dict[str, str]:
    versions = query(
        """
select person_id, site_id, birthdate, decided_on as valid_from, valid_to from (
    select *, lead(decided_on) over (partition by person_id, site_id
        order by decided_on, seq, birthdate nulls first) as valid_to
    from decided)
where valid_to is null or valid_to > valid_from
""",
        log=_LOG,
        decided=_DECIDED,
    )
    known = query(_KNOWN, log=_LOG, decided=_DECIDED)
    as_known = _updated("person", "person_id site_id", known, "true", birthdate="d.birthdate")
    return {"h01_birthdate_versions": versions, "h02_birthdate_known_on": known, "h03_birthdates_as_known": as_known}


# --- order as a column ----------------------------------------------------------------


def _positions() -> dict[str, str]:
    rules = _rules()
    columns = {
        "r01_gender_det": "patient_id, gender, site_id",
        "r01_gender_cen": "patient_id, site_id, gender, DQ_flag, kahn_category, severity",
        "r02_visit_after_death_cen": "patient_id, site_id, death_start_date, encounter_id, encounter_date,"
        " encounter_type, days_after_death, DQ_flag, kahn_category, severity",
        "r07_peds_missing_vitals_cen": "patient_id, site_id, encounter_id, visit_date, birthdate, age_at_visit,"
        " weight, height_cm, bmi, DQ_flag, kahn_category, severity",
        "r04_male_pregnancy_det": "patient_id, site_id, concept_id, observation_question, obs_datetime, value_coded,"
        " observation_answer, obs_answer_text, answer_source",
    }

    def at(key: str, order: str, drop: str = "") -> str:
        ties = ", ".join(f"{c.strip()} nulls first" for c in (order + ", " + columns[key]).split(","))
        shown = "* exclude (" + drop + ")" if drop else "*"
        return f"""
select {shown}, row_number() over (order by {ties}) as position from ({rules[key]})
"""

    return {
        "o1_by_patient": at("r01_gender_det", "patient_id"),
        "o2_by_site_patient": at("r01_gender_cen", "site_id, patient_id"),
        "o3_by_encounter_date": at("r02_visit_after_death_cen", "encounter_date"),
        "o4_by_unshown_visit": at("r07_peds_missing_vitals_cen", "site_id, encounter_id", "encounter_id"),
        "o5_by_patient_time": at("r04_male_pregnancy_det", "patient_id, obs_datetime"),
    }


def oracle_sql() -> dict[str, str]:
    return {**_rules(), **_reviews(), **_blocks(), **_scans(), **_corrections(), **_deltas(), **_history(), **_positions()}
