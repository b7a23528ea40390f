"""Every registered query against its SQL in DuckDB, value by value."""

import pytest
from conftest import SF

from checks.compare import connect, difference
from checks.oracle import oracle_sql
from checks.registry import queries

QUERIES, ORACLE = queries(), oracle_sql()

# row counts measured when the fixture was designed
KNOWN_ROWS = {
    "r01_gender_det": 188,
    "r01_gender_cen": 251,
    "r02_visit_after_death_det": 2134,
    "r02_visit_after_death_cen": 520,
    "r03_art_before_birth_cen": 154,
    "r04_male_pregnancy_det": 2409,
    "r06_art_date_implausible_det": 181,
    "r07_peds_missing_vitals_det": 3307,
    "r07_peds_missing_vitals_cen": 3298,
    "r08_adult_no_height_cen": 14,
    "r09_pregnant_at_art_start_det": 35,
    "r09_pregnant_at_art_start_cen": 96,
    "r10_breastfeeding_cen": 257,
    "r10_breastfeeding_cen_site_safe": 480,
    "v09_pmtct_gap": 393,
}


@pytest.fixture(scope="module")
def duck():
    con = connect(SF)
    yield con
    con.close()


def test_every_query_has_an_oracle():
    assert QUERIES.keys() == ORACLE.keys()


@pytest.mark.parametrize("name", QUERIES)
def test_same_values(spark, duck, name):
    assert difference(QUERIES[name](spark, SF), duck, ORACLE[name]) is None


@pytest.mark.parametrize("name", KNOWN_ROWS)
def test_known_row_counts(duck, name):
    assert duck.execute(f"select count(*) from ({ORACLE[name]})").fetchone()[0] == KNOWN_ROWS[name]


CHANGED = {
    "c01": "person",
    "c02a": "person",
    "c02b": "encounter",
    "c03a": "person",
    "c04a": "person",
    "c05": "person",
    "c06": "patient_state",
}  # all others change obs


@pytest.mark.parametrize("name", [n for n in QUERIES if n[0] == "c"])
def test_corrections_do_change_something(duck, name):
    table = CHANGED.get(name.split("_")[0], "obs")
    scan = next(sql for key, sql in ORACLE.items() if key[0] == "s" and key.endswith("_" + table))
    changed = f"(select * from ({ORACLE[name]})) except (select * from ({scan}))"
    assert duck.execute(f"select count(*) from ({changed})").fetchone()[0] > 0
