import os
import shutil
import subprocess
import sys
from datetime import date

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from conftest import AS_OF, values
from pyspark.sql import functions as F

from clinsift import corrections, read_catalog, read_parquet, run_rule, write_version
from clinsift.sources import SCHEMAS, TABLES, replace_partitions, stage, stage_dir
from clinsift.sources.schemas import AUDIT_COLUMNS, ddl

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


@pytest.fixture
def stored(clinic, tmp_path):
    for number, site in [(1, 1), (2, 1), (1, 2)]:
        clinic.client(number, site=site, gender="male", birthdate=date(2000, 1, 1))
    t = clinic.tables()
    for table in TABLES:
        df = getattr(t, table)
        by = ["site_id"] if "site_id" in df.columns else []
        write_version(df, f"{tmp_path}/{table}.parquet", by)
    return str(tmp_path)


def test_read_back_and_run(spark, stored, cfg):
    t = read_parquet(spark, stored)
    assert os.path.isdir(f"{stored}/person.parquet/site_id=2")
    found = run_rule("r01_gender", t, cfg, as_of=AS_OF)
    assert values(found, "patient_id", "site_id") == [(1, 1), (1, 2), (2, 1)]


def test_extra_columns_can_be_declared(spark, stored):
    person = read_parquet(spark, stored).person.withColumn("uuid", F.lit("u"))
    shutil.copytree(stored, f"{stored}/more", ignore=shutil.ignore_patterns("person.parquet"))
    stored = f"{stored}/more"
    write_version(person, f"{stored}/person.parquet")
    t = read_parquet(spark, stored, {"person": {"uuid": "string"}})
    assert dict(t.person.dtypes)["uuid"] == "string"


def test_version_folder_is_never_overwritten(spark, stored):
    with pytest.raises(Exception, match="already exists"):
        write_version(spark.range(1).withColumn("site_id", F.lit(1)), f"{stored}/person.parquet")


def test_only_decided_sites_are_swapped(spark, stored, cfg):
    path = f"{stored}/person.parquet"
    before = sorted(os.listdir(f"{path}/site_id=1"))  # file names are unique per write
    person = read_parquet(spark, stored).person
    decisions = spark.createDataFrame([(1, 2)], "person_id bigint, site_id int")
    part = corrections.at_decided_sites(person, decisions)
    replace_partitions(corrections.set_gender_female(part, decisions, cfg), path)
    again = read_parquet(spark, stored).person
    assert values(again, "person_id", "site_id", "gender") == [
        (1, 1, "male"), (1, 2, "F"), (2, 1, "male"),
    ]
    assert sorted(os.listdir(f"{path}/site_id=1")) == before


def test_catalogue(spark, clinic, cfg):
    clinic.client(1, gender=None)
    t = clinic.tables()
    for table in TABLES:
        getattr(t, table).createOrReplaceTempView(table)
    found = run_rule("r01_gender", read_catalog(spark), cfg, as_of=AS_OF)
    assert values(found, "patient_id") == [1]
    for table in TABLES:
        spark.catalog.dropTempView(table)


def test_stage_uses_the_shared_folder(spark):
    df = spark.createDataFrame([(1, "a"), (2, None)], "n int, s string")
    staged = stage(df, "letters", ["s"])
    assert staged.dtypes == df.dtypes
    assert values(staged, "n", "s") == [(1, "a"), (2, None)]
    assert all(f"{stage_dir(spark)}/staged-" in f for f in staged.inputFiles())


def test_stage_folder_from_the_session(tmp_path):
    code = f"""
from pyspark.sql import SparkSession
from clinsift.sources import stage_dir
spark = (SparkSession.builder.master("local[1]").config("spark.ui.enabled", "false")
         .config("spark.checkpoint.dir", "{tmp_path}").getOrCreate())
assert stage_dir(spark) == "{tmp_path}", stage_dir(spark)
"""
    done = subprocess.run([sys.executable, "-c", code], cwd=ROOT, capture_output=True, timeout=120)
    assert done.returncode == 0, done.stderr[-800:]


def test_no_stage_without_a_shared_folder():
    class Unset:
        class conf:
            @staticmethod
            def get(name, default):
                return default

    with pytest.raises(ValueError, match="checkpoint"):
        stage_dir(Unset)


REQUIRED = [(t, c) for t in TABLES for c in SCHEMAS[t] if c not in AUDIT_COLUMNS]


@pytest.fixture(scope="module")
def record_folder(spark, tmp_path_factory):
    """Empty tables with all columns; a test writes one of them again with one less."""
    folder = str(tmp_path_factory.mktemp("all_columns"))
    for table in TABLES:
        spark.createDataFrame([], ddl(SCHEMAS[table])).write.parquet(f"{folder}/{table}.parquet")
    return folder


@pytest.mark.parametrize(("table", "column"), REQUIRED)
def test_a_missing_column_stops_the_reader(spark, record_folder, tmp_path, table, column):
    for t in TABLES:
        os.symlink(f"{record_folder}/{t}.parquet", f"{tmp_path}/{t}.parquet")
    os.unlink(f"{tmp_path}/{table}.parquet")
    lacking = pa.schema([pa.field(c, pa.string()) for c in SCHEMAS[table] if c != column])
    if len(column) % 2:  # a file, or a folder of files
        pq.write_table(lacking.empty_table(), f"{tmp_path}/{table}.parquet")
    else:
        os.mkdir(f"{tmp_path}/{table}.parquet")
        pq.write_table(lacking.empty_table(), f"{tmp_path}/{table}.parquet/part-0.parquet")
    with pytest.raises(ValueError, match=f"{table} .*{column}"):
        read_parquet(spark, str(tmp_path))


def test_audit_columns_and_site_folders_may_be_there_or_not(spark, record_folder, tmp_path):
    for t in TABLES:
        os.symlink(f"{record_folder}/{t}.parquet", f"{tmp_path}/{t}.parquet")
    os.unlink(f"{tmp_path}/obs.parquet")
    kept = {c: k for c, k in SCHEMAS["obs"].items() if c not in AUDIT_COLUMNS}
    rows = spark.createDataFrame([], ddl(kept)).unionByName(
        spark.sql("select 1L obs_id, 7 site_id"), allowMissingColumns=True
    )
    rows.write.partitionBy("site_id").parquet(f"{tmp_path}/obs.parquet")
    t = read_parquet(spark, str(tmp_path))
    assert set(t.obs.columns) == set(kept)
    assert values(t.obs, "obs_id", "site_id") == [(1, 7)]
    with pytest.raises(ValueError, match="uuid"):
        read_parquet(spark, str(tmp_path), {"obs": {"uuid": "string"}})


def test_import_and_oracle_need_no_session():
    code = (
        "import __spark_entry__ as e; from checks import registry;"
        "q, o = set(e.queries()), set(e.oracle_sql());"
        "assert o <= q and set(registry.queries()) <= o"
    )
    done = subprocess.run([sys.executable, "-c", code], cwd=ROOT, capture_output=True, timeout=60)
    assert done.returncode == 0, done.stderr[-800:]
