"""Only the files that hold decided rows are rewritten, and the table equals the update."""

import os
from collections import Counter

from conftest import SF
from pyspark.sql import functions as F

from checks.fixture import CONFIG, record_tables
from clinsift import corrections
from clinsift.sources.sinks import rewrite_files, touched_files


def listing(folder):
    out = {}
    for place, _, names in os.walk(folder):
        for name in names:
            if name.endswith(".parquet"):
                full = os.path.join(place, name)
                out[full] = (os.path.getsize(full), os.path.getmtime(full))
    return out


def test_touched_files_only(spark, tmp_path):
    tables = record_tables(spark, SF)
    path = str(tmp_path / "person")
    tables.person.repartition(6, "person_id").write.partitionBy("site_id").parquet(path)
    decisions = (
        tables.person.where(F.col("person_id") % 53 == 0)
        .select("person_id", "site_id", F.lit("1960-02-29").alias("birthdate"))
        .unionByName(spark.createDataFrame([(None, 1, "1970-01-01")], "person_id bigint, site_id int, birthdate string"))
    )
    fix = lambda rows: corrections.set_birthdate(rows, decisions, CONFIG)
    whole = spark.read.parquet(path)
    expected = Counter(map(str, fix(whole).select(*whole.columns).collect()))
    before = listing(path)

    files = touched_files(spark, path, decisions, ["person_id", "site_id"])
    assert 0 < len(files) < len(before)
    new = rewrite_files(spark, path, files, fix)
    after = listing(path)

    gone = {f.replace("file:", "") for f in files}
    for name, stamp in before.items():
        if name in gone:
            assert name not in after
        else:
            assert after[name] == stamp  # untouched files stay as they were
    assert {f.replace("file:", "") for f in new} == set(after) - set(before)
    assert Counter(map(str, spark.read.parquet(path).select(*whole.columns).collect())) == expected
    assert not any(d.startswith("_rewrite") for d in os.listdir(path))
    assert rewrite_files(spark, path, [], fix) == []
