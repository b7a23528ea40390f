import random

import duckdb
import pandas as pd

from clinsift.llm.divergence import divergence
from clinsift.llm.oracle import oracle_sql

KEY = ["lang", "source", "part", "item"]


def oracle(rows):
    con = duckdb.connect()
    con.register("documents", pd.DataFrame(rows, columns=["doc_id", "text", "lang", "source"]))
    return con.execute(oracle_sql()["op13_divergence"]).df()


def same(spark, rows, **kw):
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    got = divergence(df, **kw).toPandas().sort_values(KEY).reset_index(drop=True)
    want = oracle(rows).sort_values(KEY).reset_index(drop=True)
    assert got[KEY + ["value", "rank"]].values.tolist() == want[KEY + ["value", "rank"]].values.tolist()
    return got


def test_against_sql_on_random_texts(spark):
    r = random.Random(2)
    words = ["a", "b", "Cc", "cc", "dé", "é", "x1y", "ÄB", "the", "and", "zz", "Q"]
    rows = [
        (i, " ".join(r.choice(words) for _ in range(r.randrange(0, 30))), r.choice(["en", "fr", None]), r.choice(["s1", "s2", "s3", None, "s4"]))
        for i in range(200)
    ]
    got = same(spark, rows)
    assert {"pair", "term"} == set(got.part)


def test_defined_cases(spark):
    rows = [
        (1, None, None, None), (2, "only here", "xx", "a"), (2, "only here", "xx", "a"),  # repeated rows: two documents
        (3, "word word", "en", "s"), (4, "word", "en", "s"), (5, "word other", "en", "t"), (6, "", "en", "u"),
        (7, "!!! 123", "en", "v"), (8, "word", "solo", "one"),
    ]
    got = same(spark, rows)
    # a source without kept terms has its pairs; a lang without kept terms has values 0; a lone source no pairs
    assert set(got[(got.lang == "en") & (got.source == "u")].item) == {"s", "t", "v"}
    assert (got[got.lang == "xx"].value == 0).all() and not len(got[got.lang == "solo"])


def test_top_and_empty(spark):
    r = random.Random(5)
    rows = [(i, " ".join("w" + chr(97 + r.randrange(26)) + chr(97 + r.randrange(26)) for _ in range(60)), "en", f"s{i % 3}") for i in range(120)]
    got = same(spark, rows, top=200)
    assert got[got.part == "term"].groupby("source")["rank"].max().max() <= 200
    empty = spark.createDataFrame([], "doc_id long, text string, lang string, source string, v int, tid string")
    assert divergence(empty).collect() == []


def test_counts_of_many_flushes_meet_and_sources_meet_once(spark, monkeypatch):
    # tasks pass their counts on in parts; each two sources are joined in one direction only
    import pyarrow as pa

    from clinsift.llm import divergence as module

    monkeypatch.setattr(module, "_HELD", 3)
    table = pa.RecordBatch.from_pydict(
        {"lang": ["en"] * 3 + ["fr"], "source": ["s", "t", "s", "s"], "text": ["Ab ab É1é", "ab x y z", "AB\x00cd_漢字", ""]}
    )
    parts = [row for b in module._count(iter([table])) for row in b.to_pylist()]
    sums = {}
    for row in parts:
        n, d = sums.get(key := (row["lang"], row["source"], row["term"]), (0, 0))
        sums[key] = (n + row["count"], d + row["docs"])
    assert len(parts) > len(sums)
    assert sums == {
        ("en", "s", "ab"): (3, 2), ("en", "s", "É"): (1, 1), ("en", "s", "é"): (1, 1), ("en", "t", "ab"): (1, 1), ("en", "t", "x"): (1, 1),
        ("en", "t", "y"): (1, 1), ("en", "t", "z"): (1, 1), ("en", "s", "cd"): (1, 1), ("en", "s", "漢字"): (1, 1),
    }
    rows = [(i, "a b c a", "en", f"s{i % 4}") for i in range(12)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    plan = divergence(df)._jdf.queryExecution().optimizedPlan().toString()
    # words without a common term leave in the join, before any weight is computed
    assert any("Join Inner" in line and "bits" in line and " < " in line for line in plan.split("\n"))
    same(spark, rows)
