"""Registered queries against their SQL, and the pipeline's stages."""

import hashlib
import os
import re
import sys

import duckdb
import numpy as np
import pandas as pd
import public_tokenizers
import pytest
from test_simhash import classes as near_classes
from test_simhash import slow_fingerprint

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

import corpus_pipeline
from checks.compare import connect, difference
from clinsift.llm.oracle import oracle_sql
from clinsift.llm.piece_scan import Pieces
from clinsift.llm.quality import rank_quality
from clinsift.llm.queries import queries

SMALL = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def duck():
    con = connect(SMALL)
    yield con
    con.close()


@pytest.mark.parametrize("name", oracle_sql())
def test_same_values_as_sql(spark, duck, name):
    assert difference(queries()[name](spark, SMALL), duck, oracle_sql()[name]) is None


def test_thirteen_operators_and_five_stages():
    assert sorted(int(n[2:].split("_")[0]) for n in queries()) == list(range(1, 14))
    assert len(corpus_pipeline.STAGES) == 5


def test_stages_keep_columns_and_take_effect(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    before, columns = docs.count(), docs.columns
    counts = []
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SMALL)
        assert docs.columns == columns
        docs = spark.createDataFrame(docs.collect(), docs.schema)
        counts.append(docs.count())
    assert before > counts[0] > counts[1] >= counts[2] >= counts[3] > 0
    last = corpus_pipeline.STAGES[-1][1](spark, docs, SMALL)
    assert {r.doc_id for r in last.collect()} == {r.doc_id for r in docs.collect()}


@pytest.mark.parametrize("rows", [[], [(None, None, None, None, None)] * 2 + [(1, "", "en", "s", 0), (1, "", "en", "s", 0), (2, "a " * 40_000, None, "s", None)]])
def test_stages_stand_empty_tables_nulls_and_long_texts(spark, rows):
    docs = spark.createDataFrame(rows, DOCS)
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SMALL)
        docs = spark.createDataFrame(docs.collect(), docs.schema)
    assert docs.count() <= len(rows)


def test_pipeline_against_plain_python(spark):
    """All five stages over the small tables; only the classifier's scores are taken from Spark."""
    documents = spark.read.parquet(f"{SMALL}/documents.parquet")
    scores = rank_quality(documents, spark.read.parquet(f"{SMALL}/labels.parquet")).collect()
    good = {r.doc_id for r in scores if r.predicted}
    texts = {r.doc_id: r.text for r in documents.collect() if r.doc_id in good}

    copies = {}
    for d, t in texts.items():
        copies.setdefault(re.sub(r"[\x20\x09-\x0D]", "", t), []).append((-len(t), d))
    texts = {d: texts[d] for d in (min(group)[1] for group in copies.values())}

    classes = near_classes({d: slow_fingerprint(t) for d, t in texts.items()})
    texts = {d: t for d, t in texts.items() if classes[d] == d}

    con = duckdb.connect()
    con.register("documents", pd.DataFrame({"doc_id": list(texts), "text": list(texts.values())}))
    con.execute(f"create view benchmark as select * from '{SMALL}/benchmark.parquet'")
    leaks = {row[0] for row in con.execute(oracle_sql()["op3_decontaminate"]).fetchall()}
    con.close()
    assert leaks and len(texts) > 50
    texts = {d: t for d, t in texts.items() if d not in leaks}

    pieces = Pieces(public_tokenizers.path("piece_bpe_32k.model"))
    want = {d: np.frombuffer(pieces.encode(t), "<i4").tolist() for d, t in texts.items()}
    got = corpus_pipeline.run(spark, SMALL).collect()
    assert {r.doc_id: r.ids for r in got} == want
    assert all(r.n_ids == len(r.ids) for r in got)
    assert all(r.text_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest() for r in got)
