import hashlib
import random
import re

import pytest

from clinsift.llm.exact_dedup import exact_groups, keep_first


def brute(rows):
    groups = {}
    for d, t in rows:
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]", "", t or ""), []).append((-len(t or ""), 1 << 63 if d is None else d, d))
    out = []
    for d, t in rows:
        key = re.sub(r"[\x20\x09-\x0D]", "", t or "")
        out.append((d, min(groups[key])[2], len(groups[key]), hashlib.sha256(key.encode()).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize("parts", [1, 7])
def test_against_groups_in_memory(spark, parts):
    r = random.Random(parts)
    texts = ["same text here", "x" * 200, "x" * 200 + "y", "é a b", "", None, " \t", "z" * 50_000]
    rows = [(i, r.choice(texts[:3] * 8 + texts)) for i in range(400)]
    rows = [(d, t.replace(" ", r.choice([" ", "\n ", ""])) if t and len(t) < 99 else t) for d, t in rows]
    rows += rows[:5] + [(None, "same text here"), (None, "only null")]
    df = spark.createDataFrame([(*x, "k") for x in rows], "doc_id long, text string, kept string").repartition(3)
    spark.conf.set("spark.sql.shuffle.partitions", str(parts))
    try:
        got = exact_groups(df).collect()
        left = keep_first(df).collect()
        assert exact_groups(df.limit(0)).count() == 0 == keep_first(df.limit(0)).count()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert sorted(((x.doc_id, x.keep_id, x.group_size, x.text_sha256) for x in got), key=str) == brute(rows)
    kept = [x for x in got if x.kept]
    assert len(kept) == len({x.text_sha256 for x in got}) == len(left)
    assert all(x.doc_id == x.keep_id for x in kept)
    assert sorted((x.doc_id for x in left), key=str) == sorted((x.doc_id for x in kept), key=str)
