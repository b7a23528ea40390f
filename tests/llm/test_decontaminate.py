import itertools
import random

import pytest
from pyspark.sql import functions as F

from clinsift.llm.decontaminate import MASKS, SPAN, keep_clean, overlaps


def test_every_tolerated_substitution_leaves_a_seed():
    for n in range(5, 16):
        for k in range(n // 5 + 1):
            for gone in itertools.combinations(range(n), k):
                assert any(
                    all(at + i < n and at + i not in gone for i in mask)
                    for at in range(n)
                    for mask in MASKS
                ), (n, gone)


def brute(docs, items, window=13):
    out = {}
    for d, t in docs:
        w = (t or "").lower().split()
        for i, x in items:
            v = (x or "").lower().split()
            size = min(window, len(v))
            if size == 0:
                continue
            best = 0
            for at in range(1 - len(v), len(w)):
                same = [0 <= at + k < len(w) and w[at + k] == v[k] for k in range(len(v))]
                best = max(best, *(sum(same[s : s + size]) for s in range(len(v) - size + 1)))
            if best * 5 >= size * 4:
                out[d, i] = max(best, out.get((d, i), 0))
    return out


@pytest.mark.parametrize("block", [7, 100_000])
def test_against_all_alignments(spark, block):
    r = random.Random(block)
    word = lambda: "".join(r.choice("abcd") for _ in range(r.randrange(1, 3)))
    items = [(i, " ".join(word() for _ in range(r.choice([1, 2, 3, 4, 5, 6, 9, 12, 13, 14, 30])))) for i in range(14)]
    docs = []
    for d in range(70):
        words = [word() for _ in range(r.randrange(0, 40))]
        cut = r.choice(items)[1].split(" ")
        a = r.randrange(len(cut))
        cut = cut[a : a + r.randrange(1, 30)]
        for k in range(len(cut)):
            if r.random() < 0.15:
                cut[k] = "new"
        at = r.randrange(len(words) + 1)
        docs.append((d, " ".join(words[:at] + cut + words[at:]).upper()))
    docs += [(90, None), (91, ""), (92, "..."), (None, items[-1][1])]
    df = spark.createDataFrame([(*x, 1) for x in docs] * 2, "doc_id long, text string, item_id int")
    bench = spark.createDataFrame(items + items[:2] + [(99, None)], "item_id long, text string")
    got = {(x.doc_id, x.item_id): x.matched for x in overlaps(df, bench, block=block).collect()}
    assert got == brute(docs, items) and got
    clean = {x.doc_id for x in keep_clean(df, bench).collect()}
    assert clean == {d for d, _ in docs} - {d for d, _ in got}
    assert overlaps(df.limit(0), bench).count() == overlaps(df, bench.limit(0)).count() == 0
    assert SPAN == 5


def test_keep_clean_by_row_with_clashing_columns(spark):
    item = "one two three four five six seven eight nine ten"
    bench = spark.createDataFrame([(1, item)], "item_id long, text string")
    rows = [
        (None, "here is " + item, 1, "a"), (None, "nothing to see", 2, "b"),  # null ids: judged row by row
        (7, item, 3, "c"), (7, "clean words only", 4, "d"),  # a repeated id
        (8, "clean", 5, "e"), (8, "clean", 5, "e"),  # repeated rows stay together
    ]
    df = spark.createDataFrame(rows, "doc_id long, text string, _row long, _leak string")
    for extra in ("_row0", "id", "w", "key"):
        df = df.withColumn(extra, F.lit(1))
    kept = keep_clean(df, bench)
    assert kept.columns == df.columns
    assert sorted(r._row for r in kept.collect()) == [2, 4, 5, 5]
