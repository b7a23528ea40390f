"""Global positions by range partitions equal a sort of all rows."""

import random

from clinsift.operators.positions import with_position


def test_positions_equal_a_full_sort(spark):
    r = random.Random(1)
    rows = [(r.choice([None, 1, 2, 3]), r.choice([None, "a", "b"]), r.randrange(5)) for _ in range(500)]
    rows += rows[:40]  # identical rows
    df = spark.createDataFrame(rows, "k int, s string, v int")
    key = lambda t: tuple((x is not None, x) for x in t)  # noqa: E731 - NULL first
    want = sorted(rows, key=lambda t: (key(t[:2]), key(t)))
    for parts in (1, 7, 2000):
        got = [tuple(x) for x in with_position(df, ["k", "s"], parts=parts).collect()]
        assert sorted(p for *_, p in got) == list(range(1, len(rows) + 1))
        by_place = [tuple(row) for *row, _ in sorted(got, key=lambda x: x[-1])]
        assert by_place == want


def test_empty(spark):
    df = spark.createDataFrame([], "k int")
    assert with_position(df, ["k"]).collect() == []
