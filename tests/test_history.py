"""Versions folded from a decision log: any batch order, ties and repeats give one result."""

import random
from datetime import date

from clinsift.plans.history import known_on, versions

SCHEMA = "person_id bigint, site_id int, birthdate date, decided_on date, seq long"
KEYS, VALUES = ["person_id", "site_id"], ["birthdate"]


def log_rows():
    r = random.Random(3)
    rows = []
    for _ in range(300):
        rows.append((r.randrange(6), r.randrange(1, 3), date(1990, 1, 1 + r.randrange(5)) if r.random() > 0.1 else None,
                     date(2001, 1, 1 + r.randrange(6)), r.randrange(3)))
    rows += [(None, 1, date(1990, 1, 1), date(2001, 1, 1), 0), (1, 1, date(1990, 1, 1), None, 0)]
    return rows


def plain_versions(rows):
    """Every decision against every other, in Python."""
    good = sorted({r for r in rows if None not in (r[0], r[1], r[3], r[4])}, key=lambda r: (r[3], r[4], r[2] is not None, r[2] or date.min))
    out = []
    for n, r in enumerate(good):
        after = [x for x in good[n + 1 :] if x[:2] == r[:2]]
        until = after[0][3] if after else None
        if until is None or until > r[3]:
            out.append((r[0], r[1], r[2], r[3], until))
    return sorted(out, key=str)


def test_versions_in_any_batch_order(spark):
    rows = log_rows()
    want = plain_versions(rows)
    for seed in range(3):
        shuffled = rows[:]
        random.Random(seed).shuffle(shuffled)
        batches = [shuffled[i::3] for i in range(3)] + [shuffled[:50]]  # one batch replayed
        log = spark.createDataFrame(batches[0], SCHEMA)
        for batch in batches[1:]:
            log = log.unionByName(spark.createDataFrame(batch, SCHEMA))
        got = sorted((tuple(r) for r in versions(log, KEYS, VALUES).collect()), key=str)
        assert got == want


def test_known_on_is_the_version_in_force(spark):
    rows = log_rows()
    log = spark.createDataFrame(rows, SCHEMA)
    for day in (date(2000, 12, 31), date(2001, 1, 3), date(2001, 1, 6)):
        got = sorted((tuple(r) for r in known_on(log, KEYS, VALUES, day).collect()), key=str)
        want = sorted(((v[0], v[1], v[2]) for v in plain_versions(rows) if v[3] <= day and (v[4] is None or v[4] > day)), key=str)
        assert got == want


def test_empty_log(spark):
    log = spark.createDataFrame([], SCHEMA)
    assert versions(log, KEYS, VALUES).collect() == [] and known_on(log, KEYS, VALUES, date(2001, 1, 1)).collect() == []
