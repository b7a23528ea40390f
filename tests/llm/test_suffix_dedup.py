import random

import numpy as np
import pandas as pd
import pytest

from clinsift.llm import suffix_dedup
from clinsift.llm.suffix_dedup import front_code, front_decode, merge, remove_repeats


def brute(rows, n):
    first = {}
    for d, t in rows:
        raw = (t or "").encode()
        for p in range(len(raw) - n + 1):
            w = raw[p : p + n]
            first[w] = min(first.get(w, 1 << 64), 1 << 63 if d is None else d)
    out = []
    for d, t in rows:
        raw = (t or "").encode()
        gone = bytearray(len(raw))
        for p in range(len(raw) - n + 1):
            if first[raw[p : p + n]] < (1 << 63 if d is None else d):
                gone[p : p + n] = b"\1" * n
        kept = bytes(x for x, g in zip(raw, gone, strict=True) if not g)
        spans = sum(1 for i, g in enumerate(gone) if g and not (i and gone[i - 1]))
        out.append((d, len(raw), len(raw) - len(kept), spans, kept))
    return sorted(out, key=str)


def passages():
    r = random.Random(5)
    base = ["".join(r.choice("abcdé ") for _ in range(400)) for _ in range(6)]
    rows = []
    for _ in range(150):
        text = ""
        for _ in range(r.randrange(5)):
            at = r.randrange(300)
            text += r.choice(base)[at : at + r.randrange(20, 200)]
            text += "".join(r.choice("xyz") for _ in range(r.choice([0, 0, 9])))
        rows.append((r.randrange(120), text))
    rows += [(500, "a" * 300), (501, "a" * 120), (502, "ab" * 100), (503, "ba" * 80), (None, "a" * 60)]
    return rows + rows[:4] + [(504, None), (505, ""), (7, "q" * 49), (506, "long " * 9000)]


@pytest.mark.parametrize(
    ("length", "gram", "more"),
    [(50, 24, {}), (50, 24, {"block": 700, "run_bytes": 3000}), (50, 16, {"block": 5000, "run_bytes": 3000, "hot": 3}), (20, 20, {})],
)
def test_against_all_windows(spark, length, gram, more):
    rows = passages()
    df = spark.createDataFrame([(*x, "k") for x in rows], "doc_id long, text string, kept string").repartition(5)
    got = [tuple(r) for r in remove_repeats(df, length, gram, **more).collect()]
    assert sorted(((*r[:4], bytes(r[4])) for r in got), key=str) == brute(rows, length)
    assert sum(r[2] for r in got) > 10_000


def test_empty_table(spark):
    assert remove_repeats(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_front_coded_runs_merge_in_order():
    r = random.Random(9)
    word = lambda: bytes(r.choice(b"\0ab") for _ in range(r.randrange(0, 12)))
    for k in (1, 2, 3, 5, 8):
        runs = [sorted(word() for _ in range(r.randrange(0, 40))) for _ in range(k)]
        coded = [front_decode(front_code(run)) for run in runs]
        assert [c[0] for c in coded] == runs
        merged = list(merge(coded))
        assert [m[0] for m in merged] == sorted(x for run in runs for x in run)
        for (a, *_), (b, shared, run, at) in zip(merged, merged[1:], strict=False):
            same = next((i for i, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), min(len(a), len(b)))
            assert shared == same and runs[run][at] == b


def test_answers_are_a_row_per_run_however_many_documents_share_keys():
    r = random.Random(4)
    keys = sorted(bytes(r.choice(b"abcdef") for _ in range(50)) + b"\0\1" for _ in range(60))
    rows = []
    for run in (7, 8, 9):
        ids = np.arange(60) + 1000 * run
        sent = np.array([(d, -d, 5, 1, s) for s, d in enumerate(ids.tolist())], suffix_dedup._SENT)
        rows.append((run, front_code(keys), suffix_dedup._pack(ids.astype("<i8")), suffix_dedup._pack(sent), None))
    settled = np.array([(8010, -8010, 90, 2), (8010, -8010, 95, 1)], suffix_dedup._GONE)
    rows.append((8, None, None, None, suffix_dedup._pack(settled)))
    group = pd.DataFrame(rows, columns=["run", "keys", "ids", "sent", "gone"])
    told = suffix_dedup._answers(50, 24)(group)
    assert len(told) <= len(group) and set(told["run"]) == {8, 9}  # the first run has the smallest ids
    found = suffix_dedup._by_document(told[told["run"] == 8])
    assert found["id"].tolist() == list(range(8000, 8060)) and found["key"].tolist() == [-x for x in found["id"]]
    spans = {i: np.frombuffer(x, suffix_dedup._RANGE).tolist() for i, x in zip(found["id"], found["ranges"], strict=True)}
    assert sorted(spans[8010]) == [(5, 1), (90, 2), (95, 1)] and spans[8011] == [(5, 1)]


def test_anchors_are_dealt_evenly(spark):
    r = random.Random(8)
    rows = [(i, i, "".join(r.choice("abcdefghijklmnop ") for _ in range(4000))) for i in range(60)]
    runs = spark.createDataFrame(rows, "id long, key long, text string").mapInArrow(
        suffix_dedup._anchor_runs(50, 24, 40, 1 << 20),
        "part int, run long, kind int, hashes binary, docs binary, counts binary, occ binary",
    )
    found = {p: 0 for p in range(40)}
    for row in runs.where("kind = 0").collect():
        found[row.part] += len(suffix_dedup._unpack(row.hashes, "<u8"))
    mean = sum(found.values()) / 40
    assert mean > 300 and max(found.values()) < 1.5 * mean and min(found.values()) > 0.5 * mean


def test_more_buckets_for_more_keys(spark):
    rows = passages()
    df = spark.createDataFrame([(*x, "k") for x in rows], "doc_id long, text string, kept string").repartition(5)
    got = [tuple(r) for r in remove_repeats(df, 50, 24, block=700, run_bytes=3000, bucket_keys=20).collect()]
    assert sorted(((*r[:4], bytes(r[4])) for r in got), key=str) == brute(rows, 50)
    coded = front_code(keys := [b"", b"a", b"a\0", b"a\0\0", b"a\0b", b"ab", b"ab"])
    assert front_decode(coded) == (keys, [0, 0, 1, 2, 2, 1, 2])
