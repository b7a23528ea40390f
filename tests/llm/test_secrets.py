import math
import random
import re
from collections import Counter

import pandas as pd
from pyspark.sql import functions as F

from clinsift.llm.secrets import ALLOW, HEX_BITS, WIDE_BITS, WINDOW, find_secrets, listed

KINDS = ("assign", "access", "hex", "entropy")


def bits(s):
    c = Counter(s)
    return -sum(n / len(s) * math.log2(n / len(s)) for n in c.values())


def plain(text):
    """The patterns as stated, and every window's entropy counted from scratch."""
    text = text or ""
    base = []
    for m in re.finditer(r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", text, re.I):
        if len(m[2]) >= 6:
            base.append((m.start(), 0, m.end()))
    for m in re.finditer(r"AKIA[A-Z0-9]+", text):
        if len(m[0]) >= 20:
            base.append((m.start(), 1, m.end()))
    for m in re.finditer(r"[0-9a-f]+", text):
        if len(m[0]) >= 24:
            base.append((m.start(), 2, m.end()))
    added = []
    for m in re.finditer(r"[A-Za-z0-9+/=_-]+", text):
        v = m[0]
        if len(v) < WINDOW:
            continue
        limit = HEX_BITS if re.fullmatch("[0-9a-fA-F]+", v) else WIDE_BITS
        best = max(bits(v[i : i + WINDOW]) for i in range(len(v) - WINDOW + 1))
        allowed = any(a in v.lower() for a in ALLOW)
        inside = any(a <= m.start() and b >= m.end() for a, _, b in base)
        if best >= limit - 1e-9 and not allowed and not inside:
            added.append((m.start(), 3, m.end()))
    show = lambda spans: ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in sorted(spans))
    return show(base), show(base + added)


def run(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = find_secrets(df).select("doc_id", listed(F.col("base")).alias("b"), listed(F.col("spans")).alias("s"))
    return {r.doc_id: (r.b, r.s) for r in got.collect()}


def test_against_plain_python(spark):
    r = random.Random(4)
    hexd = "0123456789abcdef"
    b64 = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"
    parts = [
        lambda: "".join(r.choice(hexd) for _ in range(r.randrange(10, 50))),
        lambda: "".join(r.choice(b64) for _ in range(r.randrange(10, 60))),
        lambda: "AKIA" + "".join(r.choice("ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789") for _ in range(r.randrange(8, 24))),
        lambda: r.choice(["password", "PassWd", "api_key", "APIKEY", "token", "secret"]) + r.choice(["=", ": ", " = '", '"="', ":"]),
        lambda: r.choice(["hello", "world", "example", "é", "ü", "\n", " ", "the_quick_brown_fox_jumps", "-", "="]),
        lambda: "x" * r.randrange(15, 30),
    ]
    texts = [" ".join(r.choice(parts)() for _ in range(r.randrange(0, 12))) for _ in range(600)]
    texts += [None, "", "a" * 50_000, "0123456789abcdef" * 3000, "token=" + "Ab9/" * 40, "𝒳 token: abcdefgh 0123456789abcdef01234567"]
    got = run(spark, texts)
    assert got == {i: plain(t) for i, t in enumerate(texts)}


def test_documents_against_plain_python(spark):
    docs = pd.read_parquet("/root/testdata/sf0.01/documents.parquet", columns=["doc_id", "text"])
    texts = list(docs.text)
    got = run(spark, texts)
    assert got == {i: plain(t) for i, t in enumerate(texts)}
    assert sum(1 for b, _ in got.values() if b) > 5


def test_defined_cases(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert find_secrets(empty).collect() == []
    rows = [(None, "token = abcdefgh", 1, "x"), (None, "token = abcdefgh", 1, "x"), (7, None, 2, "y")]
    df = spark.createDataFrame(rows, "doc_id long, text string, base int, spans string")
    got = find_secrets(df).select("doc_id", listed(F.col("spans")).alias("s")).collect()
    assert sorted((r.doc_id or -1, r.s) for r in got) == [(-1, "assign:0:16"), (-1, "assign:0:16"), (7, "")]
