import random
from collections import defaultdict

import numpy as np
import xxhash

from clinsift.llm.components import components
from clinsift.llm.simhash import fingerprint, forest, guests, homes, keep_representatives, simhash_groups


def slow_fingerprint(text, n=3):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\x0b\x0c\r":
        words = words.replace(c, " ")
    words = [w for w in words.split(" ") if w]
    if not words:
        return 0
    shingles = [" ".join(words[i : i + n]) for i in range(max(1, len(words) - n + 1))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def classes(pairs):
    """Smallest reachable id by walking all links."""
    items = list(pairs.items())
    near = defaultdict(set)
    for i, (a, x) in enumerate(items):
        for b, y in items[i + 1 :]:
            if bin(x ^ y).count("1") <= 2:
                near[a].add(b)
                near[b].add(a)
    out = {}
    for a in sorted(pairs):
        if a not in out:
            stack = [a]
            while stack:
                c = stack.pop()
                if c not in out:
                    out[c] = a
                    stack.extend(near[c])
    return out


def test_fingerprints():
    for text in ["", None, " \n\t", "one", "one two", "A b C d\x0be", "é É x y z", "w " * 500, "a b c a b c"]:
        assert fingerprint(text) == slow_fingerprint(text)


def test_every_near_fingerprint_is_a_guest_at_home():
    rng = np.random.default_rng(3)
    x = rng.integers(-(1 << 62), 1 << 62, 300)
    for bits in (0, 1, 2):
        y = x.copy()
        for i in range(len(y)):
            for b in rng.choice(64, bits, replace=False):
                y[i] ^= np.int64(np.uint64(1) << np.uint64(b))
        at, anchor = guests(y, 2)
        met = set(zip(at.tolist(), anchor.tolist(), strict=True))
        assert all((i, h) in met for i, h in enumerate(homes(x).tolist()))


def test_forest_joins_what_links_join():
    r = np.array([0, 3, 15, 255], np.int64)
    v = np.array([1, 7, 255, 1023, 5000], np.int64)
    assert {frozenset(e) for e in forest(r, v, 2)} and len(forest(r, v, 2)) < 9


def test_forest_counts_the_top_bit_like_any_other():
    at = np.uint64(0x0123456789ABCDEF)
    differing = [{63}, *({63, k} for k in range(63)), *(set(range(64 - n, 64)) for n in range(3, 19))]
    for bits in differing:
        a, b = (np.array([x], np.uint64).view(np.int64) for x in (at, at ^ np.uint64(sum(1 << k for k in bits))))
        ends = {int(a[0]), int(b[0])}
        for edges in (forest(a, b, 2), forest(b, a, 2)):
            assert [set(e) for e in edges] == ([ends] if len(bits) <= 2 else []), bits


def test_components_of_chains_stars_and_cycles(spark):
    r = random.Random(2)
    links = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 130)] + [(200, 201), (201, 202), (202, 200)]
    links += [(5, 5), (300, None)]
    r.shuffle(links)
    df = spark.createDataFrame(links, "a long, b long")
    got = {x.node: x.component for x in components(df).collect()}
    assert got == {**{i: 0 for i in range(41)}, **{i: 100 for i in range(100, 130)}, 200: 200, 201: 200, 202: 200}
    assert components(df.limit(0)).count() == 0


def test_groups_against_all_pairs(spark):
    r = random.Random(4)
    base = [" ".join(r.choice("abcdefghij") * 3 for _ in range(r.randrange(1, 90))) for _ in range(25)]
    texts = []
    for _ in range(200):
        words = r.choice(base).split(" ")
        for _ in range(r.randrange(3)):
            words[r.randrange(len(words))] = r.choice("xyz")
        texts.append(" ".join(words))
    texts += ["", "  ", None, "A b", "a B"]
    rows = [(1000 - i, t, "x") for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows + rows[:3], "doc_id long, text string, component_id string").repartition(4)
    got = simhash_groups(df).collect()
    assert len(got) == len(rows) + 3
    want = classes({i: slow_fingerprint(t) for i, t, _ in rows})
    assert {x.doc_id: x.component_id for x in got} == want
    assert {x.doc_id: x.fp & (2**64 - 1) for x in got} == {i: slow_fingerprint(t) for i, t, _ in rows}
    kept = keep_representatives(df.drop("component_id"))
    assert {x.doc_id for x in kept.collect()} == set(want.values())
    assert simhash_groups(df.limit(0)).count() == 0


def test_null_ids(spark):
    df = spark.createDataFrame([(None, "a b c"), (7, "a b c"), (None, "other words here")], "doc_id long, text string")
    got = {(x.doc_id, x.component_id) for x in simhash_groups(df).collect()}
    assert got == {(None, 7), (7, 7), (None, None)}
