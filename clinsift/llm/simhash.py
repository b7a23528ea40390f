"""SimHash near-duplicates by anchor-point covering.

A fingerprint has a bit set where more than half of the XXH64 values of the text's word
shingles have it.  Two fingerprints are linked at ``distance`` or fewer differing bits.

The anchors are the codewords of a covering code: two Golay codes side by side on bits 0-22
and 23-45 (every 23-bit word is within 3 bits of exactly one codeword), bits 46-63 left free.
A fingerprint has one home, the anchor within the covering radius, and goes as a guest to
every anchor within radius plus threshold, the threshold shared between the two halves.  If
two fingerprints differ in ``distance`` bits or fewer, each is a guest at the other's home, so
comparing homes with guests per anchor finds every link.

Links inside an anchor are not listed pair by pair: a walk over residents and guests yields
a spanning forest, so k fingerprints at an anchor give fewer than k edges.  The guests of an
anchor are dealt over ``_SALTS`` parts and its residents go to all of them, so a crowded
anchor is the work of several tasks.

Defined cases: a null or empty text, or one of white space alone, has no words and the
fingerprint zero; texts with fewer words than a shingle are one shingle.  Equal
fingerprints are linked, repeated rows too.  A row with a null id has a fingerprint but gets the
component of its fingerprint's class, null if no row of the class has an id.  Very long texts are hashed shingle by
shingle.  An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clinsift.llm.components import components
from clinsift.llm.staging import staged

SEED = 42
_GENERATOR = 0b110001110101  # x^11+x^10+x^6+x^5+x^4+x^2+1, the Golay code's generator
_N, _R, _CHECKS = 23, 3, 11
_BLOCKS = (0, _N)  # first bits of the two codes
_SALTS = 8  # parts of an anchor


def fingerprint(text: str | None, shingle: int = 3) -> int:
    """The fingerprint of one text, as an unsigned integer."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    n = max(1, len(words) - shingle + 1)
    spans = zip(starts[:n].tolist(), ends[len(words) - n :].tolist(), strict=True)
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(joined[a:b], SEED) for a, b in spans), np.uint64, n)
    counts = np.zeros(64, np.int64)
    for at in range(0, n, 1 << 16):
        bits = np.unpackbits(hashes[at : at + (1 << 16)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > n, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, shingle: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col, fp`` (the fingerprint's bits as a long) of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1)
            fps = np.fromiter((fingerprint(t.as_py(), shingle) for t in texts), np.uint64, len(texts))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fps.view(np.int64))], ["id", "fp"])

    out = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    return out.mapInArrow(run, "id long, fp long")


def _syndrome(word: int) -> int:
    for i in range(_N - 1, _CHECKS - 1, -1):
        if word >> i & 1:
            word ^= _GENERATOR << (i - _CHECKS)
    return word


@lru_cache(1)
def _golay() -> tuple[np.ndarray, np.ndarray, list[list[np.ndarray]]]:
    """Syndrome contribution of each bit; by syndrome, the error patterns that lead to the
    home anchor; by threshold e and syndrome, those of weight up to radius plus e."""
    unit = [_syndrome(1 << i) for i in range(_N)]
    home = np.zeros(1 << _CHECKS, np.int64)
    within: list[list[list[int]]] = [[[] for _ in home] for _ in range(3)]
    for weight in range(_R + 3):
        for places in combinations(range(_N), weight):
            word = s = 0
            for i in places:
                word |= 1 << i
                s ^= unit[i]
            if weight <= _R:
                home[s] = word
            within[max(0, weight - _R)][s].append(word)
    return np.array(unit), home, [[np.array(p, np.int64) for p in by] for by in within]


def _syndromes(words: np.ndarray) -> np.ndarray:
    unit = _golay()[0]
    out = np.zeros(len(words), np.int64)
    for i in range(_N):
        out ^= (words >> i & 1) * unit[i]
    return out


def _halves(fps: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each code: the covered word and its syndrome."""
    words = [fps >> at & ((1 << _N) - 1) for at in _BLOCKS]
    return [(w, _syndromes(w)) for w in words]


def homes(fps: np.ndarray) -> np.ndarray:
    """The anchor of each fingerprint: the codewords within the covering radius."""
    home = _golay()[1]
    (a, sa), (b, sb) = _halves(fps)
    return (a ^ home[sa]) | (b ^ home[sb]) << _N


def guests(fps: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Index of the fingerprint and anchor, for all anchors within radius plus threshold."""
    within = _golay()[2]
    at, anchors = [], []
    (a, sa), (b, sb) = _halves(fps)
    for i in range(len(fps)):
        left = [a[i] ^ within[e][sa[i]] for e in range(distance + 1)]
        right = [(b[i] ^ within[e][sb[i]]) << _N for e in range(distance + 1)]
        found = [
            (left[e][:, None] | right[f][None, :]).ravel()
            for e in range(distance + 1)
            for f in range(distance + 1 - e)
        ]
        anchors.append(np.concatenate(found))
        at.append(np.full(len(anchors[-1]), i))
    if not anchors:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    return np.concatenate(at), np.concatenate(anchors)


def forest(residents: np.ndarray, visitors: np.ndarray, distance: int) -> list[tuple[int, int]]:
    """Edges that join all residents and visitors of an anchor that links connect."""
    # unsigned, as numpy counts the bits of a negative number's absolute value
    near = lambda many, one: np.bitwise_count((many ^ one).view(np.uint64)) <= distance
    fresh_r, fresh_v = np.ones(len(residents), bool), np.ones(len(visitors), bool)
    edges = []
    for root in range(len(residents)):
        if not fresh_r[root]:
            continue
        fresh_r[root] = False
        stack, members = [root], []
        while stack:
            r = residents[stack.pop()]
            for v in np.flatnonzero(fresh_v & near(visitors, r)):
                fresh_v[v] = False
                members.append(int(visitors[v]))
                more = np.flatnonzero(fresh_r & near(residents, visitors[v]))
                fresh_r[more] = False
                stack.extend(more.tolist())
                members.extend(residents[more].tolist())
        first = int(residents[root])
        edges.extend((m, first) for m in set(members) if m != first)
    return edges


def _replicas(distance: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            all_fps = batch.column(0).to_numpy()
            for start in range(0, len(all_fps), 2000):
                fps = all_fps[start : start + 2000]
                at, anchors = guests(fps, distance)
                salt = (fps[at] ^ fps[at] >> 29 ^ fps[at] >> 53) % _SALTS
                own = np.repeat(homes(fps) * _SALTS, _SALTS) + np.tile(np.arange(_SALTS), len(fps))
                place = np.concatenate((anchors * _SALTS + salt, own))
                who = np.concatenate((fps[at], np.repeat(fps, _SALTS)))
                home = np.arange(len(place)) >= len(at)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(place), pa.array(who), pa.array(home)], ["place", "fp", "home"]
                )

    return run


def _compare(distance: int):
    def edges_of(place: np.ndarray, fp: np.ndarray, home: np.ndarray) -> list[tuple[int, int]]:
        starts = np.flatnonzero(np.concatenate(([True], place[1:] != place[:-1])))
        ends = np.append(starts[1:], len(place))
        residents = np.add.reduceat(home.astype(np.int64), starts)
        visitors = ends - starts - residents
        out = []
        for s, e in zip(*(x[(residents > 0) & (visitors > 0)] for x in (starts, ends)), strict=True):
            r, v = fp[s:e][home[s:e]], fp[s:e][~home[s:e]]
            if len(r) > 1 or len(v) > 1 or r[0] != v[0]:
                out.extend(forest(r, v, distance))
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = None
        for batch in batches:
            if not batch.num_rows:
                continue
            new = tuple(c.to_numpy(zero_copy_only=False) for c in batch.columns)
            rest = new if rest is None else tuple(map(np.concatenate, zip(rest, new, strict=True)))
            cut = int(np.searchsorted(rest[0], rest[0][-1]))  # the last place may go on
            if cut:
                yield _edge_batch(edges_of(*(c[:cut] for c in rest)))
                rest = tuple(c[cut:] for c in rest)
        if rest is not None:
            yield _edge_batch(edges_of(*rest))

    return run


def _edge_batch(edges: list[tuple[int, int]]) -> pa.RecordBatch:
    a, b = zip(*edges, strict=True) if edges else ((), ())
    return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])


def fingerprint_links(groups: DataFrame, distance: int = 2) -> DataFrame:
    """``a, b``: edges that connect all of the distinct ``fp`` that links connect."""
    if not 0 <= distance <= 2:
        raise ValueError("the anchors are laid out for 0 to 2 differing bits")
    return (
        groups.select("fp")
        .mapInArrow(_replicas(distance), "place long, fp long, home boolean")
        .repartition("place")
        .sortWithinPartitions("place")
        .mapInArrow(_compare(distance), "a long, b long")
    )


def simhash_groups(
    docs: DataFrame,
    shingle: int = 3,
    distance: int = 2,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``id_col, fp, component_id`` of every row; the component is its smallest id."""
    fps = staged(fingerprints(docs, shingle, id_col, text_col), "fingerprints")
    groups = staged(fps.groupBy("fp").agg(F.min("id").alias("rep")), "groups")
    labels = components(fingerprint_links(groups, distance))
    classes = groups.join(
        labels.select(F.col("node").alias("fp"), "component"), "fp", "left"
    ).select("fp", "rep", F.coalesce("component", "fp").alias("class"))
    smallest = classes.groupBy("class").agg(F.min("rep").alias("component_id"))
    named = staged(classes.join(smallest, "class").select("fp", "component_id"), "classes")
    return fps.join(named, "fp").select(F.col("id").alias(id_col), "fp", "component_id")


def keep_representatives(docs: DataFrame, shingle: int = 3, distance: int = 2) -> DataFrame:
    """The documents that are the smallest id of their component, in their own columns."""
    found = simhash_groups(docs, shingle, distance)
    others = found.where(F.col("doc_id") != F.col("component_id")).select("doc_id").distinct()
    return docs.join(staged(others, "near_copies"), "doc_id", "left_anti").select(*docs.columns)
