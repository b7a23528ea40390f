"""Quality classifier: Bradley-Terry ranking of documents from preference pairs.

A document's strength is linear in features of its text.  Of a pair, the document labelled
good is preferred; the weights minimise the logistic loss of the feature differences of
(good, bad) pairs.  The threshold is a quantile of the strengths of the training documents:
the one that separates their labels best, each document counted once.  A score is the logistic of
strength minus that quantile, shifted so that the quantile gets ``CUT``.

The model is fitted on all labelled documents that are not held out and on every (good, bad)
pair of them.  The loss of a pair is a smooth function of two strengths, so a document is spread
over the nearest points of a lattice with the weights that interpolate such functions (within
1e-8 of each pair); pairs of lattice points then stand for all pairs of documents.  Each Newton
step is one pass over the labelled documents, summed by lattice point in whole numbers, so the
sums do not depend on how rows are dealt out.  Features and scores are computed for every row
from its whole text.

Defined cases: a null text counts as empty and gets the score of an empty text; rows are
never dropped, repeated rows get equal scores; null labels and labels of unknown documents are
ignored; without labels of both kinds every score is 0.5.  An empty table gives an
empty result.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clinsift.llm.staging import staged, width

CUT = 0.3
FOLDS = 5  # a document is held out if crc32 of its id as text is divisible by this
RIDGE = 1e-3
_STEPS = 100  # Newton steps at most; some ten are usual
_CLOSE = 1e-7  # a step that moves no weight by more is the last
_FINE = (1 / 8, 8)  # lattice for loss and gradient: distance of its points, points a document is spread over
_COARSE = (1 / 2, 2)  # for the curvature, which only has to point the steps
_UNIT = 1 << 30  # sums are whole numbers of 1 / _UNIT
_SIZES = (1 << 8, 1 << 4)  # units of features and weights on the coarse lattice
_TASK = 1 << 16  # labelled documents a task sums up

_MARKS = b".,;:!?'\"()-"
_SYMBOLS = b"#$%&*+/<=>@[\\]^_`{|}~"
_GROUPS = {
    "upper": range(65, 91),
    "digit": range(48, 58),
    "mark": _MARKS,
    "symbol": _SYMBOLS,
    "break": (10, 13),
    "blank": (32, 9),
    "wide": range(128, 256),
}


def text_features(text: str | None) -> list[float]:
    """What a text looks like: characters, words, lines and their repetition."""
    text = text or ""
    raw = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
    histogram = np.bincount(raw, minlength=256)
    size = max(1, len(raw))
    shares = [float(histogram[list(codes)].sum()) / size for codes in _GROUPS.values()]
    words = text.split()
    n = max(1, len(words))
    counts = Counter(words)
    repeats = sum(map(eq, words, words[1:])) / n
    caps = sum(map(str.isupper, words)) / n
    bare = sum(c for w, c in counts.items() if not w[0].isalnum() and len(w) < 3) / n
    tailed = sum(c for w, c in counts.items() if w[-1] in "#$%&*+=|~@^!") / n
    top = max(counts.values(), default=0) / n
    lines = [x for x in text.split("\n") if x.strip()]
    m = max(1, len(lines))
    twice = 1 - len(set(lines)) / m
    length = len(text) / n
    variety = len(counts) / n
    parts = [*shares, repeats, caps, bare, tailed, top, twice, variety]
    return [
        math.log1p(len(text)),
        math.log1p(len(words)),
        math.log1p(m),
        length,
        variety * math.log1p(n),
        *parts,
        *(math.sqrt(p) for p in parts),
    ]


def features(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [text_features(t.as_py()) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(found, pa.list_(pa.float32()))], ["doc_id", "x"]
            )

    return docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")
    ).mapInArrow(run, "doc_id long, x array<float>")


def held_out(id_col: str = "doc_id") -> Column:
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % FOLDS == 0, F.lit(False))


@dataclass(frozen=True)
class Ranking:
    """Means, scales and weights of the features; ``level`` is the strength scored ``CUT``."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    level: float

    def score(self, x: np.ndarray) -> np.ndarray:
        strength = ((x - self.mean) / self.scale) @ self.weights
        z = np.clip(strength - self.level + math.log(CUT / (1 - CUT)), -60, 60)
        return 1 / (1 + np.exp(-z))


UNFITTED = Ranking(np.zeros(1), np.ones(1), np.zeros(1), math.log(CUT / (1 - CUT)))


def _chance(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(np.clip(-x, -60, 60)))


def _newton(derivatives: Callable, size: int) -> np.ndarray:
    """The weights of least loss; ``derivatives``: loss, descent and curvature at given weights."""
    w = np.zeros(size)
    loss, descent, curvature = derivatives(w)
    for _ in range(_STEPS):
        step = np.linalg.solve(curvature, descent)
        while np.abs(step).max() >= _CLOSE and (found := derivatives(w + step))[0] > loss + 1e-8:
            step = step / 2
        if np.abs(step).max() < _CLOSE:
            break
        w = w + step
        loss, descent, curvature = found
    return w


def fit(good: np.ndarray, bad: np.ndarray, shares: tuple[float, float] = (1.0, 1.0), pairs: int = 1 << 18) -> Ranking:
    """A ranking from feature rows in memory, pair by pair, some ``pairs`` at a time.

    ``shares``: how many documents each row of ``good`` and ``bad`` stands for.
    """
    if not len(good) or not len(bad):
        return UNFITTED
    rows = np.concatenate((good, bad)).astype(float)
    mean, scale = rows.mean(0), rows.std(0) + 1e-6
    z = (rows - mean) / scale
    block = max(1, pairs // len(bad))

    def derivatives(w: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
        loss, descent, curvature = 0.0, np.zeros(len(w)), np.zeros((len(w), len(w)))
        for at in range(0, len(good), block):
            diff = (z[at : min(at + block, len(good)), None] - z[None, len(good) :]).reshape(-1, len(w))
            ahead = diff @ w
            p = _chance(-ahead)
            loss += np.logaddexp(0, -ahead).sum()
            descent += p @ diff
            curvature += (diff * (p * (1 - p))[:, None]).T @ diff
        return _ridged(w, loss, descent, curvature, len(good) * len(bad))

    w = _newton(derivatives, rows.shape[1])
    strengths = (z * w).sum(axis=1)
    weight = np.repeat(shares, (len(good), len(bad)))
    order = np.argsort(strengths, kind="stable")
    # right decisions if everything from the k-th on is called good
    right = np.concatenate((np.zeros(len(good)), np.ones(len(bad))))[order] * weight[order]
    wrong = (weight[order] - right).sum()
    gain = np.concatenate(([0], np.cumsum(right - (weight[order] - right)))) + wrong
    k = int(np.argmax(gain))
    ranked = strengths[order]
    level = ranked[0] - 1 if k == 0 else (ranked[k - 1] + ranked[min(k, len(ranked) - 1)]) / 2
    return Ranking(mean, scale, w, float(level))


def _ridged(w: np.ndarray, loss: float, descent: np.ndarray, curvature: np.ndarray, pairs: float) -> tuple:
    """Means over pairs, with the ridge."""
    return (
        loss / pairs + RIDGE / 2 * float(w @ w),
        descent / pairs - RIDGE * w,
        curvature / pairs + RIDGE * np.eye(len(w)),
    )


def _spread(strength: np.ndarray, distance: float, reach: int) -> tuple[np.ndarray, np.ndarray]:
    """First lattice point of each strength and the weights of ``reach`` points from there on.

    They are Lagrange's: a smooth function of the strength is nearly the weighted sum of its
    values at the points.
    """
    place = strength / distance
    before = np.floor(place)
    points = np.arange(reach) - (reach // 2 - 1)
    weights = np.ones((len(place), reach))
    for k, point in enumerate(points):
        for other in points[points != point]:
            weights[:, k] *= (place - before - other) / (point - other)
    return before.astype(np.int64) + points[0], weights


def _add_sums(z: np.ndarray, w: np.ndarray, fine: dict[int, np.ndarray], coarse: dict[int, np.ndarray]) -> None:
    """Adds counts and features by fine, and their products by coarse lattice point."""
    strength = (z * w).sum(axis=1)
    rows = np.column_stack((np.ones(len(z)), z))
    for sums, lattice in ((fine, _FINE), (coarse, _COARSE)):
        first, weights = _spread(strength, *lattice)
        order = np.argsort(first, kind="stable")
        heads = np.flatnonzero(np.diff(first[order], prepend=first.min() - 1))
        ends = np.append(heads[1:], len(order))
        for k in range(lattice[1]):
            if sums is fine:
                parts = np.rint(rows * weights[:, k, None] * _UNIT).astype(np.int64)[order]
                found = np.add.reduceat(parts, heads)
            else:
                units = np.rint(rows * _SIZES[0])[order]
                part = units * np.rint(weights[order, k] * _SIZES[1])[:, None]
                found = [
                    (part[s:e].T @ units[s:e])[np.triu_indices(rows.shape[1])].astype(np.int64)
                    for s, e in zip(heads, ends, strict=True)
                ]
            for point, values in zip((first[order][heads] + k).tolist(), found, strict=True):
                sums[point] = sums[point] + values if point in sums else values


def _vectors(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """Features and labels of a batch of ``x, y``."""
    x = np.stack(batch.column(0).to_numpy(zero_copy_only=False)).astype(float)
    return x, batch.column(1).to_numpy(zero_copy_only=False)


def _scales(known: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Mean and deviation of each feature."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x, _ = _vectors(batch)
                sums = [len(x), *x.sum(axis=0), *(x * x).sum(axis=0)]
                yield pa.RecordBatch.from_arrays([pa.array([sums], pa.list_(pa.float64()))], ["sums"])

    # a row of some 60 numbers for each batch of 10,000 documents
    parts = np.array([r.sums for r in known.mapInArrow(run, "sums array<double>").collect()])
    n, *sums = (math.fsum(column) for column in parts.T)
    mean, square = np.array(sums).reshape(2, -1) / n
    scale = np.sqrt(np.maximum(square - mean * mean, 0)) + 1e-6
    return mean.astype(np.float32).astype(float), scale.astype(np.float32).astype(float)


def _derivatives(known: DataFrame, mean: np.ndarray, scale: np.ndarray, pairs: float) -> Callable:
    """Loss, descent and curvature over every pair of labelled documents, in one pass over these."""
    size = len(mean)

    def at(w: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held: dict[tuple[int, bool], dict[int, np.ndarray]] = {(y, c): {} for y in (0, 1) for c in (False, True)}
            for batch in batches:
                if not batch.num_rows:
                    continue
                x, labels = _vectors(batch)
                for y in (0, 1):
                    if (labels == y).any():
                        _add_sums((x[labels == y] - mean) / scale, w, held[y, False], held[y, True])
            for (y, curved), sums in held.items():
                for point, values in sums.items():
                    n = len(values)
                    columns = [[y] * n, [curved] * n, [point] * n, list(range(n)), values]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, t) for c, t in zip(columns, (pa.int32(), pa.bool_(), pa.int64(), pa.int32(), pa.int64()), strict=True)],
                        ["y", "curved", "point", "part", "total"],
                    )

        found = (
            known.mapInArrow(run, "y int, curved boolean, point long, part int, total long")
            .groupBy("y", "curved", "point", "part")
            .agg(F.sum("total").alias("total"))
            .toArrow()  # as many rows as lattice points times sums, however many documents
        )
        y, curved, point, part, total = (c.to_numpy() for c in found.columns)

        def table(kind: bool, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
            points = np.unique(point[curved == kind])
            out = np.zeros((2, len(points), width))
            some = curved == kind
            out[y[some], np.searchsorted(points, point[some]), part[some]] = total[some]
            return points, out[1], out[0]

        points, good, bad = table(False, size + 1)
        t, good, bad = points * _FINE[0], good / _UNIT, bad / _UNIT
        loss, descent = 0.0, np.zeros(size)
        for s in range(0, len(t), 512):
            behind = t[None] - t[s : s + 512, None]  # of a bad document to a good one
            p, n = _chance(behind), good[s : s + 512, 0]
            loss += float(n @ np.logaddexp(0, behind) @ bad[:, 0])
            descent += (p @ bad[:, 0]) @ good[s : s + 512, 1:] - (n @ p) @ bad[:, 1:]
        points, good, bad = table(True, (size + 1) * (size + 2) // 2)
        matrices = np.zeros((2, len(points), size + 1, size + 1))
        for filled, sums in zip(matrices, (good, bad), strict=True):
            for matrix, values in zip(filled, sums / (_SIZES[0] ** 2 * _SIZES[1]), strict=True):
                matrix[np.triu_indices(size + 1)] = values
                matrix += np.triu(matrix, 1).T
        good, bad = matrices
        t = points * _COARSE[0]
        p = _chance(t[None] - t[:, None])
        p *= 1 - p
        crossed = good[:, 0, 1:].T @ p @ bad[:, 0, 1:]
        curvature = np.tensordot(p @ bad[:, 0, 0], good[:, 1:, 1:], 1) + np.tensordot(good[:, 0, 0] @ p, bad[:, 1:, 1:], 1)
        return _ridged(w, loss, descent, curvature - crossed - crossed.T, pairs)

    return at


def _level(known: DataFrame, mean: np.ndarray, scale: np.ndarray, w: np.ndarray) -> float:
    """The strength that parts the labels best, without all strengths in one place."""

    def strengths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x, labels = _vectors(batch)
                found = ((x - mean) / scale * w).sum(axis=1) + 0.0  # no negative zero
                gains = np.where(labels == 0, 1, -1)
                yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(gains, pa.int64())], ["s", "gain"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        so_far, best, first, last, cut, after = 0, None, None, None, None, None
        for batch in batches:
            for s, gain in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                first = s if first is None else first
                after = s if cut is not None and cut == last else after
                so_far += gain
                last = s
                if best is None or so_far > best:
                    best, cut, after = so_far, s, None
        if best is not None:
            row = {"part": TaskContext.get().partitionId(), "first": first, "total": so_far, "best": best, "cut": cut, "after": after}
            yield pa.RecordBatch.from_pylist([row], schema=_PARTS)

    each = known.mapInArrow(strengths, "s double, gain long").groupBy("s").agg(F.sum("gain").alias("gain"))
    ranged = each.repartitionByRange(width(known.sparkSession), "s").sortWithinPartitions("s")
    parts = sorted(  # a row for each partition
        ranged.mapInArrow(run, "part int, first double, total long, best long, cut double, after double").collect(),
        key=lambda r: r.part,
    )
    best, level, so_far = 0, parts[0].first - 1, 0
    for i, r in enumerate(parts):
        if so_far + r.best > best:
            best = so_far + r.best
            after = parts[i + 1].first if r.after is None and i + 1 < len(parts) else r.after
            level = r.cut if after is None else (r.cut + after) / 2
        so_far += r.total
    return float(level)


_PARTS = pa.schema(
    [
        ("part", pa.int32()), ("first", pa.float64()), ("total", pa.int64()),
        ("best", pa.int64()), ("cut", pa.float64()), ("after", pa.float64()),
    ]
)


def train(described: DataFrame, labels: DataFrame, target: str = "quality") -> Ranking:
    """A ranking from the labels of all documents that are not held out, and every pair of them."""
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(target).alias("y"))
    known = staged(
        known.where(F.col("y").isin(0, 1) & ~held_out()).join(described, "doc_id"), "labelled"
    ).select("x", F.col("y").cast("int").alias("y"))
    totals = dict(known.groupBy("y").count().collect())
    if len(totals) < 2:
        return UNFITTED
    known = known.coalesce(-(-sum(totals.values()) // _TASK))
    mean, scale = _scales(known)
    w = _newton(_derivatives(known, mean, scale, totals[0] * totals[1]), len(mean))
    return Ranking(mean, scale, w, _level(known, mean, scale, w))


def score(described: DataFrame, model: Ranking) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x = np.stack(batch.column(1).to_numpy(zero_copy_only=False)).astype(float)
            scores = model.score(x if model is not UNFITTED and len(model.mean) > 1 else x[:, :1])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores)], ["doc_id", "score"])

    return described.mapInArrow(run, "doc_id long, score double").select(
        "doc_id",
        held_out().alias("held_out"),
        "score",
        (F.col("score") >= CUT).cast("int").alias("predicted"),
    )


def rank_quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Scores of all documents by a ranking learnt from ``labels``."""
    described = staged(features(docs), "features")
    return score(described, train(described, labels))


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that score at least ``CUT``, in their own columns."""
    scored = rank_quality(docs, labels)
    rejected = scored.where("predicted = 0").select(F.col("doc_id").alias("_bad")).distinct()
    return docs.join(
        staged(rejected, "rejected"), F.col("doc_id").cast("long").eqNullSafe(F.col("_bad")), "left_anti"
    )
