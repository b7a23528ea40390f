"""Centroid clustering of integer vectors by the equal-average equal-variance nearest search.

Vectors become integers ``floor(scale * x)``.  Each centroid is known by the sum of its components
``S`` (the mean times the dimension) and the deviation ``D = |c - mean(c)|``.  For a vector ``x`` and
centroid ``c``

    |x - c|^2 = (S_x - S_c)^2 / d + |(x - m_x) - (c - m_c)|^2 >= (S_x - S_c)^2 / d + (D_x - D_c)^2

so with the centroids sorted by ``S`` the search starts at the vector's own sum and walks outward
in both directions: a direction ends as soon as the mean part alone exceeds the best distance
(exact integers), a centroid is passed over when mean and deviation together exceed it (floating
point with a margin that can only let more through), and every centroid left is measured exactly
in 64-bit integers.  Ties go to the smaller centroid number.

On Spark: the integer vectors are written once to the shared folder; each round is one map pass
(an Arrow-batched pandas function, vectorised over the rows of a batch) followed by a grouped sum
per centroid with map-side combine, whose ``k`` rows come to the driver.  Only ``k`` centroids ever
leave the executors; nothing of size proportional to the vectors does.

Defined cases:

* A vector is kept if it has exactly ``dims`` components, none null, NaN or infinite, each with
  ``|floor(scale * x)| < 2**24`` (so that every sum and distance is exact in 64 bits: ``|x| < 65536``
  at scale 256); other rows are not clustered and do not appear in the result.
* Ids may be null or repeated; each row is a vector of its own.  Seeds are the ``k`` kept rows with
  the smallest ``sha256("<salt>:<id>")``; a null id has no hash and comes last; equal hashes are
  ordered by the integer vector.  Fewer kept rows than ``k`` give as many centroids as rows.
* A centroid that receives no vector keeps its place.  An empty table gives an empty result.
* Only the id and vector columns are read, so other columns, whatever their names, do not matter.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from clinsift.llm.staging import staged

DIMS = 64
SCALE = 256
K = 40
ROUNDS = 5
SALT = "2"
BOUND = 2**24  # |component| below this keeps every sum and squared distance inside 64 bits
_FAR = 2**56  # above any squared distance of kept vectors


def integer_vectors(
    table: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", dims: int = DIMS, scale: int = SCALE
) -> DataFrame:
    """``vec_id, v`` (the integer components) of the kept rows."""
    x = F.col("_x")
    # -BOUND < floor(scale * e) < BOUND, by comparisons alone (false for NaN and the infinities)
    fine = F.forall(x, lambda e: e.isNotNull() & (e * scale >= 1 - BOUND) & (e * scale < BOUND))
    rows = table.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vec_col).cast("array<double>").alias("_x"))
    kept = rows.where(x.isNotNull() & (F.size(x) == dims) & fine)
    return kept.select("vec_id", F.transform(x, lambda e: F.floor(e * scale).cast("long")).alias("v"))


def nearest(x: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number and squared distance of each row's nearest centroid (ties: smaller number).

    ``x`` is ``n x d``, ``centroids`` ``k x d``, both int64 within ``BOUND``.  The outward walk runs
    for all rows at once: step ``t`` looks at the ``t``-th centroid on either side of each row.
    """
    n, d = x.shape
    k = len(centroids)
    best = np.full(n, _FAR, dtype=np.int64)
    arg = np.full(n, k, dtype=np.int64)
    if n == 0 or k == 0:
        return arg, best
    sx, sc = x.sum(1), centroids.sum(1)
    dev_x = np.sqrt(np.maximum((x.astype(np.float64) ** 2).sum(1) - sx.astype(np.float64) ** 2 / d, 0))
    dev_c = np.sqrt(np.maximum((centroids.astype(np.float64) ** 2).sum(1) - sc.astype(np.float64) ** 2 / d, 0))
    # Rounding of the bound is far below this; it only lets more centroids reach the exact test.
    slack = 1e-9 * ((x.astype(np.float64) ** 2).sum(1) + float((centroids.astype(np.float64) ** 2).sum(1).max())) + 1
    order = np.lexsort((np.arange(k), sc))
    s_sorted, c_sorted, dev_sorted = sc[order], centroids[order], dev_c[order]
    start = np.searchsorted(s_sorted, sx, side="left")
    sides = [[start.copy(), start < k, 1], [start - 1, start - 1 >= 0, -1]]
    while sides[0][1].any() or sides[1][1].any():
        for side in sides:
            at, live, step = side
            rows = np.flatnonzero(live)
            if not len(rows):
                continue
            j = at[rows]
            gap = sx[rows] - s_sorted[j]
            ended = gap * gap > d * best[rows]
            live[rows[ended]] = False
            rows, j, gap = rows[~ended], j[~ended], gap[~ended]
            bound = gap.astype(np.float64) ** 2 / d + (dev_x[rows] - dev_sorted[j]) ** 2
            look = bound - slack[rows] <= best[rows]
            r, jj = rows[look], j[look]
            if len(r):
                diff = x[r] - c_sorted[jj]
                dist = np.einsum("ij,ij->i", diff, diff)
                number = order[jj]
                better = (dist < best[r]) | ((dist == best[r]) & (number < arg[r]))
                best[r[better]] = dist[better]
                arg[r[better]] = number[better]
            at[rows] += step
            live[rows] &= (at[rows] >= 0) & (at[rows] < k)
    return arg, best


def _assign(vectors: DataFrame, centroids: list[list[int]]) -> DataFrame:
    table = np.array(centroids, dtype=np.int64).reshape(len(centroids), -1)

    @pandas_udf("cluster int, distance long")
    def near(v: pd.Series) -> pd.DataFrame:
        x = np.stack(v.to_numpy()).astype(np.int64) if len(v) else np.zeros((0, table.shape[1]), np.int64)
        arg, best = nearest(x, table)
        return pd.DataFrame({"cluster": arg.astype(np.int32), "distance": best})

    found = near(F.col("v"))
    return vectors.select("vec_id", "v", found["cluster"].alias("cluster"), found["distance"].alias("distance"))


def _seeds(vectors: DataFrame, k: int, salt: str) -> list[list[int]]:
    key = F.sha2(F.concat(F.lit(f"{salt}:"), F.col("vec_id").cast("string")), 256)
    first = vectors.select(key.alias("h"), "v").orderBy(F.col("h").asc_nulls_last(), "v").limit(k)
    return [list(row.v) for row in first.collect()]  # k rows


def _moved(assigned: DataFrame, centroids: list[list[int]], dims: int) -> list[list[int]]:
    """Every centroid that received vectors becomes the floor of their mean; the others stay."""
    sums = assigned.groupBy("cluster").agg(
        F.count(F.lit(1)).alias("n"), *(F.sum(F.get("v", i)).alias(f"s{i}") for i in range(dims))
    )
    out = [list(c) for c in centroids]
    for row in sums.collect():  # one row per centroid
        out[row.cluster] = [row[f"s{i}"] // row.n for i in range(dims)]
    return out


def centroid_digest(centroid: list[int]) -> str:
    return hashlib.sha256(",".join(map(str, centroid)).encode()).hexdigest()


def cluster_vectors(
    table: DataFrame,
    id_col: str = "vec_id",
    vec_col: str = "embedding",
    k: int = K,
    rounds: int = ROUNDS,
    dims: int = DIMS,
    scale: int = SCALE,
    salt: str = SALT,
) -> tuple[DataFrame, list[list[int]]]:
    """Kept vectors with ``cluster`` and squared ``distance``, and the final centroids.

    ``rounds`` times: assign every vector, move every non-empty centroid; then assign once more.
    The result has ``vec_id, v, cluster, distance`` and is written to the shared folder.
    """
    vectors = staged(integer_vectors(table, id_col, vec_col, dims, scale), "vectors")
    centroids = _seeds(vectors, k, salt)
    if not centroids:
        empty = vectors.select("vec_id", "v", F.lit(0).alias("cluster"), F.lit(0).cast("long").alias("distance"))
        return empty, []
    for _ in range(rounds):
        centroids = _moved(_assign(vectors, centroids), centroids, dims)
    return staged(_assign(vectors, centroids), "assigned"), centroids


def cluster_report(table: DataFrame, **options) -> DataFrame:
    """Per kept vector: ``vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256``."""
    final, centroids = cluster_vectors(table, **options)
    spark = final.sparkSession
    per = final.groupBy("cluster").agg(F.sum("distance").alias("cluster_inertia"))  # k rows
    per = per.withColumn("inertia", F.sum("cluster_inertia").over(Window.partitionBy()))
    digests = spark.createDataFrame(
        [(n, centroid_digest(c)) for n, c in enumerate(centroids)], "cluster int, centroid_sha256 string"
    )
    small = per.join(digests, "cluster")  # k rows
    return final.join(F.broadcast(small), "cluster").select(
        "vec_id",
        "cluster",
        "distance",
        F.col("cluster_inertia").cast("long").alias("cluster_inertia"),
        F.col("inertia").cast("long").alias("inertia"),
        "centroid_sha256",
    )
