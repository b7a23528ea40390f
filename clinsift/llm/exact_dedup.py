"""Exact dedup by content sort.

Texts are normalised (white space deleted), range-partitioned by sampled splitters and
sorted by the external sort of Spark, so equal texts lie next to each other; neighbours are
compared in full.  The splitters are made of the text's first characters, a hash of all of it
and the row's id, so a group of copies of any size is spread over as many partitions as it
needs, and what is sampled is short whatever the texts' length.  The sort itself compares whole
texts.  Groups that cross a partition border are put together from one record per partition
and border, which are at most two per partition (more only if different texts agree in head
and 64-bit hash).

Of a group the row with the most code points in the original text stays, then the one with
the smallest id; of repeated rows (equal id and text) one stays.

Defined cases: a null text counts as empty; empty texts are equal to each other.  A null id is
larger than any other.  No row is dropped from the report; extra columns are ignored.  An
empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clinsift.llm.staging import staged, width

_SPACE = r"[\x20\x09-\x0D]+"
_HEAD = 32
_LAST = (1 << 63) - 1
_SCHEMA = (
    "doc_id long, part int, run long, border boolean, row_at long, text_sha256 string,"
    " run_size long, best_points int, best_id long, best_at long, content string"
)


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of a sorted partition with the run of equal texts they belong to.

    Only ids are held while a run lasts, and the rows of a run that touches the
    partition's first or last (head, hash) are marked as border rows.
    """
    part = TaskContext.get().partitionId()
    held: list[tuple] = []  # finished runs whose (head, hash) may be the last one
    key = text = first = None
    run = at = 0
    ids: list[int | None] = []
    best = None

    def finished(border: bool, runs: list[tuple]) -> Iterator[pa.RecordBatch]:
        for number, at0, ids, sha, (points, low, best_at), content in runs:
            n = len(ids)
            for s in range(0, n, 50_000):
                some = ids[s : s + 50_000]
                m = len(some)
                same = lambda v, t: pa.array([v] * m, t)
                head = [content if border and s == 0 and i == 0 else None for i in range(m)]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(some, pa.int64()),
                        same(part, pa.int32()),
                        same(number, pa.int64()),
                        same(border, pa.bool_()),
                        pa.array(range(at0 + s, at0 + s + m), pa.int64()),
                        same(sha, pa.string()),
                        same(n, pa.int64()),
                        same(points, pa.int32()),
                        same(low if low != _LAST else None, pa.int64()),
                        same(best_at, pa.int64()),
                        pa.array(head, pa.string()),
                    ],
                    names=[c.split()[0] for c in _SCHEMA.split(",")],
                )

    def close() -> tuple:
        sha = hashlib.sha256(text.encode("utf-8", "surrogatepass")).hexdigest()
        points, low, where = best
        return (run, at - len(ids), ids, sha, (-points, low, where), text)

    for batch in batches:
        heads, hashes, texts, points, doc_ids = (c.to_pylist() for c in batch.columns)
        for h, x, t, n, i in zip(heads, hashes, texts, points, doc_ids, strict=True):
            if text is not None and (x != key[1] or t != text):
                held.append(close())
                run, ids, best = run + 1, [], None
            if (h, x) != key:
                yield from finished(key == first, held)
                held, key = [], (h, x)
                first = first or key
            text = t
            rank = (-n, _LAST if i is None else i, at)
            best = rank if best is None or rank < best else best
            ids.append(i)
            at += 1
    if text is not None:
        held.append(close())
        yield from finished(True, held)


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, keep_id, group_size, kept, text_sha256`` of every row."""
    spark = docs.sparkSession
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(
        F.regexp_replace(text, _SPACE, "").alias("content"),
        F.length(text).alias("points"),
        F.col(id_col).cast("long").alias("doc_id"),
    ).select(
        F.substring("content", 1, _HEAD).alias("head"),
        F.xxhash64("content").alias("hash"),
        "content",
        "points",
        "doc_id",
    )
    runs = staged(
        rows.repartitionByRange(width(spark), "head", "hash", "doc_id")
        .sortWithinPartitions("head", "hash", "content", "doc_id")
        .mapInArrow(_runs, _SCHEMA),
        "runs",
    )
    pieces = runs.where("border and content is not null")
    best = F.struct(
        (-F.col("best_points")).alias("p"),
        F.coalesce("best_id", F.lit(_LAST)).alias("i"),
        "part",
        F.col("best_at").alias("at"),
        F.col("best_id").alias("id"),
    )
    totals = pieces.groupBy("content").agg(
        F.sum("run_size").alias("size"), F.min(best).alias("best")
    )
    # one row per run at a border: about two per partition, however large the input
    border = staged(
        pieces.join(totals, "content").select(
            "part", "run", "size", F.col("best.id").alias("keep"),
            F.col("best.part").alias("keep_part"), F.col("best.at").alias("keep_at"),
        ),
        "borders",
    )
    joined = runs.join(F.broadcast(border), ["part", "run"], "left")
    crossing = F.col("size").isNotNull()
    return joined.select(
        "doc_id",
        F.when(crossing, F.col("keep")).otherwise(F.col("best_id")).alias("keep_id"),
        F.coalesce("size", "run_size").alias("group_size"),
        (
            (F.col("part") == F.coalesce("keep_part", "part"))
            & (F.col("row_at") == F.coalesce("keep_at", "best_at"))
        ).alias("kept"),
        "text_sha256",
    )


def keep_first(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows that stay, in the columns of ``docs``.

    Rows are told apart by id.  Where an id has both rows that stay and rows that go (it is
    repeated), its rows are told apart by content too.
    """
    report = staged(exact_groups(docs, id_col, text_col), "report")
    by_id = report.groupBy("doc_id").agg(
        F.max("kept").alias("some"), F.min("kept").alias("every")
    )
    gone = staged(by_id.where("not some").select(F.col("doc_id").alias("_gone")), "gone")
    mixed = staged(
        by_id.where("some and not every").select(F.col("doc_id").alias("_mixed")), "mixed"
    )
    the_id = F.col(id_col).cast("long")
    rest = docs.join(gone, the_id.eqNullSafe(F.col("_gone")), "left_anti")
    plain = rest.join(mixed, the_id.eqNullSafe(F.col("_mixed")), "left_anti")
    stays = report.where("kept").join(
        mixed, F.col("doc_id").eqNullSafe(F.col("_mixed")), "left_semi"
    ).select(F.col("doc_id").alias("_id"), F.col("text_sha256").alias("_kept_sha")).distinct()
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    repeated = (
        rest.join(mixed, the_id.eqNullSafe(F.col("_mixed")), "left_semi")
        .withColumn("_sha", F.sha2(F.regexp_replace(text, _SPACE, ""), 256))
        .join(stays, the_id.eqNullSafe(F.col("_id")) & (F.col("_sha") == F.col("_kept_sha")), "left_semi")
        .withColumn(
            "_nth",
            F.row_number().over(
                Window.partitionBy(the_id, "_sha").orderBy(F.length(text).desc(), text)
            ),
        )
        .where("_nth = 1")
    )
    return plain.unionByName(repeated.select(*docs.columns))
