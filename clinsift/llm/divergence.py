"""Audit of how far each source's word use departs from the rest of its language.

Terms are the runs of letters (``[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+``: ASCII letters and every
character beyond ASCII), with A-Z lower-cased.  A language keeps the ``V`` terms that occur in at
least ``min_docs`` of its documents.  Every (lang, source) group, and every language as a whole,
gives each kept term the smoothed share ``p = 1 + floor(scale * (count + 1) / (N + V))``, ``N`` the
group's occurrences of kept terms.  For shares ``p`` and ``q``, ``f = floor((p - q)^2 / q)``.

* ``pair``: for each ordered pair of sources of a language, ``f`` summed over all kept terms, ``p``
  the source's share and ``q`` the other's;
* ``term``: for each term a source uses more than its language (``p > q``, count above 0), ``f``
  with ``q`` the language's share; the ``top`` largest per source.

Ranks count from 1 per (lang, source, part), by value descending, then item in UTF-8 order.

Method for ``pair``: count-level bitmaps.  Kept terms get dense numbers per language; for every
group and every count ``c`` the set of terms that occur exactly ``c`` times there is a bitmap, stored
as its non-zero 64-bit words.  Joining the words of two sources of a language and taking
``bit_count(a & b)`` gives the joint cells ``J(a, b)``: how many terms have count ``a`` in one source
and ``b`` in the other.  Cells with a zero count follow by complement from the bitmap sizes ``R``
and ``V``; each cell is multiplied by its ``f``.  So the sum over all kept terms is

    sum J(a,b) [f(a,b) - f(a,0) - f(0,b) + f(0,0)] + sum R(a) [f(a,0) - f(0,0)]
        + sum R'(b) [f(0,b) - f(0,0)] + V f(0,0)

without a row per term and pair of sources.  All arithmetic is exact: shares by integer division
(of decimals where ``scale * (count + 1)`` leaves 64 bits), sums in 64 bits.  As shares of a source sum
to ``scale + V`` at most, each of the four sums of ``f`` stays under ``(scale + 1) (scale + V) + scale + V``;
with the default scale and up to 10^9 terms in a language, all of them together fit.

On Spark: one scan of the documents.  Tasks count the terms of their documents per (lang, source) in
tables of bounded size, and the counts meet by (lang, term): sums per source and per language need
that one exchange.  The kept terms are written to the shared folder, numbered by slices of a hash
and offsets per slice (no window over a whole language), and written again with their numbers, so
that no later part scans the documents and lost executors recompute little; everything after that is
the size of the vocabulary times the groups, keyed by term or by bitmap word, so that a language or
source with a third of all rows is spread over many tasks.  Each two sources meet once, in both
directions, and only words with a common term are weighted.  The top terms use a window limited to
``top`` rows, which Spark applies before and after the exchange.

Defined cases: null lang, source and text are read as ''; a group without kept terms still has its
pairs (value from the zero cells); a language without kept terms gives pair values 0 and no term
rows; a source alone in its language has no pair rows; repeated rows count as documents of their
own; an empty table gives an empty result; only lang, source and text are read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clinsift.llm.staging import staged, width

SCALE = 1_000_000_000
MIN_DOCS = 3
TOP = 200
_WORD = 64
_HELD = 1 << 19  # terms a task holds before it passes its counts on, some 150 MB
_LONG = (1 << 63) - 1
# UTF-8 bytes: A-Z lower-cased, other ASCII but letters to blanks, what is beyond ASCII kept
_LETTERS = bytes(ord(chr(b).lower()) if chr(b).isalpha() or b > 127 else 32 for b in range(128)) + bytes(range(128, 256))


def terms(raw: bytes) -> list[bytes]:
    """The terms of a text in UTF-8, in order, A-Z lower-cased."""
    return raw.translate(_LETTERS).split()


def share(count: str, total: str, v: str, scale: int = SCALE) -> Column:
    """``1 + floor(scale * (count + 1) / (total + v))``, exactly."""
    d = "decimal(38,0)"
    return F.expr(
        f"1 + case when {count} < {_LONG // scale - 1}L then (cast({scale} as bigint) * ({count} + 1)) div ({total} + {v})"
        f" else (cast({scale} as {d}) * cast({count} + 1 as {d})) div cast({total} + {v} as {d}) end"
    )


def gain(p: str, q: str) -> Column:
    """``floor((p - q)^2 / q)`` of two shares."""
    return F.expr(f"(({p}) - ({q})) * (({p}) - ({q})) div ({q})")


_COUNTS = pa.schema(
    [("lang", pa.string()), ("source", pa.string()), ("term", pa.string()), ("count", pa.int64()), ("docs", pa.int64())]
)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of the terms of each (lang, source), passed on whenever ``_HELD`` terms are held."""
    held: dict[tuple[str, str], tuple[Counter, Counter]] = {}
    size = 0

    def flush() -> Iterator[pa.RecordBatch]:
        for (lang, source), (count, docs) in held.items():
            found = list(count)
            for at in range(0, len(found), 1 << 16):
                some = found[at : at + (1 << 16)]
                columns = (
                    pa.array([lang], pa.string()).take(pa.array([0] * len(some))),
                    pa.array([source], pa.string()).take(pa.array([0] * len(some))),
                    pa.array(some, pa.binary()).cast(pa.string()),
                    pa.array([count[x] for x in some], pa.int64()),
                    pa.array([docs[x] for x in some], pa.int64()),
                )
                yield pa.RecordBatch.from_arrays(list(columns), schema=_COUNTS)
        held.clear()

    for batch in batches:
        langs, sources = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        for lang, source, text in zip(langs, sources, batch.column(2), strict=True):
            found = terms(text.as_buffer().to_pybytes())
            if not found:
                continue
            group = held.get((lang, source)) or held.setdefault((lang, source), (Counter(), Counter()))
            size -= len(group[0])
            group[0].update(found)
            group[1].update(set(found))
            size += len(group[0])
            if size >= _HELD:
                yield from flush()
                size = 0
    yield from flush()


def group_counts(docs: DataFrame, lang: str = "lang", source: str = "source", text: str = "text") -> DataFrame:
    """``lang, source, term, count, docs`` of every term of every group, by one scan.

    Partitioned by lang and term, so that sums over the sources of a term need no exchange.
    """
    none = F.lit("")
    each = docs.select(
        F.coalesce(F.col(lang).cast("string"), none).alias("lang"),
        F.coalesce(F.col(source).cast("string"), none).alias("source"),
        F.coalesce(F.col(text).cast("string"), none).alias("text"),
    ).mapInArrow(_count, "lang string, source string, term string, count long, docs long")
    return each.repartition("lang", "term").groupBy("lang", "source", "term").agg(
        F.sum("count").alias("count"), F.sum("docs").alias("docs")
    )


def divergence(
    docs: DataFrame,
    lang: str = "lang",
    source: str = "source",
    text: str = "text",
    min_docs: int = MIN_DOCS,
    top: int = TOP,
    scale: int = SCALE,
) -> DataFrame:
    """``lang, source, part, item, value, rank`` as described above."""
    spark = docs.sparkSession
    # Written once: every part below reads the kept terms, none scans the documents again.
    # Dense numbers per language, frequent terms first, so that the terms of one bitmap word
    # are about as frequent and a source has few count levels per word.  A slice is a class of
    # frequency (a power of two) and a hash within it; the offsets of the slices are a running
    # sum over their sizes, and numbering is a window per slice, never per language.
    of_term = Window.partitionBy("term", "lang")
    kept_terms = staged(
        group_counts(docs, lang, source, text)
        .withColumns(
            {
                "df": F.sum("docs").over(of_term),
                "lang_count": F.sum("count").over(of_term),
                "first": F.col("source") == F.min("source").over(of_term),
            }
        )
        .where(F.col("df") >= min_docs)
        .select("lang", "source", "term", "count", "lang_count", "first"),
        "kept_terms",
    )
    sliced = kept_terms.withColumn("_class", F.floor(F.log2("lang_count")).cast("int")).withColumn(
        "_hash", F.pmod(F.xxhash64("term"), F.lit(width(spark)))
    )
    sizes = sliced.where("first").groupBy("lang", "_class", "_hash").count()
    in_order = Window.partitionBy("lang").orderBy(F.col("_class").desc(), "_hash")
    offsets = sizes.select("lang", "_class", "_hash", (F.sum("count").over(in_order) - F.col("count")).alias("_offset"))
    by_count = Window.partitionBy("lang", "_class", "_hash").orderBy(F.col("lang_count").desc(), "term")
    kept = staged(
        sliced.join(offsets, ["lang", "_class", "_hash"]).select(
            "lang", "source", "term", "count", "lang_count",
            (F.col("_offset") + F.dense_rank().over(by_count) - 1).alias("tid"),
        ),
        "kept_counts",
    )
    # bitmap sizes: how many terms have a count in a group; the totals follow from them
    levels = staged(
        kept.groupBy("lang", "source", F.col("count").alias("level")).agg(F.count(F.lit(1)).alias("r")), "levels"
    )
    totals = levels.groupBy("lang", "source").agg(F.sum(F.col("level") * F.col("r")).alias("total"))
    lang_totals = levels.groupBy("lang").agg(F.sum(F.col("level") * F.col("r")).alias("lang_total"))
    langs = kept_terms.where("first").groupBy("lang").agg(F.count(F.lit(1)).alias("v"))
    sized = staged(
        docs.select(F.coalesce(F.col(lang), F.lit("")).alias("lang"), F.coalesce(F.col(source), F.lit("")).alias("source"))
        .distinct()
        .join(langs, "lang", "left")
        .join(lang_totals, "lang", "left")
        .join(totals, ["lang", "source"], "left")
        .select(
            "lang",
            "source",
            F.coalesce("v", F.lit(0)).cast("long").alias("v"),
            F.coalesce("total", F.lit(0)).cast("long").alias("total"),
            F.coalesce("lang_total", F.lit(0)).cast("long").alias("lang_total"),
        )
        .withColumn("p0", F.when(F.col("v") > 0, share("0", "total", "v", scale)).otherwise(F.lit(1).cast("long"))),
        "groups",
    )

    # Part term: each kept term of a group against its language.
    rising = (
        kept.join(sized, ["lang", "source"])
        .withColumn("p", share("count", "total", "v", scale))
        .withColumn("q", share("lang_count", "lang_total", "v", scale))
        .where(F.col("p") > F.col("q"))
        .select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), gain("p", "q").alias("value"))
    )
    by_value = Window.partitionBy("lang", "source", "part").orderBy(F.col("value").desc(), F.col("item").asc())
    term_part = rising.withColumn("rank", F.row_number().over(by_value)).where(F.col("rank") <= top)

    # Part pair: count-level bitmaps as 64-bit words.
    words = kept.repartition("lang", F.expr(f"tid div {_WORD}")).groupBy(
        "lang", "source", F.col("count").alias("level"), F.expr(f"tid div {_WORD}").alias("word")
    ).agg(F.bit_or(F.expr(f"shiftleft(1L, cast(tid % {_WORD} as int))")).alias("bits"))
    pairs = (
        sized.alias("a")
        .join(sized.alias("b"), (F.col("a.lang") == F.col("b.lang")) & (F.col("a.source") != F.col("b.source")))
        .select(
            F.col("a.lang").alias("lang"),
            F.col("a.source").alias("source"),
            F.col("b.source").alias("other"),
            F.col("a.v").alias("v"),
            F.col("a.total").alias("total"),
            F.col("b.total").alias("other_total"),
            F.col("a.p0").alias("p0"),
            F.col("b.p0").alias("q0"),
        )
    )
    # Each bitmap word carries its level's share and its source's share of zero, so a joined
    # pair of words is weighted by its cell's gain at once and summed per pair of sources:
    # the map-side combine then holds one entry per pair, not one per pair of levels.
    weighted = words.join(sized.select("lang", "source", "v", "total", "p0"), ["lang", "source"]).select(
        "lang", "word", "source", "bits", share("level", "total", "v", scale).alias("p"), "p0"
    )
    a, b = weighted.alias("a"), weighted.alias("b")
    common = F.col("a.bits").bitwiseAND(F.col("b.bits"))

    def cell(p: str, q: str) -> Column:
        """The cell's terms times ``f(a,b) - f(a,0) - f(0,b) + f(0,0)``."""
        weight = gain(f"{p}.p", f"{q}.p") - gain(f"{p}.p", f"{q}.p0") - gain(f"{p}.p0", f"{q}.p") + gain(f"{p}.p0", f"{q}.p0")
        return F.bit_count(common) * weight

    cells = (
        a.join(
            b,
            (F.col("a.lang") == F.col("b.lang"))
            & (F.col("a.word") == F.col("b.word"))
            & (F.col("a.source") < F.col("b.source"))
            & (common != 0),
        )
        .groupBy(F.col("a.lang").alias("lang"), F.col("a.source").alias("s"), F.col("b.source").alias("o"))
        .agg(F.sum(cell("a", "b")).alias("there"), F.sum(cell("b", "a")).alias("back"))
        .select(
            "lang",
            F.inline(
                F.array(
                    F.struct(F.col("s").alias("source"), F.col("o").alias("other"), F.col("there").alias("part_value")),
                    F.struct(F.col("o").alias("source"), F.col("s").alias("other"), F.col("back").alias("part_value")),
                )
            ),
        )
    )
    rows_a = (
        levels.join(pairs, ["lang", "source"])
        .withColumn("pa", share("level", "total", "v", scale))
        .select("lang", "source", "other", (F.col("r") * (gain("pa", "q0") - gain("p0", "q0"))).alias("part_value"))
    )
    rows_b = (
        levels.withColumnRenamed("source", "other")
        .join(pairs, ["lang", "other"])
        .withColumn("qb", share("level", "other_total", "v", scale))
        .select("lang", "source", "other", (F.col("r") * (gain("p0", "qb") - gain("p0", "q0"))).alias("part_value"))
    )
    zeros = pairs.select("lang", "source", "other", (F.col("v") * gain("p0", "q0")).alias("part_value"))
    summed = (
        zeros.unionByName(rows_a)
        .unionByName(rows_b)
        .unionByName(cells)
        .groupBy("lang", "source", "other")
        .agg(F.sum("part_value").alias("value"))
    )
    pair_part = summed.select(
        "lang", "source", F.lit("pair").alias("part"), F.col("other").alias("item"), F.col("value").cast("long").alias("value")
    ).withColumn("rank", F.row_number().over(by_value))

    return pair_part.unionByName(term_part).select(
        "lang", "source", "part", "item", F.col("value").cast("long").alias("value"), F.col("rank").cast("int").alias("rank")
    )
