"""Benchmark decontamination by spaced-seed hashing.

Texts are cut into lower-case words.  A seed looks at five neighbouring words and hashes four of
them; four masks leave out the last, or one inner word.  Every document position and every
benchmark position gets one hash per mask, equal hashes are hits, and around a hit the two
texts are compared word by word: a document holds (part of) an item if some window of
``window`` words (the whole item if it is shorter) agrees with it in at least ``similarity`` of
its words, in place.

Nothing is missed: a window with at most a fifth of its words replaced has five
neighbours with one replaced word at most, and for each place of that word one of the masks
leaves it out.  ``similarity`` must therefore be 0.8 or more.

The hashes of the benchmark are joined in blocks of ``BLOCK`` seeds (of at most some 300 bytes,
the words around the seed included); a block is broadcast, and the documents are read once
per block.  Everything is built-in functions, and documents are not shuffled: only verified
overlaps are.

Items of fewer than ``SPAN`` words have no seed.  For them a window is the whole item and 0.8 of
at most four words is all of them, so they are matched as whole n-grams: one hash of the item's
words, joined to the hashes of the document's n-grams of the lengths that occur among such
items (at most four), in blocks of ``BLOCK`` items, and compared word by word.

Defined cases: a null text is empty; a row without words overlaps nothing; repeated items or documents are
reported under their id once.  Rows with a null id are reported under null (``keep_clean``
judges each row by its own text).  Empty tables give an empty result; extra columns are ignored.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clinsift.llm.staging import staged

MASKS = ((0, 1, 2, 3), (0, 2, 3, 4), (0, 1, 3, 4), (0, 1, 2, 4))
SPAN = 5
BLOCK = 100_000


def word_hashes(text: Column) -> Column:
    words = F.split(F.lower(F.coalesce(text.cast("string"), F.lit(""))), r"[^\p{L}\p{N}]+")
    return F.transform(F.filter(words, lambda w: w != ""), lambda w: F.xxhash64(w))


def _positions(texts: DataFrame) -> DataFrame:
    """A row per position and mask: its hash, with the words alongside."""
    placed = texts.select("id", "w", F.posexplode_outer("w").alias("at", "_"))
    # neighbours are read once each, which keeps the generated loop small enough to be compiled
    five = placed.select(
        "id", "w", "at", *(F.get("w", F.col("at") + k).alias(f"w{k}") for k in range(SPAN))
    )
    keys = (F.xxhash64(F.lit(n), *(f"w{k}" for k in mask)) for n, mask in enumerate(MASKS))
    return five.select("id", "w", "at", F.explode(F.array(*keys)).alias("key"))


def seeds(benchmark: DataFrame, window: int, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """``key, item_id, ctx, off, size``: a seed, the words around it and its place in them."""
    items = benchmark.select(F.col(id_col).alias("id"), word_hashes(F.col(text_col)).alias("w"))
    items = items.where(F.size("w") >= SPAN)
    reach = window - SPAN
    start = F.greatest(F.least(F.col("at") - reach, F.size("w") - window), F.lit(0))
    return (
        _positions(items)
        .where(F.col("at") + SPAN - 1 <= F.size("w"))
        .select(
            "key",
            F.col("id").alias("item_id"),
            F.slice("w", start + 1, F.col("at") - start + window).alias("ctx"),
            (F.col("at") - start).alias("off"),
            F.least(F.lit(window), F.size("w")).alias("size"),
        )
    )


def short_items(benchmark: DataFrame, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """``key, item_id, w, size`` of the items with fewer words than a seed spans."""
    items = benchmark.select(F.col(id_col).alias("item_id"), word_hashes(F.col(text_col)).alias("w"))
    items = items.where((F.size("w") >= 1) & (F.size("w") < SPAN))
    return items.select(F.xxhash64(F.size("w"), "w").alias("key"), "item_id", "w", F.size("w").alias("size"))


def _short_hits(texts: DataFrame, items: DataFrame, lengths: list[int]) -> DataFrame:
    """``doc_id, item_id, matched, size`` where a document holds a short item word for word."""
    placed = texts.select("id", "w", F.posexplode("w").alias("at", "_"))
    grams = [
        F.when(F.col("at") + n <= F.size("w"), F.xxhash64(F.lit(n), F.slice("w", F.col("at") + 1, n)))
        for n in lengths
    ]
    keyed = placed.select("id", "w", "at", F.explode(F.array(*grams)).alias("key")).where(F.col("key").isNotNull())
    hits = keyed.join(F.broadcast(items.withColumnRenamed("w", "item_w")), "key")
    exact = F.slice("w", F.col("at") + 1, F.col("size")) == F.col("item_w")
    return hits.where(exact).select(F.col("id").alias("doc_id"), "item_id", F.col("size").alias("matched"), "size")


def _best() -> Column:
    """Most agreeing words in any window of ``ctx`` laid on ``here``, from ``lead`` on."""
    same = F.transform(
        "ctx",
        lambda x, k: F.coalesce((F.get("here", F.col("lead") + k) == x).cast("int"), F.lit(0)),
    )
    total = lambda part: F.aggregate(part, F.lit(0), lambda a, b: a + b)
    sums = F.transform(
        F.sequence(F.lit(1), F.size("ctx") - F.col("size") + 1),
        lambda s: total(F.slice(same, s, F.col("size"))),
    )
    return F.array_max(sums)


def overlaps(
    docs: DataFrame,
    benchmark: DataFrame,
    window: int = 13,
    similarity: float = 0.8,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_id_col: str = "item_id",
    item_text_col: str = "text",
    block: int = BLOCK,
) -> DataFrame:
    """``doc_id, item_id, matched, size``: the best agreement of each document and item."""
    if window < SPAN or similarity < 0.8:
        raise ValueError("the seeds are laid out for windows of 5 words or more and 0.8 or more")
    wanted = staged(seeds(benchmark, window, item_id_col, item_text_col), "seeds")
    blocks = max(1, -(-wanted.count() // block))
    texts = docs.select(F.col(id_col).cast("long").alias("id"), word_hashes(F.col(text_col)).alias("w"))
    first = F.col("at") - F.col("off")  # where the words around the seed begin in the document
    found = []
    for n in range(blocks):
        some = wanted.where(F.pmod(F.xxhash64("key", "item_id", "off", "ctx"), F.lit(blocks)) == n)
        hits = _positions(texts).join(F.broadcast(some), "key")
        found.append(
            hits.select(
                F.col("id").alias("doc_id"),
                "item_id",
                "size",
                "ctx",
                F.slice("w", F.greatest(first, F.lit(0)) + 1, F.size("ctx")).alias("here"),
                F.least(first, F.lit(0)).alias("lead"),
            )
        )
    # written, so that the words of a whole document go no further than the join
    hits = staged(reduce(DataFrame.union, found), "hits")
    verified = hits.select("doc_id", "item_id", "size", _best().alias("matched")).where(
        F.col("matched") >= F.ceil(F.col("size") * F.lit(similarity) - 1e-9)
    )
    short = staged(short_items(benchmark, item_id_col, item_text_col), "short_items")
    lengths = sorted(r.size for r in short.select("size").distinct().collect())  # four at most
    if lengths:
        parts = max(1, -(-short.count() // block))
        for n in range(parts):
            some = short.where(F.pmod(F.xxhash64("key", "item_id"), F.lit(parts)) == n)
            verified = verified.unionByName(_short_hits(texts, some, lengths).select(*verified.columns))
    return verified.groupBy("doc_id", "item_id").agg(F.max("matched").alias("matched"), F.max("size").alias("size"))


def _unused(columns: list[str], name: str) -> str:
    taken = {c.lower() for c in columns}
    n = 0
    while f"{name}{n or ''}".lower() in taken:
        n += 1
    return f"{name}{n or ''}"


def keep_clean(
    docs: DataFrame, benchmark: DataFrame, window: int = 13, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """The documents that overlap no item, in their own columns and order.

    Rows are told apart by a 64-bit hash of id and text, not by id: a row with a null or a
    repeated id is judged by its own text, and rows equal in both are kept or dropped together.
    The hash goes under a name none of the caller's columns has.
    """
    key = _unused(docs.columns, "_row")
    keyed = docs.withColumn(key, F.xxhash64(F.col(id_col).cast("long"), F.coalesce(F.col(text_col).cast("string"), F.lit(""))))
    found = overlaps(keyed.select(key, F.col(text_col).alias("text")), benchmark, window, id_col=key)
    leaks = staged(found.select(F.col("doc_id").alias(key)).distinct(), "leaks")
    return keyed.join(leaks, key, "left_anti").select(*docs.columns)
