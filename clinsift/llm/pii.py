"""Personal data: patterns, and words around them that give the protected value away.

Base spans are e-mail addresses, IP addresses, card numbers (Luhn) and phone numbers, found by
pattern from left to right, each kind by itself.  The information-theoretic part then looks at
the words near base spans.  A value is an entity with information content
``IC(e) = -log2 p(e)``; a word (a run of letters and digits of any length) discloses ``PMI(e; t) = log2 p(e, t) / (p(e) p(t))`` of it.  Where
that is at least ``disclosure`` of ``IC(e)`` (and word and value meet ``support`` times or
more, by default once: the share alone decides), all occurrences of the word, in any row, become
spans of kind ``term``, but those inside base spans.  Probabilities come from
counts over the whole corpus: all its words, all base spans, all pairs within ``REACH``
characters.  In sanitised text base spans become their kind's label, disclosing words the
label ``[WORD]``, and words that never occur without the value (all of IC) are removed.

Telling words with occurrences elsewhere than near values are looked for in all texts, in
blocks of ``BLOCK`` words; a block is broadcast, and the documents are read once per block.

Everything is built-in DataFrame functions.  Only pairs inside a span's bounded surroundings
are formed.  Counts have map-side combine; values and words are compared by 64-bit hashes.

Defined cases: a null text is empty; rows without personal data have no spans and the digest
of an empty list; repeated rows are reported each; ids may be null.  Offsets are code
points, ends exclusive.  An empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clinsift.llm.staging import staged

# The patterns in possessive form, so that long runs neither overflow the matcher's stack
# nor are scanned again from each of their characters.
_EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
_IP = r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}"
_CARD = r"[0-9](?:[\x20-]?+[0-9]){11,}+"  # shorter runs of digits fail anyway
_PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
KINDS = ("email", "ip", "card", "phone", "term")
_IN_WORD = r"[\p{L}\p{N}]"
_WORD = _IN_WORD + "++"
_NOT_WORD = r"[^\p{L}\p{N}]+"
REACH = 64
BLOCK = 200_000
_STEP = 64  # lengths summed one by one; longer lists by blocks of this


def _sum(numbers: Column) -> Column:
    return F.aggregate(numbers, F.lit(0), lambda a, x: a + x)


def _before(lengths: Column) -> Callable[[Column], Column]:
    """Sum of the elements before a place, without a list that is copied per element."""
    blocks = F.sequence(F.lit(0), F.floor((F.size(lengths) - 1) / _STEP).cast("int"))
    sums = F.transform(blocks, lambda b: _sum(F.slice(lengths, b * _STEP + 1, _STEP)))
    until = F.aggregate(
        sums,
        F.array(F.lit(0)),
        lambda done, x: F.concat(done, F.array(F.element_at(done, -1) + x)),
    )
    return lambda i: F.get(until, F.floor(i / _STEP).cast("int")) + _sum(
        F.slice(lengths, F.floor(i / _STEP).cast("int") * _STEP + 1, (i % _STEP).cast("int"))
    )


def find_all(text: Column, pattern: str | Column, when: Column | None = None) -> Column:
    """``start, end, value`` of all matches, from left to right."""
    none = F.array().cast("array<struct<start:int,end:int,value:string>>")
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.transform(F.split(text, pattern, -1), lambda g: F.length(g))
    lengths = F.zip_with(gaps, found, lambda g, m: g + F.coalesce(F.length(m), F.lit(0)))
    before = _before(lengths)
    placed = F.transform(
        found,
        lambda m, i: F.struct(
            (before(i) + F.get(gaps, i)).cast("int").alias("start"),
            (before(i) + F.get(gaps, i) + F.length(m)).cast("int").alias("end"),
            m.alias("value"),
        ),
    )
    some = F.size(found) > 0
    return F.when(some if when is None else when & some, placed).otherwise(none)


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(value: Column) -> Column:
    digits = F.reverse(F.filter(F.split(_digits(value), ""), lambda d: d != ""))
    points = F.transform(
        digits,
        lambda d, i: F.when(i % 2 == 0, d.cast("int")).otherwise(
            F.get(F.array(*map(F.lit, (0, 2, 4, 6, 8, 1, 3, 5, 7, 9))), d.cast("int"))
        ),
    )
    return _sum(points) % 10 == 0


def _valid(kind: str, value: Column) -> Column:
    if kind == "ip":
        plain = F.transform(F.split(value, r"\."), lambda p: F.regexp_replace(p, "^0+", ""))
        return F.forall(plain, lambda p: (F.length(p) < 3) | ((F.length(p) == 3) & (p <= "255")))
    if kind == "card":
        return F.length(_digits(value)).between(12, 19) & _luhn(value)
    if kind == "phone":
        return F.length(_digits(value)).between(9, 15)
    return F.lit(True)


def base_spans(text: Column) -> Column:
    """``start, kind, end, entity`` sorted by start and kind; kind is the place in ``KINDS``."""
    patterns = {
        "email": (_EMAIL, text.contains("@")),
        "ip": (_IP, text.rlike("[0-9]")),
        "card": (_CARD, text.rlike("[0-9]")),
        "phone": (_PHONE, text.contains("+")),
    }

    def of_kind(n: int, kind: str, pattern: str, when: Column) -> Column:
        kept = F.filter(find_all(text, pattern, when), lambda s: _valid(kind, s["value"]))
        plain = F.lower if kind == "email" else _digits
        return F.transform(
            kept,
            lambda s: F.struct(
                s["start"].alias("start"),
                F.lit(n).alias("kind"),
                s["end"].alias("end"),
                F.xxhash64(F.lit(n), plain(s["value"])).alias("entity"),
            ),
        )

    found = [of_kind(n, kind, *how) for n, (kind, how) in enumerate(patterns.items())]
    return F.sort_array(F.concat(*found))


def _terms_near(text: Column, spans: Column) -> Column:
    """``entity, term, start, end`` of the whole words around each base span."""

    def around(span: Column) -> Column:
        low = F.greatest(F.lit(0), span["start"] - REACH)
        left = F.substring(text, low + 1, span["start"] - low)
        right = F.substring(text, span["end"] + 1, F.lit(REACH))
        # a word at the far edge may be cut, one at the near edge may be part of the span's word
        first, last = (F.substring(text, at, F.lit(1)).rlike(_IN_WORD) for at in (span["start"] + 1, span["end"]))
        lefts = F.filter(
            find_all(left, _WORD),
            lambda w: ((w["start"] > 0) | (low == 0)) & ((w["end"] < span["start"] - low) | ~first),
        )
        rights = F.filter(find_all(right, _WORD), lambda w: (w["end"] < REACH) & ((w["start"] > 0) | ~last))
        placed = lambda words, at: F.transform(
            words,
            lambda w: F.struct(
                span["entity"].alias("entity"),
                F.xxhash64(F.lower(w["value"])).alias("term"),
                (w["start"] + at).alias("start"),
                (w["end"] + at).alias("end"),
            ),
        )
        return F.concat(placed(lefts, low), placed(rights, span["end"]))

    near = F.flatten(F.transform(spans, around))
    return F.filter(
        near,
        lambda t: ~F.exists(spans, lambda s: (s["start"] < t["end"]) & (t["start"] < s["end"])),
    )


def _word_counts(docs: DataFrame) -> DataFrame:
    words = docs.select(F.explode(F.split("text", _NOT_WORD)).alias("word"))
    return (
        words.where("word != ''")
        .groupBy(F.xxhash64(F.lower("word")).alias("term"))
        .agg(F.count("*").alias("n_term"))
    )


def _elsewhere(texts: DataFrame, words: DataFrame, block: int) -> DataFrame:
    """``doc_id, text_hash, far``: places of the words of ``term, share`` in all texts."""
    blocks = max(1, -(-words.count() // block))
    keyed = texts.select("doc_id", F.xxhash64("text").alias("text_hash"), "text")
    each = keyed.select(
        "doc_id", "text_hash", F.explode(F.array_distinct(F.split("text", _NOT_WORD))).alias("word")
    ).where("word != ''")
    each = each.withColumn("term", F.xxhash64(F.lower("word")))
    parts = [words.where(F.pmod("term", F.lit(blocks)) == n) for n in range(blocks)]
    hits = reduce(DataFrame.union, (each.join(F.broadcast(some), "term").drop("term") for some in parts))
    hits = hits.select(
        F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash"), "word", "share"
    ).distinct()
    # written, so that its size is known when the texts with a word are picked
    with_text = keyed.join(
        staged(hits, "hits"),
        F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("text_hash") == F.col("_hash")),
    )
    whole = F.concat(F.lit(f"(?<!{_IN_WORD})"), "word", F.lit(f"(?!{_IN_WORD})"))
    places = with_text.select("doc_id", "text_hash", "share", F.explode(find_all(F.col("text"), whole)).alias("w"))
    return (
        places.select("doc_id", "text_hash", F.struct("w.start", "w.end", "share").alias("t"))
        .groupBy("doc_id", "text_hash")
        .agg(F.collect_set("t").alias("far"))
    )


def find_pii(
    docs: DataFrame,
    disclosure: float = 0.95,
    support: int = 1,
    id_col: str = "doc_id",
    text_col: str = "text",
    block: int = BLOCK,
) -> DataFrame:
    """``doc_id, text_hash, base, terms`` of every row.

    ``base``: start, kind, end, entity; ``terms``: start, end, share of the information
    content that the word discloses.
    """
    texts = docs.select(
        F.col(id_col).alias("doc_id"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
    )
    spanned = texts.select(
        "doc_id", F.xxhash64("text").alias("text_hash"), "text", base_spans(F.col("text")).alias("base")
    )
    # the row number is written with the row, so it holds whatever is computed again later
    rows = staged(
        spanned.select(
            F.monotonically_increasing_id().alias("row"),
            "doc_id",
            "text_hash",
            "base",
            F.when(F.size("base") > 0, _terms_near(F.col("text"), F.col("base"))).alias("near"),
        ),
        "base_spans",
    )
    met = rows.select("row", F.explode("near").alias("n")).select("row", "n.*")
    pairs = met.groupBy("entity", "term").agg(F.count("*").alias("n_pair"))
    pairs = staged(pairs.where(F.col("n_pair") >= support), "pairs")
    entities = rows.select(F.explode("base.entity").alias("entity")).groupBy("entity").agg(
        F.count("*").alias("n_entity")
    )
    counts = staged(_word_counts(texts), "word_counts")
    total = counts.select(F.sum("n_term")).scalar()  # one number
    told = pairs.join(counts, "term").join(entities, "entity").withColumn("total", total)
    content = F.log2(F.greatest(F.col("total"), F.col("n_entity") + 1) / F.col("n_entity"))
    share = F.lit(1.0) - F.log2(F.col("n_term") / F.least("n_pair", "n_term")) / content
    telling = staged(
        told.select("term", "n_term", share.alias("share"))
        .where(F.col("share") >= disclosure)
        .groupBy("term")
        .agg(F.max("share").alias("share"), F.max("n_term").alias("n_term")),
        "telling",
    )
    close = staged(
        met.join(telling.select("term", "share"), "term").select("row", "term", "start", "end", "share").distinct(),
        "close",
    )
    # words that occur near values only are all found by now
    seen = close.groupBy("term").agg(F.count("*").alias("n_close"))
    more = telling.join(seen, "term", "left").where(F.coalesce("n_close", F.lit(0)) < F.col("n_term"))
    far = _elsewhere(texts, staged(more.select("term", "share"), "scattered"), block)
    spans = close.groupBy("row").agg(F.collect_list(F.struct("start", "end", "share")).alias("close"))
    none = F.array().cast("array<struct<start:int,end:int,share:double>>")
    found = (
        rows.drop("near")
        .join(spans, "row", "left")
        .join(
            far.withColumnRenamed("doc_id", "_id").withColumnRenamed("text_hash", "_hash"),
            F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("text_hash") == F.col("_hash")),
            "left",
        )
    )
    outside = F.filter(
        F.array_union(F.coalesce("close", none), F.coalesce("far", none)),
        lambda t: ~F.exists("base", lambda s: (s["start"] < t["end"]) & (t["start"] < s["end"])),
    )
    return found.select("doc_id", "text_hash", "base", F.sort_array(outside).alias("terms"))


def listed(spans: Column) -> Column:
    """``kind:start:end`` of spans in order, comma-joined."""
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(
        F.transform(
            spans,
            lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string")),
        ),
        ",",
    )


def all_spans(base: Column, terms: Column) -> Column:
    """Base spans and terms by start, then kind."""
    plain = F.transform(base, lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end")))
    added = F.transform(
        terms, lambda s: F.struct(s["start"].alias("start"), F.lit(len(KINDS) - 1).alias("kind"), s["end"].alias("end"))
    )
    return F.sort_array(F.concat(plain, added))


def sanitise(docs: DataFrame, found: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with base spans and disclosing words replaced in the text.

    ``found`` is the result of ``find_pii`` over the same rows.
    """
    known = found.where((F.size("base") > 0) | (F.size("terms") > 0)).select(
        F.col("doc_id").alias("_id"),
        F.col("text_hash").alias("_hash"),
        F.col("base").alias("_base"),
        F.col("terms").alias("_terms"),
    ).dropDuplicates(["_id", "_hash"])
    joined = docs.join(
        known,
        F.col(id_col).eqNullSafe(F.col("_id")) & (F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))) == F.col("_hash")),
        "left",
    )
    labels = F.array(*(F.lit(f"[{k.upper()}]") for k in KINDS[:-1]))
    marks = F.sort_array(
        F.concat(
            F.transform("_base", lambda s: F.struct(s["start"].alias("a"), s["end"].alias("b"), F.get(labels, s["kind"]).alias("t"))),
            F.transform(
                "_terms",
                lambda s: F.struct(s["start"].alias("a"), s["end"].alias("b"), F.when(s["share"] >= 1, "").otherwise("[WORD]").alias("t")),
            ),
        )
    )
    # of overlapping spans the first is labelled; the next one covers only what lies beyond it
    ends = F.transform(marks, lambda m, i: F.greatest(F.lit(0), F.coalesce(F.array_max(F.transform(F.slice(marks, 1, i), lambda x: x["b"])), F.lit(0))))
    text = F.col(text_col)
    pieces = F.transform(
        marks,
        lambda m, i: F.concat(
            F.when(
                m["a"] > F.get(ends, i), F.substring(text, F.get(ends, i) + 1, m["a"] - F.get(ends, i))
            ).otherwise(""),
            F.when(m["b"] > F.get(ends, i), m["t"]).otherwise(""),
        ),
    )
    last = F.array_max(F.transform(marks, lambda m: m["b"]))
    rest = F.substring(text, last + 1, F.lit(1 << 30))
    clean = F.when(F.size(marks) > 0, F.concat(F.array_join(pieces, ""), rest)).otherwise(text)
    return joined.withColumn("_text", clean).select(
        *(F.col("_text").alias(c) if c == text_col else F.col(c) for c in docs.columns)
    )
