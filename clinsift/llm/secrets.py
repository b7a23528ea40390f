"""Secrets in texts: fixed patterns, and strings whose characters are too evenly spread to be words.

Base spans, each kind found from left to right by itself, failing matches dropped (not retried):

* ``assign``: a key word (password, passwd, secret, token, api_key or apikey, in either case), an
  optional quote, ``:`` or ``=`` between blanks, an optional quote and a value of 6 or more
  characters of ``[A-Za-z0-9+/_.=-]``; the span is the whole match;
* ``access``: ``AKIA`` and upper-case letters or digits, 20 characters or more;
* ``hex``: runs of lower-case hex digits of 24 or more.

The method adds spans of kind ``entropy``.  Candidates are the maximal runs of at least ``WINDOW``
characters of ``[A-Za-z0-9+/=_-]``.  A candidate of hex digits alone is judged against the hex
class, any other against the wider class.  A window of ``WINDOW`` characters slides over the
candidate; its Shannon entropy ``log2 W - (1/W) sum c log2 c`` is kept up to date from counts per
character, changed by the one character that enters and the one that leaves (a fold over the
positions, with the counts of the class as state).  A candidate whose best window reaches the
threshold of its class becomes a span, unless it holds a word of the allow list (any case) or lies
inside one base span.

Everything is built-in DataFrame functions: regular expressions, arrays and higher-order functions;
no Python runs on the rows.  Each row is read once, no shuffle.

Defined cases: a null text is empty; each input row gives one output row, whatever its id (null or
repeated ids included); offsets are code points, ends exclusive; spans are ordered by start, then
kind in the order of ``KINDS``; a text without secrets has empty lists.  An empty table gives an
empty result; only the id and text columns are read.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clinsift.llm.pii import find_all

KINDS = ("assign", "access", "hex", "entropy")

# Fixed values of the base patterns.
_KEY_WORDS = "password|passwd|secret|token|api_?key"
_VALUE = "[A-Za-z0-9+/_.=-]"
ASSIGN = "(?i:" + _KEY_WORDS + ")[\"']?\\x20*[:=]\\x20*[\"']?(" + _VALUE + "+)"
ACCESS = "AKIA[A-Z0-9]+"
HEX = "(?<![0-9a-f])[0-9a-f]{24,}+"  # the maximal runs of [0-9a-f]+ that are long enough
MIN_VALUE = 6
MIN_ACCESS = 20

# The method's parameters.
WINDOW = 20
HEX_CLASS = "0123456789abcdefABCDEF"
WIDE_CLASS = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/=_-"
HEX_BITS = 3.0  # random hex: about 3.4 bits in 20 characters
WIDE_BITS = 3.9  # random base 64: about 4.1 bits; words and names joined by _ or -: 3.0 to 3.6
ALLOW = ("example", "sample", "dummy", "placeholder", "changeme", "redacted", "xxxxxxxx", "your_", "test")
_CANDIDATE = "(?<![A-Za-z0-9+/=_-])[A-Za-z0-9+/=_-]{%d,}+"


def _plain(spans: Column, kind: int) -> Column:
    return F.transform(spans, lambda s: F.struct(s["start"].alias("start"), F.lit(kind).alias("kind"), s["end"].alias("end")))


def base_secrets(text: Column) -> Column:
    """``start, kind, end`` of the base spans, ordered; kind is the place in ``KINDS``."""
    assign = F.filter(
        find_all(text, ASSIGN, text.rlike("(?i)" + _KEY_WORDS)),
        lambda s: F.length(F.regexp_extract(s["value"], ASSIGN, 1)) >= MIN_VALUE,
    )
    access = F.filter(find_all(text, ACCESS, text.contains("AKIA")), lambda s: F.length(s["value"]) >= MIN_ACCESS)
    hexes = find_all(text, HEX, text.rlike("[0-9a-f]{24}"))
    return F.sort_array(F.concat(_plain(assign, 0), _plain(access, 1), _plain(hexes, 2)))


def _xlogx(c: Column) -> Column:
    return F.when(c > 0, c * F.log2(c)).otherwise(F.lit(0.0))


def char_codes(candidate: Column, alphabet: str = WIDE_CLASS) -> Column:
    """Place of each character in ``alphabet`` (-1 outside it)."""
    return F.transform(F.split(candidate, ""), lambda ch: F.instr(F.lit(alphabet), ch) - 1)


def best_window_bits(codes: Column, size: int = len(WIDE_CLASS), window: int = WINDOW) -> Column:
    """The largest entropy of a window of ``window`` characters, by counts kept up to date.

    ``codes`` must be a materialised array (a column or a lambda's variable), as it is read at
    every step.  Step ``i`` lets character ``i`` in and character ``i - window`` out; the sum of
    ``c log2 c`` changes by those two counts alone.  Codes below 0 are not counted.
    """
    start = F.struct(
        F.array_repeat(F.lit(0), size).alias("counts"),
        F.lit(0.0).alias("sum"),
        F.lit(0.0).alias("best"),
    )

    def step(state: Column, i: Column) -> Column:
        enter = F.get(codes, i)
        leave = F.when(i >= window, F.get(codes, i - window)).otherwise(F.lit(-1))
        counts = state["counts"]
        c_in = F.coalesce(F.get(counts, enter), F.lit(0))
        c_out = F.coalesce(F.get(counts, leave), F.lit(0))
        same = enter == leave
        gained = F.when(same | (enter < 0), 0.0).otherwise(_xlogx(c_in + 1) - _xlogx(c_in))
        lost = F.when(same | (leave < 0), 0.0).otherwise(_xlogx(c_out - 1) - _xlogx(c_out))
        total = state["sum"] + gained + lost
        bits = F.lit(math.log2(window)) - total / window
        moved = F.transform(
            counts,
            lambda c, k: c + F.when((k == enter) & ~same, 1).otherwise(0) - F.when((k == leave) & ~same, 1).otherwise(0),
        )
        return F.struct(
            moved.alias("counts"),
            total.alias("sum"),
            F.when(i >= window - 1, F.greatest(state["best"], bits)).otherwise(state["best"]).alias("best"),
        )

    positions = F.sequence(F.lit(0), F.size(codes) - 1)
    return F.aggregate(positions, start, step, lambda s: s["best"])


def entropy_secrets(text: Column, base: Column, window: int = WINDOW, allow: tuple[str, ...] = ALLOW) -> Column:
    """``start, kind, end`` of the candidates the method flags, kind ``entropy``."""
    found = find_all(text, _CANDIDATE % window, text.rlike(_CANDIDATE % window))
    coded = F.transform(
        found,
        lambda s: F.struct(
            s["start"].alias("start"),
            s["end"].alias("end"),
            s["value"].alias("value"),
            s["value"].rlike("^[0-9a-fA-F]+$").alias("hexish"),
            char_codes(s["value"]).alias("codes"),
        ),
    )
    allowed = "(?i)" + "|".join(allow) if allow else None

    def flagged(s: Column) -> Column:
        limit = F.when(s["hexish"], F.lit(HEX_BITS)).otherwise(F.lit(WIDE_BITS))
        high = best_window_bits(s["codes"], len(WIDE_CLASS), window) >= limit
        inside = F.exists(base, lambda b: (b["start"] <= s["start"]) & (b["end"] >= s["end"]))
        free = ~s["value"].rlike(allowed) if allowed else F.lit(True)
        return free & ~inside & high

    return _plain(F.filter(coded, flagged), KINDS.index("entropy"))


def listed(spans: Column) -> Column:
    """``kind:start:end`` of spans in order, comma-joined."""
    names = F.array(*map(F.lit, KINDS))
    shown = F.transform(
        spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))
    )
    return F.array_join(shown, ",")


def find_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: the id, ``base`` spans and all ``spans`` (base and entropy), by start and kind."""
    rows = docs.select(F.col(id_col).alias("_id"), F.coalesce(F.col(text_col), F.lit("")).alias("_text"))
    with_base = rows.select("_id", "_text", base_secrets(F.col("_text")).alias("base"))
    added = entropy_secrets(F.col("_text"), F.col("base"))
    return with_base.select(
        F.col("_id").alias(id_col), "base", F.sort_array(F.concat(F.col("base"), added)).alias("spans")
    )
