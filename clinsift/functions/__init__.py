"""Column functions: built-in Spark expressions only, no Python UDFs."""

from __future__ import annotations

import re
from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F

from clinsift import texts
from clinsift.config import DEFAULT, Config

__all__ = [
    "age_years",
    "answer_source",
    "as_of_column",
    "fill",
    "has_answer",
    "is_text_yes",
    "is_yes",
    "normalise_gender",
]


def as_of_column(as_of: date | None) -> Column:
    """The reporting day: a fixed date for repeatable runs, otherwise today."""
    return F.current_date() if as_of is None else F.lit(as_of)


def age_years(birthdate: Column, at: Column) -> Column:
    """Completed years from a birthdate to a date or time, truncated towards zero.

    29 February to 28 February counts as not yet completed, which
    ``months_between / 12`` would get wrong.  ``timestamp_diff`` miscounts by a year in
    some cases with a time of day before birth, depends on the session's time zone, and
    is no faster than the difference of two yyyymmdd numbers.  NULL if either is NULL.
    """
    born, day = F.to_date(birthdate), F.to_date(at)

    def number(d: Column) -> Column:
        return F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)

    def years(first: Column, last: Column) -> Column:
        return ((number(last) - number(first)) / 10000).cast("int")

    # a time on the very day, years before birth: the last of these years is not complete
    short = (
        (F.month(born) == F.month(day))
        & (F.dayofmonth(born) == F.dayofmonth(day))
        & (at.cast("timestamp_ntz") > day.cast("timestamp_ntz"))
    )
    return F.when(day >= born, years(born, day)).when(
        day < born, short.cast("int") - years(day, born)
    )


def is_text_yes(value_text: Column) -> Column:
    """Free text "yes" in any capitalisation, spaces around it ignored."""
    return F.lower(F.trim(value_text)) == "yes"


def is_yes(value_coded: Column, value_text: Column, cfg: Config = DEFAULT) -> Column:
    return (value_coded == cfg.yes) | is_text_yes(value_text)


def has_answer(
    *, datetime: bool = False, numeric: bool = False, cfg: Config = DEFAULT
) -> Column:
    """Positive answer of an observation row; optionally any date or number counts too."""
    found = is_yes(F.col("value_coded"), F.col("value_text"), cfg)
    if datetime:
        found = found | F.col("value_datetime").isNotNull()
    if numeric:
        found = found | F.col("value_numeric").isNotNull()
    return found


def answer_source(value_coded: Column, value_text: Column, cfg: Config = DEFAULT) -> Column:
    """Where the "yes" came from; the coded answer wins, NULL if there is none."""
    return F.when(value_coded == cfg.yes, texts.CODED_YES).when(
        is_text_yes(value_text), texts.TEXT_YES
    )


def normalise_gender(gender: Column) -> Column:
    """Known spellings to M or F; anything else stays for manual review."""
    spelled = F.lower(gender)
    return (
        F.when(spelled.isin(*texts.MALE_SPELLINGS), "M")
        .when(spelled.isin(*texts.FEMALE_SPELLINGS), "F")
        .otherwise(gender)
    )


def fill(template: str, **values: Column) -> Column:
    """Put column values into a text with ``{name}`` marks.

    Built on ``concat``, so one NULL value makes the whole text NULL
    (``format_string`` would print "null" instead).
    """
    parts = re.split(r"\{(\w+)\}", template)
    pieces = [
        F.lit(part) if i % 2 == 0 else values[part].cast("string")
        for i, part in enumerate(parts)
        if i % 2 == 1 or part
    ]
    return F.concat(*pieces)
