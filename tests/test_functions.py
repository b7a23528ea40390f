from datetime import date, datetime, timedelta

from pyspark.sql import functions as F

from clinsift.functions import age_years, answer_source, fill, has_answer, normalise_gender


def completed_years(a: datetime, b: datetime) -> int:
    """Whole years from a to b, counted one by one; negative when b is earlier."""
    if b < a:
        return -completed_years(b, a)
    years = b.year - a.year
    if (b.month, b.day, b.time()) < (a.month, a.day, a.time()):
        years -= 1
    return years


def test_age_against_counting(spark):
    births = [date(2000, 2, 29), date(1999, 12, 31), date(2001, 1, 1), date(2000, 2, 28)]
    start = datetime(1998, 1, 1, 8)
    times = [start + timedelta(days=d, hours=d % 24) for d in range(0, 3000, 17)]
    times += [datetime(y, m, d, h) for y in (1999, 2001, 2004) for m, d in ((2, 28), (3, 1), (12, 31))
              for h in (0, 23)]
    pairs = [(b, t) for b in births for t in times]
    df = spark.createDataFrame(pairs, "born date, at timestamp_ntz")
    got = df.select("born", "at", age_years(F.col("born"), F.col("at")).alias("age")).collect()
    for row in got:
        born = datetime(row.born.year, row.born.month, row.born.day)
        assert row.age == completed_years(born, row.at), row


def test_age_between_dates_and_nulls(spark):
    leap = date(2000, 2, 29)
    df = spark.createDataFrame(
        [(leap, date(2001, 2, 28)), (leap, date(2001, 3, 1)), (leap, None), (None, leap)],
        "a date, b date",
    )
    ages = [r[0] for r in df.select(age_years(F.col("a"), F.col("b"))).collect()]
    assert ages == [0, 1, None, None]


def test_age_does_not_depend_on_the_time_zone(spark):
    rows = [
        (date(2000, 10, 8), datetime(2010, 10, 8)),  # no midnight in Sao Paulo on the first day
        (date(2000, 10, 8), datetime(2010, 10, 7, 23, 59)),
        (date(2000, 2, 29), datetime(1999, 2, 28, 8)),
        (date(2000, 6, 15), datetime(1999, 6, 15, 10)),
        (date(2000, 6, 15), datetime(1999, 6, 15)),
    ]
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        for zone in ("America/Sao_Paulo", "Asia/Tokyo", "UTC"):
            spark.conf.set("spark.sql.session.timeZone", zone)
            df = spark.createDataFrame(rows, "a date, b timestamp_ntz")
            ages = [r[0] for r in df.select(age_years(F.col("a"), F.col("b"))).collect()]
            assert ages == [10, 9, -1, 0, -1], zone
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_texts_with_values(spark):
    df = spark.createDataFrame([(3, date(2020, 1, 2)), (None, date(2020, 1, 2))], "n int, d date")
    told = df.select(fill("{n} day(s) after {d}!", n=F.col("n"), d=F.col("d"))).collect()
    assert [r[0] for r in told] == ["3 day(s) after 2020-01-02!", None]


def test_answers(spark):
    rows = [
        (1065, None, None, None),
        (1066, " Yes ", None, None),
        (1066, "no", None, None),
        (None, None, datetime(2020, 1, 1), None),
        (None, None, None, 0.0),
        (None, None, None, None),
    ]
    df = spark.createDataFrame(
        rows,
        "value_coded int, value_text string, value_datetime timestamp_ntz, value_numeric double",
    )

    def marks(found):
        return [bool(r[0]) for r in df.select(found).collect()]

    assert marks(has_answer()) == [True, True, False, False, False, False]
    assert marks(has_answer(datetime=True)) == [True, True, False, True, False, False]
    assert marks(has_answer(datetime=True, numeric=True)) == [True, True, False, True, True, False]
    source = answer_source(F.col("value_coded"), F.col("value_text"))
    assert [r[0] for r in df.select(source).collect()] == [
        "Coded Yes", "Text Yes", None, None, None, None,
    ]


def test_gender_spellings(spark):
    df = spark.createDataFrame([("Male",), ("F",), ("U",), (None,)], "g string")
    assert [r[0] for r in df.select(normalise_gender(F.col("g"))).collect()] == ["M", "F", "U", None]
