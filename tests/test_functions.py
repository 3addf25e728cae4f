from datetime import date, datetime

import pytest
from compare import plan, rows
from pyspark.sql import functions as F

from siltstone.functions import measures, parsing, predicates


def texts(spark, *values):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, t string")


def apply(df, expression):
    return [row[0] for row in df.orderBy("i").select(expression).collect()]


def test_dates(spark):
    df = texts(spark, "2026-08-01T00:00:00.000", "2026-08-01", "2026-13-01T00:00:00.000", None)
    assert apply(df, parsing.parse_date(F.col("t"))) == [date(2026, 8, 1), None, None, None]


def test_instants_compare_by_time(spark):
    df = texts(spark, "2026-08-01T12:00:00.000Z", "2026-08-01T14:00:00.000+02", "soon", "")
    first, second, *bad = apply(df, parsing.parse_instant(F.col("t")))
    assert first == second
    assert bad == [None, None]


def test_local_times(spark):
    df = texts(
        spark,
        " 08/01/2026   05:07 ",
        "08/01/2026\t05:07",
        "\t08/01/2026 05:07",
        "8/1/2026 5:07",
        "",
        "02/30/2026 05:07",
        "08/01/2026 24:00",
        "08/01/2026 05:07x",
        None,
    )
    moment = datetime(2026, 8, 1, 5, 7)
    assert apply(df, parsing.parse_local_time(F.col("t"))) == [moment, moment, *[None] * 7]


def test_local_times_do_not_depend_on_the_session_zone(spark):
    """02:30 does not exist on that day in Chicago."""
    df = texts(spark, "03/08/2026 02:30")
    spark.conf.set("spark.sql.session.timeZone", "America/Chicago")
    try:
        found = apply(df, parsing.parse_local_time(F.col("t")))
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert found == [datetime(2026, 3, 8, 2, 30)]


def test_local_times_end_where_the_pattern_ends(spark):
    df = texts(spark, "08/01/2026 05:07\u2028", "08/01/2026 05:07\n", "008/01/2026 05:07")
    found = apply(df, parsing.parse_local_time(F.col("t")))
    assert found == [datetime(2026, 8, 1, 5, 7), None, None]


def test_text_that_is_no_number_is_not_cast(spark):
    """A failed cast is an exception to Spark, caught row by row."""
    df = texts(spark, "1.0", "x")
    whole = plan(df.select(parsing.parse_whole_number(F.col("t"))))
    assert "CASE WHEN Contains(t" in whole


def test_whole_numbers(spark):
    df = texts(spark, "7", " 7 ", "7.0", "-3.9", "x", "", "1e1", "99999999999", None)
    assert apply(df, parsing.parse_whole_number(F.col("t"))) == [
        7, 7, 7, -3, None, None, None, None, None,
    ]
    df = texts(spark, ".5", ".", "-.9", " +. ", "5.", "..", "+", ".x")
    assert apply(df, parsing.parse_whole_number(F.col("t"))) == [
        0, 0, 0, 0, 5, None, None, None,
    ]


def test_flags_are_three_valued(spark):
    df = texts(spark, "y", " Y ", "N", "?", "", None)
    assert apply(df, parsing.yes_no(F.col("t"))) == [True, True, False, None, None, None]
    status = parsing.upper_trimmed(F.col("t"))
    df = texts(spark, " c ", "O", "n", "P", None)
    assert apply(df, parsing.cleared_flag(status)) == [True, True, False, None, None]


def test_blank_means_null_empty_or_spaces(spark):
    df = texts(spark, None, "", "   ", "\t", "a")
    assert apply(df, predicates.blank(F.col("t"))) == [True, True, True, False, False]


def test_iso_text_keeps_milliseconds(spark):
    df = spark.range(1).select(
        F.lit(0).alias("i"), F.lit("2026-08-01 01:02:03.5").cast("timestamp").alias("t")
    )
    assert apply(df, parsing.iso_millis(F.col("t"))) == ["2026-08-01T01:02:03.500Z"]


@pytest.mark.parametrize(
    "new_time, new_version, old_time, old_version, wins",
    [
        (2, "1", 1, "9", True),
        (1, "9", 2, "1", False),
        (1, "1", 1, "1", False),
        (1, "1", 1, "2", True),
        (1, None, 1, "2", True),
        (1, "1", 1, None, True),
        (1, None, 1, None, False),
        (1, "1", None, "1", True),
        (None, "1", None, "1", True),
        (None, "1", 1, "1", False),
    ],
)
def test_supersedes(spark, new_time, new_version, old_time, old_version, wins):
    schema = "nt int, nv string, ot int, ov string"
    df = spark.createDataFrame([(new_time, new_version, old_time, old_version)], schema)
    rule = predicates.supersedes(*(F.col(c) for c in ("nt", "nv", "ot", "ov")))
    assert df.select(rule).first()[0] is wins


def test_measures(spark):
    df = spark.createDataFrame(
        [(date(2026, 1, 31), date(2026, 2, 2)), (date(2026, 2, 2), date(2026, 1, 31)),
         (None, date(2026, 1, 1))],
        "a date, b date",
    )
    days = rows(df.select(measures.days_forward(F.col("a"), F.col("b"))))
    assert days == [(2,), (None,), (None,)]
    row = spark.range(1).select(
        measures.ratio(F.lit(1), F.lit(0)),
        measures.ratio(F.lit(1), F.lit(4)),
        measures.seconds_between(
            F.lit("2026-01-01 00:00:00").cast("timestamp"),
            F.lit("2026-01-01 00:01:30.6").cast("timestamp"),
        ),
        measures.seconds_between(
            F.lit(None).cast("timestamp"), F.lit("2026-01-01").cast("timestamp")
        ),
    )
    assert tuple(row.first()) == (None, 0.25, 91, None)


def test_complete_months_end_before_the_current_one(spark):
    months = [(date(2026, 6, 1),), (date(2026, 7, 1),), (None,)]
    df = spark.createDataFrame(months, "m date")
    kept = df.filter(predicates.in_complete_month(F.col("m"), date(2026, 7, 31)))
    assert rows(kept) == [(date(2026, 6, 1),)]
    assert df.filter(predicates.in_complete_month(F.col("m"))).count() == 2
