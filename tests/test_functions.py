"""Scalar helpers: strict casts, completed years, NULL-safe truth."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from velocart.functions import age_years, calendar_year, cast_strict, holds, to_date_strict
from velocart.plans import reports as R


def test_bad_date_text_is_an_error(spark):
    df = spark.createDataFrame([("1980-05-05",), ("not a date",)], "dob string")
    for ansi in ("true", "false"):  # whatever the session does with bad casts
        spark.conf.set("spark.sql.ansi.enabled", ansi)
        try:
            with pytest.raises(Exception, match="does not fit"):
                df.select(to_date_strict("dob")).collect()
            with pytest.raises(Exception, match="does not fit"):
                df.select(cast_strict("dob", "int")).collect()
        finally:
            spark.conf.set("spark.sql.ansi.enabled", "true")
    good = spark.createDataFrame([("1980-05-05",), (None,)], "dob string").select(to_date_strict("dob"))
    assert [r[0] for r in good.collect()] == [dt.date(1980, 5, 5), None]


def test_completed_years_and_leap_day(spark):
    df = spark.createDataFrame(
        [("1988-02-29", "2025-02-28"), ("1988-02-29", "2025-03-01"), ("2000-12-31", "2001-12-30")],
        "dob string, on string",
    )
    got = [r[0] for r in df.select(age_years("dob", F.col("on").cast("date"))).collect()]
    assert got == [36, 37, 0]


def test_is_true_as_a_filter_drops_null_and_false(spark):
    df = spark.createDataFrame([(True,), (False,), (None,)], "b boolean")
    assert [r.b for r in df.filter(holds("b")).collect()] == [True]


def test_calendar_year(spark):
    df = spark.createDataFrame([(dt.date(2017, 12, 31),)], "d date")
    assert df.select(calendar_year("d")).first()[0] == 2017


def test_titles_default_as_of_is_today(spark):
    c = spark.createDataFrame(
        [("Senior Dev", "IT", "1900-01-01"), ("Senior Kid", "IT", str(dt.date.today()))],
        "job_title string, job_industry_category string, dob string",
    )
    assert [r[0] for r in R.titles_by_rules(c).collect()] == ["Senior Dev"]
