"""Date spine and calendar dimension."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import scalars as X
from tidemark.operators.joins import spine_cross

CALENDAR_START = date(2013, 1, 1)  # fixed value: first day of the calendar
CAPACITY_START = date(2016, 1, 1)  # fixed value: first day of the capacity grid


def as_day(day: date | Column | None) -> Column:
    """A date literal; today if none is given."""
    if day is None:
        return F.current_date()
    return day if isinstance(day, Column) else F.lit(day)


def date_spine(bounds: DataFrame, start: date | Column, end: date | Column | None = None) -> DataFrame:
    """One row ``day`` per date from start to end inclusive.

    ``bounds`` has one row; start and end may use its columns.
    """
    return spine_cross(bounds, as_day(start), as_day(end)).select("day")


def calendar(spine: DataFrame) -> DataFrame:
    """Day, Month, Year, ISO Week (beside the calendar year) and Semester of each date."""
    return spine.select(
        F.day("day").alias("Day"),
        F.month("day").alias("Month"),
        F.year("day").alias("Year"),
        X.iso_week("day").alias("Week"),
        X.semester("day").alias("Semester"),
    )


def one_row(spark: SparkSession) -> DataFrame:
    return spark.range(1)
