"""Column expressions of the dataset transformations.

Products multiply left to right in the order given, so that doubles round the same way everywhere.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

MINUTES = 2  # fixed value: the time-unit code whose values are minutes


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def amount(*factors: Column | str) -> Column:
    """Price × quantity × rate and its variants, multiplied in the written order."""
    return reduce(lambda x, y: x * y, map(_col, factors))


def net_quantity(quantity: Column | str, returned: Column | str) -> Column:
    return _col(quantity) - _col(returned)


def margin(net: Column | str, cost: Column | str) -> Column:
    return _col(net) - _col(cost)


def to_hours(time: Column | str, unit: Column | str) -> Column:
    """Minutes become hours; any other unit, or none, leaves the value as it is."""
    value = _col(time).cast("double")
    return F.when(_col(unit) == MINUTES, value / F.lit(60.0)).otherwise(value)


def describe(*parts: Column | str, sep: str = " , ") -> Column:
    """Joined description; null as soon as one part is null."""
    columns = [_col(p) for p in parts]
    pieces = columns[:1]
    for column in columns[1:]:
        pieces += [F.lit(sep), column]
    return F.concat(*pieces)


def iso_week(day: Column | str) -> Column:
    return F.weekofyear(_col(day))


def semester(day: Column | str) -> Column:
    return F.when(F.month(_col(day)) <= 6, 1).otherwise(2)


def weekday(day: Column | str) -> Column:
    """0 for Monday to 6 for Sunday."""
    return F.weekday(_col(day))


def by_weekday(day: Column | str, week: list[str]) -> Column:
    """The one of seven Monday-to-Sunday columns that belongs to the date."""
    return F.element_at(F.array(*[F.col(c) for c in week]), weekday(day) + 1)


def month_number(day: Column | str) -> Column:
    """Months since year 0, counted from 1; 0 for no date."""
    return F.coalesce(F.year(_col(day)) * 12 + F.month(_col(day)), F.lit(0))


def or_zero(c: Column | str) -> Column:
    return F.coalesce(_col(c), F.lit(0))


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Bind by name and cast to the declared types.

    A double cast to an integer is cut toward zero, a timestamp cast to a date loses its time.
    """
    return df.select([F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in schema])
