"""Connection profiles and reading of source tables by name."""

from __future__ import annotations

import os
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: A cursor with fewer rows than one in so many of its range is split by quantiles instead of even ranges.
GAPPY = 2
#: Cursor values that are sampled for each part.
SAMPLE = 200
#: Steps between sampled values: a prime, so that values that come in even steps are met too.
STEPS = (1, 2, 3, 5, 11, 101, 1009, 10007, 100003, 1000003, 10000019, 100000007)


@dataclass(frozen=True)
class Profile:
    """Where tables live: a Spark format, its options, and a pattern that turns a table name into a location.

    ``bucket`` is an expression of the database that makes a non-negative whole number of ``{column}``, to split tables
    without a row cursor on their document number: ``ABS(CAST(CHECKSUM({column}) AS BIGINT))`` in SQL Server.
    """

    format: str
    options: Mapping[str, str] = field(default_factory=dict)
    location: str = "{table}"
    bucket: str | None = None

    @classmethod
    def from_env(cls, prefix: str, location: str = "{table}", bucket: str | None = None) -> Profile:
        """A JDBC profile from ``<prefix>_URL``, ``_USER``, ``_PASSWORD`` and optionally ``_DRIVER``.

        Credentials come from the environment only.
        """
        names = {"URL": "url", "USER": "user", "PASSWORD": "password", "DRIVER": "driver"}
        found = {option: os.environ.get(f"{prefix}_{name}") for name, option in names.items()}
        if not found["url"]:
            raise KeyError(f"{prefix}_URL is not set")
        return cls("jdbc", {k: v for k, v in found.items() if v}, location, bucket)


def _relation(profile: Profile, table: str, where: str | None) -> str:
    """What a query reads FROM: the table, or only its rows that meet a condition the database evaluates."""
    location = profile.location.format(table=table)
    return f"(SELECT * FROM {location} WHERE {where}) part" if where else location


def jdbc_options(
    profile: Profile, table: str, bounds: Sequence[int] | None, cursor: str, parts: int, where: str | None = None
) -> dict:
    """Options of a JDBC read: ``parts`` ranges of the cursor, or a single read where it has no bounds."""
    options = {"fetchsize": "10000", **profile.options, "dbtable": _relation(profile, table, where)}
    if bounds and bounds[0] is not None and bounds[1] > bounds[0]:
        options |= {
            "partitionColumn": cursor,
            "lowerBound": str(bounds[0]),
            "upperBound": str(bounds[1] + 1),
            "numPartitions": str(parts),
        }
    return options


def ask(spark: SparkSession, profile: Profile, query: str) -> DataFrame:
    """The rows of a query that the database answers."""
    return spark.read.format("jdbc").options(**profile.options).option("query", query).load()


def cursor_bounds(
    spark: SparkSession, profile: Profile, table: str, cursor: str, where: str | None = None
) -> tuple[int, int, int]:
    """Smallest and largest cursor and the number of rows that have one, asked from the database as one row."""
    relation = _relation(profile, table, where)
    row = ask(spark, profile, f"SELECT MIN({cursor}) AS lo, MAX({cursor}) AS hi, COUNT({cursor}) AS n FROM {relation}").first()
    return row[0], row[1], int(row[2])


def equal_depth(sample: DataFrame, cursor: str, parts: int) -> list[int]:
    """Split points that cut the sampled cursor values into parts of about equal size; one row comes back."""
    shares = [i / parts for i in range(1, parts)]
    if not shares:
        return []
    found = sample.agg(F.percentile_approx(F.col(cursor).cast("long"), shares, 20 * parts).alias("points")).first()["points"]
    return sorted(set(found or []))


def range_predicates(cursor: str, points: Sequence[int]) -> list[str]:
    """Conditions for the ranges between the points: each row meets exactly one, those without a cursor the first."""
    if not points:
        return [f"{cursor} IS NULL OR {cursor} IS NOT NULL"]
    inner = [f"{cursor} >= {low} AND {cursor} < {high}" for low, high in zip(points, points[1:])]
    return [f"{cursor} IS NULL OR {cursor} < {points[0]}", *inner, f"{cursor} >= {points[-1]}"]


def quantile_split(
    spark: SparkSession, profile: Profile, table: str, cursor: str, parts: int, bounds: tuple[int, int, int], where: str | None = None
) -> list[str] | None:
    """Conditions for parts of about equal size, where even ranges of a cursor with gaps would not give them; else None.

    The database is asked for the cursor values that a prime divides, about SAMPLE a part; their quantiles are the split
    points. Where so few are divisible that they say nothing, smaller primes are tried, down to all values.
    """
    low, high, n = bounds
    if parts < 2 or not n or high - low + 1 <= GAPPY * n:
        return None
    wanted = SAMPLE * parts
    for every in reversed([s for s in STEPS if s == 1 or n // s >= wanted]):
        some = f"{cursor} IS NOT NULL" if every == 1 else f"{cursor} % {every} = 0"
        condition = f"({where}) AND {some}" if where else some
        sample = ask(spark, profile, f"SELECT {cursor} FROM {_relation(profile, table, condition)}")
        if every == 1 or sample.count() >= wanted // 4:
            return range_predicates(cursor, equal_depth(sample, cursor, parts))
    return None


def hash_predicates(column: str, bucket: str, parts: int) -> list[str]:
    """Conditions that split a table by a hash of ``column``: each row meets exactly one, a null has its own.

    ``bucket`` is the database's expression for a non-negative whole number made of ``{column}``.
    """
    number = bucket.format(column=column)
    return [f"{column} IS NULL"] + [f"{column} IS NOT NULL AND ({number}) % {parts} = {i}" for i in range(parts)]


def read_source(
    spark: SparkSession,
    profile: Profile,
    table: str,
    columns: Sequence[str] = (),
    cursor: str | None = None,
    parts: int = 64,
    key: str | None = None,
    where: str | None = None,
) -> DataFrame:
    """A source table as a lazy frame, with only the rows that meet the SQL condition ``where``.

    Over JDBC a cursor column splits the read into parallel ranges, even ones or, where it has gaps, ranges between
    sampled quantiles. Without one, a hash of ``key`` does where the profile has a ``bucket`` expression; else the table
    comes over a single connection.
    """
    if profile.format == "jdbc":
        bounds = cursor_bounds(spark, profile, table, cursor, where) if cursor else None
        split = quantile_split(spark, profile, table, cursor, parts, bounds, where) if cursor else None
        if key and not cursor and profile.bucket:
            split = hash_predicates(key, profile.bucket, parts)
        options = jdbc_options(profile, table, None if split else bounds, cursor or "", parts, where)
        if split:
            named = {k: v for k, v in options.items() if k not in ("url", "dbtable")}
            df = spark.read.jdbc(options["url"], options["dbtable"], predicates=split, properties=named)
        else:
            df = spark.read.format("jdbc").options(**options).load()
    else:
        path = profile.location.format(table=table)
        df = spark.read.format(profile.format).options(**profile.options).load(path)
        df = df.filter(where) if where else df
    return df.select(*columns) if columns else df


def write_options(profile: Profile, table: str) -> dict:
    """Options of a JDBC write: batches of rows, and an overwrite that keeps the table's definition."""
    fixed = {"batchsize": "10000", "truncate": "true"}
    return {**fixed, **profile.options, "dbtable": profile.location.format(table=table)}


def write_table(df: DataFrame, profile: Profile, table: str, mode: str = "overwrite") -> None:
    """Write a table through a profile, in parallel from the partitions of ``df``."""
    writer = df.write.format(profile.format).mode(mode)
    if profile.format == "jdbc":
        writer.options(**write_options(profile, table)).save()
    else:
        writer.options(**profile.options).save(profile.location.format(table=table))


# Source tables known to carry a row cursor to split a JDBC read on.
SPLIT_ON = dict.fromkeys(
    "COMPANY SALESREP BPCUSTOMER BPSUPPLIER ITMMASTER SQUOTED SORDER SDELIVERY SINVOICED PORDER PRECEIPT".split(),
    "ROWID",
)


# Document or tracking number of the tables without a row cursor.
SPLIT_BY_HASH = {
    "SQUOTE": "SQHNUM_0",
    "SORDERQ": "SOHNUM_0",
    "SORDERP": "SOHNUM_0",
    "SDELIVERYD": "SDHNUM_0",
    "SINVOICE": "NUM_0",
    "PORDERQ": "POHNUM_0",
    "PORDERP": "POHNUM_0",
    "PRECEIPTD": "PTHNUM_0",
    "MFGITMTRK": "MFGTRKNUM_0",
    "MFGOPETRK": "MFGTRKNUM_0",
}


@dataclass(frozen=True)
class Reader:
    """Read function over one profile, for ``Inputs`` and ``Warehouse``.

    ``split_on`` names a numeric column per table to read ranges of, ``hash_on`` a column to split the others on;
    ``parts`` is the number of connections a table is read over.
    """

    spark: SparkSession
    profile: Profile
    split_on: Mapping[str, str] = field(default_factory=lambda: SPLIT_ON)
    hash_on: Mapping[str, str] = field(default_factory=lambda: SPLIT_BY_HASH)
    parts: int = 64

    @property
    def pushes(self) -> bool:
        """Whether the source itself cuts a table down: what it keeps back is never copied."""
        return self.profile.format == "jdbc"

    def __call__(self, table: str, where: str | None = None) -> DataFrame:
        on = {"cursor": self.split_on.get(table), "key": self.hash_on.get(table), "parts": self.parts}
        return read_source(self.spark, self.profile, table, where=where, **on)

    def above(self, table: str, cursor: str, mark: int) -> DataFrame:
        """The rows of a table above a cursor mark; the ranges split what is above it only."""
        return self(table, f"{cursor} > {mark}")

    def related(self, table: str, number: str, new: str, cursor: str, mark: int) -> DataFrame:
        """The rows of a table whose document number stands in table ``new`` above a cursor mark."""
        return self(table, self.related_to(number, new, cursor, mark))

    def related_to(self, number: str, new: str, cursor: str, mark: int) -> str:
        location = self.profile.location.format(table=new)
        return f"{number} IN (SELECT {number} FROM {location} WHERE {cursor} > {mark})"


def reader(
    spark: SparkSession, profile: Profile, split_on: Mapping[str, str] = SPLIT_ON, parts: int = 64
) -> Reader:
    return Reader(spark, profile, split_on, parts=parts)
