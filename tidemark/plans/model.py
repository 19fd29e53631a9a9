"""What a warehouse table is: columns, rules, transformation and load protocols."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tidemark.operators.loads import append_above
from tidemark.operators.quality import Rules
from tidemark.plans.tables import SOURCE_COLUMNS
from tidemark.session import stage

CURSOR = "ROWID"  # fixed value: cursor column of the source tables

LONG, INT, DOUBLE, DATE, TIME = T.LongType(), T.IntegerType(), T.DoubleType(), T.DateType(), T.TimestampNTZType()


@dataclass(frozen=True)
class Column:
    name: str
    type: T.DataType
    length: int | None = None
    required: bool = False


def text(name: str, length: int = 255, required: bool = False) -> Column:
    return Column(name, T.StringType(), length, required)


class Inputs:
    """The source tables of a transformation by name, and the last day of generated dates (default: today).

    ``above`` names a table and a cursor mark: of this table only the rows above the mark are given. ``land`` is a
    folder to copy each table to on its first use, the used columns only, so that a database is read once.

    ``number`` is the document number that tables share with the one of ``above``. Where ``read`` can push conditions
    to the source (``pushes``), the source then gives only the rows of documents above the mark, whatever ``land`` is.
    """

    def __init__(
        self,
        spark: SparkSession,
        read: Callable[[str], DataFrame],
        end: date | None = None,
        above: tuple[str, int] | None = None,
        land: str | None = None,
        number: str | None = None,
    ):
        self.spark = spark
        self.end = end
        self.above = above
        self._read = read
        self._land = land
        self._number = number
        self._landed: dict[str, DataFrame] = {}

    def __getitem__(self, table: str) -> DataFrame:
        if table in self._landed:
            return self._landed[table]
        if self._land and self.above and table != self.above[0]:
            # First, so that a document added meanwhile is missed here and not in its other tables.
            self[self.above[0]]
        df = self._wanted(table)
        if self._land:
            df = self._landed[table] = stage(df.select(*SOURCE_COLUMNS[table]), self._land)
        return df

    def _wanted(self, table: str) -> DataFrame:
        """The table as far as it is needed, cut down by the source where that is possible."""
        new, mark = self.above or (None, 0)
        pushes = mark > 0 and getattr(self._read, "pushes", False)
        if table == new:
            df = self._read.above(table, CURSOR, mark) if pushes else self._read(table)
            return append_above(df, mark, CURSOR)
        if pushes and self._number in SOURCE_COLUMNS[table]:
            return self._read.related(table, self._number, new, CURSOR, mark)
        return self._read(table)

    def increment(self, table: str, mark: int, number: str | None = None) -> Inputs:
        return Inputs(self.spark, self._read, self.end, (table, mark), self._land, number)

    def landed(self, folder: str) -> Inputs:
        return Inputs(self.spark, self._read, self.end, self.above, folder, self._number)


@dataclass(frozen=True)
class Dataset:
    """``load`` is append, insert or all; ``sync`` is replace, merge or upsert (see operators/loads.py).

    ``cursor`` is the target's cursor column, ``cursor_table`` the source table whose row cursor it holds. ``number`` is
    the document number by which the other source tables belong to that one.

    ``build_distinct`` is an optional cheaper way to the distinct rows of ``build``. ``period``: rows of one kind come
    every so many days, so that an upsert works on runs of them, see operators/runs.py. ``build_runs`` gives the distinct
    rows as such runs, none without a day.
    """

    name: str
    columns: tuple[Column, ...]
    build: Callable[[Inputs], DataFrame]
    load: str
    sync: str | None
    surrogate: bool = True
    cursor: str | None = None
    cursor_table: str | None = None
    number: str | None = None
    keys: tuple[str, ...] = ()
    order: tuple[str, ...] = ()
    update: tuple[str, ...] = ()
    unique: tuple[str, ...] = ()
    month_column: str | None = None
    build_distinct: Callable[[Inputs], DataFrame] | None = None
    period: int | None = None
    build_runs: Callable[[Inputs], DataFrame] | None = None

    @property
    def schema(self) -> T.StructType:
        return T.StructType([T.StructField(c.name, c.type) for c in self.columns])

    @property
    def stored_schema(self) -> T.StructType:
        own = [T.StructField("id", LONG)] if self.surrogate else []
        return T.StructType(own + self.schema.fields)

    @property
    def rules(self) -> Rules:
        required = [c.name for c in self.columns if c.required]
        return Rules(required, {c.name: c.length for c in self.columns if c.length}, self.unique)
