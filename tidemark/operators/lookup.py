"""Strict label look-ups: no match gives null, one match its label, several an error.

The dictionary is grouped on its key first, so a look-up can never multiply rows and an ambiguous entry that no row
uses does no harm.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.joins import find_skews, spread_join
from tidemark.operators.sizing import measured_small, multiplies

# Form names, field names and language of the label dictionary.
LANGUAGE = "FRA"
CATEGORY_FORM, CATEGORY_ZONE = "BPCCATEG", "DESAXX"
TABLE_FORM, TABLE_ZONE = "ATABDIV", "LNGDES"
COUNTRY_FORM, COUNTRY_ZONE = "TABCOUNTRY", "CRYDES"


@dataclass(frozen=True)
class Label:
    """One slice of the dictionary: a form and a field, for numbered tables also the table number."""

    form: str
    zone: str
    exact_zone: bool = False
    table: int | None = None

    @property
    def slot(self) -> str:
        return f"{self.form}/{self.zone}/{'' if self.table is None else self.table}/"

    @property
    def rows(self) -> str:
        """Condition of the slice. Table numbers are text, as the same column also holds category and country codes."""
        zone = f"ZONE_0 = '{self.zone}'" if self.exact_zone else f"ZONE_0 LIKE '%{self.zone}%'"
        number = "" if self.table is None else f" AND IDENT1_0 = '{self.table}'"
        return f"(CODFIC_0 = '{self.form}' AND {zone}{number})"

    @property
    def code(self) -> str:
        return "IDENT1_0" if self.table is None else "IDENT2_0"


CATEGORY = Label(CATEGORY_FORM, CATEGORY_ZONE, exact_zone=True)
COUNTRY = Label(COUNTRY_FORM, COUNTRY_ZONE)


def table_label(number: int) -> Label:
    return Label(TABLE_FORM, TABLE_ZONE, table=number)


def label_dict(dictionary: DataFrame, label: Label, lang: str = LANGUAGE) -> DataFrame:
    """One slice as (code, text)."""
    chosen = dictionary.filter(F.expr(f"LANGUE_0 = '{lang}' AND {label.rows}"))
    return chosen.select(F.col(label.code).alias("code"), F.col("TEXTE_0").alias("text"))


def group_lookup(dictionary: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """The dictionary with one row per key: number of entries, and the value."""
    return dictionary.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"), F.min(value).alias("__value"))


def strict(count: Column, value: Column, what: str, asked: Column | str) -> Column:
    """The looked-up value, or an error for a key with several entries.

    ``asked`` is a column of the asking row, other than the join key, for the message. It also ties the expression to
    both sides of the join: a filter on the result must not be evaluated on dictionary entries that no row uses.
    """
    asked = F.col(asked) if isinstance(asked, str) else asked
    message = F.concat(F.lit(f"look-up of {what} is ambiguous for "), F.coalesce(asked.cast("string"), F.lit("null")))
    return F.when(count > 1, F.raise_error(message).cast("string")).otherwise(value)


def lookup(df: DataFrame, dictionary: DataFrame, on: Sequence[tuple[str, str]], value: str, as_: str) -> DataFrame:
    """Add column ``as_`` with the one dictionary value for the row's key."""
    grouped = group_lookup(dictionary, [r for _, r in on], value)
    asking = df.withColumn("__asked", F.concat_ws("/", *[F.col(l).cast("string") for l, _ in on]))
    small = measured_small(grouped) if multiplies(grouped) else None
    joined = spread_join(asking, grouped, on, "left", small=small)
    return joined.select(*df.columns, strict(F.col("__n"), F.col("__value"), as_, "__asked").alias(as_))


def lookup_family(df: DataFrame, dictionary: DataFrame, labels: Mapping[str, tuple[str, Label]]) -> DataFrame:
    """Several look-ups against slices of one dictionary: ``{new column: (code column, slice)}``.

    Slices do not overlap, and the rows of ``df`` are distinct (each carries a number). All slices are grouped in a
    single pass under a combined (slice, code) key. Every look-up then joins the very same grouped frame, so Spark
    builds and broadcasts it once and reuses it.
    """
    slices = {label.slot: label for _, label in labels.values()}
    any_slice = " OR ".join(label.rows for label in slices.values())
    key = " ".join(f"WHEN {label.rows} THEN concat('{slot}', {label.code})" for slot, label in slices.items())
    chosen = dictionary.filter(F.expr(f"LANGUE_0 = '{LANGUAGE}' AND ({any_slice})"))
    keyed = chosen.select(F.expr(f"CASE {key} END").alias("__key"), F.col("TEXTE_0").alias("__text"))
    grouped = group_lookup(keyed.filter("__key IS NOT NULL"), ["__key"], "__text")
    small = measured_small(grouped)
    asked = [F.concat(F.lit(label.slot), F.col(column)) for column, label in labels.values()]
    joined = df.select("*", *[code.alias(f"__c{i}") for i, code in enumerate(asked)])
    # Statistical codes have few values, so most are hot: measured for all look-ups in one pass.
    skews = [None] * len(asked) if small else find_skews(joined, [[f"__c{i}"] for i in range(len(asked))])
    for i, skew in enumerate(skews):
        names = {"__key": f"__k{i}", "__n": f"__n{i}", "__value": f"__v{i}"}
        entry = grouped.select([F.col(old).alias(new) for old, new in names.items()])
        joined = spread_join(joined, entry, [(f"__c{i}", f"__k{i}")], "left", small=small, skew=skew, copies=False)
    found = [
        strict(F.col(f"__n{i}"), F.col(f"__v{i}"), name, column).alias(name)
        for i, (name, (column, _)) in enumerate(labels.items())
    ]
    return joined.select(*df.columns, *found)


def label_unique(dictionary: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Dictionary keys with more than one entry."""
    return dictionary.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)
