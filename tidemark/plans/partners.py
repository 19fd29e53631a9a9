"""Companies, sales representatives, customers, suppliers and items."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions import scalars as X
from tidemark.operators.joins import MEASURE, reduce_to, spread_join
from tidemark.operators.lookup import CATEGORY, COUNTRY, Label, lookup_family, table_label
from tidemark.operators.sizing import measured_small
from tidemark.plans.model import LONG, Column, Dataset, Inputs, text
from tidemark.plans.tables import SOURCE_COLUMNS

# First table number of each family of statistical codes.
CUSTOMER_TABLES, SUPPLIER_TABLES, ITEM_TABLES = 30, 40, 20


def build_company(src: Inputs) -> DataFrame:
    return src["COMPANY"].select("CPY_0", "CPYNAM_0", "ROWID")


def build_sales_rep(src: Inputs) -> DataFrame:
    return src["SALESREP"].select("REPNUM_0", "REPNAM_0", "ROWID")


def _statistics(prefix: str, first_table: int, count: int) -> dict[str, tuple[str, Label]]:
    """Name column → (code column, dictionary slice) for a family of numbered codes."""
    return {f"{prefix}_NAME_{i}": (f"{prefix}_{i}", table_label(first_table + i)) for i in range(count)}


def with_partner(src: Inputs, entity: DataFrame, number: str) -> DataFrame:
    """The entity joined to its partner record, which holds the country code."""
    partner = src["BPARTNER"].select("BPRNUM_0", "CRY_0")
    few = src.above and src.above[1] > 0 and measured_small(entity.select(number))
    if few:
        partner = reduce_to(entity, number, partner, "BPRNUM_0")
    return spread_join(entity, partner, [(number, "BPRNUM_0")], skew=None if few else MEASURE, copies=False)


def build_customer(src: Inputs) -> DataFrame:
    labels = {
        "BCGCOD_NAME_0": ("BCGCOD_0", CATEGORY),
        **_statistics("TSCCOD", CUSTOMER_TABLES, 5),
        "PAYS_NAME": ("CRY_0", COUNTRY),
    }
    customers = with_partner(src, src["BPCUSTOMER"].select(*SOURCE_COLUMNS["BPCUSTOMER"]), "BPCNUM_0")
    return X.conform(lookup_family(customers, src["ATEXTRA"], labels), CUSTOMER.schema)


def build_supplier(src: Inputs) -> DataFrame:
    """The category label comes from the customers' category dictionary, as there is no other."""
    labels = {
        "BSGCOD_NAME_0": ("BSGCOD_0", CATEGORY),
        **_statistics("TSSCOD", SUPPLIER_TABLES, 3),
        "PAYS_NAME": ("CRY_0", COUNTRY),
    }
    suppliers = with_partner(src, src["BPSUPPLIER"].select(*SOURCE_COLUMNS["BPSUPPLIER"]), "BPSNUM_0")
    return X.conform(lookup_family(suppliers, src["ATEXTRA"], labels), SUPPLIER.schema)


def build_item(src: Inputs) -> DataFrame:
    items = src["ITMMASTER"].withColumn("ITMDES_0", X.describe("ITMDES1_0", "ITMDES2_0", "ITMDES3_0"))
    items = items.select("ITMREF_0", "ITMDES_0", "TCLCOD_0", *[f"TSICOD_{i}" for i in range(5)], "ROWID")
    return X.conform(lookup_family(items, src["ATEXTRA"], _statistics("TSICOD", ITEM_TABLES, 5)), ITEM.schema)


def _coded(prefix: str, count: int) -> list[Column]:
    return [text(name) for i in range(count) for name in (f"{prefix}_{i}", f"{prefix}_NAME_{i}")]


COMPANY = Dataset(
    "COMPANY",
    (text("CPY_0"), text("CPYNAM_0"), Column("ROWID", LONG)),
    build_company,
    load="append",
    sync="replace",
    cursor="ROWID",
    cursor_table="COMPANY",
    unique=("CPY_0",),
)
SALESREP = Dataset(
    "SALESREP",
    (text("REPNUM_0"), text("REPNAM_0"), Column("ROWID", LONG)),
    build_sales_rep,
    load="append",
    sync="replace",
    cursor="ROWID",
    cursor_table="SALESREP",
)
CUSTOMER = Dataset(
    "BPCUSTOMER",
    (
        Column("ROWID", LONG),
        *map(text, ("BPCNUM_0", "BPCNAM_0", "BCGCOD_0", "BCGCOD_NAME_0")),
        *_coded("TSCCOD", 5),
        *map(text, ("CRY_0", "PAYS_NAME")),
    ),
    build_customer,
    load="append",
    sync="replace",
    cursor="ROWID",
    cursor_table="BPCUSTOMER",
)
SUPPLIER = Dataset(
    "BPSUPPLIER",
    (
        Column("ROWID", LONG),
        *map(text, ("BPSNUM_0", "BPSNAM_0", "BSGCOD_0", "BSGCOD_NAME_0")),
        *_coded("TSSCOD", 3),
        *map(text, ("CRY_0", "PAYS_NAME")),
    ),
    build_supplier,
    load="append",
    sync="replace",
    cursor="ROWID",
    cursor_table="BPSUPPLIER",
)
ITEM = Dataset(
    "ITMMASTER",
    (*map(text, ("ITMREF_0", "ITMDES_0", "TCLCOD_0")), *_coded("TSICOD", 5), Column("ROWID", LONG)),
    build_item,
    load="append",
    sync="replace",
    cursor="ROWID",
    cursor_table="ITMMASTER",
)
