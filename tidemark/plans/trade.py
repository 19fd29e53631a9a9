"""Quotes, orders, deliveries, invoices, purchase orders and receipts.

Each document is a header joined to its lines on the document number. Lines are the left, possibly skewed, side.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column as Expr
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions import scalars as X
from tidemark.operators.joins import MEASURE, find_skew, reduce_to, spread_join
from tidemark.operators.lookup import group_lookup, strict
from tidemark.operators.sizing import measured_small
from tidemark.plans.model import DATE, DOUBLE, INT, LONG, Column, Dataset, Inputs, text


def documents(src: Inputs, number: str, **tables: DataFrame) -> tuple[bool, *tuple[DataFrame, ...]]:
    """The given tables of a document type; in an append only their rows of the documents above the mark.

    The few new documents are found first, in the table that holds the cursor. All other tables are then cut down to
    them while they are scanned, so that no old row is shuffled. The first value says whether that was done.
    """
    new = src.above[0] if src.above and src.above[1] > 0 else None
    if new not in tables or not measured_small(tables[new].select(number)):
        return False, *tables.values()
    cut = [df if name == new else reduce_to(tables[new], number, df, number) for name, df in tables.items()]
    return True, *cut


def document_lines(
    header: DataFrame,
    lines: DataFrame,
    number: str,
    *more: DataFrame,
    line_key: str | None = None,
    few: bool = False,
) -> DataFrame:
    """Lines with their header, and with every row of further detail tables of the same document.

    Joined on the document number alone, a document with q lines and p price rows gives q·p rows: that is the
    meaning of the order datasets. ``line_key`` joins the further tables by line instead. The detail table with the
    hottest document is the side that gets spread. ``few`` states that there are few rows, not worth measuring.
    """
    if line_key is not None:
        skew = None if few else MEASURE
        result = spread_join(lines, header, [(number, number)], skew=skew)
        for detail in more:
            result = spread_join(result, detail, [(number, number), (line_key, line_key)], skew=skew)
        return result
    details = [lines, *more]
    skews = [None if few else find_skew(d, [number]) for d in details]
    hottest = max(range(len(details)), key=lambda i: skews[i].salts if skews[i] else 0)
    rest = [d for i, d in enumerate(details) if i != hottest]
    copies = "ROWID" not in details[hottest].columns
    return spread_join(details[hottest], [header, *rest], [(number, number)], skew=skews[hottest], copies=copies)


def _with_representative(src: Inputs, header: DataFrame, customer: str, few: bool) -> DataFrame:
    """Look up the representative per customer and company on the headers, before the lines multiply them.

    The number of entries travels along: only a document line that uses an ambiguous entry is an error.
    """
    reps = group_lookup(src["YREPRE"], ["YBPCNUM_0", "YCPY_0"], "YREP_0")
    on = [(customer, "YBPCNUM_0"), ("CPY_0", "YCPY_0")]
    return spread_join(header, reps, on, "left", skew=None if few else MEASURE, copies=False)


def _representative() -> Expr:
    return strict(F.col("__n"), F.col("__value"), "representant", "ITMREF_0").alias("representant")


def build_quote(src: Inputs) -> DataFrame:
    header = src["SQUOTE"].select("SQHNUM_0", "CPY_0", "QUODAT_0", "BPCORD_0", "CHGRAT_0")
    lines = src["SQUOTED"].select("ROWID", "SQHNUM_0", "ITMREF_0", "QTY_0", "NETPRI_0", "NETPRIATI_0")
    few, header, lines = documents(src, "SQHNUM_0", SQUOTE=header, SQUOTED=lines)
    rows = document_lines(_with_representative(src, header, "BPCORD_0", few), lines, "SQHNUM_0", few=few)
    result = rows.select(
        F.col("ROWID").alias("rowID"),
        F.col("CPY_0").alias("societe"),
        F.col("SQHNUM_0").alias("numDevis"),
        F.col("QUODAT_0").alias("dateDevis"),
        F.col("BPCORD_0").alias("codeClient"),
        F.col("ITMREF_0").alias("codeArticle"),
        F.col("QTY_0").alias("quantite"),
        X.amount("NETPRI_0", "QTY_0", "CHGRAT_0").alias("montantHT"),
        X.amount("NETPRIATI_0", "QTY_0", "CHGRAT_0").alias("montantTTC"),
        _representative(),
    )
    return X.conform(result, QUOTE.schema)


def build_order(src: Inputs, line_key: str | None = None) -> DataFrame:
    key = [line_key] if line_key else []
    header = src["SORDER"].select("ROWID", "SOHNUM_0", "CPY_0", "BPCORD_0", "ORDDAT_0", "CHGRAT_0")
    lines = src["SORDERQ"].select("SOHNUM_0", "ITMREF_0", "QTY_0", *key)
    prices = src["SORDERP"].select("SOHNUM_0", "NETPRI_0", "NETPRIATI_0", "CPRPRI_0", *key)
    few, header, lines, prices = documents(src, "SOHNUM_0", SORDER=header, SORDERQ=lines, SORDERP=prices)
    rows = document_lines(header, lines, "SOHNUM_0", prices, line_key=line_key, few=few)
    result = rows.select(
        F.col("ROWID").alias("rowID"),
        F.col("CPY_0").alias("societe"),
        F.col("SOHNUM_0").alias("numCommande"),
        F.col("BPCORD_0").alias("codeClient"),
        F.col("ORDDAT_0").alias("dateCommande"),
        F.col("ITMREF_0").alias("codeArticle"),
        F.col("QTY_0").alias("quantite"),
        X.amount("NETPRI_0", "CHGRAT_0", "QTY_0").alias("montantHT"),
        X.amount("NETPRIATI_0", "CHGRAT_0", "QTY_0").alias("montantTTC"),
        X.amount("CPRPRI_0", "CHGRAT_0", "QTY_0").alias("montantPrixRevi"),
    )
    return X.conform(result, ORDER.schema)


def build_delivery(src: Inputs) -> DataFrame:
    """Amounts use the quantity net of returns. ``montantTTc`` is built from the price before tax, despite its name."""
    header = src["SDELIVERY"].select("ROWID", "SDHNUM_0", "CPY_0", "BPCORD_0", "SHIDAT_0", "CHGRAT_0")
    lines = src["SDELIVERYD"].select("SDHNUM_0", "ITMREF_0", "QTY_0", "RTNQTY_0", "NETPRI_0", "CPRPRI_0")
    few, header, lines = documents(src, "SDHNUM_0", SDELIVERY=header, SDELIVERYD=lines)
    kept = X.net_quantity("QTY_0", "RTNQTY_0")
    result = document_lines(header, lines, "SDHNUM_0", few=few).select(
        F.col("ROWID").alias("rowID"),
        F.col("CPY_0").alias("societe"),
        F.col("SDHNUM_0").alias("numBL"),
        F.col("BPCORD_0").alias("codeClient"),
        F.col("SHIDAT_0").alias("dateLivraison"),
        F.col("ITMREF_0").alias("codeArticle"),
        kept.alias("quantite"),
        X.amount("NETPRI_0", "CHGRAT_0", kept).alias("montantTTc"),
        X.amount("CPRPRI_0", "CHGRAT_0", kept).alias("MontantPrixRevi"),
    )
    return X.conform(result, DELIVERY.schema)


def build_invoice(src: Inputs) -> DataFrame:
    """Amounts carry the document's sign, so credit notes are negative."""
    header = src["SINVOICE"].select("NUM_0", "CPY_0", "BPR_0", "ACCDAT_0", "SNS_0", "RATMLT_0")
    lines = src["SINVOICED"].select(
        "ROWID", "NUM_0", "SIDLIN_0", "ITMREF_0", "QTY_0", "NETPRI_0", "NETPRIATI_0", "CPRPRI_0"
    )
    few, header, lines = documents(src, "NUM_0", SINVOICE=header, SINVOICED=lines)
    rows = document_lines(_with_representative(src, header, "BPR_0", few), lines, "NUM_0", few=few)
    net = X.amount("NETPRI_0", "QTY_0", "SNS_0", "RATMLT_0")
    cost = X.amount("CPRPRI_0", "SNS_0", "RATMLT_0", "QTY_0")
    result = rows.select(
        F.col("ROWID").alias("rowID"),
        F.col("CPY_0").alias("societe"),
        F.col("NUM_0").alias("numFacture"),
        F.col("SIDLIN_0").alias("ligneFacture"),
        F.col("BPR_0").alias("codeClient"),
        F.col("ACCDAT_0").alias("dateFacture"),
        F.col("ITMREF_0").alias("codeArticle"),
        F.col("QTY_0").alias("quantite"),
        net.alias("montantHT"),
        X.amount("NETPRIATI_0", "SNS_0", "QTY_0", "RATMLT_0").alias("montantTTC"),
        _representative(),
        cost.alias("montantPrixRevi"),
        X.margin(net, cost).alias("marge"),
    )
    return X.conform(result, INVOICE.schema)


def build_purchase_order(src: Inputs, line_key: str | None = None) -> DataFrame:
    key = [line_key] if line_key else []
    header = src["PORDER"].select("ROWID", "POHNUM_0", "CPY_0", "BPSNUM_0", "ORDDAT_0", "CHGCOE_0")
    lines = src["PORDERQ"].select("POHNUM_0", "ITMREF_0", "QTYSTU_0", *key)
    prices = src["PORDERP"].select("POHNUM_0", "NETPRI_0", *key)
    few, header, lines, prices = documents(src, "POHNUM_0", PORDER=header, PORDERQ=lines, PORDERP=prices)
    rows = document_lines(header, lines, "POHNUM_0", prices, line_key=line_key, few=few)
    result = rows.select(
        "ROWID",
        F.col("CPY_0").alias("CRY_0"),
        F.col("POHNUM_0").alias("numCommande"),
        F.col("BPSNUM_0").alias("codeFournisseur"),
        F.col("ORDDAT_0").alias("dateCommande"),
        F.col("ITMREF_0").alias("codeArticle"),
        F.col("QTYSTU_0").alias("quantite"),
        X.amount("NETPRI_0", "CHGCOE_0", "QTYSTU_0").alias("montantHT"),
    )
    return X.conform(result, PURCHASE_ORDER.schema)


def build_receipt(src: Inputs) -> DataFrame:
    """The quantity is net of returns, the amount is not."""
    header = src["PRECEIPT"].select("ROWID", "PTHNUM_0", "CPY_0", "BPSNUM_0", "RCPDAT_0", "CHGCOE_0")
    lines = src["PRECEIPTD"].select("PTHNUM_0", "ITMREF_0", "QTYSTU_0", "RTNQTYSTU_0", "NETPRI_0")
    few, header, lines = documents(src, "PTHNUM_0", PRECEIPT=header, PRECEIPTD=lines)
    result = document_lines(header, lines, "PTHNUM_0", few=few).select(
        "ROWID",
        F.col("CPY_0").alias("CRY_0"),
        F.col("PTHNUM_0").alias("numReception"),
        F.col("BPSNUM_0").alias("codeFournisseur"),
        F.col("RCPDAT_0").alias("dateReception"),
        F.col("ITMREF_0").alias("codeArticle"),
        X.net_quantity("QTYSTU_0", "RTNQTYSTU_0").alias("quantite"),
        X.amount("NETPRI_0", "CHGCOE_0", "QTYSTU_0").alias("montantHT"),
    )
    return X.conform(result, RECEIPT.schema)


def _document(
    name: str, build: Callable[[Inputs], DataFrame], cursor: str, table: str, number: str, *columns: Column
) -> Dataset:
    every = (Column(cursor, LONG), *columns)
    on = {"cursor": cursor, "cursor_table": table, "number": number}
    return Dataset(name, every, build, load="append", sync="replace", **on)


QUOTE = _document(
    "SALESQUOTE",
    build_quote,
    "rowID",
    "SQUOTED",
    "SQHNUM_0",
    text("societe"),
    text("numDevis"),
    Column("dateDevis", DATE),
    text("codeClient"),
    text("codeArticle"),
    Column("quantite", INT),
    Column("montantHT", DOUBLE),
    Column("montantTTC", DOUBLE),
    text("representant"),
)
ORDER = _document(
    "SALESORDER",
    build_order,
    "rowID",
    "SORDER",
    "SOHNUM_0",
    text("societe"),
    text("numCommande"),
    text("codeClient"),
    Column("dateCommande", DATE),
    text("codeArticle"),
    Column("quantite", INT),
    Column("montantHT", DOUBLE),
    Column("montantTTC", DOUBLE),
    Column("montantPrixRevi", DOUBLE),
)
DELIVERY = _document(
    "SDELIVERY",
    build_delivery,
    "rowID",
    "SDELIVERY",
    "SDHNUM_0",
    text("societe"),
    text("numBL"),
    text("codeClient"),
    Column("dateLivraison", DATE),
    text("codeArticle"),
    Column("quantite", DOUBLE),
    Column("montantTTc", DOUBLE),
    Column("MontantPrixRevi", DOUBLE),
)
INVOICE = _document(
    "SALESINVOICE",
    build_invoice,
    "rowID",
    "SINVOICED",
    "NUM_0",
    text("societe"),
    text("numFacture"),
    Column("ligneFacture", INT),
    text("codeClient"),
    Column("dateFacture", DATE),
    text("codeArticle"),
    Column("quantite", DOUBLE),
    Column("montantHT", DOUBLE),
    Column("montantTTC", DOUBLE),
    text("representant"),
    Column("montantPrixRevi", DOUBLE),
    Column("marge", DOUBLE),
)
PURCHASE_ORDER = _document(
    "PORDER",
    build_purchase_order,
    "ROWID",
    "PORDER",
    "POHNUM_0",
    text("CRY_0"),
    text("numCommande"),
    text("codeFournisseur"),
    Column("dateCommande", DATE),
    text("codeArticle"),
    Column("quantite", INT),
    Column("montantHT", DOUBLE),
)
RECEIPT = _document(
    "PRECEIPT",
    build_receipt,
    "ROWID",
    "PRECEIPT",
    "PTHNUM_0",
    text("CRY_0"),
    text("numReception"),
    text("codeFournisseur"),
    Column("dateReception", DATE),
    text("codeArticle"),
    Column("quantite", INT),
    Column("montantHT", DOUBLE),
)
