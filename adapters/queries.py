"""One query per operator over the test tables, each with the SQL that must give the same rows."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adapters.tpch import END, duckdb_statement, inputs, rows_of, spark_source
from tidemark.functions import scalars as X
from tidemark.operators import loads, quality, rows, runs
from tidemark.operators.calendar import CAPACITY_START, calendar, date_spine
from tidemark.operators.joins import merge_on, new_rows, spine_cross
from tidemark.operators.keys import assign_ids
from tidemark.operators.lookup import COUNTRY, label_dict, label_unique, lookup, lookup_family, table_label
from tidemark.plans import catalog, partners, shopfloor, trade
from tidemark.session import freeing, shared_dir, stage
from tidemark.sources.profiles import Profile, reader
from tidemark.sources.records import to_records
from tidemark.sources.store import Store
from tidemark.warehouse import CREATED, EXISTS, FAILED, IN_STEP, LOADED, NOTHING_NEW, LoadFailed, Warehouse

Query = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Check:
    query: Query
    sql: str | None


CHECKS: dict[str, Check] = {}


def register(name: str, sql: str | None) -> Callable[[Query], Query]:
    def add(query: Query) -> Query:
        CHECKS[name] = Check(query, sql)
        return query

    return add


# --- SQL of the sixteen transformations --------------------------------------------------------------------------

_FRA = "LANGUE_0 = 'FRA'"


def _category(code: str, name: str) -> str:
    return (
        f"(SELECT TEXTE_0 FROM ATEXTRA WHERE ZONE_0 = 'DESAXX' AND CODFIC_0 = 'BPCCATEG' AND {_FRA} "
        f"AND IDENT1_0 = {code}) AS {name}"
    )


def _statistic(prefix: str, first: int, count: int) -> str:
    return ", ".join(
        f"{prefix}_{i}, (SELECT TEXTE_0 FROM ATEXTRA WHERE ZONE_0 LIKE '%LNGDES%' AND CODFIC_0 = 'ATABDIV' AND {_FRA} "
        f"AND IDENT1_0 = '{first + i}' AND IDENT2_0 = {prefix}_{i}) AS {prefix}_NAME_{i}"
        for i in range(count)
    )


_COUNTRY = (
    f"(SELECT TEXTE_0 FROM ATEXTRA WHERE CODFIC_0 = 'TABCOUNTRY' AND ZONE_0 LIKE '%CRYDES%' AND {_FRA} "
    "AND IDENT1_0 = CRY_0) AS PAYS_NAME"
)


def _tracked(time_type: int, hours: str) -> str:
    per_unit = "CASE WHEN TIMUOMCOD_0 = 2 THEN {0} / CAST(60 AS DOUBLE) ELSE {0} END"
    return (
        "SELECT MFGTRKNUM_0 AS numerosuivi, LEGCPY_0 AS company, CPLQTY_0 AS quantite, REJCPLQTY_0 AS quantiterejet, "
        f"CPLWST_0 AS posterealise, CPLLAB_0 AS morealise, {per_unit.format('CPLSETTIM_0')} AS tempsreglage, "
        f'{per_unit.format("CPLOPETIM_0")} AS "{hours}", MSGNUM_0 AS message, IPTDAT_0 AS dateimputation, '
        "TIMTYP_0 AS Time_type, TIMUOMCOD_0 AS Time_unit "
        f"FROM MFGOPETRK JOIN FACILITY ON FCY_0 = MFGFCY_0 WHERE TIMTYP_0 = {time_type}"
    )


def _production(table: str) -> str:
    return (
        "SELECT MFGTRKNUM_0 AS numerosuivi, ITMREF_0 AS codearticle, LEGCPY_0 AS company, "
        f"CPLQTY_0 AS quantiterealise, IPTDAT_0 AS daterealisation FROM {table} JOIN FACILITY ON FCY_0 = MFGFCY_0"
    )


_DAYS = f"range(DATE '{CAPACITY_START}', DATE '{END}' + 1, INTERVAL 1 DAY)"
_CASE_DAYS = " ".join(f"WHEN {i + 1} THEN DAYCAP_{i}" for i in range(7))

# Name → (source tables, statement).
TARGETS: dict[str, tuple[str, str]] = {
    "t02": ("COMPANY", "SELECT CPY_0, CPYNAM_0, ROWID FROM COMPANY"),
    "t03": ("SALESREP", "SELECT REPNUM_0, REPNAM_0, ROWID FROM SALESREP"),
    "t04": (
        "BPCUSTOMER BPARTNER ATEXTRA",
        f"SELECT ROWID, BPCNUM_0, BPCNAM_0, BCGCOD_0, {_category('BCGCOD_0', 'BCGCOD_NAME_0')}, "
        f"{_statistic('TSCCOD', 30, 5)}, CRY_0, {_COUNTRY} FROM BPCUSTOMER JOIN BPARTNER ON BPCNUM_0 = BPRNUM_0",
    ),
    "t05": (
        "BPSUPPLIER BPARTNER_S ATEXTRA",
        f"SELECT ROWID, BPSNUM_0, BPSNAM_0, BSGCOD_0, {_category('BSGCOD_0', 'BSGCOD_NAME_0')}, "
        f"{_statistic('TSSCOD', 40, 3)}, CRY_0, {_COUNTRY} FROM BPSUPPLIER JOIN BPARTNER_S ON BPSNUM_0 = BPRNUM_0",
    ),
    "t06": (
        "ITMMASTER ATEXTRA",
        "SELECT ITMREF_0, ITMDES1_0 || ' , ' || ITMDES2_0 || ' , ' || ITMDES3_0 AS ITMDES_0, TCLCOD_0, "
        f"{_statistic('TSICOD', 20, 5)}, ROWID FROM ITMMASTER",
    ),
    "t07": (
        "SQUOTE SQUOTED YREPRE",
        "SELECT d.ROWID AS rowID, h.CPY_0 AS societe, h.SQHNUM_0 AS numDevis, CAST(QUODAT_0 AS DATE) AS dateDevis, "
        "BPCORD_0 AS codeClient, ITMREF_0 AS codeArticle, CAST(trunc(QTY_0) AS INTEGER) AS quantite, "
        "NETPRI_0 * QTY_0 * CHGRAT_0 AS montantHT, NETPRIATI_0 * QTY_0 * CHGRAT_0 AS montantTTC, "
        "YREP_0 AS representant FROM SQUOTE h JOIN SQUOTED d ON h.SQHNUM_0 = d.SQHNUM_0 "
        "LEFT JOIN YREPRE ON YBPCNUM_0 = BPCORD_0 AND YCPY_0 = h.CPY_0",
    ),
    "t08": (
        "SORDER SORDERQ SORDERP",
        "SELECT h.ROWID AS rowID, h.CPY_0 AS societe, h.SOHNUM_0 AS numCommande, BPCORD_0 AS codeClient, "
        "CAST(ORDDAT_0 AS DATE) AS dateCommande, q.ITMREF_0 AS codeArticle, CAST(trunc(QTY_0) AS INTEGER) AS quantite, "
        "NETPRI_0 * CHGRAT_0 * QTY_0 AS montantHT, NETPRIATI_0 * CHGRAT_0 * QTY_0 AS montantTTC, "
        "CPRPRI_0 * CHGRAT_0 * QTY_0 AS montantPrixRevi FROM SORDER h "
        "JOIN SORDERQ q ON q.SOHNUM_0 = h.SOHNUM_0 JOIN SORDERP p ON p.SOHNUM_0 = h.SOHNUM_0",
    ),
    "t09": (
        "SDELIVERY SDELIVERYD",
        "SELECT h.ROWID AS rowID, h.CPY_0 AS societe, h.SDHNUM_0 AS numBL, BPCORD_0 AS codeClient, "
        "CAST(SHIDAT_0 AS DATE) AS dateLivraison, ITMREF_0 AS codeArticle, QTY_0 - RTNQTY_0 AS quantite, "
        "NETPRI_0 * CHGRAT_0 * (QTY_0 - RTNQTY_0) AS montantTTc, "
        "CPRPRI_0 * CHGRAT_0 * (QTY_0 - RTNQTY_0) AS MontantPrixRevi "
        "FROM SDELIVERY h JOIN SDELIVERYD d ON h.SDHNUM_0 = d.SDHNUM_0",
    ),
    "t10": (
        "SINVOICE SINVOICED YREPRE",
        "SELECT d.ROWID AS rowID, h.CPY_0 AS societe, h.NUM_0 AS numFacture, SIDLIN_0 AS ligneFacture, "
        "BPR_0 AS codeClient, CAST(ACCDAT_0 AS DATE) AS dateFacture, ITMREF_0 AS codeArticle, QTY_0 AS quantite, "
        "NETPRI_0 * QTY_0 * SNS_0 * RATMLT_0 AS montantHT, NETPRIATI_0 * SNS_0 * QTY_0 * RATMLT_0 AS montantTTC, "
        "YREP_0 AS representant, CPRPRI_0 * SNS_0 * RATMLT_0 * QTY_0 AS montantPrixRevi, "
        "NETPRI_0 * QTY_0 * SNS_0 * RATMLT_0 - CPRPRI_0 * SNS_0 * RATMLT_0 * QTY_0 AS marge "
        "FROM SINVOICE h JOIN SINVOICED d ON h.NUM_0 = d.NUM_0 "
        "LEFT JOIN YREPRE ON YBPCNUM_0 = BPR_0 AND YCPY_0 = h.CPY_0",
    ),
    "t11": (
        "PORDER PORDERQ PORDERP",
        "SELECT h.ROWID AS ROWID, h.CPY_0 AS CRY_0, h.POHNUM_0 AS numCommande, BPSNUM_0 AS codeFournisseur, "
        "CAST(ORDDAT_0 AS DATE) AS dateCommande, q.ITMREF_0 AS codeArticle, "
        "CAST(trunc(QTYSTU_0) AS INTEGER) AS quantite, NETPRI_0 * CHGCOE_0 * QTYSTU_0 AS montantHT FROM PORDER h "
        "JOIN PORDERQ q ON q.POHNUM_0 = h.POHNUM_0 JOIN PORDERP p ON p.POHNUM_0 = h.POHNUM_0",
    ),
    "t12": (
        "PRECEIPT PRECEIPTD",
        "SELECT h.ROWID AS ROWID, h.CPY_0 AS CRY_0, h.PTHNUM_0 AS numReception, BPSNUM_0 AS codeFournisseur, "
        "CAST(RCPDAT_0 AS DATE) AS dateReception, ITMREF_0 AS codeArticle, "
        "CAST(trunc(QTYSTU_0 - RTNQTYSTU_0) AS INTEGER) AS quantite, NETPRI_0 * CHGCOE_0 * QTYSTU_0 AS montantHT "
        "FROM PRECEIPT h JOIN PRECEIPTD d ON h.PTHNUM_0 = d.PTHNUM_0",
    ),
    "t13": ("MFGITMTRK FACILITY", _production("MFGITMTRK")),
    "t13_twice": ("MFGITMTRK_TWICE FACILITY", _production("MFGITMTRK_TWICE")),
    "t14": ("MFGOPETRK FACILITY", _tracked(1, "tempsopérealise")),
    "t15": ("MFGOPETRK FACILITY", _tracked(3, "tempsoperealise")),
    "t16": (
        "WORKSTATIO FACILITY TABWEEDIA",
        "SELECT WST_0 AS poste, w.TWD_0 AS schema, WSTDES_0 AS designationPoste, LEGCPY_0 AS company, "
        f"CAST(day AS DATE) AS dateschema, CASE isodow(day) {_CASE_DAYS} END AS tempstheorique "
        "FROM WORKSTATIO w JOIN FACILITY ON FCY_0 = WCRFCY_0 "
        f"JOIN TABWEEDIA t ON w.TWD_0 IS NOT DISTINCT FROM t.TWD_0, {_DAYS} AS r(day)",
    ),
}


def sql(targets: str, body: str, sources: str = "") -> str:
    """``body`` with the named transformations and source tables before it."""
    names = sources.split()
    for t in targets.split():
        names += [s for s in TARGETS[t][0].split() if s not in names]
    parts = [f"{n} AS ({duckdb_statement(n)})" for n in names]
    parts += [f"{t} AS ({TARGETS[t][1]})" for t in targets.split()]
    return f"WITH {', '.join(parts)} {body}"


def target(name: str) -> str:
    return sql(name, f"SELECT * FROM {name}")


# --- the transformations -----------------------------------------------------------------------------------------


def _order_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row: 1 January of the first order year, and the last order date."""
    day = F.col("o_orderdate").cast("date")
    return rows_of(spark, sf_dir, "orders").agg(F.trunc(F.min(day), "year").alias("lo"), F.max(day).alias("hi"))


_SPINE = (
    "SELECT CAST(unnest(range(date_trunc('year', min(o_orderdate)), max(o_orderdate) + INTERVAL 1 DAY, "
    "INTERVAL 1 DAY)) AS DATE) AS day FROM orders"
)


def _parts(table: str, day: str) -> str:
    names = {"Day": f"day({day})", "Month": f"month({day})", "Year": f"year({day})", "Week": f"week({day})"}
    names["Semester"] = f"(month({day}) - 1) // 6 + 1"
    return f"SELECT {', '.join(f'CAST({e} AS INTEGER) AS {n}' for n, e in names.items())} FROM {table}"


def _spine(spark: SparkSession, sf_dir: str) -> DataFrame:
    return date_spine(_order_dates(spark, sf_dir), F.col("lo"), F.col("hi"))


@register("g1_date_spine", _SPINE)
def g1(spark, sf_dir):
    return _spine(spark, sf_dir)


@register("t01_calendar", _parts(f"({_SPINE}) AS s", "day"))
def t01(spark, sf_dir):
    return calendar(_spine(spark, sf_dir))


def _built(name: str, dataset: str, **other: str) -> None:
    @register(name, target(name[:3]))
    def run(spark, sf_dir):
        return catalog.DATASETS[dataset].build(inputs(spark, sf_dir, **other))


_built("t02_company", "COMPANY")
_built("t03_salesrep", "SALESREP")
_built("t04_customer", "BPCUSTOMER")
_built("t05_supplier", "BPSUPPLIER", BPARTNER="BPARTNER_S")
_built("t06_item", "ITMMASTER")
_built("t07_quote", "SALESQUOTE")
_built("t08_order", "SALESORDER")
_built("t09_delivery", "SDELIVERY")
_built("t10_sales_invoice", "SALESINVOICE")
_built("t11_porder", "PORDER")
_built("t12_receipt", "PRECEIPT")
_built("t13_production", "PRODUCTION")
_built("t14_time_of", "SUIVITEMPSOF")
_built("t15_time_misc", "SUIVITEMPSDIVERS")
_built("t16_capacity", "POSTEDECHARGE")


# --- scalar expressions ------------------------------------------------------------------------------------------


@register(
    "x8_time_unit",
    sql(
        "",
        "SELECT MFGTRKNUM_0, CASE WHEN TIMUOMCOD_0 = 2 THEN CPLOPETIM_0 / CAST(60 AS DOUBLE) ELSE CPLOPETIM_0 END "
        "AS hours FROM MFGOPETRK",
        "MFGOPETRK",
    ),
)
def x8(spark, sf_dir):
    src = inputs(spark, sf_dir)["MFGOPETRK"]
    return src.select("MFGTRKNUM_0", X.to_hours("CPLOPETIM_0", "TIMUOMCOD_0").alias("hours"))


@register(
    "x9_describe",
    sql("", "SELECT ITMREF_0, ITMDES1_0 || ' , ' || ITMDES2_0 || ' , ' || ITMDES3_0 AS text FROM ITMMASTER", "ITMMASTER"),
)
def x9(spark, sf_dir):
    src = inputs(spark, sf_dir)["ITMMASTER"]
    return src.select("ITMREF_0", X.describe("ITMDES1_0", "ITMDES2_0", "ITMDES3_0").alias("text"))


@register("x10_date_parts", _parts("orders", "o_orderdate"))
def x10(spark, sf_dir):
    return calendar(rows_of(spark, sf_dir, "orders").select(F.col("o_orderdate").alias("day")))


@register("x13_weekday", "SELECT o_orderkey, CAST(isodow(o_orderdate) - 1 AS INTEGER) AS weekday FROM orders")
def x13(spark, sf_dir):
    return rows_of(spark, sf_dir, "orders").select("o_orderkey", X.weekday("o_orderdate").alias("weekday"))


@register(
    "x14_by_weekday",
    "SELECT o_orderkey, CASE isodow(o_orderdate) "
    + " ".join(f"WHEN {i} THEN o_totalprice * {i}" for i in range(1, 8))
    + " END AS value FROM orders",
)
def x14(spark, sf_dir):
    orders = rows_of(spark, sf_dir, "orders")
    week = [f"d{i}" for i in range(1, 8)]
    wide = orders.select("*", *[(F.col("o_totalprice") * i).alias(f"d{i}") for i in range(1, 8)])
    return wide.select("o_orderkey", X.by_weekday("o_orderdate", week).alias("value"))


@register(
    "x15_conform",
    sql(
        "",
        "SELECT NUM_0, CAST(ACCDAT_0 AS DATE) AS day, CAST(trunc(-RATMLT_0 * 7 / 2) AS INTEGER) AS n FROM SINVOICE",
        "SINVOICE",
    ),
)
def x15(spark, sf_dir):
    src = inputs(spark, sf_dir)["SINVOICE"]
    raw = src.select("NUM_0", F.col("ACCDAT_0").alias("day"), (-F.col("RATMLT_0") * 7 / 2).alias("n"))
    return X.conform(raw, spark.createDataFrame([], "NUM_0 string, day date, n int").schema)


# --- joins and look-ups ------------------------------------------------------------------------------------------

_DICT = f"SELECT IDENT2_0 AS code, TEXTE_0 AS text FROM ATEXTRA WHERE {_FRA}"


@register(
    "p4_label_dict",
    sql("", f"{_DICT} AND CODFIC_0 = 'ATABDIV' AND ZONE_0 LIKE '%LNGDES%' AND IDENT1_0 = '30'", "ATEXTRA"),
)
def p4(spark, sf_dir):
    return label_dict(inputs(spark, sf_dir)["ATEXTRA"], table_label(30))


@register(
    "p8_cursor_filter",
    sql("", "SELECT ROWID, REPNUM_0 FROM SALESREP WHERE ROWID > (SELECT avg(ROWID) FROM SALESREP)", "SALESREP"),
)
def p8(spark, sf_dir):
    reps = inputs(spark, sf_dir)["SALESREP"]
    mark = reps.agg(F.avg("ROWID").cast("long")).first()[0]
    return loads.append_above(reps, mark, "ROWID").select("ROWID", "REPNUM_0")


@register(
    "j1_header_lines",
    sql(
        "",
        "SELECT d.SDHNUM_0, BPCORD_0, ITMREF_0, QTY_0 FROM SDELIVERYD d JOIN SDELIVERY h ON h.SDHNUM_0 = d.SDHNUM_0",
        "SDELIVERY SDELIVERYD",
    ),
)
def j1(spark, sf_dir):
    src = inputs(spark, sf_dir)
    header = src["SDELIVERY"].select("SDHNUM_0", "BPCORD_0")
    return trade.document_lines(header, src["SDELIVERYD"].select("SDHNUM_0", "ITMREF_0", "QTY_0"), "SDHNUM_0")


@register(
    "j2_partner",
    sql("", "SELECT BPCNUM_0, BPCNAM_0, CRY_0 FROM BPCUSTOMER JOIN BPARTNER ON BPCNUM_0 = BPRNUM_0", "BPCUSTOMER BPARTNER"),
)
def j2(spark, sf_dir):
    src = inputs(spark, sf_dir)
    return partners.with_partner(src, src["BPCUSTOMER"].select("BPCNUM_0", "BPCNAM_0"), "BPCNUM_0")


@register(
    "j3_site_company",
    sql(
        "",
        "SELECT MFGTRKNUM_0, MFGFCY_0, LEGCPY_0 AS company FROM MFGITMTRK JOIN FACILITY ON FCY_0 = MFGFCY_0",
        "MFGITMTRK FACILITY",
    ),
)
def j3(spark, sf_dir):
    src = inputs(spark, sf_dir)
    return shopfloor.at_company(src, src["MFGITMTRK"].select("MFGTRKNUM_0", "MFGFCY_0"), "MFGFCY_0")


@register(
    "j4_order_by_line",
    sql(
        "",
        TARGETS["t08"][1].replace(
            "p.SOHNUM_0 = h.SOHNUM_0", "p.SOHNUM_0 = h.SOHNUM_0 AND p.LINE_0 = q.LINE_0"
        ),
        TARGETS["t08"][0],
    ),
)
def j4(spark, sf_dir):
    return trade.build_order(inputs(spark, sf_dir), line_key="LINE_0")


@register(
    "j5_null_merge",
    sql(
        "",
        "SELECT WST_0, w.TWD_0, DAYCAP_0, DAYCAP_6 FROM WORKSTATIO w "
        "JOIN TABWEEDIA t ON w.TWD_0 IS NOT DISTINCT FROM t.TWD_0",
        "WORKSTATIO TABWEEDIA",
    ),
)
def j5(spark, sf_dir):
    src = inputs(spark, sf_dir)
    weeks = src["TABWEEDIA"].select("TWD_0", "DAYCAP_0", "DAYCAP_6")
    return merge_on(src["WORKSTATIO"].select("WST_0", "TWD_0"), weeks, "TWD_0")


@register(
    "j6_spine_cross",
    f"SELECT o_orderkey, CAST(unnest(range(o_orderdate, o_orderdate + INTERVAL 7 DAY, INTERVAL 1 DAY)) AS DATE) AS day "
    "FROM orders",
)
def j6(spark, sf_dir):
    orders = rows_of(spark, sf_dir, "orders").select("o_orderkey", F.col("o_orderdate").cast("date").alias("d"))
    return spine_cross(orders, F.col("d"), F.date_add("d", 6)).drop("d")


_ON_KEY = "t.poste = s.poste AND t.schema = s.schema AND t.dateschema = s.dateschema"


@register(
    "j7_new_rows",
    sql(
        "t16",
        "SELECT s.* FROM t16 s ANTI JOIN (SELECT DISTINCT poste, schema, dateschema FROM t16 WHERE tempstheorique > 0) t "
        f"ON {_ON_KEY}",
    ),
)
def j7(spark, sf_dir):
    grid = shopfloor.build_capacity(inputs(spark, sf_dir))
    return new_rows(grid, grid.filter("tempstheorique > 0"), ["poste", "schema", "dateschema"])


@register(
    "j8_absent_keys",
    sql("", "SELECT NUM_0 FROM SINVOICE WHERE NUM_0 NOT IN (SELECT NUM_0 FROM SINVOICED WHERE QTY_0 > 12)", "SINVOICE SINVOICED"),
)
def j8(spark, sf_dir):
    src = inputs(spark, sf_dir)
    return new_rows(src["SINVOICE"].select("NUM_0"), src["SINVOICED"].filter("QTY_0 > 12"), ["NUM_0"])


@register(
    "j9_new_days",
    f"{_parts(f'({_SPINE}) AS s', 'day')} "
    "WHERE day NOT IN (SELECT CAST(o_orderdate AS DATE) FROM orders WHERE o_orderstatus = 'F')",
)
def j9(spark, sf_dir):
    done = rows_of(spark, sf_dir, "orders").filter("o_orderstatus = 'F'")
    known = calendar(done.select(F.col("o_orderdate").cast("date").alias("day")))
    return new_rows(calendar(_spine(spark, sf_dir)), known, ["Day", "Month", "Year"])


@register("j11_strict_lookup", sql("", f"SELECT BPRNUM_0, CRY_0, {_COUNTRY} FROM BPARTNER", "BPARTNER ATEXTRA"))
def j11(spark, sf_dir):
    src = inputs(spark, sf_dir)
    return lookup(src["BPARTNER"], label_dict(src["ATEXTRA"], COUNTRY), [("CRY_0", "code")], "text", "PAYS_NAME")


@register(
    "j12_two_key_lookup",
    sql(
        "",
        "SELECT NUM_0, BPR_0, CPY_0, YREP_0 AS rep FROM SINVOICE "
        "LEFT JOIN YREPRE ON YBPCNUM_0 = BPR_0 AND YCPY_0 = CPY_0",
        "SINVOICE YREPRE",
    ),
)
def j12(spark, sf_dir):
    src = inputs(spark, sf_dir)
    header = src["SINVOICE"].select("NUM_0", "BPR_0", "CPY_0")
    return lookup(header, src["YREPRE"], [("BPR_0", "YBPCNUM_0"), ("CPY_0", "YCPY_0")], "YREP_0", "rep")


@register(
    "j13_lookup_family",
    sql("", f"SELECT BPCNUM_0, {_statistic('TSCCOD', 30, 5)} FROM BPCUSTOMER", "BPCUSTOMER ATEXTRA"),
)
def j13(spark, sf_dir):
    src = inputs(spark, sf_dir)
    codes = {f"TSCCOD_NAME_{i}": (f"TSCCOD_{i}", table_label(30 + i)) for i in range(5)}
    customers = src["BPCUSTOMER"].select("BPCNUM_0", *[f"TSCCOD_{i}" for i in range(5)])
    return lookup_family(customers, src["ATEXTRA"], codes)


# --- rows, keys, rules -------------------------------------------------------------------------------------------


@register("a1_high_water_mark", sql("t10", "SELECT CAST(coalesce(max(rowID), 0) AS BIGINT) AS mark FROM t10"))
def a1(spark, sf_dir):
    invoices = trade.build_invoice(inputs(spark, sf_dir))
    return invoices.agg(X.or_zero(F.max("rowID")).alias("mark"))


@register("e1_distinct", sql("t16", "SELECT DISTINCT * FROM t16"))
def e1(spark, sf_dir):
    return shopfloor.build_capacity_distinct(inputs(spark, sf_dir))


@register("e1_distinct_rows", sql("t12", "SELECT DISTINCT dateReception, CRY_0, codeFournisseur FROM t12"))
def e1_rows(spark, sf_dir):
    receipts = trade.build_receipt(inputs(spark, sf_dir))
    return rows.distinct(receipts.select("dateReception", "CRY_0", "codeFournisseur"))


def _nth(direction: str) -> str:
    order = ", ".join(f"{c} {direction}" for c in ("daterealisation", "codearticle", "company", "quantiterealise"))
    return (
        "SELECT numerosuivi, codearticle, company, quantiterealise, daterealisation FROM (SELECT *, row_number() OVER "
        f"(PARTITION BY numerosuivi ORDER BY {order}) AS n FROM t13_twice) AS v WHERE n = 1"
    )


def _twice(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shopfloor.build_production(inputs(spark, sf_dir, MFGITMTRK="MFGITMTRK_TWICE"))


_KEY, _ORDER = ["numerosuivi"], ["daterealisation"]


@register("e3a_first_wins", sql("t13_twice", _nth("ASC")))
def e3a(spark, sf_dir):
    return rows.collapse(_twice(spark, sf_dir), _KEY, _ORDER, "first")


@register("e3b_last_wins", sql("t13_twice", _nth("DESC")))
def e3b(spark, sf_dir):
    return rows.collapse(_twice(spark, sf_dir), _KEY, _ORDER, "last")


# A stored state that is out of step: invoices of status company C1 have lost their discount, small ones are missing.
_OFF = "SELECT * REPLACE (CASE WHEN societe = 'C1' THEN montantHT + 1 ELSE montantHT END AS montantHT) FROM t10 "
_OFF += "WHERE quantite >= 2"


def _off(invoices: DataFrame) -> DataFrame:
    changed = F.when(F.col("societe") == "C1", F.col("montantHT") + 1).otherwise(F.col("montantHT"))
    return invoices.filter("quantite >= 2").withColumn("montantHT", changed)


@register(
    "e4_equal",
    sql(
        "t10",
        "SELECT surplus, count(*) AS n FROM (SELECT * EXCLUDE (sign), CAST(sum(sign) AS BIGINT) AS surplus FROM "
        f"(SELECT *, 1 AS sign FROM t10 UNION ALL SELECT *, -1 FROM ({_OFF}) AS o) AS b GROUP BY ALL) AS g "
        "WHERE surplus <> 0 GROUP BY surplus",
    ),
)
def e4(spark, sf_dir):
    invoices = trade.build_invoice(inputs(spark, sf_dir))
    return rows.signed_counts(invoices, _off(invoices)).groupBy("surplus").agg(F.count(F.lit(1)).alias("n"))


@register(
    "e4_same_rows",
    sql(
        "t10",
        f"SELECT NOT EXISTS (SELECT * FROM t10 EXCEPT ALL (SELECT * FROM t10 ORDER BY rowID)) AS itself, NOT EXISTS "
        f"(SELECT * FROM t10 EXCEPT ALL ({_OFF})) AS off",
    ),
)
def e4_same(spark, sf_dir):
    with freeing(spark):
        invoices = stage(trade.build_invoice(inputs(spark, sf_dir)))
    other_order = invoices.repartition("codeArticle", "rowID")
    answers = rows.same_rows(invoices, other_order), rows.same_rows(invoices, _off(invoices))
    return spark.createDataFrame([answers], "itself boolean, off boolean")


@register(
    "e5_diff",
    sql(
        "t10",
        "SELECT coalesce(s.rowID, t.rowID) AS rowID, CASE WHEN t.rowID IS NULL THEN 'missing' "
        f"WHEN s.rowID IS NULL THEN 'extra' ELSE 'changed' END AS status FROM t10 s FULL JOIN ({_OFF}) AS t "
        "ON s.rowID = t.rowID WHERE t.rowID IS NULL OR s.rowID IS NULL OR s.montantHT <> t.montantHT",
    ),
)
def e5(spark, sf_dir):
    invoices = trade.build_invoice(inputs(spark, sf_dir))
    return rows.diff_rows(invoices, _off(invoices), ["rowID"])


@register("k1_surrogate", sql("t10", "SELECT row_number() OVER (ORDER BY rowID) AS id, * FROM t10"))
def k1(spark, sf_dir):
    return assign_ids(trade.build_invoice(inputs(spark, sf_dir)), order_by=["rowID"])


@register(
    "q1_unique", sql("t13_twice", "SELECT numerosuivi, count(*) AS n FROM t13_twice GROUP BY 1 HAVING count(*) > 1")
)
def q1(spark, sf_dir):
    return quality.unique(_twice(spark, sf_dir), _KEY)


@register("q2_not_null", sql("t06", "SELECT ITMREF_0, ITMDES_0 FROM t06 WHERE ITMDES_0 IS NULL"))
def q2(spark, sf_dir):
    items = partners.build_item(inputs(spark, sf_dir)).select("ITMREF_0", "ITMDES_0")
    return quality.not_null(items, ["ITMDES_0"])


@register("q3_length", sql("t06", "SELECT ITMREF_0, ITMDES_0 FROM t06 WHERE length(ITMDES_0) > 30"))
def q3(spark, sf_dir):
    items = partners.build_item(inputs(spark, sf_dir)).select("ITMREF_0", "ITMDES_0")
    return quality.max_length(items, {"ITMDES_0": 30})


@register(
    "q4_label_unique",
    sql(
        "",
        "SELECT CODFIC_0, IDENT1_0, IDENT2_0, count(*) AS n FROM ATEXTRA GROUP BY ALL HAVING count(*) > 1",
        "ATEXTRA",
    ),
)
def q4(spark, sf_dir):
    return label_unique(inputs(spark, sf_dir)["ATEXTRA"], ["CODFIC_0", "IDENT1_0", "IDENT2_0"])


_ITEM_RULES = quality.Rules(not_null=["ITMDES_0"], max_length={"ITMDES_0": 30, "TCLCOD_0": 6})
_BAD = {
    "ITMDES_0 is null": "ITMDES_0 IS NULL",
    "ITMDES_0 is longer than 30": "length(ITMDES_0) > 30",
    "TCLCOD_0 is longer than 6": "length(TCLCOD_0) > 6",
}


@register(
    "q5_violations",
    sql("t06", " UNION ALL ".join(f"SELECT '{r}' AS rule, count(*) AS n FROM t06 WHERE {c}" for r, c in _BAD.items())),
)
def q5(spark, sf_dir):
    items = partners.build_item(inputs(spark, sf_dir))
    counts = [F.struct(F.lit(r).alias("rule"), F.count_if(c).alias("n")) for r, c in _ITEM_RULES.checks().items()]
    return items.agg(F.array(*counts).alias("found")).select(F.inline("found"))


_REASON = "concat_ws('; ', " + ", ".join(f"CASE WHEN {c} THEN '{r}' END" for r, c in _BAD.items()) + ")"


@register(
    "s7_quarantine",
    sql("t06", f"SELECT ITMREF_0, reason FROM (SELECT *, {_REASON} AS reason FROM t06) AS m WHERE reason <> ''"),
)
def s7(spark, sf_dir):
    _, rejected = quality.enforce(partners.build_item(inputs(spark, sf_dir)), _ITEM_RULES, "quarantine")
    return rejected.select("ITMREF_0", "reason")


@register(
    "s7_accepted",
    sql("t06", f"SELECT ITMREF_0, ITMDES_0 FROM (SELECT *, {_REASON} AS reason FROM t06) AS m WHERE reason = ''"),
)
def s7_good(spark, sf_dir):
    accepted, _ = quality.enforce(partners.build_item(inputs(spark, sf_dir)), _ITEM_RULES, "quarantine")
    return accepted.select("ITMREF_0", "ITMDES_0")


@register("s8_records", sql("t04", "SELECT CAST(to_json(t) AS VARCHAR) AS record FROM t04 AS t"))
def s8(spark, sf_dir):
    return to_records(partners.build_customer(inputs(spark, sf_dir)))


# --- load protocols as pure functions ----------------------------------------------------------------------------


def _above(name: str, cut: str = "0.8") -> str:
    """Rows above the mark of a target that holds the first part of the cursor range."""
    return sql(
        name,
        f"SELECT * FROM {name} WHERE rowID > (SELECT coalesce(max(rowID), 0) FROM {name} "
        f"WHERE rowID <= (SELECT max(rowID) FROM {name}) * CAST({cut} AS DOUBLE))",
    )


def _append(build, spark: SparkSession, sf_dir: str) -> DataFrame:
    source = build(inputs(spark, sf_dir))
    top = source.agg(F.max("rowID")).first()[0]
    mark = rows.high_water_mark(source.filter(F.col("rowID") <= F.lit(top) * F.lit(0.8)), "rowID")
    return loads.append_above(source, mark, "rowID")


@register("l1_append_hwm", _above("t10"))
def l1(spark, sf_dir):
    return _append(trade.build_invoice, spark, sf_dir)


@register("l1_append_header_cursor", _above("t09"))
def l1_header(spark, sf_dir):
    return _append(trade.build_delivery, spark, sf_dir)


def _increment(build, cursor: str, table: str, number: str) -> Query:
    """What a load appends: the transformation of an increment, above the mark of the first part of the cursors."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        source = inputs(spark, sf_dir)
        whole = build(source)
        top = whole.agg(F.max(cursor)).first()[0]
        mark = rows.high_water_mark(whole.filter(F.col(cursor) <= F.lit(top) * F.lit(0.8)), cursor)
        return build(source.increment(table, mark, number))

    return query


for _name, _ds in {
    "t07": trade.QUOTE,
    "t08": trade.ORDER,
    "t09": trade.DELIVERY,
    "t10": trade.INVOICE,
    "t11": trade.PURCHASE_ORDER,
    "t12": trade.RECEIPT,
}.items():
    register(f"l1_increment_{_name}", _above(_name))(_increment(_ds.build, _ds.cursor, _ds.cursor_table, _ds.number))


# Stored state for insert and merge: productions up to a date, changed in company C1, and numbers unknown to the source.
_HELD = (
    "held AS (SELECT * REPLACE (CASE WHEN company = 'C1' THEN quantiterealise + 100 ELSE quantiterealise END "
    "AS quantiterealise) FROM t13 WHERE daterealisation < TIMESTAMP '2024-01-20' UNION ALL "
    "SELECT * REPLACE ('X' || numerosuivi AS numerosuivi) FROM t13 WHERE company = 'C2')"
)


def _held(spark: SparkSession, sf_dir: str) -> DataFrame:
    production = shopfloor.build_production(inputs(spark, sf_dir))
    more = F.when(F.col("company") == "C1", F.col("quantiterealise") + 100).otherwise(F.col("quantiterealise"))
    known = production.filter("daterealisation < timestamp_ntz '2024-01-20'").withColumn("quantiterealise", more)
    extra = production.filter("company = 'C2'").withColumn("numerosuivi", F.concat(F.lit("X"), "numerosuivi"))
    return known.unionByName(extra)


def _with_held(body: str) -> str:
    return sql("t13 t13_twice", "").rstrip() + f", {_HELD} {body}"


@register(
    "l2_insert_absent", _with_held(f"SELECT * FROM ({_nth('ASC')}) AS f WHERE numerosuivi NOT IN (SELECT numerosuivi FROM held)")
)
def l2(spark, sf_dir):
    return loads.insert_absent(_twice(spark, sf_dir), _held(spark, sf_dir), _KEY, _ORDER)


@register(
    "l2_calendar_absent",
    f"SELECT DISTINCT * FROM ({_parts('orders', 'o_orderdate')}) AS c WHERE (Day, Month, Year) NOT IN "
    "(SELECT (day(o_orderdate), month(o_orderdate), year(o_orderdate)) FROM orders WHERE o_orderpriority = '5-LOW')",
)
def l2_calendar(spark, sf_dir):
    orders = rows_of(spark, sf_dir, "orders")
    days = calendar(orders.select(F.col("o_orderdate").alias("day")))
    known = calendar(orders.filter("o_orderpriority = '5-LOW'").select(F.col("o_orderdate").alias("day")))
    return loads.insert_absent(days, known, catalog.CALENDAR.keys, catalog.CALENDAR.order)


_MERGED = (
    f"SELECT * FROM ({_nth('DESC')}) AS l UNION ALL "
    "SELECT * FROM held WHERE numerosuivi NOT IN (SELECT numerosuivi FROM t13_twice)"
)


@register("l4_sync_merge", _with_held(_MERGED))
def l4(spark, sf_dir):
    return loads.merge(_twice(spark, sf_dir), _held(spark, sf_dir), _KEY, _ORDER)


@register(
    "a3_load_counts",
    _with_held(
        "SELECT count(DISTINCT numerosuivi) FILTER (numerosuivi NOT IN (SELECT numerosuivi FROM held)) AS inserted, "
        "count(*) - count(DISTINCT numerosuivi) FILTER (numerosuivi NOT IN (SELECT numerosuivi FROM held)) AS updated "
        "FROM t13_twice"
    ),
)
def a3(spark, sf_dir):
    return loads.merge_counts(_twice(spark, sf_dir), _held(spark, sf_dir), _KEY)


# Stored capacity grid: other hours in company C1, days up to a date, stations unknown to the source.
_GRID = (
    "grid AS (SELECT * REPLACE (CASE WHEN company = 'C1' THEN tempstheorique + 1 ELSE tempstheorique END "
    "AS tempstheorique) FROM t16 WHERE dateschema < DATE '2024-01-01' UNION ALL "
    "SELECT * REPLACE ('X' || poste AS poste) FROM t16 WHERE company = 'C2')"
)
_CAPACITY_KEYS = list(shopfloor.CAPACITY.keys)


def _grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    grid = shopfloor.build_capacity_distinct(inputs(spark, sf_dir))
    more = F.when(F.col("company") == "C1", F.col("tempstheorique") + 1).otherwise(F.col("tempstheorique"))
    known = grid.filter("dateschema < date '2024-01-01'").withColumn("tempstheorique", more)
    extra = grid.filter("company = 'C2'").withColumn("poste", F.concat(F.lit("X"), "poste"))
    return known.unionByName(extra)


def _with_grid(body: str) -> str:
    return sql("t16", "").rstrip() + f", {_GRID} {body}"


_UPDATED = (
    "SELECT t.poste, t.schema, CASE WHEN s.poste IS NULL THEN t.designationPoste ELSE s.designationPoste END "
    "AS designationPoste, CASE WHEN s.poste IS NULL THEN t.company ELSE s.company END AS company, t.dateschema, "
    "CASE WHEN s.poste IS NULL THEN t.tempstheorique ELSE s.tempstheorique END AS tempstheorique "
    f"FROM grid t LEFT JOIN t16 s ON {_ON_KEY}"
)
_UPSERTED = (
    f"{_UPDATED} UNION ALL SELECT poste, schema, designationPoste, company, dateschema, tempstheorique FROM t16 s "
    f"WHERE NOT EXISTS (SELECT 1 FROM grid t WHERE {_ON_KEY})"
)


@register("j10_matched_update", _with_grid(_UPDATED))
def j10(spark, sf_dir):
    source = shopfloor.build_capacity_distinct(inputs(spark, sf_dir))
    return loads.matched_update(source, _grid(spark, sf_dir), _CAPACITY_KEYS, shopfloor.CAPACITY.update)


@register("l5_sync_upsert", _with_grid(_UPSERTED))
def l5(spark, sf_dir):
    """The source comes as runs of weeks, the stored days are made into runs, and the next state into days again."""
    target, ds = _grid(spark, sf_dir), shopfloor.CAPACITY
    source = shopfloor.build_capacity_runs(inputs(spark, sf_dir))
    changed = runs.upsert_runs(source, runs.to_runs(target, "dateschema", 7), ["poste", "schema"], ds.update, 7)
    return runs.to_days(changed, "dateschema", 7, target.columns)


# --- loads into a stored table, then read back ---------------------------------------------------------------------


def _warehouse(spark: SparkSession, read, name: str) -> Warehouse:
    """A new warehouse in the shared folder, with one empty table."""
    house = Warehouse(spark, f"{shared_dir(spark)}/warehouse-{uuid.uuid4().hex}", read, END)
    house.create(name)
    return house


@register("s3_read_target", sql("t10", "SELECT * FROM t10"))
def s3(spark, sf_dir):
    """The invoice table after two loads: the older lines first, then all of them."""
    read = spark_source(spark, sf_dir)
    top = rows.high_water_mark(read("SINVOICED"), "ROWID")

    def older(name: str) -> DataFrame:
        return read(name).filter(F.col("ROWID") <= top // 2) if name == "SINVOICED" else read(name)

    house = _warehouse(spark, older, "SALESINVOICE")
    house.load("SALESINVOICE")
    full = Warehouse(spark, house.store.root, read, END)
    full.load("SALESINVOICE")
    return full.store.read(trade.INVOICE)


@register("s1_read_source", "SELECT o_orderkey, o_custkey, o_orderdate, o_totalprice FROM orders WHERE o_totalprice > 50000")
def s1(spark, sf_dir):
    """A table through a profile, with a condition that its source evaluates."""
    read = reader(spark, Profile("parquet", location=f"{sf_dir}/{{table}}.parquet"))
    return read("orders", "o_totalprice > 50000").select("o_orderkey", "o_custkey", "o_orderdate", "o_totalprice")


_STEPS = [("1 create", CREATED), ("2 create", EXISTS), ("3 load", LOADED), ("4 load", NOTHING_NEW), ("5 sync", IN_STEP)]


@register(
    "l7_outcomes",
    sql(
        "t03",
        " UNION ALL ".join(
            f"SELECT '{step}' AS step, '{outcome}' AS outcome, "
            f"{'(SELECT count(*) FROM t03)' if outcome == LOADED else 'CAST(0 AS BIGINT)'} AS inserted"
            for step, outcome in [*_STEPS, ("6 sync", FAILED)]
        ),
    ),
)
def l7(spark, sf_dir):
    """What each step on the representatives' table reports; the last source has names too long to keep."""
    read = spark_source(spark, sf_dir)
    house = Warehouse(spark, f"{shared_dir(spark)}/warehouse-{uuid.uuid4().hex}", read, END)
    reports = [getattr(house, step.split()[1])("SALESREP") for step, _ in _STEPS]
    too_long = {"REPNAM_0": F.repeat(F.lit("x"), 256)}
    bad = Warehouse(spark, house.store.root, lambda name: read(name).withColumns(too_long), END)
    try:
        reports.append(bad.sync("SALESREP"))
    except LoadFailed as failed:
        reports.append(failed.report)
    steps = [*[step for step, _ in _STEPS], "6 sync"]
    found = [(step, report.outcome, report.inserted) for step, report in zip(steps, reports)]
    return spark.createDataFrame(found, "step string, outcome string, inserted long")


@register("s6_overwrite_then_load", sql("t03", "SELECT * FROM t03"))
def s6_then_load(spark, sf_dir):
    """A table replaced by its own rows holds its cursor: the next load adds nothing."""
    house = _warehouse(spark, spark_source(spark, sf_dir), "SALESREP")
    house.load("SALESREP")
    house.store.overwrite(partners.SALESREP, house.store.read(partners.SALESREP, with_id=True))
    house.load("SALESREP")
    return house.store.read(partners.SALESREP)


@register("s5_compacted", sql("t03", "SELECT t03.*, count(*) OVER () AS ids FROM t03"))
def s5_compacted(spark, sf_dir):
    """A table loaded in four parts, its small folders joined: all rows once, and as many ids, from 1 without a gap."""
    read = spark_source(spark, sf_dir)
    house = _warehouse(spark, read, "SALESREP")
    most = read("SALESREP").agg(F.max("ROWID")).first()[0]
    for i in range(1, 5):
        upto = lambda name, i=i: read(name).filter(F.col("ROWID") <= most * i // 4)
        Warehouse(spark, house.store.root, upto, END).load("SALESREP")
    house.compact("SALESREP")
    found = house.store.read(partners.SALESREP, with_id=True)
    last, ids = found.agg(F.max("id"), F.count_distinct("id")).first()
    return found.drop("id").withColumn("ids", F.lit(ids if ids == last else None).cast("long"))


@register("k1_stored_ids", sql("t03", "SELECT CAST(range AS BIGINT) AS id FROM range(1, (SELECT count(*) + 1 FROM t03))"))
def k1_stored(spark, sf_dir):
    house = _warehouse(spark, spark_source(spark, sf_dir), "SALESREP")
    house.load("SALESREP")
    return house.store.read(partners.SALESREP, with_id=True).select("id")


@register("l3_sync_replace", sql("t04", "SELECT * FROM t04"))
def l3(spark, sf_dir):
    """The customer table, loaded with other names, after synchronisation."""
    read = spark_source(spark, sf_dir)

    def renamed(name: str) -> DataFrame:
        df = read(name)
        return df.withColumn("BPCNAM_0", F.upper("BPCNAM_0")) if name == "BPCUSTOMER" else df

    house = _warehouse(spark, renamed, "BPCUSTOMER")
    house.load("BPCUSTOMER")
    full = Warehouse(spark, house.store.root, read, END)
    full.sync("BPCUSTOMER")
    return full.store.read(partners.CUSTOMER)


@register(
    "l2_stored_insert",
    _with_held(
        f"SELECT * FROM held UNION ALL SELECT * FROM ({_nth('ASC')}) AS f "
        "WHERE numerosuivi NOT IN (SELECT numerosuivi FROM held)"
    ),
)
def l2_stored(spark, sf_dir):
    read = spark_source(spark, sf_dir)
    house = _warehouse(spark, lambda n: read("MFGITMTRK_TWICE" if n == "MFGITMTRK" else n), "PRODUCTION")
    house.store.append(shopfloor.PRODUCTION, _held(spark, sf_dir))
    house.load("PRODUCTION")
    return house.store.read(shopfloor.PRODUCTION)


@register("l4_stored_merge", _with_held(_MERGED))
def l4_stored(spark, sf_dir):
    read = spark_source(spark, sf_dir)
    house = _warehouse(spark, lambda n: read("MFGITMTRK_TWICE" if n == "MFGITMTRK" else n), "PRODUCTION")
    house.store.append(shopfloor.PRODUCTION, _held(spark, sf_dir))
    house.sync("PRODUCTION")
    return house.store.read(shopfloor.PRODUCTION)


@register("l5_stored_upsert", _with_grid(_UPSERTED))
def l5_stored(spark, sf_dir):
    house = _warehouse(spark, spark_source(spark, sf_dir), "POSTEDECHARGE")
    house.store.append(shopfloor.CAPACITY, _grid(spark, sf_dir))
    house.sync("POSTEDECHARGE")
    return house.store.read(shopfloor.CAPACITY)


@register("l6_append_all", sql("t16", "SELECT * FROM t16 UNION ALL SELECT * FROM t16"))
def l6(spark, sf_dir):
    """Loading twice doubles the rows."""
    house = _warehouse(spark, spark_source(spark, sf_dir), "POSTEDECHARGE")
    house.load("POSTEDECHARGE")
    house.load("POSTEDECHARGE")
    return house.store.read(shopfloor.CAPACITY)


@register("s6_overwrite", sql("t15", "SELECT * FROM t15 WHERE company <> 'C0'"))
def s6(spark, sf_dir):
    """A table replaced by a part of its own rows."""
    ds = shopfloor.OTHER_TIMES
    store = Store(spark, f"{shared_dir(spark)}/warehouse-{uuid.uuid4().hex}")
    store.ensure(ds)
    store.append(ds, ds.build(inputs(spark, sf_dir)))
    store.overwrite(ds, store.read(ds).filter("company <> 'C0'"))
    return store.read(ds)
