"""The test tables in the shape of the ERP's source tables: as statements that both engines understand.

Used by the tests, the bench and ``__spark_entry__.py`` only.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from datetime import date

from pyspark.sql import DataFrame, SparkSession

from tidemark.plans.model import Inputs

END = date(2025, 12, 31)

_ORDER_HEADER = """
    CAST(o_orderkey AS {text}) AS {number}, concat('C', CAST(o_custkey % 2 AS {text})) AS CPY_0,
    CAST(o_custkey AS {text}) AS {partner}, o_orderdate AS {date},
    CAST(1 AS DOUBLE) + CAST(0.25 AS DOUBLE) * (o_orderkey % 3) AS {rate}, o_orderkey + 1 AS ROWID
"""
_NET = "l_extendedprice * (1 - l_discount) AS NETPRI_0"
_GROSS = "l_extendedprice * (1 - l_discount) * (1 + l_tax) AS NETPRIATI_0"
_COST = "l_extendedprice * CAST(0.5 AS DOUBLE) AS CPRPRI_0"
_RETURNED = "CASE WHEN l_returnflag = 'R' THEN l_quantity / 8 ELSE CAST(0 AS DOUBLE) END"
_LINE_ID = "((l_orderkey * 20000 + l_partkey) * 1000 + l_suppkey) * 8 + l_linenumber"


def _header(number: str, partner: str, day: str, rate: str, extra: str = "") -> str:
    body = _ORDER_HEADER.format(number=number, partner=partner, date=day, rate=rate, text="{text}")
    return f"SELECT {body}{extra} FROM orders"


def _lines(number: str, quantity: str, *columns: str) -> str:
    fixed = f"CAST(l_orderkey AS {{text}}) AS {number}, CAST(l_partkey AS {{text}}) AS ITMREF_0"
    every = [fixed, f"l_quantity / 4 AS {quantity}", "l_linenumber AS LINE_0", *columns]
    return f"SELECT {', '.join(every)} FROM lineitem"


def _codes(prefix: str, key: str, count: int) -> str:
    return ", ".join(f"CAST(({key} + {i}) % 7 AS {{text}}) AS {prefix}_{i}" for i in range(count))


_TRACKING = """CAST(event_id AS {text}) AS MFGTRKNUM_0, CAST(event_id % 25 AS {text}) AS MFGFCY_0,
    value AS CPLQTY_0, ts AS IPTDAT_0"""

# One statement per source table, valid in both engines once {text} is filled in.
SOURCES: dict[str, str] = {
    "COMPANY": "SELECT concat('C', CAST(r_regionkey AS {text})) AS CPY_0, r_name AS CPYNAM_0, "
    "CAST(r_regionkey AS BIGINT) + 1 AS ROWID FROM region",
    "SALESREP": "SELECT CAST(s_suppkey AS {text}) AS REPNUM_0, s_name AS REPNAM_0, s_suppkey + 1 AS ROWID FROM supplier",
    "FACILITY": "SELECT CAST(n_nationkey AS {text}) AS FCY_0, concat('C', CAST(n_regionkey AS {text})) AS LEGCPY_0 "
    "FROM nation WHERE n_nationkey < 24",
    "BPCUSTOMER": "SELECT c_custkey + 1 AS ROWID, CAST(c_custkey AS {text}) AS BPCNUM_0, c_name AS BPCNAM_0, "
    f"c_mktsegment AS BCGCOD_0, {_codes('TSCCOD', 'c_custkey', 5)} FROM customer",
    "BPSUPPLIER": "SELECT s_suppkey + 1 AS ROWID, CAST(s_suppkey AS {text}) AS BPSNUM_0, s_name AS BPSNAM_0, "
    f"CAST(s_suppkey % 4 AS {{text}}) AS BSGCOD_0, {_codes('TSSCOD', 's_suppkey', 3)} FROM supplier",
    "BPARTNER": "SELECT CAST(c_custkey AS {text}) AS BPRNUM_0, n_name AS CRY_0 FROM customer "
    "JOIN nation ON c_nationkey = n_nationkey",
    "BPARTNER_S": "SELECT CAST(s_suppkey AS {text}) AS BPRNUM_0, n_name AS CRY_0 FROM supplier "
    "JOIN nation ON s_nationkey = n_nationkey",
    "ITMMASTER": "SELECT CAST(p_partkey AS {text}) AS ITMREF_0, p_name AS ITMDES1_0, p_brand AS ITMDES2_0, "
    "nullif(p_type, 'PROMO') AS ITMDES3_0, p_type AS TCLCOD_0, "
    f"{_codes('TSICOD', 'p_size', 5)}, p_partkey + 1 AS ROWID FROM part",
    "YREPRE": "SELECT CAST(c_custkey AS {text}) AS YBPCNUM_0, 'C0' AS YCPY_0, "
    "CAST(c_custkey % 10 AS {text}) AS YREP_0 FROM customer WHERE c_custkey % 10 <> 0",
    "SQUOTE": _header("SQHNUM_0", "BPCORD_0", "QUODAT_0", "CHGRAT_0"),
    "SORDER": _header("SOHNUM_0", "BPCORD_0", "ORDDAT_0", "CHGRAT_0"),
    "SDELIVERY": _header("SDHNUM_0", "BPCORD_0", "SHIDAT_0", "CHGRAT_0"),
    "SINVOICE": _header(
        "NUM_0", "BPR_0", "ACCDAT_0", "RATMLT_0", ", CASE WHEN o_orderstatus = 'P' THEN -1 ELSE 1 END AS SNS_0"
    ),
    "PORDER": _header("POHNUM_0", "BPSNUM_0", "ORDDAT_0", "CHGCOE_0"),
    "PRECEIPT": _header("PTHNUM_0", "BPSNUM_0", "RCPDAT_0", "CHGCOE_0"),
    "SQUOTED": _lines("SQHNUM_0", "QTY_0", _NET, _GROSS, f"{_LINE_ID} AS ROWID"),
    "SORDERQ": _lines("SOHNUM_0", "QTY_0"),
    "SORDERP": _lines("SOHNUM_0", "QTYP_0", _NET, _GROSS, _COST),
    "SDELIVERYD": _lines("SDHNUM_0", "QTY_0", f"{_RETURNED} AS RTNQTY_0", _NET, _COST),
    "SINVOICED": _lines("NUM_0", "QTY_0", "l_linenumber AS SIDLIN_0", _NET, _GROSS, _COST, f"{_LINE_ID} AS ROWID"),
    "PORDERQ": _lines("POHNUM_0", "QTYSTU_0"),
    "PORDERP": _lines("POHNUM_0", "QTYP_0", _NET),
    "PRECEIPTD": _lines("PTHNUM_0", "QTYSTU_0", f"{_RETURNED} AS RTNQTYSTU_0", _NET),
    "MFGITMTRK": f"SELECT {_TRACKING}, CAST(user_id AS {{text}}) AS ITMREF_0 FROM events",
    "MFGOPETRK": f"SELECT {_TRACKING}, CASE event_type WHEN 'click' THEN 1 WHEN 'view' THEN 3 ELSE 2 END AS TIMTYP_0, "
    "CAST(nullif(event_id % 3, 0) AS INT) AS TIMUOMCOD_0, value AS CPLSETTIM_0, value * 3 AS CPLOPETIM_0, "
    "value / 4 AS REJCPLQTY_0, CAST(event_id % 5 AS INT) AS MSGNUM_0, CAST(event_id % 10 AS {text}) AS CPLWST_0, "
    "CAST(user_id AS {text}) AS CPLLAB_0 FROM events",
    "WORKSTATIO": "SELECT CAST(s_suppkey AS {text}) AS WST_0, "
    "CASE WHEN s_suppkey % 10 <> 9 THEN concat('W', CAST(s_suppkey % 6 AS {text})) END AS TWD_0, "
    "s_name AS WSTDES_0, CAST(s_nationkey AS {text}) AS WCRFCY_0 FROM supplier",
    "TABWEEDIA": "SELECT concat('W', CAST(r_regionkey AS {text})) AS TWD_0, "
    + ", ".join(
        f"{'CAST(7.5 AS DOUBLE) + r_regionkey * CAST(0.5 AS DOUBLE)' if i < 5 else 'CAST(0 AS DOUBLE)'} AS DAYCAP_{i}"
        for i in range(7)
    )
    + " FROM region UNION ALL SELECT CAST(NULL AS {text}), "
    + ", ".join("CAST(6 AS DOUBLE)" if i < 6 else "CAST(NULL AS DOUBLE)" for i in range(7))
    + " FROM region WHERE r_regionkey = 0",
}

# Tracking rows of which some numbers come twice, the second version an hour later.
_AGAIN = re.sub(r"\bvalue\b", "value + 1", SOURCES["MFGITMTRK"]).replace("ts AS", "ts + INTERVAL 1 HOUR AS")
SOURCES["MFGITMTRK_TWICE"] = f"{SOURCES['MFGITMTRK']} UNION ALL {_AGAIN} WHERE event_id % 10 = 0"

# Dictionary: codes 0 to 5 of thirteen tables, country names, all customer segments but one and three supplier
# categories; every entry in two languages. {each} and {list} make one row per list element.
_FRENCH = [
    "SELECT 'ATABDIV' AS CODFIC_0, 'XLNGDESX' AS ZONE_0, CAST(t AS {text}) AS IDENT1_0, "
    "CAST(n_nationkey AS {text}) AS IDENT2_0, "
    "concat('T', CAST(t AS {text}), '-', CAST(n_nationkey AS {text})) AS TEXTE_0 FROM (SELECT n_nationkey, "
    "{each}({list}(20, 21, 22, 23, 24, 30, 31, 32, 33, 34, 40, 41, 42)) AS t FROM nation WHERE n_nationkey < 6) AS c",
    "SELECT 'TABCOUNTRY', 'CRYDES', n_name, '', concat('Pays ', n_name) FROM nation WHERE n_nationkey <> 7",
    "SELECT DISTINCT 'BPCCATEG', 'DESAXX', c_mktsegment, '', concat('Cat ', c_mktsegment) "
    "FROM customer WHERE c_mktsegment <> 'FURNITURE'",
    "SELECT 'BPCCATEG', 'DESAXX', CAST(r_regionkey AS {text}), '', concat('Four ', CAST(r_regionkey AS {text})) "
    "FROM region WHERE r_regionkey < 3",
]
SOURCES["ATEXTRA"] = (
    "SELECT CODFIC_0, ZONE_0, LANGUE_0, IDENT1_0, IDENT2_0, concat(LANGUE_0, ' ', TEXTE_0) AS TEXTE_0 "
    f"FROM (SELECT *, {{each}}({{list}}('FRA', 'ENG')) AS LANGUE_0 FROM ({' UNION ALL '.join(_FRENCH)}) AS d) AS e"
)

TABLES = "region nation customer supplier part orders lineitem events".split()


def duckdb_statement(name: str) -> str:
    """The statement of a source table for the check."""
    return SOURCES[name].replace("{text}", "VARCHAR").replace("{each}", "unnest").replace("{list}", "list_value")


_views: dict[tuple[str, str], str] = {}


def _view(spark: SparkSession, sf_dir: str, table: str) -> str:
    """Name of a view on a test table, made once per session, so that its footer is not read again each time."""
    key = (spark.sparkContext.applicationId, f"{sf_dir}/{table}")
    if key not in _views:
        name = f"{table}_{len(_views)}"
        spark.read.parquet(f"{sf_dir}/{table}.parquet").createOrReplaceTempView(name)
        _views[key] = name
    return _views[key]


def spark_source(spark: SparkSession, sf_dir: str) -> Callable[[str], DataFrame]:
    """Read function that gives a source table by name, built from the test tables."""

    def read(name: str) -> DataFrame:
        query = SOURCES[name].replace("{text}", "STRING").replace("{each}", "explode").replace("{list}", "array")
        table = rf"\b(FROM|JOIN) ({'|'.join(TABLES)})\b"
        return spark.sql(re.sub(table, lambda m: f"{m[1]} {_view(spark, sf_dir, m[2])}", query))

    return read


def inputs(spark: SparkSession, sf_dir: str, end: date = END, **other: str) -> Inputs:
    """Sources for a transformation; ``other`` names a stand-in for a table.

    Customers and suppliers share numbers, so suppliers need ``BPARTNER="BPARTNER_S"``.
    """
    read = spark_source(spark, sf_dir)
    return Inputs(spark, lambda name: read(other.get(name, name)), end)


def rows_of(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """A test table as it is."""
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")

