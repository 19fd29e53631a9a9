"""Transformations on hand-made edge rows."""

from __future__ import annotations

from datetime import date, datetime

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tests.conftest import values
from tidemark.plans import partners, shopfloor, trade
from tidemark.plans.catalog import DATASETS
from tidemark.plans.model import Inputs
from tidemark.plans.tables import SOURCE_COLUMNS

DAY = datetime(2020, 5, 17, 13, 30)


@pytest.fixture
def given(spark, frame):
    """``given(TABLE=(schema, rows), …)``"""

    def make(end=None, **tables):
        frames = {name: frame(schema, rows) for name, (schema, rows) in tables.items()}
        return Inputs(spark, frames.__getitem__, end)

    return make


def test_sixteen_tables_from_known_sources():
    assert len(DATASETS) == 16
    assert {ds.cursor_table for ds in DATASETS.values() if ds.cursor} <= {t for t, c in SOURCE_COLUMNS.items() if "ROWID" in c}


REPS = ("YBPCNUM_0 string, YCPY_0 string, YREP_0 string", [("7", "C0", "R7"), ("8", "C0", "a"), ("8", "C0", "b")])
INVOICE = "NUM_0 string, CPY_0 string, BPR_0 string, ACCDAT_0 timestamp_ntz, SNS_0 int, RATMLT_0 double"
LINE = (
    "ROWID long, NUM_0 string, SIDLIN_0 int, ITMREF_0 string, QTY_0 double, NETPRI_0 double, NETPRIATI_0 double, "
    "CPRPRI_0 double"
)


def _invoices(given, headers, lines):
    return trade.build_invoice(given(SINVOICE=(INVOICE, headers), SINVOICED=(LINE, lines), YREPRE=REPS))


def test_credit_note_negates_amounts_and_margin(given):
    rows = _invoices(given, [("I1", "C0", "7", DAY, -1, 2.0)], [(1, "I1", 1, "A", 3.0, 10.0, 12.0, 4.0)])
    assert values(rows) == [
        (1, "C0", "I1", 1, "7", date(2020, 5, 17), "A", 3.0, -60.0, -72.0, "R7", -24.0, -36.0),
    ]


def test_only_headers_with_lines_appear(given):
    rows = _invoices(
        given,
        [("I1", "C0", "7", DAY, 1, 1.0), ("I2", "C0", "7", DAY, 1, 1.0)],
        [(1, "I1", 1, "A", 1.0, 1.0, 1.0, 1.0), (2, "I3", 1, "A", 1.0, 1.0, 1.0, 1.0)],
    )
    assert values(rows.select("numFacture")) == [("I1",)]


def test_representative_of_another_company_is_null(given):
    rows = _invoices(given, [("I1", "C1", "7", DAY, 1, 1.0)], [(1, "I1", 1, "A", 1.0, 1.0, 1.0, 1.0)])
    assert rows.first()["representant"] is None


def test_ambiguous_representative_matters_only_for_a_line(given):
    headers = [("I1", "C0", "7", DAY, 1, 1.0), ("I2", "C0", "8", DAY, 1, 1.0)]
    line = (1, "I1", 1, "A", 1.0, 1.0, 1.0, 1.0)
    rows = _invoices(given, headers, [line])
    assert rows.filter("representant = 'R7'").count() == 1
    with pytest.raises(PySparkException, match="ambiguous"):
        _invoices(given, headers, [line, (2, "I2", 1, "A", 1.0, 1.0, 1.0, 1.0)]).collect()


def test_invoice_with_a_hot_document_and_a_hot_customer(given, forced_skew):
    headers = [(f"I{i}", "C0", "7" if i % 3 == 0 else str(100 + i), DAY, 1, 1.0) for i in range(300)]
    lines = [(i, "I0" if i % 3 == 0 else f"I{i % 300}", i, "A", 1.0, 2.0, 3.0, 1.0) for i in range(900)]
    rows = _invoices(given, headers, lines)
    assert rows.count() == 900
    assert rows.select("rowID").distinct().count() == 900
    assert rows.filter("representant = 'R7'").count() == sum(1 for i in range(900) if i % 3 == 0)


HEADER = "ROWID long, SOHNUM_0 string, CPY_0 string, BPCORD_0 string, ORDDAT_0 timestamp_ntz, CHGRAT_0 double"


def _order(given):
    return given(
        SORDER=(HEADER, [(9, "O1", "C0", "7", DAY, 2.0), (10, "O2", "C0", "7", DAY, 1.0)]),
        SORDERQ=(
            "SOHNUM_0 string, ITMREF_0 string, QTY_0 double, LINE_0 int",
            [("O1", "A", 2.75, 1), ("O1", "B", -2.75, 2)],
        ),
        SORDERP=(
            "SOHNUM_0 string, NETPRI_0 double, NETPRIATI_0 double, CPRPRI_0 double, LINE_0 int",
            [("O1", 1.0, 2.0, 3.0, 1), ("O1", 10.0, 20.0, 30.0, 2), ("O1", 5.0, 5.0, 5.0, 3)],
        ),
    )


def test_order_lines_times_price_lines(given):
    rows = trade.build_order(_order(given))
    assert rows.count() == 6
    assert {r.quantite for r in rows.collect()} == {2, -2}
    assert sorted(r.montantHT for r in rows.filter("codeArticle = 'A'").collect()) == [5.5, 27.5, 55.0]


def test_order_lines_with_their_own_price(given):
    rows = trade.build_order(_order(given), line_key="LINE_0")
    assert sorted((r.codeArticle, r.montantHT) for r in rows.collect()) == [("A", 5.5), ("B", -55.0)]


def test_order_fan_out_when_salted(given, forced_skew):
    n = 60
    src = given(
        SORDER=(HEADER, [(1, "O1", "C0", "7", DAY, 1.0)] + [(i, f"P{i}", "C0", "7", DAY, 1.0) for i in range(2, 60)]),
        SORDERQ=("SOHNUM_0 string, ITMREF_0 string, QTY_0 double", [("O1", str(i), 1.0) for i in range(n)]),
        SORDERP=(
            "SOHNUM_0 string, NETPRI_0 double, NETPRIATI_0 double, CPRPRI_0 double",
            [("O1", float(i), 1.0, 1.0) for i in range(n)],
        ),
    )
    rows = trade.build_order(src)
    assert rows.count() == n * n
    assert rows.select("codeArticle", "montantHT").distinct().count() == n * n


def test_order_with_a_hot_price_side_is_spread(given, forced_skew, without_aqe):
    """One document with one line and a third of all price rows."""
    numbers = [f"O{i}" for i in range(600)]
    src = given(
        SORDER=(HEADER, [(i, n, "C0", "7", DAY, 1.0) for i, n in enumerate(numbers)]),
        SORDERQ=("SOHNUM_0 string, ITMREF_0 string, QTY_0 double", [(n, "A", 1.0) for n in numbers]),
        SORDERP=(
            "SOHNUM_0 string, NETPRI_0 double, NETPRIATI_0 double, CPRPRI_0 double",
            [("O0" if i % 3 == 0 else numbers[i % 600], float(i), 1.0, 1.0) for i in range(3000)],
        ),
    )
    rows = trade.build_order(src)
    assert rows.count() == 3000
    assert rows.groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0] < 1000


def test_receipt_and_delivery_with_returns(given):
    receipt = trade.build_receipt(
        given(
            PRECEIPT=(
                "ROWID long, PTHNUM_0 string, CPY_0 string, BPSNUM_0 string, RCPDAT_0 timestamp_ntz, CHGCOE_0 double",
                [(1, "R1", "C0", "7", DAY, 1.0)],
            ),
            PRECEIPTD=(
                "PTHNUM_0 string, ITMREF_0 string, QTYSTU_0 double, RTNQTYSTU_0 double, NETPRI_0 double",
                [("R1", "A", 10.0, 4.0, 2.0)],
            ),
        )
    ).first()
    assert (receipt.CRY_0, receipt.quantite, receipt.montantHT) == ("C0", 6, 20.0)
    delivery = trade.build_delivery(
        given(
            SDELIVERY=(
                "ROWID long, SDHNUM_0 string, CPY_0 string, BPCORD_0 string, SHIDAT_0 timestamp_ntz, CHGRAT_0 double",
                [(1, "D1", "C0", "7", DAY, 1.0)],
            ),
            SDELIVERYD=(
                "SDHNUM_0 string, ITMREF_0 string, QTY_0 double, RTNQTY_0 double, NETPRI_0 double, CPRPRI_0 double",
                [("D1", "A", 10.0, 4.0, 2.0, 1.0)],
            ),
        )
    ).first()
    assert (delivery.quantite, delivery.montantTTc, delivery.MontantPrixRevi) == (6.0, 12.0, 6.0)


SITES = ("FCY_0 string, LEGCPY_0 string", [("S1", "C0")])
STATIONS = "WST_0 string, TWD_0 string, WSTDES_0 string, WCRFCY_0 string"
WEEKS = "TWD_0 string, " + ", ".join(f"DAYCAP_{i} double" for i in range(7))


def _capacity(given, stations, weeks, end):
    return given(end=end, WORKSTATIO=(STATIONS, stations), TABWEEDIA=(WEEKS, weeks), FACILITY=SITES)


def test_capacity_by_weekday_with_null_schemas(given):
    src = _capacity(
        given,
        [("P1", "W", "one", "S1"), ("P2", None, "two", "S1"), ("P3", "W", "unknown site", "S9"), ("P4", "V", "x", "S1")],
        [("W", 1.0, 2.0, 3.0, 4.0, 5.0, 6.0, 7.0), (None, 9.0, 9.0, 9.0, 9.0, 9.0, 9.0, None)],
        date(2016, 1, 3),
    )
    expected = [
        ("P1", "W", "one", "C0", date(2016, 1, 1), 5.0),
        ("P1", "W", "one", "C0", date(2016, 1, 2), 6.0),
        ("P1", "W", "one", "C0", date(2016, 1, 3), 7.0),
        ("P2", None, "two", "C0", date(2016, 1, 1), 9.0),
        ("P2", None, "two", "C0", date(2016, 1, 2), 9.0),
        ("P2", None, "two", "C0", date(2016, 1, 3), None),
    ]
    assert values(shopfloor.build_capacity(src)) == expected
    assert values(shopfloor.build_capacity_distinct(src)) == expected


def test_distinct_capacity_drops_only_equal_days(given):
    src = _capacity(
        given,
        [("P1", "W", "one", "S1")],
        [("W", 1.0, 2.0, 3.0, 4.0, 5.0, 6.0, 7.0), ("W", 1.0, 2.0, 3.0, 4.0, 5.5, 6.0, 7.0)],
        date(2016, 1, 10),
    )
    assert shopfloor.build_capacity(src).count() == 20
    assert values(shopfloor.build_capacity(src).distinct()) == values(shopfloor.build_capacity_distinct(src))


def test_capacity_without_a_match_is_an_empty_typed_frame(given):
    empty = shopfloor.build_capacity(_capacity(given, [("P1", "W", "one", "S1")], [], date(2016, 1, 3)))
    assert empty.count() == 0
    assert empty.dtypes == [(f.name, f.dataType.simpleString()) for f in shopfloor.CAPACITY.schema]


def test_times_are_split_by_type(given):
    schema = (
        "MFGTRKNUM_0 string, MFGFCY_0 string, CPLWST_0 string, CPLLAB_0 string, CPLQTY_0 double, REJCPLQTY_0 double, "
        "CPLSETTIM_0 double, CPLOPETIM_0 double, TIMTYP_0 int, TIMUOMCOD_0 int, MSGNUM_0 int, IPTDAT_0 timestamp_ntz"
    )
    rows = [
        ("1", "S1", "P", "L", 1.0, 0.0, 90.0, 30.0, 1, 2, 0, DAY),
        ("2", "S1", "P", "L", 1.0, 0.0, 90.0, 30.0, 3, None, 0, DAY),
        ("3", "S1", "P", "L", 1.0, 0.0, 90.0, 30.0, 2, 1, 0, DAY),
    ]
    src = given(MFGOPETRK=(schema, rows), FACILITY=SITES)
    assert values(shopfloor.build_time(src, 1).select("numerosuivi", "tempsreglage", "tempsopérealise")) == [("1", 1.5, 0.5)]
    assert values(shopfloor.build_time(src, 3).select("numerosuivi", "tempsreglage", "tempsoperealise")) == [("2", 90.0, 30.0)]


def test_item_description_with_a_null_part(given):
    codes = ", ".join(f"TSICOD_{i} string" for i in range(5))
    items = f"ITMREF_0 string, ITMDES1_0 string, ITMDES2_0 string, ITMDES3_0 string, TCLCOD_0 string, {codes}, ROWID long"
    row = ("A", "x", "y", None, "T", *"01234", 1)
    dictionary = "CODFIC_0 string, ZONE_0 string, LANGUE_0 string, IDENT1_0 string, IDENT2_0 string, TEXTE_0 string"
    built = partners.build_item(given(ITMMASTER=(items, [row]), ATEXTRA=(dictionary, [])))
    assert built.first()["ITMDES_0"] is None
