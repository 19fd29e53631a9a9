"""The sixteen warehouse tables."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tidemark.operators.calendar import CALENDAR_START, calendar, date_spine, one_row
from tidemark.plans import partners, shopfloor, trade
from tidemark.plans.model import INT, Column, Dataset, Inputs


def build_calendar(src: Inputs) -> DataFrame:
    return calendar(date_spine(one_row(src.spark), CALENDAR_START, src.end))


CALENDAR = Dataset(
    "Date",
    tuple(Column(name, INT) for name in ("Day", "Month", "Year", "Week", "Semester")),
    build_calendar,
    load="insert",
    sync=None,
    keys=("Day", "Month", "Year"),
    order=("Week",),
)

DATASETS: dict[str, Dataset] = {
    ds.name: ds
    for ds in (
        CALENDAR,
        partners.COMPANY,
        partners.SALESREP,
        partners.CUSTOMER,
        partners.SUPPLIER,
        partners.ITEM,
        trade.QUOTE,
        trade.ORDER,
        trade.DELIVERY,
        trade.INVOICE,
        trade.PURCHASE_ORDER,
        trade.RECEIPT,
        shopfloor.PRODUCTION,
        shopfloor.ORDER_TIMES,
        shopfloor.OTHER_TIMES,
        shopfloor.CAPACITY,
    )
}
