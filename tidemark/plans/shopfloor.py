"""Production, time tracking and workstation capacity."""

from __future__ import annotations

from functools import partial

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions import scalars as X
from tidemark.operators.calendar import CAPACITY_START, as_day
from tidemark.operators.joins import merge_on, spine_cross, spread_join
from tidemark.operators.runs import FIRST, LAST
from tidemark.operators.sizing import measured_small
from tidemark.plans.model import DATE, DOUBLE, INT, TIME, Column, Dataset, Inputs, text
from tidemark.plans.tables import SOURCE_COLUMNS

ORDER_TIME, OTHER_TIME = 1, 3  # fixed values: time types of the two tracking tables
WEEK = [f"DAYCAP_{i}" for i in range(7)]  # Monday to Sunday


def at_company(src: Inputs, rows: DataFrame, site: str) -> DataFrame:
    """Add the legal company of the site as ``company``; rows of unknown sites drop out."""
    sites = src["FACILITY"].select("FCY_0", F.col("LEGCPY_0").alias("company"))
    return spread_join(rows, sites, [(site, "FCY_0")], small=measured_small(sites))


def build_production(src: Inputs) -> DataFrame:
    rows = src["MFGITMTRK"].select("MFGTRKNUM_0", "ITMREF_0", "MFGFCY_0", "CPLQTY_0", "IPTDAT_0")
    result = at_company(src, rows, "MFGFCY_0").select(
        F.col("MFGTRKNUM_0").alias("numerosuivi"),
        F.col("ITMREF_0").alias("codearticle"),
        "company",
        F.col("CPLQTY_0").alias("quantiterealise"),
        F.col("IPTDAT_0").alias("daterealisation"),
    )
    return X.conform(result, PRODUCTION.schema)


def _tracked_time(src: Inputs, time_type: int, operation_hours: str) -> DataFrame:
    rows = src["MFGOPETRK"].filter(F.col("TIMTYP_0") == time_type).select(*SOURCE_COLUMNS["MFGOPETRK"])
    return at_company(src, rows, "MFGFCY_0").select(
        F.col("MFGTRKNUM_0").alias("numerosuivi"),
        "company",
        F.col("CPLQTY_0").alias("quantite"),
        F.col("REJCPLQTY_0").alias("quantiterejet"),
        F.col("CPLWST_0").alias("posterealise"),
        F.col("CPLLAB_0").alias("morealise"),
        X.to_hours("CPLSETTIM_0", "TIMUOMCOD_0").alias("tempsreglage"),
        X.to_hours("CPLOPETIM_0", "TIMUOMCOD_0").alias(operation_hours),
        F.col("MSGNUM_0").alias("message"),
        F.col("IPTDAT_0").alias("dateimputation"),
        F.col("TIMTYP_0").alias("Time_type"),
        F.col("TIMUOMCOD_0").alias("Time_unit"),
    )


def build_time(src: Inputs, time_type: int) -> DataFrame:
    dataset = {ORDER_TIME: ORDER_TIMES, OTHER_TIME: OTHER_TIMES}[time_type]
    hours = dataset.schema.names[7]
    return X.conform(_tracked_time(src, time_type, hours), dataset.schema)


def _week_plans(src: Inputs) -> DataFrame:
    """Workstations with the seven daily capacities of their week schema; a missing schema matches a missing one."""
    stations = src["WORKSTATIO"].select(
        F.col("WST_0").alias("poste"),
        F.col("TWD_0").alias("schema"),
        F.col("WSTDES_0").alias("designationPoste"),
        "WCRFCY_0",
    )
    weeks = src["TABWEEDIA"].select(F.col("TWD_0").alias("schema"), *WEEK)
    return merge_on(at_company(src, stations, "WCRFCY_0").drop("WCRFCY_0"), weeks, "schema")


def _spread_out(plans: DataFrame) -> DataFrame:
    """A station becomes thousands of days: spread the few stations evenly over all tasks before that, copies too."""
    return plans.repartition(int(plans.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def build_capacity(src: Inputs) -> DataFrame:
    end = as_day(src.end)
    days = spine_cross(_spread_out(_week_plans(src)), F.lit(CAPACITY_START), end, "dateschema")
    return X.conform(days.withColumn("tempstheorique", X.by_weekday("dateschema", WEEK)), CAPACITY.schema)


def build_capacity_distinct(src: Inputs) -> DataFrame:
    """The distinct rows of the grid: duplicates are removed per station and weekday, before the days are generated."""
    start, end = F.lit(CAPACITY_START), as_day(src.end)
    named = ["poste", "schema", "designationPoste", "company"]
    hours = _week_plans(src).select(*named, F.posexplode(F.array(*WEEK)).alias("weekday", "tempstheorique"))
    first = F.date_add(start, F.pmod(F.col("weekday") - F.weekday(start), F.lit(7)))
    days = F.when(first <= end, F.sequence(first, end, F.expr("interval 7 days")))
    grid = _spread_out(hours.distinct()).withColumn("dateschema", F.explode(days))
    return X.conform(grid, CAPACITY.schema)


def build_capacity_runs(src: Inputs) -> DataFrame:
    """The distinct rows of the grid as runs of weeks, see operators/runs.py: no day is generated."""
    start, end = F.lit(CAPACITY_START), as_day(src.end)
    named = ["poste", "schema", "designationPoste", "company"]
    hours = _week_plans(src).select(*named, F.posexplode(F.array(*WEEK)).alias("weekday", "tempstheorique")).distinct()
    first = F.date_add(start, F.pmod(F.col("weekday") - F.weekday(start), F.lit(7)))
    rows = X.conform(hours.withColumn("dateschema", first), CAPACITY.schema).filter(F.col("dateschema") <= end)
    last = F.date_add("dateschema", (F.floor(F.datediff(end, "dateschema") / 7) * 7).cast("int"))
    return rows.withColumn(LAST, last).withColumnRenamed("dateschema", FIRST)


def _times(name: str, time_type: int, operation_hours: str) -> Dataset:
    return Dataset(
        name,
        (
            text("numerosuivi", 50, required=True),
            text("company", 50),
            Column("quantite", DOUBLE),
            Column("quantiterejet", DOUBLE),
            text("posterealise", 50),
            text("morealise", 50),
            Column("tempsreglage", DOUBLE),
            Column(operation_hours, DOUBLE),
            Column("message", INT),
            Column("dateimputation", TIME),
            Column("Time_type", INT),
            Column("Time_unit", INT),
        ),
        partial(build_time, time_type=time_type),
        load="insert",
        sync="merge",
        surrogate=False,
        keys=("numerosuivi",),
        order=("dateimputation",),
        unique=("numerosuivi",),
        month_column="dateimputation",
    )


PRODUCTION = Dataset(
    "PRODUCTION",
    (
        text("numerosuivi", required=True),
        text("codearticle", required=True),
        text("company", required=True),
        Column("quantiterealise", DOUBLE, required=True),
        Column("daterealisation", TIME, required=True),
    ),
    build_production,
    load="insert",
    sync="merge",
    surrogate=False,
    keys=("numerosuivi",),
    order=("daterealisation",),
    unique=("numerosuivi",),
    month_column="daterealisation",
)
ORDER_TIMES = _times("SUIVITEMPSOF", ORDER_TIME, "tempsopérealise")
OTHER_TIMES = _times("SUIVITEMPSDIVERS", OTHER_TIME, "tempsoperealise")
CAPACITY = Dataset(
    "POSTEDECHARGE",
    (
        text("poste", 50),
        text("schema", 50),
        text("designationPoste"),
        text("company", 50),
        Column("dateschema", DATE),
        Column("tempstheorique", DOUBLE),
    ),
    build_capacity,
    load="all",
    sync="upsert",
    surrogate=False,
    keys=("poste", "schema", "dateschema"),
    update=("designationPoste", "company", "tempstheorique"),
    month_column="dateschema",
    build_distinct=build_capacity_distinct,
    period=7,
    build_runs=build_capacity_runs,
)
