"""Line dedup by site-relative frequency, with DataFrame functions only.

A line is boilerplate on its site if it stands in more than a given share of the site's pages. Only line hashes are
shuffled, counted map-side first; the texts stay where they are.

An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.frames import packed
from tidemark.operators.joins import spread_join
from tidemark.operators.sizing import measured_small
from tidemark.session import stage

RATIO = 0.1
MIN_PAGES = 3


def _lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def _hash(line: Column) -> Column:
    return F.xxhash64(F.trim(line))


def frequent_lines(
    pages: DataFrame, site: str = "source", text: str = "text", ratio: float = RATIO, min_pages: int = MIN_PAGES
) -> DataFrame:
    """(site, bad): per site the hashes of its boilerplate lines; sites without any are left out.

    A line counts once a page, without the spaces around it; blank lines never count. A boilerplate line stands in
    at least ``min_pages`` pages and in more than ``ratio`` of the site's pages. Rows with a null site form a site of
    their own. A site has at most (mean lines a page) / ratio such lines, so ``bad`` is bounded.
    """
    kept = F.filter(_lines(F.col("text")), lambda l: F.trim(l) != "")
    hashes = F.array_distinct(F.transform(kept, _hash))
    narrow = pages.select(F.col(site).alias("site"), F.col(text).alias("text"))
    counts = narrow.select("site", F.explode(hashes).alias("line")).groupBy("site", "line").agg(F.count("*").alias("n"))
    totals = narrow.groupBy("site").agg(F.count("*").alias("pages")).withColumnRenamed("site", "total_site")
    found = counts.filter(F.col("n") >= min_pages).join(totals, F.col("site").eqNullSafe(F.col("total_site")))
    found = found.filter(F.col("n") > F.col("pages") * F.lit(ratio))
    return found.groupBy("site").agg(F.collect_set("line").alias("bad"))


def drop_frequent_lines(
    pages: DataFrame, site: str = "source", text: str = "text", ratio: float = RATIO, min_pages: int = MIN_PAGES
) -> DataFrame:
    """``pages`` with the boilerplate lines taken out of ``text``: same rows, same columns.

    What stays keeps its order, joined by line feeds. A null text stays null, an empty one empty; a page whose lines
    all go stays with an empty text. Repeated rows count as pages each. Columns of any other name pass through.
    """
    names = pages.columns
    marked = with_frequent_lines(packed(pages), f"row.{site}", f"row.{text}", ratio, min_pages)
    columns = [F.col("kept").alias(n) if n == text else F.col("row").getField(n).alias(n) for n in names]
    return marked.select(*columns)


def with_frequent_lines(
    pages: DataFrame, site: str, text: str, ratio: float = RATIO, min_pages: int = MIN_PAGES
) -> DataFrame:
    """``pages`` and three more columns: ``kept`` (the text left), ``n_lines``, ``n_dropped`` (0 for a null text).

    The few boilerplate lines are broadcast if they are measured to be small; else pages and lines meet in a join
    that spreads a hot site over many tasks.
    """
    bad = stage(frequent_lines(pages, site, text, ratio, min_pages))
    keyed = pages.withColumn("site", F.coalesce(F.concat(F.lit("="), F.col(site)), F.lit("")))
    bad = bad.select(F.coalesce(F.concat(F.lit("="), F.col("site")), F.lit("")).alias("bad_site"), "bad")
    size = bad.select(F.explode("bad"))
    joined = spread_join(keyed, bad, [("site", "bad_site")], "left", small=measured_small(size))
    lines = _lines(F.col(text))
    fresh = F.filter(lines, lambda l: ~F.array_contains(F.col("bad"), _hash(l)))
    touched = joined.withColumn("fresh", F.when(F.col("bad").isNull(), lines).otherwise(fresh)).drop("bad", "site")
    gone = F.size(lines) - F.size("fresh")
    return touched.select(
        *pages.columns,
        F.array_join("fresh", "\n").alias("kept"),
        F.when(F.col(text).isNull(), 0).otherwise(F.size(lines)).cast("long").alias("n_lines"),
        F.when(F.col(text).isNull(), 0).otherwise(gone).cast("long").alias("n_dropped"),
    )
