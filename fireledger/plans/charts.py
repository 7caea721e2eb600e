"""The aggregate behind each kind of dashboard chart, over the emission star.

Dimensions are ``country``, ``region``, ``continent``, ``gas``, ``month`` and
``year``. All records count: those without a value of a dimension make a NULL line.
A ``limit`` cuts the finished rows only; totals and pages are those of all rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fireledger.functions.totals import total_by
from fireledger.operators.ranking import number_large
from fireledger.plans.star import Star


def _largest() -> Column:
    return F.col("total").desc_nulls_last()


def _cut(rows: DataFrame, limit: int | None) -> DataFrame:
    return rows if limit is None else rows.limit(limit)


def grand_total(star: Star) -> DataFrame:
    """One number: the sum of all records."""
    return star.totals(complete=True).select(
        F.col("total").cast("double").alias("total_emission")
    )


def shares(star: Star, dimension: str) -> DataFrame:
    """Total by one dimension, largest first, with its share of the whole."""
    totals = star.total_by(dimension, complete=True)
    whole = totals.agg(F.sum("total").cast("double")).scalar()
    total = F.col("total").cast("double")
    return totals.orderBy(_largest(), dimension).select(
        dimension, total.alias("total_emission"), F.try_divide(total, whole).alias("share")
    )


def stacked(star: Star, axis: str, series: str, limit: int | None = None) -> DataFrame:
    """Totals by axis and series, axis values by their own total, smallest first."""
    pairs = star.total_by(axis, series, complete=True)
    axes = total_by(pairs, axis, value="total", out="axis_total").withColumnRenamed(axis, "_axis")
    rows = (
        pairs.join(axes, F.col(axis).eqNullSafe(F.col("_axis")))
        .orderBy("axis_total", axis, _largest(), series)
        .select(
            axis,
            series,
            F.col("total").cast("double").alias("total_emission"),
            F.col("axis_total").cast("double").alias("axis_total"),
        )
    )
    return _cut(rows, limit)


def bar_pairs(star: Star, first: str, second: str, limit: int | None = None) -> DataFrame:
    """Total by two dimensions, largest first."""
    rows = (
        star.total_by(first, second, complete=True)
        .orderBy(_largest(), first, second)
        .select(first, second, F.col("total").cast("double").alias("total_emission"))
    )
    return _cut(rows, limit)


def top_pairs(
    star: Star, first: str, second: str, limit: int | None = None, page_rows: int = 10
) -> DataFrame:
    """`bar_pairs` in numbered pages."""
    pairs = number_large(star.total_by(first, second, complete=True), [], "total", "_place", [first, second])
    rows = pairs.orderBy("_place").select(
        first,
        second,
        F.col("total").cast("double").alias("total_emission"),
        (F.floor((F.col("_place") - 1) / page_rows) + 1).cast("int").alias("page"),
    )
    return _cut(rows, limit)


CHARTS = {
    "bar_pairs": bar_pairs,
    "grand_total": grand_total,
    "shares": shares,
    "stacked": stacked,
    "top_pairs": top_pairs,
}
