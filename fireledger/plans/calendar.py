"""Year and month dimensions, and the lookup the fact uses.

``fires`` is the cleaned records or their monthly quantities. Keys come from the values
(the year; year * 100 + month; 0 for records without a time), so new periods leave
the keys of others as they are.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fireledger.functions.columns import month_name
from fireledger.functions.totals import total_by


def _year_id():
    return F.coalesce(F.col("year"), F.lit(0)).cast("long")


def year_dim(fires: DataFrame) -> DataFrame:
    """``id, value, total_gas_emission``; records without a time make one NULL year."""
    return total_by(fires, "year", value="emissions_quantity").select(
        _year_id().alias("id"),
        F.col("year").alias("value"),
        F.col("total").cast("double").alias("total_gas_emission"),
    )


def month_dim(fires: DataFrame, years: DataFrame) -> DataFrame:
    """``id, name, num_value, year_id``: the months that occur, per year.

    ``year_id`` is NULL where ``years`` lacks the year, as for records without a time.
    """
    months = fires.select("month", "year").distinct()
    return months.join(
        years.select(F.col("id").alias("year_id"), "value"), F.col("year") == F.col("value"), "left"
    ).select(
        (_year_id() * 100 + F.coalesce("month", F.lit(0))).alias("id"),
        month_name(F.col("month")).alias("name"),
        F.col("month").alias("num_value"),
        "year_id",
    )


def time_lookup(months: DataFrame, years: DataFrame) -> DataFrame:
    """``year_id, num_value, month_id, value``: each month with its year's value."""
    return months.select("year_id", "num_value", F.col("id").alias("month_id")).join(
        years.select(F.col("id").alias("year_id"), "value"), "year_id", "left"
    )
