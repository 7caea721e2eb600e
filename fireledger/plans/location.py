"""Country, region and continent from the country list, with their totals.

``fires`` is the cleaned records or their monthly quantities.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fireledger.functions.totals import total_by


def _located(fires: DataFrame, countries: DataFrame) -> DataFrame:
    # Summed by code before the join: the list meets one row per code, and a code
    # with most of the records costs no more than another.
    by_code = total_by(fires, "alpha_3", value="emissions_quantity", out="quantity")
    codes = countries.select("`alpha-3`", "`country-code`", "`sub-region-code`")
    return by_code.join(codes, F.col("alpha_3") == F.col("`alpha-3`"), "left")


def _totals(located: DataFrame, code: str) -> DataFrame:
    summed = total_by(located, code, value="quantity")
    return summed.select(f"`{code}`", F.col("total").cast("double").alias("total_gas_emission"))


def country_totals(fires: DataFrame, countries: DataFrame) -> DataFrame:
    """``country-code, total_gas_emission``; a NULL code collects unlisted countries."""
    return _totals(_located(fires, countries), "country-code")


def region_totals(fires: DataFrame, countries: DataFrame) -> DataFrame:
    """``sub-region-code, total_gas_emission`` without fires outside any region."""
    return _totals(_located(fires, countries), "sub-region-code").na.drop(
        subset=["`sub-region-code`"]
    )


def country_dim(countries: DataFrame, totals: DataFrame) -> DataFrame:
    """Every listed country; the total is NULL where there were no fires."""
    listed = countries.select(
        F.col("`country-code`").alias("code"),
        "name",
        F.col("`alpha-2`").alias("alpha_2"),
        F.col("`alpha-3`").alias("alpha_3"),
        F.col("`sub-region-code`").alias("region_code"),
    )
    return listed.join(totals.withColumnRenamed("country-code", "code"), "code", "left")


def region_dim(countries: DataFrame, totals: DataFrame) -> DataFrame:
    """Distinct regions of the list; rows without any region value are dropped."""
    regions = (
        countries.select(
            F.col("`sub-region-code`").alias("code"),
            F.col("`sub-region`").alias("name"),
            F.col("`region-code`").alias("continent_code"),
        )
        .distinct()
        .na.drop(how="all")
    )
    return regions.join(totals.withColumnRenamed("sub-region-code", "code"), "code", "left")


def continent_dim(countries: DataFrame) -> DataFrame:
    """Distinct continents of the list; rows without any value are dropped."""
    return (
        countries.select(F.col("`region-code`").alias("code"), F.col("region").alias("name"))
        .distinct()
        .na.drop(how="all")
    )
