"""The given tables in the shape of the raw files and of the star.

| model     | given table                                             |
|-----------|---------------------------------------------------------|
| continent | region                                                  |
| region    | nation                                                  |
| country   | supplier                                                |
| gas       | distinct p_type of part                                 |
| record    | lineitem, its gas through part, its time from l_shipdate |
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fireledger.functions.columns import month_name
from fireledger.plans.gases import gas_key
from fireledger.plans.star import Star


class Given:
    """The given tables of one folder, each opened when first used."""

    def __init__(self, spark: SparkSession, folder: str):
        self._spark, self._folder = spark, folder

    def __getattr__(self, table: str) -> DataFrame:
        rows = self._spark.read.parquet(f"{self._folder}/{table}.parquet")
        setattr(self, table, rows)
        return rows


# --- the star the reports read ----------------------------------------------


def _text(name: str) -> Column:
    return F.col(name).cast("string")


def _gas_key() -> Column:
    return gas_key(F.col("p_type"))


class StandInStar(Star):
    """The star over the given tables."""

    def __init__(self, spark: SparkSession, folder: str):
        self._given = Given(spark, folder)

    @cached_property
    def continents(self) -> DataFrame:
        return self._given.region.select(_text("r_regionkey").alias("code"), F.col("r_name").alias("name"))

    @cached_property
    def regions(self) -> DataFrame:
        return self._given.nation.select(
            _text("n_nationkey").alias("code"),
            F.col("n_name").alias("name"),
            _text("n_regionkey").alias("continent_code"),
        )

    @cached_property
    def countries(self) -> DataFrame:
        return self._given.supplier.select(
            _text("s_suppkey").alias("code"),
            F.col("s_name").alias("name"),
            _text("s_nationkey").alias("region_code"),
        )

    @cached_property
    def gases(self) -> DataFrame:
        types = self._given.part.select("p_type").distinct()
        return types.select(_gas_key().alias("id"), F.col("p_type").alias("name"))

    @cached_property
    def months(self) -> DataFrame:
        months = self._given.lineitem.select(
            F.year("l_shipdate").alias("year"), F.month("l_shipdate").alias("num_value")
        ).distinct()
        return months.select(
            (F.col("year") * 100 + F.col("num_value")).cast("long").alias("id"),
            month_name(F.col("num_value")).alias("name"),
            "num_value",
            F.col("year").cast("long").alias("year_id"),
        )

    def dated(self, rows: DataFrame, how: str = "inner") -> DataFrame:
        """The key holds the month, so there is nothing to look up."""
        month = (F.col("month_id") % 100).cast("int")
        return rows.withColumns({"month": month, "month_name": month_name(month)})

    def emissions(self, columns: Sequence[str], year: int | None = None) -> DataFrame:
        rows = self._given.lineitem
        if year is not None:
            start = F.lit(f"{year}-01-01").cast("timestamp_ntz")
            end = F.lit(f"{year + 1}-01-01").cast("timestamp_ntz")
            rows = rows.where((F.col("l_shipdate") >= start) & (F.col("l_shipdate") < end))
        if "gas_id" in columns:
            parts = self._given.part.select("p_partkey", _gas_key().alias("gas_id"))
            rows = rows.join(parts, F.col("l_partkey") == F.col("p_partkey"), "left")
        made = {
            "id": F.col("l_orderkey") * 8 + F.col("l_linenumber"),
            "quantity": F.col("l_extendedprice"),
            "country_code": _text("l_suppkey"),
            "month_id": (F.year("l_shipdate") * 100 + F.month("l_shipdate")).cast("long"),
            "year": F.year("l_shipdate"),
            "gas_id": F.col("gas_id"),
        }
        return rows.select([made[name].alias(name) for name in columns])


# --- the raw files the jobs read --------------------------------------------


def raw_countries(given: Given) -> DataFrame:
    """The country list. Suppliers with a debt stand for countries without a region;
    the code is padded so that leading zeros matter; one alpha-2 is the text NA."""
    placed = given.supplier.join(given.nation, F.col("s_nationkey") == F.col("n_nationkey"), "left")
    placed = placed.join(given.region, F.col("n_regionkey") == F.col("r_regionkey"), "left")
    key = F.col("s_suppkey")

    def unless_in_debt(value: Column) -> Column:
        return F.when(F.col("s_acctbal") >= 0, value)

    return placed.select(
        F.col("s_name").alias("name"),
        F.when(key == 3, "NA").otherwise(F.concat(F.lit("S"), (key % 10).cast("string"))).alias("alpha-2"),
        _alpha_3(key).alias("alpha-3"),
        F.format_string("%03d", key).alias("country-code"),
        unless_in_debt(F.col("r_name")).alias("region"),
        unless_in_debt(F.col("n_name")).alias("sub-region"),
        unless_in_debt(F.format_string("%03d", F.col("r_regionkey"))).alias("region-code"),
        unless_in_debt(F.format_string("%03d", F.col("n_nationkey"))).alias("sub-region-code"),
    )


def _alpha_3(key: Column) -> Column:
    return (
        F.when(key == 0, "XKX").when(key == 1, "SRB").otherwise(F.concat(F.lit("S"), key.cast("string")))
    )


def raw_gases(given: Given) -> DataFrame:
    types = given.part.select("p_type").distinct()
    return types.select(F.lower("p_type").alias("name"), F.col("p_type").alias("chemical-label"))


def raw_fires(given: Given) -> DataFrame:
    """One raw record per line item, some with a bad time, an unlisted gas, a polygon
    with a space before its brackets or with four points only."""
    parts = given.part.select("p_partkey", "p_type", "p_size")
    rows = given.lineitem.join(parts, F.col("l_partkey") == F.col("p_partkey"), "left")

    east = F.col("l_partkey").cast("string")
    north = F.col("l_suppkey").cast("string")
    west, south = F.concat(F.lit("-"), east, F.lit(".5")), F.concat(F.lit("-"), north, F.lit(".25"))
    corners = [F.concat_ws(" ", x, y) for x, y in ((east, north), (west, north), (west, south), (east, south))]
    line = F.col("l_linenumber")
    polygon = F.concat(
        F.when(line == 1, "POLYGON ((").otherwise("POLYGON(("),
        F.concat_ws(",", *corners, F.when(line != 2, corners[0])),
        F.lit("))"),
    )
    bad_time = (F.col("l_linenumber") == 7) & (F.col("l_quantity") == 50)
    # Price less discount has four decimals; made of whole numbers it is exact.
    cents = F.rint(F.col("l_extendedprice") * 100)
    percent = 100 - F.rint(F.col("l_discount") * 100)
    return rows.select(
        _alpha_3(F.col("l_suppkey")).alias("iso3_country"),
        F.col("l_returnflag").alias("original_inventory_sector"),
        F.when(bad_time, "junk").otherwise(F.col("l_shipdate").cast("string")).alias("start_time"),
        F.col("l_shipdate").cast("string").alias("end_time"),
        F.col("l_linestatus").alias("temporal_granularity"),
        F.when(F.col("p_size") == 50, "UNLISTED").otherwise(F.col("p_type")).alias("gas"),
        (cents * percent / 10_000).alias("emissions_quantity"),
        F.col("l_tax").alias("emissions_factor"),
        polygon.alias("st_astext"),
    )
