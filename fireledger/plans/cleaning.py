"""Raw fire records to cleaned records: one stage, no shuffle."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fireledger.functions import columns as c
from fireledger.functions.totals import total_by

# Fixed names: raw column -> model column.
RENAMED = {"iso3_country": "alpha_3", "original_inventory_sector": "cause"}


def clean_fires(raw: DataFrame) -> DataFrame:
    """One cleaned record per raw record."""
    parsed = raw.withColumnsRenamed(RENAMED).select(
        c.folded_code(F.col("alpha_3")).alias("alpha_3"),
        "cause",
        "temporal_granularity",
        "gas",
        c.rounded_quantity(F.col("emissions_quantity")).alias("emissions_quantity"),
        "emissions_factor",
        c.parsed_time(F.col("start_time")).alias("_time"),
        c.ring_text(F.col("st_astext")).alias("_ring"),
    )
    return parsed.select(
        "alpha_3",
        "cause",
        "temporal_granularity",
        "gas",
        "emissions_quantity",
        "emissions_factor",
        F.year("_time").alias("year"),
        F.month("_time").alias("month"),
        *c.ring_points(F.col("_ring")),
    )


def monthly_quantities(cleaned: DataFrame) -> DataFrame:
    """Quantity by country code, year and month: all that the dimensions need.

    A refresh stores it, so the location and time jobs share one pass over the
    records. It has the column names of the records and can stand in for them.
    """
    return total_by(
        cleaned, "alpha_3", "year", "month", value="emissions_quantity", out="emissions_quantity"
    )
