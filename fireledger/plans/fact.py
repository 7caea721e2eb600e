"""The emission fact: one row per cleaned record."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fireledger.functions.totals import merge_states, sum_states, thousandths
from fireledger.operators.numbering import open_copies, place_by_content
from fireledger.schemas import AGGREGATES


def record_counts(cleaned: DataFrame) -> DataFrame:
    """``alpha_3, gas, quantity, month, copies, year``: what the fact takes of the records, counted.

    Counts of parts of the records merge to those of all (`merge_counts`).
    """
    values = [F.col("alpha_3"), F.col("gas"), F.col("emissions_quantity").alias("quantity"), F.col("month"), F.col("year")]
    counted = cleaned.groupBy(*values).agg(F.count("*").alias("copies"))
    return counted.select("alpha_3", "gas", "quantity", "month", "copies", "year")


def merge_counts(*parts: DataFrame) -> DataFrame:
    """The counts of all records, from those of parts."""
    rows = parts[0]
    for part in parts[1:]:
        rows = rows.unionByName(part)
    merged = rows.groupBy("alpha_3", "gas", "quantity", "month", "year").agg(F.sum("copies").alias("copies"))
    return merged.select("alpha_3", "gas", "quantity", "month", "copies", "year")


def _exact(quantity: Column) -> Column:
    """A quantity as text: whole thousandths, as far as these are whole."""
    return F.when(F.abs(quantity) < 9e15, thousandths(F.when(F.abs(quantity) < 9e15, quantity)).cast("string")).otherwise(
        quantity.cast("string")
    )


def keyed_records(records: DataFrame, countries: DataFrame, gases: DataFrame, lookup: DataFrame) -> DataFrame:
    """``records`` (see `record_counts`) with the keys of the dimensions, NULL without a match,
    instead of the values that lead to them.

    Pass dimensions that are stored: Catalyst then knows their size, and joins those
    below the broadcast threshold without moving the records.
    """
    rows = records.withColumnsRenamed({"year": "_year", "month": "_month"})
    country = countries.select(F.col("code").alias("country_code"), F.col("alpha_3").alias("_alpha_3"))
    gas = gases.select(F.col("id").alias("gas_id"), F.col("chemical_label").alias("_label"))
    time = lookup.select("month_id", "num_value", F.col("value").alias("year"))
    return (
        rows.join(country, F.col("alpha_3") == F.col("_alpha_3"), "left")
        .join(gas, F.col("gas") == F.col("_label"), "left")
        .join(time, (F.col("_month") == F.col("num_value")) & (F.col("_year") == F.col("year")), "left")
        .drop("alpha_3", "gas", "_year", "_month", "_alpha_3", "_label", "num_value")
    )


def numbered_fact(records: DataFrame, countries: DataFrame, gases: DataFrame, lookup: DataFrame) -> DataFrame:
    """``id, quantity, country_code, month_id, gas_id, year`` from the counts of the records.

    The id holds the record's year and its place among that year's records in the order of
    their content, so it depends on the records alone, and those of other years leave it as
    it is. A key that a dimension lists twice doubles records under their ids, which the
    audit of keys shows.
    """
    content = [F.col("month"), F.col("alpha_3"), F.col("gas"), _exact(F.col("quantity"))]
    placed = place_by_content(records, "year", content, "copies")
    rows = open_copies(keyed_records(placed, countries, gases, lookup), "copies", "id", dealt_by="year")
    return rows.select("id", "quantity", "country_code", "month_id", "gas_id", "year")


def emission_fact(
    cleaned: DataFrame, countries: DataFrame, gases: DataFrame, lookup: DataFrame
) -> DataFrame:
    """The fact of all cleaned records."""
    return numbered_fact(record_counts(cleaned), countries, gases, lookup)


def cube_states(keyed: DataFrame) -> DataFrame:
    """The sums of the fact by all of its keys."""
    return sum_states(keyed, *AGGREGATES["cube"], value="quantity", copies="copies")


def smaller_states(cube: DataFrame) -> dict[str, DataFrame]:
    """The other stored aggregates, from the cube."""
    return {name: merge_states(cube, *keys) for name, keys in AGGREGATES.items() if name != "cube"}
