"""The emission star: the fact and its dimensions, joined as late as possible.

A report first sums the fact by its own keys and joins names to the result. The
records so meet no join, whatever the size of the dimensions, and map-side
aggregation leaves little to shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fireledger.functions.totals import merge_states, total_by, totals_of
from fireledger.schemas import AGGREGATES

# Dimension -> the fact key that leads to it.
FACT_KEY = {
    "country": "country_code",
    "region": "country_code",
    "continent": "country_code",
    "gas": "gas_id",
    "month": "month_id",
    "year": "year",
}


class Star:
    """Reports over a fact and its dimensions, which a subclass provides."""

    continents: DataFrame  # code, name
    regions: DataFrame  # code, name, continent_code
    countries: DataFrame  # code, name, region_code
    gases: DataFrame  # id, name
    months: DataFrame  # id, name, num_value

    def emissions(self, columns: Sequence[str], year: int | None = None) -> DataFrame:
        """Columns of the fact, of one year if named. Its ``year`` is that of its
        month, NULL when the month is."""
        raise NotImplementedError

    def totals(
        self, *keys: str, year: int | None = None, records: str | None = None, complete: bool = False
    ) -> DataFrame:
        """``keys`` and ``total`` over the records that have all of these keys, or with
        ``complete`` over all records."""
        rows = self.emissions([*keys, "quantity"], year)
        if not complete:
            rows = rows.na.drop(subset=list(keys))
        return total_by(rows, *keys, value="quantity", records=records)

    def named(
        self, rows: DataFrame, *dimensions: str, where: Column | None = None, how: str = "inner"
    ) -> DataFrame:
        """Add the name of each dimension; rows without a match are dropped, or with
        ``how="left"`` kept without a name.

        A region comes with its country, a continent with both. ``where`` may test any
        of the names. Each table is joined by itself rather than as part of a joined
        lookup: Catalyst takes the size of a join for the product of its sides, and
        would not broadcast such a lookup however small its tables are.
        """
        wanted = set(dimensions)
        if wanted & {"country", "region", "continent"}:
            rows = rows.join(
                self.countries.select(
                    F.col("code").alias("country_code"), F.col("name").alias("country"), "region_code"
                ),
                "country_code",
                how,
            )
        if wanted & {"region", "continent"}:
            rows = rows.join(
                self.regions.select(
                    F.col("code").alias("region_code"), F.col("name").alias("region"), "continent_code"
                ),
                "region_code",
                how,
            )
        if "continent" in wanted:
            rows = rows.join(
                self.continents.select(
                    F.col("code").alias("continent_code"), F.col("name").alias("continent")
                ),
                "continent_code",
                how,
            )
        if "gas" in wanted:
            gases = self.gases.select(F.col("id").alias("gas_id"), F.col("name").alias("gas"))
            rows = rows.join(gases, "gas_id", how)
        if "month" in wanted:
            rows = self.dated(rows, how)
        rows = rows.drop("region_code", "continent_code")
        return rows if where is None else rows.where(where)

    def dated(self, rows: DataFrame, how: str = "inner") -> DataFrame:
        """Add ``month`` and ``month_name`` for ``month_id``."""
        months = self.months.select(
            F.col("id").alias("month_id"), F.col("num_value").alias("month"), F.col("name").alias("month_name")
        )
        return rows.join(months, "month_id", how)

    def total_by(
        self,
        *dimensions: str,
        year: int | None = None,
        where: Column | None = None,
        complete: bool = False,
    ) -> DataFrame:
        """Names of ``dimensions`` and the exact ``total`` of each combination; with
        ``complete`` records without a name make NULL lines."""
        keys = list(dict.fromkeys(FACT_KEY[d] for d in dimensions))
        totals = self.totals(*keys, year=year, complete=complete)
        rows = self.named(totals, *dimensions, where=where, how="left" if complete else "inner")
        return total_by(rows, *dimensions, value="total")


class TableStar(Star):
    """The star over the warehouse tables.

    A fact table without the ``year`` column gets it from the month. ``aggregates`` are the
    stored sums of the fact (see `schemas.AGGREGATES`): totals come from the smallest one that
    has all keys asked for, and from the fact if none has.
    """

    def __init__(self, tables: dict[str, DataFrame], aggregates: dict[str, DataFrame] | None = None):
        self._aggregates = aggregates or {}
        self.years = tables["year"]
        self.continents = tables["continent"]
        self.regions = tables["region"]
        self.countries = tables["country"]
        self.gases = tables["gas"]
        self.months = tables["month"]
        self._fact = tables["gas_emission"]
        if "year" not in self._fact.columns:
            months = tables["month"].select(F.col("id").alias("month_id"), "year_id")
            years = tables["year"].select(F.col("id").alias("year_id"), F.col("value").alias("year"))
            self._fact = self._fact.join(months, "month_id", "left").join(years, "year_id", "left")

    def emissions(self, columns: Sequence[str], year: int | None = None) -> DataFrame:
        rows = self._fact if year is None else self._fact.where(F.col("year") == year)
        return rows.select(*columns)

    def totals(
        self, *keys: str, year: int | None = None, records: str | None = None, complete: bool = False
    ) -> DataFrame:
        asked = {*keys, *([] if year is None else ["year"])}
        holding = [name for name in self._aggregates if asked <= set(AGGREGATES[name])]
        if not holding:
            return super().totals(*keys, year=year, records=records, complete=complete)
        rows = self._aggregates[min(holding, key=self._size)]
        if year is not None:
            rows = rows.where(F.col("year") == year)
        if not complete:
            rows = rows.na.drop(subset=list(keys))
        return totals_of(merge_states(rows, *keys), *keys, records=records)

    def _size(self, name: str) -> tuple[int, str]:
        """The size of an aggregate as Catalyst knows it, and its name for ties."""
        size = self._aggregates[name]._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
        return int(str(size)), name

    def emissions_during(
        self, columns: Sequence[str], years: Column | None = None, months: Column | None = None
    ) -> DataFrame:
        """Columns of the records of the years and months for which the conditions hold.

        ``years`` may test ``year`` and ``year_total``, ``months`` may test ``month`` (1 to 12)
        and ``month_name``. The years that are left are joined on the fact's partition
        column, so Spark reads the files of these years only, which it knows when the query
        runs (dynamic partition pruning). Each table is joined by itself, see `named`.
        """
        rows = self._fact
        if years is not None:
            known = self.years.select(F.col("value").alias("year"), F.col("total_gas_emission").alias("year_total"))
            chosen = known.where(years).select(F.col("year").alias("_year"))
            rows = rows.join(chosen, F.col("year") == F.col("_year"))
        if months is not None:
            known = self.months.select(
                F.col("id").alias("_month_id"), F.col("num_value").alias("month"), F.col("name").alias("month_name")
            )
            rows = rows.join(known.where(months).select("_month_id"), F.col("month_id") == F.col("_month_id"))
        return rows.select(*columns)
