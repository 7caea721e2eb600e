"""The ten reports, the disabled one, and the stated intent where it differs.

Defaults of the parameters are the values the reports were written with. Totals
are exact; a result is rounded where the report rounds it. Names of countries and
gases are taken to be unique, as their lists are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fireledger.functions.totals import mean, total_by
from fireledger.operators.neighbours import centred_mean
from fireledger.operators.ranking import rank_large, top_ranked
from fireledger.plans.star import Star


def _double(name: str) -> Column:
    return F.col(name).cast("double")


def _rounded(value: Column) -> Column:
    return F.round(value, 2).cast("double")


def top_month(star: Star, year: int = 2015) -> DataFrame:
    """The month of a year with the largest total."""
    totals = star.named(star.totals("month_id", year=year), "month")
    return (
        totals.orderBy(F.col("total").desc_nulls_last(), "month_id")
        .limit(1)
        .select(_double("total").alias("max_total_emission"), "month_id", "month_name")
    )


def top_gases(star: Star, amounts: DataFrame, k: int) -> DataFrame:
    """The ``k`` leading gases of each country and year, with ties."""
    gases = star.named(amounts.na.drop(subset=["year", "gas_id"]), "gas")
    keys = [c for c in gases.columns if c not in ("gas_id", "total")]
    merged = gases.groupBy(*keys).agg(F.sum("total").alias("total"))
    return top_ranked(merged, ["year", "country_code"], "total", k, "gas_rank")


def country_total_per_top_gas(star: Star, k: int = 2) -> DataFrame:
    """Report 2 as written: per country and year, the country's all-time total once
    for every gas among that year's top ``k``.

    The all-time total counts records without a gas or a month too. Both it and the
    ranks come from one aggregation of the fact.
    """
    keys = ["country_code", "year", "gas_id"]
    totals = star.totals(*keys, complete=True).where(F.col("country_code").isNotNull())
    amounts = totals.withColumn(
        "all_time", F.sum("total").over(Window.partitionBy("country_code"))
    )
    counted = (
        top_gases(star, amounts, k)
        .groupBy("country_code", "year", "all_time")
        .agg((F.col("all_time") * F.count("*")).alias("amount"))
    )
    return (
        star.named(counted, "country")
        .groupBy(F.col("country").alias("country_name"), "year")
        .agg(_rounded(F.sum("amount")).alias("cumulative_emission"))
    )


def top_gases_running_total(star: Star, k: int = 2) -> DataFrame:
    """Report 2 as stated: running total over the years of the top ``k`` gases."""
    top = top_gases(star, star.totals("country_code", "year", "gas_id"), k)
    yearly = top.groupBy("country_code", "year").agg(F.sum("total").alias("total"))
    so_far = (
        Window.partitionBy("country_code")
        .orderBy("year")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    running = yearly.withColumn("running", F.sum("total").over(so_far))
    return star.named(running, "country").select(
        F.col("country").alias("country_name"),
        "year",
        _rounded(F.col("running")).alias("cumulative_emission"),
    )


def largest_yearly_increase(star: Star) -> DataFrame:
    """Per continent, the year that rose most over the one before it; ties stay."""
    yearly = star.total_by("continent", "year")
    by_year = Window.partitionBy("continent").orderBy("year")
    changes = yearly.withColumn("increase", F.col("total") - F.lag("total").over(by_year))
    best = top_ranked(
        changes.where("increase IS NOT NULL AND continent IS NOT NULL"), ["continent"], "increase", 1
    )
    return best.select(
        F.col("continent").alias("continent_name"),
        "year",
        _rounded(F.col("increase")).alias("max_increase"),
    )


def _yearly_by_country(star: Star, continent: str) -> DataFrame:
    return star.named(
        star.totals("country_code", "year"), "continent", where=F.col("continent") == continent
    )


def rank_change(star: Star, continent: str = "Europe") -> DataFrame:
    """Report 4 as written: does a year rank higher among its country's years than
    the year after it? A year without a next one gives no row."""
    ranks = _yearly_by_country(star, continent).withColumn(
        "rank",
        F.rank().over(Window.partitionBy("country_code").orderBy(F.col("total").desc_nulls_last())),
    )
    by_year = Window.partitionBy("country_code").orderBy("year")
    following = ranks.withColumns(
        {"next_year": F.lead("year").over(by_year), "next_rank": F.lead("rank").over(by_year)}
    )
    change = (
        F.when(F.col("rank") == F.col("next_rank"), "Stable")
        .when(F.col("rank") < F.col("next_rank"), "Increased")
        .otherwise("Decreased")
    )
    return following.where(F.col("next_year") == F.col("year") + 1).select(
        F.col("country").alias("country_name"), "year", change.alias("rank_change")
    )


def yearly_direction(
    star: Star, continent: str = "Europe", tolerance: float = 0.05
) -> DataFrame:
    """Report 4 as stated: each year against the one before, about equal within
    ``tolerance`` of the earlier total."""
    by_year = Window.partitionBy("country_code").orderBy("year")
    changes = _yearly_by_country(star, continent).withColumns(
        {"last_year": F.lag("year").over(by_year), "last_total": F.lag("total").over(by_year)}
    )
    step = (F.col("total") - F.col("last_total")).cast("double")
    allowed = F.abs(_double("last_total")) * tolerance
    direction = (
        F.when(F.abs(step) <= allowed, "Stable").when(step > 0, "Increased").when(step < 0, "Decreased")
    )
    return changes.where(F.col("last_year") == F.col("year") - 1).select(
        F.col("country").alias("country_name"), "year", direction.alias("direction")
    )


def ranked_countries(star: Star, continent: str = "Asia", year: int = 2020) -> DataFrame:
    """Countries of a continent by their total in a year, largest first."""
    totals = star.total_by(
        "continent", "country", "year", year=year, where=F.col("continent") == continent
    )
    return rank_large(totals, ["year"], "total", "emission_rank").select(
        "year",
        F.col("country").alias("country_name"),
        _rounded(F.col("total")).alias("total_gas_emission"),
        "emission_rank",
    )


def top_countries_by_gas(star: Star, k: int = 3) -> DataFrame:
    """The ``k`` countries with the largest total per gas and year; ties stay."""
    totals = star.total_by("gas", "country", "year")
    return top_ranked(totals, ["gas", "year"], "total", k).select(
        F.col("gas").alias("gas_name"),
        F.col("country").alias("country_name"),
        "year",
        _rounded(F.col("total")).alias("total_emission"),
    )


def country_and_global_means(star: Star) -> DataFrame:
    """Mean record per country and gas beside the mean of all records of that gas,
    those without a country included.

    The country key is made non-NULL before grouping. So no filter for the join to
    countries is pushed into one of the two uses of the grouped fact, and Spark
    scans and shuffles it once for both.
    """
    amounts = total_by(
        star.emissions(["country_code", "gas_id", "quantity"])
        .where(F.col("gas_id").isNotNull())
        .withColumn("country_code", F.coalesce("country_code", F.lit(""))),
        "country_code",
        "gas_id",
        value="quantity",
        records="records",
    )
    overall = amounts.groupBy("gas_id").agg(
        mean(F.sum("total"), F.sum("records")).alias("global_avg_gas_emission")
    )
    return (
        star.named(amounts.join(overall, "gas_id"), "country", "gas")
        .groupBy(
            F.col("country").alias("country_name"),
            F.col("gas").alias("gas_name"),
            "global_avg_gas_emission",
        )
        .agg(mean(F.sum("total"), F.sum("records")).alias("avg_country_gas_emission"))
        .select("country_name", "gas_name", "avg_country_gas_emission", "global_avg_gas_emission")
    )


def above_global_mean(star: Star, ratio: float = 1.5) -> DataFrame:
    """Countries whose mean record of a gas exceeds ``ratio`` times the global mean."""
    return country_and_global_means(star).where(
        F.col("avg_country_gas_emission") > ratio * F.col("global_avg_gas_emission")
    )


def largest_records(star: Star) -> DataFrame:
    """The largest single record of each year, with its country and gas.

    The maximum per year, country and gas is enough to find it, so records are not
    sorted. Equal records are ordered by country and gas.
    """
    keys = ["year", "country_code", "gas_id"]
    largest = (
        star.emissions([*keys, "quantity"])
        .na.drop(subset=keys)
        .groupBy(*keys)
        .agg(F.max("quantity").alias("quantity"))
    )
    order = Window.partitionBy("year").orderBy(F.col("quantity").desc_nulls_last(), "country", "gas")
    return (
        star.named(largest, "country", "gas")
        .withColumn("rank", F.row_number().over(order))
        .where("rank = 1")
        .select(F.col("country").alias("country_name"), "year", "gas", "quantity")
        .orderBy("year")
    )


def moving_mean_of_records(
    star: Star, region: str = "Northern America", year: int = 2021
) -> DataFrame:
    """Report 9 as written: mean of each record and its two neighbours in time, per
    country and gas. Records of one month have no order in the report; here it is by
    quantity, so neither ids nor the cluster change the result.

    Names are added after the mean, so that only keys and quantities are shuffled.
    """
    keys = ["country_code", "gas_id"]
    rows = star.emissions([*keys, "month_id", "quantity"], year)
    records = star.named(
        rows.na.drop(subset=[*keys, "month_id"]), "region", "month", where=F.col("region") == region
    ).select(*keys, "month", "quantity")
    means = centred_mean(records, keys, "month", "quantity", "moving_avg")
    return (
        star.named(means, "country", "gas")
        .withColumn("year", F.lit(year))
        .orderBy("year", "month", "country", "gas", "moving_avg")
        .select("country", "year", "month", "gas", "moving_avg")
    )


def moving_mean_of_months(
    star: Star, region: str = "Northern America", year: int = 2021
) -> DataFrame:
    """Report 9 as stated: mean of each monthly total and its two neighbours."""
    months = star.named(
        star.totals("country_code", "gas_id", "month_id", "year", year=year),
        "region",
        "gas",
        "month",
        where=F.col("region") == region,
    )
    frame = Window.partitionBy("country_code", "gas_id").orderBy("month").rowsBetween(-1, 1)
    moving = mean(F.sum("total").over(frame), F.count("total").over(frame))
    return months.select("country", "year", "month", "gas", moving.alias("moving_avg")).orderBy(
        "year", "month", "country", "gas"
    )


def continent_ranges(star: Star) -> DataFrame:
    """Continents by the spread of their yearly totals, largest first."""
    return (
        star.total_by("continent", "year")
        .groupBy("continent")
        .agg((F.max("total") - F.min("total")).cast("double").alias("emission_increase"))
        .orderBy(F.col("emission_increase").desc_nulls_last(), "continent")
    )


def country_year_totals(star: Star) -> DataFrame:
    """Total by country and year."""
    return star.total_by("country", "year").select("country", "year", _double("total").alias("sum"))


# Name on the command line -> report.
REPORTS = {
    "top_month": top_month,
    "country_total_per_top_gas": country_total_per_top_gas,
    "top_gases_running_total": top_gases_running_total,
    "largest_yearly_increase": largest_yearly_increase,
    "rank_change": rank_change,
    "yearly_direction": yearly_direction,
    "ranked_countries": ranked_countries,
    "top_countries_by_gas": top_countries_by_gas,
    "above_global_mean": above_global_mean,
    "largest_records": largest_records,
    "moving_mean_of_records": moving_mean_of_records,
    "moving_mean_of_months": moving_mean_of_months,
    "continent_ranges": continent_ranges,
    "country_year_totals": country_year_totals,
}
