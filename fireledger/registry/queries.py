"""One query per operator, function, job, report and chart.

Each takes ``(spark, folder of the given tables)`` and returns a DataFrame. Report
parameters are set to values that occur in the given tables.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fireledger.functions import columns as c
from fireledger.functions.totals import mean, total_by
from fireledger.operators import audits
from fireledger.operators.ranking import top_ranked
from fireledger.plans import calendar, charts, gases, location, reports
from fireledger.plans.cleaning import RENAMED, clean_fires, monthly_quantities
from fireledger.plans.fact import emission_fact
from fireledger.plans.refresh import read_aggregates, refresh, refresh_from_files
from fireledger.plans.star import Star, TableStar
from fireledger.registry import standin
from fireledger.registry.standin import Given
from fireledger.schemas import CLEANED_FIRES, RAW_COUNTRIES, RAW_FIRES, TABLES
from fireledger.session import stage, work_folder
from fireledger.sources import (
    create_tables,
    malformed_fields,
    overwrite_table,
    overwrite_tables,
    read_csv,
    read_tables,
    split_csv,
    write_csv,
)

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}
_WAREHOUSES: dict[tuple[str, str], Star] = {}

YEAR = 2000
REGION = "NATION_1"


def _key(name: str):
    def register(query: Query) -> Query:
        _QUERIES[name] = query
        return query

    return register


def _on_star(name: str):
    """Register a query that takes the star: over the given tables, and as ``wh_...``
    over the stored tables of a refresh."""

    def register(query: Callable[[Star], DataFrame]):
        _QUERIES[name] = lambda spark, folder: query(standin.StandInStar(spark, folder))
        if name.startswith(("q", "chart_")):
            _QUERIES[f"wh_{name}"] = lambda spark, folder: query(_warehouse(spark, folder))
        return query

    return register


def _warehouse(spark: SparkSession, folder: str) -> Star:
    """The star over the tables of one refresh for each session and folder."""
    key = (spark.sparkContext.applicationId, folder)
    if key not in _WAREHOUSES:
        database, tables = _refreshed(spark, folder)
        _WAREHOUSES[key] = TableStar(tables, read_aggregates(spark, database))
    return _WAREHOUSES[key]


def _on_fires(name: str):
    """Register a query that takes the raw fire records."""

    def register(query: Callable[[DataFrame], DataFrame]):
        _QUERIES[name] = lambda spark, folder: query(standin.raw_fires(Given(spark, folder)))
        return query

    return register


def _on_cleaned(name: str):
    """Register a query that takes the cleaned fire records."""
    return lambda query: _on_fires(name)(lambda raw: query(clean_fires(raw)))


def _on_countries(name: str):
    """Register a query that takes the country list."""

    def register(query: Callable[[DataFrame], DataFrame]):
        _QUERIES[name] = lambda spark, folder: query(standin.raw_countries(Given(spark, folder)))
        return query

    return register


def _database(folder: str) -> str:
    return "fireledger_" + folder.rsplit("-", 1)[-1]


def _double(name: str, alias: str | None = None):
    return F.col(name).cast("double").alias(alias or name)


# --- scans, sources, sinks ---------------------------------------------------


@_key("src_csv_file")
def src_csv_file(spark, folder):
    """The country list from one file, read by the path of the file itself."""
    path = work_folder(spark)
    write_csv(standin.raw_countries(Given(spark, folder)), path, files=1)
    (file,) = spark.read.csv(path).inputFiles()
    return read_csv(spark, file, RAW_COUNTRIES).withColumnsRenamed(
        {name: name.replace("-", "_") for name in RAW_COUNTRIES.names}
    )


@_key("src_csv_dir")
def src_csv_dir(spark, folder):
    path = work_folder(spark)
    write_csv(clean_fires(standin.raw_fires(Given(spark, folder))), path)
    return read_csv(spark, path, CLEANED_FIRES)


@_key("src_table")
def src_table(spark, folder):
    work = work_folder(spark)
    database = _database(work)
    create_tables(spark, database, location=work)
    rows = _star_tables(spark, folder)
    overwrite_tables(spark, database, {name: rows[name] for name in ("region", "country")})
    tables = read_tables(spark, database)
    regions = tables["region"].select(F.col("code").alias("region_code"), F.col("name").alias("region"))
    return tables["country"].join(regions, "region_code").select("code", "name", "region")


@_key("sink_csv_overwrite")
def sink_csv_overwrite(spark, folder):
    """The country list, replaced by the year dimension in a single file."""
    path, given = work_folder(spark), Given(spark, folder)
    write_csv(standin.raw_countries(given), path)
    write_csv(calendar.year_dim(clean_fires(standin.raw_fires(given))), path, files=1)
    return read_csv(spark, path, TABLES["year"])


@_key("sink_csv_ordered")
def sink_csv_ordered(spark, folder):
    """Countries by their total, in five files that follow the order: the rows of each file
    between its largest and smallest total, and whether these are within those of its neighbours."""
    path, star = work_folder(spark), standin.StandInStar(spark, folder)
    totals = star.total_by("country").select("country", _double("total"))
    write_csv(totals, path, files=5, order=[F.col("total").desc(), "country"])
    read = read_csv(spark, path, totals.schema).withColumn("file", F.regexp_extract(F.input_file_name(), r"part-(\d+)", 1))
    files = read.groupBy("file").agg(F.count("*").alias("rows"), F.min("total").alias("low"), F.max("total").alias("high"))
    after = F.lead("high").over(Window.partitionBy(F.lit(1)).orderBy("file"))
    return files.withColumn("after", after).agg(
        F.sum("rows").alias("countries"), F.count_if(F.col("after") > F.col("low")).alias("breaches")
    )


@_key("sink_table_overwrite")
def sink_table_overwrite(spark, folder):
    work = work_folder(spark)
    database = _database(work)
    create_tables(spark, database, location=work)
    star = standin.StandInStar(spark, folder)
    for year in (YEAR, None):
        rows = star.emissions(TABLES["gas_emission"].names, year)
        written = overwrite_table(rows, database, "gas_emission")
    named = written.join(star.gases.select(F.col("id").alias("gas_id"), F.col("name").alias("gas")), "gas_id")
    return named.select("id", "quantity", "country_code", "month_id", "gas", "year")


@_key("ddl_star_schema")
def ddl_star_schema(spark, folder):
    work = work_folder(spark)
    database = _database(work)
    create_tables(spark, database, location=work)
    parts = []
    for name, table in overwrite_tables(spark, database, _star_tables(spark, folder)).items():
        types = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in table.schema)
        parts.append(
            table.agg(F.count("*").alias("records")).select(
                F.lit(name).alias("table_name"), F.lit(types).alias("column_types"), "records"
            )
        )
    return reduce(DataFrame.unionByName, parts)


def _star_tables(spark, folder) -> dict[str, DataFrame]:
    """The stand-in star as seven tables, without rolled-up totals."""
    star = standin.StandInStar(spark, folder)
    none = F.lit(None).cast("string")
    no_total = F.lit(None).cast("double").alias("total_gas_emission")
    years = star.months.select(F.col("year_id").alias("id"), F.col("year_id").cast("int").alias("value"))
    return {
        "continent": star.continents,
        "region": star.regions.select("*", no_total),
        "country": star.countries.select("*", none.alias("alpha_3"), none.alias("alpha_2"), no_total),
        "year": years.distinct().select("*", no_total),
        "month": star.months,
        "gas": star.gases.select("*", F.col("name").alias("chemical_label")),
        "gas_emission": star.emissions(TABLES["gas_emission"].names),
    }


@_key("audit_primary_key")
def audit_primary_key(spark, folder):
    return audits.primary_key_report(_star_tables(spark, folder))


@_key("audit_foreign_key")
def audit_foreign_key(spark, folder):
    return audits.foreign_key_report(_refreshed(spark, folder)[1])


@_key("audit_not_null")
def audit_not_null(spark, folder):
    """Tables whose keys are taken from the raw values, where some are missing."""
    given = Given(spark, folder)
    listed, cleaned = standin.raw_countries(given), clean_fires(standin.raw_fires(given))
    keys = {
        "continent": listed.select(F.col("`region-code`").alias("code")),
        "region": listed.select(F.col("`sub-region-code`").alias("code")),
        "country": listed.select(F.col("`country-code`").alias("code")),
        "year": cleaned.select(F.col("year").alias("id")),
        "month": cleaned.select(F.col("month").alias("id")),
        "gas": gases.gas_dim(standin.raw_gases(given)),
        "gas_emission": cleaned.select(F.lit(1).alias("id")),
    }
    return audits.not_null_report(keys)


@_key("audit_csv_fields")
def audit_csv_fields(spark, folder):
    """Files with words for some numbers, and a field too many in some lines."""
    path = work_folder(spark)
    fires = standin.raw_fires(Given(spark, folder)).withColumns(
        {
            "emissions_factor": F.when(F.col("emissions_factor") > 0.05, "high").otherwise("0.01"),
            "emissions_quantity": F.when(F.col("temporal_granularity") == "F", "n/a").otherwise("1.5"),
            "gas": F.when(F.col("gas") == "UNLISTED", "UNLISTED;torn").otherwise(F.col("gas")),
        }
    )
    fires.write.csv(path, header=True, sep=";", quote="")
    return malformed_fields(spark, path, RAW_FIRES, delimiter=";")


@_on_cleaned("audit_quantities")
def audit_quantities(cleaned):
    """Records of one cause made endless, those of another finer than thousandths."""
    quantity = F.col("emissions_quantity")
    spoilt = F.when(F.col("cause") == "R", float("inf")).when(F.col("cause") == "A", quantity + 0.0004)
    return audits.quantity_report(cleaned.select(spoilt.otherwise(quantity).alias("quantity")))


@_key("src_csv_quarantine")
def src_csv_quarantine(spark, folder):
    """Records by gas, and the lines of the files that do not parse, read in one pass."""
    work = work_folder(spark)
    spoilt = standin.raw_fires(Given(spark, folder)).withColumn(
        "emissions_quantity",
        F.when(F.col("temporal_granularity") == "F", "n/a").otherwise(F.col("emissions_quantity").cast("string")),
    )
    torn = spoilt.withColumn("gas", F.when(F.col("gas") == "UNLISTED", "UNLISTED;torn").otherwise(F.col("gas")))
    torn.write.csv(f"{work}/raw", header=True, sep=";", quote="")
    good, lines, _ = split_csv(spark, f"{work}/raw", RAW_FIRES, f"{work}/split", delimiter=";")
    torn_apart = F.col("line").contains("UNLISTED;torn")
    what = F.when(torn_apart, "(field too many)").otherwise("(no number)")
    return (
        good.select("gas")
        .unionByName(lines.select(what.alias("gas")))
        .groupBy("gas")
        .agg(F.count("*").alias("lines"))
    )


# --- projections and filters -------------------------------------------------


@_on_fires("proj_select")
def proj_select(raw):
    return raw.select("iso3_country", "gas", "emissions_quantity")


@_on_fires("proj_rename")
def proj_rename(raw):
    return raw.withColumnsRenamed(RENAMED).select("alpha_3", "cause", "gas")


@_on_fires("proj_with_column")
def proj_with_column(raw):
    return raw.select("start_time", "emissions_quantity").withColumns(
        {
            "year": F.year(c.parsed_time(F.col("start_time"))),
            "emissions_quantity": c.rounded_quantity(F.col("emissions_quantity")),
        }
    )


@_on_fires("proj_loop_columns")
def proj_loop_columns(raw):
    return raw.select(c.ring_text(F.col("st_astext")).alias("ring")).select("ring", *c.ring_points(F.col("ring")))


@_on_fires("proj_drop")
def proj_drop(raw):
    return raw.drop("start_time", "end_time")


@_on_star("filter_eq")
def filter_eq(star):
    rows = star.emissions(["country_code", "year", "quantity"], YEAR)
    return star.named(rows, "continent", where=F.col("continent") == "ASIA").select("country", "year", "quantity")


@_on_star("filter_rank_le")
def filter_rank_le(star):
    return top_ranked(star.total_by("gas", "year"), ["year"], "total", 2).select(
        "gas", "year", "emission_rank"
    )


@_on_star("filter_having")
def filter_having(star):
    totals = star.total_by("region", "gas")
    middle = totals.groupBy("gas").agg((F.avg("total").cast("double")).alias("mean_total"))
    return (
        totals.join(middle, "gas")
        .where(F.col("total").cast("double") > 1.1 * F.col("mean_total"))
        .select("region", "gas", _double("total"))
    )


@_on_countries("filter_dropna_all")
def filter_dropna_all(countries):
    return countries.select(
        F.col("`sub-region-code`").alias("code"), F.col("`sub-region`").alias("name")
    ).na.drop(how="all")


@_on_countries("filter_dropna_subset")
def filter_dropna_subset(countries):
    return countries.select("name", F.col("`region-code`").alias("region_code")).na.drop(subset=["region_code"])


@_on_star("case_when")
def case_when(star):
    by_year = Window.partitionBy("gas").orderBy("year")
    following = star.total_by("gas", "year").withColumn("next_total", F.lead("total").over(by_year))
    label = (
        F.when(F.col("next_total").isNull(), "Last")
        .when(F.col("next_total") > F.col("total"), "Increased")
        .otherwise("Decreased")
    )
    return following.select("gas", "year", label.alias("direction"))


# --- joins -------------------------------------------------------------------


@_key("join_left_equi")
def join_left_equi(spark, folder):
    given = Given(spark, folder)
    fires = clean_fires(standin.raw_fires(given))
    by_code = total_by(fires, "alpha_3", value="emissions_quantity")
    listed = standin.raw_countries(given).select("name", F.col("`alpha-3`").alias("alpha_3"))
    return listed.join(by_code, "alpha_3", "left").select("name", "alpha_3", _double("total"))


@_on_cleaned("join_left_using")
def join_left_using(cleaned):
    years = calendar.year_dim(cleaned)
    return calendar.time_lookup(calendar.month_dim(cleaned, years), years)


@_on_cleaned("join_left_composite")
def join_left_composite(cleaned):
    spark, work = cleaned.sparkSession, work_folder(cleaned.sparkSession)
    years = stage(calendar.year_dim(cleaned), work, "year")
    months = stage(calendar.month_dim(cleaned, years), work, "month")
    lookup = stage(calendar.time_lookup(months, years), work, "lookup").withColumnRenamed("value", "_year")
    matched = (F.col("month") == F.col("num_value")) & (F.col("year") == F.col("_year"))
    return (
        cleaned.select("year", "month", "gas")
        .join(lookup, matched, "left")
        .groupBy("month_id", "year", "month", "gas")
        .agg(F.count("*").alias("records"))
    )


@_on_star("join_inner_star")
def join_inner_star(star):
    rows = star.named(star.totals("country_code", "gas_id", "month_id", "year"), "continent", "gas", "month")
    return rows.select("continent", "region", "country", "gas", "year", "month", _double("total"))


@_on_star("join_comma_mixed")
def join_comma_mixed(star):
    """Report 2 as its text joins it, with the fact summed by country beforehand."""
    top = reports.top_gases(star, star.totals("country_code", "year", "gas_id"), 2)
    whole = total_by(
        star.emissions(["country_code", "quantity"]), "country_code", value="quantity", out="amount"
    )
    years = star.months.select(F.col("year_id").cast("int").alias("value")).distinct()
    names = star.gases.select(F.col("name").alias("gas_name"))
    joined = (
        top.join(years, F.col("year") == F.col("value"))
        .join(names, F.col("gas") == F.col("gas_name"))
        .join(whole, "country_code")
    )
    return (
        star.named(joined, "country")
        .groupBy(F.col("country").alias("country_name"), "year")
        .agg(F.sum("amount").cast("double").alias("emission"))
    )


@_on_star("join_self_offset")
def join_self_offset(star):
    totals = star.total_by("continent", "year")
    later = totals.select("continent", (F.col("year") - 1).alias("year"), F.col("total").alias("next_total"))
    return totals.join(later, ["continent", "year"]).select(
        "continent", "year", _double("total"), _double("next_total")
    )


@_on_star("join_back_to_max")
def join_back_to_max(star):
    best = top_ranked(star.total_by("gas", "year"), ["gas"], "total", 1)
    return best.select("gas", "year", _double("total", "max_total"))


_on_star("join_agg_to_detail")(reports.country_and_global_means)


# --- aggregations --------------------------------------------------------------


@_on_star("agg_sum_group")
def agg_sum_group(star):
    return star.total_by("country", "gas").select("country", "gas", _double("total"))


@_on_cleaned("agg_sum_rounded")
def agg_sum_rounded(cleaned):
    return total_by(cleaned, "cause", value="emissions_quantity").select(
        "cause", F.round("total", 3).cast("double").alias("total_gas_emission")
    )


@_on_star("agg_avg_group")
def agg_avg_group(star):
    rows = star.named(star.totals("gas_id", "year", records="records"), "gas")
    return rows.select("gas", "year", mean(F.col("total"), F.col("records")).alias("mean_quantity"))


@_on_star("agg_max_group")
def agg_max_group(star):
    return star.total_by("continent", "year").groupBy("continent").agg(
        F.max("total").cast("double").alias("max_total")
    )


@_on_star("agg_range")
def agg_range(star):
    return star.total_by("gas", "year").groupBy("gas").agg(
        (F.max("total") - F.min("total")).cast("double").alias("spread")
    )


@_on_cleaned("agg_distinct_rows")
def agg_distinct_rows(cleaned):
    return cleaned.select("month", "year").distinct()


@_on_star("agg_group_as_distinct")
def agg_group_as_distinct(star):
    keys = ["country_code", "year", "gas_id"]
    rows = star.emissions([*keys, "quantity"]).dropDuplicates([*keys, "quantity"])
    return star.named(rows, "country", "gas").select("country", "year", "gas", "quantity")


# --- windows -------------------------------------------------------------------


@_on_star("win_rank_over_sum")
def win_rank_over_sum(star):
    order = Window.partitionBy("year").orderBy(F.col("total").desc())
    return star.total_by("gas", "year").select("gas", "year", F.rank().over(order).alias("emission_rank"))


@_on_star("win_lag_over_sum")
def win_lag_over_sum(star):
    order = Window.partitionBy("continent").orderBy("year")
    change = F.col("total") - F.lag("total").over(order)
    return star.total_by("continent", "year").select(
        "continent", "year", change.cast("double").alias("quantity_increase")
    )


@_on_star("win_row_number")
def win_row_number(star):
    order = Window.partitionBy("gas").orderBy(F.col("total").desc(), "region")
    return star.total_by("gas", "region").select("gas", "region", F.row_number().over(order).alias("position"))


@_on_star("win_moving_avg")
def win_moving_avg(star):
    frame = Window.partitionBy("gas_id").orderBy("month_id").rowsBetween(-1, 1)
    moving = mean(F.sum("total").over(frame), F.count("total").over(frame))
    rows = star.totals("gas_id", "month_id").withColumn("moving_avg", moving)
    return star.named(rows, "gas").select("gas", "month_id", "moving_avg")


# --- sorts and limits ------------------------------------------------------------


@_on_star("sort_global")
def sort_global(star):
    return star.total_by("country", "year").orderBy(F.col("year").asc(), F.col("total").desc(), "country").select(
        "country", "year", _double("total")
    )


@_on_star("top_1")
def top_1(star):
    return star.total_by("country").orderBy(F.col("total").desc(), "country").limit(1).select(
        "country", _double("total")
    )


@_on_star("top_k_per_group")
def top_k_per_group(star):
    return top_ranked(star.total_by("region", "year"), ["year"], "total", 3).select(
        "region", "year", _double("total"), "emission_rank"
    )


# --- scalar functions --------------------------------------------------------------


@_on_fires("fn_round")
def fn_round(raw):
    quantity = F.col("emissions_quantity")
    return raw.select("emissions_quantity", c.rounded_quantity(quantity).alias("rounded"))


@_on_fires("fn_to_timestamp")
def fn_to_timestamp(raw):
    return raw.select("start_time", c.parsed_time(F.col("start_time")).cast("timestamp_ntz").alias("parsed"))


@_on_fires("fn_year_month")
def fn_year_month(raw):
    times = raw.select(c.parsed_time(F.col("start_time")).alias("time"))
    return times.select(F.year("time").alias("year"), F.month("time").alias("month"))


@_on_cleaned("fn_month_name")
def fn_month_name(cleaned):
    return cleaned.select("month", c.month_name(F.col("month")).alias("name"))


@_on_fires("fn_regexp_extract")
def fn_regexp_extract(raw):
    return raw.select("st_astext", c.ring_text(F.col("st_astext")).alias("ring"))


@_on_fires("fn_regexp_replace")
def fn_regexp_replace(raw):
    return raw.select("iso3_country", c.folded_code(F.col("iso3_country")).alias("alpha_3"))


@_on_fires("fn_split")
def fn_split(raw):
    points = F.split(c.ring_text(F.col("st_astext")), ",")
    return raw.select("st_astext", F.size(points).alias("points"))


@_on_fires("fn_array_item")
def fn_array_item(raw):
    points = F.split(c.ring_text(F.col("st_astext")), ",")
    return raw.select(F.get(points, F.lit(0)).alias("first"), F.get(points, F.lit(4)).alias("last"))


@_on_cleaned("fn_cast")
def fn_cast(cleaned):
    text = F.col("month").cast("string")
    return cleaned.select(text.alias("month_text"), text.cast("int").alias("month"))


@_key("fn_surrogate_key")
def fn_surrogate_key(spark, folder):
    return gases.gas_dim(standin.raw_gases(Given(spark, folder)))


@_on_fires("fn_arith_compare")
def fn_arith_compare(raw):
    quantity, factor = F.col("emissions_quantity"), F.col("emissions_factor")
    return raw.select(
        "emissions_quantity",
        "emissions_factor",
        (quantity > 50_000).alias("large"),
        ((quantity <= 50_000) & (factor < 0.05)).alias("small"),
        (F.rint(factor * 100).cast("int") - 1).alias("less_one"),
    )


# --- jobs ----------------------------------------------------------------------------


_on_cleaned("job_clean_fires")(lambda cleaned: cleaned)


def _on_located(name: str):
    """Register a query that takes the cleaned records and the country list."""

    def register(query):
        def run(spark, folder):
            given = Given(spark, folder)
            return query(clean_fires(standin.raw_fires(given)), standin.raw_countries(given))

        _QUERIES[name] = run
        return query

    return register


@_on_located("job_country_totals")
def job_country_totals(fires, countries):
    return location.country_totals(fires, countries).withColumnRenamed("country-code", "country_code")


@_on_located("job_region_totals")
def job_region_totals(fires, countries):
    return location.region_totals(fires, countries).withColumnRenamed("sub-region-code", "sub_region_code")


@_on_located("job_dim_country")
def job_dim_country(fires, countries):
    return location.country_dim(countries, location.country_totals(fires, countries))


@_on_located("job_dim_region")
def job_dim_region(fires, countries):
    return location.region_dim(countries, location.region_totals(fires, countries))


_on_countries("job_dim_continent")(location.continent_dim)
_on_cleaned("job_dim_year")(calendar.year_dim)


@_on_cleaned("job_dim_month")
def job_dim_month(cleaned):
    return calendar.month_dim(cleaned, calendar.year_dim(cleaned))


@_key("job_dim_gas")
def job_dim_gas(spark, folder):
    return gases.gas_dim(standin.raw_gases(Given(spark, folder))).orderBy("chemical_label")


@_on_cleaned("job_time_lookup")
def job_time_lookup(cleaned):
    """From the monthly quantities, as the refresh makes it."""
    monthly = monthly_quantities(cleaned)
    years = calendar.year_dim(monthly)
    return calendar.time_lookup(calendar.month_dim(monthly, years), years)


@_key("job_fact_emission")
def job_fact_emission(spark, folder):
    """With its id, which the content of the records decides."""
    return _staged_fact(spark, folder)


def _staged_fact(spark, folder) -> DataFrame:
    given, work = Given(spark, folder), work_folder(spark)
    cleaned = stage(clean_fires(standin.raw_fires(given)), work, "cleaned")
    monthly = stage(monthly_quantities(cleaned), work, "monthly")
    listed = standin.raw_countries(given)
    countries = stage(
        location.country_dim(listed, location.country_totals(monthly, listed)), work, "country"
    )
    years = stage(calendar.year_dim(monthly), work, "year")
    months = stage(calendar.month_dim(monthly, years), work, "month")
    gas = stage(gases.gas_dim(standin.raw_gases(given)), work, "gas")
    lookup = stage(calendar.time_lookup(months, years), work, "lookup")
    return emission_fact(cleaned, countries, gas, lookup)


def _refreshed(spark, folder) -> tuple[str, dict[str, DataFrame]]:
    """A database made by a refresh, and its tables."""
    given, work = Given(spark, folder), work_folder(spark)
    raw = standin.raw_fires(given), standin.raw_countries(given), standin.raw_gases(given)
    return _database(work), refresh(*raw, _database(work), work, location=f"{work}/warehouse")


def _measured(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows of each table and the sum of its measure."""
    parts = []
    for name, table in tables.items():
        measure = {"gas_emission": "quantity"}.get(name, "total_gas_emission")
        if measure in table.columns:
            total = total_by(table, value=measure, records="measured").select(_double("total"))
        else:
            total = None
        rows = table.agg(F.count("*").alias("records")).select(F.lit(name).alias("table_name"), "records")
        if total is None:
            parts.append(rows.withColumn("total", F.lit(None).cast("double")))
        else:
            parts.append(rows.withColumn("total", total.scalar()))
    return reduce(DataFrame.unionByName, parts)


@_key("job_full_refresh")
def job_full_refresh(spark, folder):
    return _measured(_refreshed(spark, folder)[1])


@_key("job_incremental_refresh")
def job_incremental_refresh(spark, folder):
    """The tables after a refresh from some files and one more after others were added."""
    given, work = Given(spark, folder), work_folder(spark)
    fires = standin.raw_fires(given)
    late = F.col("start_time") >= f"{YEAR}"
    write_csv(fires.where(~late), f"{work}/raw/fires")
    write_csv(standin.raw_countries(given), f"{work}/raw/countries")
    write_csv(standin.raw_gases(given), f"{work}/raw/gases")
    paths = [f"{work}/raw/{name}" for name in ("fires", "countries", "gases")]
    target = _database(work), f"{work}/steps", f"{work}/warehouse"
    refresh_from_files(spark, *paths, *target)
    fires.where(late).write.mode("append").csv(paths[0], header=True)
    return _measured(refresh_from_files(spark, *paths, *target))


# --- reports ---------------------------------------------------------------------------


_on_star("q01_top_month")(lambda star: reports.top_month(star, 1998))
_on_star("q02_literal")(reports.country_total_per_top_gas)
_on_star("q02_top2_cumulative")(reports.top_gases_running_total)
_on_star("q03_max_yoy_increase")(reports.largest_yearly_increase)
_on_star("q04_rank_change")(lambda star: reports.rank_change(star, "EUROPE"))
_on_star("q04_yoy_direction")(lambda star: reports.yearly_direction(star, "EUROPE"))
_on_star("q05_rank_asia")(lambda star: reports.ranked_countries(star, "ASIA", YEAR))
_on_star("q06_top3_by_gas_year")(reports.top_countries_by_gas)
_on_star("q07_above_global_avg")(lambda star: reports.above_global_mean(star, 1.1))
_on_star("q08_largest_record")(reports.largest_records)
_on_star("q09_moving_avg_records")(lambda star: reports.moving_mean_of_records(star, REGION, YEAR))
_on_star("q09_moving_avg_months")(lambda star: reports.moving_mean_of_months(star, REGION, YEAR))
_on_star("q10_continent_range")(reports.continent_ranges)
_on_star("q11_country_year_sum")(reports.country_year_totals)


@_key("wh_star_during")
def wh_star_during(spark, folder):
    """Largest and smallest record by country, in June of the years above the mean year."""
    star = _warehouse(spark, folder)
    typical = star.years.agg(F.avg("total_gas_emission")).scalar()
    rows = star.emissions_during(
        ["country_code", "quantity"], years=F.col("year_total") > typical, months=F.col("month") == 6
    ).where("country_code IS NOT NULL")
    found = rows.groupBy("country_code").agg(
        F.max("quantity").alias("largest"), F.min("quantity").alias("smallest"), F.count("*").alias("records")
    )
    return star.named(found, "country").select("country", "largest", "smallest", "records")


# --- chart datasets ----------------------------------------------------------------------


_on_star("chart_total")(charts.grand_total)
_on_star("chart_share")(lambda star: charts.shares(star, "gas"))
_on_star("chart_stacked")(lambda star: charts.stacked(star, "region", "gas"))
_on_star("chart_top_pairs")(lambda star: charts.top_pairs(star, "gas", "country"))
_on_star("chart_bar_pairs")(lambda star: charts.bar_pairs(star, "gas", "country"))


def registered() -> dict[str, Query]:
    return dict(_QUERIES)
