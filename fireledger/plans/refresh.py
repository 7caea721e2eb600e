"""The whole run: raw files to seven tables, and what a new file changes in them."""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from functools import partial, reduce

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fireledger.functions.totals import merge_states, sum_states, totals_of
from fireledger.operators.audits import key_reports, quantity_report
from fireledger.plans.calendar import month_dim, time_lookup, year_dim
from fireledger.plans.cleaning import clean_fires
from fireledger.plans.fact import (
    cube_states,
    keyed_records,
    merge_counts,
    numbered_fact,
    record_counts,
    smaller_states,
)
from fireledger.plans.gases import gas_dim
from fireledger.plans.location import (
    continent_dim,
    country_dim,
    country_totals,
    region_dim,
    region_totals,
)
from fireledger.schemas import (
    AGGREGATES,
    CLEANED_FIRES,
    RAW_COUNTRIES,
    RAW_FIRES,
    RAW_GASES,
    STATES,
    TABLES,
)
from fireledger.session import stage
from fireledger.sources import read_csv, read_tables, split_csv, write_csv
from fireledger.sources.versions import Draft, current_number, version_database, version_table

_MONTHLY = ("alpha_3", "year", "month")


def refresh(
    fires: DataFrame,
    countries: DataFrame,
    gases: DataFrame,
    database: str,
    folder: str,
    location: str | None = None,
    rules: bool = False,
) -> dict[str, DataFrame]:
    """Clean the raw data and replace all tables of ``database``, together.

    ``location`` is where a new database goes, by default the session's warehouse. With
    ``rules``, a row without a primary key or with too long a text stops the refresh, and the
    tables stay as they were.

    The records are passed over twice: to clean them, and to count them by the values that
    the tables hold. Totals, fact and stored aggregates are made from these counts. Each step
    reads what the step before has written, below ``folder``, which all executors must
    share, or in the new version. The next refresh with the same folder overwrites these steps.
    """
    spark = fires.sparkSession
    draft = Draft(spark, database, location, rules)
    cleaned = _cleaned(fires, folder, draft.number)
    return _built(draft, record_counts(cleaned), countries, gases, folder, _no_files(spark))


def refresh_from_files(
    spark: SparkSession,
    fires_csv: str,
    countries_csv: str,
    gases_csv: str,
    database: str,
    folder: str,
    location: str | None = None,
    quarantine: str | None = None,
    rules: bool = False,
) -> dict[str, DataFrame]:
    """`refresh` from raw CSV files, of which only those are read that the tables lack.

    A version keeps a list of its files. If records were added as new files, only these are
    cleaned and counted, their counts and sums are merged into the stored ones, and only the
    years that they touch are made anew; the other years' files stay as they are. A changed
    list of countries or gases makes all tables anew from the stored counts. If a file of
    records was changed or removed, or the tables were written by other means, everything
    is read again. With nothing new the tables stay as they are.

    With ``quarantine``, a folder, lines that do not parse are put there and left out (see
    `split_csv`); else their fields are NULL.
    """
    listed = _listed(spark, {"fires": fires_csv, "countries": countries_csv, "gases": gases_csv})
    seen, number = _seen(spark, database), current_number(spark, database)
    new, gone = _apart(listed, seen)
    kinds = {r["kind"] for r in new} | {r["kind"] for r in gone}
    full = not number or not seen or any(r["kind"] == "fires" for r in gone)
    if not full and not kinds:
        return read_tables(spark, database)
    draft = Draft(spark, database, location, rules)
    fresh = [r["path"] for r in (listed if full else new) if r["kind"] == "fires"]
    if fresh:
        if quarantine:
            raw, _, _ = split_csv(spark, fresh, RAW_FIRES, f"{quarantine}/v{draft.number}")
        else:
            raw = read_csv(spark, fresh, RAW_FIRES)
        counts = record_counts(_cleaned(raw, folder, draft.number, full))
    else:
        counts = spark.createDataFrame([], STATES["records"])
    batches = {} if full else {(r["kind"], r["path"]): r["batch"] for r in seen}
    files = [
        (r["kind"], r["path"], r["length"], r["modified"], batches.get((r["kind"], r["path"]), draft.number))
        for r in listed
    ]
    return _built(
        draft,
        counts,
        read_csv(spark, countries_csv, RAW_COUNTRIES),
        read_csv(spark, gases_csv, RAW_GASES),
        folder,
        spark.createDataFrame(files, STATES["source_files"]),
        None if full else version_database(database, number),
        bool(kinds & {"countries", "gases"}),
    )


def _no_files(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], STATES["source_files"])


def _listed(spark: SparkSession, paths: dict[str, str]) -> list:
    """The files below some paths: one line a file, as Spark's own file index holds them; no file is opened."""
    parts = [
        spark.read.format("binaryFile")
        .load(path)
        .select(F.lit(kind).alias("kind"), "path", "length", F.col("modificationTime").alias("modified"))
        for kind, path in paths.items()
    ]
    return reduce(DataFrame.unionByName, parts).where("length > 0").collect()


def _seen(spark: SparkSession, database: str) -> list:
    """The files of the current version, none if it has no list of them."""
    number = current_number(spark, database)
    if not number or not spark.catalog.tableExists(f"`{version_database(database, number)}`.`source_files`"):
        return []
    return version_table(spark, database, "source_files").collect()


def _apart(listed: list, seen: list) -> tuple[list, list]:
    """The files that are new or changed, and those that were there otherwise or are gone."""

    def marks(rows: list) -> dict:
        return {(r["kind"], r["path"], r["length"], r["modified"]): r for r in rows}

    now, before = marks(listed), marks(seen)
    return [now[m] for m in now.keys() - before.keys()], [before[m] for m in before.keys() - now.keys()]


def _cleaned(raw: DataFrame, folder: str, batch: int, whole: bool = True) -> DataFrame:
    """The cleaned records, stored as a batch; with ``whole`` the only one."""
    cleaned = clean_fires(raw)
    if whole:
        return stage(cleaned.withColumn("batch", F.lit(batch)), folder, "cleaned", ["batch"]).drop("batch")
    path = f"{folder}/cleaned/batch={batch}"
    cleaned.write.mode("overwrite").parquet(path)
    return raw.sparkSession.read.schema(cleaned.schema).parquet(path)


def _in_years(years: set) -> Column:
    """Whether the year is among ``years``, of which None may be one."""
    known = F.coalesce(F.col("year").isin(sorted(y for y in years if y is not None)), F.lit(False))
    return known | F.col("year").isNull() if None in years else known


def _together(spark: SparkSession, *tasks: Callable) -> list:
    """The results of some tasks whose jobs Spark runs side by side; the first error, if any."""
    with ThreadPoolExecutor(len(tasks)) as pool:
        started = [pool.submit(inheritable_thread_target(spark)(task)) for task in tasks]
    return [task.result() for task in started]


def _built(
    draft: Draft,
    counts: DataFrame,
    countries: DataFrame,
    gases: DataFrame,
    folder: str,
    files: DataFrame,
    before: str | None = None,
    rekeyed: bool = False,
) -> dict[str, DataFrame]:
    """All tables of a version from its records' ``counts``; with ``before``, the database of an
    earlier version, from those of the records added since. ``rekeyed``: keys of the
    dimensions may have changed, so all years' facts are made anew."""
    spark = draft.spark
    touched = None
    if before is not None:
        counts = stage(counts, folder, "added")
        # As many rows as there are years.
        touched = {r["year"] for r in counts.select("year").distinct().collect()}
        old = spark.table(f"`{before}`.`records`").where(_in_years(touched))
        added = sum_states(counts, *_MONTHLY, value="quantity", copies="copies")
        sums = merge_states(spark.table(f"`{before}`.`monthly`").unionByName(added), *_MONTHLY)
        records = draft.save("records", merge_counts(old, counts), touched)
    else:
        records = draft.save("records", counts)
        sums = sum_states(records, *_MONTHLY, value="quantity", copies="copies")
    monthly = totals_of(draft.save("monthly", sums), *_MONTHLY, out="emissions_quantity")
    monthly = stage(monthly, folder, "monthly")
    listed = stage(countries, folder, "countries")

    def dated() -> DataFrame:
        year = draft.save("year", year_dim(monthly))
        month = draft.save("month", month_dim(monthly, year))
        return stage(time_lookup(month, year), folder, "lookup")

    country, gas, lookup, *_ = _together(
        spark,
        lambda: draft.save("country", country_dim(listed, country_totals(monthly, listed))),
        lambda: draft.save("gas", gas_dim(gases)),
        dated,
        lambda: draft.save("region", region_dim(listed, region_totals(monthly, listed))),
        lambda: draft.save("continent", continent_dim(listed)),
        lambda: draft.save("source_files", files),
    )
    if rekeyed:
        touched = None
    rows = records if touched is None else records.where(_in_years(touched))

    def aggregated() -> None:
        cube = draft.save("cube", cube_states(keyed_records(rows, country, gas, lookup)), touched)
        _together(spark, *[partial(draft.save, name, states) for name, states in smaller_states(cube).items()])

    _together(
        spark,
        lambda: draft.save("gas_emission", numbered_fact(rows, country, gas, lookup), touched, dealt=True),
        aggregated,
    )
    draft.publish()
    return {name: draft.table(name) for name in TABLES}


def read_aggregates(spark: SparkSession, database: str) -> dict[str, DataFrame]:
    """The stored aggregates of the current version, none if it was not made by a refresh."""
    number = current_number(spark, database)
    inner = version_database(database, number)
    names = [n for n in AGGREGATES if number and spark.catalog.tableExists(f"`{inner}`.`{n}`")]
    return {name: spark.table(f"`{inner}`.`{name}`") for name in names}


def write_audits(tables: dict[str, DataFrame], folder: str) -> None:
    """The key rules and the quantities that sums cannot take, as headed CSV directories."""
    reports = {**key_reports(tables), "quantities": quantity_report(tables["gas_emission"])}
    for name, report in reports.items():
        write_csv(report, f"{folder}/{name}")


def export_cleaned(spark: SparkSession, database: str, folder: str, path: str) -> None:
    """The cleaned records that refreshes left below ``folder``, as headed CSV part files."""
    files = version_table(spark, database, "source_files").where("kind = 'fires'")
    batches = [r["batch"] for r in files.select("batch").distinct().collect()]
    parts = [f"{folder}/cleaned/batch={batch}" for batch in sorted(batches)]
    write_csv(spark.read.schema(CLEANED_FIRES).parquet(*(parts or [f"{folder}/cleaned"])), path)


def export_csv(tables: dict[str, DataFrame], folder: str) -> None:
    """Each dimension as one headed CSV file in a directory of its name."""
    for name, table in tables.items():
        if name != "gas_emission":
            write_csv(table, f"{folder}/{name}", files=1)
