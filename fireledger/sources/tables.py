"""Warehouse tables in the session catalog."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from fireledger.schemas import TABLES
from fireledger.sources.versions import Draft, current_number, quoted, version_database


def create_tables(spark: SparkSession, database: str, location: str | None = None) -> None:
    """Create the seven typed tables, empty, if absent; ``location`` is for a new database."""
    if not current_number(spark, database):
        Draft(spark, database, location).publish()


def overwrite_tables(
    spark: SparkSession,
    database: str,
    rows: Mapping[str, DataFrame],
    location: str | None = None,
    rules: bool = False,
) -> dict[str, DataFrame]:
    """Replace the rows of some warehouse tables together, keep their declared types, read all back.

    Readers see all old tables until all new ones are written (see ``versions``). With
    ``rules`` a row without a primary key or with too long a text stops the write.
    """
    draft = Draft(spark, database, location, rules)
    for name, df in rows.items():
        draft.save(name, df)
    draft.publish()
    return read_tables(spark, database)


def overwrite_table(df: DataFrame, database: str, name: str) -> DataFrame:
    """`overwrite_tables` for one."""
    return overwrite_tables(df.sparkSession, database, {name: df})[name]


def read_tables(spark: SparkSession, database: str) -> dict[str, DataFrame]:
    """The seven tables by name, all of one version."""
    number = current_number(spark, database)
    inner = version_database(database, number) if number else database
    return {name: spark.table(quoted(inner, name)) for name in TABLES}
