"""Command line for spark-submit: refresh the warehouse, or write a result as CSV.

The tables live in the session's catalog. To find them again in a later run, submit
with a lasting one (spark.sql.catalogImplementation=hive).

Parameters of a report or chart are given as name=value, for example
``report ranked_countries out continent=Asia year=2020`` or
``chart stacked out axis=region series=gas``.
"""

from __future__ import annotations

import argparse
from inspect import signature

from pyspark.sql import SparkSession

from fireledger.operators.audits import key_reports, quantity_report
from fireledger.plans.charts import CHARTS
from fireledger.plans.refresh import (
    export_cleaned,
    export_csv,
    read_aggregates,
    refresh_from_files,
    write_audits,
)
from fireledger.plans.reports import REPORTS
from fireledger.plans.star import TableStar
from fireledger.session import SETTINGS, shared_folder
from fireledger.sources import read_tables, write_csv

AUDITS = ("primary_key", "foreign_key", "not_null", "quantities")


def _arguments(argv: list[str] | None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="fireledger", description=__doc__)
    commands = parser.add_subparsers(dest="command", required=True)
    build = commands.add_parser("refresh", help="raw CSV files to warehouse tables")
    build.add_argument("fires")
    build.add_argument("countries")
    build.add_argument("gases")
    build.add_argument("--csv", help="also export the dimensions to this folder")
    build.add_argument("--cleaned-csv", help="also export the cleaned records to this folder")
    build.add_argument("--audits", help="also write the audits to this folder")
    build.add_argument("--quarantine", help="put lines that do not parse in this folder instead of emptying their fields")
    build.add_argument("--rules", action="store_true", help="stop at NULL primary keys and texts that are too long")
    build.add_argument("--work", help="shared folder for steps between; each refresh overwrites it")
    for name, choices in (("report", REPORTS), ("chart", CHARTS), ("audit", AUDITS)):
        command = commands.add_parser(name, help=f"one {name} to a CSV folder")
        command.add_argument("name", choices=sorted(choices))
        command.add_argument("output")
        if name != "audit":
            command.add_argument("parameters", nargs="*", metavar="name=value")
    for command in commands.choices.values():
        command.add_argument("--database", default="fireledger")
    return parser.parse_args(argv)


def _parameters(function, given: list[str]) -> dict[str, object]:
    """``name=value`` texts in the types of the function's annotations."""
    types = {"int": int, "int | None": int, "float": float, "str": str}
    known = {p.name: types[p.annotation] for p in list(signature(function).parameters.values())[1:]}
    values = {}
    for text in given:
        name, mark, value = text.partition("=")
        if not mark or name not in known:
            raise SystemExit(f"{text!r} is not name=value with a name of {', '.join(known) or 'none'}")
        values[name] = known[name](value)
    return values


def main(argv: list[str] | None = None) -> None:
    arguments = _arguments(argv)
    builder = SparkSession.builder.appName(f"fireledger {arguments.command}")
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    if arguments.command == "refresh":
        files = (arguments.fires, arguments.countries, arguments.gases)
        work = arguments.work or f"{shared_folder(spark)}/fireledger-{arguments.database}"
        options = {"quarantine": arguments.quarantine, "rules": arguments.rules}
        tables = refresh_from_files(spark, *files, arguments.database, work, **options)
        if arguments.csv:
            export_csv(tables, arguments.csv)
        if arguments.cleaned_csv:
            export_cleaned(spark, arguments.database, work, arguments.cleaned_csv)
        if arguments.audits:
            write_audits(tables, arguments.audits)
        return
    tables = read_tables(spark, arguments.database)
    if arguments.command == "audit":
        made = {**key_reports(tables), "quantities": quantity_report(tables["gas_emission"])}
        write_csv(made[arguments.name], arguments.output)
    else:
        function = (REPORTS if arguments.command == "report" else CHARTS)[arguments.name]
        write_csv(function(TableStar(tables, read_aggregates(spark, arguments.database)), **_parameters(function, arguments.parameters)), arguments.output)


if __name__ == "__main__":
    main()
