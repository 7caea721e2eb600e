"""Versions of a warehouse: all of its tables are replaced together, by one change in the catalog.

A property of the database ``emissions`` names its current version, a database
``emissions__v3`` whose tables lie in the folder ``v3`` of ``emissions``. A write makes a new
version beside it, and when all tables are whole the property is set: one change, before
which readers see the old tables, and after it the new ones. What a stopped write leaves is
cleared by the next one. One write at a time: a second one fails on creating its version.

A table or partition that a write leaves as it is is not written again: the new version
names the folder where it lies. ``_folders`` in a version's folder says where that is, for
one row a table or partition. Views in ``emissions`` show the current version to SQL; each is
replaced after the property, from one whole table to another.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from fireledger.schemas import AGGREGATE_TABLES, PARTITIONED_BY, STATES, TABLES, conform, ruled

PROPERTY = "fireledger.version"
ALL_TABLES = {**TABLES, **AGGREGATE_TABLES, **STATES}
#: Versions that stay whole beside the current one, for readers who hold their tables.
KEPT = 1

_NO_VALUE = "__HIVE_DEFAULT_PARTITION__"


def quoted(*names: str) -> str:
    return ".".join("`" + name.replace("`", "``") + "`" for name in names)


def _text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _described(spark: SparkSession, database: str) -> dict[str, str]:
    return {r[0]: r[1] for r in spark.sql(f"DESCRIBE DATABASE EXTENDED {quoted(database)}").collect()}


def _databases(spark: SparkSession) -> list[str]:
    return [r[0].lower() for r in spark.sql("SHOW DATABASES").collect()]


def current_number(spark: SparkSession, database: str) -> int:
    """The number of the current version, 0 before the first."""
    if database.lower() not in _databases(spark):
        return 0
    found = re.search(re.escape(PROPERTY) + r",\s*(\d+)", _described(spark, database).get("Properties", ""))
    return int(found.group(1)) if found else 0


def version_database(database: str, number: int) -> str:
    return f"{database}__v{number}"


def version_table(spark: SparkSession, database: str, name: str) -> DataFrame:
    """A table of the current version; it stays what it is when a newer version comes."""
    number = current_number(spark, database)
    return spark.table(quoted(version_database(database, number), name))


def _files(spark: SparkSession, folder: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()), path


def _children(spark: SparkSession, folder: str) -> list[str]:
    """Names of the folders in a folder."""
    files, path = _files(spark, folder)
    if not files.exists(path):
        return []
    return sorted(s.getPath().getName() for s in files.listStatus(path) if s.isDirectory())


def _delete(spark: SparkSession, folder: str) -> None:
    files, path = _files(spark, folder)
    files.delete(path, True)


class Draft:
    """A version that is being written. ``save`` its new tables, then ``publish``.

    With ``rules``, rows that break a table's rules (see `schemas.ruled`) stop the write.
    """

    def __init__(self, spark: SparkSession, database: str, location: str | None = None, rules: bool = False) -> None:
        self.spark, self.database, self.rules = spark, database, rules
        where = f" LOCATION {_text(location)}" if location else ""
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {quoted(database)}{where}")
        self.base = _described(spark, database)["Location"].rstrip("/")
        self.before = current_number(spark, database)
        numbers = self._numbers()
        for number in numbers:
            if number > self.before:
                spark.sql(f"DROP DATABASE {quoted(version_database(database, number))} CASCADE")
                _delete(spark, f"{self.base}/v{number}")
        self.number = max([self.before, *numbers]) + 1
        self.name = version_database(database, self.number)
        self.folder = f"{self.base}/v{self.number}"
        # Dropping a database deletes its own folder, so the data are elsewhere.
        spark.sql(f"CREATE DATABASE {quoted(self.name)} LOCATION {_text(f'{self.base}/_versions/v{self.number}')}")
        #: Table -> partition (empty for a table without) -> folder.
        self.folders: dict[str, dict[str, str]] = {}
        self.old = self._folders_of(self.before) if self.before else {}

    def _numbers(self) -> list[int]:
        found = (re.fullmatch(re.escape(self.database.lower()) + r"__v(\d+)", name) for name in _databases(self.spark))
        return [int(m.group(1)) for m in found if m]

    def _folders_of(self, number: int) -> dict[str, dict[str, str]]:
        found: dict[str, dict[str, str]] = {}
        for r in self.spark.read.parquet(f"{self.base}/v{number}/_folders").collect():
            found.setdefault(r["table"], {})
            if r["folder"]:
                found[r["table"]][r["part"]] = r["folder"]
        return found

    def _create(self, name: str) -> None:
        columns = ", ".join(f"{quoted(f.name)} {f.dataType.simpleString()}" for f in ALL_TABLES[name])
        keys = PARTITIONED_BY.get(name, [])
        partitioned = f" PARTITIONED BY ({', '.join(map(quoted, keys))})" if keys else ""
        folders = self.folders[name]
        place = f"{self.folder}/{name}" if keys else folders[""]
        table = quoted(self.name, name)
        self.spark.sql(f"CREATE TABLE {table} ({columns}) USING parquet{partitioned} LOCATION {_text(place)}")
        if keys and folders:
            parts = []
            for part, folder in folders.items():
                key, value = part.split("=", 1)
                value = "NULL" if value == _NO_VALUE else value
                parts.append(f"PARTITION ({quoted(key)} = {value}) LOCATION {_text(folder)}")
            self.spark.sql(f"ALTER TABLE {table} ADD {' '.join(parts)}")

    def save(self, name: str, df: DataFrame, touched: set | None = None, dealt: bool = False) -> DataFrame:
        """Write a table of this version and read it back.

        With ``touched``, values of the partition column, the other partitions stay
        where the version before has them, and ``df`` has the rows of the touched ones.
        Rows for a partitioned table are rebalanced by its partition column, unless they are
        ``dealt`` already, so that a task writes few partitions and a year with most of the
        rows is split over many files of the advisory size.
        """
        keys, folder = PARTITIONED_BY.get(name, []), f"{self.folder}/{name}"
        rows = conform(df, ALL_TABLES[name])
        if self.rules:
            rows = ruled(rows, name)
        if keys and not dealt:
            rows = rows.hint("rebalance", *keys)
        rows.write.partitionBy(*keys).parquet(folder)
        if keys:
            made = {part: f"{folder}/{part}" for part in _children(self.spark, folder) if "=" in part}
            if touched is not None:
                gone = {f"{keys[0]}={_NO_VALUE if value is None else value}" for value in touched}
                made = {**{p: f for p, f in self.old.get(name, {}).items() if p not in gone}, **made}
            self.folders[name] = made
        else:
            self.folders[name] = {"": folder}
        self._create(name)
        return self.table(name)

    def keep(self, name: str) -> DataFrame:
        """A table as it is in the version before, empty if that has none."""
        if name in self.old:
            self.folders[name] = self.old[name]
            self._create(name)
            return self.table(name)
        return self.save(name, self.spark.createDataFrame([], ALL_TABLES[name]))

    def table(self, name: str) -> DataFrame:
        return self.spark.table(quoted(self.name, name))

    def publish(self) -> None:
        """Make this the current version.

        Of the seven tables those that were not saved stay as they were; aggregates and states
        that were not saved or kept are not in it.
        """
        for name in TABLES:
            if name not in self.folders:
                self.keep(name)
        rows = [
            (name, part, folder) for name, parts in self.folders.items() for part, folder in (parts or {"": ""}).items()
        ]
        told = self.spark.createDataFrame(rows, "`table` string, part string, folder string")
        told.coalesce(1).write.parquet(f"{self.folder}/_folders")
        self.spark.sql(f"ALTER DATABASE {quoted(self.database)} SET DBPROPERTIES ({_text(PROPERTY)} = '{self.number}')")
        show_current(self.spark, self.database)
        self._drop_old()

    def _drop_old(self) -> None:
        """Drop versions that are no longer kept, with the folders that only they use."""
        numbers = sorted(self._numbers())
        kept = numbers[-1 - KEPT :]
        used = {f for n in kept for parts in self._folders_of(n).values() for f in parts.values()}
        for number in numbers[: len(numbers) - len(kept)]:
            self.spark.sql(f"DROP DATABASE {quoted(version_database(self.database, number))} CASCADE")
        for name in _children(self.spark, self.base):
            if not re.fullmatch(r"v\d+", name) or int(name[1:]) in kept:
                continue
            # A version without a database, whose folders later versions may still use.
            for table in _children(self.spark, f"{self.base}/{name}"):
                folder = f"{self.base}/{name}/{table}"
                for part in _children(self.spark, folder):
                    if f"{folder}/{part}" not in used:
                        _delete(self.spark, f"{folder}/{part}")
                if folder not in used and not _children(self.spark, folder):
                    _delete(self.spark, folder)
            if not _children(self.spark, f"{self.base}/{name}"):
                _delete(self.spark, f"{self.base}/{name}")


def show_current(spark: SparkSession, database: str) -> None:
    """Point the views of the table names at the current version."""
    inner = version_database(database, current_number(spark, database))
    for name in TABLES:
        view, shown = quoted(database, name), quoted(inner, name)
        if spark.catalog.tableExists(view) and spark.catalog.getTable(view).tableType != "VIEW":
            spark.sql(f"DROP TABLE {view}")
        spark.sql(f"CREATE OR REPLACE VIEW {view} AS SELECT * FROM {shown}")
