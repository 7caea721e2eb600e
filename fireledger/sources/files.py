"""Headed CSV files: one file or a directory of part files."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType


def _header(spark: SparkSession, path: str | list[str], options: dict) -> list[str]:
    return spark.read.options(**options).csv(path if isinstance(path, str) else path[0]).columns


def _in_order(header: list[str], schema: StructType, path: str | list[str]) -> StructType:
    """The types of ``schema`` in the order of a file's header."""
    types = {field.name: field.dataType for field in schema}
    missing = types.keys() - set(header)
    if missing:
        raise ValueError(f"{path} has no column {', '.join(sorted(missing))}")
    return StructType([StructField(name, types.get(name, StringType())) for name in header])


def read_csv(
    spark: SparkSession, path: str | list[str], schema: StructType, delimiter: str = ","
) -> DataFrame:
    """The columns of ``schema`` from a headed CSV, found by name.

    Types come from ``schema``, so there is no inference pass over the data; only
    the header is read first, to learn the order of the columns. Columns outside
    the schema are not parsed. A file whose header differs from that order raises,
    and an empty field or a value that does not parse becomes NULL.
    """
    options = {"header": True, "sep": delimiter}
    full = _in_order(_header(spark, path, options), schema, path)
    rows = spark.read.options(**options, enforceSchema=False, mode="PERMISSIVE")
    return rows.schema(full).csv(path).select([f"`{name}`" for name in schema.names])


def split_csv(
    spark: SparkSession, path: str | list[str], schema: StructType, folder: str, delimiter: str = ","
) -> tuple[DataFrame, DataFrame, dict[str, int]]:
    """The rows of a headed CSV whose fields all parse, the lines of the others, and their numbers.

    The files are read once: good rows and quarantined lines (``file, line``) are written
    below ``folder`` in one job, in a folder each, and counted on the way. A line is
    quarantined if it has too few or too many fields or a value that is not of its
    column's type. Empty lines are no lines.
    """
    options = {"header": True, "sep": delimiter}
    full = _in_order(_header(spark, path, options), schema, path).add("_line", StringType())
    reader = spark.read.options(**options, enforceSchema=False, mode="PERMISSIVE")
    # Without column pruning the parser counts the fields of each line.
    rows = reader.options(columnNameOfCorruptRecord="_line", columnPruning=False).schema(full).csv(path)
    bad = F.col("_line").isNotNull()
    counts = Observation()
    split = rows.select(
        *[F.when(~bad, F.col(f"`{name}`")).alias(name) for name in schema.names],
        F.when(bad, F.col("_metadata.file_path")).alias("_file"),
        "_line",
        bad.alias("_bad"),
    ).observe(counts, F.count_if(~bad).alias("good"), F.count_if(bad).alias("quarantined"))
    split.write.mode("overwrite").partitionBy("_bad").parquet(folder)
    whole = StructType([*schema.fields, StructField("_file", StringType()), StructField("_line", StringType())])
    # Spark's boolean partition column is read back as text by its folder's name.
    back = spark.read.schema(whole.add("_bad", StringType())).parquet(folder)
    good = back.where("_bad = 'false'").select([f"`{name}`" for name in schema.names])
    lines = back.where("_bad = 'true'").select(F.col("_file").alias("file"), F.col("_line").alias("line"))
    return good, lines, counts.get


def malformed_fields(
    spark: SparkSession, path: str, schema: StructType, delimiter: str = ","
) -> DataFrame:
    """``column_name, malformed``: fields that `read_csv` reads as NULL although they hold
    text, by column, and lines with too few or too many fields as ``(whole line)``."""
    options = {"header": True, "sep": delimiter}
    header = spark.read.options(**options).csv(path).columns
    full = StructType([*[StructField(name, StringType()) for name in header], StructField("_line", StringType())])
    # Without column pruning the parser counts the fields of each line.
    reader = spark.read.options(**options, columnNameOfCorruptRecord="_line", columnPruning=False)
    rows = reader.schema(full).csv(path)
    typed = [field for field in schema if field.dataType != StringType()]
    counts = [
        F.count_if(
            F.col("_line").isNull()
            & F.col(f"`{field.name}`").isNotNull()
            & F.col(f"`{field.name}`").try_cast(field.dataType).isNull()
        ).alias(field.name)
        for field in typed
    ]
    counted = rows.agg(*counts, F.count("_line").alias("(whole line)"))
    return counted.unpivot([], counted.columns, "column_name", "malformed")


def write_csv(
    df: DataFrame, path: str, files: int | None = None, order: Sequence[str | Column] = ()
) -> None:
    """Replace ``path`` with headed CSV part files.

    ``files`` bounds their number for exports of small results, as that many tasks
    write all rows. It shuffles the result rather than coalescing, which would run the
    whole last stage in that many tasks. With ``order`` each file holds a range of the rows
    in that order, sorted, and file names follow it: read one after the other, by name,
    the files are sorted as a whole. An order that ``df`` has by itself does not outlast
    ``files``.
    """
    if order:
        tasks = files or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        df = df.repartitionByRange(tasks, *order).sortWithinPartitions(*order)
    elif files is not None:
        df = df.repartition(files)
    df.write.mode("overwrite").csv(path, header=True)
