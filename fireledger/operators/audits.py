"""Key rules as reports: every row of a result is a breach."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType

from fireledger.schemas import FOREIGN_KEYS, PRIMARY_KEYS


def duplicate_keys(df: DataFrame, key: str) -> DataFrame:
    """Key values held by more than one row: ``key_value, records``.

    Whole numbers are first set as bits in bitmaps of 32768 numbers each, made before the
    shuffle: a number costs a bit there, where numbers lie close together, as ids do. Only
    rows of bitmaps with fewer bits than rows are grouped by key; text keys are grouped as
    they are.
    """
    rows = df.select(F.col(key).alias("_key"))
    if isinstance(df.schema[key].dataType, (IntegerType, LongType)):
        number = F.col("_key").cast("long")
        bits = F.bitmap_count(F.bitmap_construct_agg(F.bitmap_bit_position(number)))
        crowded = (
            rows.groupBy(F.bitmap_bucket_number(number).alias("_bitmap"))
            .agg(F.count("*").alias("_rows"), bits.alias("_bits"))
            .where("_rows > _bits OR _bitmap IS NULL")
            .select("_bitmap")
        )
        rows = rows.join(crowded, F.bitmap_bucket_number(number).eqNullSafe(F.col("_bitmap")), "left_semi")
    return (
        rows.groupBy("_key")
        .agg(F.count("*").alias("records"))
        .where("records > 1")
        .select(F.col("_key").cast("string").alias("key_value"), "records")
    )


def orphan_keys(child: DataFrame, column: str, parent: DataFrame, key: str) -> DataFrame:
    """Foreign key values without a parent row: ``key_value, records``.

    Records with a NULL key are one line with a NULL ``key_value``. The child is
    counted by key first, so what is joined is one row per key, not per record.
    """
    return (
        child.groupBy(F.col(column).alias("_key"))
        .agg(F.count("*").alias("records"))
        .join(parent.select(F.col(key).alias("_parent")), F.col("_key") == F.col("_parent"), "left_anti")
        .select(F.col("_key").cast("string").alias("key_value"), "records")
    )


def null_counts(df: DataFrame, *columns: str) -> DataFrame:
    """NULLs per column in one pass: ``column_name, nulls``."""
    counted = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return counted.unpivot([], list(columns), "column_name", "nulls")


def quantity_report(fact: DataFrame, value: str = "quantity") -> DataFrame:
    """Records that exact sums cannot take as they are: ``not_finite, finer`` (than thousandths)."""
    number = F.col(value)
    finite = F.abs(number) < F.lit(float("inf"))
    rounded = F.abs(number * 1000 - F.rint(number * 1000))
    finer = finite & (rounded > F.greatest(F.abs(number * 1000) * 1e-15, F.lit(1e-6)))
    return fact.agg(
        F.count_if(number.isNotNull() & ~finite).alias("not_finite"), F.count_if(finer).alias("finer")
    )


def _labelled(parts: list[tuple[str, DataFrame]]) -> DataFrame:
    labelled = [df.select(F.lit(name).alias("rule"), "key_value", "records") for name, df in parts]
    return reduce(DataFrame.unionByName, labelled)


def primary_key_report(tables: dict[str, DataFrame]) -> DataFrame:
    """All duplicate primary keys: ``rule, key_value, records``."""
    return _labelled(
        [(f"{t}.{key}", duplicate_keys(tables[t], key)) for t, key in PRIMARY_KEYS.items()]
    )


def foreign_key_report(tables: dict[str, DataFrame]) -> DataFrame:
    """All foreign keys that are NULL or have no parent: ``rule, key_value, records``."""
    return _labelled(
        [
            (f"{t}.{column}", orphan_keys(tables[t], column, tables[parent], key))
            for (t, column), (parent, key) in FOREIGN_KEYS.items()
        ]
    )


def not_null_report(tables: dict[str, DataFrame]) -> DataFrame:
    """NULLs in each primary key column: ``rule, nulls``."""
    parts = [
        null_counts(tables[t], key).select(F.lit(f"{t}.{key}").alias("rule"), "nulls")
        for t, key in PRIMARY_KEYS.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def key_reports(tables: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """The three key rules by name."""
    return {
        "primary_key": primary_key_report(tables),
        "foreign_key": foreign_key_report(tables),
        "not_null": not_null_report(tables),
    }
