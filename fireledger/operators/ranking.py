"""Ranks, within many small groups or within a single large one."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Buckets per doubling of the ranked value in `rank_large`.
_STEPS = 1024


def top_ranked(
    df: DataFrame, groups: Sequence[str], value: str, k: int, rank: str = "emission_rank"
) -> DataFrame:
    """Rows whose RANK by ``value``, largest first, is at most ``k``; ties stay.

    The filter directly on the rank lets Spark drop lower rows of a group before
    the shuffle (WindowGroupLimit), so a group with most of the rows is no hot spot.
    """
    order = Window.partitionBy(*groups).orderBy(F.col(value).desc_nulls_last())
    return df.withColumn(rank, F.rank().over(order)).where(F.col(rank) <= k)


def magnitude(value: Column) -> Column:
    """A whole number that never falls as ``value`` rises; lowest for NULL."""
    number = value.cast("double")
    size = F.floor(F.log2(F.abs(number) + 1) * _STEPS)
    return F.coalesce(F.when(number < 0, -size).otherwise(size), F.lit(-(2**31)))


def rank_large(df: DataFrame, groups: Sequence[str], value: str, rank: str) -> DataFrame:
    """RANK by ``value``, largest first, for groups of any size.

    A plain window sorts a whole group in one task. Here equal values are counted first, so
    a value with most of the rows is one row; values are ranked within narrow buckets, and
    each bucket adds the number of rows in the buckets above it. The only window over a
    whole group runs on bucket counts, of which a double range allows about 65 thousand.
    The rows meet their value's rank in a join, where AQE splits a hot value.
    """
    values = (
        df.groupBy(*groups, value)
        .agg(F.count("*").alias("_rows"))
        .withColumn("_bucket", magnitude(F.col(value)))
    )
    bucket = [*groups, "_bucket"]
    higher = (
        Window.partitionBy(*groups)
        .orderBy(F.col("_bucket").desc())
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    above = (
        values.groupBy(*bucket)
        .agg(F.sum("_rows").alias("_size"))
        .select(*bucket, F.coalesce(F.sum("_size").over(higher), F.lit(0)).alias("_above"))
    )
    inside = (
        Window.partitionBy(*bucket)
        .orderBy(F.col(value).desc_nulls_last())
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    ranked = (
        values.withColumn("_inside", F.coalesce(F.sum("_rows").over(inside), F.lit(0)))
        .join(above, bucket)
        .select(
            *[F.col(g).alias(f"_{g}") for g in groups],
            F.col(value).alias("_value"),
            (F.col("_above") + F.col("_inside") + 1).cast("int").alias(rank),
        )
    )
    same = [F.col(g) == F.col(f"_{g}") for g in groups]
    return df.join(ranked, [*same, F.col(value).eqNullSafe(F.col("_value"))]).select(*df.columns, rank)


def number_large(
    df: DataFrame, groups: Sequence[str], value: str, number: str, ties: Sequence[str]
) -> DataFrame:
    """ROW_NUMBER by ``value``, largest first, then ``ties``, for groups of any size.

    Rows are dealt to tasks by ranges of group, value, ties and, for rows that agree in all
    of these, their place in ``df``. Each task numbers its rows, after the rows of the
    group in the tasks before it. So many equal values, or rows alike, are many tasks'.
    """
    order = [F.col(value).desc_nulls_last(), *[F.col(t) for t in ties]]
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = (
        df.withColumn("_place", F.monotonically_increasing_id())
        .repartitionByRange(tasks, *[F.col(g) for g in groups], *order, "_place")
        .withColumn("_task", F.spark_partition_id())
    )
    task = [*groups, "_task"]
    earlier = Window.partitionBy(*groups).orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    before = (
        dealt.groupBy(*task)
        .agg(F.count("*").alias("_rows"))
        .select(*task, F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_before"))
    )
    inside = F.row_number().over(Window.partitionBy(*task).orderBy(*order))
    return (
        dealt.withColumn("_inside", inside)
        .join(before, task)
        .withColumn(number, (F.col("_before") + F.col("_inside")).cast("int"))
        .select(*df.columns, number)
    )
