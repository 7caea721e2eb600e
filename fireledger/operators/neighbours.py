"""Centred moving mean over groups of any size."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fireledger.functions.totals import thousandths
from fireledger.operators.ranking import magnitude

# Rows that one task makes of one line before the line is dealt out further.
_SLICE = 4096


def _mean(*frame: Column) -> Column:
    values = F.array_compact(F.array(*frame))
    total = F.aggregate(values, F.lit(0).cast("long"), lambda acc, x: acc + x)
    return F.try_divide(total.cast("double") / 1000, F.size(values))


def centred_mean(
    df: DataFrame, groups: Sequence[str], period: str, value: str, out: str
) -> DataFrame:
    """``groups``, ``period`` and for each row the mean of its value with those of the
    row before and the row after it in its group.

    Rows are ordered by ``period``, then by value, NULL first. Rows of equal values are
    interchangeable, so the result depends on nothing else. Equal rows are counted
    before the shuffle and told apart only at the end: the first and last of them have
    other neighbours, those between have equal ones. The distinct values of a group are
    cut into pieces by value range, which follow the order and are sorted in separate
    tasks; only the ends of each piece meet in one window per group. Rows with a NULL in
    ``groups`` or ``period`` are left out, NULL values only of the mean.
    """
    piece = [*groups, period, "_piece"]
    runs = (
        df.where(reduce(and_, [F.col(name).isNotNull() for name in (*groups, period)]))
        .groupBy(*groups, period, thousandths(F.col(value)).alias("_whole"))
        .agg(F.count("*").alias("_rows"))
        .withColumn("_piece", magnitude(F.col("_whole")))
    )
    along = Window.partitionBy(*groups).orderBy(period, "_piece")
    # With the count in it, this use of the runs has the columns of the other, and Spark
    # makes them once.
    present = F.when(F.col("_rows") > 0, F.col("_whole"))
    ends = (
        runs.groupBy(*piece)
        .agg(F.min(present).alias("_head"), F.max(present).alias("_tail"))
        .select(
            *piece,
            F.lag("_tail").over(along).alias("_tail_before"),
            F.lead("_head").over(along).alias("_head_after"),
        )
    )
    inside = Window.partitionBy(*piece).orderBy(F.col("_whole").asc_nulls_first())
    linked = runs.withColumn("_lag", F.lag("_whole").over(inside)).withColumn(
        "_lead", F.lead("_whole").over(inside)
    )
    own = F.col("_whole")
    before, after = F.coalesce("_lag", "_tail_before"), F.coalesce("_lead", "_head_after")

    def line(mean: Column, rows: Column) -> Column:
        return F.struct(mean.alias("mean"), rows.cast("long").alias("rows"))

    several = F.array(
        line(_mean(before, own, own), F.lit(1)),
        line(_mean(own, own, own), F.col("_rows") - 2),
        line(_mean(own, own, after), F.lit(1)),
    )
    lines = F.when(F.col("_rows") == 1, F.array(line(_mean(before, own, after), F.lit(1)))).otherwise(several)
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return (
        linked.join(ends, piece)
        .select(*groups, period, F.inline(F.filter(lines, lambda x: x["rows"] > 0)))
        .select("*", F.explode(F.sequence(F.lit(0), F.floor((F.col("rows") - 1) / _SLICE))).alias("_slice"))
        .repartition(tasks, *groups, period, "mean", "_slice")
        .withColumn("_left", F.least(F.lit(_SLICE), F.col("rows") - F.col("_slice") * _SLICE))
        .select(*groups, period, F.col("mean").alias(out), F.explode(F.sequence(F.lit(1), F.col("_left").cast("int"))))
        .select(*groups, period, out)
    )
