"""Sums that do not depend on the order of the rows.

A sum of doubles changes with the order in which partial sums meet, so two runs
(or a retried task) can differ in the last digits and a rank can flip. Quantities
have three decimals, so they are summed as whole thousandths. One long sum could
overflow at warehouse scale and a decimal buffer is about five times slower than a
long one, so each value is cut into two low parts of 18 bits and the rest, which
carries the sign: three long sums, put together as a decimal once per group. Each
is exact up to 3e13 records a group, for any quantity a double holds exactly.

A quantity with more than three decimals would lose the rest, and one that is not
finite raises. The cleaning job makes neither; for a fact made elsewhere,
`audits.quantity_report` counts both.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

TOTAL = DecimalType(38, 3)
_BITS = 18
_MASK = 2**_BITS - 1


def thousandths(value: Column) -> Column:
    """A quantity of at most three decimals as a whole number; raises beyond 9e15."""
    return F.rint(value * 1000).cast("long")


def _joined_parts(high: Column, middle: Column, low: Column) -> Column:
    def times(part: Column, power: int) -> Column:
        return part.cast("decimal(20,0)") * F.lit(2**power).cast("decimal(11,0)")

    whole = times(high, 2 * _BITS) + times(middle, _BITS) + low.cast("decimal(20,0)")
    return (whole.cast("decimal(34,0)") * F.lit("0.001").cast("decimal(3,3)")).cast(TOTAL)


def sum_states(df: DataFrame, *keys: str, value: str, copies: str | None = None) -> DataFrame:
    """``keys`` with the three sums of a double column and the count of its values.

    States of parts of the data merge to the state of all. ``copies`` names a column that
    says how many records a row stands for.
    """
    whole, times = thousandths(F.col(value)), F.lit(1) if copies is None else F.col(copies)

    def summed(part: Column) -> Column:
        return F.sum(part if copies is None else part * times)

    return df.groupBy(*[F.col(f"`{key}`") for key in keys]).agg(
        summed(F.shiftright(whole, 2 * _BITS)).alias("high"),
        summed(F.shiftright(whole, _BITS).bitwiseAND(F.lit(_MASK))).alias("middle"),
        summed(whole.bitwiseAND(F.lit(_MASK))).alias("low"),
        F.coalesce(F.sum(F.when(whole.isNotNull(), times)), F.lit(0)).cast("long").alias("records"),
    )


def merge_states(states: DataFrame, *keys: str) -> DataFrame:
    """The states of ``keys``, from states by these and other keys."""
    merged = [F.sum(part).alias(part) for part in ("high", "middle", "low")]
    records = F.coalesce(F.sum("records"), F.lit(0)).alias("records")
    return states.groupBy(*[F.col(f"`{key}`") for key in keys]).agg(*merged, records)


def totals_of(states: DataFrame, *keys: str, out: str = "total", records: str | None = None) -> DataFrame:
    """``keys`` with the sum as decimal(38,3), NULL where nothing was counted."""
    counted = [F.col("records").alias(records)] if records else []
    total = _joined_parts(F.col("high"), F.col("middle"), F.col("low"))
    return states.select(*[F.col(f"`{key}`") for key in keys], *counted, total.alias(out))


def total_by(
    df: DataFrame, *keys: str, value: str, out: str = "total", records: str | None = None
) -> DataFrame:
    """``keys`` with the exact sum of ``value`` as decimal(38,3).

    ``value`` is a double column of records or a decimal column of earlier totals.
    ``records`` names a count of the non-NULL values.
    """
    if not isinstance(df.schema[value].dataType, DecimalType):
        return totals_of(sum_states(df, *keys, value=value), *keys, out=out, records=records)
    column = F.col(value)
    counted = [F.count(column).alias(records)] if records else []
    kept = [F.col(f"`{key}`") for key in keys] + ([F.col(records)] if records else [])
    summed = df.groupBy(*kept[: len(keys)]).agg(F.sum(column).cast(TOTAL).alias(out), *counted)
    return summed.select(*kept, out)


def mean(total: Column, records: Column) -> Column:
    """Mean as double; NULL when nothing was counted."""
    return F.try_divide(total.cast("double"), records)
