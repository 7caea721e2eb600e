"""Gas dimension."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def gas_key(label: Column) -> Column:
    """A number made from the label, so that a new gas leaves the keys of others as they are."""
    return F.conv(F.substring(F.md5(F.coalesce(label, F.lit(""))), 1, 15), 16, 10).cast("long")


def gas_dim(gases: DataFrame) -> DataFrame:
    """``id, name, chemical_label``; a label listed twice breaks the key and shows in the audit."""
    label = F.col("`chemical-label`")
    return gases.select(gas_key(label).alias("id"), "name", label.alias("chemical_label"))
