"""Column types of the raw files and of the seven warehouse tables, with their keys."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)


def _table(**columns) -> StructType:
    return StructType([StructField(name, kind()) for name, kind in columns.items()])


# The column names of the raw files and of the tables.
# Of the raw files only the columns the jobs use. Codes are text, so leading zeros stay.
RAW_FIRES = _table(
    iso3_country=StringType,
    original_inventory_sector=StringType,
    start_time=StringType,
    end_time=StringType,
    temporal_granularity=StringType,
    gas=StringType,
    emissions_quantity=DoubleType,
    emissions_factor=DoubleType,
    st_astext=StringType,
)
RAW_COUNTRIES = _table(
    **{
        "name": StringType,
        "alpha-2": StringType,
        "alpha-3": StringType,
        "country-code": StringType,
        "region": StringType,
        "sub-region": StringType,
        "region-code": StringType,
        "sub-region-code": StringType,
    }
)
RAW_GASES = _table(**{"name": StringType, "chemical-label": StringType})

CLEANED_FIRES = _table(
    alpha_3=StringType,
    cause=StringType,
    temporal_granularity=StringType,
    gas=StringType,
    emissions_quantity=DoubleType,
    emissions_factor=DoubleType,
    year=IntegerType,
    month=IntegerType,
    coordinates_1=StringType,
    coordinates_2=StringType,
    coordinates_3=StringType,
    coordinates_4=StringType,
    coordinates_5=StringType,
)

TABLES = {
    "continent": _table(code=StringType, name=StringType),
    "region": _table(
        code=StringType, name=StringType, total_gas_emission=DoubleType, continent_code=StringType
    ),
    "country": _table(
        code=StringType,
        name=StringType,
        alpha_3=StringType,
        total_gas_emission=DoubleType,
        region_code=StringType,
        alpha_2=StringType,
    ),
    "year": _table(id=LongType, value=IntegerType, total_gas_emission=DoubleType),
    "month": _table(id=LongType, name=StringType, num_value=IntegerType, year_id=LongType),
    "gas": _table(id=LongType, name=StringType, chemical_label=StringType),
    # `year` is an addition: the partition column that lets a report skip files.
    "gas_emission": _table(
        id=LongType,
        quantity=DoubleType,
        country_code=StringType,
        month_id=LongType,
        gas_id=LongType,
        year=IntegerType,
    ),
}

# What a refresh keeps to go on from: records counted by their values, the sums behind
# the totals, and the files that were read.
STATES = {
    "records": _table(
        alpha_3=StringType,
        gas=StringType,
        quantity=DoubleType,
        month=IntegerType,
        copies=LongType,
        year=IntegerType,
    ),
    "monthly": _table(
        alpha_3=StringType,
        year=IntegerType,
        month=IntegerType,
        high=LongType,
        middle=LongType,
        low=LongType,
        records=LongType,
    ),
    "source_files": _table(
        kind=StringType, path=StringType, length=LongType, modified=TimestampType, batch=LongType
    ),
}

# Stored sums of the fact by some of its keys, from which reports are answered.
_KEYS = {"country_code": StringType, "gas_id": LongType, "month_id": LongType}
_SUMS = {"high": LongType, "middle": LongType, "low": LongType, "records": LongType}
AGGREGATES = {
    "cube": ("country_code", "gas_id", "month_id", "year"),
    "by_country_gas_year": ("country_code", "gas_id", "year"),
    "by_country_year": ("country_code", "year"),
    "by_gas_year": ("gas_id", "year"),
    "by_month": ("month_id", "year"),
}
AGGREGATE_TABLES = {
    name: _table(**{key: _KEYS[key] for key in keys if key != "year"}, **_SUMS, year=IntegerType)
    for name, keys in AGGREGATES.items()
}

PARTITIONED_BY = {"gas_emission": ["year"], "records": ["year"], "cube": ["year"]}

PRIMARY_KEYS = {
    "continent": "code",
    "region": "code",
    "country": "code",
    "year": "id",
    "month": "id",
    "gas": "id",
    "gas_emission": "id",
}

# The longest texts that the tables take, in characters.
LENGTHS = {
    ("continent", "code"): 3,
    ("continent", "name"): 255,
    ("region", "code"): 3,
    ("region", "name"): 255,
    ("region", "continent_code"): 3,
    ("country", "code"): 5,
    ("country", "name"): 255,
    ("country", "alpha_3"): 3,
    ("country", "region_code"): 3,
    ("country", "alpha_2"): 2,
    ("month", "name"): 255,
    ("gas", "name"): 255,
    ("gas", "chemical_label"): 255,
    ("gas_emission", "country_code"): 5,
}

# (child table, column) -> (parent table, column)
FOREIGN_KEYS = {
    ("region", "continent_code"): ("continent", "code"),
    ("country", "region_code"): ("region", "code"),
    ("month", "year_id"): ("year", "id"),
    ("gas_emission", "country_code"): ("country", "code"),
    ("gas_emission", "month_id"): ("month", "id"),
    ("gas_emission", "gas_id"): ("gas", "id"),
}


def conform(df: DataFrame, schema: StructType) -> DataFrame:
    """The columns of ``schema``, in its order and types."""
    return df.select([F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in schema])


def ruled(df: DataFrame, table: str) -> DataFrame:
    """``df``, which fails when run at a row without its table's primary key or with a text that is too long.

    The error names the rule and, for a text, its length. The rules are tested in the pass
    that writes the rows.
    """
    key = PRIMARY_KEYS.get(table)
    checked = {}
    for field in df.schema:
        value, length = F.col(f"`{field.name}`"), LENGTHS.get((table, field.name))
        if length is not None:
            said = F.format_string(f"{table}.{field.name} holds more than {length} characters: %s", F.length(value))
            value = F.when(F.length(value) > length, F.raise_error(said)).otherwise(value)
        if field.name == key:
            value = F.when(value.isNull(), F.raise_error(F.lit(f"{table}.{field.name} is NULL"))).otherwise(value)
        checked[field.name] = value.cast(field.dataType).alias(field.name)
    return df.select(*checked.values())
