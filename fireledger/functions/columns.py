"""Column expressions of the cleaning and time jobs."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The formats of the raw records and the country code that is folded
# into another.
TIME_FORMAT = "yyyy-MM-dd HH:mm:ss"
RING_PATTERN = r"POLYGON\(\(([-\d.]+ [-\d.]+,[-\d.]+ [-\d.]+,[-\d.]+ [-\d.]+,[-\d.]+ [-\d.]+,[-\d.]+ [-\d.]+)\)\)"
RING_POINTS = 5
FOLDED_CODES = {"XKX": "SRB"}


def rounded_quantity(quantity: Column) -> Column:
    """Three decimals, half up."""
    return F.round(quantity, 3)


def parsed_time(text: Column) -> Column:
    """The timestamp, or NULL for text in another format."""
    return F.try_to_timestamp(text, F.lit(TIME_FORMAT))


def month_name(number: Column) -> Column:
    """English month name of 1..12."""
    return F.date_format(F.make_date(F.lit(2000), number, F.lit(1)), "MMMM")


def ring_text(polygon: Column) -> Column:
    """The points of a five-point ring, '' for any other shape."""
    return F.regexp_extract(polygon, RING_PATTERN, 1)


def ring_points(ring: Column) -> list[Column]:
    """``coordinates_1`` .. ``coordinates_5``; NULL past the last point."""
    points = F.split(ring, ",")
    return [F.get(points, F.lit(i)).alias(f"coordinates_{i + 1}") for i in range(RING_POINTS)]


def folded_code(code: Column) -> Column:
    """Country code with the folded codes replaced."""
    for old, new in FOLDED_CODES.items():
        code = F.replace(code, F.lit(old), F.lit(new))
    return code
