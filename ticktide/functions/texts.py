"""Text rendering of typed values, for keyed cells whose values are all text."""

from pyspark.sql import Column, functions as F


def plain_double(value: Column) -> Column:
    """Shortest decimal text of a double: ``1704067200.0`` where a cast gives ``1.7040672E9``."""
    digits = F.regexp_replace(value.cast("decimal(38,18)").cast("string"), r"0+$", "")
    plain = F.when(digits.endswith("."), F.concat(digits, F.lit("0"))).otherwise(digits)
    exponent = F.regexp_replace(F.regexp_replace(F.lower(value.cast("string")), r"\.0e", "e"), r"e-(\d)$", "e-0$1")
    size = F.abs(value)
    return F.when((size > 0) & ((size < 1e-4) | (size >= 1e16)), exponent).otherwise(plain)


def cell_text(value: Column) -> Column:
    """Cells have no null: an absent value is the word ``None``."""
    return F.coalesce(value.cast("string"), F.lit("None"))
