"""Numbers and codes from text. A text that does not fit becomes NULL, never an error.

Placeholder texts ('N/A', 'TBD', ...) have none of these shapes, so they need no test of their own.

A failing ``try_cast`` raises and catches an exception inside the JVM, at some twenty times the cost of the
cast, so the shape is matched first. The shape also keeps out '1E3', which a decimal cast would read. Each
expression uses its input once: a filter on the result is then pushed below the projections without copies.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from medloom.functions.binding import let
from medloom.functions.text import drop_text, matched

# Shapes of codes and numbers. 'tinyint' is unsigned, 0 to 255.
ICD_SHAPE = r"^[A-Z][0-9]{2}(?:[A-Z0-9]{1,4}|\.(?=\.*[A-Z0-9])[A-Z0-9.]{1,4})\z"
PINCODE_SHAPE = r"^(?:\+?0*(?=[1-9][0-9]{5}\z))?([0-9]{6})\z"
CPT_SHAPE = r"^([0-9]{5})\.0{5}\z"
DECIMAL_SHAPE = r"^[+-]?(?:[0-9]+\.?[0-9]*|\.[0-9]+)\z"
WHOLE_SHAPES = {
    "int": ("int", r"^[+-]?0*[0-9]{1,10}\z"),
    "smallint": ("smallint", r"^[+-]?0*[0-9]{1,5}\z"),
    "tinyint": ("smallint", r"^\+?0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])\z"),
}


def safe_int(col: Column, kind: str = "int") -> Column:
    """Whole number of kind 'int', 'smallint' or 'tinyint'; commas are ignored.

    Rows are filtered by keys read so. ``matched`` ends in a ``nullif``, of which a filter computes the input twice.
    """
    spark_type, shape = WHOLE_SHAPES[kind]
    return F.get(F.regexp_extract_all(drop_text(col, ","), F.lit(shape), 0), F.lit(0)).try_cast(spark_type)


def safe_decimal(col: Column, precision: int, scale: int, drop: tuple[str, ...] = (",", " ")) -> Column:
    """Decimal rounded half up to ``scale`` after removing separators; NULL when it does not fit."""
    return matched(drop_text(col, *drop), DECIMAL_SHAPE).try_cast(f"decimal({precision},{scale})")


def cpt_number(col: Column) -> Column:
    """The number a procedure code text holds."""
    return safe_decimal(col, 10, 5)


def cpt_code(number: Column) -> Column:
    """Five-digit procedure code from a whole number 0..99999 out of ``cpt_number`` ('99213.0' counts)."""
    return matched(F.lpad(number.cast("string"), 11, "0"), CPT_SHAPE, 1)


def icd_code(col: Column) -> Column:
    """Upper-case diagnosis code, with or without dot; NULL when the shape is wrong."""
    return matched(F.upper(drop_text(col, " ")), ICD_SHAPE)


def pincode(col: Column) -> Column:
    """Six digits as they stand, else the six digits of a whole number 100000..999999."""
    return matched(drop_text(col, " "), PINCODE_SHAPE, 1)


def experience_years(years: Column) -> Column:
    """Years of experience, 0 to 60."""
    return let(years, lambda y: F.when(y <= 60, y))
