"""Type-strict getters on VARIANT values.

A getter gives the value only if the JSON value has the asked type; any other
type becomes null and the row stays. `try_variant_get` alone would coerce
(`5` to `'5'`), hence the test on the JSON type.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

FLOAT_TEXT = r"^[+-]?(([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?|(?i:inf|infinity|nan))$"
INTEGER_TEXT = r"^[+-]?[0-9]+$"


def parse(payload: Column | str) -> Column:
    """Payload text as VARIANT, null if it is not valid JSON."""
    return F.try_parse_json(payload)


def json_type(value: Column, path: str) -> Column:
    return F.schema_of_variant(F.try_variant_get(value, path, "variant"))


def text(value: Column, path: str) -> Column:
    return F.when(json_type(value, path) == "STRING", F.try_variant_get(value, path, "string"))


def number(value: Column, path: str) -> Column:
    is_number = json_type(value, path).rlike("^(BIGINT|DOUBLE|DECIMAL.*)$")
    return F.when(is_number, F.try_variant_get(value, path, "double"))


def integer(value: Column, path: str) -> Column:
    return F.when(json_type(value, path) == "BIGINT", F.try_variant_get(value, path, "bigint"))


def small_integer(value: Column, path: str) -> Column:
    """32-bit integer; null beyond its range."""
    return integer(value, path).try_cast("int")


def number_in_text(value: Column, path: str) -> Column:
    content = text(value, path)
    return F.when(content.rlike(FLOAT_TEXT), content.try_cast("double"))


def small_integer_in_text(value: Column, path: str) -> Column:
    content = text(value, path)
    return F.when(content.rlike(INTEGER_TEXT), content.try_cast("int"))


def integer_or_text(value: Column, path: str) -> Column:
    content = text(value, path)
    return F.coalesce(
        integer(value, path), F.when(content.rlike(INTEGER_TEXT), content.try_cast("bigint"))
    )


def trimmed_text(value: Column, path: str) -> Column:
    return strip(text(value, path))


def elements(value: Column, path: str) -> Column:
    """Array of VARIANT, null if the path does not hold an array."""
    return F.try_variant_get(value, path, "array<variant>")


def strip(content: Column) -> Column:
    """Both ends free of white space of any kind, not only blanks."""
    return F.regexp_replace(content, r"(?U)^\s+|\s+$", "")
