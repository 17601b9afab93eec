"""Cutting long histories into pieces of bounded size."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def piece_of(number: Column | str, size: int) -> Column:
    """Number of the piece a row falls in, by whole-number division."""
    column = F.col(number) if isinstance(number, str) else number
    return F.call_function("div", column.cast("bigint"), F.lit(size).cast("bigint"))
