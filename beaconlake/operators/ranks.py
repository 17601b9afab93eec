"""Places of rows in an order, over all rows or within groups, without a task that holds a whole group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from beaconlake.session import staged

_INDEX_BITS = 33  # of `monotonically_increasing_id`; the partition stands above


def numbered(
    rows: DataFrame, order: Sequence[Column], by: Sequence[str] = (), place: str = "place", total: str | None = None, start: int = 0
) -> DataFrame:
    """Rows with their place in `order`, from `start` on, and with `total` the rows of their group.

    The rows are dealt out by ranges of group and order and sorted there; a row's place is its index in the range plus
    the rows of its group in the ranges before. So the only rows that meet in one task are one count per range. Sorted
    rows are written once, as ranges must not be drawn anew between the counts and the rows. Rows alike in group and
    order share a range and get neighbouring places in any order: give an order that tells apart what may not be
    interchanged. A null group is a group.
    """
    at, part, index = (f"{place}_{n}" for n in ("at", "part", "index"))
    keys = [F.col(c).asc_nulls_first() for c in by]
    ranged = rows.repartitionByRange(*keys, *order).sortWithinPartitions(*keys, *order)
    sorted_rows = staged(ranged.withColumn(at, F.monotonically_increasing_id()), "numbered").withColumns(
        {part: F.shiftrightunsigned(at, _INDEX_BITS), index: F.col(at).bitwiseAND((1 << _INDEX_BITS) - 1)}
    )
    counts = sorted_rows.groupBy(part, *by).agg(F.min(index).alias(f"{place}_first"), F.count("*").alias(f"{place}_n"))
    whole = Window.partitionBy(*(by or [F.lit(0)]))
    before = F.sum(f"{place}_n").over(whole.orderBy(part).rowsBetween(Window.unboundedPreceding, -1))
    counts = counts.select(
        F.col(part).alias(f"{part}_of"), *[F.col(c).alias(f"{place}_by{i}") for i, c in enumerate(by)],
        (F.coalesce(before, F.lit(0)) - F.col(f"{place}_first") + start).alias(f"{place}_offset"),
        F.sum(f"{place}_n").over(whole).alias(f"{place}_total"),
    )
    same = F.col(part) == F.col(f"{part}_of")
    for i, c in enumerate(by):
        same = same & F.col(c).eqNullSafe(F.col(f"{place}_by{i}"))
    found = sorted_rows.join(counts, same)
    shown = {place: F.col(index) + F.col(f"{place}_offset")} | ({total: F.col(f"{place}_total")} if total else {})
    return found.select(*rows.columns, *[c.cast("long").alias(n) for n, c in shown.items()])
