"""Views over the feed tables: map layers, counts, snapshots, grids."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from beaconlake.operators.geometry import located, point
from beaconlake.operators.ranks import numbered
from beaconlake.session import staged

# Port codes and names, and the order keywords of the grid.
CHOKEPOINTS = {
    "chokepoint1": "Suez Canal",
    "chokepoint2": "Panama Canal",
    "chokepoint3": "Bosporus Strait",
    "chokepoint4": "Bab el-Mandeb Strait",
    "chokepoint5": "Malacca Strait",
    "chokepoint6": "Strait of Hormuz",
    "chokepoint7": "Cape of Good Hope",
    "chokepoint8": "Gibraltar Strait",
    "chokepoint9": "Dover Strait",
    "chokepoint10": "Oresund Strait",
    "chokepoint11": "Taiwan Strait",
}
FRONT_KEYWORDS = ("chokepoint", "date", "capacity", "capacity_cargo", "capacity_tanker")
VOLATILE_LAYERS = ("dark_ships",)


def map_layers(tables: dict[str, DataFrame], base: DataFrame | None = None) -> DataFrame:
    """Located rows of several tables as one, with layer name and point; base layers first."""
    parts = [
        located(rows).withColumns({"layer": F.lit(name), "geometry": point()}) for name, rows in tables.items()
    ]
    if base is not None:
        parts = [base, *parts]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def layer_counts(layers: DataFrame) -> DataFrame:
    return layers.groupBy("layer").agg(F.count("*").alias("n_rows"))


def total_tracked(counts: DataFrame, switched_on: list[str]) -> DataFrame:
    """Sum over the layers switched on; 0 if there is none."""
    total = F.coalesce(F.sum("n_rows"), F.lit(0)).alias("total_tracked")
    return counts.where(F.col("layer").isin(switched_on)).agg(total)


def layer_snapshot(rows: DataFrame, polls: DataFrame, volatile: tuple[str, ...] = VOLATILE_LAYERS) -> DataFrame:
    """Rows of the latest poll in which each layer had any.

    Volatile layers count only if they have rows in the last poll of all. The latest
    poll per layer is a small staged aggregate joined back: Spark knows its size and
    broadcasts it, so no layer goes through one task.
    """
    last_poll = polls.agg(F.max("poll_id").alias("last_poll")).scalar()
    newest = rows.groupBy("layer").agg(F.max("poll_id").alias("poll_id"))
    shown = newest.where(~F.col("layer").isin(*volatile) | (F.col("poll_id") == last_poll))
    return rows.join(staged(shown, "layer-polls"), ["layer", "poll_id"])


def port_name(code: Column) -> Column:
    """Name of a known port code, else the code."""
    table = F.create_map(*[F.lit(part) for pair in CHOKEPOINTS.items() for part in pair])
    return F.coalesce(table[code], code)


def front_first(columns: list[str], keywords: tuple[str, ...] = FRONT_KEYWORDS) -> list[str]:
    """For each keyword the first unused column containing it, then all other columns."""
    front: list[str] = []
    for keyword in keywords:
        front += [c for c in columns if keyword in c.lower() and c not in front][:1]
    return front + [c for c in columns if c not in front]


def chokepoints(records: DataFrame) -> DataFrame:
    """Port records: attributes unnested, epoch milliseconds as a date, port names, columns in order."""
    rows = records.select("attributes.*")
    if "date" in rows.columns:
        rows = rows.withColumn("date", F.date_format(F.timestamp_millis("date"), "yyyy-MM-dd"))
    if "portid" in rows.columns:
        rows = rows.withColumn("chokepoint_name", port_name(F.col("portid")))
    return rows.select(front_first(rows.columns))


def ordered(rows: DataFrame, order: list[Column], place: str | None = None) -> DataFrame:
    """Rows in an order; with `place`, each row says where it stands, from 1, and need not be read in order."""
    return numbered(rows, order, place=place, start=1) if place else rows.orderBy(*order)


def latest_first(rows: DataFrame, column: str = "date", ties: tuple[str, ...] = (), place: str | None = None) -> DataFrame:
    """Latest first, rows without a date before all others; `ties` order rows of one date."""
    return ordered(rows, [F.desc_nulls_first(column), *map(F.col, ties)], place)


def by_volume(markets: DataFrame, ties: tuple[str, ...] = (), place: str | None = None) -> DataFrame:
    """Largest volume first; markets without volume come before all others."""
    return ordered(markets, [F.desc_nulls_first("volume"), *map(F.col, ties)], place)


def newest(rows: DataFrame, limit: int, *order: Column, where: Column | None = None) -> DataFrame:
    """A report of the first `limit` rows in an order, as a distributed top-k."""
    return (rows if where is None else rows.where(where)).orderBy(*order).limit(limit)
