"""Satellite ground positions and tracks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from beaconlake.functions import sgp4
from beaconlake.operators import tle

# Spherical earth radius, turn of the earth per day.
EARTH_RADIUS_KM = 6371.0
EARTH_TURN_DEG = 360.985647366

# Steps of a grid that share one computation of the orbit's constants, and stretches that a task works off.
STRETCH = 1024
STRETCHES_PER_TASK = 64


def days_since_2000(at: Column) -> Column:
    """Days since 2000-01-01 00:00 UTC."""
    return (F.unix_micros(at.cast("timestamp")) - F.lit(946684800000000)) / F.lit(86400e6)


def ground(rows: DataFrame, at: Column, gmst_offset_deg: float = 0.0) -> DataFrame:
    """Latitude, longitude and altitude over a sphere from `x_km, y_km, z_km`.

    The turn of the earth is counted from noon of 2000-01-01 without the sidereal angle
    of that instant; `gmst_offset_deg=280.46062` gives geographic longitudes. Rows
    without a position get NaN.
    """
    x, y, z = F.col("x_km"), F.col("y_km"), F.col("z_km")
    radius = F.sqrt(x * x + y * y + z * z)
    turn = ((days_since_2000(at) - 0.5) * EARTH_TURN_DEG + gmst_offset_deg) % 360.0
    raw = F.degrees(F.atan2(y, x)) - turn
    wrapped = F.when(raw < -180.0, raw + 360.0).when(raw > 180.0, raw - 360.0).otherwise(raw)
    again = F.when(wrapped < -180.0, wrapped + 360.0).when(wrapped > 180.0, wrapped - 360.0).otherwise(wrapped)
    nan = F.lit(float("nan"))
    return rows.withColumns(
        {
            "latitude": F.coalesce(F.degrees(F.asin(z / radius)), nan),
            "longitude": F.coalesce(again, nan),
            "altitude_km": F.coalesce(radius - EARTH_RADIUS_KM, nan),
        }
    )


def positions_at(element_sets: DataFrame, at: Column, gravity: sgp4.Gravity = sgp4.WGS84) -> DataFrame:
    """Position of every satellite at an instant, NaN where elements or model fail.

    Element sets are few bytes, but one far from its epoch is much work: they are dealt out over
    `spark.sql.shuffle.partitions` tasks, however few their bytes.
    """
    given = element_sets.columns
    dealt = element_sets.repartition(int(element_sets.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    timed = tle.elements(dealt).withColumn("at", at.cast("timestamp"))
    timed = timed.withColumn("at_day", days_since_2000(F.col("at")))
    moved = sgp4.propagate(timed, "(at_day - epoch_day) * 1440.0D", gravity)
    extra = [] if "at" in given else ["at"]
    return ground(moved, F.col("at")).select(*given, *extra, "latitude", "longitude", "altitude_km")


def ground_positions(element_sets: DataFrame, at: Column, gravity: sgp4.Gravity = sgp4.WGS84) -> DataFrame:
    """Only satellites with a position."""
    return positions_at(element_sets, at, gravity).where(~F.isnan("latitude"))


def positions_from_lists(lists: DataFrame, at: Column, *keys: str, gravity: sgp4.Gravity = sgp4.WGS84) -> DataFrame:
    """Positions for `(keys, line1s, line2s)` lists, paired by place up to the shorter list."""
    size = F.least(F.size("line1s"), F.size("line2s"))
    pairs = F.arrays_zip(
        F.slice("line1s", F.lit(1), size).alias("tle_line1"), F.slice("line2s", F.lit(1), size).alias("tle_line2")
    )
    paired = lists.select(*keys, F.posexplode(pairs).alias("place", "pair")).select(*keys, "place", "pair.*")
    return positions_at(paired, at, gravity)


def ground_tracks(
    element_sets: DataFrame, start: Column, end: Column, step: Column, gravity: sgp4.Gravity = sgp4.WGS84
) -> DataFrame:
    """Positions at every step from start to end, without a join. The step is a positive interval of days or less.

    Element sets are few bytes and their tracks much work. Each satellite first makes stretches of `STRETCH`
    steps; these are counted and dealt out in turn, `STRETCHES_PER_TASK` to a task or fewer if cores are idle, so neither
    one long grid nor sets that occur very often meet in a task. A stretch computes the constants of its orbit once,
    then its instants.
    """
    spark = element_sets.sparkSession
    given = element_sets.columns
    grid = F.struct(start.cast("timestamp").alias("start"), end.cast("timestamp").alias("end"), step.alias("step"))
    stretches = element_sets.withColumn("grid", grid).withColumn(
        "first", F.explode(F.sequence("grid.start", "grid.end", F.col("grid.step") * STRETCH))
    )
    count = stretches.count()
    tasks = max(-(-count // STRETCHES_PER_TASK), min(count, spark.sparkContext.defaultParallelism), 1)
    dealt = stretches.repartition(tasks)
    orbits = sgp4.constants(tle.elements(dealt), gravity)
    last = F.least(F.col("given.grid.end"), F.col("given.first") + F.col("given.grid.step") * (STRETCH - 1))
    timed = orbits.withColumn("at", F.explode(F.sequence(F.col("given.first"), last, F.col("given.grid.step"))))
    timed = timed.withColumn("given", F.struct(*[F.col("given")[c].alias(c) for c in given], "at"))
    timed = timed.withColumn("at_day", days_since_2000(F.col("at")))
    moved = sgp4.at_minutes(timed, "(at_day - epoch_day) * 1440.0D", gravity)
    found = ground(moved, F.col("at")).select(*given, "at", "latitude", "longitude", "altitude_km")
    return found.where(~F.isnan("latitude"))
