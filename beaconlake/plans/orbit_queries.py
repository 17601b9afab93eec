"""Satellite positions over element sets derived from suppliers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from beaconlake.functions import sgp4
from beaconlake.functions.pieces import piece_of
from beaconlake.operators import orbits, tle
from beaconlake.plans.tables import EVENTS_SQL, PAGE, events, pages_of, query, table


# Published element sets and verification positions (WGS-72) at minutes after the epoch, in km.
PUBLISHED = [
    ("1 00005U 58002B   00179.78495062  .00000023  00000-0  28098-4 0  4753",
     "2 00005  34.2682 348.7242 1859667 331.7664  19.3264 10.82419157413667",
     "2000-06-27 18:50:19.733568", (0, 7022.46529266, -1400.08296755, 0.03995155),
     (360, -7154.03120202, -3783.17682504, -3536.19412294)),
    ("1 04632U 70093B   04031.91070959 -.00000084  00000-0  10000-3 0  9955",
     "2 04632  11.4628 273.1101 1450506 207.6000 143.9350  1.20231981 44145",
     "2004-01-31 21:51:25.308576", (-5184, -29020.02587128, 13819.84419063, -5713.33679183),
     (0, 2334.11450085, -41920.44035349, -0.03867437)),
    ("1 08195U 75081A   06176.33215444  .00000099  00000-0  11873-3 0   813",
     "2 08195  64.1586 279.0717 6877146 264.7651  20.2257  2.00491383225656",
     "2006-06-25 07:58:18.143616", (0, 2349.89483350, -14785.93811562, 0.02119378),
     (120, 15223.91713658, -17852.95881713, 25280.39558224)),
    ("1 28129U 03058A   06175.57071136 -.00000104  00000-0  10000-3 0   459",
     "2 28129  54.7298 324.8098 0048506 266.2640  93.1663  2.00562768 18443",
     "2006-06-24 13:41:49.461504", (0, 21707.46412351, -15318.61752390, 0.13551152),
     (120, 18616.75971861, 3166.15177043, 18833.41523210)),
]
STEPS = 12  # from the first published instant of a set to the second

# Published places by supplier, and what the conversion makes of them: ground(k, which, object_id, latitude, ...).
_VALUES = ", ".join(
    f"({i}, '{line1[2:7]}', {which}, TIMESTAMP '{epoch}' + to_minutes({minutes}), {x!r}::DOUBLE, {y!r}::DOUBLE, {z!r}::DOUBLE)"
    for i, (line1, _, epoch, *places) in enumerate(PUBLISHED) for which, (minutes, x, y, z) in enumerate(places)
)
GROUND_SQL = f"""p(k, object_id, which, instant, x, y, z) AS (VALUES {_VALUES}),
t AS (SELECT *, sqrt(x * x + y * y + z * z) AS r, degrees(atan2(y, x))
        - (((epoch_us(instant) - 946684800000000) / 86400000000.0 - 0.5) * 360.985647366 % 360) AS raw FROM p),
ground AS (SELECT k, object_id, which, instant, round(degrees(asin(z / r)), 5) AS latitude,
  round(CASE WHEN raw < -180 THEN raw + 360 WHEN raw > 180 THEN raw - 360 ELSE raw END, 5)
    AS longitude, round(r - 6371, 4) AS altitude_km FROM t)"""


def _place() -> list[Column]:
    digits = {"latitude": 5, "longitude": 5, "altitude_km": 4}
    return [F.round(name, n).alias(name) for name, n in digits.items()]


def _published(part: int, field: int | None = None) -> Column:
    """A part of the set a supplier carries."""
    values = [row[part] if field is None else row[part][field] for row in PUBLISHED]
    return F.get(F.array(*[F.lit(v) for v in values]), (F.col("key") % len(PUBLISHED)).cast("int"))


def published_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each supplier carries one of the published sets; the lines of one nation are garbage of the right shape."""
    rows = table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("key"), F.col("s_nationkey").alias("nation"), F.timestamp_seconds(F.lit(0)).alias("fetched"),
    )
    wrong = F.concat(F.substring(_published(1), 1, 68), F.lit("x"))
    return rows.withColumns({"line1": _published(0), "line2": F.when(F.col("nation") == 3, wrong).otherwise(_published(1))})


def published_sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same as a feed, read back, with the published instants of each set."""
    block = F.concat_ws("\r\n", F.col("key").cast("string"), "line1", F.concat(F.col("line2"), F.lit("\r\n")))
    feed = pages_of(
        published_rows(spark, sf_dir), "key", block, "celestrak_military", "", "TAIL", fetched_at="fetched", separator="\n"
    )
    sets = tle.extract(feed).withColumn("key", F.col("object_name").cast("bigint"))
    epoch = _published(2).cast("timestamp")
    return sets.select(
        "key", "object_id", "tle_line1", "tle_line2",
        *[(epoch + F.make_dt_interval(mins=_published(part, 0))).alias(name) for part, name in ((3, "first_at"), (4, "second_at"))],
    )


@query("ground_positions", f"""WITH {GROUND_SQL}
SELECT s_suppkey AS key, object_id, epoch_us(instant) AS at_us, latitude, longitude, altitude_km
FROM supplier JOIN ground ON s_suppkey % {len(PUBLISHED)} = k WHERE which = 1 AND s_nationkey <> 3""")
def ground_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every satellite at an instant of its own; those with broken lines have no position."""
    rows = orbits.ground_positions(published_sets(spark, sf_dir), F.col("second_at"), sgp4.WGS72)
    return rows.select("key", "object_id", F.unix_micros("second_at").alias("at_us"), *_place())


@query("ground_tracks", f"""WITH {GROUND_SQL}
SELECT s_suppkey AS key, a.object_id, {STEPS + 1} AS n_instants, epoch_us(a.instant) AS first_at_us, epoch_us(b.instant) AS last_at_us,
       a.latitude AS first_latitude, a.longitude AS first_longitude, a.altitude_km AS first_altitude_km,
       b.latitude AS last_latitude, b.longitude AS last_longitude, b.altitude_km AS last_altitude_km
FROM supplier JOIN ground a ON s_suppkey % {len(PUBLISHED)} = a.k JOIN ground b ON a.k = b.k
WHERE a.which = 0 AND b.which = 1 AND s_nationkey <> 3""")
def ground_tracks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All satellites over thirteen instants between two published places, and the places at both ends."""
    sets = published_sets(spark, sf_dir)
    minutes = [b[0] - a[0] for *_, a, b in PUBLISHED]
    step = F.get(F.array(*[F.lit(m // STEPS) for m in minutes]), (F.col("key") % len(PUBLISHED)).cast("int"))
    rows = orbits.ground_tracks(sets, F.col("first_at"), F.col("second_at"), F.make_dt_interval(mins=step), sgp4.WGS72)
    place = F.struct(F.unix_micros("at").alias("at_us"), *_place())
    ends = rows.groupBy("key", "object_id").agg(
        F.count("*").cast("int").alias("n_instants"), F.min_by(place, "at").alias("first"), F.max_by(place, "at").alias("last")
    )
    names = ("at_us", "latitude", "longitude", "altitude_km")
    return ends.select(
        "key", "object_id", "n_instants", *[F.col(f"{end}.{n}").alias(f"{end}_{n}") for end in ("first", "last") for n in names]
    )


@query("positions_from_lists", f"""WITH {GROUND_SQL},
s AS (SELECT s_suppkey, s_suppkey // {PAGE} AS seq, s_nationkey,
             CAST(row_number() OVER (PARTITION BY s_suppkey // {PAGE} ORDER BY s_suppkey) - 1 AS INTEGER) AS place,
             count(*) OVER (PARTITION BY s_suppkey // {PAGE}) AS n FROM supplier),
v AS (SELECT * FROM ground WHERE k = 0 AND which = 1)
SELECT seq, place, s_nationkey <> 3 AND s_suppkey % {len(PUBLISHED)} = 0 AS located,
       CASE WHEN located THEN latitude END AS latitude, CASE WHEN located THEN longitude END AS longitude,
       CASE WHEN located THEN altitude_km END AS altitude_km
FROM s, v WHERE place < n - 1""")
def positions_from_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lists of first and second lines, the second one shorter, at a published instant of one set.

    Other sets are shown without their places, as nothing is published for them at that instant.
    """
    rows = published_rows(spark, sf_dir).withColumn("seq", piece_of("key", PAGE))
    ordered = F.array_sort(F.collect_list(F.struct("key", "line1", "line2")))
    lists = rows.groupBy("seq").agg(ordered.alias("rows")).select(
        "seq", F.transform("rows", lambda r: r["line1"]).alias("line1s"),
        F.transform(F.slice("rows", F.lit(1), F.size("rows") - 1), lambda r: r["line2"]).alias("line2s"),
    )
    line1, _, epoch, _, (minutes, *_) = PUBLISHED[0]
    at = F.lit(epoch).cast("timestamp") + F.make_dt_interval(mins=F.lit(minutes))
    found = orbits.positions_from_lists(lists, at, "seq", gravity=sgp4.WGS72)
    located = (F.col("tle_line1") == line1) & ~F.isnan("latitude")
    shown = found.select("seq", "place", located.alias("located"), *_place())
    return shown.select("seq", "place", "located", *[
        F.when(F.col("located"), F.col(n)).alias(n) for n in ("latitude", "longitude", "altitude_km")])


@query("ground_conversion", f"""WITH {EVENTS_SQL}, p AS (
  SELECT event_id, 7000 * cos(radians(lat)) * cos(radians(lon)) AS x, 7000 * cos(radians(lat)) * sin(radians(lon)) AS y,
         7000 * sin(radians(lat)) AS z, ((epoch_us(ts) - 946684800000000) / 86400000000.0 - 0.5) * 360.985647366 % 360 AS turn
  FROM e),
g AS (SELECT event_id, sqrt(x * x + y * y + z * z) AS r, degrees(atan2(y, x)) - turn AS raw, x, y, z FROM p)
SELECT event_id, round(degrees(asin(z / r)), 5) AS latitude,
       round(CASE WHEN raw < -180 THEN raw + 360 WHEN raw > 180 THEN raw - 360 ELSE raw END, 5) AS longitude,
       round(r - 6371, 5) AS altitude_km FROM g""")
def ground_conversion(spark: SparkSession, sf_dir: str) -> DataFrame:
    """From given positions in space to latitude, longitude and altitude."""
    lat, lon = F.radians("lat"), F.radians("lon")
    rows = events(spark, sf_dir).select(
        "event_id", "ts", (7000 * F.cos(lat) * F.cos(lon)).alias("x_km"), (7000 * F.cos(lat) * F.sin(lon)).alias("y_km"),
        (7000 * F.sin(lat)).alias("z_km"),
    )
    found = orbits.ground(rows, F.col("ts"))
    return found.select("event_id", *[F.round(c, 5).alias(c) for c in ("latitude", "longitude", "altitude_km")])
