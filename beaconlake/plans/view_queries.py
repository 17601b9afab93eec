"""Map layers, grids, feed health and geometry over the driver's tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from beaconlake.functions.pieces import piece_of
from beaconlake.operators import dynamic, feeds, geometry, health, views
from beaconlake.plans.feed_queries import (
    E, USGS_LOCATED, element, fred_payloads, num, opensky_payloads, txt, usgs_payloads,
)
from beaconlake.plans.tables import EVENTS_SQL, arr, events, js, obj, pages_of, query, raw, table


def usgs_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return feeds.extract(usgs_payloads(spark, sf_dir), feeds.FEEDS["usgs"])


def opensky_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return feeds.extract(opensky_payloads(spark, sf_dir), feeds.FEEDS["opensky"])


def eonet_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    record = obj(title=js(E.label), geometry=arr(obj(coordinates=arr(num(E.lon), num(E.lat)))))
    payloads = pages_of(events(spark, sf_dir), "event_id", record, "nasa_eonet", '{"events":[', "]}")
    return feeds.extract(payloads, feeds.FEEDS["eonet"])


def layer_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    label = {"usgs": "place", "opensky": "icao24", "nasa_eonet": "title"}
    rows = {
        "usgs": usgs_rows(spark, sf_dir), "opensky": opensky_rows(spark, sf_dir), "nasa_eonet": eonet_rows(spark, sf_dir),
    }
    return {
        name: table_.select("seq", "pos", F.col(label[name]).alias("label"), "longitude", "latitude")
        for name, table_ in rows.items()
    }


def base_layer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A static layer: suppliers at made-up places."""
    placed = table(spark, sf_dir, "supplier").select(
        F.col("s_name").alias("label"), (F.col("s_suppkey") % 360 - 180).cast("double").alias("longitude"),
        (F.col("s_nationkey") * 3).cast("double").alias("latitude"),
    )
    return placed.withColumns({"layer": F.lit("ports"), "geometry": geometry.point()})


LAYERS_SQL = f"""{EVENTS_SQL}, m AS (
  SELECT 'usgs' AS layer, seq, pos, CASE WHEN event_type <> 'view' THEN 'E' || event_id END AS label, lon AS x, lat AS y
  FROM e WHERE {USGS_LOCATED}
  UNION ALL SELECT 'opensky', seq, pos, 'E' || event_id, lon, lat FROM e WHERE event_type <> 'signup'
  UNION ALL SELECT 'nasa_eonet', seq, pos, 'E' || event_id, lon, lat FROM e WHERE event_type <> 'error'
  UNION ALL SELECT 'ports', NULL, NULL, s_name, CAST(s_suppkey % 360 - 180 AS DOUBLE), CAST(s_nationkey * 3 AS DOUBLE) FROM supplier)"""


@query("located_rows", f"""WITH {EVENTS_SQL}
SELECT seq, pos, CASE WHEN event_type <> 'view' THEN 'E' || event_id END AS place,
       CASE WHEN event_type <> 'error' THEN value END AS magnitude, lon AS longitude, lat AS latitude
FROM e WHERE {USGS_LOCATED}""")
def located_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return geometry.located(usgs_rows(spark, sf_dir)).drop("source", "fetched_at")


@query("map_layers", f"WITH {LAYERS_SQL} SELECT * FROM m")
def map_layers(spark: SparkSession, sf_dir: str) -> DataFrame:
    layers = views.map_layers(layer_tables(spark, sf_dir), base_layer(spark, sf_dir))
    return layers.select("layer", "seq", "pos", "label", "geometry.x", "geometry.y")


@query("layer_counts", f"WITH {LAYERS_SQL} SELECT layer, count(*) AS n_rows FROM m GROUP BY layer")
def layer_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.layer_counts(views.map_layers(layer_tables(spark, sf_dir), base_layer(spark, sf_dir)))


@query("total_tracked", f"WITH {LAYERS_SQL} SELECT CAST(count(*) AS BIGINT) AS total_tracked FROM m WHERE layer IN ('usgs', 'opensky')")
def total_tracked(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.total_tracked(layer_counts(spark, sf_dir), ["usgs", "opensky", "celestrak"])


POLL = 20  # events per poll


@query("layer_snapshot", f"""WITH {EVENTS_SQL}, r AS (
  SELECT event_type || '_' || k // 10 AS layer, event_type, event_id // {POLL} AS poll_id, event_id FROM e)
SELECT layer, poll_id, event_id FROM r
QUALIFY poll_id = max(poll_id) OVER (PARTITION BY layer)
  AND (event_type <> 'error' OR poll_id = (SELECT max(event_id // {POLL}) FROM events))""")
def layer_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fifty layers over small polls, most of which lack most layers; those of one type are volatile."""
    layer = F.concat_ws("_", E.event_type, piece_of("k", 10).cast("string"))
    rows = events(spark, sf_dir).select(layer.alias("layer"), piece_of("event_id", POLL).alias("poll_id"), "event_id")
    volatile = tuple(f"error_{n}" for n in range(10))
    return views.layer_snapshot(rows, rows.select("poll_id"), volatile)


@query("chokepoints", """
SELECT CASE o_orderkey % 14 WHEN 1 THEN 'Suez Canal' WHEN 2 THEN 'Panama Canal' WHEN 3 THEN 'Bosporus Strait'
         WHEN 4 THEN 'Bab el-Mandeb Strait' WHEN 5 THEN 'Malacca Strait' WHEN 6 THEN 'Strait of Hormuz'
         WHEN 7 THEN 'Cape of Good Hope' WHEN 8 THEN 'Gibraltar Strait' WHEN 9 THEN 'Dover Strait'
         WHEN 10 THEN 'Oresund Strait' WHEN 11 THEN 'Taiwan Strait' ELSE 'chokepoint' || (o_orderkey % 14) END AS chokepoint_name,
       strftime(o_orderdate, '%Y-%m-%d') AS date, o_totalprice AS capacity, o_totalprice / 4 AS capacity_cargo,
       'chokepoint' || (o_orderkey % 14) AS portid, o_orderkey AS "ObjectId"
FROM orders""")
def chokepoints(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    port = F.concat(F.lit("chokepoint"), (F.col("o_orderkey") % 14).cast("string"))
    attributes = obj(
        ObjectId=js("o_orderkey"), portid=js(port), date=js(F.unix_millis(F.col("o_orderdate").cast("timestamp"))),
        capacity=js("o_totalprice"), capacity_cargo=js(F.col("o_totalprice") / 4),
    )
    payloads = pages_of(
        orders, "o_orderkey", obj(attributes=attributes), "imf_portwatch", '{"features":[', "]}", fetched_at="o_orderdate"
    )
    return views.chokepoints(dynamic.extract(payloads))


@query("fred_latest_first", f"""WITH {EVENTS_SQL}
SELECT strftime(ts, '%Y-%m-%d') AS date, CASE WHEN event_type NOT IN ('error', 'view') THEN value END AS value,
       row_number() OVER (ORDER BY strftime(ts, '%Y-%m-%d') DESC, event_id) AS place FROM e""")
def fred_latest_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = feeds.extract(fred_payloads(spark, sf_dir), feeds.FEEDS["fred"])
    return views.latest_first(rows, ties=("seq", "pos"), place="place").select("date", "value", "place")


@query("markets_by_volume", f"""WITH {EVENTS_SQL}
SELECT CASE WHEN event_type NOT IN ('view', 'signup') THEN 'E' || event_id END AS title,
       CASE WHEN event_type NOT IN ('error', 'signup') THEN value END AS volume,
       row_number() OVER (ORDER BY CASE WHEN event_type NOT IN ('error', 'signup') THEN value END DESC NULLS FIRST, event_id) AS place
FROM e""")
def markets_by_volume(spark: SparkSession, sf_dir: str) -> DataFrame:
    record = element(obj(title=txt(E.label), volume=num(E.value)))
    payloads = pages_of(events(spark, sf_dir), "event_id", record, "polymarket")
    markets = feeds.extract(payloads, feeds.FEEDS["polymarket"])
    return views.by_volume(markets, ties=("seq", "pos"), place="place").select("title", "volume", "place")


def fetch_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events(spark, sf_dir).select(
        E.event_type.alias("source"), E.event_id.alias("seq"), (E.value <= 10).alias("ok")
    )


@query("feed_health", """
WITH l AS (SELECT event_type AS source, event_id AS seq, value <= 10 AS ok,
                  sum(CASE WHEN value <= 10 THEN 1 ELSE 0 END) OVER (PARTITION BY event_type ORDER BY event_id) AS run FROM events),
r AS (SELECT *, row_number() OVER (PARTITION BY source, run, ok ORDER BY seq) AS failed FROM l),
s AS (SELECT source, seq, ok, CASE WHEN ok THEN 0 ELSE (failed - 1) % 5 + 1 END AS streak FROM r)
SELECT source, count(*) AS requests, count(*) FILTER (NOT ok) AS failures, count(*) FILTER (streak = 5) AS trips,
       max(streak) AS longest_streak, arg_max(streak, seq) AS open_streak
FROM s GROUP BY source""")
def feed_health(spark: SparkSession, sf_dir: str) -> DataFrame:
    return health.feed_health(fetch_log(spark, sf_dir))


# -- geometry

LINE = 20  # events per derived line


def cable_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines through consecutive events; the type of the first event picks the kind of geometry."""
    e = events(spark, sf_dir).withColumn("line", piece_of("event_id", LINE))
    points = F.transform(
        F.array_sort(F.collect_list(F.struct("event_id", arr(js(E.lon), js(E.lat)).alias("p")))), lambda x: x["p"]
    )
    lines = e.groupBy("line").agg(
        points.alias("points"), F.min_by("event_type", "event_id").alias("kind"), F.max("ts").alias("ts")
    )

    def listed(items: Column) -> Column:
        return F.concat(F.lit("["), F.array_join(items, ","), F.lit("]"))

    first, rest = F.slice("points", 1, 10), F.slice("points", 11, 10)
    kind = F.col("kind")
    shape = (
        F.when(kind == "view", obj(type=raw('"MultiLineString"'), coordinates=arr(listed(first), listed(rest))))
        .when(kind == "error", obj(type=raw('"Point"'), coordinates=F.get("points", 0)))
        .when(kind == "signup", raw("null"))
        .otherwise(obj(type=raw('"LineString"'), coordinates=listed(F.col("points"))))
    )
    name = F.when(kind == "purchase", raw("7")).otherwise(js(F.concat(F.lit("Cable "), F.col("line").cast("string"))))
    feature = obj(
        type=raw('"Feature"'), properties=obj(name=name, id=js(F.concat(F.lit("id-"), F.col("line").cast("string")))),
        geometry=shape,
    )
    return pages_of(lines, "line", feature, "cables", '{"type":"FeatureCollection","features":[', "]}")


@query("cable_paths", f"""WITH {EVENTS_SQL}, p AS (
  SELECT event_id // {LINE} AS line, row_number() OVER (PARTITION BY event_id // {LINE} ORDER BY event_id) - 1 AS i,
         arg_min(event_type, event_id) OVER (PARTITION BY event_id // {LINE}) AS kind, lon, lat FROM e)
SELECT CASE WHEN kind = 'purchase' THEN 'Unknown' ELSE 'Cable ' || line END AS name, 'id-' || line AS id,
       CASE WHEN kind = 'view' THEN CAST(i // 10 AS INTEGER) WHEN kind IN ('click', 'purchase') THEN 0 END AS line_no,
       CASE WHEN kind = 'view' THEN CAST(i % 10 AS INTEGER) WHEN kind IN ('click', 'purchase') THEN CAST(i AS INTEGER) END AS vertex_no,
       CASE WHEN kind NOT IN ('error', 'signup') THEN lon END AS x, CASE WHEN kind NOT IN ('error', 'signup') THEN lat END AS y
FROM p WHERE kind NOT IN ('error', 'signup') OR i = 0""")
def cable_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    paths = geometry.cable_paths(cable_payloads(spark, sf_dir))
    return geometry.vertices(paths).select("name", "id", "line_no", "vertex_no", "x", "y")


def point_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A layer per event type; events with a small number have no latitude or no city."""
    rows = events(spark, sf_dir).select(
        "event_id", F.when(E.k >= 10, E.lat).alias("latitude"), E.lon.alias("longitude"),
        F.when(E.k < 90, E.label).alias("city"), E.k.alias("threat_level"), "event_type",
    )
    return geometry.to_features(rows, F.col("event_type"), "event_id").select("layer", "feature_id", "feature")


POINTS_SQL = f"""{EVENTS_SQL}, f AS (
  SELECT event_type AS layer, event_id AS feature_id, k, CAST(trunc(lon * 10000) AS INTEGER) AS px,
         CAST(trunc(lat * 10000) AS INTEGER) AS py, CASE WHEN k < 90 THEN 'E' || event_id END AS city
  FROM e WHERE k >= 10)"""


@query("points_to_features", f"""WITH {POINTS_SQL}
SELECT layer, feature_id // {geometry.COLLECTION_SIZE} AS part, count(*) AS n_features,
       '{{"type":"FeatureCollection","features":[' || string_agg(
         '{{"type":"Feature","id":' || feature_id || ',"geometry":{{"type":"Point","coordinates":[' || px || ',' || py ||
         ']}},"properties":{{"_layer":"' || layer || '","city":' || coalesce('"' || city || '"', 'null') ||
         ',"threat_level":' || k || ',"event_type":"' || layer || '"}}}}', ',' ORDER BY feature_id) || ']}}' AS collection
FROM f GROUP BY ALL""")
def points_to_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return geometry.to_collections(point_features(spark, sf_dir))


@query("features_to_rows", f"WITH {POINTS_SQL} SELECT layer, feature_id, px, py, city, k AS threat_level FROM f")
def features_to_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return geometry.from_collections(points_to_features(spark, sf_dir), {"city": "string", "threat_level": "int"})


@query("list_layers", f"WITH {POINTS_SQL} SELECT DISTINCT layer FROM f")
def list_layers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return geometry.layers(points_to_features(spark, sf_dir))
