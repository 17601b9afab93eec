"""Vessel feeds, state, enrichment and silence over payloads derived from events."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from beaconlake.operators import feeds, polls, vessels
from beaconlake.plans.feed_queries import E, as_text
from beaconlake.plans.tables import EVENTS_SQL, arr, events, js, obj, pages_of, query, raw, single

TIMEOUT_HOURS = 0.05


def _static() -> Column:
    name = F.when(E.k < 10, raw("null")).when(E.k < 20, raw('" "')).otherwise(
        js(F.concat(F.lit(" VESSEL "), as_text(E.k), F.lit(" ")))
    )
    data = obj(UserID=js(E.user_id), Type=js(F.lit(60) + E.k % 40), Name=name,
               Destination=F.when(E.k < 5, raw("null")).otherwise(js(F.concat(F.lit("PORT "), as_text(E.k)))))
    return obj(MessageType=raw('"ShipStaticData"'), Message=obj(ShipStaticData=data))


def _position() -> Column:
    name = F.when(E.k < 30, raw("null")).when(E.k < 50, raw('"Unknown"')).otherwise(
        js(F.concat(F.lit("SHIP "), as_text(E.k), F.lit(" ")))
    )
    meta = obj(MMSI=js(E.user_id), ShipName=name, latitude=js(E.lat), longitude=js(E.lon))
    nav = F.when(E.k > 90, raw('"none"')).otherwise(js(E.event_id % 3))
    report = obj(Sog=js(E.value), Cog=raw("90"), NavigationalStatus=nav)
    return obj(MessageType=raw('"PositionReport"'), MetaData=meta, Message=obj(PositionReport=report))


def ais_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`signup` events are static records, all others position reports."""
    payload = F.when(E.event_type == "signup", _static()).otherwise(_position())
    return single(events(spark, sf_dir), "event_id", payload, "ais_stream")


def _marinesia_record() -> Column:
    kinds = F.array(*[F.lit(k) for k in ("Cargo", "Tanker", "Passenger", "Fishing", "Pleasure Craft", "Other")])
    return obj(
        mmsi=js(E.user_id), lat=js(E.lat), lng=F.when(E.k > 95, raw('"x"')).otherwise(js(E.lon)), sog=js(E.value),
        cog=raw("null"), status=F.when(E.k > 80, raw("1.5")).otherwise(js(E.event_id % 3)),
        type=js(F.get(kinds, E.k % 6)),
        name=F.when(E.k < 10, raw("7")).when(E.k < 30, raw('""')).otherwise(js(F.concat(F.lit("M "), as_text(E.k)))),
        dest=F.when(E.k < 50, js(F.concat(F.lit("DEST "), as_text(E.k)))).otherwise(raw("[]")),
    )


def _digitraffic_record() -> Column:
    return obj(
        properties=F.when(E.k == 99, raw("5")).otherwise(
            obj(mmsi=js(E.user_id), sog=js(E.value), cog=js(E.value), navStat=js(E.event_id % 3))
        ),
        geometry=obj(coordinates=F.when(E.k == 98, arr(js(E.lon))).otherwise(arr(js(E.lon), js(E.lat)))),
    )


def mixed_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four vessel feeds in one stream, by event type; the fifth type is a feed without state."""
    payload = (
        F.when(E.event_type == "signup", _static())
        .when(E.event_type == "click", _position())
        .when(E.event_type == "purchase", obj(data=arr(_marinesia_record())))
        .when(E.event_type == "view", obj(features=arr(_digitraffic_record())))
        .otherwise(arr(obj(), arr(obj(MMSI=js(E.user_id), NAME=raw('"HUB"')))))
    )
    source = (
        F.when(E.event_type == "purchase", "marinesia")
        .when(E.event_type == "view", "digitraffic")
        .when(E.event_type == "error", "aishub")
        .otherwise("ais_stream")
    )
    return single(events(spark, sf_dir), "event_id", payload, source)


MIXED_SOURCES = {"ais_stream": "ais", "marinesia": "marinesia", "digitraffic": "digitraffic", "aishub": "aishub"}

MARINESIA_TYPE = "CASE k % 6 WHEN 0 THEN 70 WHEN 1 THEN 80 WHEN 2 THEN 60 WHEN 3 THEN 30 WHEN 4 THEN 37 ELSE 0 END"
MARINESIA_NAME = "CASE WHEN k < 10 THEN 'Unknown' WHEN k < 30 THEN '' ELSE 'M ' || k END"
MARINESIA_DEST = "CASE WHEN k < 50 THEN 'DEST ' || k ELSE 'Unknown' END"

# Updates in SQL; `is_ais` makes every event but `signup` an AIS position.
def updates_sql(mixed: bool) -> str:
    act = (
        "CASE event_type WHEN 'signup' THEN 'set' WHEN 'purchase' THEN 'set' WHEN 'view' THEN 'dummy' "
        "WHEN 'click' THEN CASE WHEN k < 30 THEN 'none' ELSE 'name' END END"
        if mixed
        else "CASE WHEN event_type = 'signup' THEN 'set' WHEN k < 30 THEN 'none' ELSE 'name' END"
    )
    where = "event_type <> 'error' AND NOT (event_type = 'view' AND k = 98)" if mixed else "TRUE"
    marinesia = "event_type = 'purchase'" if mixed else "FALSE"
    digitraffic = "event_type = 'view'" if mixed else "FALSE"
    return f"""{EVENTS_SQL}, u AS (
  SELECT event_id, ts, value, event_type, k, {act} AS act, event_type <> 'signup' AS live,
         CASE WHEN {digitraffic} AND k = 99 THEN 0 ELSE user_id END AS mmsi,
         CASE WHEN {marinesia} THEN 'marinesia' WHEN {digitraffic} THEN 'digitraffic' ELSE 'ais_stream' END AS source,
         lat, CASE WHEN {marinesia} AND k > 95 THEN 0.0 ELSE lon END AS lon,
         CASE WHEN {marinesia} THEN CASE WHEN k > 80 THEN 15 ELSE event_id % 3 END
              WHEN {digitraffic} THEN CASE WHEN k = 99 THEN 15 ELSE event_id % 3 END
              ELSE CASE WHEN k > 90 THEN 15 ELSE event_id % 3 END END AS nav,
         CASE WHEN {marinesia} THEN {MARINESIA_NAME}
              WHEN {digitraffic} THEN NULL
              WHEN event_type = 'signup' THEN CASE WHEN k < 10 THEN 'Unknown' WHEN k < 20 THEN '' ELSE 'VESSEL ' || k END
              WHEN k < 30 THEN NULL WHEN k < 50 THEN 'Unknown' ELSE 'SHIP ' || k END AS name,
         CASE WHEN {marinesia} THEN {MARINESIA_TYPE} WHEN event_type = 'signup' THEN 60 + k % 40 END AS ship_type,
         CASE WHEN {marinesia} THEN {MARINESIA_DEST}
              WHEN event_type = 'signup' THEN CASE WHEN k < 5 THEN 'Unknown' ELSE 'PORT ' || k END END AS destination
  FROM e WHERE {where}),
o AS (SELECT *, row_number() OVER (PARTITION BY mmsi ORDER BY event_id) AS rn FROM u)"""


# The state row by row, as a recursive query: independent of how the library finds it.
def fold_sql(mixed: bool) -> str:
    def step(name: str, kind: str, dest: str) -> str:
        blank = f"{name} IN ('', 'Unknown')"
        return f"""
      CASE WHEN o.act = 'set' THEN o.name WHEN o.act = 'name' AND {blank} THEN o.name
           WHEN o.act = 'dummy' AND {blank} THEN 'Baltic Vessel' ELSE {name} END AS s_name,
      CAST(CASE WHEN o.act = 'set' THEN o.ship_type WHEN o.act = 'dummy' AND {blank} THEN 80 ELSE {kind} END AS BIGINT) AS s_type,
      CASE WHEN o.act = 'set' THEN o.destination WHEN o.act = 'dummy' AND {blank} THEN 'Unknown' ELSE {dest} END AS s_dest"""

    return f"""WITH RECURSIVE {updates_sql(mixed)},
f AS (
  SELECT o.mmsi, o.rn, {step("''", "0", "''")} FROM o WHERE o.rn = 1
  UNION ALL
  SELECT o.mmsi, o.rn, {step("f.s_name", "f.s_type", "f.s_dest")} FROM f JOIN o ON o.mmsi = f.mmsi AND o.rn = f.rn + 1)"""


def state_sql(mixed: bool) -> str:
    return f"""{fold_sql(mixed)},
last AS (SELECT mmsi, arg_max(s_name, rn) AS name, arg_max(s_type, rn) AS ship_type, arg_max(s_dest, rn) AS destination FROM f GROUP BY mmsi),
live AS (SELECT mmsi, max(CAST(floor(epoch(ts)) AS BIGINT)) AS last_seen, arg_max(lat, event_id) AS latitude,
                arg_max(lon, event_id) AS longitude, arg_max(nav, event_id) AS nav_status FROM o WHERE live GROUP BY mmsi),
state AS (
  SELECT last.mmsi, name, ship_type, destination, coalesce(last_seen, 0) AS last_seen, coalesce(latitude, 0.0) AS latitude,
         coalesce(longitude, 0.0) AS longitude, CAST(coalesce(nav_status, 0) AS BIGINT) AS nav_status
  FROM last LEFT JOIN live USING (mmsi))"""


def _enriched_sql(mixed: bool, where: str = "TRUE", extra: str = "") -> str:
    return f"""{fold_sql(mixed)}
SELECT o.event_id AS seq, o.mmsi, o.lat AS latitude, o.lon AS longitude,
       CASE WHEN o.source = 'digitraffic' AND k = 99 THEN NULL ELSE o.value END AS sog,
       CASE WHEN o.source = 'ais_stream' THEN CAST(90 AS DOUBLE) WHEN o.source = 'digitraffic' AND k < 99 THEN o.value END AS cog,
       CAST(o.nav AS BIGINT) AS nav_status,
       CASE WHEN o.source = 'digitraffic' THEN s_name WHEN o.source = 'ais_stream' AND k >= 50 THEN 'SHIP ' || k || ' ' ELSE o.name END AS name,
       s_type AS ship_type, s_dest AS destination{extra}
FROM o JOIN f ON f.mmsi = o.mmsi AND f.rn = o.rn WHERE o.live AND {where}"""


ROW = ["seq", "mmsi", "latitude", "longitude", "sog", "cog", "nav_status", "name", "ship_type", "destination"]


@query("feed_ais", _enriched_sql(False))
def feed_ais(spark: SparkSession, sf_dir: str) -> DataFrame:
    return polls.poll(ais_payloads(spark, sf_dir), {"ais_stream": "ais"})["ais_stream"].select(ROW)


@query("ais_enriched", _enriched_sql(False, extra=", s_name AS known_name"))
def ais_enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vessels.enriched(vessels.ais_updates(ais_payloads(spark, sf_dir))).select(*ROW, "known_name")


@query("feed_marinesia", f"""WITH {EVENTS_SQL}
SELECT seq, pos, user_id AS mmsi, lat AS latitude, CASE WHEN k > 95 THEN 0.0 ELSE lon END AS longitude, value AS sog,
       CAST(NULL AS DOUBLE) AS cog, CAST(CASE WHEN k > 80 THEN 15 ELSE event_id % 3 END AS BIGINT) AS nav_status,
       {MARINESIA_NAME} AS name, CAST({MARINESIA_TYPE} AS BIGINT) AS ship_type, {MARINESIA_DEST} AS destination
FROM e""")
def feed_marinesia(spark: SparkSession, sf_dir: str) -> DataFrame:
    payloads = pages_of(
        events(spark, sf_dir), "event_id", _marinesia_record(), "marinesia", '{"data":[', "]}"
    )
    return vessels.marinesia(payloads).drop("source", "fetched_at")


@query("feed_digitraffic", _enriched_sql(True, "o.source = 'digitraffic'"))
def feed_digitraffic(spark: SparkSession, sf_dir: str) -> DataFrame:
    return polls.poll(mixed_payloads(spark, sf_dir), MIXED_SOURCES)["digitraffic"].select(ROW)


@query("feed_aishub", f"""WITH {EVENTS_SQL}
SELECT seq, pos, CASE WHEN event_type <> 'error' THEN user_id END AS mmsi, lat AS latitude, lon AS longitude, value AS sog,
       CAST(k AS DOUBLE) AS cog, CASE WHEN event_type <> 'view' THEN 'E' || event_id END AS name,
       CASE WHEN event_type <> 'error' THEN CAST(k AS BIGINT) END AS ship_type, event_type AS destination FROM e""")
def feed_aishub(spark: SparkSession, sf_dir: str) -> DataFrame:
    broken = E.event_type == "error"
    record = obj(
        MMSI=F.when(broken, raw('"x"')).otherwise(js(E.user_id)), LATITUDE=js(E.lat), LONGITUDE=js(E.lon),
        SOG=js(E.value), COG=js(E.k), NAME=F.when(E.event_type == "view", raw("1")).otherwise(js(E.label)),
        TYPE=F.when(broken, raw("1.0")).otherwise(js(E.k)), DEST=js(E.event_type),
    )
    payloads = pages_of(events(spark, sf_dir), "event_id", record, "aishub", '[{"ERROR":false},[', "]]")
    return feeds.extract(payloads, feeds.FEEDS["aishub"]).drop("source", "fetched_at")


@query("mixed_enriched", _enriched_sql(True, extra=", o.source, s_name AS known_name"))
def mixed_enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    updates = polls.vessel_updates(mixed_payloads(spark, sf_dir), MIXED_SOURCES)
    return vessels.enriched(updates).select(*ROW, "source", "known_name")


@query("vessel_state", f"{state_sql(False)} SELECT * FROM state")
def vessel_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vessels.vessel_state(vessels.ais_updates(ais_payloads(spark, sf_dir)))


@query("vessel_state_mixed", f"{state_sql(True)} SELECT * FROM state")
def vessel_state_mixed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vessels.vessel_state(polls.vessel_updates(mixed_payloads(spark, sf_dir), MIXED_SOURCES))


@query("dark_vessels", f"""{state_sql(False)}
SELECT mmsi, latitude, longitude, name, ship_type FROM state
WHERE ship_type BETWEEN 70 AND 89 AND nav_status = 0 AND latitude <> 0 AND longitude <> 0
  AND (SELECT CAST(floor(epoch(max(ts))) AS BIGINT) FROM events) - last_seen > 180""")
def dark_vessels(spark: SparkSession, sf_dir: str) -> DataFrame:
    now = events(spark, sf_dir).agg(F.max("ts").alias("now")).scalar()
    return vessels.dark_vessels(vessel_state(spark, sf_dir), now, TIMEOUT_HOURS)


@query("latest_vessels", f"""{_enriched_sql(False)}
QUALIFY row_number() OVER (PARTITION BY o.mmsi ORDER BY o.event_id DESC) = 1""")
def latest_vessels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vessels.latest(vessels.enriched(vessels.ais_updates(ais_payloads(spark, sf_dir)))).select(ROW)


@query("cargo_tankers", f"""SELECT * FROM ({_enriched_sql(False)}
QUALIFY row_number() OVER (PARTITION BY o.mmsi ORDER BY o.event_id DESC) = 1) WHERE ship_type BETWEEN 70 AND 89""")
def cargo_tankers(spark: SparkSession, sf_dir: str) -> DataFrame:
    reports = vessels.last_reports(vessels.ais_updates(ais_payloads(spark, sf_dir)))
    return reports.where(vessels.is_cargo_or_tanker()).select(ROW)


@query("bbox_filter", f"""WITH {EVENTS_SQL}
SELECT event_id AS seq, user_id AS mmsi, lat AS latitude, lon AS longitude FROM e
WHERE event_type <> 'signup'
  AND ((lat BETWEEN 10 AND 45 AND lon BETWEEN -60 AND 20.5) OR (lat BETWEEN -90 AND -30.25 AND lon BETWEEN 0 AND 180))""")
def bbox_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = vessels.ais_updates(ais_payloads(spark, sf_dir)).where("live")
    boxes = [(10.0, -60.0, 45.0, 20.5), (-90.0, 0.0, -30.25, 180.0)]
    return vessels.in_boxes(rows, boxes).select("seq", "mmsi", "latitude", "longitude")


@query("message_type_filter", """
SELECT event_id AS seq, 'ais_stream' AS source FROM events WHERE event_type = 'signup'""")
def message_type_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vessels.of_message_types(ais_payloads(spark, sf_dir), ["ShipStaticData"]).select("seq", "source")
