"""Feed jobs over payloads derived from the driver's tables.

Wrong cells are part of the payloads, by event type: `error` has an object in a
numeric place, `view` a number in a text place, `signup` is no object at all. The SQL
gives the expected rows straight from the tables.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from beaconlake.operators import dynamic, feeds, rss, tle
from beaconlake.plans.tables import (
    EVENTS_SQL, PAGE, arr, events, js, obj, pages_of, query, raw, single, table,
)

class _EventColumns:
    """Columns of the events table by name; `label` is made of the id."""

    def __getattr__(self, name: str) -> Column:
        if name == "label":
            return F.concat(F.lit("E"), F.col("event_id").cast("string"))
        return F.col(name)


E = _EventColumns()
NUMBER_BROKEN, TEXT_BROKEN, NO_OBJECT = "error", "view", "signup"

LABEL_SQL = "'E' || event_id"


def num(value: Column) -> Column:
    return F.when(E.event_type == NUMBER_BROKEN, raw("{}")).otherwise(js(value))


def txt(value: Column) -> Column:
    return F.when(E.event_type == TEXT_BROKEN, raw("17")).otherwise(js(value))


def element(record: Column) -> Column:
    return F.when(E.event_type == NO_OBJECT, E.event_id.cast("string")).otherwise(record)


def as_text(value: Column) -> Column:
    return value.cast("string")


# Column expressions of the expected rows: value, null on a broken number or text, null on a non-object.
def n_sql(value: str) -> str:
    return f"CASE WHEN event_type NOT IN ('error', 'signup') THEN {value} END"


def t_sql(value: str) -> str:
    return f"CASE WHEN event_type NOT IN ('view', 'signup') THEN {value} END"


def o_sql(value: str) -> str:
    return f"CASE WHEN event_type <> 'signup' THEN {value} END"


def expected(columns: str, where: str = "TRUE") -> str:
    return f"WITH {EVENTS_SQL} SELECT seq, pos, {columns} FROM e WHERE {where}"


def paged(name: str, record: Callable[[], Column], prefix: str, suffix: str):
    """A feed job over pages of event records."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        payloads = pages_of(events(spark, sf_dir), "event_id", element(record()), name, prefix, suffix)
        return feeds.extract(payloads, feeds.FEEDS[name]).drop("source", "fetched_at")

    return run



query("feed_polymarket", expected(f"{t_sql(LABEL_SQL)} AS title, {n_sql('value')} AS volume"))(
    paged("polymarket", lambda: obj(title=txt(E.label), volume=num(E.value)), "[", "]")
)

query("feed_cloudflare", expected(
    f"{n_sql('event_id')} AS asn, {t_sql('event_type')} AS leak_type, {o_sql('CAST(user_id AS VARCHAR)')} AS country_code"
))(
    paged(
        "cloudflare",
        lambda: obj(asn=num(E.event_id), leak_type=txt(E.event_type), country_code=js(as_text(F.col("user_id")))),
        '{"result":{"events":[', "]}}",
    )
)

query("feed_firms", expected(
    f"{o_sql('lat')} AS latitude, {o_sql('lon')} AS longitude, {n_sql('value')} AS brightness, {t_sql('event_type')} AS confidence"
))(
    paged("firms", lambda: obj(latitude=js(E.lat), longitude=js(E.lon), bright_ti4=num(E.value), confidence=txt(E.event_type)), "[", "]")
)

query("feed_ucdp", expected(
    f"{o_sql('event_id')} AS id, {t_sql(LABEL_SQL)} AS conflict_name, {o_sql('lat')} AS latitude, "
    f"{o_sql('lon')} AS longitude, {n_sql('k')} AS deaths"
))(
    paged(
        "ucdp",
        lambda: obj(id=js(E.event_id), conflict_name=txt(E.label), latitude=js(E.lat), longitude=js(E.lon), best=num(E.k)),
        '{"TotalCount":0,"Result":[', "]}",
    )
)

query("feed_feodo", expected(
    f"{t_sql(chr(39) + '10.0.0.' + chr(39) + ' || k')} AS ip_address, {n_sql('8000 + k')} AS port, {o_sql('event_type')} AS malware"
))(
    paged(
        "feodo",
        lambda: obj(ip_address=txt(F.concat(F.lit("10.0.0."), as_text(E.k))), port=num(E.k + 8000), malware=js(E.event_type)),
        "[", "]",
    )
)

query("feed_ransomware", expected(
    f"{o_sql('event_type')} AS group_name, {t_sql(LABEL_SQL)} AS victim, {o_sql('strftime(ts, ' + chr(39) + '%Y-%m-%d' + chr(39) + ')')} AS published"
))(
    paged(
        "ransomware",
        lambda: obj(group_name=js(E.event_type), post_title=txt(E.label), published=js(F.date_format("ts", "yyyy-MM-dd"))),
        "[", "]",
    )
)

query("feed_nga", expected(f"{o_sql('event_type')} AS \"navArea\", {t_sql(LABEL_SQL)} AS text"))(
    paged("nga", lambda: obj(navArea=js(E.event_type), text=txt(E.label)), '{"broadcast-warn":[', "]}")
)

query("feed_acled", expected(
    f"{t_sql(LABEL_SQL)} AS event_id_cnty, {o_sql('event_type')} AS event_type, {o_sql('lat')} AS latitude, "
    f"{o_sql('lon')} AS longitude, {n_sql('k')} AS fatalities"
))(
    paged(
        "acled",
        lambda: obj(
            event_id_cnty=txt(E.label), event_type=js(E.event_type), latitude=js(as_text(E.lat)), longitude=js(as_text(E.lon)),
            fatalities=num(as_text(E.k)),
        ),
        '{"status":200,"data":[', "]}",
    )
)

query("feed_gdelt", expected(
    f"{t_sql(LABEL_SQL)} AS name, {o_sql('event_type')} AS url, {n_sql('lon')} AS longitude, {n_sql('lat')} AS latitude"
))(
    paged(
        "gdelt",
        lambda: obj(
            type=raw('"Feature"'), properties=obj(name=txt(E.label), url=js(E.event_type)),
            geometry=obj(type=raw('"Point"'), coordinates=arr(num(E.lon), num(E.lat))),
        ),
        '{"type":"FeatureCollection","features":[', "]}",
    )
)

query("feed_eonet", expected(
    f"{t_sql(LABEL_SQL)} AS title, {o_sql('event_type')} AS category, {n_sql('lon')} AS longitude, {n_sql('lat')} AS latitude"
))(
    paged(
        "eonet",
        lambda: obj(
            title=txt(E.label), categories=arr(obj(title=js(E.event_type)), raw('{"title":"other"}')),
            geometry=arr(obj(coordinates=arr(num(E.lon), num(E.lat)))),
        ),
        '{"events":[', "]}",
    )
)


def usgs_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    record = obj(
        properties=obj(place=txt(E.label), mag=num(E.value)),
        geometry=F.when(E.event_type == "click", raw("null")).otherwise(obj(coordinates=arr(js(E.lon), js(E.lat), raw("10.0")))),
    )
    return pages_of(events(spark, sf_dir), "event_id", element(record), "usgs", '{"features":[', "]}")


USGS_LOCATED = "event_type NOT IN ('click', 'signup')"


@query("feed_usgs", expected(
    f"{t_sql(LABEL_SQL)} AS place, {n_sql('value')} AS magnitude, CASE WHEN {USGS_LOCATED} THEN lon END AS longitude, "
    f"CASE WHEN {USGS_LOCATED} THEN lat END AS latitude"
))
def feed_usgs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return feeds.extract(usgs_payloads(spark, sf_dir), feeds.FEEDS["usgs"]).drop("source", "fetched_at")


query("feed_urlhaus", expected(
    f"{n_sql('event_id')} AS id, {t_sql(LABEL_SQL)} AS url, {o_sql('event_type')} AS status"
))(
    paged(
        "urlhaus",
        # the id comes as a number or as text
        lambda: obj(
            id=F.when(E.event_type == "click", js(as_text(E.event_id))).otherwise(num(E.event_id)), url=txt(E.label), url_status=js(E.event_type)
        ),
        '{"urls":[', "]}",
    )
)

def fred_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    value = F.when(E.event_type == "error", raw('"."')).when(E.event_type == "view", raw("5"))
    record = obj(date=js(F.date_format("ts", "yyyy-MM-dd")), value=value.otherwise(js(as_text(E.value))))
    return pages_of(events(spark, sf_dir), "event_id", record, "fred", '{"observations":[', "]}")


FRED_SQL = expected(
    "strftime(ts, '%Y-%m-%d') AS date, CASE WHEN event_type NOT IN ('error', 'view') THEN value END AS value"
)


@query("feed_fred", FRED_SQL)
def feed_fred(spark: SparkSession, sf_dir: str) -> DataFrame:
    return feeds.extract(fred_payloads(spark, sf_dir), feeds.FEEDS["fred"]).drop("source", "fetched_at")


query("feed_unhcr", expected(
    f"{t_sql('event_type')} AS origin, {o_sql('CAST(user_id AS VARCHAR)')} AS destination, {n_sql('event_id * 1000')} AS population, "
    f"{o_sql('strftime(ts, ' + chr(39) + '%Y' + chr(39) + ')')} AS date"
))(
    paged(
        "unhcr",
        lambda: obj(
            origin=txt(E.event_type), destination=js(as_text(F.col("user_id"))), population=num(E.event_id * 1000),
            date=js(F.date_format("ts", "yyyy")),
        ),
        '{"items":[', "]}",
    )
)


def opensky_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    seconds = F.unix_timestamp("ts")
    state = arr(
        js(E.label), txt(F.concat(F.lit(" F"), as_text(E.k), F.lit("  "))), js(E.event_type), js(seconds), num(seconds), js(E.lon), js(E.lat)
    )
    record = F.when(E.event_type == NO_OBJECT, obj(state=state)).otherwise(state)
    return pages_of(events(spark, sf_dir), "event_id", record, "opensky", '{"time":1,"states":[', "]}")


@query("feed_opensky", expected(
    f"{LABEL_SQL} AS icao24, {t_sql(chr(39) + 'F' + chr(39) + ' || k')} AS callsign, event_type AS origin_country, "
    f"CAST(floor(epoch(ts)) AS BIGINT) AS time_position, {n_sql('CAST(floor(epoch(ts)) AS BIGINT)')} AS last_contact, "
    "lon AS longitude, lat AS latitude",
    "event_type <> 'signup'",
))
def feed_opensky(spark: SparkSession, sf_dir: str) -> DataFrame:
    return feeds.extract(opensky_payloads(spark, sf_dir), feeds.FEEDS["opensky"]).drop("source", "fetched_at")


# -- feeds whose payload is one record


@query("feed_binance", f"""WITH {EVENTS_SQL}
SELECT event_id AS seq, CASE WHEN event_type <> 'error' THEN value END AS price,
       CASE WHEN event_type <> 'view' THEN CAST(k AS DOUBLE) END AS quantity FROM e""")
def feed_binance(spark: SparkSession, sf_dir: str) -> DataFrame:
    trade = obj(p=num(as_text(E.value)), q=txt(as_text(E.k)))
    payloads = single(events(spark, sf_dir), "event_id", trade, "binance")
    return feeds.extract(payloads, feeds.FEEDS["binance"]).select("seq", "price", "quantity")


@query("feed_oref", f"""WITH {EVENTS_SQL}
SELECT event_id AS seq, CAST(event_id AS VARCHAR) AS id, CASE WHEN event_type <> 'view' THEN event_type END AS title,
       CASE WHEN event_type = 'error' THEN NULL WHEN event_type = 'signup' THEN ''
            ELSE event_type || ', City ' || k END AS cities FROM e""")
def feed_oref(spark: SparkSession, sf_dir: str) -> DataFrame:
    cities = arr(js(E.event_type), raw("5"), raw("null"), js(F.concat(F.lit("City "), as_text(E.k))))
    cities = F.when(E.event_type == "error", raw('"none"')).when(E.event_type == "signup", raw("[]")).otherwise(cities)
    payloads = single(
        events(spark, sf_dir), "event_id", obj(id=js(as_text(E.event_id)), title=txt(E.event_type), data=cities), "oref"
    )
    return feeds.extract(payloads, feeds.FEEDS["oref"]).select("seq", "id", "title", "cities")


@query("feed_meteo", f"""WITH {EVENTS_SQL}
SELECT event_id AS seq, lat AS latitude, lon AS longitude,
       CASE WHEN event_type <> 'error' THEN value END AS temperature FROM e""")
def feed_meteo(spark: SparkSession, sf_dir: str) -> DataFrame:
    weather = obj(latitude=js(E.lat), longitude=js(E.lon), current_weather=obj(temperature=num(E.value)))
    payloads = single(events(spark, sf_dir), "event_id", weather, "open_meteo")
    return feeds.extract(payloads, feeds.FEEDS["meteo"]).select("seq", "latitude", "longitude", "temperature")


@query("feed_messages", """
SELECT conv_id * 1000 + turn AS seq, turn AS message_id, 'c' || conv_id AS channel, text,
       CASE WHEN role = 'system' THEN NULL ELSE 1710760000 + turn END AS date,
       CASE WHEN role = 'user' THEN 'photo/' || turn || '.jpg' ELSE '' END AS media
FROM conversations""")
def feed_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").withColumn("seq", F.col("conv_id") * 1000 + F.col("turn"))
    date = F.when(F.col("role") == "system", raw('"unknown"')).otherwise(js(F.lit(1710760000) + F.col("turn")))
    media = F.when(F.col("role") == "user", js(F.concat(F.lit("photo/"), F.col("turn").cast("string"), F.lit(".jpg"))))
    record = obj(
        message_id=js("turn"), channel=js(F.concat(F.lit("c"), F.col("conv_id").cast("string"))), text=js("text"),
        date=date, media=F.coalesce(media, raw("null")),
    )
    at = F.timestamp_seconds(F.lit(1710760000) + F.col("turn"))
    payloads = single(rows.withColumn("at", at), "seq", record, "tg_all", "at")
    return feeds.extract(payloads, feeds.FEEDS["messages"]).select(
        "seq", "message_id", "channel", "text", "date", "media"
    )


# -- feeds of another shape


@query("feed_coingecko", f"""
SELECT p_partkey // {PAGE} AS seq, p_name || ' ' || lpad(CAST(p_partkey AS VARCHAR), 9, '0') AS coin,
       CASE WHEN p_type <> 'ECONOMY' THEN p_retailprice END AS price_usd FROM part""")
def feed_coingecko(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part")
    coin = F.concat_ws(" ", "p_name", F.lpad(F.col("p_partkey").cast("string"), 9, "0"))
    quote = F.when(F.col("p_type") == "ECONOMY", raw("1")).otherwise(obj(usd=js("p_retailprice")))
    rows = part.withColumn("at", F.timestamp_seconds(F.lit(0)))
    payloads = pages_of(
        rows, "p_partkey", F.concat(js(coin), F.lit(":"), quote), "coingecko", "{", "}", fetched_at="at"
    )
    return feeds.coingecko(payloads).select("seq", "coin", "price_usd")


DYNAMIC_SQL = f"""
SELECT o_orderkey // {PAGE} AS seq, o_orderkey AS orderkey, o_totalprice AS price, o_orderpriority AS priority,
       o_orderstatus = 'F' AS done, strftime(o_orderdate, '%Y-%m-%d') AS day
FROM orders"""


def order_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order records under the root or one of the known keys, in turn; a non-object follows every record."""
    orders = table(spark, sf_dir, "orders")
    record = F.to_json(
        F.struct(
            F.col("o_orderkey").alias("orderkey"), F.col("o_totalprice").alias("price"),
            F.col("o_orderpriority").alias("priority"), (F.col("o_orderstatus") == "F").alias("done"),
            F.date_format("o_orderdate", "yyyy-MM-dd").alias("day"),
        )
    )
    pages = pages_of(orders, "o_orderkey", F.concat(record, F.lit(",7")), "dynamic", fetched_at="o_orderdate")
    keys = F.array(*[F.lit(key) for key in ("", *dynamic.RECORD_KEYS)])
    key = F.get(keys, (F.col("seq") % (len(dynamic.RECORD_KEYS) + 1)).cast("int"))
    under = F.concat(F.lit('{"meta":1,"'), key, F.lit('":'), F.col("payload"), F.lit("}"))
    return pages.withColumn("payload", F.when(key == "", F.col("payload")).otherwise(under))


@query("feed_dynamic", DYNAMIC_SQL)
def feed_dynamic(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = dynamic.extract(order_payloads(spark, sf_dir))
    return rows.select("seq", "orderkey", "price", "priority", "done", "day")


def element_set_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Element lines made from suppliers: near-earth and deep-space orbits of many shapes."""
    s = table(spark, sf_dir, "supplier").withColumn("k", F.col("s_suppkey"))
    names = F.array(*[F.lit(n) for n in ("Yaogan", "COSMOS 2", "NOAA", "Sentinel", "ISS")])
    name = F.concat(F.get(names, (F.col("k") % 5).cast("int")), F.lit(" "), F.col("k").cast("string"))
    number = F.lpad((F.col("k") % 100000).cast("string"), 5, "0")

    def fixed(value: Column, before: int, after: int) -> Column:
        return F.lpad(F.format_string(f"%.{after}f", value), before + 1 + after, " ")

    # Every eighth orbit is a day or half a day long, some of the latter very eccentric.
    slow = F.col("k") % 8
    motion = F.when(slow == 1, 1.0027).when(slow == 2, 2.0056).otherwise(12.0 + (F.col("k") % 37) / F.lit(10.0))
    eccentricity = F.when((slow == 2) & (F.col("k") % 3 == 0), 6900000).otherwise(F.col("k") * 7919 % 90000)
    body1 = F.concat(
        F.lit("1 "), number, F.lit("U 98067A   24"), fixed(1 + F.col("k") % 30 + (F.col("k") % 97) / F.lit(100.0), 3, 8),
        F.lit("  .00000100  00000-0  12345-4 0  999"),
    )
    body2 = F.concat(
        F.lit("2 "), number, F.lit(" "), fixed((F.col("k") * 13 % 17900) / F.lit(100.0) + 0.5, 3, 4), F.lit(" "),
        fixed((F.col("k") * 29 % 36000) / F.lit(100.0), 3, 4), F.lit(" "),
        F.lpad(eccentricity.cast("string"), 7, "0"), F.lit(" "),
        fixed((F.col("k") * 31 % 36000) / F.lit(100.0), 3, 4), F.lit(" "),
        fixed((F.col("k") * 37 % 36000) / F.lit(100.0), 3, 4), F.lit(" "), fixed(motion, 2, 8), F.lit("    1"),
    )
    return s.select(
        F.col("s_suppkey").alias("key"), F.col("s_nationkey").alias("nation"), name.alias("name"),
        _checked(body1).alias("line1"), _checked(body2).alias("line2"), F.timestamp_seconds(F.lit(0)).alias("at"),
    )


def _checked(body: Column) -> Column:
    """Line with its checksum digit."""
    total = F.aggregate(
        F.regexp_extract_all(body, F.lit("([0-9-])"), F.lit(1)), F.lit(0),
        lambda sum_, c: sum_ + F.when(c == "-", 1).otherwise(c.try_cast("int")),
    )
    return F.concat(body, (total % 10).cast("string"))


def element_set_payloads(spark: SparkSession, sf_dir: str, source: str = "celestrak_military") -> DataFrame:
    rows = element_set_rows(spark, sf_dir)
    block = F.concat_ws("\r\n", "name", "line1", F.concat(F.col("line2"), F.lit("\r\n")))
    return pages_of(rows, "key", block, source, "", "TAIL", fetched_at="at", separator="\n")


# Numbers of the element lines, as SQL over supplier.
TLE_SQL = f"""s AS (
  SELECT s_suppkey AS k, s_suppkey // {PAGE} AS seq,
         CAST(row_number() OVER (PARTITION BY s_suppkey // {PAGE} ORDER BY s_suppkey) - 1 AS INTEGER) AS pos,
         list_extract(['Yaogan', 'COSMOS 2', 'NOAA', 'Sentinel', 'ISS'], CAST(s_suppkey % 5 + 1 AS INTEGER)) || ' ' || s_suppkey AS object_name,
         lpad(CAST(s_suppkey % 100000 AS VARCHAR), 5, '0') AS object_id,
         1 + s_suppkey % 30 + (s_suppkey % 97) / 100.0 AS epoch_day_of_year,
         (s_suppkey * 13 % 17900) / 100.0 + 0.5 AS inclination_deg,
         (s_suppkey * 29 % 36000) / 100.0 AS raan_deg,
         (s_suppkey * 31 % 36000) / 100.0 AS arg_perigee_deg,
         (s_suppkey * 37 % 36000) / 100.0 AS mean_anomaly_deg,
         CASE s_suppkey % 8 WHEN 1 THEN 1.0027 WHEN 2 THEN 2.0056 ELSE 12.0 + (s_suppkey % 37) / 10.0 END AS mean_motion,
         CASE WHEN s_suppkey % 8 = 2 AND s_suppkey % 3 = 0 THEN 6900000 ELSE s_suppkey * 7919 % 90000 END AS ecc7
  FROM supplier)"""


def _fixed_sql(value: str, width: int, digits: int) -> str:
    return f"lpad(printf('%.{digits}f', CAST({value} AS DOUBLE)), {width}, ' ')"


def _checked_sql(body: str) -> str:
    digits = f"list_sum(list_transform(regexp_extract_all({body}, '[0-9]'), lambda d: CAST(d AS INTEGER)))"
    return f"{body} || CAST(({digits} + length({body}) - length(replace({body}, '-', ''))) % 10 AS VARCHAR)"


@query("feed_tle", f"""WITH {TLE_SQL}, b AS (SELECT seq, pos, object_name, object_id,
  '1 ' || object_id || 'U 98067A   24' || {_fixed_sql("epoch_day_of_year", 12, 8)} || '  .00000100  00000-0  12345-4 0  999' AS body1,
  '2 ' || object_id || ' ' || {_fixed_sql("inclination_deg", 8, 4)} || ' ' || {_fixed_sql("raan_deg", 8, 4)} || ' '
    || lpad(CAST(ecc7 AS VARCHAR), 7, '0') || ' ' || {_fixed_sql("arg_perigee_deg", 8, 4)} || ' '
    || {_fixed_sql("mean_anomaly_deg", 8, 4)} || ' ' || {_fixed_sql("mean_motion", 11, 8)} || '    1' AS body2 FROM s)
SELECT seq, pos, object_name, object_id, {_checked_sql("body1")} AS tle_line1, {_checked_sql("body2")} AS tle_line2 FROM b""")
def feed_tle(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = tle.extract(element_set_payloads(spark, sf_dir))
    return rows.select("seq", "pos", "object_name", "object_id", "tle_line1", "tle_line2")


@query("tle_elements", f"""WITH {TLE_SQL}
SELECT object_id, object_name, CAST(object_id AS INTEGER) AS norad_id, 2024 AS epoch_year,
       round(epoch_day_of_year, 8) AS epoch_day_of_year,
       0.000012345 AS bstar, round(inclination_deg, 4) AS inclination_deg, round(raan_deg, 4) AS raan_deg,
       round(ecc7 / 10000000.0, 7) AS eccentricity, round(arg_perigee_deg, 4) AS arg_perigee_deg,
       round(mean_anomaly_deg, 4) AS mean_anomaly_deg, CAST(mean_motion AS DOUBLE) AS mean_motion, TRUE AS usable
FROM s""".replace("0.000012345 AS", "CAST(0.000012345 AS DOUBLE) AS"))
def tle_elements(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = tle.elements(tle.extract(element_set_payloads(spark, sf_dir)))
    return rows.select(
        "object_id", "object_name", "norad_id", "epoch_year", "epoch_day_of_year", "bstar", "inclination_deg",
        "raan_deg", "eccentricity", "arg_perigee_deg", "mean_anomaly_deg", "mean_motion", "usable",
    )


@query("intel_satellites", f"""WITH {TLE_SQL}
SELECT source, seq, pos, object_name, object_id
FROM s, (SELECT unnest(['celestrak_military', 'celestrak_resource']) AS source)
WHERE k % 5 IN (0, 1, 3)""")
def intel_satellites(spark: SparkSession, sf_dir: str) -> DataFrame:
    sets = [
        tle.extract(element_set_payloads(spark, sf_dir, source)) for source in ("celestrak_military", "celestrak_resource")
    ]
    return tle.intel_satellites(*sets).select("source", "seq", "pos", "object_name", "object_id")


# -- news

NEWS_SQL = """n AS (
  SELECT doc_id, doc_id // 20 AS seq,
         CAST(row_number() OVER (PARTITION BY doc_id // 20 ORDER BY doc_id) - 1 AS INTEGER) AS pos,
         'Doc <' || doc_id || '> & ' || source AS title,
         'https://news.example.com/' || lang || '?id=' || doc_id || '&ref=x' AS link,
         '2024-01-' || lpad(CAST(doc_id % 28 + 1 AS VARCHAR), 2, '0') AS "pubDate",
         text, lang, source
  FROM documents)"""


def news_payloads(spark: SparkSession, sf_dir: str, broken: bool = False) -> DataFrame:
    """RSS with escaped titles, whole documents as CDATA, repeated and nested tags, comments; some items with errors if `broken`."""
    docs = table(spark, sf_dir, "documents").withColumn("at", F.timestamp_seconds(F.lit(0)))
    key = F.col("doc_id").cast("string")
    item = F.concat(
        F.lit("<item>\n <title>Doc &lt;"), key, F.lit("&gt; &#38; <!-- "), key, F.lit(" --></title><title>"),
        F.lit("<![CDATA[ ]]>"), "source", F.lit("</title>\n <link>https://news.example.com/"), "lang", F.lit("?id="),
        key, F.lit("&amp;ref=x</link><pubDate>2024-01-"),
        F.lpad((F.col("doc_id") % 28 + 1).cast("string"), 2, "0"),
        F.lit("</pubDate>\n<description><![CDATA["), "text", F.lit("]]></description>"),
        F.lit("<dc:Lang>zz</dc:Lang><dc:Lang>"), "lang", F.lit("</dc:Lang><media:thumbnail url='x'/>"),
        F.lit("<category domain='d'>"), "source", F.lit("<sub>"), key, F.lit("</sub>lost</category>"),
        F.lit("<broken>&nbsp;</broken></item>"),
    )
    if broken:
        item = F.when(F.col("doc_id") % 37 == 5, F.lit("<item><title>x</titel><link>y</link></item>")).when(
            F.col("doc_id") % 41 == 6, F.lit("<item><title>a < b</title></item>")
        ).otherwise(item)
    return pages_of(
        docs, "doc_id", item, "bbc", "<?xml version='1.0'?><rss><channel><title>all</title>",
        "<item><title>half", size=20, fetched_at="at", separator="\n",
    )


@query("feed_rss", f"""WITH {NEWS_SQL}
SELECT seq, pos, title, link, "pubDate", trim(text, chr(32) || chr(9) || chr(10) || chr(13)) AS description,
       '{{"category":"' || source || '","dc:lang":"' || lang || '","sub":"' || doc_id || '"}}' AS metadata
FROM n""")
def feed_rss(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rss.extract(news_payloads(spark, sf_dir)).drop("source", "fetched_at")


@query("feed_rss_strict", f"""WITH {NEWS_SQL},
bad AS (SELECT seq, min(pos) AS broken FROM n WHERE doc_id % 37 = 5 OR doc_id % 41 = 6 GROUP BY seq)
SELECT seq, pos, title, link, "pubDate", trim(text, chr(32) || chr(9) || chr(10) || chr(13)) AS description,
       '{{"category":"' || source || '","dc:lang":"' || lang || '","sub":"' || doc_id || '"}}' AS metadata
FROM n LEFT JOIN bad USING (seq) WHERE broken IS NULL OR pos < broken""")
def feed_rss_strict(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rss.extract(news_payloads(spark, sf_dir, broken=True), stop_at_error=True).drop("source", "fetched_at")
