"""Sources: registration, landing and reading, capping, routing, rejects."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from beaconlake.operators import feeds, messages, polls, views
from beaconlake.plans.feed_queries import (
    E, as_text, expected, fred_payloads, n_sql, opensky_payloads, t_sql, o_sql, LABEL_SQL, USGS_LOCATED, usgs_payloads,
)
from beaconlake.plans.tables import EVENTS_SQL, events, js, obj, query, raw as json_text, single, table
from beaconlake.session import scratch_path
from beaconlake.sources import raw, registry


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


CATALOGUE_SQL = "c(adapter, parser, default_url, place) AS (VALUES " + ", ".join(
    f"({_text(name)}, {_text(parser)}, {_text(url)}, {place})"
    for place, (name, parser, url, _) in enumerate(registry.CATALOGUE)
) + ")"

REGISTRATIONS_SQL = f"""r AS (
  SELECT s_suppkey AS reg_no, adapter, parser, default_url,
         CASE WHEN s_acctbal >= 0 THEN 'src_' || s_nationkey END AS name,
         CASE WHEN s_acctbal < 5000 THEN 'https://feeds.example.com/' || s_suppkey END AS url
  FROM supplier JOIN c ON place = s_suppkey % {len(registry.CATALOGUE)})"""


def registrations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every supplier registers a feed; a name or address may be missing or empty."""
    s = table(spark, sf_dir, "supplier")
    names = F.array(*[F.lit(entry[0]) for entry in registry.CATALOGUE])
    return s.select(
        F.col("s_suppkey").alias("reg_no"),
        F.get(names, (F.col("s_suppkey") % len(registry.CATALOGUE)).cast("int")).alias("adapter"),
        F.when(F.col("s_acctbal") >= 0, F.concat(F.lit("src_"), F.col("s_nationkey").cast("string"))).alias("name"),
        F.when(F.col("s_acctbal") < 5000, F.concat(F.lit("https://feeds.example.com/"), F.col("s_suppkey").cast("string")))
        .otherwise("").alias("url"),
    )


@query("feed_registry", f"""WITH {CATALOGUE_SQL}, {REGISTRATIONS_SQL}
SELECT c.adapter, c.parser, c.default_url, count(r.reg_no) AS n_registrations
FROM c LEFT JOIN r ON r.adapter = c.adapter GROUP BY ALL""")
def feed_registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    used = registrations(spark, sf_dir).groupBy("adapter").agg(F.count("*").alias("n_registrations"))
    known = registry.catalogue(spark).select("adapter", "parser", "default_url")
    return known.join(used, "adapter", "left").fillna(0, ["n_registrations"])


@query("resolve_feeds", f"""WITH {CATALOGUE_SQL}, {REGISTRATIONS_SQL}
SELECT coalesce(name, lower(adapter)) AS source, parser, coalesce(url, default_url) AS url
FROM r QUALIFY row_number() OVER (PARTITION BY coalesce(name, lower(adapter)) ORDER BY reg_no DESC) = 1""")
def resolve_feeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return registry.resolve(registrations(spark, sf_dir), registry.catalogue(spark))


@query("scan_snapshots", expected(
    f"{t_sql(LABEL_SQL)} AS place, {n_sql('value')} AS magnitude, CASE WHEN {USGS_LOCATED} THEN lon END AS longitude, "
    f"CASE WHEN {USGS_LOCATED} THEN lat END AS latitude, 'usgs' AS source"
))
def scan_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "snapshots")
    raw.write_snapshots(usgs_payloads(spark, sf_dir), path)
    rows = feeds.extract(raw.read_snapshots(spark, path), feeds.FEEDS["usgs"])
    return rows.drop("fetched_at")


def trades(spark: SparkSession, sf_dir: str) -> DataFrame:
    return single(events(spark, sf_dir), "event_id", obj(p=js(as_text(E.value)), q=js(as_text(E.k))), "binance")


@query("scan_messages", f"""WITH {EVENTS_SQL}
SELECT 'binance' AS source, event_id AS seq, value AS price, CAST(k AS DOUBLE) AS quantity FROM e""")
def scan_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "messages")
    raw.write_messages(trades(spark, sf_dir), path)
    rows = feeds.extract(raw.read_messages(spark, path), feeds.FEEDS["binance"])
    return rows.select("source", "seq", "price", "quantity")


@query("inject_payloads", f"""WITH {EVENTS_SQL}
SELECT 'binance' AS source, event_id AS seq, '{{"p":"' || value || '","q":"' || k || '"}}' AS payload FROM e
UNION ALL SELECT 'tg_test', page_id, url FROM pages""")
def inject_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = table(spark, sf_dir, "pages").select(
        F.col("page_id").alias("seq"), F.timestamp_seconds(F.lit(0)).alias("fetched_at"), F.col("url").alias("payload")
    )
    return raw.inject(trades(spark, sf_dir), "tg_test", given).drop("fetched_at")


@query("poll_counts", f"""WITH {EVENTS_SQL}
SELECT 'binance' AS source, count(*) AS n_rows FROM e
UNION ALL SELECT 'usgs', count(*) FROM e
UNION ALL SELECT 'fred', count(*) FROM e
UNION ALL SELECT 'opensky', count(*) FROM e WHERE event_type <> 'signup'""")
def poll_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Payloads of four known and one unknown source, landed and polled."""
    path = scratch_path(spark, "raw")
    unknown = trades(spark, sf_dir).withColumn("source", F.lit("nobody"))
    for payloads in (trades(spark, sf_dir), usgs_payloads(spark, sf_dir), fred_payloads(spark, sf_dir),
                     opensky_payloads(spark, sf_dir), unknown):
        raw.write_raw(payloads, path)
    sources = {name: name for name in ("binance", "usgs", "fred", "opensky")}
    return polls.row_counts(polls.poll(raw.read_raw(spark, path), sources))


@query("route_payloads", f"""WITH {CATALOGUE_SQL}
SELECT lower(adapter) AS source, parser, count(*) AS n_payloads
FROM supplier JOIN c ON place = s_nationkey WHERE s_acctbal >= 0 GROUP BY ALL""")
def route_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Payloads of unknown sources are dropped by the join with the registered ones."""
    names = F.array(*[F.lit(entry[0].lower()) for entry in registry.CATALOGUE])
    known = F.get(names, F.col("s_nationkey"))
    rows = table(spark, sf_dir, "supplier").withColumn(
        "source", F.when(F.col("s_acctbal") >= 0, known).otherwise(F.concat(F.lit("x_"), known))
    )
    return raw.route(rows, registry.default_sources(registry.catalogue(spark))).groupBy("source", "parser").agg(
        F.count("*").alias("n_payloads")
    )


def _by_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    return single(events(spark, sf_dir), "event_id", js(E.value), F.col("event_type"))


def _cap_sql(direction: str) -> str:
    return f"""SELECT event_type AS source, event_id AS seq, CAST(value AS VARCHAR) AS payload FROM events
QUALIFY row_number() OVER (PARTITION BY event_type ORDER BY event_id {direction}) <= 1000"""


@query("cap_newest", _cap_sql("DESC"))
def cap_newest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw.cap_newest(_by_type(spark, sf_dir), 1000).drop("fetched_at")


@query("cap_oldest", _cap_sql("ASC"))
def cap_oldest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw.cap_oldest(_by_type(spark, sf_dir), 1000).drop("fetched_at")


@query("payload_rejects", """
SELECT event_type AS source, event_id AS seq,
       CASE WHEN event_type = 'error' THEN 'not valid JSON' ELSE 'no records' END AS reason
FROM events WHERE event_type IN ('error', 'view', 'signup')""")
def payload_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    whole = obj(data=F.concat(json_text("["), js(E.value), json_text("]")))
    payload = (
        F.when(E.event_type == "error", F.substring(whole, F.lit(1), F.length(whole) - 1))
        .when(E.event_type == "view", obj(data=js(E.value)))
        .when(E.event_type == "signup", json_text('{"data":[]}'))
        .otherwise(whole)
    )
    payloads = single(events(spark, sf_dir), "event_id", payload, F.col("event_type"))
    bad = raw.rejects(payloads, feeds.array_at("$.data"))
    return bad.select("source", "seq", "reason")


# -- channels


def conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Turns as channel messages; assistant turns are the account's own."""
    return table(spark, sf_dir, "conversations").select(
        F.col("conv_id").alias("chat_id"), F.concat(F.lit("c"), F.col("conv_id").cast("string")).alias("channel"),
        F.col("turn").alias("message_id"), (F.col("role") == "assistant").alias("outgoing"), "role", "text",
    )


@query("channel_messages", """
SELECT conv_id AS chat_id, 'tg_c' || conv_id AS source, 'c' || conv_id AS channel, turn AS message_id, text
FROM conversations WHERE role <> 'assistant' AND conv_id IN (SELECT conv_id FROM conversations WHERE role = 'system')""")
def channel_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    all_messages = conversations(spark, sf_dir)
    channels = all_messages.where("role = 'system'").select("chat_id", "channel").distinct()
    channels = channels.withColumn("source", F.concat(F.lit("tg_"), "channel"))
    rows = messages.channel_messages(all_messages.drop("channel", "role"), channels)
    return rows.select("chat_id", "source", "channel", "message_id", "text")


@query("channel_history", """
SELECT 'tg_c' || conv_id AS source, 'c' || conv_id AS channel, turn AS message_id, text FROM conversations
QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC) <= 5""")
def channel_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = messages.channel_history(conversations(spark, sf_dir))
    return rows.select("source", "channel", "message_id", "text")


@query("follow_channels", """
SELECT DISTINCT 'c' || conv_id AS channel FROM conversations WHERE role IN ('system', 'assistant')""")
def follow_channels(spark: SparkSession, sf_dir: str) -> DataFrame:
    all_messages = conversations(spark, sf_dir)
    followed = all_messages.where("role = 'system'").select("channel").distinct()
    return messages.follow(followed, all_messages.where("role = 'assistant'"))


@query("feed_limit_newest", """
SELECT o_orderkey, o_orderdate, o_totalprice FROM orders WHERE o_orderstatus = 'F'
ORDER BY o_orderdate DESC, o_orderkey LIMIT 500""")
def feed_limit_newest(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate", "o_totalprice", "o_orderstatus")
    top = views.newest(orders, 500, F.desc("o_orderdate"), F.asc("o_orderkey"), where=F.col("o_orderstatus") == "F")
    return top.drop("o_orderstatus")
