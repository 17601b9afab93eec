"""Payload to rows: feeds described as data, extracted by one shared plan.

Every feed is a path to its records and a list of fields with strict getters.
Payloads that are not valid JSON or lack the record array give no rows; a value of
the wrong type nulls its own cell only. Rows carry `source, seq, fetched_at` of
their payload and `pos`, the position of the record in it.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from beaconlake.functions import strict

LINEAGE = ["source", "seq", "fetched_at", "pos"]


@dataclass(frozen=True)
class Field:
    name: str
    path: str
    get: Callable[[Column, str], Column]
    default: object = None

    def column(self, record: Column) -> Column:
        value = self.get(record, self.path)
        if self.default is not None:
            value = F.coalesce(value, F.lit(self.default))
        return value.alias(self.name)


@dataclass(frozen=True)
class Feed:
    """`records` maps the parsed payload to an array of records."""

    name: str
    records: Callable[[Column], Column]
    fields: tuple[Field, ...]
    keep: Callable[[Column], Column] | None = None

    @property
    def columns(self) -> list[str]:
        return [f.name for f in self.fields]


def array_at(path: str) -> Callable[[Column], Column]:
    return lambda doc: strict.elements(doc, path)


def payload_itself(doc: Column) -> Column:
    return F.array_compact(F.array(doc))


def records(payloads: DataFrame, find: Callable[[Column], Column]) -> DataFrame:
    """One row per record. The parse sits inside the generator, so it runs once per payload."""
    return payloads.select(
        "source", "seq", "fetched_at", F.posexplode(find(strict.parse("payload"))).alias("pos", "record")
    )


def extract(payloads: DataFrame, feed: Feed) -> DataFrame:
    rows = records(payloads, feed.records)
    if feed.keep is not None:
        rows = rows.where(feed.keep(F.col("record")))
    return rows.select(*LINEAGE, *[f.column(F.col("record")) for f in feed.fields])


# Field shorthands: JSON key equal to the column name unless given.
def _field(get):
    def make(name: str, path: str | None = None, default: object = None) -> Field:
        return Field(name, f"$.{name}" if path is None else path, get, default)

    return make


S = _field(strict.text)
F64 = _field(strict.number)
I64 = _field(strict.integer)
I32 = _field(strict.small_integer)
FS = _field(strict.number_in_text)
IS = _field(strict.small_integer_in_text)
IoS = _field(strict.integer_or_text)
TRIM = _field(strict.trimmed_text)


def _lon_lat(path: str) -> tuple[Field, Field]:
    """GeoJSON order: longitude first."""
    return F64("longitude", f"{path}[0]"), F64("latitude", f"{path}[1]")


def _joined_texts(value: Column, path: str) -> Column:
    """The strings of an array joined by a comma; other elements are skipped."""
    texts = F.transform(strict.elements(value, path), lambda x: strict.text(x, "$"))
    return F.array_join(F.array_compact(texts), ", ")


def _second_of_two(doc: Column) -> Column:
    """The record array in `[meta, records]`; any other number of elements gives none."""
    return F.flatten(
        F.transform(
            F.filter(F.array(strict.elements(doc, "$")), lambda root: F.size(root) == 2),
            lambda root: F.coalesce(strict.elements(root[1], "$"), F.array().cast("array<variant>")),
        )
    )


def _is_array(record: Column) -> Column:
    return strict.elements(record, "$").isNotNull()


FEEDS: dict[str, Feed] = {
    feed.name: feed
    for feed in [
        Feed("polymarket", array_at("$"), (S("title"), F64("volume"))),
        Feed("cloudflare", array_at("$.result.events"), (I64("asn"), S("leak_type"), S("country_code"))),
        Feed("firms", array_at("$"), (
            F64("latitude"), F64("longitude"), F64("brightness", "$.bright_ti4"), S("confidence"))),
        Feed("ucdp", array_at("$.Result"), (
            I64("id"), S("conflict_name"), F64("latitude"), F64("longitude"), I32("deaths", "$.best"))),
        Feed("feodo", array_at("$"), (S("ip_address"), I32("port"), S("malware"))),
        Feed("ransomware", array_at("$"), (S("group_name"), S("victim", "$.post_title"), S("published"))),
        Feed("nga", array_at("$['broadcast-warn']"), (S("navArea"), S("text"))),
        Feed("binance", payload_itself, (FS("price", "$.p"), FS("quantity", "$.q"))),
        Feed("acled", array_at("$.data"), (
            S("event_id_cnty"), S("event_type"), FS("latitude"), FS("longitude"), IS("fatalities"))),
        Feed("opensky", array_at("$.states"), (
            S("icao24", "$[0]"), TRIM("callsign", "$[1]"), S("origin_country", "$[2]"),
            I64("time_position", "$[3]"), I64("last_contact", "$[4]"),
            F64("longitude", "$[5]"), F64("latitude", "$[6]")), keep=_is_array),
        Feed("gdelt", array_at("$.features"), (
            S("name", "$.properties.name"), S("url", "$.properties.url"), *_lon_lat("$.geometry.coordinates"))),
        Feed("eonet", array_at("$.events"), (
            S("title"), S("category", "$.categories[0].title"), *_lon_lat("$.geometry[0].coordinates"))),
        Feed("usgs", array_at("$.features"), (
            S("place", "$.properties.place"), F64("magnitude", "$.properties.mag"),
            *_lon_lat("$.geometry.coordinates"))),
        Feed("urlhaus", array_at("$.urls"), (IoS("id"), S("url"), S("status", "$.url_status"))),
        Feed("fred", array_at("$.observations"), (S("date"), FS("value"))),
        Feed("oref", payload_itself, (S("id"), S("title"), Field("cities", "$.data", _joined_texts))),
        Feed("meteo", payload_itself, (
            F64("latitude"), F64("longitude"), F64("temperature", "$.current_weather.temperature"))),
        Feed("messages", payload_itself, (
            I64("message_id"), S("channel"), S("text"), I64("date"), S("media", default=""))),
        Feed("unhcr", array_at("$.items"), (S("origin"), S("destination"), I64("population"), S("date"))),
        Feed("aishub", _second_of_two, (
            I64("mmsi", "$.MMSI"), F64("latitude", "$.LATITUDE"), F64("longitude", "$.LONGITUDE"),
            F64("sog", "$.SOG"), F64("cog", "$.COG"), S("name", "$.NAME"),
            I64("ship_type", "$.TYPE"), S("destination", "$.DEST"))),
    ]
}


def coingecko(payloads: DataFrame) -> DataFrame:
    """Prices: every key of the payload object is a row."""
    entries = F.try_variant_get(strict.parse("payload"), "$", "map<string,variant>")
    rows = payloads.select("source", "seq", "fetched_at", F.posexplode(entries).alias("pos", "coin", "quote"))
    return rows.select(*LINEAGE, "coin", strict.number(F.col("quote"), "$.usd").alias("price_usd"))
