"""Feed catalogue, and the feeds registered on top of it."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

CATALOGUE_SCHEMA = "adapter string, parser string, default_url string, alt_urls array<string>"

# Catalogue name, parser, default address, alternate addresses.
CATALOGUE = [
    ("BINANCE", "binance", "wss://stream.binance.com:9443/ws/btcusdt@trade",
     ["wss://stream.binance.us:9443/ws/btcusdt@trade"]),
    ("AIS_STREAM", "ais", "wss://stream.aisstream.io/v0/stream", []),
    ("AISHUB", "aishub",
     "https://data.aishub.net/ws.php?username=YOUR_AISHUB_USERNAME&format=1&output=json&compress=0", []),
    ("DIGITRAFFIC", "digitraffic", "https://meri.digitraffic.fi/api/ais/v1/locations", []),
    ("MARINESIA", "marinesia", "https://api.marinesia.com/api/v2/vessel/area", []),
    ("IMF_PORTWATCH", "dynamic",
     "https://services9.arcgis.com/weJ1QsnbMYJlCHdG/arcgis/rest/services/Daily_Chokepoints_Data/FeatureServer/0/query"
     "?where=1%3D1&outFields=*&orderByFields=Date+DESC&resultRecordCount=500&f=json", []),
    ("ACLED", "acled", "https://acleddata.com/api/acled/read", ["https://api.acleddata.com/acled/read"]),
    ("NASA_EONET", "eonet", "https://eonet.gsfc.nasa.gov/api/v3/events", []),
    ("CELESTRAK_MILITARY", "tle", "https://celestrak.org/NORAD/elements/gp.php?GROUP=military&FORMAT=tle", []),
    ("CELESTRAK_RESOURCE", "tle", "https://celestrak.org/NORAD/elements/gp.php?GROUP=resource&FORMAT=tle", []),
    ("OPENSKY", "opensky", "https://opensky-network.org/api/states/all", []),
    ("GDELT_GEOJSON", "gdelt", "https://api.gdeltproject.org/api/v2/geo/geo?format=geojson", []),
    ("GOOGLE_NEWS_REUTERS", "rss",
     "https://news.google.com/rss/search?q=site%3Areuters.com+when%3A1d&hl=en-US&gl=US&ceid=US%3Aen", []),
    ("POLYMARKET", "polymarket", "https://gamma-api.polymarket.com/events?limit=50&active=true", []),
    ("USGS", "usgs", "https://earthquake.usgs.gov/earthquakes/feed/v1.0/summary/all_hour.geojson", []),
    ("NWS", "rss", "https://api.weather.gov/alerts/active", []),
    ("BBC", "rss", "http://feeds.bbci.co.uk/news/world/rss.xml", []),
    ("AL_JAZEERA", "rss", "https://www.aljazeera.com/xml/rss/all.xml", []),
    ("CLOUDFLARE_RADAR", "cloudflare", "https://api.cloudflare.com/client/v4/radar/bgp/leaks/events", []),
    ("NASA_FIRMS", "firms",
     "https://firms.modaps.eosdis.nasa.gov/api/country/csv/YOUR_KEY/VIIRS_SNPP_NRT/USA/1", []),
    ("URLHAUS", "urlhaus", "https://urlhaus-api.abuse.ch/v1/urls/recent/", []),
    ("FRED", "fred", "https://api.stlouisfed.org/fred/series/observations?series_id=BDI&file_type=json", []),
    ("UCDP", "ucdp", "https://ucdpapi.pcr.uu.se/api/gedevents/23.1?pagesize=100", []),
    ("OREF", "oref", "https://www.oref.org.il/WarningMessages/alert/alerts.json", []),
    ("COINGECKO", "coingecko",
     "https://api.coingecko.com/api/v3/simple/price?ids=tether,bitcoin&vs_currencies=usd", []),
    ("OPEN_METEO", "meteo",
     "https://api.open-meteo.com/v1/forecast?latitude=52.52&longitude=13.41&current_weather=true", []),
    ("FEODO_TRACKER", "feodo", "https://feodotracker.abuse.ch/downloads/ipblocklist.json", []),
    ("RANSOMWARE_LIVE", "ransomware", "https://api.ransomware.live/v2/recentvictims", []),
    ("NGA_WARNINGS", "nga", "https://msi.nga.mil/api/publications/broadcast-warn?output=json", []),
    ("UNHCR", "unhcr", "https://api.unhcr.org/population/v1/population/", []),
]


@dataclass(frozen=True)
class Adapter:
    """A feed type a user may register: catalogue entry or own definition."""

    name: str
    parser: str
    default_url: str
    alt_urls: list[str] = field(default_factory=list)


def adapter(name: str) -> Adapter:
    return next(Adapter(*entry) for entry in CATALOGUE if entry[0] == name)


def supported_sources() -> list[str]:
    return sorted(entry[0] for entry in CATALOGUE)


def catalogue(spark: SparkSession, extra: list[Adapter] | None = None) -> DataFrame:
    """The catalogue as a dimension, with adapters of the user's own added."""
    own = [(a.name, a.parser, a.default_url, list(a.alt_urls)) for a in extra or []]
    return spark.createDataFrame(CATALOGUE + own, CATALOGUE_SCHEMA)


def resolve(registrations: DataFrame, adapters: DataFrame) -> DataFrame:
    """Source name, parser and address of each registered feed.

    `registrations(reg_no, adapter, name, url)`: a null name means the adapter name
    in lower case, a null or empty address the default one; of several
    registrations under one name the last counts. Keeping the last is one
    aggregate, so a name registered very often is reduced before the shuffle.
    """
    named = registrations.withColumn("source", F.coalesce(F.nullif("name", F.lit("")), F.lower("adapter")))
    last = named.groupBy("source").agg(
        F.max(F.struct("reg_no", "adapter", F.nullif("url", F.lit("")).alias("url"))).alias("last")
    )
    return (
        last.select("source", "last.adapter", "last.url")
        .join(adapters, "adapter")
        .select("source", "parser", F.coalesce("url", "default_url").alias("url"))
    )


def default_sources(adapters: DataFrame) -> DataFrame:
    """All catalogue feeds under their default name."""
    return adapters.select(F.lower("adapter").alias("source"), "parser", F.col("default_url").alias("url"))
