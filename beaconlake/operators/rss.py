"""News feeds: RSS text to one row per item, with Spark's own string functions.

Rules kept: tag names are lower-cased; text counts for the start tag right before it,
and any end tag ends that; repeated title, link, pubDate and description are joined,
of other repeated tags the last text wins; CDATA is taken as it is; text with an
unknown entity is skipped; an item without its end tag gives no row. Items after a
syntax error are kept, unless `stop_at_error` is asked for: then the payload ends before
the first end tag that does not close the element opened last, or the first bracket that
begins no markup, as for a parser that keeps a stack of open elements.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from beaconlake.functions import strict
from beaconlake.functions.entities import unescape_xml
from beaconlake.operators.feeds import LINEAGE

# Private-use characters that mark CDATA content, its end, and dropped markup.
OPEN, CLOSE, GAP = "\ue000", "\ue001", "\ue002"

_PIECES = r"(?s)(<!\[CDATA\[.*?\]\]>|<!--.*?-->|<\?.*?\?>|[^<]+|<)"
_ITEM = r"(?is)(<item(?:\s[^>]*)?>.*?</item\s*>)"
_TAG_AND_TEXT = r"(?s)<([\p{L}_:][^\s<>/]*)[^<>]*>([^<]*)"
_EVENT = f"({OPEN}[^{CLOSE}]*{CLOSE}|[^{OPEN}{GAP}]+)"
_MARKUP = "<[^<>]+>"
_EDGE = r"^[ \t\r\n]+|[ \t\r\n]+$"

# Tags that become columns.
COLUMNS = {"title": "title", "link": "link", "pubdate": "pubDate", "description": "description"}


def _all(content: Column, pattern: str, group: int = 1) -> Column:
    return F.regexp_extract_all(content, F.lit(pattern), F.lit(group))


def _protected(payload: Column) -> Column:
    """CDATA marked and freed of angle brackets, comments and empty tags replaced by a gap."""

    def one(piece: Column) -> Column:
        inner = F.substring(piece, 10, F.length(piece) - 12)
        safe = F.replace(F.replace(inner, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;"))
        return (
            F.when(piece.startswith("<![CDATA["), F.concat(F.lit(OPEN), safe, F.lit(CLOSE)))
            .when(piece.startswith("<!--") | piece.startswith("<?"), F.lit(GAP))
            .otherwise(piece)
        )

    joined = F.array_join(F.transform(_all(payload, _PIECES), one), "")
    return F.regexp_replace(joined, r"<[\p{L}_:][^<>]*/>", GAP)


def _events(item: Column) -> Column:
    """`array<struct<tag, value>>` in document order."""
    pairs = F.arrays_zip(_all(item, _TAG_AND_TEXT, 1).alias("tag"), _all(item, _TAG_AND_TEXT, 2).alias("text"))

    def value(event: Column) -> Column:
        cdata = F.substring(event, 2, F.length(event) - 2)
        raw = F.replace(F.replace(cdata, F.lit("&lt;"), F.lit("<")), F.lit("&amp;"), F.lit("&"))
        plain = F.regexp_replace(event, _EDGE, "")
        return F.when(event.startswith(OPEN), raw).when(plain != "", unescape_xml(plain))

    def texts(pair: Column) -> Column:
        events = F.transform(_all(pair["text"], _EVENT), lambda e: F.struct(F.lower(pair["tag"]).alias("tag"), value(e).alias("value")))
        return F.filter(events, lambda e: e["value"].isNotNull())

    return F.flatten(F.transform(pairs, texts))


def _joined(tag: str) -> Column:
    texts = F.transform(F.filter("events", lambda e: e["tag"] == tag), lambda e: e["value"])
    return strict.strip(F.array_join(texts, ""))


def _metadata() -> Column:
    """Other tags as a JSON object with sorted keys, the last text of each tag."""
    others = F.filter("events", lambda e: ~e["tag"].isin(*COLUMNS))
    tags = F.array_sort(F.array_distinct(F.transform(others, lambda e: e["tag"])))
    last = F.transform(
        tags,
        lambda t: F.struct(t, F.element_at(F.filter(others, lambda e: e["tag"] == t), -1)["value"]),
    )
    return F.to_json(F.map_from_entries(last))


def _until_error(content: Column) -> Column:
    """What stands before the first syntax error: a fold over the tags with the names of the elements open."""
    lead, tag = F.split(content, _MARKUP, -1).alias("lead"), _all(content, _MARKUP, 0).alias("tag")
    # The text behind the last tag comes with an empty one.
    tokens = F.transform(
        F.arrays_zip(lead, tag),
        lambda t: F.struct(
            t["lead"].alias("lead"), F.coalesce(t["tag"], F.lit("")).alias("tag"), F.regexp_extract(t["tag"], r"^</?([^\s<>/]*)", 1).alias("name")
        ),
    )
    start = F.struct(
        F.lit(0).alias("at"), F.lit(None).cast("int").alias("error"), F.array().cast("array<string>").alias("open")
    )

    def step(state: Column, t: Column) -> Column:
        ends, depth = t["tag"].startswith("</"), F.size(state["open"])
        closes = F.coalesce(F.try_element_at(state["open"], F.lit(-1)) == t["name"], F.lit(False))
        stray = F.instr(t["lead"], "<")
        error = F.when(stray > 0, state["at"] + stray - 1).when(ends & ~closes, state["at"] + F.length(t["lead"]))
        left = F.when(ends & (depth > 0), F.slice(state["open"], F.lit(1), F.greatest(depth - 1, F.lit(0)))).when(
            ends | (t["tag"] == "") | t["tag"].startswith("<!"), state["open"]
        ).otherwise(F.array_append(state["open"], t["name"]))
        return F.struct(
            (state["at"] + F.length(t["lead"]) + F.length(t["tag"])).alias("at"), F.coalesce(state["error"], error).alias("error"),
            left.alias("open"),
        )

    return F.aggregate(tokens, start, step, lambda state: F.substring(content, F.lit(1), F.coalesce(state["error"], F.length(content))))


def extract(payloads: DataFrame, stop_at_error: bool = False) -> DataFrame:
    content = _protected(F.col("payload"))
    if stop_at_error:
        # The generator keeps the content from being made again for each use.
        payloads = payloads.select("source", "seq", "fetched_at", F.explode(F.array(content)).alias("content"))
        content = _until_error(F.col("content"))
    items = payloads.select("source", "seq", "fetched_at", F.posexplode(_all(content, _ITEM)).alias("pos", "item"))
    # An item opened again before its end starts over.
    fresh = F.regexp_replace("item", r"(?is)^.+(?=<item[\s>])", "")
    events = items.select(*LINEAGE, F.explode(F.array(_events(fresh))).alias("events"))
    return events.select(*LINEAGE, *[_joined(tag).alias(name) for tag, name in COLUMNS.items()], _metadata().alias("metadata"))
