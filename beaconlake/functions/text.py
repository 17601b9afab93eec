"""Text expressions: script direction, names, cards and link markup."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Code points of the Hebrew to Arabic range, and the markup of a link.
RTL_FIRST, RTL_LAST = 0x0590, 0x06FF
LINK_OPEN = ('<a href="', '" target="_blank" style="color: #0096ff; text-decoration: none;">')
LINK_CLOSE = "</a>"

SPAN_TYPE = "array<struct<kind:string,offset:int,length:int,url:string>>"


def is_rtl(content: Column) -> Column:
    """Whether the first letter belongs to a right-to-left script; false without letters."""
    letter = F.regexp_extract(content, r"(\p{L})", 1)
    return F.coalesce(F.ascii(letter).between(RTL_FIRST, RTL_LAST), F.lit(False))


def upper_snake(name: Column) -> Column:
    """`pubDate` to `PUB_DATE`: a line before each capital that does not follow a capital."""
    return F.upper(F.regexp_replace(name, r"(?<=\P{Lu})(\p{Lu})", "_$1"))


def real_newlines(content: Column) -> Column:
    """Backslash-n pairs, left over from escaping, as line breaks."""
    return F.replace(content, F.lit("\\n"), F.lit("\n"))


def link_markup(content: Column, spans: Column) -> Column:
    """Insert anchor tags for link spans whose offset and length count UTF-16 units.

    Spans of kind `text_url` bring their address; of kind `url` the marked text is the
    address, with `https://` before it unless it starts with http. Spans beyond the end
    are skipped. Works on the hexadecimal UTF-16 form, four digits per unit, so that
    offsets are right for characters outside the basic plane too.
    """
    units = F.hex(F.encode(content, "UTF-16BE"))
    size = (F.length(units) / 4).cast("int")

    def code(text: Column) -> Column:
        return F.hex(F.encode(text, "UTF-16BE"))

    def cut(start: Column, length: Column) -> Column:
        return F.substring(units, start * 4 + 1, length * 4)

    def edge(at: Column) -> Column:
        """A place inside a character moves to its start."""
        return F.when(F.substring(units, at * 4 + 1, 2).between("DC", "DF"), at - 1).otherwise(at)

    def resolve(span: Column, place: Column) -> Column:
        start, end = edge(span["offset"]), edge(span["offset"] + span["length"])
        marked = F.decode(F.unhex(cut(start, end - start)), "UTF-16BE")
        address = F.when(marked.startswith("http"), marked).otherwise(F.concat(F.lit("https://"), marked))
        url = F.when(span["kind"] == "url", address).otherwise(span["url"])
        return F.struct((-span["offset"]).alias("back"), place, start.alias("start"), end.alias("end"), url.alias("url"))

    known = F.filter(spans, lambda s: s["kind"].isin("url", "text_url") & (s["offset"] + s["length"] <= size))
    from_back = F.array_sort(F.transform(known, resolve))

    def insert(done: Column, link: Column) -> Column:
        opening = F.concat(F.lit(LINK_OPEN[0]), link["url"], F.lit(LINK_OPEN[1]))
        head = F.substring(done, F.lit(1), link["start"] * 4)
        body = F.substring(done, link["start"] * 4 + 1, (link["end"] - link["start"]) * 4)
        tail = F.substring(done, link["end"] * 4 + 1, F.length(done))
        return F.concat(head, code(opening), body, code(F.lit(LINK_CLOSE)), tail)

    linked = F.decode(F.unhex(F.aggregate(from_back, units, insert)), "UTF-16BE")
    return F.when(F.coalesce(F.size(known), F.lit(0)) > 0, linked).otherwise(content)
