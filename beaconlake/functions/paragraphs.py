"""Paragraphs of an HTML page by its stack of open elements, as one fold over the tags.

Follows the tree rules of the HTML standard as far as they decide what lies in a paragraph: which start tags close an
open paragraph, which elements shield one from that (scopes), how list items, definitions, table parts and buttons end,
and that an end tag without its element is passed over. Elements that decide nothing, such as links and emphasis, stay
off the stack. A page without a doctype is read in quirks mode, where a table stands inside a paragraph.

Text is that of all descendants, so scripts and styles in a paragraph count, as they do for a tree; templates do not.
Not followed: the content of `select` and frames, and text that a table pushes out before itself.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from beaconlake.functions.entities import unescape_html

# Element names by their part in the tree rules.
CLOSERS = (
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 "
    "h5 h6 header hgroup hr listing main menu nav ol p plaintext pre search section summary ul"
).split()
HEADINGS = "h1 h2 h3 h4 h5 h6".split()
BARRIERS = "applet caption html marquee object table td template th".split()
OWN_SCOPE = "applet button marquee object template".split()
CELLS, ROW_GROUPS = ["td", "th"], ["tbody", "tfoot", "thead"]
TABLE_PARTS = [*CELLS, "tr", *ROW_GROUPS, "caption", "table"]
ITEMS = {"li": ["li"], "dd": ["dd", "dt"], "dt": ["dd", "dt"]}
PASSED_OVER = ["address", "div", "p"]  # between a list item and the one before it
RAW = "script style xmp iframe noembed noframes noscript".split()
ESCAPABLE = ["textarea", "title"]

_RAW = "|".join([*RAW, *ESCAPABLE])
_TOKEN = rf"(?is)<!--.*?(?:-->|$)|<({_RAW})(?=[\s/>])[^>]*>.*?(?:</\1\s*>|$)|</?[a-z][^>]*>|<[!?/][^>]*>"
_DOCTYPE = r"(?is)^\s*(?:<!--.*?-->\s*)*<!doctype\s+html"
# Private-use characters: between pieces of text, and for an ampersand that begins no reference.
_SEAM, _AMPERSAND = "\ue010", "\ue011"
_OPEN = "array<struct<name: string, id: int, text: string>>"


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body` of a value that is made once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _last(opened: Column, names: Sequence[str] | Column) -> Column:
    """Place of the last open element with one of the names, -1 if there is none."""
    wanted = (lambda o: o["name"].isin(*names)) if isinstance(names, (list, tuple)) else (lambda o: o["name"] == names)
    return F.coalesce(F.array_max(F.transform(opened, lambda o, i: F.when(wanted(o), i))), F.lit(-1))


def _tokens(html: Column) -> Column:
    """`array<struct<text, name, ends>>`: text before each tag, raw text with its own tag as text."""
    lead, tag = F.split(html, _TOKEN, -1).alias("lead"), F.regexp_extract_all(html, F.lit(_TOKEN), F.lit(0)).alias("tag")

    def one(t: Column) -> Column:
        name = F.lower(F.regexp_extract(t["tag"], r"^</?([A-Za-z][^\s/>]*)", 1))
        starts = ~t["tag"].startswith("</")
        inner = F.regexp_replace(t["tag"], r"(?s)^<[^>]*>|</[^<>]*>$", "")
        raw = F.when(starts & name.isin(RAW), F.replace(inner, F.lit("&"), F.lit(_AMPERSAND))).when(starts & name.isin(ESCAPABLE), inner)
        text = F.concat(t["lead"], F.when(raw.isNotNull(), F.concat(F.lit(_SEAM), raw)).otherwise(""), F.lit(_SEAM))
        return F.struct(text.alias("text"), F.coalesce(F.when(raw.isNull(), name), F.lit("")).alias("name"), F.coalesce(~starts, F.lit(False)).alias("ends"))

    return F.transform(F.arrays_zip(lead, tag), one)


def _kept(state: Column, t: Column, quirks: Column) -> Column:
    """How many of the open elements stay, and the element that comes on top, if any."""
    opened, name = state["open"], t["name"]
    n = F.size(opened)
    barrier = _last(opened, BARRIERS)
    shield = F.greatest(barrier, _last(opened, ["button"]))
    p, table = _last(opened, ["p"]), _last(opened, ["table"])
    without_p = F.when(p > shield, p).otherwise(n)

    def item(names: list[str]) -> Column:
        before = _last(opened, names)
        stop = F.coalesce(F.array_max(F.transform(opened, lambda o, i: F.when(~o["name"].isin(*PASSED_OVER, *names), i))), F.lit(-1))
        return F.least(F.when(before > stop, before).otherwise(n), without_p)

    closes = F.when(name == "table", F.when(quirks, n).otherwise(without_p)).when(name.isin(CLOSERS), without_p)
    for one, names in ITEMS.items():
        closes = closes.when(name == one, item(names))
    part = (
        F.when(name.isin(CELLS), _last(opened, ["tr", *ROW_GROUPS, "table"])).when(name == "tr", _last(opened, [*ROW_GROUPS, "table"])).otherwise(table)
    )
    in_table = name.isin(*CELLS, "tr", *ROW_GROUPS, "caption")
    button = _last(opened, ["button"])
    start = closes.when(in_table & (table >= 0), F.greatest(part, table) + 1).when((name == "button") & (button > barrier), button).otherwise(n)
    pushed = (name.isin(*CLOSERS, *ITEMS, "table", *OWN_SCOPE) & (name != "hr")) | (in_table & (table >= 0))

    same = F.when(name.isin(HEADINGS), _last(opened, HEADINGS)).otherwise(_last(opened, name))
    floor = (
        F.when(name == "p", shield + 1)
        .when(name == "li", F.greatest(barrier, _last(opened, ["ol", "ul"])) + 1)
        .when(name.isin(TABLE_PARTS), table)
        .when(name.isin(BARRIERS), barrier)
        .otherwise(barrier + 1)
    )
    end = F.when((same >= 0) & (same >= floor), same).otherwise(n)
    return F.struct(F.when(t["ends"], end).otherwise(start).alias("kept"), F.when(~t["ends"] & pushed, name).alias("pushed"))


def _step(state: Column, t: Column, quirks: Column) -> Column:
    none = F.array().cast(_OPEN)

    def after(x: Column) -> Column:
        opened, kept, name = x["open"], x["k"]["kept"], x["k"]["pushed"]
        hidden = F.exists(opened, lambda o: o["name"] == "template")
        number = F.when((name == "p") & ~hidden, x["n"] + 1).otherwise(0)
        top = F.when(name.isNotNull(), F.array(F.struct(name.alias("name"), number.alias("id"), F.lit("").alias("text")))).otherwise(none)
        closed = F.filter(F.slice(opened, kept + 1, F.greatest(F.size(opened) - kept, F.lit(0))), lambda o: o["id"] > 0)
        return F.struct(
            F.concat(F.slice(opened, F.lit(1), kept), top).alias("open"), (x["n"] + F.when(number > 0, 1).otherwise(0)).alias("n"),
            F.when(F.size(closed) > 0, F.concat(x["done"], closed)).otherwise(x["done"]).alias("done"),
        )

    hidden = F.exists(state["open"], lambda o: o["name"] == "template")
    heard = F.transform(
        state["open"],
        lambda o: F.struct(
            o["name"].alias("name"), o["id"].alias("id"),
            F.when((o["id"] > 0) & ~hidden, F.concat(o["text"], t["text"])).otherwise(o["text"]).alias("text"),
        ),
    )
    return _let(
        F.struct(heard.alias("open"), state["n"].alias("n"), state["done"].alias("done"), _kept(state, t, quirks).alias("k")), after
    )


def paragraphs(html: Column) -> Column:
    """Texts of all paragraphs in the order in which they begin, references replaced, white space as it stands."""
    quirks = ~html.rlike(_DOCTYPE)
    start = F.struct(F.array().cast(_OPEN).alias("open"), F.lit(0).alias("n"), F.array().cast(_OPEN).alias("done"))

    def ended(state: Column) -> Column:
        found = F.concat(state["done"], F.filter(state["open"], lambda o: o["id"] > 0))
        return F.transform(F.array_sort(F.transform(found, lambda o: F.struct(o["id"], o["text"]))), lambda o: o["text"])

    def plain(text: Column) -> Column:
        return F.replace(F.replace(unescape_html(text), F.lit(_SEAM), F.lit("")), F.lit(_AMPERSAND), F.lit("&"))

    return F.transform(F.aggregate(_tokens(html), start, lambda s, t: _step(s, t, quirks), ended), plain)
