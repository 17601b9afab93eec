"""Character references in markup, replaced inside the JVM."""

from __future__ import annotations

import json
from collections.abc import Callable
from html.entities import html5, name2codepoint

from pyspark.sql import Column
from pyspark.sql import functions as F

XML_NAMES = {"lt": "<", "gt": ">", "amp": "&", "apos": "'", "quot": '"'}
# All names of the HTML standard, as Python's library lists them; lookups go through the old and common ones first.
HTML_NAMES = {name: html5[f"{name};"] for name in name2codepoint}
HTML_NAMES |= {name[:-1]: text for name, text in html5.items() if name.endswith(";")}
# Names that count without a semicolon too, and before further letters; the longest is taken.
BARE_NAMES = {name: text for name, text in html5.items() if not name.endswith(";")}
_BARE = "^&(" + "|".join(sorted(BARE_NAMES, key=lambda name: (-len(name), name))) + ")"

# Numbers 128 to 159 mean the characters of this old code page where it has one.
_OLD_CODES = {chr(code): bytes([code]).decode("cp1252", "ignore") or chr(code) for code in range(128, 160)}

_XML_TOKENS = r"&[A-Za-z][A-Za-z0-9]*;|&#[0-9]+;|&#[xX][0-9A-Fa-f]+;|[^&]+|&"
_HTML_TOKENS = r"&[A-Za-z][A-Za-z0-9]*;?|&#[0-9]+;?|&#[xX][0-9A-Fa-f]+;?|[^&]+|&"
_XML_REFERENCE = r"&(?!(?:lt|gt|amp|apos|quot|#[0-9]+|#x[0-9A-Fa-f]+);)"


def _character(code: Column) -> Column:
    """The character of a code point, null if there is none."""
    valid = (code > 0) & (code < 0x110000) & ~code.between(0xD800, 0xDFFF)
    return F.when(valid, F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32"))


def _table(names: dict[str, str]) -> Column:
    """A constant map; one literal, as a literal per name would take long to build."""
    return F.from_json(F.lit(json.dumps(names)), "map<string,string>")


def _replace(content: Column, tokens: str, named: Callable[[Column], Column], old_codes: dict[str, str]) -> Column:
    """`named` gives the text of a named reference, null if there is none."""

    def number(code: Column) -> Column:
        return F.translate(_character(code), "".join(old_codes), "".join(old_codes.values())) if old_codes else _character(code)

    def one(token: Column) -> Column:
        body = F.ltrim(F.regexp_replace(token, "^&#?[xX]?|;$", ""), F.lit("0"))
        hexadecimal = F.when(F.length(body) <= 8, F.conv(body, 16, 10).try_cast("bigint"))
        return (
            F.when(~token.startswith("&") | (token == "&"), token)
            .when(token.rlike("^&#[xX]"), F.coalesce(number(hexadecimal), token))
            .when(token.startswith("&#"), F.coalesce(number(body.try_cast("bigint")), token))
            .otherwise(F.coalesce(named(token), token))
        )

    pieces = F.regexp_extract_all(content, F.lit(f"({tokens})"), F.lit(1))
    return F.when(content.contains("&"), F.array_join(F.transform(pieces, one), "")).otherwise(content)


def unescape_html(content: Column) -> Column:
    """Named and numeric references to characters, with or without semicolon as HTML has it; unknown ones stay as they are."""

    def named(token: Column) -> Column:
        whole = F.when(token.endswith(";"), _table(HTML_NAMES)[F.substring(token, F.lit(2), F.length(token) - 2)])
        bare = F.regexp_extract(token, _BARE, 1)
        rest = F.substring(token, F.length(bare) + 2, F.length(token))
        return F.coalesce(whole, F.when(bare != "", F.concat(_table(BARE_NAMES)[bare], rest)))

    return _replace(content, _HTML_TOKENS, named, _OLD_CODES)


def unescape_xml(content: Column) -> Column:
    """The five predefined names and numeric references; null if any other `&` occurs."""

    def named(token: Column) -> Column:
        return _table(XML_NAMES)[F.substring(token, F.lit(2), F.length(token) - 2)]

    return F.when(~content.rlike(_XML_REFERENCE), _replace(content, _XML_TOKENS, named, {}))
