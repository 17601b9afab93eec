"""Article text of web pages, and news items joined with it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from beaconlake.functions import strict
from beaconlake.functions.entities import unescape_html
from beaconlake.functions.paragraphs import paragraphs

# Fixed values.
MIN_BYTES = 30
NOTICE = (
    "Could not extract article text. The site might be using heavy JavaScript rendering "
    "or an anti-bot wall."
)
NO_TITLE, NO_LINK, NO_DATE = "No Title", "#", "Unknown Date"

# Elements whose start ends an open paragraph.
BLOCKS = (
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer "
    "form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre section summary table ul"
)
# Elements whose end closes a paragraph left open inside them.
PARENTS = BLOCKS + " body html td th li dd dt caption"

_HIDDEN = r"(?is)<!--.*?(?:-->|$)|<(script|style|template|textarea|title|noscript)\b[^>]*>.*?(?:</\1\s*>|$)"
_STARTS = "|".join(BLOCKS.split())
_ENDS = "|".join(PARENTS.split())
_PARAGRAPH = rf"(?is)<p(?:\s[^>]*)?>(.*?)(?=</(?:{_ENDS})\s*>|<(?:{_STARTS})(?:[\s/][^>]*)?>|$)"
_TAG = r"(?s)</?[A-Za-z!?][^>]*>"


def article_text(html: Column, tree: bool = False) -> Column:
    """Paragraphs of more than 30 bytes joined by a blank line, or a fixed notice.

    A paragraph ends at its end tag, at the next block element or where its parent
    ends. Script, style and comment content does not count. With `tree`, paragraphs are
    those of the page's element tree, at some ten times the cost: lists and tables inside
    a paragraph's shield stay in it, stray end tags end nothing, and scripts inside a
    paragraph are text of it.
    """
    if tree:
        texts = F.transform(paragraphs(html), strict.strip)
    else:
        visible = F.regexp_replace(html, _HIDDEN, "")
        found = F.regexp_extract_all(visible, F.lit(_PARAGRAPH), F.lit(1))
        texts = F.transform(found, lambda p: strict.strip(unescape_html(F.regexp_replace(p, _TAG, ""))))
    kept = F.filter(texts, lambda t: F.octet_length(t) > MIN_BYTES)
    return F.coalesce(F.nullif(F.array_join(kept, "\n\n"), F.lit("")), F.lit(NOTICE))


def articles(pages: DataFrame, tree: bool = False) -> DataFrame:
    """`pages(url, html)` to `(url, article)`."""
    return pages.select("url", article_text(F.col("html"), tree).alias("article"))


def news_with_text(news: DataFrame, pages: DataFrame) -> DataFrame:
    """News rows with fallbacks for missing fields and the text of the page they link to.

    Of pages with the same address the newest counts, by `fetched_at` or else `page_id` if there is such a column, and
    the greatest text among equals; so a news row stays one row. Only pages that some item links to are taken apart.
    Items without link meet no page. A link shared by very many items is split by the adaptive skew join.
    """
    order = [c for c in ("fetched_at", "page_id") if c in pages.columns][:1]
    linked = pages.join(news.select(F.col("link").alias("url")).distinct(), "url", "left_semi")
    newest = linked.groupBy("url").agg(F.max_by("html", F.struct(*order, "html")).alias("html"))
    date = F.coalesce("pubDate", "date") if "date" in news.columns else F.col("pubDate")
    filled = news.withColumns(
        {
            "title": F.coalesce("title", F.lit(NO_TITLE)),
            "published": F.coalesce(date, F.lit(NO_DATE)),
        }
    )
    return filled.join(articles(newest).withColumnRenamed("url", "link"), "link", "left").withColumns(
        {"link": F.coalesce("link", F.lit(NO_LINK)), "article": F.coalesce("article", F.lit(NOTICE))}
    )
