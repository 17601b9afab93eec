"""Messages, articles, geometry and views."""

import html.parser

import pytest
from pyspark.sql import functions as F

from beaconlake.functions import text
from beaconlake.functions.entities import unescape_html, unescape_xml
from beaconlake.functions.paragraphs import paragraphs
from beaconlake.operators import articles, geometry, messages, views
from beaconlake.sources import registry

A = "".join(text.LINK_OPEN)


def link(url, shown):
    return f"{text.LINK_OPEN[0]}{url}{text.LINK_OPEN[1]}{shown}{text.LINK_CLOSE}"


@pytest.mark.parametrize(
    "content,spans,expected",
    [
        ("see a.io now", [("url", 4, 4, None)], "see " + link("https://a.io", "a.io") + " now"),
        ("http://x", [("url", 0, 8, None)], link("http://x", "http://x")),
        ("\U0001f600\U0001f600 hi", [("text_url", 5, 2, "u")], "\U0001f600\U0001f600 " + link("u", "hi")),
        ("ab cd", [("text_url", 0, 2, "u"), ("text_url", 3, 2, "v")], link("u", "ab") + " " + link("v", "cd")),
        ("ab", [("text_url", 1, 2, "u"), ("bold", 0, 1, None)], "ab"),
        ("ab", None, "ab"),
        ("", [("url", 0, 0, None)], link("https://", "")),
    ],
)
def test_link_markup(spark, content, spans, expected):
    frame = spark.createDataFrame([(content, spans)], f"content string, spans {text.SPAN_TYPE}")
    assert frame.select(text.link_markup(F.col("content"), F.col("spans"))).first()[0] == expected


def test_direction_names_and_cards(spark):
    rows = spark.createDataFrame(
        [("123 שלום", "AbuX"), ("a שלום", "x"), ("123", "x"), ("مرحبا\nb\nc", "x"), ("one\\ntwo", "x")], "text string, channel string"
    ).withColumn("date", F.lit(1710760000))
    got = [(r.direction, r.highlight, r.title, r.body, r.shown_time) for r in messages.cards(rows).collect()]
    assert got == [
        ("rtl", True, None, "123 שלום", "11:06:40"), ("ltr", False, None, "a שלום", "11:06:40"), ("ltr", False, None, "123", "11:06:40"),
        ("rtl", False, "مرحبا", "b\nc", "11:06:40"), ("ltr", False, "one", "two", "11:06:40"),
    ]
    names = spark.createDataFrame([("pubDate",), ("ABCd",), ("navArea2X",), ("plain",)], "n string")
    assert [r[0] for r in names.select(text.upper_snake(F.col("n"))).collect()] == ["PUB_DATE", "ABCD", "NAV_AREA2_X", "PLAIN"]


def test_rolling_feed_order(spark):
    rows = [(p, f"tg_{s}", 100 - i, p * 1000 + i) for p in range(3) for s in "ba" for i in range(60)] + [(2, "bbc", 1, 1)]
    frame = spark.createDataFrame([(p, s, d, n + (500 if s == "tg_a" else 0)) for p, s, d, n in rows], "poll_id long, source string, date long, seq long")
    got = messages.rolling_feed(frame).collect()
    assert [r.part for r in got] == ["new"] * 120 + ["old"] * 100
    assert [(-r.poll_id, r.source, r.date) for r in got] == sorted((-r.poll_id, r.source, r.date) for r in got)
    assert {r.poll_id for r in got if r.part == "old"} == {1}


def test_history_and_following(spark):
    m = spark.createDataFrame([(c, i) for c in "xy" for i in range(9 if c == "x" else 2)], "channel string, message_id long")
    got = sorted((r.source, r.message_id) for r in messages.channel_history(m).collect())
    assert got == [("tg_x", i) for i in range(4, 9)] + [("tg_y", 0), ("tg_y", 1)]
    plan = messages.channel_history(m)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2  # one of them before the shuffle
    have, want = (spark.createDataFrame([(c,) for c in cs], "channel string") for cs in ("ab", "bccd"))
    assert sorted(r.channel for r in messages.follow(have, want).collect()) == ["a", "b", "c", "d"]


class Paragraphs(html.parser.HTMLParser):
    """Paragraph texts by a tag-by-tag walk."""

    def __init__(self):
        super().__init__()
        self.found, self.open, self.hidden = [], False, None

    def handle_starttag(self, tag, attrs):
        if tag in ("script", "style", "title"):
            self.hidden = tag
        elif tag == "p" or tag in articles.BLOCKS.split():
            self.open = tag == "p"
            if self.open:
                self.found.append("")

    def handle_endtag(self, tag):
        if tag == self.hidden:
            self.hidden = None
        elif tag in articles.PARENTS.split():
            self.open = False

    def handle_data(self, data):
        if self.open and not self.hidden:
            self.found[-1] += data


def test_articles_equal_a_tag_by_tag_walk(spark):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    got = {r.url: r.article for r in articles.articles(pages).collect()}
    for page in pages.collect():
        walk = Paragraphs()
        walk.feed(page.html)
        walk.close()
        kept = [p.strip() for p in walk.found if len(p.strip().encode()) > articles.MIN_BYTES]
        assert got[page.url] == ("\n\n".join(kept) or articles.NOTICE)


def test_article_rules(spark):
    long = "x" * 31
    cases = {
        f"<P class='a'>{long} &amp; &eacute;&#x41;</P>": f"{long} & éA",
        f"<div><p>{long}<div>inner {long}</div>{long}</div>": long,
        f"<p>{'é' * 15}</p><p>{'é' * 16}</p>": "é" * 16,
        f"<script>'<p>{long}</p>'</script><!-- <p>{long}</p> --><pre>{long}</pre>": articles.NOTICE,
        f"<p>{long}<p>{long}": f"{long}\n\n{long}",
        "<p>short</p>": articles.NOTICE,
    }
    frame = spark.createDataFrame([(k,) for k in cases], "html string").withColumn("got", articles.article_text(F.col("html")))
    assert {r.html: r.got for r in frame.collect()} == cases


def test_paragraphs_of_the_element_tree(spark):
    """What a tree builder by the HTML standard gives; d marks a page with a doctype."""
    d = "<!DOCTYPE html>"
    cases = {
        f"{d}<p>a<ul><li>b<p>c<li>d</ul>e": ["a", "c"],
        f"{d}<p>one<span></div>two</p>three": ["onetwo"],
        f"{d}<div><p>one<span>two</div>three": ["onetwo"],
        f"{d}<p>a<button><p>b<div>c</div></button>d</p>e": ["abcd", "b"],
        f"{d}<p>a<object><ul><li>x<li>y</ul></object>b<p>c": ["axyb", "c"],
        f"{d}<p>a<table><tr><td>b<p>c</table>d": ["a", "c"],
        "<p>a<table><tr><td>b<p>c<td>e</table>d</p>f": ["abced", "c"],
        f"{d}<table><tr><td><p>a<td><p>b<tr><td>c<p>d</table><p>e": ["a", "b", "d", "e"],
        f"{d}<table><tr><td><p>a</tr>b</table>": ["a"],
        f"{d}<dl><dt><p>a<dd>b<p>c</dl>d": ["a", "c"],
        f"{d}<ul><li><p>a<div><p>b<li>c</ul>": ["a", "b"],
        f"{d}<ul><li><p>a<ul><li>b</ul>c<p>e</li></ul>": ["a", "e"],
        f"{d}<h1>t<p>a</h2>b": ["a"],
        f"{d}<p>a<hr>b<p>c<br>d<img src=x>e": ["a", "cde"],
        f"{d}<p>a</li></td></tr>b</body></html>c": ["abc"],
        f"{d}<P>x<!-- </p> -->y<script>'</p>&amp;'</script>z&amp;&lt;</P>": ["xy'</p>&amp;'z&<"],
        f"{d}<p>a<template><p>b</template>c": ["ac"],
        f"{d}<p>a&am<b>p;</b>": ["a&amp;"],
        f"{d}<form><p>a<td>b</form>c": ["ab"],
        f"{d}</p>a<p></p><p>b": ["", "b"],
        "": [],
        "no markup": [],
    }
    frame = spark.createDataFrame([(i, k) for i, k in enumerate(cases)], "i int, html string")
    got = {r.i: r.p for r in frame.select("i", paragraphs(F.col("html")).alias("p")).collect()}
    assert [got[i] for i in range(len(cases))] == list(cases.values())
    assert spark.createDataFrame([(None,)], "html string").select(paragraphs(F.col("html"))).first()[0] is None


def test_references(spark):
    frame = spark.createDataFrame([("a &lt;b&gt; &#8364; &nope; & &copy;",), ("&amp;lt; &#x1F600;",), ("plain",)], "s string")
    got = [(r[0], r[1]) for r in frame.select(unescape_html(F.col("s")), unescape_xml(F.col("s"))).collect()]
    assert got == [("a <b> € &nope; & ©", None), ("&lt; \U0001f600", "&lt; \U0001f600"), ("plain", "plain")]


def test_points_to_features_and_back(spark):
    rows = spark.createDataFrame(
        [(0, 32.0853, 34.7818, "Tel Aviv", 5), (1, 31.7683, 35.2137, "Jerusalem", 3), (2, None, None, "Unknown", 0)],
        "id long, latitude double, longitude double, city string, threat_level long",
    )
    features = geometry.to_features(rows, "israel_cities", "id")
    collections = geometry.to_collections(features)
    back = geometry.from_collections(collections, {"city": "string", "threat_level": "bigint"}).orderBy("feature_id").collect()
    assert [tuple(r) for r in back] == [
        ("israel_cities", 0, int(34.7818 * 10000), int(32.0853 * 10000), "Tel Aviv", 5),
        ("israel_cities", 1, int(35.2137 * 10000), int(31.7683 * 10000), "Jerusalem", 3),
    ]
    assert [r.layer for r in geometry.layers(collections).collect()] == ["israel_cities"]
    assert geometry.to_collections(features, 1).count() == 2
    custom = rows.toDF("id", "lat", "lon", "name", "n")
    assert geometry.to_features(custom, "x", "id", "lat", "lon").count() == 2
    with pytest.raises(ValueError):
        geometry.to_features(custom, "x", "id")


def test_cable_geometries(payloads):
    text_ = (
        '{"features":[{"properties":{"name":"A","id":"a"},"geometry":{"type":"LineString","coordinates":[[1,2],[3,4.5]]}},'
        '{"properties":{},"geometry":{"type":"MultiLineString","coordinates":[[[1,2]],[[3,4],[5,6]]]}},'
        '{"geometry":{"type":"Point","coordinates":[1,2]}},{"geometry":{"type":"LineString","coordinates":[["x",2]]}},{}]}'
    )
    rows = geometry.cable_paths(payloads(text_)).orderBy("pos").collect()
    assert [(r.name, r.id, r.geometry) for r in rows] == [
        ("A", "a", [[(1.0, 2.0), (3.0, 4.5)]]), ("Unknown", "Unknown", [[(1.0, 2.0)], [(3.0, 4.0), (5.0, 6.0)]]),
        ("Unknown", "Unknown", None), ("Unknown", "Unknown", None), ("Unknown", "Unknown", None),
    ]


def test_column_order_and_sorts(spark):
    columns = ["ObjectId", "capacity", "capacity_cargo", "Date", "portid", "chokepoint_name", "capacity_tanker"]
    assert views.front_first(columns) == [
        "chokepoint_name", "Date", "capacity", "capacity_cargo", "capacity_tanker", "ObjectId", "portid"
    ]
    markets = spark.createDataFrame([("a", 1.0), ("b", None), ("c", 3.0)], "title string, volume double")
    assert [r.title for r in views.by_volume(markets).collect()] == ["b", "c", "a"]
    dates = spark.createDataFrame([("2023-01-01",), ("2024-01-01",)], "date string")
    assert [r.date for r in views.latest_first(dates).collect()] == ["2024-01-01", "2023-01-01"]


def test_registry(spark):
    assert len(registry.supported_sources()) == 30 and registry.supported_sources()[0] == "ACLED"
    own = registry.Adapter("MINE", "dynamic", "https://mine.example.com")
    given = [(0, "BBC", None, None), (1, "BBC", "x", "u"), (2, "MINE", "x", ""), (3, "USGS", "", "v")]
    rows = registry.resolve(
        spark.createDataFrame(given, "reg_no long, adapter string, name string, url string"), registry.catalogue(spark, [own])
    )
    assert sorted(tuple(r) for r in rows.collect()) == [
        ("bbc", "rss", registry.adapter("BBC").default_url), ("usgs", "usgs", "v"), ("x", "dynamic", "https://mine.example.com")
    ]
