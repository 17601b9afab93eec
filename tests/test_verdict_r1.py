"""Values that must not lose data or end a job."""

import json

import pytest
from pyspark.sql import functions as F

from beaconlake.functions.entities import unescape_html
from beaconlake.operators import articles, dynamic, geometry, polls
from beaconlake.sources import raw
from beaconlake.streaming import vessels as vessel_stream


def test_dynamic_names_stay(payloads):
    record = {"AVOIDED": 1, "OBJECT<x": {"DEVOID": 1.5, "q`t": [1, None]}, "a b": "s", "DECIMAL(1,2)": 2.25, "VOID": None}
    rows = dynamic.extract(payloads(json.dumps({"data": [record]}), '{"data":[{"AVOI'))
    row = rows.first().asDict(recursive=True)
    assert row["AVOIDED"] == 1 and row["OBJECT<x"] == {"DEVOID": 1.5, "q`t": [1, None]}
    assert row["a b"] == "s" and row["DECIMAL(1,2)"] == 2.25 and row["VOID"] is None and dict(rows.dtypes)["VOID"] == "string"


def test_objects_keyed_by_id_stay_variant(payloads):
    rows = dynamic.extract(payloads(json.dumps([{"id": 1, "prices": {f"k{i}": i for i in range(300)}}])))
    assert dict(rows.dtypes)["prices"] == "variant"


def test_grid_saturates(spark):
    values = [float("nan"), float("inf"), float("-inf"), 1e9, -1e9, 1.5]
    rows = spark.createDataFrame([(i, v, 0.0) for i, v in enumerate(values)], "id long, latitude double, longitude double")
    found = geometry.to_features(rows, "l", "id").orderBy("feature_id").collect()
    got = [json.loads(r.feature)["geometry"]["coordinates"][1] for r in found]
    assert got == [0, 2**31 - 1, -(2**31), 2**31 - 1, -(2**31), int(1.5 * geometry.GRID)]


def test_messages_keep_line_breaks(spark, payloads, tmp_path):
    path, texts = str(tmp_path / "m"), ["a", "l1\nl2\r\n\\n\\", "tab\tin", '{"x":"\\n"}', "\\"]
    raw.write_messages(payloads(*texts, source="ais"), path)
    spark.createDataFrame([("no tab here", "ais"), ("x\ty", "ais")], "value string, source string").write.mode("append").partitionBy("source").text(path)
    assert [r.payload for r in raw.read_messages(spark, path).orderBy("seq").collect()] == texts
    assert sorted(r.payload for r in raw.message_rejects(spark, path).collect()) == ["no tab here", "x\ty"]


def test_news_stays_one_row(spark):
    news = spark.createDataFrame([(1, "t", "u", "d"), (2, "t", None, "d"), (3, "t", "v", None)], "id int, title string, link string, pubDate string")
    text = "<p>the newest text of a page that is long enough to count</p>"
    pages = spark.createDataFrame([(1, "u", "<p>an old text of a page that is long enough</p>"), (2, "u", text), (3, "#", text)], "page_id int, url string, html string")
    found = {r.id: r for r in articles.news_with_text(news, pages).collect()}
    assert len(found) == 3 and found[1].article.startswith("the newest") and found[2].link == "#"
    assert found[2].article == found[3].article == articles.NOTICE


def test_numeric_references_of_any_length(spark):
    row = spark.range(1).select(unescape_html(F.lit("&#00000065;&#x000000042;&#99999999999;&#xFFFFFFFFFF;")).alias("t")).first()
    assert row.t == "AB&#99999999999;&#xFFFFFFFFFF;"


def test_poll_folds_vessels_once(payloads, monkeypatch):
    calls, fold = [], polls.vessels.enriched
    monkeypatch.setattr(polls.vessels, "enriched", lambda updates: calls.append(1) or fold(updates))
    tables = polls.poll(payloads("{}", source="a"), {"a": "ais", "d": "digitraffic", "u": "usgs"})
    tables["u"].count()
    assert not calls and set(tables) == {"a", "d", "u"}
    tables["a"].count(), tables["d"].count()
    assert len(calls) == 1


def test_vessel_stream_needs_a_vessel_feed(payloads, tmp_path):
    with pytest.raises(ValueError):
        vessel_stream.start_vessels(payloads("{}"), {"s": "usgs"}, str(tmp_path), str(tmp_path / "c"))
