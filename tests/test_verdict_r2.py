"""Named references of the HTML standard, and grids longer than one stretch."""

import datetime
import html

from pyspark.sql import functions as F

from beaconlake.functions.entities import unescape_html
from beaconlake.operators import orbits
from beaconlake.sources import raw
from tests.test_orbits import ISS, PAIRS


def test_references_like_the_standard(spark):
    texts = [
        "&check; &bigstar;", "a&nbsp b", "&notit; &notin;", "&#150;&#0065;&#x41 &#65", "&foo; & &&amp;lt;", "&AMP &ampx",
        "&NotEqualTilde;", "plain", "&eacute&eacute;t", "", None,
    ]
    frame = spark.createDataFrame([(t,) for t in texts], "t string")
    got = frame.select("t", unescape_html(F.col("t")).alias("u")).collect()
    assert [r.u for r in got] == [None if r.t is None else html.unescape(r.t) for r in got]


def test_long_grid_is_cut_and_constants_come_first(spark):
    start = datetime.datetime(2020, 7, 13, 12)
    steps = 2 * orbits.STRETCH + 5
    end = start + datetime.timedelta(seconds=steps)
    first, last = (F.lit(t).cast("timestamp") for t in (start, end))
    frame = spark.createDataFrame([ISS, ISS], PAIRS)
    tracks = orbits.ground_tracks(frame, first, last, F.expr("INTERVAL 1 SECOND"))
    counts = tracks.groupBy("at").count().groupBy("count").agg(F.count("*").alias("n")).collect()
    assert [(r["count"], r.n) for r in counts] == [(2, steps + 1)]
    plan = tracks._jdf.queryExecution().optimizedPlan().toString()
    # Operators are shown from the last to the first.
    instants = plan.index("Generate explode(sequence(")
    assert plan.index("AS rk#") < instants < min(plan.index(f"AS {name}#") for name in ("mdot", "argpdot", "no", "cosi"))


def test_caps_of_any_size_reduce_before_the_shuffle(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(raw, "staged", lambda frame, label: seen.append(frame) or frame)
    rows = spark.range(20000).selectExpr(
        "concat('s', id % 1) AS source", "id AS seq", "timestamp_seconds(id) AS fetched_at", "CAST(id AS STRING) AS payload"
    )
    kept = raw.cap_newest(rows, 5000).agg(F.count("*"), F.min("seq")).first()
    assert tuple(kept) == (5000, 15000)
    plan = seen[0]._jdf.queryExecution().executedPlan().toString()
    # From the last operator to the first: two ranks, each cut before and after its own shuffle.
    assert plan.rindex("WindowGroupLimit") > plan.rindex("Exchange")
    assert plan.count("WindowGroupLimit") == 4
