"""Vessel state against a row-by-row fold in plain Python, whole and in pieces."""

import random

import pytest
from pyspark.sql import functions as F

from beaconlake.operators import health, polls, vessels
from beaconlake.plans.vessel_queries import MIXED_SOURCES, mixed_payloads

SF = "/root/testdata/sf0.001"


def fold(updates):
    """The write rules one row at a time; returns the state after each row and the last one per vessel."""
    state, after = {}, []
    for u in sorted(updates, key=lambda r: (r.seq, r.pos)):
        s = state.setdefault(u.mmsi, {"name": "", "type": 0, "dest": "", "seen": 0, "lat": 0.0, "lon": 0.0, "nav": 0})
        if u.live:
            s.update(seen=int(u.fetched_at.timestamp()), lat=u.latitude, lon=u.longitude, nav=u.nav_status)
        unnamed = s["name"] in ("", "Unknown")
        if u.act == "set":
            s.update(name=u.name, type=u.ship_type, dest=u.destination)
        elif u.act == "name" and unnamed:
            s["name"] = u.name
        elif u.act == "dummy" and unnamed:
            s.update(name="Baltic Vessel", type=80, dest="Unknown")
        after.append((u.seq, u.pos, u.mmsi, s["name"], s["type"], s["dest"]))
    last = [(m, s["name"], s["type"], s["dest"], s["seen"], s["lat"], s["lon"], s["nav"]) for m, s in state.items()]
    return sorted(after), sorted(last)


def check(updates, piece):
    after, last = fold(updates.collect())
    running = vessels.running_state(updates, piece).select("seq", "pos", "mmsi", "state.name", "state.ship_type", "state.destination")
    assert sorted(tuple(r) for r in running.collect()) == after
    assert sorted(tuple(r) for r in vessels.vessel_state(updates).collect()) == last


@pytest.mark.parametrize("piece", [vessels.PIECE, 97, 1])
def test_mixed_feeds_equal_the_fold(spark, piece):
    check(polls.vessel_updates(mixed_payloads(spark, SF), MIXED_SOURCES).cache(), piece)


def test_random_updates_of_one_hot_vessel(spark):
    rng = random.Random(7)
    rows = []
    for seq in range(600):
        mmsi = 1 if rng.random() < 0.7 else rng.randint(2, 4)
        act = rng.choices(["set", "name", "dummy", "none"], [1, 6, 2, 4])[0]
        name = rng.choice(["", "Unknown", f"N{seq}"])
        rows.append((seq, 0, mmsi, act, rng.random() < 0.6, float(seq), -float(seq), seq % 16, name, seq % 90, f"D{seq}"))
    updates = spark.createDataFrame(
        rows,
        "seq long, pos int, mmsi long, act string, live boolean, latitude double, longitude double, nav_status long, "
        "name string, ship_type long, destination string",
    ).withColumns(
        {
            "source": F.lit("x"), "fetched_at": F.timestamp_seconds(F.col("seq") + 1710760000), "given_name": F.lit(None).cast("string"),
            "sog": F.lit(None).cast("double"), "cog": F.lit(None).cast("double"),
        }
    ).cache()
    for piece in (1000, 50, 3):
        check(updates, piece)


def test_dark_vessels_borders(spark):
    schema = "mmsi long, name string, ship_type long, destination string, last_seen long, latitude double, longitude double, nav_status long"
    base = dict(name="n", ship_type=70, destination="d", last_seen=820, latitude=1.0, longitude=1.0, nav_status=0)
    cases = [{}, {"last_seen": 819}, {"ship_type": 89, "last_seen": 1}, {"ship_type": 90, "last_seen": 1}, {"nav_status": 1, "last_seen": 1},
             {"latitude": 0.0, "last_seen": 1}, {"longitude": 0.0, "last_seen": 1}, {"ship_type": 69, "last_seen": 1}]
    rows = [tuple({"mmsi": i, **base, **c}[k] for k in ["mmsi", *base]) for i, c in enumerate(cases)]
    dark = vessels.dark_vessels(spark.createDataFrame(rows, schema), F.timestamp_seconds(F.lit(1000)), 0.05)
    assert sorted(r.mmsi for r in dark.collect()) == [1, 2]


def test_latest_is_the_last_row_not_any(spark):
    rows = spark.createDataFrame(
        [(i, 0, i % 3, float(i), 1.0, 75) for i in range(300)], "seq long, pos int, mmsi long, latitude double, longitude double, ship_type long"
    ).repartition(7)
    assert sorted((r.mmsi, r.seq) for r in vessels.latest(rows).collect()) == [(0, 297), (1, 298), (2, 299)]
    assert vessels.cargo_tankers(rows.withColumn("latitude", F.when(F.col("seq") < 298, F.col("latitude")))).count() == 3


def snapshots_of_vessel_0(spark, payloads=6, records=4000):
    """Digitraffic snapshots whose records have no number, so that all of them are vessel 0, and a few of vessel 5."""
    record = F.format_string(
        '{"properties":{"sog":1.5,"navStat":0%s},"geometry":{"coordinates":[%s,2.5]}}',
        F.when(F.col("i") % 1000 == 7, ',"mmsi":5').otherwise(""), (F.col("i") % 90 + 1).cast("string"),
    )
    ids = spark.range(payloads).select(F.col("id").alias("seq"), F.explode(F.sequence(F.lit(0), F.lit(records - 1))).alias("i"))
    listed = ids.groupBy("seq").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("i", record.alias("r")))), lambda x: x["r"]), ",").alias("body"))
    return listed.select(
        F.lit("digitraffic").alias("source"), "seq", F.timestamp_seconds(F.col("seq") + 1710760000).alias("fetched_at"),
        F.concat(F.lit('{"features":['), "body", F.lit("]}")).alias("payload"),
    )


def test_a_hot_vessel_within_a_payload_is_cut_by_rows(spark):
    updates = vessels.digitraffic_updates(snapshots_of_vessel_0(spark)).cache()
    piece = 1500
    check(updates, piece)
    cut = vessels._cut(updates, piece)
    sizes = cut.groupBy("mmsi", "piece").count().collect()
    assert max(r["count"] for r in sizes) <= piece
    assert len([r for r in sizes if r.mmsi == 0]) == 16 and [r.piece for r in sizes if r.mmsi == 5] == [0]


def test_the_state_is_reduced_before_the_shuffle(spark):
    updates = polls.vessel_updates(mixed_payloads(spark, SF), MIXED_SOURCES)
    plan = vessels.vessel_state(updates)._jdf.queryExecution().executedPlan().toString()
    assert "partial_max" in plan and "Window" not in plan and "Python" not in plan


def test_last_reports_are_the_last_rows_of_enriched(spark):
    updates = polls.vessel_updates(mixed_payloads(spark, SF), MIXED_SOURCES).cache()
    wanted = vessels.latest(vessels.enriched(updates).dropna(subset=["longitude", "latitude"]))
    got = vessels.last_reports(updates).select(wanted.columns)
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(map(tuple, wanted.collect()), key=repr)


def test_failure_streaks(spark):
    rng = random.Random(3)
    rows = [(s, i * 3 + n, rng.random() < 0.25) for n, s in enumerate("ab") for i in range(400)]
    expected, streak = {}, {}
    for source, seq, ok in sorted(rows, key=lambda r: r[1]):
        streak[source] = 0 if ok else streak.get(source, 0) % 5 + 1
        expected[(source, seq)] = streak[source]
    fetches = spark.createDataFrame(rows, "source string, seq long, ok boolean").repartition(5)
    for piece in (10**6, 40, 1):
        got = {(r.source, r.seq): r.streak for r in health.failure_streaks(fetches, piece).collect()}
        assert got == expected
    a = health.feed_health(fetches, 40).where("source = 'a'").first()
    assert a.requests == 400 and a.trips == sum(1 for (s, _), n in expected.items() if s == "a" and n == 5)
