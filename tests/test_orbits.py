"""Propagation against published positions, ground positions, broken elements."""

import datetime
import math

import pytest
from pyspark.sql import functions as F

from beaconlake.functions import sgp4
from beaconlake.operators import orbits, tle

ISS = (
    "1 25544U 98067A   20194.88612269 -.00002218  00000-0 -31515-4 0  9992",
    "2 25544  51.6461 221.2784 0001413  89.1723 280.4612 15.49507896236008",
)
LEO = (
    "1 42982U 98067NE  20194.06866787  .00008489  00000-0  72204-4 0  9997",
    "2 42982  51.6338 155.6245 0002758 166.8841 193.2228 15.70564504154944",
)

# Published verification vectors (WGS-72): minutes since epoch and position in km.
VECTORS = [
    ("1 00005U 58002B   00179.78495062  .00000023  00000-0  28098-4 0  4753",
     "2 00005  34.2682 348.7242 1859667 331.7664  19.3264 10.82419157413667",
     [(0.0, 7022.46529266, -1400.08296755, 0.03995155), (360.0, -7154.03120202, -3783.17682504, -3536.19412294)]),
    ("1 04632U 70093B   04031.91070959 -.00000084  00000-0  10000-3 0  9955",
     "2 04632  11.4628 273.1101 1450506 207.6000 143.9350  1.20231981 44145",
     [(0.0, 2334.11450085, -41920.44035349, -0.03867437), (-5184.0, -29020.02587128, 13819.84419063, -5713.33679183)]),
    ("1 06251U 62025E   06176.82412014  .00008885  00000-0  12808-3 0  3985",
     "2 06251  58.0579  54.0425 0030035 139.1568 221.1854 15.56387291  6774",
     [(0.0, 3988.31022699, 5498.96657235, 0.90055879)]),
    ("1 08195U 75081A   06176.33215444  .00000099  00000-0  11873-3 0   813",
     "2 08195  64.1586 279.0717 6877146 264.7651  20.2257  2.00491383225656",
     [(0.0, 2349.89483350, -14785.93811562, 0.02119378), (120.0, 15223.91713658, -17852.95881713, 25280.39558224)]),
    ("1 28129U 03058A   06175.57071136 -.00000104  00000-0  10000-3 0   459",
     "2 28129  54.7298 324.8098 0048506 266.2640  93.1663  2.00562768 18443",
     [(0.0, 21707.46412351, -15318.61752390, 0.13551152), (120.0, 18616.75971861, 3166.15177043, 18833.41523210)]),
]
PAIRS = "tle_line1 string, tle_line2 string"


def test_published_positions(spark):
    rows = [(l1, l2, t, x, y, z) for l1, l2, places in VECTORS for t, x, y, z in places]
    frame = spark.createDataFrame(rows, PAIRS + ", minutes double, x double, y double, z double")
    moved = sgp4.propagate(tle.elements(frame), "minutes", sgp4.WGS72)
    got = moved.select("x", "x_km", "y", "y_km", "z", "z_km").collect()
    assert len(got) == len(rows)
    for r in got:
        assert r.x_km == pytest.approx(r.x, abs=1e-6)
        assert r.y_km == pytest.approx(r.y, abs=1e-6)
        assert r.z_km == pytest.approx(r.z, abs=1e-6)
    plan = moved._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Exchange" not in plan


def test_ground_positions_and_garbage(spark):
    at = F.lit(datetime.datetime(2020, 7, 13, 12, 0)).cast("timestamp")
    broken_sum = ISS[1][:-1] + "9"
    rows = [ISS, LEO, ("GARBAGE", "DATA"), ("", ""), (ISS[0], broken_sum), (ISS[0], LEO[1])]
    frame = spark.createDataFrame(rows, PAIRS)
    got = orbits.positions_at(frame, at).collect()
    assert len(got) == 6
    by_pair = {(r.tle_line1, r.tle_line2): r for r in got}
    for pair in (ISS, LEO):
        r = by_pair[pair]
        assert -90 <= r.latitude <= 90 and -180 <= r.longitude <= 180 and r.altitude_km > 200
    for pair in rows[2:]:
        r = by_pair[pair]
        assert math.isnan(r.latitude) and math.isnan(r.longitude) and math.isnan(r.altitude_km)
    assert orbits.ground_positions(frame, at).count() == 2
    assert orbits.positions_at(spark.createDataFrame([], PAIRS), at).count() == 0


def test_tracks_have_a_row_per_step_and_agree_with_single_positions(spark):
    start, end = (F.lit(datetime.datetime(2020, 7, 13, h)).cast("timestamp") for h in (12, 13))
    frame = spark.createDataFrame([ISS, LEO], PAIRS)
    tracks = orbits.ground_tracks(frame, start, end, F.expr("INTERVAL 20 MINUTES")).cache()
    assert tracks.count() == 8
    last = {r.tle_line1: (r.latitude, r.longitude) for r in tracks.where(F.col("at") == end).collect()}
    assert last == {r.tle_line1: (r.latitude, r.longitude) for r in orbits.positions_at(frame, end).collect()}


def test_longitude_wraps_and_offset(spark):
    rows = spark.createDataFrame([(7000.0, 0.0, 0.0), (-7000.0, 0.0, 0.0), (0.0, 0.0, 7000.0), (None, None, None)], "x_km double, y_km double, z_km double")
    noon = F.lit("2000-01-01 12:00:00").cast("timestamp")
    got = [(r.latitude, r.longitude, r.altitude_km) for r in orbits.ground(rows, noon).collect()]
    assert got[:3] == [(0.0, 0.0, 629.0), (0.0, 180.0, 629.0), (90.0, 0.0, 629.0)]
    assert math.isnan(got[3][0])
    shifted = orbits.ground(rows, noon, 280.46062).first()
    assert shifted.longitude == pytest.approx(360 - 280.46062)


def test_few_sets_far_from_their_epoch(spark):
    """Few bytes but much work: dealt out over all tasks."""
    from beaconlake.plans.orbit_queries import PUBLISHED

    rows = [(i, PUBLISHED[i % 4][0], PUBLISHED[i % 4][1]) for i in range(64)]
    frame = spark.createDataFrame(rows, "key long, tle_line1 string, tle_line2 string").coalesce(1)
    at = F.lit("2008-06-27 00:00:00").cast("timestamp")
    found = orbits.positions_at(frame, at, sgp4.WGS72)
    tasks = found.groupBy(F.spark_partition_id()).count().count()
    assert tasks == int(spark.conf.get("spark.sql.shuffle.partitions"))


def test_harmonics_are_the_terms_of_the_resonance(spark):
    """The sums of the stepped integration against the terms one by one, in both classes."""
    import random

    names = [c for c, *_ in sgp4._TERMS_1 + sgp4._TERMS_2]
    pick = random.Random(3)
    rows = [[*(pick.uniform(-1e-6, 1e-6) for _ in names), *(pick.uniform(0, 6) for _ in range(2)), pick.uniform(-1e-5, 1e-5), pick.uniform(0, 6), 0.0087, 1e-4, k, 720.0 * n * (-1) ** n]
            for n, k in [(n, k) for n in range(7) for k in (1, 2)]]
    columns = [*names, "argp", "mean", "argpdot", "lam0", "no", "lamdot", "class", "t"]
    df = spark.createDataFrame(rows, columns)
    df = sgp4._stage(sgp4._stage(df, f"step = sign(t) * {sgp4.STEP!r}\n" + sgp4._harmonics()), sgp4._integrated())
    for r in df.collect():
        at, lam, n = 0.0, r.lam0, r.no
        for _ in range(int(abs(r.t) // sgp4.STEP)):
            omega = r.argp + r.argpdot * at
            terms = sgp4._TERMS_1 if r["class"] == 1 else sgp4._TERMS_2
            angles = [(t[0], t[-2], t[1] * (lam - t[2]) if len(t) == 3 else t[1] * omega + t[2] * lam - t[3]) for t in terms]
            ndot = sum(r[c] * math.sin(angle) for c, _, angle in angles)
            turn = n + r.lamdot
            nddot = sum(m * r[c] * math.cos(angle) for c, m, angle in angles) * turn
            at, lam, n = (at + r.step, lam + turn * r.step + ndot * sgp4.STEP**2 / 2, n + ndot * r.step + nddot * sgp4.STEP**2 / 2)
        assert (r.res.at, r.res.lam, r.res.n) == pytest.approx((at, lam, n), rel=1e-11)
