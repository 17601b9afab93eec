"""Places in an order against sorting in plain Python."""

import random

import pytest
from pyspark.sql import functions as F

from beaconlake.operators import views
from beaconlake.operators.ranks import numbered

SCHEMA = "g string, a double, b int"


def rows_of(n, seed=1):
    pick = random.Random(seed)
    groups = [None, "", "x", "hot", "hot", "hot"]
    return [(pick.choice(groups), pick.choice([None, 1.0, 2.5, float(i % 7)]), i) for i in range(n)]


@pytest.mark.parametrize("n", [0, 1, 700])
def test_places_over_all_rows_and_in_groups(spark, n):
    rows = rows_of(n)
    frame = spark.createDataFrame(rows, SCHEMA).repartition(5)
    order = [F.desc_nulls_first("a"), F.col("b")]
    key = lambda r: (r[1] is not None, -(r[1] or 0), r[2])
    got = {r.b: r.place for r in numbered(frame, order, start=1).collect()}
    assert got == {r[2]: i + 1 for i, r in enumerate(sorted(rows, key=key))}

    inside, sizes, expected = {}, {}, {}
    for r in sorted(rows, key=key):
        expected[r[2]] = inside[r[0]] = inside.get(r[0], -1) + 1
        sizes[r[0]] = sizes.get(r[0], 0) + 1
    found = numbered(frame, order, ["g"], place="at", total="of").collect()
    assert {r.b: r.at for r in found} == expected
    assert all(r["of"] == sizes[r.g] for r in found)


def test_no_task_holds_a_hot_group(spark):
    """With tables too large to be read by one task, as these settings make them."""
    small = {"spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.files.maxPartitionBytes": "4k", "spark.sql.files.openCostInBytes": "4k"}
    before = {k: spark.conf.get(k) for k in small}
    for k, v in small.items():
        spark.conf.set(k, v)
    try:
        frame = spark.range(4000).select(F.lit("hot").alias("g"), F.col("id").alias("b")).repartition(6)
        rows = numbered(frame, [F.col("b")], ["g"])
        tasks = rows.groupBy(F.spark_partition_id()).count().collect()
        assert len(tasks) >= 4 and max(r["count"] for r in tasks) < 2000
        assert rows.where("place <> b").count() == 0
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_sorted_views_show_places(spark):
    markets = spark.createDataFrame([("a", 1.0, 3), ("b", None, 1), ("c", 5.0, 2), ("d", 1.0, 0)], "title string, volume double, seq int")
    got = {r.title: r.place for r in views.by_volume(markets, ("seq",), "place").collect()}
    assert got == {"b": 1, "c": 2, "d": 3, "a": 4}
    dates = spark.createDataFrame([("2023-01-01",), ("2024-01-01",), (None,)], "date string")
    assert {r.date: r.place for r in views.latest_first(dates, place="place").collect()} == {None: 1, "2024-01-01": 2, "2023-01-01": 3}
