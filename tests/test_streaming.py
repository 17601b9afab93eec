"""Streams end with what the batch operators find on the same payloads."""

import os

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from beaconlake.operators import feeds, polls, vessels
from beaconlake.plans.vessel_queries import MIXED_SOURCES, mixed_payloads
from beaconlake.sources import raw
from beaconlake.streaming import ingest, ledger, vessels as vessel_stream

SF = "/root/testdata/sf0.001"


def land(payloads, path, cuts):
    """Land payloads in several files, in arrival order."""
    for low, high in zip(cuts, cuts[1:]):
        part = payloads.where((F.col("seq") >= low) & (F.col("seq") < high))
        part.coalesce(1).write.mode("append").parquet(path)


def rows_of(frame):
    return sorted(map(tuple, frame.collect()), key=repr)


def test_vessel_stream_equals_batch(spark, tmp_path):
    all_payloads = mixed_payloads(spark, SF).cache()
    landed, out, cp = (str(tmp_path / n) for n in ("landed", "out", "cp"))
    cuts = [0, 137, 400, 401, 777, 10**9]
    for low, high in zip(cuts, cuts[1:]):
        land(all_payloads, landed, [low, high])
        query = vessel_stream.start_vessels(
            ingest.read_raw_stream(spark, landed), MIXED_SOURCES, out, cp, period=None
        )
        query.awaitTermination()
        assert query.exception() is None
    batch_state = vessels.vessel_state(polls.vessel_updates(all_payloads, MIXED_SOURCES))
    assert rows_of(vessel_stream.read_state(spark, cp).select(batch_state.columns)) == rows_of(batch_state)

    # A silence is alerted once, when the clock of the payloads so far first shows the vessel dark.
    expected = set()
    for high in cuts[1:]:
        so_far = all_payloads.where(F.col("seq") < high)
        now = so_far.agg(F.max("fetched_at")).first()[0]
        state = vessels.vessel_state(polls.vessel_updates(so_far, MIXED_SOURCES)).cache()
        dark = vessels.dark_vessels(state, F.lit(now), 0.05).join(state.select("mmsi", "last_seen"), "mmsi").collect()
        expected |= {(r.mmsi, r.last_seen) for r in dark}
    got = rows_of(vessel_stream.read_alerts(spark, out).select("mmsi", "last_seen"))
    assert got == sorted(expected, key=repr)
    assert len(expected) > 0


AIS = '{{"MessageType":"{kind}","MetaData":{{"MMSI":{mmsi},"ShipName":"S{mmsi}","latitude":1.5,"longitude":2.5}},"Message":{{"{kind}":{{{body}}}}}}}'


def report(mmsi, at, nav=0):
    return ("ais_stream", AIS.format(kind="PositionReport", mmsi=mmsi, body=f'"Sog":1,"Cog":2,"NavigationalStatus":{nav}'), at)


def cargo(mmsi, at, kind=75):
    return ("ais_stream", AIS.format(kind="ShipStaticData", mmsi=mmsi, body=f'"UserID":{mmsi},"Type":{kind},"Name":"C{mmsi}","Destination":"D"'), at)


class Voyage:
    """A vessel stream that is fed step by step; times are seconds."""

    def __init__(self, spark, folder, **options):
        self.spark, self.options, self.seq = spark, options, 0
        self.landed, self.out, self.cp = (str(folder / n) for n in ("landed", "out", "cp"))

    def feed(self, *payloads):
        rows = [(source, self.seq + i, text, at) for i, (source, text, at) in enumerate(payloads)]
        self.seq += len(rows)
        frame = self.spark.createDataFrame(rows, "source string, seq bigint, payload string, at bigint")
        frame.selectExpr("source", "seq", "timestamp_seconds(at) AS fetched_at", "payload").coalesce(1).write.mode("append").parquet(self.landed)
        stream = ingest.read_raw_stream(self.spark, self.landed)
        query = vessel_stream.start_vessels(stream, {"ais_stream": "ais", "usgs": "usgs"}, self.out, self.cp, period=None, **self.options)
        query.awaitTermination()
        return query

    def alerts(self):
        return sorted((r.mmsi, r.last_seen) for r in vessel_stream.read_alerts(self.spark, self.out).collect())


def test_silence_is_alerted_once_and_a_report_cancels_it(spark, tmp_path):
    voyage = Voyage(spark, tmp_path)
    voyage.feed(cargo(1, 1000), cargo(2, 1000), cargo(3, 1000, 60), report(1, 1000), report(2, 1000), report(3, 1000), report(4, 1000))
    assert voyage.alerts() == []
    voyage.feed(report(2, 1150))  # cancels the alert of vessel 2
    voyage.feed(("usgs", "{}", 1180))  # silent for 180 seconds, which is not longer than the timeout
    assert voyage.alerts() == []
    voyage.feed(("usgs", "{}", 1181))  # the vessel feed is idle, another feed moves the clock
    assert voyage.alerts() == [(1, 1000)]
    voyage.feed(("usgs", "{}", 1300))
    assert voyage.alerts() == [(1, 1000)]
    voyage.feed(cargo(4, 1305))  # a vessel that turns out to be a cargo vessel, silent already
    voyage.feed(("usgs", "{}", 1306))
    assert voyage.alerts() == [(1, 1000), (4, 1000)]
    voyage.feed(report(1, 1310), ("usgs", "{}", 1600))  # vessel 2 dark, vessel 1 armed again and dark again
    voyage.feed(("usgs", "{}", 1601))
    assert voyage.alerts() == [(1, 1000), (1, 1310), (2, 1150), (4, 1000)]
    # a late payload is folded, not dropped: its time is before the clock
    voyage.feed(cargo(9, 10), report(9, 10, nav=1))
    state = {r.mmsi: (r.name, r.last_seen) for r in vessel_stream.read_state(spark, voyage.cp).collect()}
    assert state[9] == ("C9", 10) and state[1] == ("C1", 1310) and len(state) == 5


def test_a_batch_touches_its_own_vessels_only(spark, tmp_path):
    voyage = Voyage(spark, tmp_path)
    voyage.feed(*[cargo(i, 1000, 30) for i in range(1, 301)])
    query = voyage.feed(report(7, 1010), report(8, 1010), report(7, 1011))
    updated = [p.stateOperators[0].numRowsUpdated for p in query.recentProgress if p.stateOperators and p.numInputRows]
    assert updated and sum(updated) <= 2
    assert vessel_stream.read_state(spark, voyage.cp).count() == 300


def test_vessels_silent_for_long_are_forgotten(spark, tmp_path):
    voyage = Voyage(spark, tmp_path, forget_hours=1.0)
    voyage.feed(cargo(1, 1000), report(1, 1000), cargo(2, 1000), report(2, 1000))
    voyage.feed(report(2, 3000))
    voyage.feed(("usgs", "{}", 4700))
    assert voyage.alerts() == [(1, 1000), (2, 3000)]
    assert [r.mmsi for r in vessel_stream.read_state(spark, voyage.cp).collect()] == [2]


def test_an_idle_stream_raises_alerts_by_the_wall_clock(spark, tmp_path):
    import time

    landed, out, cp = (str(tmp_path / n) for n in ("landed", "out", "cp"))
    now = int(time.time())
    rows = [("ais_stream", i, text) for i, (_, text, _) in enumerate([cargo(1, 0), report(1, 0)])]
    frame = spark.createDataFrame(rows, "source string, seq bigint, payload string")
    frame.selectExpr("source", "seq", f"timestamp_seconds({now}) AS fetched_at", "payload").coalesce(1).write.parquet(landed)
    query = vessel_stream.start_vessels(
        ingest.read_raw_stream(spark, landed), {"ais_stream": "ais"}, out, cp, timeout_hours=3 / 3600, period="1 second", heartbeat=True
    )
    try:
        deadline = time.time() + 60
        while time.time() < deadline and not (query.exception() or _alerted(spark, out)):
            time.sleep(1)
        assert query.exception() is None
        assert _alerted(spark, out) == [1]
    finally:
        query.stop()


def _alerted(spark, out):
    try:
        return [r.mmsi for r in vessel_stream.read_alerts(spark, out).collect()]
    except AnalysisException:  # nothing written yet
        return []


def test_feed_stream_delivers_once_across_restarts(spark, tmp_path, payloads):
    texts = [f'{{"p":"{i}.5","q":"1"}}' for i in range(40)]
    landed, out, cp = (str(tmp_path / n) for n in ("landed", "out", "cp"))
    job = lambda stream: feeds.extract(stream, feeds.FEEDS["binance"])

    def start(period):
        return ingest.start_feed(ingest.read_raw_stream(spark, landed, 1), job, out, cp, "trades", period)

    raw_rows = payloads(*texts, source="binance")
    land(raw_rows, landed, [0, 10, 20])
    start(None).awaitTermination()
    land(raw_rows, landed, [20, 40])
    start(None).awaitTermination()
    assert sorted(r.price for r in spark.read.parquet(out).collect()) == [i + 0.5 for i in range(40)]


def test_start_stop_and_restart_by_name(spark, tmp_path, payloads):
    landed = str(tmp_path / "landed")
    land(payloads('{"p":"1","q":"1"}', source="binance"), landed, [0, 10])
    job = lambda stream: feeds.extract(stream, feeds.FEEDS["binance"])

    def start(period, name="one"):
        stream = ingest.read_raw_stream(spark, landed)
        return ingest.start_feed(stream, job, str(tmp_path / name), str(tmp_path / f"cp-{name}"), name, period)

    start("1 second").processAllAvailable()
    start("1 second", "two").processAllAvailable()  # a feed added while another runs
    assert set(ingest.running(spark)) == {"one", "two"}
    with pytest.warns(UserWarning, match="running already"):
        assert start("1 second").id == ingest.running(spark)["one"].id
    again = ingest.restart(spark, "one", start, "2 seconds")
    assert again.isActive and set(ingest.running(spark)) == {"one", "two"}
    assert ingest.stop(spark, "two") and not ingest.stop(spark, "two")
    ingest.stop_all(spark)
    assert ingest.running(spark) == {}
    assert spark.read.parquet(str(tmp_path / "one")).count() == 1


def test_poll_stream_caps_and_separates_sources(spark, tmp_path, payloads):
    landed, out = str(tmp_path / "landed"), str(tmp_path / "out")
    land(payloads(*[f'{{"p":"{i}"}}' for i in range(30)], source="binance"), landed, [0, 100])
    land(payloads('[{"title":"a","volume":1}]', source="polymarket"), landed, [0, 100])
    sources = {"binance": "binance", "polymarket": "polymarket"}
    stream = ingest.read_raw_stream(spark, landed)
    ingest.start_poll(stream, sources, out, str(tmp_path / "cp"), "poll", None, cap=7).awaitTermination()
    prices = [r.price for r in ingest.read_polled(spark, out, "binance").collect()]
    assert sorted(prices) == [float(i) for i in range(23, 30)]
    assert ingest.read_polled(spark, out, "polymarket").select("title", "volume").collect() == [("a", 1.0)]


def test_layers_stay_until_replaced(spark, tmp_path):
    landed, out = str(tmp_path / "landed"), str(tmp_path / "out")
    schema = "layer string, label string"

    def poll(rows):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(landed)
        stream = spark.readStream.schema(schema).parquet(landed)
        ingest.start_layers(stream, out, str(tmp_path / "cp"), "layers", None).awaitTermination()
        return sorted((r.layer, r.label) for r in ingest.read_layers(spark, out).collect())

    assert poll([("usgs", "a"), ("dark_ships", "d")]) == [("dark_ships", "d"), ("usgs", "a")]
    # the dark layer is gone when a poll has none, the other one stays
    assert poll([("opensky", "f")]) == [("opensky", "f"), ("usgs", "a")]
    assert poll([("usgs", "b"), ("usgs", "c")]) == [("opensky", "f"), ("usgs", "b"), ("usgs", "c")]


def test_snapshot_and_message_files_stream(spark, tmp_path, payloads):
    snapshots, messages = str(tmp_path / "snap"), str(tmp_path / "msg")
    bodies = ['{"a":1}', '{"a":\n2}', "\\n\r\n\\\\x\t", ""]
    raw.write_snapshots(payloads(*bodies, source="usgs"), snapshots)
    raw.write_messages(payloads("x", "y\nz", source="ais"), messages)
    for reader, path, expected in (
        (raw.read_snapshots, snapshots, [("usgs", i, body) for i, body in enumerate(bodies)]),
        (raw.read_messages, messages, [("ais", 0, "x"), ("ais", 1, "y\nz")]),
    ):
        stream = reader(spark, path, stream=True)
        query = stream.writeStream.format("memory").queryName("landing").trigger(availableNow=True).start()
        query.awaitTermination()
        got = [(r.source, r.seq, r.payload) for r in spark.table("landing").orderBy("seq").collect()]
        assert got == expected
        assert spark.table("landing").where("fetched_at is null").count() == 0
        assert rows_of(reader(spark, path)) == rows_of(spark.table("landing"))


def test_snapshots_land_in_few_files(spark, tmp_path, payloads):
    path = str(tmp_path / "snap")
    given = payloads(*[f'{{"n":{i}}}' for i in range(500)], source="usgs").coalesce(2)
    raw.write_snapshots(given, path)
    raw.write_snapshots(payloads("late").withColumn("seq", F.lit(900).cast("bigint")), path)
    files = [n for n in os.listdir(f"{path}/source=usgs") if n.startswith("part-")]
    assert len(files) == 2
    back = raw.read_snapshots(spark, path)
    assert rows_of(back.where("source = 'usgs'")) == rows_of(given.select(raw.RAW_COLUMNS))
    assert back.where("seq = 900").count() == 1


def test_files_of_others_are_snapshots(spark, tmp_path):
    for seq, body in ((3, '{"a":\n1}'), (4, "two\nlines\n")):
        folder = tmp_path / "source=x" / f"seq={seq}"
        folder.mkdir(parents=True)
        (folder / "body.json").write_text(body)
    got = raw.read_snapshot_files(spark, str(tmp_path)).orderBy("seq").collect()
    assert [(r.source, r.seq, r.payload) for r in got] == [("x", 3, '{"a":\n1}'), ("x", 4, "two\nlines\n")]


def folders(path):
    return sorted(os.listdir(path)) if os.path.isdir(path) else []


def test_no_staged_folder_is_left_after_ten_batches(spark, tmp_path):
    landed, out = str(tmp_path / "landed"), str(tmp_path / "out")
    shared = spark.conf.get("spark.checkpoint.dir")
    before = folders(shared)
    everything = mixed_payloads(spark, SF).where("seq < 500").cache()
    for low in range(0, 500, 50):
        land(everything, landed, [low, low + 50])
    stream = ingest.read_raw_stream(spark, landed, 1)
    ingest.start_poll(stream, MIXED_SOURCES, out, str(tmp_path / "cp"), "ten", None, cap=40).awaitTermination()
    assert folders(shared) == before
    got = ingest.read_polled(spark, out, "marinesia")
    assert got.select("batch_id").distinct().count() == 10
    entries = [n for n in folders(f"{out}/_ledger") if n.endswith(".json") and not n.startswith(".")]
    assert entries == ["8.json", "9.json"]


def test_a_lost_batch_shows_the_old_snapshot_whole(spark, tmp_path, monkeypatch):
    landed, out, cp = (str(tmp_path / n) for n in ("landed", "out", "cp"))
    schema = "layer string, label string"

    def poll(rows):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(landed)
        return ingest.start_layers(spark.readStream.schema(schema).parquet(landed), out, cp, "lost", None)

    def shown():
        return sorted((r.layer, r.label) for r in ingest.read_layers(spark, out).collect())

    poll([("usgs", "a"), ("opensky", "f")]).awaitTermination()
    with monkeypatch.context() as broken:
        broken.setattr(ledger.Ledger, "publish", lambda *a: (_ for _ in ()).throw(OSError("the driver died here")))
        query = poll([("usgs", "b")])
        with pytest.raises(Exception, match="the driver died here"):
            query.awaitTermination()
    assert shown() == [("opensky", "f"), ("usgs", "a")]  # rows of the lost batch lie there, unpublished
    poll([("opensky", "g")]).awaitTermination()
    assert shown() == [("opensky", "g"), ("usgs", "b")]
    for i in range(4):
        poll([("usgs", f"n{i}")]).awaitTermination()
    assert shown() == [("opensky", "g"), ("usgs", "n3")]
    kept = {int(n.removeprefix("batch_id=")) for n in folders(f"{out}/layers")}
    last = ledger.Ledger(spark, out).latest()
    assert set(last["layers"].values()) <= kept and len(kept) <= 3


def test_undeclared_schemas_widen_from_batch_to_batch(spark, tmp_path, payloads):
    landed, out, cp = (str(tmp_path / n) for n in ("landed", "out", "cp"))

    def poll(source, *texts, seq):
        rows = payloads(*texts, source=source).withColumn("seq", F.col("seq") + seq)
        rows.coalesce(1).write.mode("append").parquet(landed)
        ingest.start_dynamic(ingest.read_raw_stream(spark, landed), out, cp, "dynamic", None).awaitTermination()

    poll("mine", '{"data":[{"a":1,"b":null,"o":{"x":1}},{"a":2}]}', "broken", seq=0)
    first = ingest.read_dynamic(spark, out, "mine")
    assert first.schema["a"].dataType.simpleString() == "bigint" and first.count() == 2
    poll("mine", '[{"a":2.5,"b":7,"c":"new","o":{"y":"t"}}]', seq=10)
    poll("other", '{"items":[{"a":"text"}]}', seq=20)
    poll("mine", "[1,2]", '[{"a":3,"c":[1]}]', seq=30)
    rows = ingest.read_dynamic(spark, out, "mine")
    assert [(f.name, f.dataType.simpleString()) for f in rows.schema.fields[4:]] == [
        ("a", "double"), ("b", "bigint"), ("c", "variant"), ("o", "struct<x:bigint,y:string>")
    ]
    got = sorted((r.seq, r.pos, r.a, r.b, r.o and (r.o.x, r.o.y)) for r in rows.drop("c").collect())
    assert got == [(0, 0, 1.0, None, (1, None)), (0, 1, 2.0, None, None), (10, 0, 2.5, 7, (None, "t")), (31, 0, 3.0, None, None)]
    assert [str(r.c) for r in rows.selectExpr("seq", "to_json(c) AS c").orderBy("seq").where("c IS NOT NULL").collect()] == ['"new"', "[1]"]
    assert [r.a for r in ingest.read_dynamic(spark, out, "other").collect()] == ["text"]
    with pytest.raises(ValueError, match="no records of absent"):
        ingest.read_dynamic(spark, out, "absent")
