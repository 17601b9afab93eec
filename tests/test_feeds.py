"""Golden rows of every feed, wrong types, broken payloads."""

import pytest
from pyspark.sql import functions as F

from beaconlake.operators import dynamic, feeds, polls, rss, tle, vessels
from beaconlake.sources import raw

GOLDEN = [
    ("acled", '{"data":[{"event_id_cnty":"ISR123","fatalities":"0"}]}', [("ISR123", None, None, None, 0)]),
    ("opensky", '{"time":1710760000,"states":[["4b1814","SWR123  ","Switzerland",1710760000,1710760000,8.54,47.45]]}',
     [("4b1814", "SWR123", "Switzerland", 1710760000, 1710760000, 8.54, 47.45)]),
    ("gdelt", '{"features":[{"properties":{"name":"Protest","url":"http://news.com/1"},"geometry":{"coordinates":[35.21,31.76]}}]}',
     [("Protest", "http://news.com/1", 35.21, 31.76)]),
    ("usgs", '{"features":[{"properties":{"place":"5km N of Test","mag":4.5},"geometry":{"coordinates":[-120.0,35.0]}}]}',
     [("5km N of Test", 4.5, -120.0, 35.0)]),
    ("binance", '{"p":"65000.50","q":"0.150"}', [(65000.5, 0.15)]),
    ("eonet", '{"events":[{"title":"Grass fire by the lake","categories":[{"title":"Wildfires"}],"geometry":[{"coordinates":[-120.5,35.5]}]}]}',
     [("Grass fire by the lake", "Wildfires", -120.5, 35.5)]),
    ("polymarket", '[{"title":"Rain on Sunday?","volume":1234.5}]', [("Rain on Sunday?", 1234.5)]),
    ("cloudflare", '{"result":{"events":[{"asn":64500,"leak_type":"origin","country_code":"US"}]}}', [(64500, "origin", "US")]),
    ("firms", '[{"latitude":34.5,"longitude":-118.2,"bright_ti4":330.5,"confidence":"high"}]', [(34.5, -118.2, 330.5, "high")]),
    ("urlhaus", '{"urls":[{"id":4711,"url":"http://files.example.org/a","url_status":"online"},{"id":"77"}]}',
     [(4711, "http://files.example.org/a", "online"), (77, None, None)]),
    ("fred", '{"observations":[{"date":"2023-01-01","value":"1500.5"},{"date":"2023-01-02","value":"."}]}',
     [("2023-01-01", 1500.5), ("2023-01-02", None)]),
    ("ucdp", '{"Result":[{"id":1,"conflict_name":"Border dispute","latitude":10.0,"longitude":20.0,"best":5},{"best":3000000000}]}',
     [(1, "Border dispute", 10.0, 20.0, 5), (None, None, None, None, None)]),
    ("oref", '{"id":"123","title":"Siren test","data":["Haifa",5,"Acre"]}', [("123", "Siren test", "Haifa, Acre")]),
    ("meteo", '{"latitude":52.52,"longitude":13.41,"current_weather":{"temperature":22.5}}', [(52.52, 13.41, 22.5)]),
    ("feodo", '[{"ip_address":"192.0.2.7","port":8080,"malware":"sample-a"}]', [("192.0.2.7", 8080, "sample-a")]),
    ("ransomware", '[{"group_name":"group nine","post_title":"Harbour Mills","published":"2023-10-01"}]', [("group nine", "Harbour Mills", "2023-10-01")]),
    ("nga", '{"broadcast-warn":[{"navArea":"IV","text":"BUOY ADRIFT NEAR 51N 003E"}]}',
     [("IV", "BUOY ADRIFT NEAR 51N 003E")]),
    ("unhcr", '{"items":[{"origin":"Chad","destination":"Kenya","population":812,"date":"2023"}]}', [("Chad", "Kenya", 812, "2023")]),
    ("messages", '{"message_id":999,"channel":"weather_desk","text":"Road closed after heavy snow.","date":1710760000,"media":"media/7.jpg"}',
     [(999, "weather_desk", "Road closed after heavy snow.", 1710760000, "media/7.jpg")]),
    ("messages", '{"channel":5,"media":null}', [(None, None, None, None, "")]),
    ("aishub", '[{"E":1},[{"MMSI":5,"LATITUDE":1,"NAME":"X"},7]]',
     [(5, 1.0, None, None, None, "X", None, None), (None,) * 8]),
]


@pytest.mark.parametrize("name,payload,expected", GOLDEN, ids=[f"{g[0]}-{i}" for i, g in enumerate(GOLDEN)])
def test_golden(payloads, name, payload, expected):
    feed = feeds.FEEDS[name]
    rows = feeds.extract(payloads(payload), feed).orderBy("pos").select(feed.columns).collect()
    assert [tuple(r) for r in rows] == expected


def test_broken_payloads_give_no_rows(payloads):
    broken = payloads("", "{", "'x'", "null", "5", '{"data":{}}', '{"data":"x"}', "[1,2,3]")
    for name in ("acled", "usgs", "aishub"):
        assert feeds.extract(broken, feeds.FEEDS[name]).count() == 0
    assert feeds.coingecko(broken).count() == 2  # the two objects: their key is a coin without price


def test_wrong_type_nulls_its_cell_only(payloads):
    rows = feeds.extract(payloads('{"data":[{"event_id_cnty":"BAD1","fatalities":{}},5,null,{"event_id_cnty":9}]}'), feeds.FEEDS["acled"])
    got = [(r.event_id_cnty, r.fatalities) for r in rows.orderBy("pos").collect()]
    assert got == [("BAD1", None), (None, None), (None, None), (None, None)]


def test_states_that_are_no_arrays_are_skipped(payloads):
    rows = feeds.extract(payloads('{"states":[{"a":1},5,["x"],[]]}'), feeds.FEEDS["opensky"])
    assert [r.icao24 for r in rows.orderBy("pos").collect()] == ["x", None]


def test_number_texts(payloads):
    texts = ["inf", "-Infinity", "1e3", ".5", "1.", " 5", "1d", "0x1", "", "+7"]
    rows = feeds.extract(payloads(*[f'{{"p":"{t}"}}' for t in texts]), feeds.FEEDS["binance"])
    got = [r.price for r in rows.orderBy("seq").collect()]
    assert got == [float("inf"), float("-inf"), 1000.0, 0.5, 1.0, None, None, None, None, 7.0]


def test_last_of_duplicate_keys_counts(payloads):
    rows = feeds.extract(payloads('{"p":"1","p":"2"}'), feeds.FEEDS["binance"])
    assert [r.price for r in rows.collect()] == [2.0]


def test_coingecko(payloads):
    rows = feeds.coingecko(payloads('{"tether":{"usd":1.00},"bitcoin":{"usd":65000.0}}'))
    assert {(r.coin, r.price_usd) for r in rows.collect()} == {("tether", 1.0), ("bitcoin", 65000.0)}
    assert rows.where(F.col("coin") == "bitcoin").first().price_usd == 65000.0


def test_dynamic_infers_one_schema(payloads):
    text = (
        '[{"name":"FalconSat","date_utc":"2006-03-24T22:30:00.000Z","success":false,"flight_number":1},'
        '{"name":"RatSat","success":true,"flight_number":2.5,"core":{"id":1}},7]'
    )
    rows = dynamic.extract(payloads(text, '{"items":{},"results":[{"name":"late"}]}', "{"))
    kinds = dict(rows.drop(*feeds.LINEAGE).dtypes)
    assert kinds == {
        "core": "struct<id:bigint>", "date_utc": "string", "flight_number": "double", "name": "string", "success": "boolean",
    }
    assert [r.name for r in rows.orderBy("seq", "pos").collect()] == ["FalconSat", "RatSat", "late"]
    with pytest.raises(ValueError):
        dynamic.extract(payloads('{"nothing":1}', "[1]"))


def test_dynamic_takes_the_first_key_with_an_array(payloads):
    rows = dynamic.extract(payloads('{"data":{"x":1},"results":[{"a":1}],"features":[{"a":2}]}'), "struct<a:int>")
    assert [r.a for r in rows.collect()] == [2]


ISS = (
    "1 25544U 98067A   20194.88612269 -.00002218  00000-0 -31515-4 0  9992",
    "2 25544  51.6461 221.2784 0001413  89.1723 280.4612 15.49507896236008",
)


def test_element_blocks(payloads):
    good = "ISS (ZARYA)\r\n" + ISS[0] + "  \n\n" + ISS[1] + "\nTAIL"
    shifted = "stray\n" + good
    rows = tle.extract(payloads(good, shifted, "A\n1 x\n2 y", "A\nB\nC", "")).orderBy("seq").collect()
    assert [(r.seq, r.object_name, r.object_id) for r in rows] == [(0, "ISS (ZARYA)", "25544"), (2, "A", "Unknown")]
    assert rows[0].tle_line1 == ISS[0] and rows[0].tle_line2 == ISS[1]


def test_rss(payloads):
    simple = "<rss><channel><item><title>Test News</title><link>https://reuters.com/123</link></item></channel></rss>"
    rows = rss.extract(payloads(simple)).collect()
    assert [tuple(r)[4:] for r in rows] == [("Test News", "https://reuters.com/123", "", "", "{}")]


def test_rss_tag_rules(payloads):
    text = (
        "<rss><title>outside</title><ITEM a='1'> own <Title> A &amp; B</Title><title>C &#233;</title>"
        "<description>a<b>c</b>d</description><x:y>1</x:y><x:y>2</x:y><bad>&nbsp;</bad>"
        "<description><![CDATA[ <p>&amp;</item> ]]></description><pubDate>M<!-- c -->N</pubDate></ITEM>"
        "<item><title>half</title>"
    )
    rows = rss.extract(payloads(text, "no xml", "<item/>")).collect()
    assert [tuple(r)[4:] for r in rows] == [
        ("A & BC é", "", "MN", "a <p>&amp;</item>", '{"b":"c","item":"own","x:y":"2"}')
    ]


def test_rss_stops_at_a_syntax_error(payloads):
    def item(title, extra=""):
        return f"<item><title>{title}</title>{extra}</item>"

    cases = {
        f"<rss>{item('a')}{item('b', '<x><y></x></y>')}{item('c')}</rss>": ["a"],
        f"<rss>{item('a')}</channel>{item('b')}": ["a"],
        f"{item('a')}<b><i></b></i>{item('c')}": ["a"],
        f"<rss>{item('a', '<br/><!-- </x> --><![CDATA[</y>]]>')}{item('b')}</rss></rss>{item('c')}": ["a", "b"],
        f"<!DOCTYPE rss><rss>{item('a')}{item('b')}<open>": ["a", "b"],
        f"<rss>{item('a')}1 < 2{item('b')}</rss>": ["a"],
        f"<rss>{item('a')}<Item><title>t</title></item>{item('b')}</rss>": ["a"],
        f"<rss><a></a >{item('a')}</rss>": ["a"],
        "": [],
        "no markup": [],
    }
    frame = payloads(*cases)
    strict, lax = ({}, {})
    for found, stop in ((strict, True), (lax, False)):
        for r in rss.extract(frame, stop_at_error=stop).orderBy("seq", "pos").collect():
            found.setdefault(r.seq, []).append(r.title)
    assert [strict.get(i, []) for i in range(len(cases))] == list(cases.values())
    assert lax[0] == ["a", "b", "c"]


def test_ais_static_is_state_only(payloads):
    static = '{"MessageType":"ShipStaticData","Message":{"ShipStaticData":{"UserID":1,"Type":70,"Name":" N ","Destination":" D "}}}'
    position = '{"MessageType":"PositionReport","MetaData":{"MMSI":%d,"ShipName":" S ","latitude":34.0},"Message":{"PositionReport":{"Sog":14.2}}}'
    rows = vessels.enriched(vessels.ais_updates(payloads(position % 1, static, position % 1, position % 2, '{"MessageType":"X"}')))
    got = [(r.seq, r.mmsi, r.latitude, r.longitude, r.sog, r.nav_status, r.name, r.ship_type, r.destination) for r in rows.orderBy("seq").collect()]
    assert got == [
        (0, 1, 34.0, 0.0, 14.2, 15, " S ", 0, ""),
        (2, 1, 34.0, 0.0, 14.2, 15, " S ", 70, "D"),
        (3, 2, 34.0, 0.0, 14.2, 15, " S ", 0, ""),
    ]


def test_marinesia_defaults_and_type_names(payloads):
    text = '{"data":[{"mmsi":1,"lat":1.5,"type":"Tanker","status":0,"name":"A","dest":"B"},7]}'
    rows = vessels.marinesia(payloads(text)).orderBy("pos").select(vessels.VESSEL_COLUMNS).collect()
    assert [tuple(r) for r in rows] == [
        (1, 1.5, 0.0, None, None, 0, "A", 80, "B"),
        (0, 0.0, 0.0, None, None, 15, "Unknown", 0, "Unknown"),
    ]


def test_digitraffic_needs_properties_and_two_coordinates(payloads):
    text = (
        '{"features":[{"properties":{"mmsi":1},"geometry":{"coordinates":[20.5,60.1]}},'
        '{"geometry":{"coordinates":[1,2]}},{"properties":{},"geometry":{"coordinates":[1]}},5]}'
    )
    rows = polls.poll(payloads(text), {"s": "digitraffic"})["s"].collect()
    assert [(r.mmsi, r.latitude, r.longitude, r.name, r.ship_type, r.destination) for r in rows] == [
        (1, 60.1, 20.5, "Baltic Vessel", 80, "Unknown")
    ]


def test_poll_leaves_unknown_sources_out(payloads):
    both = payloads('{"p":"1"}', source="binance").unionByName(payloads('{"p":"2"}', source="other"))
    tables = polls.poll(both, {"binance": "binance"})
    assert list(tables) == ["binance"] and [r.price for r in tables["binance"].collect()] == [1.0]


def test_a_feed_of_the_users_own(payloads):
    polls.register_parser("mine", lambda p: feeds.extract(p, feeds.Feed("mine", feeds.array_at("$.rows"), (feeds.S("a"),))))
    assert [r.a for r in polls.poll(payloads('{"rows":[{"a":"x"}]}'), {"s": "mine"})["s"].collect()] == ["x"]


def test_caps_keep_newest_and_oldest(spark):
    many = spark.range(2000).selectExpr("'ais' AS source", "id AS seq", "current_timestamp() AS fetched_at", "string(id) AS payload")
    few = many.where("seq < 5").withColumn("source", F.lit("small"))
    both = many.unionByName(few)
    newest = [r.seq for r in raw.cap_newest(both, 1000).where("source = 'ais'").orderBy("seq").collect()]
    oldest = [r.seq for r in raw.cap_oldest(both, 1000).where("source = 'ais'").orderBy("seq").collect()]
    assert newest == list(range(1000, 2000)) and oldest == list(range(1000))
    assert raw.cap_newest(both, 1000).where("source = 'small'").count() == 5


def test_rejects_keep_the_reason(payloads):
    rows = raw.rejects(payloads('{"data":[1]}', "{", '{"data":[]}', "[]"), feeds.array_at("$.data")).orderBy("seq").collect()
    assert [(r.seq, r.reason) for r in rows] == [(1, "not valid JSON"), (2, "no records"), (3, "no records")]


def test_feed_plans_stay_in_the_jvm_and_parse_once(payloads):
    rows = feeds.extract(payloads('{"data":[]}'), feeds.FEEDS["acled"])
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Exchange" not in plan
    assert plan.count("parseJson") == 1


def test_reading_one_source_prunes_folders(spark, tmp_path, payloads):
    path = str(tmp_path / "raw")
    raw.write_raw(payloads('{"p":"1"}', source="binance").unionByName(payloads("x", source="other")), path)
    rows = raw.read_raw(spark, path).where("source = 'binance'")
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(source" in plan
    assert rows.count() == 1


def test_cap_does_not_shuffle_payload_text(payloads):
    rows = raw.cap_newest(payloads("a", "b", "c"), 2)
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan
    assert sorted(r.payload for r in rows.collect()) == ["b", "c"]


def test_polled_tables_are_written_per_source(spark, tmp_path, payloads):
    both = payloads('{"p":"1"}', source="binance").unionByName(payloads('[{"title":"t"}]', source="polymarket"))
    tables = polls.poll(both, {"binance": "binance", "polymarket": "polymarket"})
    for _ in range(2):
        polls.write_tables(tables, str(tmp_path))
    assert [r.price for r in spark.read.parquet(f"{tmp_path}/source=binance").collect()] == [1.0, 1.0]
    assert tables["polymarket"].select("title").toArrow().to_pylist() == [{"title": "t"}]
