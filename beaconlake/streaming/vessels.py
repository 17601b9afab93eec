"""Vessel state and silence alerts over a stream of raw payloads.

The state is keyed by vessel and lives in the state store of the query (RocksDB, snapshots and changes in the
checkpoint), so a micro-batch reads and writes the vessels it has updates of and no others. Updates of a vessel are
folded in arrival order by the rules of the batch form; the stream ends with the state the batch query finds.

A vessel that would count as dark if it fell silent holds a timer at the instant from which it does. A report cancels
it and sets the next; when the clock passes it, the vessel is alerted, once per silence. The clock is the latest fetch
time of all payloads of the stream, those of other feeds too. With `heartbeat` the wall clock counts as well, so that
alerts come when nothing arrives at all. Payloads that come late are folded like others: the clock is a column of its
own, and rows are not dropped by it.

A vessel's updates of one micro-batch are sorted in memory; `files_per_batch` of the reader bounds them. With
`forget_hours` a second timer removes vessels that have been silent that long.
"""

from __future__ import annotations

import warnings
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from beaconlake.operators import polls, vessels
from beaconlake.streaming.ingest import DEFAULT_PERIOD, running, trigger

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
STATE_COLUMNS = ["name", "ship_type", "destination", "last_seen", "latitude", "longitude", "nav_status"]
STATE_SCHEMA = (
    "name string, ship_type bigint, destination string, last_seen bigint, latitude double, longitude double, "
    "nav_status bigint, alerted_at bigint, alert_timer bigint, forget_timer bigint"
)
ALERT_SCHEMA = "mmsi bigint, latitude double, longitude double, name string, ship_type bigint, last_seen bigint"
NO_TIMER = -1
UNSEEN = {
    "name": "", "ship_type": 0, "destination": "", "last_seen": 0, "latitude": 0.0, "longitude": 0.0, "nav_status": 0,
    "alerted_at": 0, "alert_timer": NO_TIMER, "forget_timer": NO_TIMER,
}


def advance(state: dict, update: Row) -> None:
    """One update, by the write rules of `operators.vessels`."""
    if update.live:
        state.update(
            last_seen=update.seen_at, latitude=update.latitude, longitude=update.longitude, nav_status=update.nav_status
        )
    unnamed = state["name"] in vessels.UNNAMED
    if update.act == "set":
        state.update(name=update.name, ship_type=update.ship_type, destination=update.destination)
    elif update.act == "name" and unnamed:
        state["name"] = update.name
    elif update.act == "dummy" and unnamed:
        state.update(name=vessels.DUMMY_NAME, ship_type=vessels.DUMMY_TYPE, destination=vessels.DUMMY_DESTINATION)


class VesselProcessor(StatefulProcessor):
    """State of one vessel, its alert timer, and the timer that forgets it."""

    def __init__(self, timeout_hours: float, forget_hours: float | None):
        self._timeout = int(timeout_hours * 3600)
        self._forget = None if forget_hours is None else int(forget_hours * 3600)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._handle = handle
        self._vessel = handle.getValueState("vessel", STATE_SCHEMA)

    def _known(self) -> dict:
        held = self._vessel.get()
        return dict(UNSEEN) if held is None else dict(zip(UNSEEN, held))

    def _keep(self, state: dict) -> None:
        self._vessel.update(tuple(state.values()))

    def _due(self, state: dict) -> bool:
        """Would the vessel be dark once it is silent long enough, and is that not alerted yet?"""
        low, high = vessels.CARGO_AND_TANKER
        wanted = low <= state["ship_type"] <= high and state["nav_status"] == 0
        located = state["latitude"] != 0 and state["longitude"] != 0
        return wanted and located and state["alerted_at"] != state["last_seen"]

    def _set_timer(self, state: dict, name: str, at: int) -> None:
        if state[name] != at:
            if state[name] != NO_TIMER:
                self._handle.deleteTimer(state[name])
            if at != NO_TIMER:
                self._handle.registerTimer(at)
            state[name] = at

    def _set_timers(self, state: dict) -> None:
        # Silence is told in whole seconds, and has to be longer than the timeout. The two timers of a vessel differ by
        # a millisecond at least, as a timer is known by its instant.
        alert = (state["last_seen"] + self._timeout + 1) * 1000
        self._set_timer(state, "alert_timer", alert if self._due(state) else NO_TIMER)
        if self._forget is not None:
            self._set_timer(state, "forget_timer", (state["last_seen"] + self._forget + 1) * 1000 + 1)

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        state = self._known()
        for update in sorted(rows, key=lambda r: (r.seq, r.pos)):
            advance(state, update)
        self._set_timers(state)
        self._keep(state)
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        state = self._known()
        expired = expiredTimerInfo.getExpiryTimeInMs()
        if expired == state["forget_timer"]:
            if state["alert_timer"] != NO_TIMER:
                self._handle.deleteTimer(state["alert_timer"])
            self._vessel.clear()
        elif expired == state["alert_timer"]:
            state.update(alerted_at=state["last_seen"], alert_timer=NO_TIMER)
            self._keep(state)
            yield Row(
                mmsi=key[0], latitude=state["latitude"], longitude=state["longitude"], name=state["name"],
                ship_type=state["ship_type"], last_seen=state["last_seen"],
            )

    def close(self) -> None:
        pass


def _beats(spark: SparkSession) -> DataFrame:
    """A payload without content or source every second, so that the clock goes on."""
    ticks = spark.readStream.format("rate").option("rowsPerSecond", 1).load()
    return ticks.select(
        F.lit("").alias("source"), F.lit(0).cast("bigint").alias("seq"), F.col("timestamp").alias("fetched_at"), F.lit("").alias("payload")
    )


def alerts(
    payloads: DataFrame, sources: dict[str, str], timeout_hours: float = 0.05, forget_hours: float | None = None,
    heartbeat: bool = False,
) -> DataFrame:
    """A streaming table of silence alerts, whose query holds the state of all vessels."""
    if not any(parser in polls.VESSEL_UPDATES for parser in sources.values()):
        raise ValueError("none of the sources is a vessel feed")
    if heartbeat:
        payloads = payloads.unionByName(_beats(payloads.sparkSession))
    timed = payloads.withColumn("clock", F.col("fetched_at")).withWatermark("clock", "0 seconds")
    # Reading the clock keeps the choice of sources above it, so that payloads of all sources move it.
    told = F.coalesce(F.when(F.col("clock").isNotNull(), F.col("source")), F.col("source"))
    updates = polls.vessel_updates(timed.withColumn("source", told), sources)
    thin = updates.select(
        "mmsi", "seq", "pos", "act", "live", F.unix_timestamp("fetched_at").alias("seen_at"), "latitude", "longitude",
        "nav_status", "name", "ship_type", "destination",
    )
    return thin.groupBy("mmsi").transformWithState(
        VesselProcessor(timeout_hours, forget_hours), ALERT_SCHEMA, outputMode="Append", timeMode="EventTime"
    )


def start_vessels(
    payloads: DataFrame, sources: dict[str, str], path: str, checkpoint: str, name: str = "vessels",
    timeout_hours: float = 0.05, period: str | None = DEFAULT_PERIOD, forget_hours: float | None = None,
    heartbeat: bool = False,
) -> StreamingQuery:
    """Maintain the state in `checkpoint` and append alerts to `path/alerts`, each exactly once.

    A query that runs already is left running.
    """
    spark = payloads.sparkSession
    if name in running(spark):
        warnings.warn(f"{name} is running already", stacklevel=2)
        return running(spark)[name]
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    raised = alerts(payloads, sources, timeout_hours, forget_hours, heartbeat)
    return (
        raised.writeStream.queryName(name).format("parquet").option("path", f"{path}/alerts")
        .option("checkpointLocation", checkpoint).outputMode("append").trigger(**trigger(period)).start()
    )


def read_state(spark: SparkSession, checkpoint: str) -> DataFrame:
    """The state after the last batch, read from the state store."""
    held = spark.read.format("statestore").option("stateVarName", "vessel").load(checkpoint)
    return held.select("key.mmsi", *[F.col("value")[c].alias(c) for c in STATE_COLUMNS])


def dark_now(spark: SparkSession, checkpoint: str, as_of: Column, timeout_hours: float = 0.05) -> DataFrame:
    """Vessels silent at an instant, with or without traffic since the last batch."""
    return vessels.dark_vessels(read_state(spark, checkpoint), as_of, timeout_hours)


def read_alerts(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(ALERT_SCHEMA).parquet(f"{path}/alerts")
