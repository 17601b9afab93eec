"""Vessel feeds, the last known state per vessel, as-of enrichment, vessels gone silent.

All feeds become *updates*: `mmsi, act, live` plus values, ordered by `(seq, pos)`.

    act = set      name, ship_type and destination are replaced
    act = name     the name is taken only while the vessel has none
    act = dummy    stand-in name, type and destination, only while it has no name
    act = none     nothing of the three changes
    live           position and last-seen time are replaced

Whether a rule applies depends on the state before it, yet no row-by-row loop is
needed: after a `set` row the state can change at most once more, at the first row
that gives a name. So a running state is a few window functions over the rows since
the last `set`.

A vessel may hold a large share of all rows (records without a number are vessel 0), so
windows run over pieces of its history, `PIECE` rows each: rows of long histories are
numbered by ranges and counts, whatever number of them a payload holds. What a whole
piece does to the state is again one update of the same form, so the same function over
the piece summaries gives the state each piece starts from.

The last state alone needs no window: it is the last `set` and the first naming after
it, two aggregates that reduce before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from beaconlake.functions import strict
from beaconlake.functions.pieces import piece_of
from beaconlake.operators import feeds
from beaconlake.operators.ranks import numbered
from beaconlake.session import staged

PIECE = 1 << 20

# Fixed values.
UNNAMED = ("", "Unknown")
DUMMY_NAME, DUMMY_TYPE, DUMMY_DESTINATION = "Baltic Vessel", 80, "Unknown"
TYPE_CODES = {"Cargo": 70, "Tanker": 80, "Passenger": 60, "Fishing": 30, "Pleasure Craft": 37}
DEFAULT_NAV_STATUS = 15
CARGO_AND_TANKER = (70, 89)

VESSEL_COLUMNS = ["mmsi", "latitude", "longitude", "sog", "cog", "nav_status", "name", "ship_type", "destination"]
UPDATE_COLUMNS = [
    "source", "seq", "fetched_at", "pos", "mmsi", "act", "live", "latitude", "longitude", "sog", "cog",
    "nav_status", "given_name", "name", "ship_type", "destination",
]


# -- feeds to updates


def _updates(rows: DataFrame, **columns: Column) -> DataFrame:
    return rows.select(*feeds.LINEAGE, *[c.alias(n) for n, c in columns.items()]).select(UPDATE_COLUMNS)


def ais_updates(payloads: DataFrame) -> DataFrame:
    """Static records (state only) and position reports of the AIS stream; other messages give nothing."""
    r = F.col("record")
    rows = feeds.records(payloads, feeds.payload_itself)
    typed = rows.withColumn("message", strict.text(r, "$.MessageType"))
    static = F.col("message") == "ShipStaticData"
    position = F.col("message") == "PositionReport"
    typed = typed.withColumn(
        "mmsi",
        F.when(static, strict.integer(r, "$.Message.ShipStaticData.UserID")).when(
            position, strict.integer(r, "$.MetaData.MMSI")
        ),
    ).where(F.col("mmsi").isNotNull())
    data, report = "$.Message.ShipStaticData", "$.Message.PositionReport"
    given = F.when(position, strict.text(r, "$.MetaData.ShipName"))

    def static_text(path: str) -> Column:
        return strict.strip(F.coalesce(strict.text(r, path), F.lit("Unknown")))

    return _updates(
        typed,
        mmsi=F.col("mmsi"),
        act=F.when(static, "set").when(given.isNotNull(), "name").otherwise("none"),
        live=position,
        latitude=F.when(position, F.coalesce(strict.number(r, "$.MetaData.latitude"), F.lit(0.0))),
        longitude=F.when(position, F.coalesce(strict.number(r, "$.MetaData.longitude"), F.lit(0.0))),
        sog=F.when(position, strict.number(r, f"{report}.Sog")),
        cog=F.when(position, strict.number(r, f"{report}.Cog")),
        nav_status=F.when(
            position, F.coalesce(strict.integer(r, f"{report}.NavigationalStatus"), F.lit(DEFAULT_NAV_STATUS))
        ).cast("bigint"),
        given_name=given,
        name=F.when(static, static_text(f"{data}.Name")).otherwise(strict.strip(given)),
        ship_type=F.when(static, F.coalesce(strict.integer(r, f"{data}.Type"), F.lit(0))).cast("bigint"),
        destination=F.when(static, static_text(f"{data}.Destination")),
    )


def marinesia_updates(payloads: DataFrame) -> DataFrame:
    r = F.col("record")
    rows = feeds.records(payloads, feeds.array_at("$.data"))
    type_name = strict.text(r, "$.type")
    code = F.lit(0)
    for name, number in TYPE_CODES.items():
        code = F.when(type_name == name, number).otherwise(code)
    name = F.coalesce(strict.text(r, "$.name"), F.lit("Unknown"))
    return _updates(
        rows,
        mmsi=F.coalesce(strict.integer(r, "$.mmsi"), F.lit(0)),
        act=F.lit("set"),
        live=F.lit(True),
        latitude=F.coalesce(strict.number(r, "$.lat"), F.lit(0.0)),
        longitude=F.coalesce(strict.number(r, "$.lng"), F.lit(0.0)),
        sog=strict.number(r, "$.sog"),
        cog=strict.number(r, "$.cog"),
        nav_status=F.coalesce(strict.integer(r, "$.status"), F.lit(DEFAULT_NAV_STATUS)).cast("bigint"),
        given_name=name,
        name=name,
        ship_type=code.cast("bigint"),
        destination=F.coalesce(strict.text(r, "$.dest"), F.lit("Unknown")),
    )


def digitraffic_updates(payloads: DataFrame) -> DataFrame:
    """Features with properties and at least two coordinates; name, type and destination come from the state."""
    r = F.col("record")
    rows = feeds.records(payloads, feeds.array_at("$.features"))
    has_properties = F.try_variant_get(r, "$.properties", "variant").isNotNull()
    has_two = F.try_variant_get(r, "$.geometry.coordinates[1]", "variant").isNotNull()
    return _updates(
        rows.where(has_properties & has_two),
        mmsi=F.coalesce(strict.integer(r, "$.properties.mmsi"), F.lit(0)),
        act=F.lit("dummy"),
        live=F.lit(True),
        latitude=F.coalesce(strict.number(r, "$.geometry.coordinates[1]"), F.lit(0.0)),
        longitude=F.coalesce(strict.number(r, "$.geometry.coordinates[0]"), F.lit(0.0)),
        sog=strict.number(r, "$.properties.sog"),
        cog=strict.number(r, "$.properties.cog"),
        nav_status=F.coalesce(strict.integer(r, "$.properties.navStat"), F.lit(DEFAULT_NAV_STATUS)).cast("bigint"),
        given_name=F.lit(None).cast("string"),
        name=F.lit(DUMMY_NAME),
        ship_type=F.lit(DUMMY_TYPE).cast("bigint"),
        destination=F.lit(DUMMY_DESTINATION),
    )


def marinesia(payloads: DataFrame) -> DataFrame:
    """The feed's own rows; they do not depend on the state."""
    return marinesia_updates(payloads).select(*feeds.LINEAGE, *VESSEL_COLUMNS)


# -- running state


def _meta(name: Column, ship_type: Column, destination: Column) -> Column:
    return F.struct(name.alias("name"), ship_type.alias("ship_type"), destination.alias("destination"))


def _initial() -> Column:
    return _meta(F.lit(""), F.lit(0).cast("bigint"), F.lit(""))


def _named(name: Column) -> Column:
    return ~name.isin(*UNNAMED)


def _advance(base: Column, naming: Column, blank: Column) -> Column:
    """State after some rows without `set`, from the state before and what these rows hold."""
    return (
        F.when(_named(base["name"]), base)
        .when(naming.isNull(), _meta(F.coalesce(blank, base["name"]), base["ship_type"], base["destination"]))
        .when(naming["act"] == "name", _meta(naming["name"], base["ship_type"], base["destination"]))
        .otherwise(_meta(F.lit(DUMMY_NAME), F.lit(DUMMY_TYPE).cast("bigint"), F.lit(DUMMY_DESTINATION)))
    )


def _since_last_set(updates: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Per row: values of the last `set`, first naming and last unnamed value since then."""
    act = F.col("act")
    running = (Window.unboundedPreceding, Window.currentRow)
    history = Window.partitionBy(*keys).orderBy(*order).rowsBetween(*running)
    stretch = Window.partitionBy(*keys, "stretch").orderBy(*order).rowsBetween(*running)
    naming = (act == "dummy") | ((act == "name") & _named(F.col("name")))
    blank = (act == "name") & ~_named(F.col("name"))
    return updates.withColumn("stretch", F.count(F.when(act == "set", 1)).over(history)).withColumns(
        {
            "base": F.first(
                F.when(act == "set", _meta(F.col("name"), F.col("ship_type"), F.col("destination"))), True
            ).over(stretch),
            "naming": F.first(F.when(naming, F.struct("act", "name")), True).over(stretch),
            "blank": F.last(F.when(blank, F.col("name")), True).over(stretch),
        }
    )


def _cut(updates: DataFrame, piece: int) -> DataFrame:
    """Updates with `piece`, the number of a stretch of `piece` rows in the history of the vessel."""
    sizes = updates.groupBy("mmsi").agg(F.count("*").alias("n_rows"))
    long = staged(sizes.where(F.col("n_rows") > piece).select("mmsi"), "long-histories")
    if long.isEmpty():
        return updates.withColumn("piece", F.lit(0).cast("bigint"))
    short = updates.join(long, "mmsi", "left_anti").withColumn("piece", F.lit(0).cast("bigint"))
    order = [F.col("seq"), F.col("pos")]
    cut = numbered(updates.join(long, "mmsi", "left_semi"), order, ["mmsi"]).withColumn("piece", piece_of("place", piece))
    return short.unionByName(cut.drop("place"))


def _pieces(updates: DataFrame, piece: int) -> DataFrame:
    return _since_last_set(_cut(updates, piece), ["mmsi", "piece"], ["seq", "pos"])


def _piece_updates(pieces: DataFrame) -> DataFrame:
    """What each piece does to the state, as one update, with its last live report."""
    last = F.max_by(F.struct("base", "naming", "blank"), F.struct("seq", "pos"))
    live = F.when(F.col("live"), F.struct("seq", "pos", "fetched_at", "latitude", "longitude", "nav_status"))
    ends = pieces.groupBy("mmsi", "piece").agg(last.alias("end"), F.max(live).alias("live"))
    base, naming, blank = F.col("end.base"), F.col("end.naming"), F.col("end.blank")
    after = _advance(base, naming, blank)
    return ends.select(
        "mmsi",
        "piece",
        "live",
        F.when(base.isNotNull(), "set")
        .when(naming.isNotNull(), naming["act"])
        .when(blank.isNotNull(), "name")
        .otherwise("none")
        .alias("act"),
        F.when(base.isNotNull(), after["name"]).when(naming.isNotNull(), naming["name"]).otherwise(blank).alias("name"),
        after["ship_type"].alias("ship_type"),
        after["destination"].alias("destination"),
    )


def _piece_states(pieces: DataFrame) -> DataFrame:
    """State at the end of each piece."""
    folded = _since_last_set(_piece_updates(pieces), ["mmsi"], ["piece"])
    return folded.withColumn(
        "state", _advance(F.coalesce("base", _initial()), F.col("naming"), F.col("blank"))
    )


def running_state(updates: DataFrame, piece: int = PIECE, stage: bool = True) -> DataFrame:
    """Updates with `state`: name, type and destination known right after each of them.

    Updates are read for the sizes of the histories, the piece summaries and the rows. They
    are staged first, so that payloads are parsed once; pass `stage=False` for updates that
    come from a table already.
    """
    pieces = _pieces(staged(updates, "vessel-updates") if stage else updates, piece)
    before = F.lag("state").over(Window.partitionBy("mmsi").orderBy("piece"))
    carried = _piece_states(pieces).select("mmsi", "piece", F.coalesce(before, _initial()).alias("carried"))
    joined = pieces.join(carried, ["mmsi", "piece"])
    return joined.select(
        *UPDATE_COLUMNS, _advance(F.coalesce("base", "carried"), F.col("naming"), F.col("blank")).alias("state")
    )


def enriched(updates: DataFrame, piece: int = PIECE, stage: bool = True) -> DataFrame:
    """Rows of the vessel feeds with static data as of their arrival.

    AIS positions keep the name they came with; Digitraffic rows take it from the state.
    """
    rows = running_state(updates, piece, stage).where("live")
    name = F.when(F.col("act") == "dummy", F.col("state.name")).otherwise(F.col("given_name"))
    return rows.select(
        *feeds.LINEAGE, "mmsi", "latitude", "longitude", "sog", "cog", "nav_status",
        name.alias("name"), "state.ship_type", "state.destination", F.col("state.name").alias("known_name"),
    )


def _state_of(rows: DataFrame, *last: Column) -> DataFrame:
    """mmsi, `state` after the rows of each vessel, and further aggregates of them."""
    act = F.col("act")
    base = F.max(F.when(act == "set", F.struct("seq", "pos", "name", "ship_type", "destination"))).alias("base")
    ends = rows.groupBy("mmsi").agg(base, *last)
    naming = (act == "dummy") | _named(F.col("name"))
    since = rows.where(act.isin("name", "dummy")).select("mmsi", "seq", "pos", "act", "name")
    since = since.join(ends.select("mmsi", F.struct("base.seq", "base.pos").alias("from"), F.col("base").isNull().alias("new")), "mmsi")
    since = since.where(F.col("new") | (F.struct("seq", "pos") > F.col("from"))).groupBy("mmsi").agg(
        F.min(F.when(naming, F.struct("seq", "pos", "act", "name"))).alias("naming"),
        F.max(F.when(~naming, F.struct("seq", "pos", "name"))).alias("blank"),
    )
    known = F.when(F.col("base").isNotNull(), _meta(F.col("base.name"), F.col("base.ship_type"), F.col("base.destination")))
    state = _advance(F.coalesce(known, _initial()), F.col("naming"), F.col("blank.name"))
    return ends.join(since, "mmsi", "left").withColumn("state", state).drop("base", "naming", "blank")


def _last_report(*columns: str, where: Column) -> Column:
    return F.max(F.when(where, F.struct("seq", "pos", *columns)))


def vessel_state(updates: DataFrame, stage: bool = True) -> DataFrame:
    """Last known state per vessel. Vessels without a report have last_seen 0 and position 0, 0."""
    rows = staged(updates, "vessel-updates") if stage else updates
    live = _last_report("fetched_at", "latitude", "longitude", "nav_status", where=F.col("live"))
    return _state_of(rows, live.alias("live")).select(
        "mmsi",
        "state.name",
        "state.ship_type",
        "state.destination",
        F.coalesce(F.unix_timestamp("live.fetched_at"), F.lit(0)).alias("last_seen"),
        F.coalesce("live.latitude", F.lit(0.0)).alias("latitude"),
        F.coalesce("live.longitude", F.lit(0.0)).alias("longitude"),
        F.coalesce("live.nav_status", F.lit(0)).cast("bigint").alias("nav_status"),
    )


def last_reports(updates: DataFrame, stage: bool = True) -> DataFrame:
    """The last located report of each vessel, with static data as of its arrival: one row per vessel of `enriched`."""
    rows = staged(updates, "vessel-updates") if stage else updates
    located = F.col("live") & ~F.isnan("latitude") & ~F.isnan("longitude")
    report = ["source", "fetched_at", "act", "latitude", "longitude", "sog", "cog", "nav_status", "given_name"]
    last = rows.groupBy("mmsi").agg(_last_report(*report, where=located).alias("last")).where("last IS NOT NULL")
    until = rows.join(last.select("mmsi", F.struct("last.seq", "last.pos").alias("until")), "mmsi")
    state = _state_of(until.where(F.struct("seq", "pos") <= F.col("until")).drop("until"))
    found = last.join(state, "mmsi").select("mmsi", "last.*", "state")
    name = F.when(F.col("act") == "dummy", F.col("state.name")).otherwise(F.col("given_name"))
    return found.select(
        *feeds.LINEAGE, "mmsi", "latitude", "longitude", "sog", "cog", "nav_status",
        name.alias("name"), "state.ship_type", "state.destination", F.col("state.name").alias("known_name"),
    )


# -- questions on the state


def is_cargo_or_tanker() -> Column:
    return F.col("ship_type").between(*CARGO_AND_TANKER)


def dark_vessels(state: DataFrame, as_of: Column, timeout_hours: float) -> DataFrame:
    """Cargo vessels and tankers last seen under way and silent for longer than the timeout."""
    silent = F.unix_timestamp(as_of.cast("timestamp")) - F.col("last_seen") > int(timeout_hours * 3600)
    located = (F.col("latitude") != 0) & (F.col("longitude") != 0)
    under_way = F.col("nav_status") == 0
    return state.where(is_cargo_or_tanker() & under_way & silent & located).select(
        "mmsi", "latitude", "longitude", "name", "ship_type"
    )


def latest(rows: DataFrame) -> DataFrame:
    """The last row of each vessel, as one aggregate that reduces before the shuffle."""
    rest = [c for c in rows.columns if c not in ("seq", "pos", "mmsi")]
    last = rows.groupBy("mmsi").agg(F.max_by(F.struct("seq", "pos", *rest), F.struct("seq", "pos")).alias("last"))
    return last.select("mmsi", "last.*").select(rows.columns)


def cargo_tankers(rows: DataFrame) -> DataFrame:
    """Map rows: located, newest per vessel, then only cargo and tanker types."""
    return latest(rows.dropna(subset=["longitude", "latitude"])).where(is_cargo_or_tanker())


def in_boxes(rows: DataFrame, boxes: list[tuple[float, float, float, float]]) -> DataFrame:
    """Rows inside any of the boxes `(lat_min, lon_min, lat_max, lon_max)`, borders included."""
    inside = F.lit(False)
    for south, west, north, east in boxes:
        inside = inside | (F.col("latitude").between(south, north) & F.col("longitude").between(west, east))
    return rows.where(inside)


def of_message_types(payloads: DataFrame, types: list[str]) -> DataFrame:
    """Payloads of the AIS stream with one of the message types."""
    parsed = payloads.select("*", F.explode(F.array(strict.parse("payload"))).alias("doc"))
    return parsed.where(strict.text(F.col("doc"), "$.MessageType").isin(types)).drop("doc")
