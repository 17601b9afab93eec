"""One poll: payloads of all registered sources to one table per source."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from beaconlake.operators import dynamic, feeds, rss, tle, vessels
from beaconlake.session import staged

# Parser name to feed job. Own parsers may be added.
PARSERS: dict[str, Callable[[DataFrame], DataFrame]] = {
    **{name: (lambda payloads, feed=feed: feeds.extract(payloads, feed)) for name, feed in feeds.FEEDS.items()},
    "coingecko": feeds.coingecko,
    "dynamic": dynamic.extract,
    "tle": tle.extract,
    "rss": rss.extract,
    "marinesia": vessels.marinesia,
}

# Feeds that read or write the vessel state: they are folded together in arrival order.
VESSEL_UPDATES = {
    "ais": vessels.ais_updates,
    "marinesia": vessels.marinesia_updates,
    "digitraffic": vessels.digitraffic_updates,
}


def register_parser(name: str, job: Callable[[DataFrame], DataFrame]) -> None:
    PARSERS[name] = job


def vessel_updates(payloads: DataFrame, sources: dict[str, str]) -> DataFrame | None:
    """Updates of all vessel feeds among the sources."""
    parts = [
        VESSEL_UPDATES[parser](payloads.where(F.col("source") == source))
        for source, parser in sources.items()
        if parser in VESSEL_UPDATES
    ]
    updates = parts[0] if parts else None
    for part in parts[1:]:
        updates = updates.unionByName(part)
    return updates


class Polled(Mapping[str, DataFrame]):
    """Tables by source name, each built when it is first asked for.

    Rows of all vessel feeds come from one fold, written once when the first of their tables is asked for.
    """

    def __init__(self, payloads: DataFrame, sources: dict[str, str]):
        self._payloads, self._sources = payloads, sources
        self._built: dict[str, DataFrame] = {}
        self._vessels: DataFrame | None = None

    def _enriched(self) -> DataFrame:
        if self._vessels is None:
            rows = vessels.enriched(vessel_updates(self._payloads, self._sources))
            self._vessels = staged(rows.select(*feeds.LINEAGE, *vessels.VESSEL_COLUMNS), "enriched")
        return self._vessels

    def __getitem__(self, source: str) -> DataFrame:
        parser = self._sources[source]
        if source not in self._built:
            if parser in VESSEL_UPDATES and parser != "marinesia":
                self._built[source] = self._enriched().where(F.col("source") == source)
            else:
                self._built[source] = PARSERS[parser](self._payloads.where(F.col("source") == source))
        return self._built[source]

    def __iter__(self) -> Iterator[str]:
        return iter(self._sources)

    def __len__(self) -> int:
        return len(self._sources)


def poll(payloads: DataFrame, sources: dict[str, str]) -> Polled:
    """Source name to its rows. `sources` maps names to parsers; other payloads are left out."""
    return Polled(payloads, sources)


def write_tables(tables: Mapping[str, DataFrame], path: str) -> None:
    """Add the rows of a poll to parquet tables, one folder per source."""
    for source, rows in tables.items():
        rows.write.mode("append").parquet(f"{path}/source={source}")


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows per source; sources without rows do not occur."""
    counts = None
    for rows in tables.values():
        one = rows.groupBy("source").agg(F.count("*").alias("n_rows"))
        counts = one if counts is None else counts.unionByName(one)
    return counts
