"""Continuous ingest: raw payload streams to feed tables, one named query per feed."""

from __future__ import annotations

import json
import warnings
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from beaconlake.operators import dynamic, polls, views
from beaconlake.sources import raw
from beaconlake.streaming.ledger import Ledger, published

Job = Callable[[DataFrame], DataFrame]

DEFAULT_PERIOD = "60 seconds"


def read_raw_stream(spark: SparkSession, path: str, files_per_batch: int | None = None) -> DataFrame:
    """Raw payloads as they land; `files_per_batch` bounds a micro-batch instead of dropping payloads."""
    reader = spark.readStream.schema(raw.RAW_SCHEMA)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path).select(raw.RAW_COLUMNS)


def trigger(period: str | None) -> dict:
    """A poll period, or None to work off what is there and stop."""
    return {"processingTime": period} if period else {"availableNow": True}


def start_feed(
    payloads: DataFrame, job: Job, path: str, checkpoint: str, name: str, period: str | None = DEFAULT_PERIOD
) -> StreamingQuery:
    """Extract one feed without state into a parquet table, each payload exactly once.

    A feed that runs already is left running.
    """
    if name in running(payloads.sparkSession):
        warnings.warn(f"{name} is running already", stacklevel=2)
        return running(payloads.sparkSession)[name]
    return (
        job(payloads).writeStream.queryName(name).format("parquet").option("path", path)
        .option("checkpointLocation", checkpoint).trigger(**trigger(period)).start()
    )


def start_batches(
    payloads: DataFrame, work: Callable[[DataFrame, int], None], checkpoint: str, name: str,
    period: str | None = DEFAULT_PERIOD,
) -> StreamingQuery:
    """Hand micro-batches to `work`, which must give the same result when a batch is repeated.

    A query that runs already is left running.
    """
    if name in running(payloads.sparkSession):
        warnings.warn(f"{name} is running already", stacklevel=2)
        return running(payloads.sparkSession)[name]
    return (
        payloads.writeStream.queryName(name).foreachBatch(work)
        .option("checkpointLocation", checkpoint).trigger(**trigger(period)).start()
    )


def start_poll(
    payloads: DataFrame, sources: dict[str, str], path: str, checkpoint: str, name: str,
    period: str | None = DEFAULT_PERIOD, cap: int | None = None,
) -> StreamingQuery:
    """Poll all sources of a stream into `path/<source>/batch_id=<n>`; `read_polled` shows the published batches.

    The tables of a batch are published together. With `cap` only the newest payloads per source of a batch are taken.
    """
    spark = payloads.sparkSession

    def work(batch: DataFrame, batch_id: int, last: dict | None) -> dict:
        taken = raw.cap_newest(batch, cap) if cap else batch
        for source, rows in polls.poll(taken, sources).items():
            rows.write.mode("overwrite").parquet(f"{path}/{source}/batch_id={batch_id}")
        return {"sources": sorted(sources)}

    return start_batches(payloads, published(spark, path, name, work), checkpoint, name, period)


def read_polled(spark: SparkSession, path: str, source: str) -> DataFrame:
    """Rows of a source in all published batches, with `batch_id`."""
    last = Ledger(spark, path).latest()
    return spark.read.parquet(f"{path}/{source}").where(F.col("batch_id") <= (last["batch_id"] if last else -1))


def start_layers(
    rows: DataFrame, path: str, checkpoint: str, name: str, period: str | None = DEFAULT_PERIOD
) -> StreamingQuery:
    """Keep the latest non-empty rows of each layer: a batch replaces the layers it has rows of, all at once.

    A batch writes the layers it has into its own folder; the entry it publishes says in which batch each layer stands.
    Folders without a layer in the last two entries are removed.
    """
    spark = rows.sparkSession

    def work(batch: DataFrame, batch_id: int, last: dict | None) -> dict:
        folder = f"layers/batch_id={batch_id}"
        polled = batch.withColumn("poll_id", F.lit(batch_id).cast("bigint"))
        polled.write.mode("overwrite").partitionBy("layer").parquet(f"{path}/{folder}")
        # One row per layer, of which there are a few.
        new = spark.read.schema(polled.schema).parquet(f"{path}/{folder}").select("layer").distinct().collect()
        layers = {**(last["layers"] if last else {}), **{row["layer"]: batch_id for row in new}}
        folders = [f"layers/batch_id={n}" for n in sorted(set(layers.values()) | {batch_id})]
        return {"layers": layers, "folders": folders, "schema": polled.schema.json()}

    return start_batches(rows, published(spark, path, name, work), checkpoint, name, period)


def read_layers(spark: SparkSession, path: str) -> DataFrame:
    """The layers as the last published batch left them."""
    last = Ledger(spark, path).latest()
    schema = StructType.fromJson(json.loads(last["schema"]))
    shown = {k: n for k, n in last["layers"].items() if k not in views.VOLATILE_LAYERS or n == last["batch_id"]}
    folders = [f"{path}/layers/batch_id={n}" for n in sorted(set(shown.values()))]
    if not folders:
        return spark.createDataFrame([], schema)
    held = spark.read.schema(schema).option("basePath", f"{path}/layers").parquet(*folders)
    standing = F.lit(False)
    for layer, number in shown.items():
        standing = standing | ((F.col("layer") == layer) & (F.col("poll_id") == number))
    return held.where(standing)


def start_dynamic(
    payloads: DataFrame, path: str, checkpoint: str, name: str, period: str | None = DEFAULT_PERIOD
) -> StreamingQuery:
    """Keep the records of feeds without a declared schema, and for each source a schema that every batch widens.

    A batch is parsed once: its records are written as VARIANT into `path/records/batch_id=<n>`, and their schemas are
    merged from there, one row per source. The entry it publishes holds the schemas so far; its version is the batch. A
    source that gains columns, or whose whole numbers become fractions, keeps all its rows.
    """
    spark = payloads.sparkSession

    def work(batch: DataFrame, batch_id: int, last: dict | None) -> dict:
        schemas = dict(last["schemas"]) if last else {}
        folder = f"{path}/records/batch_id={batch_id}"
        found = dynamic.records(batch)
        found.write.mode("overwrite").parquet(folder)
        kinds = spark.read.schema(found.schema).parquet(folder).groupBy("source").agg(F.schema_of_variant_agg("record").alias("kind"))
        for row in kinds.collect():
            kind = dynamic.record_type(row["kind"])
            if row["source"] in schemas:
                kind = dynamic.widened(StructType.fromJson(schemas[row["source"]]), kind)
            schemas[row["source"]] = kind.jsonValue()
        return {"schemas": schemas}

    return start_batches(payloads, published(spark, path, name, work), checkpoint, name, period)


def read_dynamic(spark: SparkSession, path: str, source: str) -> DataFrame:
    """Records of a source in all published batches, as columns of its schema so far."""
    last = Ledger(spark, path).latest()
    if last is None or source not in last["schemas"]:
        raise ValueError(f"no records of {source}")
    held = spark.read.schema(f"{dynamic.RECORDS}, batch_id bigint").option("basePath", f"{path}/records").parquet(f"{path}/records")
    mine = held.where((F.col("source") == source) & (F.col("batch_id") <= last["batch_id"]))
    return dynamic.typed(mine, StructType.fromJson(last["schemas"][source]))


# -- control by query name


def running(spark: SparkSession) -> dict[str, StreamingQuery]:
    return {query.name: query for query in spark.streams.active}


def stop(spark: SparkSession, name: str) -> bool:
    """Stop a feed; false if it does not run."""
    query = running(spark).get(name)
    if query is not None:
        query.stop()
    return query is not None


def stop_all(spark: SparkSession) -> None:
    for query in spark.streams.active:
        query.stop()


def restart(spark: SparkSession, name: str, start: Callable[[str | None], StreamingQuery], period: str | None) -> StreamingQuery:
    """Go on with a new period; the checkpoint keeps the place."""
    stop(spark, name)
    return start(period)
