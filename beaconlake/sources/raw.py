"""Raw payloads: one row per payload `(source, seq, fetched_at, payload)`.

`seq` is the arrival number. It is unique in the table and grows in arrival order
over all sources; the landing job assigns it. Ordered operators use it both as
order and to cut a long history into pieces of bounded size.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from beaconlake.functions import strict
from beaconlake.session import staged

RAW_SCHEMA = "source string, seq bigint, fetched_at timestamp, payload string"
RAW_COLUMNS = ["source", "seq", "fetched_at", "payload"]

# Rows of one key kept by the first of the two ranking steps are spread over this many groups.
RANK_SPREAD = 64


def write_raw(payloads: DataFrame, path: str) -> None:
    """Land payloads as parquet, one folder per source, so that reads prune by source."""
    payloads.select(RAW_COLUMNS).write.mode("append").partitionBy("source").parquet(path)


def read_raw(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(RAW_SCHEMA).parquet(path).select(RAW_COLUMNS)


def _escaped(payload: Column) -> Column:
    escaped = F.replace(payload, F.lit("\\"), F.lit("\\\\"))
    return F.replace(F.replace(escaped, F.lit("\n"), F.lit("\\n")), F.lit("\r"), F.lit("\\r"))


def _unescaped(content: Column) -> Column:
    parts = F.transform(F.split(content, r"\\\\", -1), lambda p: F.replace(F.replace(p, F.lit("\\n"), F.lit("\n")), F.lit("\\r"), F.lit("\r")))
    return F.array_join(parts, "\\")


def write_snapshots(payloads: DataFrame, path: str) -> None:
    """Land polled bodies, many to a file: one folder per source, a line per body.

    A line is `<seq> TAB <fetch time in microseconds> TAB <body>`, the body's backslashes and line breaks escaped. Files
    follow the tasks that write, not the payloads; further landings add files.
    """
    line = F.concat_ws("\t", F.col("seq").cast("string"), F.unix_micros(F.col("fetched_at").cast("timestamp")).cast("string"), _escaped(F.col("payload")))
    payloads.select("source", line.alias("value")).write.mode("append").partitionBy("source").text(path)


_SNAPSHOT = "^(-?[0-9]+)\t(-?[0-9]+)\t"


def read_snapshots(spark: SparkSession, path: str, stream: bool = False) -> DataFrame:
    """Polled snapshots as `write_snapshots` landed them; other lines are left out."""
    reader = spark.readStream if stream else spark.read
    lines = reader.schema("value string, source string").text(path)
    number = lambda group: F.nullif(F.regexp_extract("value", _SNAPSHOT, group), F.lit("")).try_cast("bigint")
    rows = lines.select(
        "source", number(1).alias("seq"), F.timestamp_micros(number(2)).alias("fetched_at"),
        _unescaped(F.regexp_replace("value", _SNAPSHOT, "")).alias("payload"),
    )
    return rows.where(F.col("seq").isNotNull())


def read_snapshot_files(spark: SparkSession, path: str, stream: bool = False) -> DataFrame:
    """Snapshots that others landed as `source=<name>/seq=<n>/<file>`: each file is one payload, its write time the fetch time."""
    reader = spark.readStream if stream else spark.read
    files = reader.schema("value string, source string, seq bigint").text(path, wholetext=True)
    return files.select("source", "seq", file_time().alias("fetched_at"), F.col("value").alias("payload"))


def write_messages(payloads: DataFrame, path: str) -> None:
    """Land messages as lines `<seq> TAB <payload>` in one folder per source.

    A payload with line breaks is written as `<seq>e TAB <payload>`, its backslashes and line breaks escaped.
    """
    broken = F.col("payload").rlike("[\r\n]")
    number = F.concat(F.col("seq").cast("string"), F.when(broken, "e").otherwise(""))
    line = F.concat_ws("\t", number, F.when(broken, _escaped(F.col("payload"))).otherwise(F.col("payload")))
    payloads.select("source", line.alias("value")).write.partitionBy("source").text(path)


# A line that holds a message, and the number before it.
_MESSAGE = "^(-?[0-9]+)e?\t"


def _message_lines(spark: SparkSession, path: str, stream: bool) -> DataFrame:
    reader = spark.readStream if stream else spark.read
    lines = reader.schema("value string, source string").text(path)
    number = F.nullif(F.regexp_extract("value", _MESSAGE, 1), F.lit("")).try_cast("bigint")
    return lines.select("source", number.alias("seq"), file_time().alias("fetched_at"), "value")


def read_messages(spark: SparkSession, path: str, stream: bool = False) -> DataFrame:
    """Message frames: each line is one payload after its arrival number; other lines are left out."""
    rest = F.regexp_replace("value", _MESSAGE, "")
    payload = F.when(F.col("value").rlike("^-?[0-9]+e\t"), _unescaped(rest)).otherwise(rest)
    rows = _message_lines(spark, path, stream).where(F.col("seq").isNotNull())
    return rows.select("source", "seq", "fetched_at", payload.alias("payload"))


def message_rejects(spark: SparkSession, path: str, stream: bool = False) -> DataFrame:
    """Lines that are no messages, with the reason."""
    rows = _message_lines(spark, path, stream).where(F.col("seq").isNull())
    return rows.select("source", "fetched_at", F.col("value").alias("payload"), F.lit("no arrival number").alias("reason"))


def file_time() -> Column:
    return F.col("_metadata.file_modification_time")


def inject(payloads: DataFrame, source: str, given: DataFrame) -> DataFrame:
    """Add payloads of any origin, `given(seq, fetched_at, payload)`, under a source name."""
    return payloads.select(RAW_COLUMNS).unionByName(given.withColumn("source", F.lit(source)).select(RAW_COLUMNS))


def route(payloads: DataFrame, sources: DataFrame) -> DataFrame:
    """Payloads of registered sources with their parser; other payloads are dropped.

    Spark broadcasts `sources` only while its measured size is small.
    """
    return payloads.join(sources.select("source", "parser"), "source")


def cap_newest(payloads: DataFrame, size: int) -> DataFrame:
    """The newest `size` payloads of each source."""
    return _cap(payloads, size, newest=True)


def cap_oldest(payloads: DataFrame, size: int) -> DataFrame:
    """The oldest `size` payloads of each source, as for message channels."""
    return _cap(payloads, size, newest=False)


def _cap(payloads: DataFrame, size: int, newest: bool) -> DataFrame:
    """Find each source's cut-off number on the two narrow columns, then filter by it.

    Ranking is done in two steps, first within slices of a source, so a source that
    holds most of the rows is not sorted by one task. The cut-offs, one row per source,
    are staged: Spark then knows their size and broadcasts them if it is small, so that
    payload text is not shuffled.
    """
    order = F.col("seq").desc() if newest else F.col("seq").asc()
    slices = Window.partitionBy("source", F.pmod(F.xxhash64("seq"), F.lit(RANK_SPREAD))).orderBy(order)
    whole = Window.partitionBy("source").orderBy(order)
    kept = (
        payloads.select("source", "seq")
        .withColumn("place", F.row_number().over(slices))
        .where(F.col("place") <= size)
        .withColumn("place", F.row_number().over(whole))
        .where(F.col("place") <= size)
    )
    edge = F.min("seq") if newest else F.max("seq")
    edges = kept.groupBy("source").agg(edge.alias("edge"))
    inside = F.col("seq") >= F.col("edge") if newest else F.col("seq") <= F.col("edge")
    return payloads.join(staged(edges, "cap-edges"), "source").where(inside).drop("edge")


def rejects(payloads: DataFrame, records: Callable[[Column], Column] | None = None) -> DataFrame:
    """Payloads no row can come from, with the reason.

    With `records`, a feed's way from the parsed payload to its record array, payloads
    without any record count as well. The generator keeps the parse from running twice.
    """
    parsed = payloads.select("*", F.explode(F.array(strict.parse("payload"))).alias("doc"))
    reason = F.when(F.col("doc").isNull(), "not valid JSON")
    if records is not None:
        reason = reason.when(F.coalesce(F.size(records(F.col("doc"))), F.lit(0)) <= 0, "no records")
    return parsed.withColumn("reason", reason).where(F.col("reason").isNotNull()).drop("doc")
