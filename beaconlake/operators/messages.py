"""Channel messages: routing, history, cards, records and the rolling feed."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from beaconlake.functions import text
from beaconlake.operators.views import ordered

# Fixed values.
SOURCE_PREFIX = "tg_"
HISTORY_LIMIT = 5
OLDER_CARDS = 100
HIGHLIGHT = "abu"


def channel_messages(messages: DataFrame, channels: DataFrame) -> DataFrame:
    """Messages of the followed channels with their source name; own outgoing ones are dropped.

    `channels(chat_id, source, channel)` is of the user's making and may be long: Spark
    broadcasts it only if its measured size is small, else a busy channel is split by
    the adaptive skew join.
    """
    return messages.where(~F.col("outgoing")).join(channels, "chat_id")


def channel_history(messages: DataFrame, limit: int = HISTORY_LIMIT) -> DataFrame:
    """The newest messages of each channel under the source `tg_<channel>`.

    Spark applies the rank limit in every task before the shuffle, so a busy channel
    sends `limit` rows per task only.
    """
    newest = Window.partitionBy("channel").orderBy(F.col("message_id").desc())
    return (
        messages.withColumn("place", F.row_number().over(newest))
        .where(F.col("place") <= limit)
        .drop("place")
        .withColumn("source", F.concat(F.lit(SOURCE_PREFIX), "channel"))
    )


def follow(channels: DataFrame, wanted: DataFrame) -> DataFrame:
    """Followed channels with the wanted ones added that are absent."""
    new = wanted.select("channel").distinct().join(channels, "channel", "left_anti")
    return channels.select("channel").unionByName(new)


def records(messages: DataFrame) -> DataFrame:
    """Messages as JSON payloads, link spans turned into markup."""
    marked = messages.withColumn("text", text.link_markup(F.col("text"), F.col("spans")))
    record = F.struct("message_id", "channel", "text", "date", "media")
    return marked.withColumn("payload", F.to_json(record))


def message_sources(rows: DataFrame) -> DataFrame:
    return rows.where(F.col("source").startswith(SOURCE_PREFIX))


def cards(rows: DataFrame) -> DataFrame:
    """What a message card shows: time of day, highlight, direction, title line and body."""
    body = text.real_newlines(F.col("text"))
    parts = F.split(body, "\n", 2)
    return rows.withColumns(
        {
            "shown_time": F.date_format(F.timestamp_seconds("date"), "HH:mm:ss"),
            "highlight": F.lower("channel").contains(HIGHLIGHT),
            "direction": F.when(text.is_rtl(F.col("text")), "rtl").otherwise("ltr"),
            "title": F.when(F.size(parts) > 1, parts[0]),
            "body": F.when(F.size(parts) > 1, parts[1]).otherwise(body),
        }
    )


def rolling_feed(rows: DataFrame, older: int = OLDER_CARDS, place: str | None = None) -> DataFrame:
    """The feed after the last poll: all its messages, then the newest `older` of earlier polls.

    `rows(poll_id, source, date, seq)`; the order is poll (newest first), source, date.
    The last poll number is one small aggregate, the older part a distributed top-k. With `place`, each row says where
    it stands, from 1.
    """
    mine = message_sources(rows)
    last_poll = mine.agg(F.max("poll_id").alias("last_poll")).scalar()
    fresh = mine.where(F.col("poll_id") == last_poll).withColumn("part", F.lit("new"))
    rest = (
        mine.where(F.col("poll_id") < last_poll)
        .orderBy(F.desc("poll_id"), "source", "date", "seq")
        .limit(older)
        .withColumn("part", F.lit("old"))
    )
    order = [F.desc("poll_id"), F.col("source"), F.col("date"), F.col("seq")]
    return ordered(fresh.unionByName(rest), order, place)
