"""The driver's tables, and raw payloads that Spark derives from all of their rows."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from beaconlake.functions.pieces import piece_of
from beaconlake.session import tune

PAGE = 50  # records per derived payload


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return tune(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with the number in `props` and a made-up position."""
    e = table(spark, sf_dir, "events")
    return e.withColumns(
        {
            "k": F.regexp_extract("props", "([0-9]+)", 1).cast("int"),
            "lat": (F.col("event_id") * 37 % 18000) / F.lit(100.0) - 90,
            "lon": (F.col("event_id") * 91 % 36000) / F.lit(100.0) - 180,
        }
    )


# The same in SQL, to begin oracle queries with; `seq` and `pos` are those of a derived payload.
EVENTS_SQL = f"""e AS (
  SELECT *, CAST(regexp_extract(props, '[0-9]+') AS INTEGER) AS k,
         ((event_id * 37) % 18000) / 100.0 - 90 AS lat,
         ((event_id * 91) % 36000) / 100.0 - 180 AS lon,
         event_id // {PAGE} AS seq,
         CAST(row_number() OVER (PARTITION BY event_id // {PAGE} ORDER BY event_id) - 1 AS INTEGER) AS pos
  FROM events)"""


def js(value: Column | str) -> Column:
    """A scalar as JSON text."""
    listed = F.to_json(F.array(value))
    return F.substring(listed, F.lit(2), F.length(listed) - 2)


def raw(text: str) -> Column:
    return F.lit(text)


def obj(**members: Column) -> Column:
    """JSON object text from members that are JSON text already."""
    parts = [F.concat(F.lit(f'"{name}":'), value) for name, value in members.items()]
    return F.concat(F.lit("{"), F.concat_ws(",", *parts), F.lit("}"))


def arr(*items: Column) -> Column:
    return F.concat(F.lit("["), F.concat_ws(",", *items), F.lit("]"))


def pages_of(
    rows: DataFrame, key: str, record: Column, source: str, prefix: str = "[", suffix: str = "]",
    size: int = PAGE, fetched_at: str = "ts", separator: str = ",",
) -> DataFrame:
    """Raw payloads with `size` consecutive records each, in the order of the unique key."""
    listed = rows.select(
        piece_of(key, size).alias("seq"), F.col(key).alias("key"), F.col(fetched_at).alias("at"),
        record.alias("record"),
    )
    ordered = F.array_sort(F.collect_list(F.struct("key", "record")))
    body = F.array_join(F.transform(ordered, lambda x: x["record"]), separator)
    return listed.groupBy("seq").agg(F.max("at").alias("fetched_at"), body.alias("body")).select(
        F.lit(source).alias("source"), "seq", "fetched_at",
        F.concat(F.lit(prefix), "body", F.lit(suffix)).alias("payload"),
    )


def single(rows: DataFrame, key: str, payload: Column, source: str | Column, fetched_at: str = "ts") -> DataFrame:
    """One raw payload per row."""
    name = F.lit(source) if isinstance(source, str) else source
    return rows.select(
        name.alias("source"), F.col(key).alias("seq"), F.col(fetched_at).alias("fetched_at"), payload.alias("payload")
    )


# -- registration of queries with their SQL

Query = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Registered:
    run: Query
    sql: str | None


REGISTRY: dict[str, Registered] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(run: Query) -> Query:
        REGISTRY[name] = Registered(run, sql)
        return run

    return register
