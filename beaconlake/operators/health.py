"""Feed health: requests, failures and breaker trips per source from a fetch log."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from beaconlake.functions.pieces import piece_of

# Fixed value: failures in a row that open the breaker, after which the count starts anew.
TRIP_AT = 5
PIECE = 1 << 22


def failure_streaks(fetches: DataFrame, piece: int = PIECE) -> DataFrame:
    """Add `streak`, failures in a row up to each fetch, and `tripped`.

    `fetches(source, seq, ok)`. Windows run over pieces of a source's log; failures open
    at the end of earlier pieces are added from a summary with one row per piece.
    """
    order = (Window.unboundedPreceding, Window.currentRow)
    in_piece = Window.partitionBy("source", "piece").orderBy("seq").rowsBetween(*order)
    runs = Window.partitionBy("source", "piece", "run").orderBy("seq").rowsBetween(*order)
    cut = fetches.withColumn("piece", piece_of("seq", piece))
    local = cut.withColumn("run", F.count(F.when(F.col("ok"), 1)).over(in_piece)).withColumn(
        "failed", F.count(F.when(~F.col("ok"), 1)).over(runs)
    )
    ends = local.groupBy("source", "piece").agg(F.max_by(F.struct("run", "failed"), "seq").alias("end"))
    by_piece = Window.partitionBy("source").orderBy("piece").rowsBetween(*order)
    open_runs = ends.select("source", "piece", "end.*").withColumn(
        "stretch", F.sum(F.when(F.col("run") > 0, 1).otherwise(0)).over(by_piece)
    )
    stretch = Window.partitionBy("source", "stretch").orderBy("piece").rowsBetween(*order)
    open_runs = open_runs.withColumn("open", F.sum("failed").over(stretch))
    before = F.coalesce(F.lag("open").over(Window.partitionBy("source").orderBy("piece")), F.lit(0))
    carried = open_runs.select("source", "piece", before.alias("carried"))
    total = F.col("failed") + F.when(F.col("run") == 0, F.col("carried")).otherwise(0)
    streak = F.when(F.col("ok"), 0).otherwise((total - 1) % TRIP_AT + 1)
    return (
        local.join(carried, ["source", "piece"])
        .withColumn("streak", streak.cast("bigint"))
        .withColumn("tripped", F.col("streak") == TRIP_AT)
        .drop("piece", "run", "failed", "carried")
    )


def feed_health(fetches: DataFrame, piece: int = PIECE) -> DataFrame:
    return failure_streaks(fetches, piece).groupBy("source").agg(
        F.count("*").alias("requests"),
        F.count_if(~F.col("ok")).alias("failures"),
        F.count_if("tripped").alias("trips"),
        F.max("streak").alias("longest_streak"),
        F.max_by("streak", "seq").alias("open_streak"),
    )
