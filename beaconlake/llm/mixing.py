"""Mixing sources to target weights by Sainte-Laguë apportionment.

A source's documents, in seeded order, form streams (shards) of words. Highest quotients give each source, then each
of its shards, a whole number of blocks of `block` words; a shard takes its blocks as one run that starts at a seeded
place and goes round the stream, so a document is taken wholly, in part, or up to twice.

    targets: sources in order of code points (null last) weigh 5, 2, 1, repeating, and share `share` of all words;
    a target stops at `limit` times its source, and the excess is shared again by weight until none is above.

A null text has no words; a null source is a source of its own, a null id an id of its own. Rows that repeat are
documents of their own; rows alike in all that counts are interchangeable. Empty sources have target 0. No rows give
no rows. Reruns agree: nothing depends on how Spark splits the rows.

Scale: one aggregate over (source, bucket) reduces before its shuffle; all planning works on that small table. A shard
holds about `SHARD_WORDS` words, so a hot source is many shards. The rows are ranked inside shards only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from beaconlake.llm.common import row_key, spare_prefix
from beaconlake.session import staged

WEIGHTS = (5, 2, 1)
BLOCK = 4
BUCKETS = 4096  # shards of a source are whole buckets
SHARD_WORDS = 1 << 18
SEED = "mix-1"
WORD = r"[^\x20\x09-\x0D]+"


def _number(digest: Column, start: int) -> Column:
    """A number from 7 hex digits of a digest."""
    return F.conv(F.substring(digest, start, 7), 16, 10).cast("long")


def targets(sources: DataFrame, share: float = 1.5, limit: int = 2) -> DataFrame:
    """(source, source_size) -> with weight and target."""
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*map(F.lit, WEIGHTS)), ((F.row_number().over(by_name) - 1) % len(WEIGHTS) + 1).cast("int"))
    everything = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    s = sources.withColumn("weight", weight).withColumns(
        {
            "cap": F.col("source_size") * limit,
            "all_words": F.sum("source_size").over(everything) * F.lit(share),
            "all_weights": F.sum("weight").over(everything),
        }
    )
    # Sources whose limit is small for their weight fill up first; what is left is shared by those behind.
    filling = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last()).rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    left_words = F.col("all_words") - (F.sum("cap").over(filling) - F.col("cap"))
    left_weights = F.col("all_weights") - (F.sum("weight").over(filling) - F.col("weight"))
    s = s.withColumn("full", F.col("cap") * left_weights <= left_words * F.col("weight"))
    per_weight = (F.col("all_words") - F.sum(F.when(F.col("full"), F.col("cap")).otherwise(0)).over(everything)) / F.nullif(
        F.sum(F.when(F.col("full"), 0).otherwise(F.col("weight"))).over(everything), F.lit(0)
    )
    target = F.when(F.col("full"), F.col("cap").cast("double")).otherwise(F.least(F.col("cap").cast("double"), F.col("weight") * per_weight))
    return s.withColumn("target", target).select("source", "source_size", "weight", "target")


def apportion(rows: DataFrame, group: list[str], order: list[Column], weight: str, total: str) -> DataFrame:
    """Add `seats`: of `total` seats of its group, those each row gets by the highest quotients weight / (2 k + 1).

    Every row gets the seats that are beyond doubt at once; only the quotients around the last seat, a few per row,
    are ranked.
    """
    whole = Window.partitionBy(*group).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    per_seat = F.col(weight) / F.nullif(F.sum(weight).over(whole), F.lit(0))
    half = F.count(F.lit(1)).over(whole) / 2
    sure = F.greatest(F.floor(per_seat * F.greatest(F.col(total) - half, F.lit(0)) + 0.5) - 1, F.lit(0))
    at_most = F.floor(per_seat * (F.col(total) + half) + 0.5) + 1
    open_rows = rows.withColumns({"_sure": F.coalesce(sure, F.lit(0)).cast("long"), "_most": F.coalesce(at_most, F.lit(0)).cast("long")})
    open_rows = open_rows.withColumn("_open", F.col(total) - F.sum("_sure").over(whole))
    seats = open_rows.withColumn("_seat", F.explode(F.sequence(F.col("_sure"), F.greatest(F.col("_most"), F.col("_sure")))))
    ranked = Window.partitionBy(*group).orderBy((F.col(weight) / (2 * F.col("_seat") + 1)).desc(), *order, F.col("_seat"))
    won = (F.row_number().over(ranked) <= F.col("_open")) & (F.col(weight) > 0)
    counted = seats.withColumn("_won", won.cast("long")).groupBy(*rows.columns, "_sure").agg(F.sum("_won").alias("_won"))
    return counted.withColumn("seats", F.col("_sure") + F.col("_won")).select(*rows.columns, "seats")


def plan(tally: DataFrame, share: float, limit: int, block: int, seed: str) -> DataFrame:
    """(source, bucket, words) -> per bucket: its shard, the shard's words, start and length of the run, and targets."""
    sources = targets(tally.groupBy("source").agg(F.sum("words").alias("source_size")), share, limit)
    everything = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    sources = sources.withColumn("blocks", F.round(F.sum("target").over(everything) / block).cast("long"))
    sources = apportion(sources, [], [F.col("source").asc_nulls_last()], "target", "blocks")
    most = F.floor(F.col("source_size") * limit / block)
    sources = sources.withColumn("quota", F.least("seats", most)).select(
        F.col("source").alias("_source"), "source_size", "target", "quota",
        F.greatest(F.ceil(F.col("source_size") / SHARD_WORDS), F.lit(1)).alias("shards"),
    )
    buckets = tally.join(sources, F.col("source").eqNullSafe(F.col("_source")))
    buckets = buckets.withColumn("shard", F.col("bucket") % F.least(F.col("shards"), F.lit(BUCKETS)))
    facts = ["source", "shard", "source_size", "target", "quota"]
    shards = buckets.groupBy(*facts).agg(F.sum("words").alias("shard_words"))
    shards = apportion(shards, ["source"], [F.col("shard")], "shard_words", "quota")
    most = F.floor(F.col("shard_words") * limit / block)
    digest = F.md5(F.concat_ws("|", F.lit(seed), F.coalesce("source", F.lit("")), F.col("shard").cast("string")).cast("binary"))
    shards = shards.select(
        F.col("source").alias("_source"), F.col("shard").alias("_shard"), "shard_words", (F.least("seats", most) * block).alias("run"),
        F.coalesce(F.pmod(_number(digest, 1) * 268435456 + _number(digest, 8), F.nullif("shard_words", F.lit(0))), F.lit(0)).alias("run_start"),
    )
    found = buckets["source"].eqNullSafe(shards["_source"]) & (buckets["shard"] == shards["_shard"])
    joined = buckets.drop("_source").join(shards, found)
    return joined.select(
        F.col("source").alias("_source"), F.col("bucket").alias("_bucket"), "shard", "shard_words", "run", "run_start", "source_size", "target"
    )


def mix(
    docs: DataFrame, share: float = 1.5, limit: int = 2, block: int = BLOCK, seed: str = SEED,
    id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", out: str = "mix",
) -> DataFrame:
    """All columns of the documents, and a struct `out`: size, source_size, target, taken, full (whole copies), parts.

    `parts` are the word ranges [from, to) taken besides whole copies.
    """
    p = spare_prefix([*docs.columns, out])
    c = lambda name: F.col(p + name)
    digest = F.md5(F.concat_ws("|", F.lit(seed), F.coalesce(F.col(id_col).cast("string"), F.lit("null"))).cast("binary"))
    size = F.coalesce(F.regexp_count(F.col(text_col), F.lit(WORD)), F.lit(0)).cast("long")
    rows = docs.withColumns({p + "size": size, p + "digest": digest, p + "from": F.col(source_col)})
    rows = rows.withColumn(p + "in", _number(c("digest"), 1) % BUCKETS)
    tally = rows.groupBy(c("from").alias("source"), c("in").alias("bucket")).agg(F.sum(c("size")).alias("words"))
    planned = staged(plan(staged(tally, "mix-tally"), share, limit, block, seed), "mix-plan")
    planned = planned.select([F.col(x).alias(p + x) for x in planned.columns])
    rows = rows.join(planned, c("from").eqNullSafe(c("_source")) & (c("in") == c("_bucket")))
    inside = Window.partitionBy(c("from"), c("shard")).orderBy(c("digest"), F.col(id_col), c("size"), row_key(F.col(id_col), F.col(text_col)))
    rows = rows.withColumn(p + "end", F.sum(c("size")).over(inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    begin, words = c("end") - c("size"), c("shard_words")
    full = F.coalesce(F.floor(c("run") / F.nullif(words, F.lit(0))), F.lit(0)).cast("long")
    rest = c("run") - full * words

    def part(start: Column) -> Column:
        """What the run's last round takes of the document, from one of its two places on the stream."""
        low = F.greatest(start, begin) - begin
        high = F.least(start + rest, c("end")) - begin
        return F.struct(low.cast("long").alias("from"), F.greatest(high, low).cast("long").alias("to"))

    rows = rows.withColumns({p + "a": part(c("run_start")), p + "b": part(c("run_start") - words)})
    taken = full * c("size") + c("a.to") - c("a.from") + c("b.to") - c("b.from")
    facts = F.struct(
        c("size").alias("size"), c("source_size").alias("source_size"), c("target").alias("target"), taken.alias("taken"),
        full.alias("full"), F.filter(F.array(c("a"), c("b")), lambda x: x["to"] > x["from"]).alias("parts"),
    )
    return rows.select(*[F.col(x) for x in docs.columns], facts.alias(out))


def mixed_documents(docs: DataFrame, text_col: str = "text", length_col: str | None = "n_chars", **options) -> DataFrame:
    """The mix itself: a row per whole copy and per part taken, with the columns of the documents.

    White space inside a part stays; documents without words are left out, as the mix takes none of them.
    """
    p = spare_prefix(docs.columns)
    rows = mix(docs, text_col=text_col, out=p + "mix", **options)
    size = F.col(p + "mix.size")
    whole = F.struct(F.lit(0).cast("long").alias("from"), size.alias("to"))
    pieces = F.concat(F.array_repeat(whole, F.col(p + "mix.full").cast("int")), F.col(p + "mix.parts"))
    rows = rows.where(size > 0).withColumn(p + "piece", F.explode(pieces))
    first, length = F.col(p + "piece.from"), F.col(p + "piece.to") - F.col(p + "piece.from")
    words = F.regexp_extract_all(F.col(text_col), F.lit(WORD + r"[\x20\x09-\x0D]*"), F.lit(0))
    cut = F.array_join(F.slice(words, (first + 1).cast("int"), length.cast("int")), "")
    changed = {text_col: F.when(length == size, F.col(text_col)).otherwise(cut)}
    if length_col and length_col in docs.columns:
        kind = docs.schema[length_col].dataType
        changed[length_col] = F.when(length == size, F.col(length_col)).otherwise(F.length(cut).cast(kind))
    return rows.withColumns(changed).select(*docs.columns)
