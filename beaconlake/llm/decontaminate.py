"""Benchmark decontamination by a prefix-filtered set join.

A benchmark item is cut into windows of `window` consecutive words (a shorter item is one window). The shingles of a
window are its runs of `shingle` words, ordered by how rare they are in the corpus. A text contains a window only if it
contains all of its shingles, so one shingle, the rarest, is a necessary prefix: texts and windows are joined on it.
Its place in the window tells where the window must lie in the text (positional bound) and whether it fits (length
bound); then the words themselves are compared.

A null text has no words; items without words have no windows; items may repeat or share windows, each counts by its
id. Null ids stay null (a null item id counts as an item of its own in n_items and is left out of the digest's names).
An empty benchmark leaves every document clean; no documents give no rows. Repeated documents are rows of their own.

Scale: texts are read twice, first to count the benchmark's shingles, then to look for prefixes; only shingles that the
benchmark holds leave a task. Their hashes are sent to the tasks if there are at most `MOST_SENT`; a larger benchmark
goes the other way, its shingles joined with all shingles of the texts by a shuffle. What follows is small, and a
passage that very many texts share is one row per text and place.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from beaconlake.llm import grams
from beaconlake.llm.common import row_key
from beaconlake.session import staged

WINDOW = 10
SHINGLE = 3
MOST_SENT = 1 << 22  # 32 MB of hashes
ITEM_WINDOWS = "item_id long, window string, size int, shingle long, place int"
CANDIDATES = "row long, n_words long, doc_id long, key string, found array<struct<shingle: long, place: int, first: int, words: string>>"


def item_windows(benchmark: DataFrame, window: int, shingle: int, id_col: str, text_col: str) -> DataFrame:
    """Every window of every item with each of its shingles and their place in it."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_pylist()
            out: list[tuple] = []
            for at, words in grams.sliced(batch.column(1), grams.ALNUM):
                runs = {k: dict(zip(words.runs(k)[1].tolist(), words.runs(k)[0].view(np.int64).tolist())) for k in range(1, shingle + 1)}
                for i in range(words.texts):
                    low, high = int(words.bounds[i]), int(words.bounds[i + 1])
                    size = min(window, high - low)
                    if size:
                        k = min(shingle, size)
                        for first in range(low, high - size + 1):
                            text = words.joined(first, first + size).decode()
                            out += [(ids[at + i], text, size, runs[k][first + j], j) for j in range(size - k + 1)]
            kinds = [pa.int64(), pa.string(), pa.int32(), pa.int64(), pa.int32()]
            columns = list(zip(*out)) or [[]] * 5
            names = ["item_id", "window", "size", "shingle", "place"]
            yield pa.record_batch([pa.array(c, t) for c, t in zip(columns, kinds)], names=names)

    return benchmark.select(F.col(id_col).cast("long"), F.col(text_col).cast("string")).mapInArrow(work, ITEM_WINDOWS)


def _hits(words: grams.Words, sizes: list[int], wanted: np.ndarray | None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(hash, first word) of the runs of each size that are wanted."""
    for k in sizes:
        found, first = words.runs(k)
        if wanted is not None and len(found):
            at = np.minimum(np.searchsorted(wanted, found), len(wanted) - 1)
            kept = wanted[at] == found
            found, first = found[kept], first[kept]
        yield found, first


def _counts(docs: DataFrame, sizes: list[int], wanted: np.ndarray | None) -> DataFrame:
    """How often shingles occur in the corpus."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, words in grams.sliced(batch.column(0), grams.ALNUM):
                found = np.concatenate([f for f, _ in _hits(words, sizes, wanted)] or [np.zeros(0, np.uint64)])
                shingles, n = np.unique(found, return_counts=True)
                yield pa.record_batch([pa.array(shingles.view(np.int64)), pa.array(n)], names=["shingle", "n"])

    return docs.select("text").mapInArrow(work, "shingle long, n long").groupBy("shingle").agg(F.sum("n").alias("n"))


def _candidates(docs: DataFrame, sizes: list[int], wanted: np.ndarray | None, reach: int) -> DataFrame:
    """Per document its number of words and, for each shingle found, the words from `first` on that may be a window."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row_ids, ids, keys = batch.column(0), batch.column(1), batch.column(3)
            found: list[list[dict]] = []
            count: list[int] = []
            for _, words in grams.sliced(batch.column(2), grams.ALNUM):
                base = len(found)
                found += [[] for _ in range(words.texts)]
                count += np.diff(words.bounds).tolist()
                for shingles, firsts in _hits(words, sizes, wanted):
                    for shingle, at in zip(shingles.view(np.int64).tolist(), firsts.tolist()):
                        i = int(words.text[at])
                        low, high = int(words.bounds[i]), int(words.bounds[i + 1])
                        first = max(low, at - reach)
                        text = words.joined(first, min(high, at + reach + 1)).decode()
                        found[base + i].append({"shingle": shingle, "place": at - low, "first": first - low, "words": text})
            kind = pa.list_(pa.struct([("shingle", pa.int64()), ("place", pa.int32()), ("first", pa.int32()), ("words", pa.string())]))
            columns = [row_ids, pa.array(count, pa.int64()), ids, keys, pa.array(found, kind)]
            yield pa.RecordBatch.from_arrays(columns, names=["row", "n_words", "doc_id", "key", "found"])

    return docs.select("row", "doc_id", "text", "key").mapInArrow(work, CANDIDATES)


def contaminated(
    docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, shingle: int = SHINGLE, most_sent: int = MOST_SENT,
    id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", keys: bool = False,
) -> DataFrame:
    """(row, doc_id, key, n_words, n_hit, items, spans): the words hit, the items found, the word ranges hit (from, to).

    With `keys`, `key` finds the text again beside its id (see `common.filtered`); else it is null.
    """
    text = F.col(text_col).cast("string")
    texts = docs.select(
        F.monotonically_increasing_id().alias("row"), F.col(id_col).cast("long").alias("doc_id"), text.alias("text"),
        (row_key(F.col(id_col), text) if keys else F.lit(None).cast("string")).alias("key"),
    )
    windows = staged(item_windows(benchmark, window, shingle, item_col, item_text_col), "windows")
    shingles = windows.select("shingle").distinct()
    sizes = sorted(row["k"] for row in windows.select(F.least("size", F.lit(shingle)).alias("k")).distinct().collect())

    def sent(hashes: DataFrame) -> np.ndarray | None:
        few = hashes.limit(most_sent + 1).toArrow()
        return None if few.num_rows > most_sent else np.sort(few.column(0).to_numpy().view(np.uint64))

    counted = _counts(texts, sizes, sent(shingles)) if sizes else None
    rarity = [F.col("place")] if counted is None else [F.coalesce("n", F.lit(0)), F.col("shingle"), F.col("place")]
    each = windows if counted is None else windows.join(staged(counted.join(shingles, "shingle", "left_semi"), "shingle-counts"), "shingle", "left")
    prefix = F.min(F.struct(*rarity, F.col("shingle").alias("rarest"), F.col("place").alias("at")))
    prefixes = each.groupBy("window", "size").agg(prefix.alias("p")).select("window", "size", F.col("p.rarest").alias("rarest"), F.col("p.at").alias("at"))
    prefixes = staged(prefixes, "prefixes")
    seen = staged(_candidates(texts, sizes, sent(prefixes.select("rarest").distinct()), max(window - 1, 1)), "candidates")

    places = seen.select("row", "n_words", F.explode("found").alias("f")).select("row", "n_words", "f.*")
    joined = places.join(prefixes, F.col("shingle") == F.col("rarest"))
    begin = F.col("place") - F.col("at")
    fits = (begin >= 0) & (begin + F.col("size") <= F.col("n_words"))
    inside = F.array_join(F.slice(F.split("words", " "), begin - F.col("first") + 1, F.col("size")), " ")
    hits = joined.where(fits).where(inside == F.col("window")).select("row", "window", begin.alias("begin"), (begin + F.col("size")).alias("end"))
    hits = staged(hits, "hits")

    # Ranges that meet are one; their words are counted once.
    before = Window.partitionBy("row").orderBy("begin", "end")
    reached = F.max("end").over(before.rowsBetween(Window.unboundedPreceding, -1))
    ranges = hits.select("row", "begin", "end").distinct().withColumn("reached", reached)
    ranges = ranges.withColumn("new", F.when(F.col("reached").isNull() | (F.col("begin") > F.col("reached")), 1).otherwise(0))
    ranges = ranges.withColumn("part", F.sum("new").over(before))
    parts = ranges.groupBy("row", "part").agg(F.min("begin").alias("from"), F.max("end").alias("to"))
    spans = parts.groupBy("row").agg(
        F.sum(F.col("to") - F.col("from")).cast("long").alias("n_hit"), F.array_sort(F.collect_list(F.struct("from", "to"))).alias("spans")
    )
    named = windows.select("window", "item_id").distinct()
    items = hits.select("row", "window").distinct().join(named, "window").select("row", "item_id").distinct()
    items = items.groupBy("row").agg(F.collect_list("item_id").alias("items"), F.count(F.lit(1)).alias("n_items"))
    out = seen.select("row", "doc_id", "key", "n_words").join(spans.join(items, "row"), "row", "left")
    return out.select(
        "row", "doc_id", "key", "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce("n_items", F.lit(0)).cast("long").alias("n_items"), F.coalesce("items", F.array().cast("array<long>")).alias("items"),
        F.coalesce("spans", F.array().cast("array<struct<from: int, to: int>>")).alias("spans"),
    )
