"""Alignment of two tokenizers by interval coalescing.

    aligned = align(docs)                # all columns, and the struct `alignment`
    counts = link_counts(aligned)        # how often an id of A and an id of B are linked in the corpus
    scored = link_scores(aligned, counts)

Every text, behind a blank, is encoded by A, a byte-level vocabulary, and by B, a piece model that adds the blank
itself; neither knows special tokens. The tokens of both are intervals of bytes. Sorted by start, with the running
maximum of their ends, they part where a start reaches that maximum: there tokens of both end, and a group is closed.
Within a group every token of A is linked with the tokens of B whose bytes overlap its own.

A text that is null or empty, or that either vocabulary does not give back byte for byte, has no tokens. Ids are
little-endian numbers of 2 bytes, 4 if a vocabulary needs them. `groups` writes the ids in order as `a1,a2|b1;a3|b2`.
Rows alike are aligned each for itself; null ids stay null. No rows give no rows.

Scale: alignment is a scan; texts go to the encoders some `CHUNK` bytes at a time. A task adds up its pairs before they
are shuffled. The counts of the most frequent pairs, `FREQUENT` at most, are broadcast; the texts' other pairs are
joined with their counts as rows. What is chosen for the broadcast changes nothing in the result. The vocabularies'
files are read by the driver and broadcast.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from beaconlake.llm.common import spare_prefix
from beaconlake.llm.packing import PATTERN
from beaconlake.session import staged

VOCABULARY_A = "/opt/tokenizers/byte_bpe_50k.json"
VOCABULARY_B = "/opt/tokenizers/piece_bpe_32k.model"
CHUNK = 1 << 19
FREQUENT = 1 << 20
PAIRS_KEPT = 1 << 21  # pairs a task holds before it adds them up
OUT_PAIRS = 1 << 15
_SHIFT = 32  # a pair is the id of A above the id of B
_SPACE = "▁"


class Vocabularies:
    """Both encoders, and the bytes of their tokens, from the contents of their files."""

    def __init__(self, file_a: bytes, file_b: bytes):
        import sentencepiece
        import tiktoken

        held = json.loads(file_a)
        special = {t["id"] for t in held["added_tokens"] if t["special"]}
        # Bytes that print stand for themselves, the others for the characters from 256 on.
        printing = [*range(33, 127), *range(161, 173), *range(174, 256)]
        others = [b for b in range(256) if b not in set(printing)]
        byte_of = {chr(b): b for b in printing} | {chr(256 + i): b for i, b in enumerate(others)}
        ranks = {bytes(byte_of[c] for c in entry): i for entry, i in held["model"]["vocab"].items() if i not in special}
        self._a = tiktoken.Encoding("a", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self._b = sentencepiece.SentencePieceProcessor(model_proto=file_b)
        self.bytes_a: list[bytes] = [b""] * (max(ranks.values()) + 1)
        for entry, i in ranks.items():
            self.bytes_a[i] = entry
        self.bytes_b = [self._piece(i) for i in range(self._b.get_piece_size())]
        self.sizes_a = np.array([len(t) for t in self.bytes_a])
        self.sizes_b = np.array([len(t) for t in self.bytes_b])
        self.kind = "<u2" if max(len(self.bytes_a), len(self.bytes_b)) <= 1 << 16 else "<u4"

    def _piece(self, i: int) -> bytes:
        piece = self._b.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if self._b.is_byte(i) else piece.replace(_SPACE, " ").encode()

    def encode(self, texts: list[str | None]) -> list[tuple[np.ndarray, np.ndarray]]:
        """Ids of A and of B per text; none if either does not give back the text."""
        none = np.zeros(0, np.int64)
        out = [(none, none)] * len(texts)
        given = [i for i, t in enumerate(texts) if t]
        for i, b in zip(given, self._b.encode([texts[i] for i in given], num_threads=1) if given else []):
            whole = b" " + texts[i].encode("utf-8", "surrogatepass")
            a = self._a.encode_ordinary(" " + texts[i])
            bytes_a, bytes_b = self.bytes_a, self.bytes_b
            if b"".join([bytes_b[t] for t in b]) == whole and b"".join([bytes_a[t] for t in a]) == whole:
                out[i] = np.array(a, np.int64), np.array(b, np.int64)
        return out


@cache
def _loaded(files: tuple[bytes, bytes]) -> Vocabularies:
    return Vocabularies(*files)


def _vocabularies(spark: SparkSession, paths: tuple[str, str]):
    contents = []
    for path in paths:
        with open(path, "rb") as file:
            contents.append(file.read())
    return spark.sparkContext.broadcast(tuple(contents))


def _bounds(sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    ends = np.cumsum(sizes)
    return ends - sizes, ends


def grouped(sizes_a: np.ndarray, sizes_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number of its group for every token of A and of B, which cover the same bytes."""
    starts, ends = (np.concatenate(x) for x in zip(_bounds(sizes_a), _bounds(sizes_b)))
    order = np.lexsort((np.arange(len(starts)) >= len(sizes_a), starts))
    reached = np.maximum.accumulate(ends[order])
    group = np.empty(len(starts), np.int64)
    group[order] = np.concatenate((np.zeros(min(len(starts), 1), np.int64), np.cumsum(starts[order][1:] >= reached[:-1])))
    return group[: len(sizes_a)], group[len(sizes_a) :]


def linked(sizes_a: np.ndarray, sizes_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the tokens of A and of B of every link, by A and then B."""
    (start_a, end_a), (start_b, end_b) = _bounds(sizes_a), _bounds(sizes_b)
    first, last = np.searchsorted(end_b, start_a, "right"), np.searchsorted(start_b, end_a, "left")
    n = last - first
    a = np.repeat(np.arange(len(sizes_a)), n)
    return a, np.arange(len(a)) - np.repeat(np.cumsum(n) - n, n) + np.repeat(first, n)


@cache
def _written(n: int) -> tuple[np.ndarray, ...]:
    """Decimal ids, each with one of the three separators behind it."""
    return tuple(np.array([f"{i}{mark}" for i in range(n)], object) for mark in ",|;")


def notation(a: np.ndarray, b: np.ndarray, group_a: np.ndarray, group_b: np.ndarray) -> str:
    if not len(a):
        return ""
    inner, bar, end = _written(1 << 16 if max(a.max(), b.max()) < 1 << 16 else int(max(a.max(), b.max())) + 1)
    group, ids = np.concatenate((group_a, group_b)), np.concatenate((a, b))
    side = np.arange(len(ids)) >= len(a)
    order = np.lexsort((side, group))
    group, ids, side = group[order], ids[order], side[order]
    new_group = np.append(group[1:] != group[:-1], True)
    new_side = np.append(side[1:] != side[:-1], False) & ~new_group
    texts = np.where(new_group, end[ids], np.where(new_side, bar[ids], inner[ids]))
    return "".join(texts.tolist())[:-1]


def _chunks(texts: list[str | None]) -> Iterator[tuple[int, int]]:
    begin, size = 0, 0
    for i, text in enumerate(texts):
        if size and size + len(text or "") > CHUNK:
            yield begin, i
            begin, size = i, 0
        size += len(text or "")
    if begin < len(texts):
        yield begin, len(texts)


ALIGNMENT = T.StructType(
    [T.StructField(n, T.LongType()) for n in ("n_a", "n_b", "n_groups", "n_links")]
    + [T.StructField("a", T.BinaryType()), T.StructField("b", T.BinaryType()), T.StructField("groups", T.StringType())]
)


def align(
    docs: DataFrame, text_col: str = "text", out: str = "alignment", vocabulary_a: str = VOCABULARY_A, vocabulary_b: str = VOCABULARY_B
) -> DataFrame:
    """All columns, and a struct `out`: numbers of tokens, groups and links, the ids of both, and the groups written out."""
    files = _vocabularies(docs.sparkSession, (vocabulary_a, vocabulary_b))
    arrow = pa.struct([*[(n, pa.int64()) for n in ("n_a", "n_b", "n_groups", "n_links")], ("a", pa.binary()), ("b", pa.binary()), ("groups", pa.string())])

    def one(own: Vocabularies, a: np.ndarray, b: np.ndarray) -> dict:
        sizes = own.sizes_a[a], own.sizes_b[b]
        group_a, group_b = grouped(*sizes)
        return {
            "n_a": len(a), "n_b": len(b), "n_groups": int(group_a[-1]) + 1 if len(a) else 0, "n_links": len(linked(*sizes)[0]),
            "a": a.astype(own.kind).tobytes(), "b": b.astype(own.kind).tobytes(), "groups": notation(a, b, group_a, group_b),
        }

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = _loaded(files.value)
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index(text_col)).to_pylist()
            for begin, end in _chunks(texts):
                found = pa.array([one(own, a, b) for a, b in own.encode(texts[begin:end])], arrow)
                kept = [c.slice(begin, end - begin) for c in batch.columns]
                yield pa.RecordBatch.from_arrays([*kept, found], names=[*batch.schema.names, out])

    return docs.mapInArrow(work, T.StructType([*docs.schema.fields, T.StructField(out, ALIGNMENT)]))


def _pairs(own: Vocabularies, a: bytes, b: bytes) -> np.ndarray:
    """The pairs of ids of all links."""
    a, b = np.frombuffer(a, own.kind).astype(np.int64), np.frombuffer(b, own.kind).astype(np.int64)
    at_a, at_b = linked(own.sizes_a[a], own.sizes_b[b])
    return (a[at_a] << _SHIFT) + b[at_b]


def _added(pairs: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    keys, place = np.unique(np.concatenate(pairs), return_inverse=True)
    return keys, np.bincount(place, np.concatenate(counts), len(keys)).astype(np.int64)


def link_counts(aligned: DataFrame, alignment: str = "alignment", vocabulary_a: str = VOCABULARY_A, vocabulary_b: str = VOCABULARY_B) -> DataFrame:
    """pair (id of A * 2^32 + id of B), n (links that hold it), best (no pair of its B id has more); read as often as wanted."""
    files = _vocabularies(aligned.sparkSession, (vocabulary_a, vocabulary_b))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = _loaded(files.value)
        keys, counts, size = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], 0
        for batch in batches:
            for a, b in zip(*(c.to_pylist() for c in batch.columns)):
                found, n = np.unique(_pairs(own, a, b), return_counts=True)
                keys.append(found)
                counts.append(n)
                size += len(found)
                if size > PAIRS_KEPT:
                    added = _added(keys, counts)
                    keys, counts, size = [added[0]], [added[1]], 0
                    if len(added[0]) > PAIRS_KEPT // 2:
                        yield from rows(*added)
                        keys, counts = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        yield from rows(*_added(keys, counts))

    def rows(keys: np.ndarray, counts: np.ndarray) -> Iterator[pa.RecordBatch]:
        for at in range(0, len(keys), OUT_PAIRS):
            yield pa.record_batch([pa.array(keys[at : at + OUT_PAIRS]), pa.array(counts[at : at + OUT_PAIRS])], names=["pair", "n"])

    ids = aligned.select(F.col(alignment)["a"].alias("a"), F.col(alignment)["b"].alias("b"))
    counted = staged(ids.mapInArrow(work, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n")), "pair-counts")
    of_b = F.col("pair").bitwiseAND((1 << _SHIFT) - 1)
    most = counted.groupBy(of_b.alias("b")).agg(F.max("n").alias("most"))  # a row per id of B
    marked = counted.withColumn("of_b", of_b).join(most, F.col("of_b") == F.col("b"))
    return staged(marked.select("pair", "n", (F.col("n") == F.col("most")).alias("best")), "pairs")


def _frequent(counts: DataFrame) -> tuple[int, pa.Table]:
    """The least count from which on there are `FREQUENT` pairs at most, by powers of two, and these pairs."""
    power = F.floor(F.log2("n")).cast("int")
    sizes = {r["power"]: r["count"] for r in counts.groupBy(power.alias("power")).count().collect()}  # 64 rows at most
    least, room = max(sizes, default=0) + 1, FREQUENT
    while least > 0 and sizes.get(least - 1, 0) <= room:
        least -= 1
        room -= sizes.get(least, 0)
    return 2**least, counts.where(F.col("n") >= 2**least).orderBy("pair").toArrow()


def link_scores(
    aligned: DataFrame, counts: DataFrame, alignment: str = "alignment", out: str = "links",
    vocabulary_a: str = VOCABULARY_A, vocabulary_b: str = VOCABULARY_B,
) -> DataFrame:
    """All columns but the ids, and a struct `out`: `n_best`, links whose pair is the best of its B id, and `count_sum`.

    `aligned` is read twice, so it should come from a table.
    """
    spark = aligned.sparkSession
    files = _vocabularies(spark, (vocabulary_a, vocabulary_b))
    least, table = _frequent(counts)
    held = spark.sparkContext.broadcast(tuple(table[c].to_numpy() for c in ("pair", "n", "best")))
    row = spare_prefix(aligned.columns) + "row"
    numbered = aligned.withColumn(row, F.monotonically_increasing_id())
    kept = [f for f in numbered.schema.fields if f.name != alignment]
    ids = T.StructType([T.StructField("a", T.BinaryType()), T.StructField("b", T.BinaryType())])
    prefix = row.removesuffix("row")
    found = T.StructType(
        [
            T.StructField(prefix + "n_best", T.LongType()), T.StructField(prefix + "count_sum", T.LongType()),
            T.StructField(prefix + "pairs", T.ArrayType(T.LongType())), T.StructField(prefix + "times", T.ArrayType(T.LongType())),
        ]
    )

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, (known, n, best) = _loaded(files.value), held.value
        for batch in batches:
            sums, pairs, times = [], [], []
            given = batch.column(batch.num_columns - 1)
            for a, b in zip(given.field("a").to_pylist(), given.field("b").to_pylist()):
                keys, here = np.unique(_pairs(own, a, b), return_counts=True)
                at = np.minimum(np.searchsorted(known, keys), max(len(known) - 1, 0))
                hit = known[at] == keys if len(known) else np.zeros(len(keys), bool)
                sums.append((int(here[hit][best[at[hit]]].sum()), int((here[hit] * n[at[hit]]).sum())))
                pairs.append(keys[~hit])
                times.append(here[~hit])
            ends = pa.array(np.cumsum([0, *map(len, pairs)]).astype(np.int32))
            lists = [pa.ListArray.from_arrays(ends, pa.array(np.concatenate([np.zeros(0, np.int64), *x]))) for x in (pairs, times)]
            columns = [pa.array([s[0] for s in sums], pa.int64()), pa.array([s[1] for s in sums], pa.int64()), *lists]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *columns], names=[f.name for f in kept] + found.names)

    shaped = numbered.select(*[f.name for f in kept], F.struct(*[F.col(alignment)[c].alias(c) for c in ids.names]).alias(alignment))
    summed = staged(shaped.mapInArrow(work, T.StructType([*kept, *found.fields])), "link-sums")
    rest = summed.select(F.col(row).alias("of"), F.explode(F.arrays_zip(F.col(prefix + "pairs").alias("pair"), F.col(prefix + "times").alias("times"))).alias("link"))
    rest = rest.select("of", "link.pair", "link.times")
    rare = counts.where(F.col("n") < least)
    added = rest.join(rare, "pair").groupBy("of").agg(
        F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("more_best"), F.sum(F.col("times") * F.col("n")).alias("more_sum")
    )
    joined = summed.join(added.select(F.col("of").alias(row + "_of"), F.col("more_best").alias(row + "_best"), F.col("more_sum").alias(row + "_sum")), F.col(row) == F.col(row + "_of"), "left")
    whole = F.struct(
        (F.col(prefix + "n_best") + F.coalesce(row + "_best", F.lit(0))).alias("n_best"),
        (F.col(prefix + "count_sum") + F.coalesce(row + "_sum", F.lit(0))).alias("count_sum"),
    )
    return joined.select(*[c for c in aligned.columns if c != alignment], whole.alias(out))
