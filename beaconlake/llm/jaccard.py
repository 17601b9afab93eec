"""Near copies by an exact n-gram Jaccard join with vertical partitioning.

A document's set holds its distinct shingles of `SHINGLE` words (all words as one, if there are fewer). Two documents
link when |a & b| >= 0.75 |a | b|; a component is what links connect.

1. Equal sets are one class. All work below is on classes.
2. Sets are cut into fragments by shingle hash. A task has all shingles of a fragment, so it knows which of them other
   sets hold, and how many. Only shared shingles go on. A class with less than three quarters of its set shared has no
   link and drops out.
3. The global order of shingles is by the number of sets that hold them, rarest first. Sets that link share a shingle
   among the first |a| - ceil(0.75 |a|) + 1 of both. For each such shingle, the least class that has it is its hub, and
   every other class with it is paired with the hub, never with one another.
4. Pairs are counted by vertical fragments of the global order: the overlaps of each fragment apart, then summed per
   pair.
5. A pair that shares a prefix shingle has a hub in common. Where both link to it they are connected already. The
   classes that do not link to a hub are compared with all classes around it in blocks of bounded size, again fragment by
   fragment; a block gives only the edges that join its components, so a group of m copies never makes m^2 rows.
6. Alternating stars turn edges into components.

Shingles are 48 bits of a hash, set sizes count 64 bits; two sets compared would need shingles that collide to be
misjudged (1e-9 for 500 shingles each). Null and empty texts have an empty set and link with nothing. Repeated rows are
equal sets. With null ids only, a component has a null id. No documents give no rows.

Scale: one shuffle of 8 bytes per shingle; the number of fragments grows with the corpus, so a fragment stays about
`FRAGMENT` shingles. Copies inside a batch are one set before the shuffle.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from beaconlake.llm import grams
from beaconlake.llm.common import filtered, row_key, spare_prefix
from beaconlake.llm.components import connected
from beaconlake.session import staged

SHINGLE = 5
PERCENT = 75
FRAGMENT = 1 << 21
BLOCK = 512  # classes on either side of a block
COLUMNS = 4096  # shingles of a fragment of a block
MOST_DF = 255
SIZES = "row long, doc_id long, key string, n_shingles long, cls binary"
PIECES = "fragment int, batch long, directory boolean, shingles binary, owners binary, counts binary"
CLASSES = "cls binary, n int, prefix array<long>, parts array<struct<part: int, shingles: array<long>>>"
EDGES = "a binary, b binary"


def shingle_sets(texts: pa.Array, k: int) -> Iterator[tuple[int, list[np.ndarray]]]:
    """(number of the first text, sorted distinct 64-bit shingles of each text)."""
    for at, words in grams.sliced(texts, grams.SPACED):
        hashes, first = words.runs(k)
        low = np.searchsorted(words.text[first], np.arange(words.texts + 1)) if len(first) else np.zeros(words.texts + 1, np.int64)
        sets = []
        for i in range(words.texts):
            if low[i] < low[i + 1]:
                sets.append(np.unique(hashes[low[i] : low[i + 1]]))
            elif words.bounds[i] < words.bounds[i + 1]:
                total = np.zeros(1, np.uint64)  # fewer than k words: one shingle
                for h in words.hash[words.bounds[i] : words.bounds[i + 1]]:
                    total = grams.mix(total * np.uint64(0xD6E8FEB86659FD93) + h)
                sets.append(total + np.uint64(1))
            else:
                sets.append(np.zeros(0, np.uint64))
        yield at, sets


def _class(shingles: np.ndarray) -> bytes:
    return hashlib.md5(shingles.tobytes()).digest()


def set_sizes(docs: DataFrame, k: int, keys: bool, id_col: str, text_col: str) -> DataFrame:
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [s for _, some in shingle_sets(batch.column(3), k) for s in some]
            columns = [
                *batch.columns[:3], pa.array([len(s) for s in sets], pa.int64()),
                pa.array([_class(s) if len(s) else None for s in sets], pa.binary()),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["row", "doc_id", "key", "n_shingles", "cls"])

    text = F.col(text_col).cast("string")
    key = row_key(F.col(id_col), text) if keys else F.lit(None).cast("string")
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).cast("long").alias("doc_id"), key.alias("key"), text.alias("text"))
    return rows.mapInArrow(work, SIZES)


def _six(numbers: np.ndarray) -> bytes:
    """48-bit numbers, 6 bytes each."""
    return np.ascontiguousarray(numbers.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6]).tobytes()


def _of_six(data: bytes) -> np.ndarray:
    out = np.zeros((len(data) // 6, 8), np.uint8)
    out[:, :6] = np.frombuffer(data, np.uint8).reshape(-1, 6)
    return out.view("<u8").ravel()


def _pieces(docs: DataFrame, k: int, bits: int, text_col: str) -> DataFrame:
    """Per batch and fragment the shingles and the sets they belong to; and per batch a directory of its sets."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        for batch in batches:
            known: dict[bytes, np.ndarray] = {}
            for _, some in shingle_sets(batch.column(0), k):
                for s in some:
                    if len(s):
                        known.setdefault(_class(s), s)
            if not known:
                continue
            sets = list(known.values())
            shingles = np.concatenate(sets) >> np.uint64(16)
            owners = np.repeat(np.arange(len(sets), dtype=np.uint32), [len(s) for s in sets])
            order = np.argsort(shingles)
            shingles, owners = shingles[order], owners[order]
            fragments = (shingles >> np.uint64(48 - bits)).astype(np.int64)
            cuts = np.searchsorted(fragments, np.arange((1 << bits) + 1))
            rows = [(number % (1 << bits), number, True, b"".join(known), np.array([len(s) for s in sets], np.uint32).tobytes(), b"")]
            for f in range(1 << bits):
                low, high = cuts[f], cuts[f + 1]
                if low < high:
                    rows.append((f, number, False, _six(shingles[low:high]), owners[low:high].astype(np.uint16).tobytes(), b""))
            number += 1
            yield _record(rows)

    return docs.select(F.col(text_col).cast("string").alias("text")).mapInArrow(work, PIECES)


def _record(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int32(), pa.int64(), pa.bool_(), pa.binary(), pa.binary(), pa.binary()]
    names = ["fragment", "batch", "directory", "shingles", "owners", "counts"]
    columns = list(zip(*rows)) or [[]] * 6
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], names=names)


def _shared(table: pa.Table) -> pa.Table:
    """Of a fragment, the shingles that more than one set holds, and how many hold them."""
    rows = table.select(["fragment", "batch", "directory", "shingles", "owners", "counts"]).to_pylist()
    own = [_of_six(r["shingles"]) for r in rows if not r["directory"]]
    found, n = np.unique(np.concatenate(own or [np.zeros(0, np.uint64)]), return_counts=True)
    found, n = found[n > 1], np.minimum(n[n > 1], MOST_DF).astype(np.uint8)
    out = [tuple(r.values()) for r in rows if r["directory"]]
    own_of = iter(own)
    for r in rows:
        if not r["directory"] and len(mine := next(own_of)) and len(found):
            at = np.minimum(np.searchsorted(found, mine), len(found) - 1)
            kept = found[at] == mine
            if kept.any():
                owners = np.frombuffer(r["owners"], np.uint16)[kept]
                out.append((r["fragment"], r["batch"], False, _six(mine[kept]), owners.tobytes(), n[at[kept]].tobytes()))
    return pa.Table.from_batches([_record(out)])


def _candidates(table: pa.Table) -> pa.Table:
    """Of a batch, the classes that may have a link: their prefix, and their shared shingles by vertical fragment."""
    rows = table.to_pylist()
    directory = next(r for r in rows if r["directory"])
    sizes = np.frombuffer(directory["owners"], np.uint32)
    names = [directory["shingles"][i : i + 16] for i in range(0, len(directory["shingles"]), 16)]
    rest = [r for r in rows if not r["directory"]]
    empty = np.zeros(0, np.uint8)
    shingles = np.concatenate([_of_six(r["shingles"]) for r in rest] or [empty]).astype(np.int64)
    owners = np.concatenate([np.frombuffer(r["owners"], np.uint16) for r in rest] or [empty]).astype(np.int64)
    counts = np.concatenate([np.frombuffer(r["counts"], np.uint8) for r in rest] or [empty])
    order = np.lexsort((shingles, counts, owners))
    shingles, owners, counts = shingles[order], owners[order], counts[order]
    low = np.searchsorted(owners, np.arange(len(sizes) + 1))
    columns: list[list] = [[], [], [], []]
    for i, n in enumerate(sizes.tolist()):
        mine, held = shingles[low[i] : low[i + 1]], counts[low[i] : low[i + 1]]
        if 100 * len(mine) < PERCENT * n:
            continue
        needed = -(-PERCENT * n // 100)
        prefix = mine[: max(0, n - needed + 1 - (n - len(mine)))]  # shingles of one set alone come first of all
        octave = np.log2(held).astype(np.int64)
        parts = [{"part": int(p), "shingles": mine[octave == p]} for p in np.unique(octave)]
        for column, value in zip(columns, (names[i], n, prefix, parts)):
            column.append(value)
    long_list = pa.list_(pa.int64())
    kinds = [pa.binary(), pa.int32(), long_list, pa.list_(pa.struct([("part", pa.int32()), ("shingles", long_list)]))]
    return pa.table({name: pa.array(c, t) for name, c, t in zip(["cls", "n", "prefix", "parts"], columns, kinds)})


def _block_edges(table: pa.Table) -> pa.Table:
    """Edges that connect what links among the classes of a block: queries against targets."""
    rows = table.to_pylist()
    asked, targets = [r for r in rows if r["asked"]], [r for r in rows if not r["asked"]]
    edges: list[tuple[bytes, bytes]] = []
    if asked and targets:
        t = [np.asarray(r["shingles"], np.int64) for r in targets]
        q = [np.asarray(r["shingles"], np.int64) for r in asked]
        order = np.unique(np.concatenate(t))
        t_row = np.repeat(np.arange(len(t)), [len(x) for x in t])
        q_row = np.repeat(np.arange(len(q)), [len(x) for x in q])
        t_all, q_all = np.concatenate(t), np.concatenate(q)
        t_at = np.searchsorted(order, t_all)
        q_at = np.minimum(np.searchsorted(order, q_all), len(order) - 1)
        known = order[q_at] == q_all
        q_row, q_at = q_row[known], q_at[known]
        overlap = np.zeros((len(q), len(t)), np.float32)
        for low in range(0, len(order), COLUMNS):  # overlaps of each fragment, summed
            width = min(COLUMNS, len(order) - low)
            q_in, t_in = (q_at >= low) & (q_at < low + width), (t_at >= low) & (t_at < low + width)
            a, b = np.zeros((len(q), width), np.float32), np.zeros((len(t), width), np.float32)
            a[q_row[q_in], q_at[q_in] - low] = 1
            b[t_row[t_in], t_at[t_in] - low] = 1
            overlap += a @ b.T
        n_q, n_t = np.array([r["n"] for r in asked])[:, None], np.array([r["n"] for r in targets])[None]
        both = overlap.astype(np.int64)
        parent = list(range(len(q) + len(t)))

        def top(i: int) -> int:
            while parent[i] != i:
                parent[i] = parent[parent[i]]
                i = parent[i]
            return i

        at_of = {r["cls"]: j for j, r in enumerate(targets)}
        for i, r in enumerate(asked):  # a class on both sides is one node
            if r["cls"] in at_of:
                parent[i] = len(q) + at_of[r["cls"]]
        for i, j in zip(*np.nonzero(100 * both >= PERCENT * (n_q + n_t - both))):
            x, y = top(int(i)), top(len(q) + int(j))
            if x != y:
                parent[x] = y
                edges.append((asked[i]["cls"], targets[j]["cls"]))
    return pa.table({"a": pa.array([a for a, _ in edges], pa.binary()), "b": pa.array([b for _, b in edges], pa.binary())})


def links(docs: DataFrame, sizes: DataFrame, k: int, text_col: str) -> DataFrame:
    """Edges between classes that connect exactly what links connect."""
    total = sizes.agg(F.sum("n_shingles")).first()[0] or 0
    bits = max(4, int(total // FRAGMENT).bit_length())
    pieces = _pieces(docs, k, bits, text_col)
    shared = pieces.groupBy("fragment").applyInArrow(_shared, PIECES)
    classes = shared.groupBy("batch").applyInArrow(_candidates, CLASSES)
    classes = staged(classes.dropDuplicates(["cls"]), "classes")

    prefixes = classes.select("cls", F.explode("prefix").alias("shingle"))
    hubs = prefixes.groupBy("shingle").agg(F.min("cls").alias("hub"), F.count(F.lit(1)).alias("held")).where("held > 1")
    pairs = prefixes.join(hubs.drop("held"), "shingle").where("cls <> hub").select("hub", "cls").distinct()
    pairs = staged(pairs, "pairs")
    parts = classes.select("cls", "n", F.explode("parts").alias("p")).select("cls", "n", "p.part", "p.shingles")
    of_hub = parts.select(F.col("cls").alias("hub"), F.col("n").alias("hub_n"), "part", F.col("shingles").alias("hub_shingles"))
    partial = pairs.join(parts, "cls").join(of_hub, ["hub", "part"])
    partial = partial.select("hub", "cls", "n", "hub_n", F.size(F.array_intersect("shingles", "hub_shingles")).alias("overlap"))
    summed = partial.groupBy("hub", "cls").agg(F.sum("overlap").alias("overlap"), F.max("n").alias("n"), F.max("hub_n").alias("hub_n"))
    linked = 100 * F.col("overlap") >= PERCENT * (F.col("n") + F.col("hub_n") - F.col("overlap"))
    around = staged(pairs.join(summed, ["hub", "cls"], "left").select("hub", "cls", F.coalesce(linked, F.lit(False)).alias("linked")), "around")

    # Classes that do not link to a hub against all classes around it.
    blocks = lambda n: F.ceil(n / BLOCK).cast("int")
    apart = F.sum(F.when(~F.col("linked"), 1).otherwise(0))
    hubs = around.groupBy("hub").agg(blocks(apart).alias("asked_blocks"), blocks(F.count(F.lit(1))).alias("target_blocks"), F.count(F.lit(1)).alias("m"))
    members = around.join(hubs.where("asked_blocks > 0 AND m > 1").drop("m"), "hub")
    place = lambda n: F.pmod(F.xxhash64("cls", "hub"), F.col(n)).cast("int")
    each = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    asked = members.where(~F.col("linked")).select("hub", "cls", F.lit(True).alias("asked"), place("asked_blocks").alias("i"), each("target_blocks").alias("j"))
    targets = members.select("hub", "cls", F.lit(False).alias("asked"), place("target_blocks").alias("j"), each("asked_blocks").alias("i"))
    whole = classes.select("cls", "n", F.flatten("parts.shingles").alias("shingles"))
    rows = asked.unionByName(targets).join(whole, "cls")
    more = rows.groupBy("hub", "i", "j").applyInArrow(_block_edges, EDGES)
    return around.where("linked").select(F.col("hub").alias("a"), F.col("cls").alias("b")).union(more)


def components(docs: DataFrame, k: int = SHINGLE, keys: bool = False, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(row, doc_id, key, n_shingles, cls, component_id, first): a row per document.

    `component_id` is the smallest id of the component; `first` is true for one row of each component, one with that id,
    and for every document with an empty set. With `keys`, `key` finds the document again (see `common.row_key`).
    """
    sizes = staged(set_sizes(docs, k, keys, id_col, text_col), "sets")
    edges = links(docs, sizes, k, text_col)
    roots = connected(edges, "a", "b").select(F.col("node").alias("cls"), "root")
    least = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), F.col("doc_id").alias("id"), F.col("row").alias("at")))
    of_class = sizes.where("cls IS NOT NULL").groupBy("cls").agg(least.alias("least"))
    rooted = staged(of_class.join(roots, "cls", "left").withColumn("root", F.coalesce("root", "cls")), "roots")
    of_root = rooted.groupBy("root").agg(F.min("least").alias("least"))
    known = rooted.select("cls", "root").join(of_root, "root").select(
        "cls", F.col("least.id").alias("component_id"), F.col("least.at").alias("at")
    )
    out = sizes.join(known, "cls", "left")
    alone = F.col("cls").isNull()
    return out.select(
        "row", "doc_id", "key", "n_shingles", "cls", F.when(alone, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
        (alone | (F.col("row") == F.col("at"))).alias("first"),
    )


def without_copies(docs: DataFrame, k: int = SHINGLE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents, with one of each component: one with the smallest id. Documents without words all stay."""
    kept = components(docs, k, True, id_col, text_col).where("first").select("key").distinct()
    p = spare_prefix(docs.columns)
    rows = filtered(docs, kept, "left_semi", id_col, text_col, out=p + "key")
    words = F.coalesce(F.col(text_col).rlike(r"[^\x20\x09-\x0D]"), F.lit(False))
    rows = rows.withColumn(p + "tie", F.when(words, F.lit(0).cast("long")).otherwise(F.monotonically_increasing_id()))
    return rows.dropDuplicates([p + "key", p + "tie"]).select(*docs.columns)  # a repeated row has the same key
