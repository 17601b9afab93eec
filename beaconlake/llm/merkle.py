"""Merkle manifest of a dataset: a tree per group, and a tree over the groups' roots.

    manifest = build(rows, key, order, digest, keep=["doc_id"])
    proofs = prove(manifest)     # kept columns, key, place, digest, path, subroot, root
    fold(digest, path)           # the root that a leaf and its siblings lead to

Leaves of a group ascend by `order`; every `ARITY` neighbours of a level, fewer in its last run, become the digest of
their hexadecimal digests, until one node remains. The roots of the groups, by key, are the leaves of the last tree.

A tree is an append log in postorder: a node is written as soon as all below it is complete. `position` says in closed
form where: the last leaf below a node of level h and index i is z = min((i + 1) * ARITY^h, n) - 1; before that leaf
stand z leaves and z // ARITY^j complete nodes of every level j, and after it the nodes that it completes, level by
level. Builders work on aligned blocks of ARITY^HEIGHT leaves, each writing its stretch of the log as one row; the last
nodes of all blocks are the leaves of the next round. A proof reads the siblings of a leaf from the block's stretch by
position and takes the path above from the block, not from each leaf: what is joined is one row per block.

Groups and order may hold nulls, which come first; keys compare as UTF-8 bytes. Rows alike in order are told apart by
digest, and equal rows are leaves of their own. A group of one leaf has that leaf as its root; a single group gives
the root of the whole. No rows give no rows. Kept columns may have any names.

Scale: places come from range partitions and counts, so a group with most of the rows is many ranges; rounds are few
(the logarithm of the largest group to the base ARITY^HEIGHT). No block exceeds ARITY^HEIGHT rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from beaconlake.operators.ranks import numbered
from beaconlake.session import staged

ARITY = 3
HEIGHT = 6
SIZE = 32  # bytes of a digest
STEP = T.StructType([T.StructField("before", T.BinaryType()), T.StructField("after", T.BinaryType())])
_STEP = pa.struct([("before", pa.binary()), ("after", pa.binary())])


def hexed(data: Column) -> Column:
    return F.lower(F.hex(data))


def leaf(*values: Column) -> Column:
    """Digest of a row: each value as its UTF-8 length, a colon and itself, null as a dash."""
    texts = [v.cast("string") for v in values]
    parts = [F.when(t.isNull(), "-").otherwise(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t)) for t in texts]
    return F.unhex(F.sha2(F.concat(*parts).cast("binary"), 256))


def fold(digest: Column, path: Column) -> Column:
    """The root above a leaf, from its siblings, as hexadecimal text."""
    above = lambda below, step: F.sha2(F.concat(hexed(step["before"]), below, hexed(step["after"])).cast("binary"), 256)
    return F.aggregate(path, hexed(digest), above)


def siblings(path: Column) -> Column:
    """All siblings of a path, level by level, left to right, as hexadecimal text."""
    return F.array_join(F.transform(path, lambda step: F.concat(hexed(step["before"]), hexed(step["after"]))), "")


def height_of(leaves: int) -> int:
    height = 0
    while ARITY**height < leaves:
        height += 1
    return height


def position(level, index, leaves: int):
    """Place in the log of a node, or of an array of nodes."""
    last = np.minimum((np.asarray(index, np.int64) + 1) * ARITY**level, leaves) - 1
    place = last + level
    step = ARITY
    while step < ARITY * leaves:
        place = place + last // step
        step *= ARITY
    return place


def append_log(leaves: Sequence[bytes], height: int) -> list[bytes]:
    """Nodes of a block in the order in which they become complete, up to one node of level `height`."""
    log: list[bytes] = []
    runs: list[list[bytes]] = [[] for _ in range(height + 1)]

    def add(level: int, node: bytes) -> None:
        log.append(node)
        runs[level].append(node)
        if level < height and len(runs[level]) == ARITY:
            close(level)

    def close(level: int) -> None:
        node = hashlib.sha256("".join(d.hex() for d in runs[level]).encode()).digest()
        runs[level].clear()
        add(level + 1, node)

    for digest in leaves:
        add(0, digest)
    for level in range(height):
        if runs[level]:
            close(level)
    return log


@dataclass(frozen=True)
class Tree:
    """Blocks of every round, from the leaves up."""

    rounds: tuple[DataFrame, ...]
    keep: tuple[str, ...]

    def tops(self) -> DataFrame:
        found = [b.where("total = 1").select("key", F.col("top").alias("digest")) for b in self.rounds]
        out = found[0]
        for more in found[1:]:
            out = out.unionAll(more)
        return out


@dataclass(frozen=True)
class Manifest:
    groups: Tree
    whole: Tree


def _blocks(nodes: DataFrame, kept: T.StructType) -> DataFrame:
    """One row per block: its stretch of the log, its last node, and the kept columns of its leaves."""
    size = ARITY**HEIGHT
    schema = T.StructType(
        [
            T.StructField("key", T.StringType()), T.StructField("block", T.LongType()), T.StructField("n", T.LongType()),
            T.StructField("height", T.LongType()), T.StructField("total", T.LongType()), T.StructField("log", T.BinaryType()),
            T.StructField("top", T.BinaryType()), T.StructField("kept", T.ArrayType(kept)),
        ]
    )

    def work(table: pa.Table) -> pa.Table:
        table = table.sort_by("place").combine_chunks()
        n, total = table.num_rows, table["total"][0].as_py()
        height = HEIGHT if total > size else height_of(total)
        log = append_log(table["digest"].to_pylist(), height)
        kept_rows = pa.ListArray.from_arrays(pa.array([0, n], pa.int32()), table["kept"].chunk(0))
        return pa.table(
            {
                "key": table["key"][:1], "block": pa.array([table["place"][0].as_py() // size]), "n": pa.array([n]),
                "height": pa.array([height]), "total": pa.array([-(-total // ARITY**height)]),
                "log": pa.array([b"".join(log)]), "top": pa.array([log[-1]]), "kept": kept_rows,
            }
        )

    dealt = nodes.withColumn("block", F.floor(F.col("place") / size))
    return staged(dealt.groupBy("key", "block").applyInArrow(work, schema), "merkle-blocks")


def _tree(nodes: DataFrame, kept: T.StructType) -> Tree:
    """From rows of key, place, total, digest and kept."""
    rounds, largest = [], nodes.agg(F.max("total")).first()[0] or 0
    while True:
        rounds.append(_blocks(nodes, kept))
        largest = -(-largest // ARITY**HEIGHT)
        if largest <= 1:
            return Tree(tuple(rounds), tuple(kept.names))
        above = rounds[-1].where("total > 1")
        kept = T.StructType([T.StructField("place", T.LongType())])
        nodes = above.select("key", F.col("block").alias("place"), "total", F.col("top").alias("digest"), F.struct(F.col("block").alias("place")).alias("kept"))


def build(rows: DataFrame, key: Column, order: Sequence[Column], digest: Column, keep: Sequence[Column] = ()) -> Manifest:
    """The trees over the rows' digests; `keep` are columns to find beside the proofs."""
    # An equals sign before each key lets null, the empty text here, come first.
    keyed = F.coalesce(F.concat(F.lit("="), key.cast("string")), F.lit(""))
    ordered = [c.alias(f"order{i}") for i, c in enumerate(order)]
    leaves = rows.select(keyed.alias("key"), *ordered, digest.alias("digest"), F.struct(digest.alias("digest"), *keep).alias("kept"))
    by = [F.col(f"order{i}").asc_nulls_first() for i in range(len(ordered))]
    placed = numbered(leaves, [*by, F.col("digest").asc()], ["key"], total="total")
    groups = _tree(placed.select("key", "place", "total", "digest", "kept"), leaves.schema["kept"].dataType)
    tops = groups.tops().select(F.lit("").alias("key"), "digest", F.struct(F.col("key").alias("group")).alias("kept"))
    over = numbered(tops, [F.col("kept.group").asc()], ["key"], total="total")
    return Manifest(groups, _tree(over.select("key", "place", "total", "digest", "kept"), tops.schema["kept"].dataType))


def nodes(tree: Tree) -> DataFrame:
    """The append log of every tree's first round as rows: key, block, position in the block, digest."""
    held = tree.rounds[0].select("key", "block", F.posexplode(F.sequence(F.lit(0), (F.octet_length("log") / SIZE - 1).cast("int"))).alias("position", "i"), "log")
    return held.select("key", "block", "position", F.substring("log", F.col("i") * SIZE + 1, F.lit(SIZE)).alias("digest"))


def _neighbours(log: bytes, n: int, height: int) -> tuple[list[bytes], list[bytes], list[int]]:
    """What stands before and after each node in its run, by level and index; and where each level begins."""
    before, after, begins = [], [], []
    for level in range(height):
        count = -(-n // ARITY**level)
        at = position(level, np.arange(count), n) * SIZE
        digests = [log[p : p + SIZE] for p in at.tolist()]
        begins.append(len(before))
        for i in range(count):
            run = i - i % ARITY
            before.append(b"".join(digests[run:i]))
            after.append(b"".join(digests[i + 1 : run + ARITY]))
    return before, after, begins


def _paths(blocks: DataFrame, above: DataFrame) -> DataFrame:
    """One row per leaf of a round, with its path, from blocks and what stands above them: key, block, path, subroot, root."""
    kept = blocks.schema["kept"].dataType.elementType
    schema = T.StructType(
        [
            T.StructField("key", T.StringType()), T.StructField("kept", kept), T.StructField("path", T.ArrayType(STEP)),
            T.StructField("subroot", T.BinaryType()), T.StructField("root", T.BinaryType()),
        ]
    )

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = {name: batch.column(i) for i, name in enumerate(batch.schema.names)}
            for row in range(batch.num_rows):
                n, height = columns["n"][row].as_py(), columns["height"][row].as_py()
                before, after, begins = _neighbours(columns["log"][row].as_py(), n, height)
                upper = columns["path"][row].as_py()
                index = [begin + np.arange(n) // ARITY**level for level, begin in enumerate(begins)]
                index += [np.full(n, len(before) + i) for i in range(len(upper))]
                steps = pa.StructArray.from_arrays(
                    [pa.array(before + [s["before"] for s in upper], pa.binary()), pa.array(after + [s["after"] for s in upper], pa.binary())],
                    fields=list(_STEP),
                )
                depth = len(index)
                taken = steps.take(pa.array(np.stack(index, 1).ravel() if depth else np.zeros(0, np.int64)))
                path = pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * depth), taken)
                same = pa.array(np.zeros(n, np.int64))
                one = {c: columns[c].slice(row, 1).take(same) for c in ("key", "subroot", "root")}
                arrays = [one["key"], columns["kept"].slice(row, 1).flatten(), path, one["subroot"], one["root"]]
                yield pa.RecordBatch.from_arrays(arrays, names=schema.names)

    return blocks.join(above, ["key", "block"]).mapInArrow(work, schema)


def _descend(tree: Tree, above: DataFrame) -> DataFrame:
    """Paths of the leaves, from the last round down; `above` holds key, path, subroot and root of every tree's top."""
    inner: DataFrame | None = None
    for blocks in reversed(tree.rounds):
        ends = blocks.where("total = 1").select("key", "block").join(above, "key").select("key", "block", "path", "subroot", "root")
        if inner is not None:
            ends = ends.unionAll(inner.select("key", F.col("kept.place").alias("block"), "path", "subroot", "root"))
        inner = _paths(blocks, ends)
    return inner


def prove(manifest: Manifest) -> DataFrame:
    """One row per leaf: kept columns, key of the group (null as empty, else after an equals sign), digest, path, subroot, root."""
    root = manifest.whole.tops().select(
        "key", F.array().cast(T.ArrayType(STEP)).alias("path"), F.lit(None).cast("binary").alias("subroot"), F.col("digest").alias("root")
    )
    groups = _descend(manifest.whole, root).select(F.col("kept.group").alias("key"), "path", "root")
    tops = manifest.groups.tops().select("key", F.col("digest").alias("subroot"))
    above = groups.join(tops, "key").select("key", "path", "subroot", "root")
    return _descend(manifest.groups, above).select("kept.*", "key", "path", "subroot", "root")
