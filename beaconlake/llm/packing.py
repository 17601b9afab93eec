"""Token ids packed into rows of equal length, without cutting where it can be helped.

Texts become the ids of a public byte-level vocabulary, ended by an end-of-text id. Ids beyond `length` are split into
full rows and a rest. Rests are packed best fit, longest first: a segment tree over free space finds the open row with
the least space that is enough. Every id of every text is in exactly one row.

A packed row: `ids` (`length` little-endian numbers of 2 bytes, or 4 if the vocabulary needs them, padded with the
end-of-text id), `cu_lengths` (0 and the end of each segment) and, per segment, `doc_ids`, `pieces`, `resets` (the place
in the row where position numbers begin again) and `starts` (the number they begin with: 0, or for a later piece of a
split text the number of its first id). `positions` gives the position numbers of a row. `block` names the matrix: its
rows were packed together and stand in the order of `row`.

A null text is empty: only the end-of-text id. Null ids stay null. Rows alike are packed one by one. No rows give none.

Scale: no shuffle; a task packs blocks of about `BLOCK_IDS` ids as it reads, so memory does not grow with the partition.
A lost task packs the same rows again.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Callable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
END_ID = 50256
LENGTH = 2048
BLOCK_IDS = 1 << 21
CACHED = 1 << 19  # words whose ids a worker keeps
# How the public byte-level vocabulary parts words before merging: a fixed value.
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}++| ?\p{N}++| ?[^\s\p{L}\p{N}]++|\s++$|\s+(?!\S)|\s"""
PACKED = (
    "block long, row int, ids binary, cu_lengths array<int>, doc_ids array<long>, pieces array<int>, resets array<int>, starts array<long>, used int"
)


class _Ids(dict):
    """Packed ids of words behind a blank, encoded when first met; those met first are kept."""

    def __init__(self, encode: Callable[[str], bytes]):
        super().__init__()
        self.encode = encode

    def __missing__(self, word: str) -> bytes:
        ids = self.encode(" " + word)
        if len(self) < CACHED and len(word) <= 40:
            self[word] = ids
        return ids


_encoders: dict[tuple[str, int], Callable[[str], bytes]] = {}


def encoder(vocabulary: str, id_bytes: int) -> Callable[[str], bytes]:
    """Text to packed little-endian ids; loaded once in a worker."""
    if (vocabulary, id_bytes) not in _encoders:
        import tiktoken

        with open(vocabulary, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        own = tiktoken.Encoding("public", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        kind = f"<u{id_bytes}"

        def whole(text: str) -> bytes:
            return np.array(own.encode_ordinary(text), kind).tobytes()

        cache = _Ids(whole)
        rare = re.compile("[\t\x0b-\r\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")

        def encode(text: str) -> bytes:
            # A blank between two other characters begins a token, so such pieces can be encoded on their own. A text
            # with other white space beside a blank is encoded as a whole.
            doubled = "  " in text or "\n " in text or " \n" in text or text[:1] == " " or text[-1:] == " "
            if doubled or rare.search(text):
                return whole(text)
            first, *others = text.split(" ")
            return b"".join(chain((whole(first),), map(cache.__getitem__, others)))

        _encoders[vocabulary, id_bytes] = encode
    return _encoders[vocabulary, id_bytes]


class _Space:
    """Segment tree over the free space of open rows: which row has the least that is enough?"""

    def __init__(self, length: int):
        self.size = 1
        while self.size < length + 1:
            self.size *= 2
        self.any = bytearray(2 * self.size)  # whether some open row has a space of this range
        self.rows: list[list[int]] = [[] for _ in range(length + 1)]

    def put(self, space: int, row: int) -> None:
        self.rows[space].append(row)
        at = space + self.size
        while at and not self.any[at]:
            self.any[at] = 1
            at //= 2

    def take(self, need: int) -> tuple[int, int] | None:
        """(space, row) of the best fit."""
        at = need + self.size
        if not self.any[at]:
            while at > 1 and (at % 2 or not self.any[at + 1]):
                at //= 2
            if at <= 1:
                return None
            at += 1
            while at < self.size:
                at = 2 * at if self.any[2 * at] else 2 * at + 1
        space = at - self.size
        row = self.rows[space].pop()
        while at >= 1 and not (self.rows[space] if at >= self.size else self.any[2 * at] or self.any[2 * at + 1]):
            self.any[at] = 0
            at //= 2
        return space, row


def best_fit(sizes: list[int], length: int) -> list[list[int]]:
    """Rows of item numbers; sizes are at most `length`, longer items first, ties in the order given."""
    space, rows = _Space(length), []
    for item in sorted(range(len(sizes)), key=lambda i: (-sizes[i], i)):
        found = space.take(sizes[item])
        if found is None:
            rows.append([item])
            free = length - sizes[item]
            if free:
                space.put(free, len(rows) - 1)
        else:
            free, row = found
            rows[row].append(item)
            if free > sizes[item]:
                space.put(free - sizes[item], row)
    return rows


def pack(
    docs: DataFrame, length: int = LENGTH, vocabulary: str = VOCABULARY, end_id: int = END_ID,
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """Packed rows of all texts; see above."""
    kind = id_type(end_id)

    def packed(block: int, pieces: list[tuple[int | None, int, int, np.ndarray]]) -> pa.RecordBatch:
        rows = best_fit([len(p[3]) for p in pieces], length)
        columns: list[list] = [[] for _ in range(9)]
        for number, items in enumerate(rows):
            ids, ends = np.full(length, end_id, kind), [0]
            for item in items:
                own = pieces[item][3]
                ids[ends[-1] : ends[-1] + len(own)] = own
                ends.append(ends[-1] + len(own))
            values = (
                block, number, ids.tobytes(), ends, [pieces[i][0] for i in items], [pieces[i][1] for i in items],
                ends[:-1], [pieces[i][2] for i in items], ends[-1],
            )
            for column, value in zip(columns, values):
                column.append(value)
        kinds = [pa.int64(), pa.int32(), pa.binary(), pa.list_(pa.int32()), pa.list_(pa.int64()), pa.list_(pa.int32()), pa.list_(pa.int32()), pa.list_(pa.int64()), pa.int32()]
        names = ["block", "row", "ids", "cu_lengths", "doc_ids", "pieces", "resets", "starts", "used"]
        return pa.record_batch([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, end = encoder(vocabulary, kind.itemsize), np.array([end_id], kind).tobytes()
        block = TaskContext.get().partitionId() << 32
        held: list[tuple[int | None, int, int, np.ndarray]] = []
        count = 0
        for batch in batches:
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = np.frombuffer(encode(text.as_py() or "") + end, kind)
                for piece, at in enumerate(range(0, len(ids), length)):
                    held.append((doc, piece, at, ids[at : at + length]))
                count += len(ids)
                if count >= BLOCK_IDS:
                    yield packed(block, held)
                    held, count, block = [], 0, block + 1
        if held:
            yield packed(block, held)

    return docs.select(F.col(id_col).cast("long"), F.col(text_col).cast("string")).mapInArrow(work, PACKED)


def id_type(end_id: int) -> np.dtype:
    """The end-of-text id follows all others."""
    return np.dtype("<u2" if end_id < 1 << 16 else "<u4")


def positions(cu_lengths: list[int], starts: list[int], length: int) -> np.ndarray:
    """Position numbers of a packed row; padding has 0."""
    out = np.zeros(length, np.int64)
    for low, high, start in zip(cu_lengths, cu_lengths[1:], starts):
        out[low:high] = np.arange(start, start + high - low)
    return out


def unpack(packed: DataFrame, end_id: int = END_ID) -> DataFrame:
    """(doc_id, piece, ids) of every segment, the end-of-text id included."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            docs, pieces, found = [], [], []
            for row in batch.to_pylist():
                ids = np.frombuffer(row["ids"], id_type(end_id))
                for i, (low, high) in enumerate(zip(row["cu_lengths"], row["cu_lengths"][1:])):
                    docs.append(row["doc_ids"][i])
                    pieces.append(row["pieces"][i])
                    found.append(ids[low:high].astype(np.int64).tolist())
            yield pa.record_batch(
                [pa.array(docs, pa.int64()), pa.array(pieces, pa.int32()), pa.array(found, pa.list_(pa.int64()))],
                names=["doc_id", "piece", "ids"],
            )

    return packed.mapInArrow(work, "doc_id long, piece int, ids array<long>")
