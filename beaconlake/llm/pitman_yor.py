"""Language-model scores from a hierarchical Pitman-Yor model.

Every context word has a restaurant whose dishes are the words that follow; tables of all contexts are the customers of
one parent, and its tables those of a uniform base. With discount d and strength s, a dish with c customers at t
tables of a restaurant with C customers at T tables has the probability

    (c - d t + (s + d T) * parent) / (s + C).

Seating is sampled by Gibbs sweeps in blocks: given the tables T of its restaurant and the parent's probability, the
customers of one dish of one context take their seats anew, one after the other, by the Chinese restaurant process;
a sweep does so for all dishes of all contexts at once, then for the parent. Probabilities are averaged over the sweeps
kept. The discount comes from the training data (n1 / (n1 + 2 n2), of pairs seen once and twice).

Every word of the training texts is a dish and has a restaurant of its own, however rare; besides, there are an end and
room for one unknown word. So the distribution over words sums to one, and every count is over all training texts. Words
are told apart by 64 bits of a hash. What is drawn for a pair depends on its two words and the sweep alone.

A null text is empty and has an end only. Documents with a null id are not learned from. Repeated rows are scored alike.
Without training data all dishes are equally likely. No documents give no rows.

Scale: the `WORDS` most frequent words have numbers, and what a sweep needs to know of them is sent to all tasks; the list
and, per sweep, a number for each of their dishes and contexts are all that passes the driver. The list decides where a pair is
worked on, not how: pairs of two frequent words lie in fragments by hash, all others in the fragment of their rare word, which
knows all that follows and precedes it; those of two rare words lie in both, which tell each other the tables and customers
of their words after every sweep. Pairs are counted by fragment, a row per block of texts and fragment.

When the sweeps are done, the texts are read again: a second shuffle brings the places where pairs occur, two bytes each,
behind the counts of their fragment, and a task passes them in small rows. So a task holds the counts of one fragment and
no more of the places than a batch, however often a pair occurs; the places of fragments with very frequent pairs are dealt
to several tasks. What the sweeps read is written once; a lost executor repeats a part.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from beaconlake.llm import grams
from beaconlake.session import delete_path, scratch_path, staged

WORDS = 65533
END, START, OTHER = 65533, 65534, 65535
IDS = 65536
TABLE_BITS = 18
FEW = 16
STRENGTH = 1.0
SMOOTH = 0.1
SWEEPS, KEPT = 3, 2
SEED = 20240229
BLOCK_TOKENS, BLOCK_TEXTS = 1 << 21, 1 << 15
FRAGMENT, RARE_FRAGMENT = 1 << 20, 1 << 18  # occurrences
SLICE = 4 * FRAGMENT  # occurrences of a fragment that one task places
RECORD_BYTES = 1 << 20
COUNTS = -1  # in place of a block: the counts of a fragment; below, what another fragment tells
DIRECTORY, RARE, PAIRS = 0, 1, 2
PACKED = "kind int, fragment int, block long, n long, a binary, b binary, c binary, d binary"
_MIX = 2654435769
_UNMIX = np.uint32(pow(_MIX, -1, 1 << 32))
_GOLDEN = 0x9E3779B97F4A7C15
_END_NAME, _START_NAME = 0x2545F4914F6CDD1D, 0xD1342543DE82EF95


@contextmanager
def _shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """Shuffle files go when what they were for is written, not when the driver happens to collect its garbage."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


# -- packing


def _bytes_of(numbers: np.ndarray, width: int) -> bytes:
    """The lowest byte of all numbers, then the next, which compresses well."""
    return b"".join((numbers >> numbers.dtype.type(8 * i)).astype(np.uint8).tobytes() for i in range(width))


def _of_bytes(data: bytes, n: int, width: int, at: int = 0) -> np.ndarray:
    out = np.zeros(n, np.uint64)
    for i in range(width):
        out |= np.frombuffer(data, np.uint8, n, at + i * n).astype(np.uint64) << np.uint64(8 * i)
    return out


def _planes(numbers: np.ndarray) -> bytes:
    """32-bit numbers."""
    return _bytes_of(numbers.astype(np.uint32), 4)


def _of_planes(data: bytes) -> np.ndarray:
    return _of_bytes(data, len(data) // 4, 4).astype(np.uint32)


def _rising(numbers: np.ndarray) -> bytes:
    """Sorted 32-bit numbers as differences."""
    return _planes(np.diff(numbers.astype(np.int64), prepend=0))


def _of_rising(data: bytes) -> np.ndarray:
    return np.cumsum(_of_planes(data), dtype=np.int64)


def _record(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), *[pa.binary()] * 4]
    columns = list(zip(*rows)) or [[]] * 8
    names = ["kind", "fragment", "block", "n", "a", "b", "c", "d"]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], names=names)


def _records(rows: Iterable[tuple]) -> Iterator[pa.RecordBatch]:
    """Rows in batches of about `RECORD_BYTES`."""
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += 64 + sum(len(x) for x in row[4:])
        if size >= RECORD_BYTES:
            yield _record(held)
            held, size = [], 0
    if held:
        yield _record(held)


def _put(arrays: Iterable[np.ndarray]) -> bytes:
    """Arrays of numbers from 0 up, each in as few bytes a number as its largest needs."""
    parts = []
    for numbers in arrays:
        width = (int(numbers.max()).bit_length() + 7) // 8 if len(numbers) else 0
        parts.append(np.array([len(numbers), width], "<i8").tobytes())
        parts.append(_bytes_of(numbers.astype(np.uint64), width))
    return b"".join(parts)


def _parts(data: bytes) -> list[tuple[int, int, int]]:
    """Number, bytes and place of the arrays."""
    out, at = [], 0
    while at < len(data):
        n, width = np.frombuffer(data, "<i8", 2, at).tolist()
        out.append((n, width, at + 16))
        at += 16 + n * width
    return out


def _taken(data: bytes) -> list[np.ndarray]:
    return [_of_bytes(data, *part) for part in _parts(data)]


def _rows(batches: Iterable[pa.RecordBatch]) -> Iterator[dict]:
    """Rows one by one, as those of a batch may be large."""
    for batch in batches:
        for i in range(batch.num_rows):
            yield {name: column[i].as_py() for name, column in zip(batch.schema.names, batch.columns)}


def _gaps(keys: np.ndarray) -> np.ndarray:
    """Sorted 64-bit numbers as differences."""
    return np.diff(keys, prepend=keys.dtype.type(0))


# -- vocabulary


@dataclass(frozen=True)
class Vocabulary:
    keys: np.ndarray  # of the frequent words, sorted; the position is the id
    counts: np.ndarray  # training count of each id
    tokens: int
    types: int
    texts: int

    def table(self) -> np.ndarray:
        """Ids by the upper bits of the hash, or at the next free place."""
        out, bits = np.full(1 << TABLE_BITS, OTHER, np.int64), np.uint64(64 - TABLE_BITS)
        for i, spot in enumerate((self.keys >> bits).astype(np.int64).tolist()):
            while out[spot] != OTHER:
                spot = (spot + 1) % len(out)
            out[spot] = i
        return out

    def ids(self, keys: np.ndarray, table: np.ndarray) -> np.ndarray:
        spot = (keys >> np.uint64(64 - TABLE_BITS)).astype(np.int64)
        out, known = table[spot], np.append(self.keys, np.zeros(1, np.uint64))
        at = np.flatnonzero(out != OTHER)
        while True:
            at = at[known[out[at]] != keys[at]]
            if not len(at):
                return out
            spot[at] = (spot[at] + 1) % len(table)
            out[at] = table[spot[at]]
            at = at[out[at] != OTHER]

    def names(self) -> np.ndarray:
        """The hash of each id."""
        out = np.zeros(IDS, np.uint64)
        out[: len(self.keys)], out[END], out[START] = self.keys, _END_NAME, _START_NAME
        return out


def _vocabulary(training: DataFrame) -> Vocabulary:
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, count = [], 0

        def counted() -> pa.RecordBatch:
            keys, n = np.unique(np.concatenate(held), return_counts=True)
            return pa.record_batch([pa.array(keys.view(np.int64)), pa.array(n)], names=["word", "n"])

        for batch in batches:
            for _, words in grams.sliced(batch.column(0), grams.SPACED):
                held.append(words.hash)
                count += len(held[-1])
            if count >= BLOCK_TOKENS:
                yield counted()
                held, count = [], 0
        if count:
            yield counted()

    words = training.select("text").mapInArrow(work, "word long, n long").groupBy("word").agg(F.sum("n").alias("n"))
    words = staged(words, "words")
    texts = training.count()
    # Frequent enough: the lowest of finely stepped counts that leaves at most WORDS words above it.
    step = F.floor(F.log2("n") * 64).cast("int")
    steps = sorted(((r["step"], r["types"], r["n"]) for r in words.groupBy(step.alias("step")).agg(F.count(F.lit(1)).alias("types"), F.sum("n").alias("n")).collect()), reverse=True)
    cut, room = None, WORDS
    for at, types, _ in steps:
        if types > room:
            break
        cut, room = at, room - types
    frequent = words.where(step >= F.lit(cut)) if cut is not None else words.limit(0)
    table = frequent.toArrow()
    keys = table["word"].to_numpy().view(np.uint64)
    order = np.argsort(keys)
    counts = np.zeros(IDS, np.int64)
    counts[: len(keys)] = table["n"].to_numpy()[order]
    counts[END] = counts[START] = texts
    tokens = sum(n for _, _, n in steps) + texts
    return Vocabulary(keys[order], counts, tokens, sum(t for _, t, _ in steps) + (texts > 0), texts)


# -- occurrences by fragment


def _by_fragment(keys: np.ndarray, posts: np.ndarray, bits: int, block: int, places: bool) -> Iterator[tuple]:
    """A row per fragment, that is, value of the upper bits: distinct pairs, and either their places or their training counts.

    Pairs are sorted, and the places of each.
    """
    first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
    unique, ends = keys[first], np.append(first, len(keys))
    of = (unique >> np.uint32(32 - bits)).astype(np.int64)
    where = np.searchsorted(of, np.arange((1 << bits) + 1))
    for f in np.flatnonzero(np.diff(where)).tolist():
        low, high = where[f], where[f + 1]
        some, a = posts[ends[low] : ends[high]], _rising(unique[low:high])
        if places:
            yield PAIRS, f, block, len(some), a, _planes(np.diff(ends[low : high + 1])), some.tobytes(), b""
        else:
            trained = np.add.reduceat(some & 1, ends[low:high] - ends[low], dtype=np.int64)
            yield PAIRS, f, block, len(some), a, _planes(trained), b"", b""


# Pairs with a rare word: its dishes that are frequent words, the contexts before it that are, its rare dishes, and,
# with the counts only, the rare contexts before it.
AFTER, BEFORE, RARE_AFTER, RARE_BEFORE = range(4)


def _rare_by_fragment(after: tuple, before: tuple, both: tuple, bits: int, offset: int, block: int, places: bool) -> Iterator[tuple]:
    """A row per fragment of the rare words: the words, and their pairs with either the places or the training counts.

    Given are hash, number of the other word and place; of two rare words both hashes.
    """
    words, at = np.unique(np.concatenate((after[0], before[0], both[0], both[1])), return_inverse=True)
    at_after, at_before, at_both, at_dish = np.split(at.astype(np.uint64), np.cumsum([len(after[0]), len(before[0]), len(both[0])]))
    sides = [(at_after, after[1], after[2]), (at_before, before[1], before[2]), (at_both, at_dish, both[2])]
    if not places:
        sides.append((at_dish, at_both, both[2]))
    edges = np.searchsorted(words >> np.uint64(64 - bits), np.arange((1 << bits) + 1, dtype=np.uint64))
    found = []
    for side, (own, partner, post) in enumerate(sides):
        if side < RARE_AFTER:  # sorted as one number
            code = own << np.uint64(32) | partner.astype(np.uint64) << np.uint64(16) | post.astype(np.uint64)
            code.sort()
            code, post = code >> np.uint64(16), code.astype(np.uint16)
            code = (code >> np.uint64(16)) << np.uint64(32) | code & np.uint64(0xFFFF)
        else:
            code = own << np.uint64(32) | partner
            order = np.lexsort((post, code))
            code, post = code[order], post[order]
        first = np.flatnonzero(np.concatenate(([True], code[1:] != code[:-1]))) if len(code) else np.zeros(0, np.int64)
        ends = np.append(first, len(code))
        code = code[first]
        own, partner = (code >> np.uint64(32)).astype(np.int64), code & np.uint64(0xFFFFFFFF)
        if side >= RARE_AFTER:
            partner = words[partner.astype(np.int64)]
        if places:
            counts = np.diff(ends)
        else:
            counts = np.add.reduceat(post & 1, first, dtype=np.int64) if len(first) else np.zeros(0, np.int64)
        found.append((own, partner, counts, ends, post, np.searchsorted(own, edges)))
    for f in np.flatnonzero(np.diff(edges)).tolist():
        low, high = edges[f], edges[f + 1]
        arrays, posts, n = [_gaps(words[low:high])], [], 0
        for own, partner, counts, ends, post, where in found:
            some = slice(where[f], where[f + 1])
            arrays += [np.bincount(own[some] - low, minlength=high - low), partner[some], counts[some]]
            posts.append(post[ends[where[f]] : ends[where[f + 1]]].tobytes() if places else b"")
            n += ends[where[f + 1]] - ends[where[f]]
        yield RARE, offset + f, block, int(n), _put(arrays), *posts[:3]


def _packed(texts: DataFrame, vocabulary: Vocabulary, rare_bits: int, pair_bits: int, places: bool) -> DataFrame:
    """Blocks of texts: pairs by hash and pairs with rare words by their hash, with their training counts.

    With `places`, the texts they occur in instead, and a directory.
    """
    sent = texts.sparkSession.sparkContext.broadcast(vocabulary)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = sent.value
        logs, table = np.log10(known.counts[: len(known.keys)] + SMOOTH), known.table()
        block = TaskContext.get().partitionId() << 32
        pairs, rare, directory = [], ([], [], []), []
        tokens = 0

        def cut() -> Iterator[tuple]:
            if places:
                columns = [np.concatenate(c) for c in zip(*directory)]
                types = ("<i8", "<i8", "<f8", "<i8")
                yield DIRECTORY, -1 - block % 64, block, len(columns[0]), *(c.astype(t).tobytes() for c, t in zip(columns, types))
            both = np.concatenate(pairs)  # sorted as one number, which takes less memory than an order
            pairs.clear()
            if len(both):
                both.sort()
                mixed, post = (both >> np.uint64(16)).astype(np.uint32), both.astype(np.uint16)
                del both
                yield from _by_fragment(mixed, post, pair_bits, block, places)
            sides = [tuple(np.concatenate(c) for c in zip(*side)) for side in rare]
            if any(len(side[0]) for side in sides):
                yield from _rare_by_fragment(*sides, rare_bits, 1 << pair_bits, block, places)

        for batch in batches:
            train = batch.column(2).to_numpy(zero_copy_only=False)
            row_ids = batch.column(0).to_numpy()
            for at, words in grams.sliced(batch.column(1), grams.SPACED):
                n, base = words.texts, sum(len(d[0]) for d in directory)
                if directory and (tokens >= BLOCK_TOKENS or base + n > BLOCK_TEXTS):
                    yield from _records(cut())
                    pairs, rare, directory = [], ([], [], []), []
                    tokens, base, block = 0, 0, block + 1
                ids = known.ids(words.hash, table)
                spot = np.arange(len(ids)) + words.text
                row, names = np.full(len(ids) + n, END, np.uint32), np.zeros(len(ids) + n, np.uint64)
                row[spot], names[spot] = ids, words.hash
                before = np.empty_like(row)
                before[1:] = row[:-1]
                before[words.bounds[:-1] + np.arange(n)] = START
                size = np.diff(words.bounds) + 1
                post = np.repeat(((base + np.arange(n)) << 1 | train[at : at + n]).astype(np.uint16), size)
                dish_rare, context_rare = row == OTHER, before == OTHER
                some = ~(dish_rare | context_rare)
                mixed = (before[some] << np.uint32(16) | row[some]) * np.uint32(_MIX)
                pairs.append(mixed.astype(np.uint64) << np.uint64(16) | post[some].astype(np.uint64))
                some = np.flatnonzero(context_rare & ~dish_rare)
                rare[0].append((names[some - 1], row[some], post[some]))
                some = np.flatnonzero(dish_rare & ~context_rare)
                rare[1].append((names[some], before[some], post[some]))
                some = np.flatnonzero(dish_rare & context_rare)
                rare[2].append((names[some - 1], names[some], post[some]))
                out = ids == OTHER
                own = np.bincount(words.text[~out], weights=logs[ids[~out]], minlength=n) if len(logs) else np.zeros(n)
                own += np.log10(known.texts + SMOOTH)
                seen = np.bincount(words.text[~out], minlength=n) + (known.texts > 0)
                directory.append((row_ids[at : at + n], size, own, seen))
                tokens += len(row)
        if directory:
            yield from _records(cut())

    return texts.select("row", "text", "train").mapInArrow(work, PACKED)


def _merged(rows: list[dict]) -> Rare:
    """The counts of a fragment of rare words, seated with one table for each dish of each context."""
    blocks = [_taken(r["a"]) for r in rows]
    listed = [np.cumsum(b[0], dtype=np.uint64) for b in blocks]
    words, place = np.unique(np.concatenate(listed), return_inverse=True)
    places = np.split(place, np.cumsum([len(x) for x in listed])[:-1])
    sides = []
    for side in range(4):
        own = np.concatenate([np.repeat(p, b[1 + 3 * side].astype(np.int64)) for p, b in zip(places, blocks)])
        partners, partner = np.unique(np.concatenate([b[2 + 3 * side] for b in blocks]), return_inverse=True)
        codes, at = np.unique(own << 32 | partner, return_inverse=True)
        counts = np.bincount(at, weights=np.concatenate([b[3 + 3 * side] for b in blocks]), minlength=len(codes)).astype(np.int64)
        sides.append(Side(codes >> 32, partners[codes & 0xFFFFFFFF], counts))
    first = [np.minimum(s.counts, 1) for s in sides]
    return Rare(words, sides, [Seating.of(words, sides, first)])


def _counted(table: pa.Table) -> pa.Table:
    """One row with all pairs of a fragment, their training counts and the number of occurrences."""
    rows = table.to_pylist()
    kind, n = rows[0]["kind"], sum(r["n"] for r in rows)
    if kind == RARE:
        return pa.Table.from_batches([_record([_merged(rows).row(rows[0]["fragment"], n)])])
    trained = np.concatenate([_of_planes(r["b"]) for r in rows])
    keys, at = np.unique(np.concatenate([_of_rising(r["a"]) for r in rows]), return_inverse=True)
    counts = np.bincount(at, weights=trained, minlength=len(keys)).astype(np.int64)
    return pa.Table.from_batches([_record([(kind, rows[0]["fragment"], COUNTS, n, _rising(keys), _planes(counts), b"", b"")])])


# -- seating


# Random numbers for some positions: a row of them from a given number on, and as many rows as asked for.
Chance = Callable[[np.ndarray, int, int], np.ndarray]


def _pair(context: np.ndarray, dish: np.ndarray) -> np.ndarray:
    """A hash of two words, by their hashes."""
    return grams.mix(context * np.uint64(_GOLDEN) + dish)


def _chance(keys: np.ndarray, sweep: int) -> Chance:
    """Random numbers that depend on the key of a position and the sweep alone."""
    base = grams.mix(keys + grams.mix(np.array([SEED + (sweep << 32)], np.uint64)))

    def draw(at: np.ndarray, first: int, rows: int) -> np.ndarray:
        step = np.arange(first, first + rows, dtype=np.uint64) * np.uint64(_GOLDEN)
        return (grams.mix(base[at] + step[:, None]) >> np.uint64(11)) * 2.0**-53

    return draw


def seat(counts: np.ndarray, new: np.ndarray, discount: float, random: np.random.Generator | Chance) -> np.ndarray:
    """Tables that `counts` customers of a dish take, one after the other, if `new` weighs a table of their own.

    With n customers at t tables, the next opens a table with weight `new` and joins one with n - discount * t. The
    first customers are seated one by one; later, the number of customers until the next table is drawn at once. The few
    dishes with the most tables are seated each on its own.
    """
    chance = random if callable(random) else lambda at, first, rows: random.random((rows, len(at)))
    tables = (counts > 0).astype(np.float64)
    at = np.flatnonzero(counts > 1)
    n = 1
    while len(at) and n < 24:
        opens = chance(at, n, 1)[0] * (new[at] + n - discount * tables[at]) < new[at]
        tables[at[opens]] += 1
        n += 1
        at = at[counts[at] > n]
    seated, asked = np.full(len(at), float(n)), n
    with np.errstate(over="ignore", divide="ignore"):
        while len(at) > FEW:
            spot = np.arange(len(at))
            for row in chance(at, asked, 1 if len(at) > 4096 else 16):
                joined = seated - discount * tables[at]
                following = np.floor(joined * row[spot] ** (-1 / np.maximum(new[at], 1e-12)) + discount * tables[at])
                opens = following < counts[at]
                at, seated, spot = at[opens], np.maximum(following[opens], seated[opens]) + 1, spot[opens]
                tables[at] += 1
                more = seated < counts[at]
                at, seated, spot = at[more], seated[more], spot[more]
                asked += 1
                if len(at) <= FEW:
                    break
    for i in range(len(at)):
        tables[at[i]] = _seat_one(at[i : i + 1], float(seated[i]), float(tables[at[i]]), counts, new, discount, chance, asked)
    return tables


def _seat_one(at: np.ndarray, n: float, tables: float, counts: np.ndarray, new: np.ndarray, discount: float, chance: Chance, asked: int) -> float:
    """Tables of one dish, of which n customers have their seats."""
    count, power, rows = float(counts[at[0]]), -1 / max(float(new[at[0]]), 1e-12), 64
    while True:
        for drawn in chance(at, asked, rows)[:, 0].tolist():
            closed = discount * tables
            try:
                following = math.floor((n - closed) * drawn**power + closed)
            except (OverflowError, ZeroDivisionError):  # beyond all customers
                return tables
            if following >= count:
                return tables
            n, tables = max(following, n) + 1, tables + 1
            if n >= count:
                return tables
        asked, rows = asked + rows, 4096


@dataclass(frozen=True)
class State:
    """What a sweep needs to know of frequent words, and of the parent's restaurant as a whole."""

    names: np.ndarray  # hash of each frequent word
    trained: np.ndarray  # customers of its restaurant
    tables: np.ndarray  # tables there
    parent: np.ndarray  # its probability as a dish of the parent
    all_customers: float
    all_tables: float
    tables_before: float  # all tables before the parent's last sweep
    uniform: float
    discount: float
    sweep: int

    def shares(self, customers: np.ndarray, dish: np.ndarray) -> np.ndarray:
        """The parent's probability of dishes, given by hash, with so many customers; the same wherever it is asked for."""
        tables = _seated_parent(customers, dish, self.tables_before, self.uniform, self.discount, self.sweep, SWEEPS)
        return _shares(customers, tables, self.all_customers, self.all_tables, self.uniform, self.discount)

    def given(self, counts: np.ndarray, tables: np.ndarray, of_context: np.ndarray, trained: np.ndarray, parent: np.ndarray) -> np.ndarray:
        """The probability of dishes in the restaurants of their contexts."""
        return (counts - self.discount * tables + (STRENGTH + self.discount * of_context) * parent) / (STRENGTH + trained)

    def seated(self, sweep: int, counts: np.ndarray, of_context: np.ndarray, parent: np.ndarray, context: np.ndarray, dish: np.ndarray) -> np.ndarray:
        """Tables of the sweep after this state, the same whenever and wherever it is asked for; words are given by hash."""
        tables, at = np.minimum(counts, 1).astype(np.float64), np.flatnonzero(counts > 1)
        new = (STRENGTH + self.discount * of_context[at]) * parent[at]
        tables[at] = seat(counts[at], new, self.discount, _chance(_pair(context[at], dish[at]), sweep))
        return tables


def _seated_parent(customers: np.ndarray, dish: np.ndarray, opened: float, uniform: float, discount: float, sweep: int, turn: int) -> np.ndarray:
    """Tables of dishes in the parent after one of its own sweeps, with all tables before it."""
    tables, at = np.minimum(customers, 1).astype(np.float64), np.flatnonzero(customers > 1)
    new = np.full(len(at), (STRENGTH + discount * opened) * uniform)
    tables[at] = seat(customers[at], new, discount, _parent_chance(dish[at], sweep, turn))
    return tables


def _parent_chance(dish: np.ndarray, sweep: int, turn: int) -> Chance:
    return _chance(_pair(np.zeros(1, np.uint64), dish), sweep | turn << 8)


def _shares(customers: np.ndarray, tables: np.ndarray, all_customers: float, all_tables: float, uniform: float | np.ndarray, discount: float) -> np.ndarray:
    return (customers - discount * tables + (STRENGTH + discount * all_tables) * uniform) / (STRENGTH + all_customers)


@dataclass
class Others:
    """Dishes of the parent without a number: how many, customers, tables at first, and those after a sweep with so many before."""

    number: int = 0
    customers: int = 0
    tables: int = 0
    swept: Callable[[int, float], int] = lambda turn, opened: 0
    before: float = 0.0  # all tables of the parent, before its last sweep and after it
    opened: float = 0.0


def _parent(
    customers: np.ndarray, dishes: int, discount: float, random: np.random.Generator | Callable[[int], Chance], sweeps: int, others: Others | None = None
) -> np.ndarray:
    """Probabilities of the dishes in the parent restaurant, its own seating sampled."""
    others = others or Others()
    dish = np.zeros(IDS, bool)
    dish[:dishes] = dish[END] = True
    uniform = dish / (dish.sum() + others.number)
    tables = np.minimum(customers, 1).astype(np.float64)
    others.before = others.opened = float(tables.sum() + others.tables)
    for turn in range(1, sweeps + 1):
        others.before = others.opened
        new = (STRENGTH + discount * others.before) * uniform
        tables = seat(customers, new, discount, random(turn) if callable(random) else random)
        others.opened = float(tables.sum() + others.swept(turn, others.before))
    return _shares(customers, tables, customers.sum() + others.customers, others.opened, uniform, discount)


def _model(a: bytes, b: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Context, dish and training count of the pairs of a fragment."""
    pairs = _of_rising(a).astype(np.uint32) * _UNMIX
    return (pairs >> np.uint32(16)).astype(np.int64), (pairs & np.uint32(0xFFFF)).astype(np.int64), _of_planes(b).astype(np.int64)


def _draw(state: State, sweep: int, context: np.ndarray, dish: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The seating of pairs of frequent words."""
    return state.seated(sweep, counts, state.tables[context], state.parent[dish], state.names[context], state.names[dish])


def _summed(at: np.ndarray, numbers: np.ndarray, n: int) -> np.ndarray:
    return np.bincount(at, weights=numbers, minlength=n).astype(np.int64)


@dataclass(frozen=True)
class Side:
    """Pairs of the rare words of a fragment on one side, sorted: the word's position, and number or hash of the other."""

    own: np.ndarray
    partner: np.ndarray
    counts: np.ndarray


@dataclass(frozen=True)
class Seating:
    """The seating of a sweep in a fragment of rare words."""

    tables: list[np.ndarray]  # of pairs, by side; not of RARE_BEFORE, which other fragments have
    of_context: np.ndarray  # by word, tables in its restaurant
    customers: np.ndarray  # by word, in the parent
    dish_customers: np.ndarray | None = None  # of rare dishes, as told by their fragments

    @staticmethod
    def of(words: np.ndarray, sides: list[Side], tables: list[np.ndarray]) -> Seating:
        n = len(words)
        of_context = sum(_summed(sides[s].own, tables[s], n) for s in (AFTER, RARE_AFTER))
        customers = sum(_summed(sides[s].own, tables[s], n) for s in (BEFORE, RARE_BEFORE))
        return Seating(tables[:RARE_BEFORE], of_context, customers)


@dataclass(frozen=True)
class Rare:
    """A fragment of rare words: the words, their pairs by side, and seatings: those kept, and the last."""

    words: np.ndarray
    sides: list[Side]
    seatings: list[Seating]

    def row(self, fragment: int, n: int) -> tuple:
        """The words and their customers in the parent stand by themselves, as its sweeps read nothing else."""
        arrays = []
        for side in self.sides:
            arrays += [np.bincount(side.own, minlength=len(self.words)), side.partner, side.counts]
        for s in self.seatings:
            arrays += [*s.tables, s.of_context, *([] if s.dish_customers is None else [s.customers, s.dish_customers])]
        return RARE, fragment, COUNTS, n, _put(arrays), _put([_gaps(self.words), self.seatings[-1].customers]), b"", b""

    @staticmethod
    def of(row: dict) -> Rare:
        arrays, (words, customers) = _taken(row["a"]), Rare.eaters(row["b"])
        rest = [*(a.view(np.int64) for a in arrays[12:]), customers]
        spots = np.arange(len(words))
        sides = [Side(np.repeat(spots, arrays[i].view(np.int64)), arrays[i + 1], arrays[i + 2].view(np.int64)) for i in range(0, 12, 3)]
        return Rare(words, sides, [Seating(rest[i : i + 3], *rest[i + 3 : i + 6]) for i in range(0, len(rest), 6)])

    @staticmethod
    def eaters(data: bytes) -> tuple[np.ndarray, np.ndarray]:
        """Words and their customers in the parent."""
        gaps, customers = _taken(data)
        return np.cumsum(gaps, dtype=np.uint64), customers.view(np.int64)

    @staticmethod
    def last(data: bytes) -> tuple[list, list, list]:
        """Numbers of the frequent words after and before, counts by side, and last tables by side."""
        parts = _parts(data)
        places = [1, 4], [2, 5, 8], range(len(parts) - 4, len(parts) - 1)
        return tuple([_of_bytes(data, *parts[i]).view(np.int64) for i in some] for some in places)

    def trained(self) -> np.ndarray:
        return sum(_summed(self.sides[s].own, self.sides[s].counts, len(self.words)) for s in (AFTER, RARE_AFTER))

    def tell(self, fragment: int, bits: int, offset: int) -> Iterator[tuple]:
        """A row for each fragment with which it shares pairs of rare words: tables of contexts, customers of dishes.

        Both have the pairs, those of one and another fragment in the order of context and dish.
        """
        last, shift = self.seatings[-1], np.uint64(64 - bits)
        after, before = self.sides[RARE_AFTER], self.sides[RARE_BEFORE]
        to = (after.partner >> shift).astype(np.int64)
        out = np.argsort(to, kind="stable")
        back = np.lexsort((before.own, before.partner))
        to, whence = to[out], (before.partner[back] >> shift).astype(np.int64)
        contexts, dishes = last.of_context[after.own[out]], before.own[back]
        for other in np.union1d(to, whence).tolist():
            a, b = (slice(*np.searchsorted(x, (other, other + 1))) for x in (to, whence))
            told = _put([contexts[a], last.customers[dishes[b]]])
            yield RARE, offset + other, COUNTS - 1 - fragment, 0, told, b"", b"", b""

    def told(self, rows: list[dict], bits: int) -> tuple[Rare, np.ndarray]:
        """With the customers of rare dishes, and the tables of the rare contexts before its words."""
        found = [_taken(r["a"]) for r in sorted(rows, key=lambda r: -r["block"])]
        after, before = self.sides[RARE_AFTER], self.sides[RARE_BEFORE]
        out = np.argsort(after.partner >> np.uint64(64 - bits), kind="stable")
        back = np.lexsort((before.own, before.partner))
        contexts, customers = (np.concatenate([np.zeros(0, np.uint64), *(f[i] for f in found)]).astype(np.int64) for i in range(2))
        if len(contexts) != len(back) or len(customers) != len(out):
            raise ValueError(f"told of {len(contexts)} contexts and {len(customers)} dishes, not {len(back)} and {len(out)}")
        of_context, dish_customers = np.zeros_like(contexts), np.zeros_like(customers)
        of_context[back], dish_customers[out] = contexts, customers
        last = replace(self.seatings[-1], dish_customers=dish_customers)
        return replace(self, seatings=[*self.seatings[:-1], last]), of_context

    def _dealt(self, state: State, seating: Seating, before: np.ndarray | None) -> Iterator[tuple]:
        """By side, tables of the contexts, probabilities of the dishes in the parent, and the hashes of both."""
        here = state.shares(seating.customers, self.words)
        after, preceding, rare_after, rare_before = self.sides
        there = state.shares(seating.dish_customers, rare_after.partner)
        number = after.partner.astype(np.int64)
        yield seating.of_context[after.own], state.parent[number], self.words[after.own], state.names[number]
        number = preceding.partner.astype(np.int64)
        yield state.tables[number], here[preceding.own], state.names[number], self.words[preceding.own]
        yield seating.of_context[rare_after.own], there, self.words[rare_after.own], rare_after.partner
        if before is not None:
            yield before, here[rare_before.own], rare_before.partner, self.words[rare_before.own]

    def swept(self, state: State, sweep: int, before: np.ndarray) -> Rare:
        """With the seating of a sweep; that before is left if it is one of those kept."""
        dealt = self._dealt(state, self.seatings[-1], before)
        tables = [state.seated(sweep, side.counts, *known) for side, known in zip(self.sides, dealt)]
        kept = self.seatings if sweep - 1 > SWEEPS - KEPT else self.seatings[:-1]
        return replace(self, seatings=[*kept, Seating.of(self.words, self.sides, tables)])

    def logs(self, states: list[State]) -> list[np.ndarray]:
        """log10 probabilities of the pairs by side, averaged over the sweeps kept."""
        trained, sums = self.trained(), [np.zeros(len(s.counts)) for s in self.sides[:RARE_BEFORE]]
        for state, seating in zip(states, self.seatings, strict=True):
            for i, (side, known) in enumerate(zip(self.sides, self._dealt(state, seating, None))):
                customers = state.trained[side.partner.astype(np.int64)] if i == BEFORE else trained[side.own]
                sums[i] += state.given(side.counts, seating.tables[i], known[0], customers, known[1])
        return [np.log10(s / len(states)) for s in sums]


def _beside(rows: DataFrame, tasks: int, *keys: str) -> DataFrame:
    """Rows of a fragment together: what others tell it, its counts, and then its places."""
    return rows.repartition(tasks, *keys).sortWithinPartitions(*keys, "block")


def _telling(rare: DataFrame, bits: int, offset: int) -> DataFrame:
    """Fragments of rare words, and what they tell each other."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for row in _rows(batches):
            yield tuple(row.values())
            yield from Rare.of(row).tell(row["fragment"] - offset, bits, offset)

    return rare.mapInArrow(lambda batches: _records(work(batches)), PACKED)


def _reseated(told: DataFrame, state: State, sweep: int, bits: int, offset: int) -> DataFrame:
    """Fragments of rare words after a sweep, and what they tell each other then."""
    sent = told.sparkSession.sparkContext.broadcast(state)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        heard = []
        for row in _rows(batches):
            if row["block"] < COUNTS:
                heard.append(row)
                continue
            rare, before = Rare.of(row).told([r for r in heard if r["fragment"] == row["fragment"]], bits)
            heard, rare = [], rare.swept(sent.value, sweep, before)
            yield rare.row(row["fragment"], row["n"])
            yield from rare.tell(row["fragment"] - offset, bits, offset)

    return _beside(told, 1 << bits, "fragment").mapInArrow(lambda batches: _records(work(batches)), PACKED)


def _sweep(pairs: DataFrame, rare: DataFrame, state: State | None, sweep: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Tables of each context and of each dish that have numbers; and how many pairs were not seen, seen once and twice,
    and how many others are dishes of the parent, and their customers."""
    sent = pairs.sparkSession.sparkContext.broadcast(state)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((3, IDS), np.int64)

        def add(what: int, number: np.ndarray, tables: np.ndarray) -> None:
            sums[what] += _summed(number.astype(np.int64), tables, IDS)

        for row in _rows(batches):
            if row["kind"] == RARE:
                partners, counts, tables = Rare.last(row["a"])
                _, customers = Rare.eaters(row["b"])
                add(0, partners[BEFORE], tables[BEFORE])
                add(1, partners[AFTER], tables[AFTER])
                sums[2, 3:5] += np.count_nonzero(customers), customers.sum()
                seen = np.concatenate(counts)
            else:
                context, dish, seen = _model(row["a"], row["b"])
                tables = np.minimum(seen, 1) if sent.value is None else _draw(sent.value, sweep, context, dish, seen)
                add(0, context, tables)
                add(1, dish, tables)
            sums[2, :3] += np.bincount(np.minimum(seen, 3), minlength=4)[:3]
        what, number = np.nonzero(sums)
        yield pa.record_batch([pa.array(what), pa.array(number), pa.array(sums[what, number])], names=["what", "number", "n"])

    rows = pairs.unionByName(rare.where(F.col("block") == COUNTS)).select("kind", "a", "b")
    summed = rows.mapInArrow(work, "what long, number long, n long")
    out = np.zeros((3, IDS), np.int64)
    for row in summed.groupBy("what", "number").agg(F.sum("n").alias("n")).toArrow().to_pylist():  # 2 x 65,535 + 5 rows at most
        out[row["what"], row["number"]] = row["n"]
    return out[0], out[1], out[2, :5]


def _swept_parent(rare: DataFrame, opened: float, uniform: float, discount: float, sweep: int, turn: int) -> int:
    """Tables of the rare words after a sweep of the parent."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = 0
        for row in _rows(batches):
            words, customers = Rare.eaters(row["b"])
            n += int(_seated_parent(customers, words, opened, uniform, discount, sweep, turn).sum())
        yield pa.record_batch([pa.array([n])], names=["n"])

    return rare.where(F.col("block") == COUNTS).select("b").mapInArrow(work, "n long").agg(F.sum("n")).first()[0] or 0


def _state(sums: tuple[np.ndarray, np.ndarray, np.ndarray], rare: DataFrame, vocabulary: Vocabulary, discount: float, sweep: int) -> State:
    """After a sweep of the contexts, the parent's own sweeps begin with one table for each dish."""
    tables, customers, (_, _, _, rare_tables, rare_customers) = sums
    names, known = vocabulary.names(), len(vocabulary.keys)
    # Besides those with a number and the end: rare words, and one for all never seen.
    number = max(vocabulary.types - 1, 0) - known + 1
    uniform = 1 / (known + 1 + number)
    others = Others(number, rare_customers, rare_tables, lambda turn, opened: _swept_parent(rare, opened, uniform, discount, sweep, turn))
    parent = _parent(customers, known, discount, lambda turn: _parent_chance(names, sweep, turn), SWEEPS, others)
    eaters = float(customers.sum() + rare_customers)
    return State(names, vocabulary.counts, tables, parent, eaters, others.opened, others.before, uniform, discount, sweep)


def _beside_counts(counts: DataFrame, places: DataFrame, tasks: int) -> DataFrame:
    """Places behind the counts of their fragment; if those of a fragment are many, in slices, each behind its counts."""
    slices = F.ceil(F.col("n") / SLICE).cast("int")
    many = counts.where(F.col("block") == COUNTS).select("fragment", slices.alias("slices")).where("slices > 1")
    number = F.coalesce("slices", F.lit(1))
    copied = counts.join(F.broadcast(many), "fragment", "left").withColumn("slice", F.explode(F.sequence(F.lit(0), number - 1)))
    dealt = places.join(F.broadcast(many), "fragment", "left").withColumn("slice", F.pmod(F.hash("block"), number))
    return _beside(copied.unionByName(dealt).drop("slices"), tasks, "fragment", "slice").select(*places.columns)


class RareLogs:
    """Log probabilities of the pairs of rare words of a fragment, to be looked up."""

    def __init__(self, rare: Rare, states: list[State]):
        self.words, self.logs = rare.words, rare.logs(states)
        trained = rare.trained()
        self.base, self.seen = np.log10(trained + SMOOTH), trained > 0
        self.dishes = np.unique(rare.sides[RARE_AFTER].partner)
        self.codes = [self.coded(i, s.own, s.partner) for i, s in enumerate(rare.sides[:RARE_BEFORE])]

    def coded(self, side: int, own: np.ndarray, partner: np.ndarray) -> np.ndarray:
        """Pairs as numbers, in their order."""
        return own << 32 | (np.searchsorted(self.dishes, partner) if side == RARE_AFTER else partner.view(np.int64))

    def sums(self, row: dict) -> list[np.ndarray]:
        """The texts of a row of places; by text, base sum, score and how many words were seen."""
        arrays = _taken(row["a"])
        words = np.searchsorted(self.words, np.cumsum(arrays[0], dtype=np.uint64))
        texts = [np.frombuffer(row[c], np.uint16) >> 1 for c in "bcd"]
        n = max(int(t.max()) for t in texts if len(t)) + 1
        met, (base, score, seen) = np.zeros(n, bool), np.zeros((3, n))
        for side, text in enumerate(texts):
            each, partner, counts = arrays[1 + 3 * side : 4 + 3 * side]
            own, counts = np.repeat(words, each.view(np.int64)), counts.view(np.int64)
            at = np.searchsorted(self.codes[side], self.coded(side, own, partner))
            met[text] = True
            score += np.bincount(text, weights=np.repeat(self.logs[side][at], counts), minlength=n)
            if side != BEFORE:  # every place of a word is followed by one dish
                base += np.bincount(text, weights=np.repeat(self.base[own], counts), minlength=n)
                seen += np.bincount(text, weights=np.repeat(self.seen[own], counts), minlength=n)
        found = np.flatnonzero(met)
        return [found, base[found], score[found], seen[found]]


def _text_scores(rows: DataFrame, states: list[tuple[int, State, State]], bits: int) -> DataFrame:
    """Per block and fragment, sums for the texts met there; of pairs, log10 probabilities averaged over the sweeps kept."""
    sent = rows.sparkSession.sparkContext.broadcast(states)

    def pair_logs(row: dict) -> np.ndarray:
        context, dish, counts = _model(row["a"], row["b"])
        mean = np.zeros(len(counts))
        for sweep, before, state in sent.value:
            tables = _draw(before, sweep, context, dish, counts)
            mean += state.given(counts, tables, state.tables[context], state.trained[context], state.parent[dish])
        return np.log10(mean / len(sent.value))

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        fragment = keys = values = rare = None
        heard = []
        for row in _rows(batches):
            kind = row["kind"]
            if kind == DIRECTORY:
                yield tuple(row.values())
            elif row["block"] < COUNTS:
                if row["fragment"] != fragment:
                    heard.append(row)
            elif row["block"] == COUNTS:
                if row["fragment"] == fragment:
                    continue
                fragment = row["fragment"]
                if kind == PAIRS:
                    keys, values = _of_rising(row["a"]), pair_logs(row)
                else:
                    told, _ = Rare.of(row).told([r for r in heard if r["fragment"] == fragment], bits)
                    heard, rare = [], RareLogs(told, [state for _, _, state in sent.value])
            else:
                if row["fragment"] != fragment:
                    raise ValueError(f"no counts before the places of fragment {row['fragment']}")
                if kind == PAIRS:
                    at, text = np.searchsorted(keys, _of_rising(row["a"])), np.frombuffer(row["c"], np.uint16) >> 1
                    met = np.flatnonzero(np.bincount(text))
                    sums = [np.bincount(text, weights=values[np.repeat(at, _of_planes(row["b"]))])[met]]
                else:
                    met, *sums = rare.sums(row)
                told = [s.astype("<f8").tobytes() for s in sums[:2]] + [_put(sums[2:])]
                yield kind, fragment, row["block"], len(met), met.astype("<u2").tobytes(), *told, *[b""] * (3 - len(told))

    return rows.mapInArrow(lambda batches: _records(summed(batches)), PACKED)


def _assembled(table: pa.Table) -> pa.Table:
    """The texts of a block with all their sums."""
    rows = table.to_pylist()
    head = next(r for r in rows if r["kind"] == DIRECTORY)
    ids, size, base, seen = (np.frombuffer(head[c], t) for c, t in zip("abcd", ("<i8", "<i8", "<f8", "<i8")))
    base, seen, score = base.copy(), seen.copy(), np.zeros(len(ids))
    for r in sorted(rows, key=lambda r: (r["kind"], r["fragment"])):  # sums do not depend on the order of arrival
        if r["kind"] == RARE:
            met = np.frombuffer(r["a"], "<u2")
            base[met] += np.frombuffer(r["b"], "<f8")
            score[met] += np.frombuffer(r["c"], "<f8")
            seen[met] += _taken(r["d"])[0].astype(np.int64)
        elif r["kind"] == PAIRS:
            score[np.frombuffer(r["a"], "<u2")] += np.frombuffer(r["b"], "<f8")
    return pa.table({"row": ids, "n_tokens": size, "n_known": seen, "base_sum": base, "score": score})


SCORED = "row long, n_tokens long, n_known long, base_sum double, score double"


def score(docs: DataFrame, train: Column, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, trained, n_tokens, n_known, train_tokens, base_score, score); learns from the rows where `train` holds."""
    texts = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"), F.coalesce(train, F.lit(False)).alias("train"))
    spark = docs.sparkSession
    with _shuffles_freed(spark):
        vocabulary = _vocabulary(texts.where("train"))
        numbered = texts.withColumn("row", F.monotonically_increasing_id())
        directory = staged(numbered.select("row", "doc_id", "train"), "texts")
        tokens = max(vocabulary.tokens, 1)
        frequent = int(vocabulary.counts[:WORDS].sum() + vocabulary.texts)
        pair_bits = max(4, int(frequent * frequent // tokens // FRAGMENT).bit_length())
        rare_bits = max(2, int((tokens - frequent) // RARE_FRAGMENT).bit_length())
        packed = _packed(numbered, vocabulary, rare_bits, pair_bits, places=False)
        stored = staged(packed.groupBy("fragment").applyInArrow(_counted, PACKED), "fragments")
        pairs, rare = (stored.where(F.col("kind") == kind) for kind in (PAIRS, RARE))

        sums = _sweep(pairs, rare, None, 0)
        once, twice = sums[2][1:3].tolist()
        discount = once / (once + 2 * twice) if once and twice else 0.5
        states = [_state(sums, rare, vocabulary, discount, 0)]
        told, path = _telling(rare, rare_bits, 1 << pair_bits), None
        for sweep in range(1, SWEEPS + 1):
            told, done, path = _reseated(told, states[-1], sweep, rare_bits, 1 << pair_bits), path, scratch_path(spark, "sweep")
            told.write.parquet(path)
            told = spark.read.schema(told.schema).parquet(path)
            if done:
                delete_path(spark, done)
            states.append(_state(_sweep(pairs, told, states[-1], sweep), told, vocabulary, discount, sweep))
    kept = [(sweep, states[sweep - 1], states[sweep]) for sweep in range(SWEEPS - KEPT + 1, SWEEPS + 1)]
    places = _packed(numbered, vocabulary, rare_bits, pair_bits, places=True)
    beside = _beside_counts(pairs.unionByName(told), places, (1 << pair_bits) + (1 << rare_bits))
    sums = _text_scores(beside, kept, rare_bits)
    scored = sums.groupBy("block").applyInArrow(_assembled, SCORED)
    whole = float(np.log10(vocabulary.tokens + SMOOTH * (vocabulary.types + 1)))
    out = directory.join(scored, "row")
    return out.select(
        "doc_id", F.col("train").alias("trained"), "n_tokens", "n_known", F.lit(vocabulary.tokens).cast("long").alias("train_tokens"),
        (F.col("base_sum") - F.col("n_tokens") * F.lit(whole)).alias("base_score"), "score",
        F.pow(F.lit(10.0), -F.col("score") / F.col("n_tokens")).alias("perplexity"),
    )
