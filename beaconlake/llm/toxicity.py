"""Toxicity by compression distance.

A text is cut into windows of about `WINDOW` bytes at blanks. Each window is compressed twice, with a zstandard
dictionary trained on toxic text and with one trained on ordinary text; the difference of the two lengths is its
evidence, in bytes up to `MOST`. How often windows of ordinary and of toxic texts reach each threshold is measured on
texts the dictionaries have not seen. A text's counts are compared with what the ordinary rates let expect, its
differences are weighed by how much likelier they are in toxic texts, and a logistic curve fitted on the same unseen
texts turns both into a probability.

Most windows of a toxic text are ordinary, so the toxic dictionary is trained in `STAGES` on selected windows. Within
a stage, windows are dealt into folds; one stays selected while a dictionary of the other folds' selected windows
shortens it by more than it does nearly all ordinary windows. The next stage learns from the toxic texts in which the
stages so far find too little. Both dictionaries end with the same content, trained on ordinary text, and each begins
with as much of its own class, so that lengths differ only where a class has something of its own.

Learning takes `SAMPLE` labelled texts of each class at most, those with the smallest digests of their ids, and
`SAMPLE_BYTES` of them in all; a quarter is kept for calibration. Scores use the text alone.

    model = fit(docs, labels)                    # labels: doc_id, toxic
    scored = score(docs, model)                  # all columns, and the struct `toxicity`

Null and empty texts are one empty window. An id without a label, a null label, or a label without a text teaches
nothing; a document with several labels counts once for each. With labels of one class only, or none, every text
scores the share of toxic labels. Repeated rows score alike. No rows give no rows.
"""

from __future__ import annotations

import hashlib
import pickle
import re
import struct
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from beaconlake.session import staged

WINDOW = 32
MOST = 8  # bytes of difference told apart
SAMPLE = 2000
SAMPLE_BYTES = 16 << 20
STAGES, ROUNDS, FOLDS = 4, 3, 4
COMMON_BYTES, STAGE_BYTES = 1 << 16, 1 << 10
QUANTILE = 0.995  # of ordinary windows, that a toxic one has to exceed
FOUND, FOUND_LEAST = 4, 0.01  # a text is found at this many times the ordinary rate, and this share of windows
LEVEL = 9
SHARE = 0.7  # from here on a text is predicted toxic
SLICE = 1 << 14  # windows compressed before their lengths are summed up
_OTHER = re.compile(rb"[^a-z\x80-\xff]+")
# The content of a dictionary follows its three starting offsets.
_OFFSETS = struct.pack("<3I", 1, 4, 8)


def windows(text: str | None) -> Iterator[bytes]:
    """Windows of the lower-cased letters of a text, cut at the first blank from `WINDOW` bytes on, or at twice that."""
    data = _OTHER.sub(b" ", (text or "").lower().encode("utf-8", "replace")).strip()
    if not data:
        yield b""
    at = 0
    while at < len(data):
        end = data.find(b" ", at + WINDOW, at + 2 * WINDOW)
        if end < 0:
            end = len(data) if len(data) <= at + WINDOW else min(at + 2 * WINDOW, len(data))
        yield data[at:end]
        at = end


def _trained(size: int, samples: list[bytes], k: int, d: int) -> bytes:
    """Dictionary content of `size` bytes at most; the samples' last bytes if they are too few to train on."""
    try:
        made = zstandard.train_dictionary(size, samples, k=k, d=d, level=LEVEL).as_bytes()
    except zstandard.ZstdError:
        return b" ".join(samples)[-size:]
    at = made.find(_OFFSETS)
    return made[at + len(_OFFSETS) :] if at >= 0 else made


class Lengths:
    """Compressed lengths of windows under a dictionary."""

    def __init__(self, content: bytes):
        content = content.rjust(64)
        held = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        settings = zstandard.ZstdCompressionParameters.from_level(
            LEVEL, source_size=WINDOW, dict_size=len(content), write_content_size=False, write_checksum=False,
            write_dict_id=False, format=zstandard.FORMAT_ZSTD1_MAGICLESS,
        )
        held.precompute_compress(compression_params=settings)
        self._compress = zstandard.ZstdCompressor(dict_data=held, compression_params=settings).compress

    def __call__(self, of: Iterable[bytes]) -> np.ndarray:
        compress = self._compress
        return np.fromiter((len(compress(w)) for w in of), np.int32)


@dataclass(frozen=True)
class Model:
    ordinary: bytes
    toxic: bytes
    rates: tuple[float, ...]  # share of ordinary windows at each threshold from 1 to MOST
    likelihood: tuple[float, ...]  # how much likelier each difference is in a toxic text, as a logarithm
    weights: tuple[float, ...]  # of the features, and a constant


def evidence(ordinary: Lengths, toxic: Lengths, text: str | None) -> np.ndarray:
    """Windows of a text by their difference: none or less, 1, ... up to `MOST` bytes."""
    counts, part = np.zeros(MOST + 1, np.int64), []

    def add() -> None:
        nonlocal counts
        counts = counts + np.bincount(np.clip(ordinary(part) - toxic(part), 0, MOST), minlength=MOST + 1)
        part.clear()

    for window in windows(text):
        part.append(window)
        if len(part) == SLICE:
            add()
    if part:
        add()
    return counts


def _reaching(counts: np.ndarray) -> np.ndarray:
    """Windows that reach each threshold from 1 on."""
    return np.cumsum(counts[..., ::-1], -1)[..., ::-1][..., 1:]


def _features(counts: np.ndarray, rates: Sequence[float], likelihood: Sequence[float]) -> np.ndarray:
    n, p = counts.sum(1, keepdims=True), np.asarray(rates)
    told = (counts @ np.asarray(likelihood))[:, None]
    above = np.arcsinh((_reaching(counts) - n * p) / np.sqrt(n * p + 0.1))
    return np.hstack((np.arcsinh(told), told / np.sqrt(n), above, np.ones_like(n, float)))


def probability(model: Model, counts: np.ndarray) -> np.ndarray:
    found = _features(counts, model.rates, model.likelihood) @ np.asarray(model.weights)
    return 1 / (1 + np.exp(-np.clip(found, -30, 30)))


def _logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Weighted logistic regression with a small ridge, by Newton steps."""
    w = np.zeros(x.shape[1])
    ridge = np.diag([0.5] * (x.shape[1] - 1) + [1e-3])
    for _ in range(40):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (weight * p * (1 - p) + 1e-9)[:, None]).T @ x + ridge, x.T @ (weight * (y - p)) - ridge @ w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return w


def _toxic_content(texts: list[list[bytes]], ordinary: Lengths, common: bytes, unseen: list[bytes]) -> bytes:
    """What toxic texts have of their own, found in stages."""
    pool = sorted({w for ws in texts for w in ws})
    place = {w: i for i, w in enumerate(pool)}
    members = [np.array([place[w] for w in ws], np.int64) for ws in texts]
    fold = np.array([hashlib.md5(w).digest()[0] % FOLDS for w in pool], np.int64)
    plain, plain_unseen = ordinary(pool), ordinary(unseen)
    content, missed = b"", list(range(len(texts)))
    for _ in range(STAGES):
        at = np.unique(np.concatenate([members[i] for i in missed])) if missed else np.zeros(0, np.int64)
        chosen = at
        for _ in range(ROUNDS):
            kept = []
            for f in range(FOLDS):
                others = [pool[i] for i in chosen[fold[chosen] != f]]
                lengths = Lengths(_trained(STAGE_BYTES, others, 10, 8) + common)
                bar = max(np.quantile(plain_unseen - lengths(unseen), QUANTILE), 0) if unseen else 0
                mine = at[fold[at] == f]
                kept.append(mine[plain[mine] - lengths(pool[i] for i in mine) > bar])
            chosen = np.sort(np.concatenate(kept))
            if not len(chosen):
                return content
        content = _trained(STAGE_BYTES, [pool[i] for i in chosen], 10, 8) + content
        lengths = Lengths(content + common)
        bar = max(FOUND * float(((plain_unseen - lengths(unseen)) >= 2).mean()) if unseen else 0.0, FOUND_LEAST)
        hit = plain - lengths(pool) >= 2
        missed = [i for i, m in enumerate(members) if hit[m].mean() < bar]
    return content


def learn(texts: list[str], toxic: list[bool], spare: list[bool], share: float) -> Model:
    """A model from texts, their labels, which of them are for calibration, and the share of toxic texts among all."""
    share = min(max(share, 1e-4), 1 - 1e-4)
    flat = Model(b"", b"", (0.01,) * MOST, (0.0,) * (MOST + 1), (*[0.0] * (MOST + 2), float(np.log(share / (1 - share)))))
    if len(set(toxic)) < 2:
        return flat
    if any(len({t for t, s in zip(toxic, spare) if s == side}) < 2 for side in (True, False)):
        spare = [i % 2 == 0 for i in range(len(texts))]
    cut = [sorted(set(windows(t))) for t in texts]
    bad = [ws for ws, t, s in zip(cut, toxic, spare) if t and not s]
    known = {w for ws in bad for w in ws}
    good = sorted({w for ws, t, s in zip(cut, toxic, spare) if not t and not s for w in ws} - known, key=lambda w: hashlib.md5(w).digest())
    if not bad or not good:
        return flat
    third = len(good) // 3
    common = _trained(COMMON_BYTES, good[:third], 32, 6)
    plain = _trained(STAGES * STAGE_BYTES, good[third : 2 * third], 32, 6) + common
    ordinary = Lengths(plain)
    found = _toxic_content(bad, ordinary, common, good[2 * third :][:20000]) + common
    lengths = Lengths(found)
    # Calibration on texts that neither dictionary has seen.
    counts = np.array([evidence(ordinary, lengths, t) for t, s in zip(texts, spare) if s])
    y = np.array([float(t) for t, s in zip(toxic, spare) if s])
    if not len(y):
        return flat
    clean, bad_windows = counts[y == 0].sum(0), counts[y == 1].sum(0)
    rates = (_reaching(clean) + 0.5) / (clean.sum() + 1)
    likelihood = np.log((bad_windows + 0.5) / (bad_windows.sum() + 0.5 * (MOST + 1)))
    likelihood -= np.log((clean + 0.5) / (clean.sum() + 0.5 * (MOST + 1)))
    weight = np.where(y == 1, share * len(y) / max(y.sum(), 1), (1 - share) * len(y) / max((1 - y).sum(), 1))
    weights = _logistic(_features(counts, rates, likelihood), y, weight)
    return Model(plain, found, *(tuple(map(float, x)) for x in (rates, likelihood, weights)))


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> Model:
    """Learn from labelled documents; `labels` has the ids and their 0 or 1. The model is some 140 KB."""
    known = labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("toxic")).where("id IS NOT NULL AND toxic IN (0, 1)")
    sizes = {r["toxic"]: r["count"] for r in known.groupBy("toxic").count().collect()}  # two rows
    draw = F.md5(F.col("id").cast("string").cast("binary"))
    parts = [known.where(F.col("toxic") == c).withColumn("draw", draw).orderBy("draw", "id").limit(SAMPLE) for c in (0, 1)]
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).where(F.col("text").isNotNull())
    sample = staged(texts.join(parts[0].unionAll(parts[1]), "id"), "toxicity-sample")
    # Ids may repeat in documents, so rows are bounded once more.
    thin = sample.select("draw", "id", F.octet_length("text").alias("bytes")).orderBy("draw", "id", "bytes").limit(2 * SAMPLE).collect()
    total, last = 0, ""
    for row in thin:
        total += row["bytes"]
        if total > SAMPLE_BYTES:
            break
        last = row["draw"]
    share = sizes.get(1, 0) / max(sum(sizes.values()), 1)

    def work(table: pa.Table) -> pa.Table:
        rows = sorted(zip(table["draw"].to_pylist(), table["text"].to_pylist(), table["toxic"].to_pylist()))
        model = learn([r[1] for r in rows], [r[2] == 1 for r in rows], [int(r[0][:4], 16) % 4 == 0 for r in rows], share)
        return pa.table({"model": [pickle.dumps(model)]})

    bounded = sample.where((F.col("draw") <= last) & (F.octet_length("text") <= SAMPLE_BYTES)).limit(2 * SAMPLE)
    found = bounded.select("draw", "text", "toxic").groupBy(F.lit("all").alias("group")).applyInArrow(work, "model binary").collect()
    return pickle.loads(found[0]["model"]) if found else learn([], [], [], share)


SCORED = T.StructType(
    [T.StructField("n_windows", T.LongType()), T.StructField("n_toxic", T.LongType()), T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())]
)


def score(docs: DataFrame, model: Model, text_col: str = "text", out: str = "toxicity") -> DataFrame:
    """All columns, and a struct `out`: windows, those of two bytes gain or more, the probability, and 1 from `SHARE` on."""
    held = docs.sparkSession.sparkContext.broadcast(model)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ordinary, toxic = Lengths(held.value.ordinary), Lengths(held.value.toxic)
        for batch in batches:
            if not batch.num_rows:
                continue
            texts = batch.column(batch.schema.get_field_index(text_col))
            counts = np.array([evidence(ordinary, toxic, t.as_py()) for t in texts])
            p = probability(held.value, counts)
            found = pa.StructArray.from_arrays(
                [pa.array(counts.sum(1)), pa.array(counts[:, 2:].sum(1)), pa.array(p), pa.array((p >= SHARE).astype(np.int32))],
                names=["n_windows", "n_toxic", "score", "predicted"],
            )
            yield pa.RecordBatch.from_arrays([*batch.columns, found], names=[*batch.schema.names, out])

    return docs.mapInArrow(work, T.StructType([*docs.schema.fields, T.StructField(out, SCORED)]))
