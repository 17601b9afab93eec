"""Language identification by nearest centroid.

A text is a vector of hashed letter bigrams and trigrams, weighted by TF-IDF and scaled to length one. Each language
has up to `CENTROIDS` centroids, found by spherical k-means; a text gets the language of the nearest by cosine. It is
rejected if it has no letter, or lies further off than `SLACK` times the furthest sample text of that language.

Document frequencies come from all labelled training texts. Centroids are fitted on a sample: texts are taken by a
hash of id and text so that about `SAMPLE` texts of each language are expected, or all if there are fewer. The model
holds CENTROIDS x DIMS numbers per language (128 KB), whatever the number of rows; `MOST_LANGUAGES` bounds it.

Null and empty texts, and texts without a letter, are `und` with score 0 and rejected. Without training rows every
text is `und`. Rows with a null language are never learned from. Repeated rows are predicted alike.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from beaconlake.llm.common import row_key

DIMS = 1 << 13
CENTROIDS = 4
SAMPLE = 1000
SLACK = 0.5
MOST_LANGUAGES = 1000
ROUNDS = 12
ROWS = 128  # texts turned into vectors at a time
SLICE_CHARS = 1 << 20
_LETTER = re.compile(r"[^\W\d_]")
_BLANK = np.uint32(32)
_letters: list[np.ndarray] = []


def _is_letter(codes: np.ndarray) -> np.ndarray:
    if not _letters:
        _letters.append(np.array([chr(i).isalpha() for i in range(1 << 16)]))
    return _letters[0][np.minimum(codes, np.uint32(0xFFFF))] | (codes > 0xFFFF)


def _add_counts(counts: np.ndarray, row: int, text: str) -> None:
    """Add the n-grams of a text to a row of counts, a slice at a time."""
    text = text.lower()
    for at in range(0, len(text), SLICE_CHARS):
        # Slices overlap by two characters, so that no trigram is lost; bigrams of the overlap count there once more.
        codes = np.frombuffer(text[max(at - 2, 0) : at + SLICE_CHARS].encode("utf-32-le", "surrogatepass"), np.uint32)
        letter = _is_letter(codes)
        codes = np.where(letter, codes, _BLANK)
        kept = np.empty(len(codes), bool)
        kept[0] = True
        kept[1:] = letter[1:] | letter[:-1]
        codes = np.concatenate(([_BLANK], codes[kept], [_BLANK])).astype(np.uint32)
        two = codes[:-1] * np.uint32(0x9E3779B1) + codes[1:] * np.uint32(0x85EBCA77)
        three = two[:-1] * np.uint32(0xC2B2AE3D) + codes[2:] * np.uint32(0x27D4EB2F)
        grams = np.concatenate((two, three))
        grams ^= grams >> np.uint32(15)
        grams *= np.uint32(0x2C1B3C6D)
        counts[row] += np.bincount(grams >> np.uint32(32 - 13), minlength=DIMS)


def count_vectors(texts: list[str | None]) -> np.ndarray:
    counts = np.zeros((len(texts), DIMS), np.float32)
    for row, text in enumerate(texts):
        if text and _LETTER.search(text):
            _add_counts(counts, row, text)
    return counts


def weighted(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    x = np.log1p(counts) * idf
    return x / np.maximum(np.sqrt((x * x).sum(1, keepdims=True)), 1e-12)


@dataclass(frozen=True)
class Model:
    languages: tuple[str, ...]  # of each centroid
    centroids: np.ndarray
    furthest: np.ndarray  # least cosine of a sample text of the centroid's language
    idf: np.ndarray


def _idf(training: DataFrame, text_col: str) -> np.ndarray:
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, rows = np.zeros(DIMS, np.int64), 0
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                counts = count_vectors(batch.column(0).slice(at, ROWS).to_pylist())
                seen += (counts > 0).sum(0)
                rows += len(counts)
        if rows:
            yield pa.record_batch([pa.array(np.arange(-1, DIMS)), pa.array(np.concatenate(([rows], seen)))], names=["gram", "n"])

    counted = training.select(text_col).mapInArrow(work, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n")).collect()
    known = {row["gram"]: row["n"] for row in counted}  # DIMS + 1 rows at most
    seen = np.array([known.get(i, 0) for i in range(DIMS)], np.float64)
    return np.log((known.get(-1, 0) + 1) / (seen + 1)).astype(np.float32) + np.float32(1)


def _clusters(x: np.ndarray, k: int) -> np.ndarray:
    """Spherical k-means; the first centre is the mean, the next are the texts furthest from those before."""
    centres = x.mean(0, keepdims=True)
    centres /= max(np.sqrt((centres**2).sum()), 1e-12)
    while len(centres) < min(k, len(x)):
        centres = np.vstack((centres, x[(x @ centres.T).max(1).argmin()][None]))
    for _ in range(ROUNDS):
        nearest = (x @ centres.T).argmax(1)
        sums = np.array([x[nearest == j].sum(0) if (nearest == j).any() else centres[j] for j in range(len(centres))])
        centres = sums / np.maximum(np.sqrt((sums**2).sum(1, keepdims=True)), 1e-12)
    return centres.astype(np.float32)


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> Model:
    """Learn from the rows given whose language is not null."""
    training = docs.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull())
    idf = _idf(training, text_col)
    sizes = training.groupBy(F.col(lang_col).alias("lang")).count().limit(MOST_LANGUAGES + 1).collect()
    if len(sizes) > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} languages")
    if not sizes:
        return Model((), np.zeros((0, DIMS), np.float32), np.zeros(0, np.float32), idf)
    share = F.create_map(*[F.lit(v) for row in sizes for v in (row["lang"], min(1.0, SAMPLE / row["count"]))])
    key = row_key(F.col(id_col), F.col(text_col))
    draw = F.conv(F.substring(key, 1, 7), 16, 10).cast("double") / float(1 << 28)
    sample = training.where(draw < F.element_at(share, F.col(lang_col))).select(
        F.col(lang_col).alias("lang"), F.col(text_col).alias("text"), key.alias("key")
    )

    def work(table: pa.Table) -> pa.Table:
        rows = sorted(zip(table["key"].to_pylist(), table["text"].to_pylist()))
        x = np.vstack([weighted(count_vectors([t for _, t in rows[at : at + ROWS]]), idf) for at in range(0, len(rows), ROWS)])
        x = x[x.any(1)]
        if not len(x):
            return pa.table({"lang": pa.array([], pa.string()), "centres": pa.array([], pa.binary()), "furthest": pa.array([], pa.float64())})
        centres = _clusters(x, CENTROIDS)
        least = float((x @ centres.T).max(1).min())
        return pa.table({"lang": [table["lang"][0].as_py()], "centres": [centres.tobytes()], "furthest": [least]})

    schema = "lang string, centres binary, furthest double"
    found = sorted(sample.groupBy("lang").applyInArrow(work, schema).collect(), key=lambda row: row["lang"])
    centres = [np.frombuffer(row["centres"], np.float32).reshape(-1, DIMS) for row in found]
    return Model(
        tuple(row["lang"] for row, c in zip(found, centres) for _ in c),
        np.vstack(centres) if centres else np.zeros((0, DIMS), np.float32),
        np.array([row["furthest"] for row, c in zip(found, centres) for _ in c], np.float32), idf,
    )


PREDICTED = T.StructType(
    [T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()), T.StructField("rejected", T.BooleanType())]
)


def predict(model: Model, texts: list[str | None]) -> list[dict]:
    x = weighted(count_vectors(texts), model.idf)
    known = x.any(1) if len(model.languages) else np.zeros(len(texts), bool)
    out = [{"lang_pred": "und", "score": 0.0, "rejected": True} for _ in texts]
    if known.any():
        cosine = x @ model.centroids.T
        nearest = cosine.argmax(1)
        for i in np.flatnonzero(known):
            j = nearest[i]
            score = float(min(max(cosine[i, j], 0.0), 1.0))
            out[i] = {"lang_pred": model.languages[j], "score": score, "rejected": bool(score < SLACK * model.furthest[j])}
    return out


def identify(docs: DataFrame, model: Model, text_col: str = "text", out: str = "language") -> DataFrame:
    """All columns, and a struct `out` of lang_pred, score and rejected."""
    held = docs.sparkSession.sparkContext.broadcast(model)
    arrow = pa.struct([("lang_pred", pa.string()), ("score", pa.float64()), ("rejected", pa.bool_())])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, found = batch.column(batch.schema.get_field_index(text_col)), []
            for at in range(0, batch.num_rows, ROWS):
                found += predict(held.value, texts.slice(at, ROWS).to_pylist())
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, arrow)], names=[*batch.schema.names, out])

    return docs.mapInArrow(work, T.StructType([*docs.schema.fields, T.StructField(out, PREDICTED)]))
