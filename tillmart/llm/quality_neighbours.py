"""Quality classifier (operator 8): nearest labelled neighbours in a latent space.

A text's features are counts of character-class trigrams (its typography), of hashed words
(its content) and of how far its words and lines repeat. Weighted by inverse document
frequency, they are projected on the leading singular directions of a labelled sample
(latent semantic analysis). The sample's vectors, at most `SAMPLE` x `RANK` floats, go to
every task; each document is compared with all of them by exact cosine products, in
blocks of `BLOCK` documents, and the `NEIGHBOURS` nearest vote with a power of their similarity.

The sample holds the labelled documents with the smallest hash of their id, outside the
held-out fold. Frequencies, directions and vectors come from it alone.

Defined results: a null or empty text has no features and gets the share of good labels
in the sample, as every text does when no label is there (then 0); repeated rows are
scored alike; null ids are scored but never learned from. Other columns are never read.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillmart.llm.common import text_bytes, word_hashes, written
from tillmart.llm.toxicity import labelled_sample

SAMPLE = 4_000
RANK = 48
NEIGHBOURS = 15
BLOCK = 256
FOLDS, HELD_OUT = 4, 2
THRESHOLD = 0.7

TRIGRAMS, WORDS, BINS = 4096, 2048, 8
REPEATS = 5
SIZE = TRIGRAMS + WORDS + REPEATS * BINS
_PARTS = ((0, TRIGRAMS, 1.0), (TRIGRAMS, TRIGRAMS + WORDS, 0.4), (TRIGRAMS + WORDS, SIZE, 1.0))


def _classes() -> np.ndarray:
    """One of 16 classes for each byte value."""
    kinds = np.full(256, 13)
    kinds[:32] = kinds[127] = 15
    kinds[128:] = 14
    groups = {
        "abcdefghijklmnopqrstuvwxyz": 1, "aeiou": 0, "ABCDEFGHIJKLMNOPQRSTUVWXYZ": 2,
        "0123456789": 3, " \t": 4, "\n": 5, ".": 6, ",": 7, "!": 8, "|": 9, "#*$%&": 10, "\"'`": 11, "<>": 12,
    }
    for chars, kind in groups.items():
        kinds[[ord(c) for c in chars]] = kind
    return kinds.astype(np.int32)


_CLASS = _classes()


@dataclass
class Model:
    prior: float
    idf: np.ndarray | None = None
    directions: np.ndarray | None = None
    vectors: np.ndarray | None = None
    labels: np.ndarray | None = None


def plain(model: Model) -> tuple:
    """The model's parts; executors would need the package to read a broadcast `Model`."""
    return model.prior, model.idf, model.directions, model.vectors, model.labels


def train(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label: str = "quality",
    held_out: tuple[int, int] = (FOLDS, HELD_OUT),
    most: int = SAMPLE,
    rank: int = RANK,
) -> Model:
    sample = written(
        labelled_sample(docs, labels, label, held_out, most, id_col, text_col), "quality-sample"
    )
    rows = sample.mapInArrow(_sparse_features, "label int, at array<int>, value array<float>").collect()
    if not rows:
        return Model(0.0)
    rows.sort(key=lambda r: (r["label"], r["at"], r["value"]))
    y = np.array([r["label"] for r in rows], dtype=np.float32)
    x = np.zeros((len(rows), SIZE), dtype=np.float32)
    for i, row in enumerate(rows):
        x[i, row["at"]] = row["value"]
    idf = np.log((1 + len(x)) / (1 + (x > 0).sum(axis=0))).astype(np.float32) + np.float32(0.1)
    idf[TRIGRAMS + WORDS :] = 1
    x = weighted(x, idf)
    directions = _leading_directions(x, min(rank, len(x)))
    return Model(float(y.mean()), idf, directions, _unit(x @ directions), y)


def score(
    docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """id and score (0 to 1, higher is better) per row."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(plain(model))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Model(*shared.value)
        for batch in batches:
            scores = []
            for at in range(0, batch.num_rows, BLOCK):
                texts = text_bytes(batch.column("text").slice(at, BLOCK))
                scores.append(vote(model, np.array([features(t) for t in texts])))
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(np.concatenate(scores) if scores else np.empty(0))],
                names=["id", "score"],
            )

    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(run, f"id {kind}, score double").withColumnRenamed("id", id_col)


def keep_good(
    docs: DataFrame,
    labels: DataFrame,
    threshold: float = THRESHOLD,
    text_col: str = "text",
    learn_from: DataFrame | None = None,
) -> DataFrame:
    """Rows whose text scores at least `threshold`, with all their columns, by a scan alone.

    The model learns from `learn_from`, by default `docs` themselves.
    """
    model = train(docs if learn_from is None else learn_from, labels, text_col=text_col)
    shared = docs.sparkSession.sparkContext.broadcast(plain(model))
    rows = docs.select(F.struct("*").alias("row"))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Model(*shared.value)
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK):
                part = batch.column("row").slice(at, BLOCK)
                texts = text_bytes(part.field(text_col))
                scores = vote(model, np.array([features(t) for t in texts]))
                good = part.filter(pa.array(scores >= threshold))
                yield pa.RecordBatch.from_arrays([good], names=["row"])

    return rows.mapInArrow(run, rows.schema).select("row.*")


def vote(model: Model, x: np.ndarray, neighbours: int = NEIGHBOURS) -> np.ndarray:
    """Share of good labels among the nearest sample vectors, weighted by similarity."""
    if model.vectors is None:
        return np.full(len(x), model.prior)
    cosines = _unit(weighted(x, model.idf) @ model.directions) @ model.vectors.T
    k = min(neighbours, cosines.shape[1])
    nearest = np.argpartition(-cosines, k - 1, axis=1)[:, :k]
    near = np.maximum(np.take_along_axis(cosines, nearest, axis=1), 0).astype(np.float64) ** 8
    good = (near * model.labels[nearest]).sum(axis=1)
    # A weight of 0.05 for the prior settles texts without features.
    return np.clip((good + 0.05 * model.prior) / (near.sum(axis=1) + 0.05), 0.0, 1.0)


def features(text: bytes | None) -> np.ndarray:
    out = np.zeros(SIZE, dtype=np.float32)
    if not text:
        return out
    kinds = _CLASS[np.frombuffer(text, dtype=np.uint8)]
    if len(kinds) > 2:
        out[:TRIGRAMS] = np.log1p(
            np.bincount(kinds[:-2] * 256 + kinds[1:-1] * 16 + kinds[2:], minlength=TRIGRAMS)
        )
    words = word_hashes(text)
    if not len(words):
        return out
    counts = np.bincount((words % np.uint64(WORDS)).astype(np.int64), minlength=WORDS)
    out[TRIGRAMS : TRIGRAMS + WORDS] = np.log1p(counts)
    lines = [line for line in text.split(b"\n") if line.strip()]
    _, times = np.unique(words, return_counts=True)
    measures = (
        1 - len(times) / len(words),
        times.max() / len(words),
        float((words[1:] == words[:-1]).mean()) if len(words) > 1 else 0.0,
        1 - len(set(lines)) / max(len(lines), 1),
        min(len(text) / len(words) / 20, 1.0),
    )
    for i, measure in enumerate(measures):
        place = measure * (BINS - 1)
        low = min(int(place), BINS - 2)
        start = TRIGRAMS + WORDS + i * BINS + low
        out[start] += 1 - (place - low)
        out[start + 1] += place - low
    return out


def weighted(x: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """Features times their weights, each part scaled to its share of the length."""
    x = x * idf
    for begin, end, share in _PARTS:
        part = x[:, begin:end]
        size = np.linalg.norm(part, axis=1, keepdims=True)
        part *= share / np.where(size > 0, size, 1)
    return x


def _unit(x: np.ndarray) -> np.ndarray:
    size = np.linalg.norm(x, axis=1, keepdims=True)
    return x / np.where(size > 0, size, 1)


def _leading_directions(x: np.ndarray, rank: int, rounds: int = 4) -> np.ndarray:
    """Leading right singular vectors by subspace iteration from a seeded start."""
    rng = np.random.Generator(np.random.PCG64(8))
    basis = rng.standard_normal((x.shape[1], min(rank + 16, *x.shape)), dtype=np.float32)
    for _ in range(rounds):
        basis = np.linalg.qr(x.T @ (x @ basis))[0]
    small = x @ basis
    _, _, right = np.linalg.svd(small, full_matrices=False)
    return np.ascontiguousarray((basis @ right.T)[:, :rank], dtype=np.float32)


def _sparse_features(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = [features(t) for t in text_bytes(batch.column("text"))]
        places = [np.flatnonzero(r).astype(np.int32) for r in rows]
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("label"),
                pa.array(places, pa.list_(pa.int32())),
                pa.array([r[p] for r, p in zip(rows, places, strict=True)], pa.list_(pa.float32())),
            ],
            names=["label", "at", "value"],
        )
