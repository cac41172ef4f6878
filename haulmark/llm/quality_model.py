"""A quality classifier that lets the nearest labelled texts vote in a latent semantic space.

Terms are hashed words and word shapes, weighted by tf-idf. A truncated singular value decomposition of a bounded sample of
labelled texts gives the latent space; the labelled vectors, of bounded number and size, are broadcast. Every document is
then projected and compared with all of them by exact cosine products in blocks; the nearest vote with their labels,
weighted by similarity and by how many labelled texts of its class each one of the sample stands for.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import islice
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from haulmark.llm.common import ship, table

#: Buckets of hashed words and of hashed word shapes, and terms of the text's texture: words that repeat the one before, and
#: lines that repeat an earlier one, as far as they make up the text. Texture weighs so many times the mentions of a word.
WORDS, SHAPES, TEXTURE = 3584, 510, 2
TERMS = WORDS + SHAPES + TEXTURE
TEXTURE_WEIGHT = 4.0
RANK = 48
NEIGHBOURS = 25
#: Labelled texts per class that the model learns from at most.
PER_CLASS = 1536
BLOCK = 256
REMEMBERED = 100_000

#: Capitals, small letters (and all beyond ASCII), digits; other bytes stand for themselves.
_SHAPE = bytes(65 if 65 <= b < 91 else 97 if 97 <= b < 123 or b >= 128 else 48 if 48 <= b < 58 else b for b in range(256))
_known: dict[bytes, tuple[int, int]] = {}


@dataclass
class Model:
    idf: np.ndarray
    axes: np.ndarray
    vectors: np.ndarray
    labels: np.ndarray
    weights: np.ndarray


def _terms(word: bytes) -> tuple[int, int]:
    if len(_known) >= REMEMBERED:
        _known.clear()
    shape = word.translate(_SHAPE)
    runs = bytes(b for i, b in enumerate(shape[:64]) if i == 0 or b != shape[i - 1])
    out = _known[word] = (zlib.crc32(word.lower()) % WORDS, WORDS + zlib.crc32(runs) % SHAPES)
    return out


def term_counts(text: str | None) -> np.ndarray:
    """log(1 + count) of each term of the whole text."""
    raw = text.encode() if text else b""
    words = raw.split()
    if not words:
        return np.zeros(TERMS, np.float32)
    found = Counter(words)
    lines = [x for x in raw.split(b"\n") if x]
    get = _known.get
    ids = np.array([get(w) or _terms(w) for w in found], np.int64)
    n = np.fromiter(found.values(), np.float64, len(found))
    out = np.log1p(np.bincount(ids.ravel(), np.repeat(n, 2), TERMS))
    again = np.array([sum(map(eq, words, islice(words, 1, None))), len(lines) - len(set(lines))])
    out[-TEXTURE:] = TEXTURE_WEIGHT * np.log1p(again) * again / (len(words), max(1, len(lines)))
    return out.astype(np.float32)


def _unit(rows: np.ndarray) -> np.ndarray:
    return rows / np.maximum(np.sqrt((rows * rows).sum(axis=1, keepdims=True)), 1e-12)


def fit(counts: np.ndarray, labels: np.ndarray, weights: np.ndarray, rank: int = RANK, seed: int = 11) -> Model:
    """Randomised truncated decomposition of the weighted term matrix."""
    idf = np.log((1 + len(counts)) / (1 + (counts > 0).sum(axis=0))).astype(np.float32) + 1
    x = _unit(counts * idf)
    rng = np.random.default_rng(seed)
    base = np.linalg.qr(x @ rng.standard_normal((TERMS, rank + 8)).astype(np.float32))[0]
    for _ in range(2):
        base = np.linalg.qr(x @ (x.T @ base))[0]
    axes = np.linalg.svd(base.T @ x, full_matrices=False)[2][:rank].T.astype(np.float32)
    return Model(idf, axes, _unit(x @ axes), labels.astype(np.float32), weights.astype(np.float32))


def score(model: Model, counts: np.ndarray, neighbours: int = NEIGHBOURS) -> np.ndarray:
    """Share of label 1 among the nearest labelled vectors; a text without words scores 0."""
    near = _unit(_unit(counts * model.idf) @ model.axes) @ model.vectors.T
    k = min(neighbours, near.shape[1])
    top = np.argpartition(-near, k - 1, axis=1)[:, :k]
    w = np.maximum(np.take_along_axis(near, top, 1), 1e-6) ** 2 * model.weights[top]
    out = (w * model.labels[top]).sum(axis=1) / w.sum(axis=1)
    return np.where(counts.any(axis=1), np.clip(out, 0, 1), 0.0).astype(np.float64)


def held_out(id_col: Column) -> Column:
    return F.coalesce(F.pmod(F.crc32(id_col.cast("string").cast("binary")), F.lit(3)) == 1, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", per_class: int = PER_CLASS) -> Model | None:
    """Learn from labelled rows outside the held-out third; none when there are none.

    At most ``per_class`` ids of each class, the first by a hash, are learned from; an id whose labels differ is left out,
    and of an id with several texts the smallest. What reaches the driver is bounded by that sample.
    """
    spark = docs.sparkSession
    ship(spark)
    sound = table(labels.filter(F.col("doc_id").isNotNull() & F.col(label).isin(0, 1) & ~held_out(F.col("doc_id")))
                  .groupBy("doc_id").agg(F.min(label).cast("int").alias("y"), F.max(label).cast("int").alias("y2"))
                  .filter(F.col("y") == F.col("y2")).select("doc_id", "y"), "labels")
    totals = {r["y"]: r["n"] for r in sound.groupBy("y").agg(F.count("*").alias("n")).collect()}
    if not totals:
        return None
    sample = None
    for y, n in totals.items():
        first = sound.filter(F.col("y") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_class)
        first = first.withColumn("w", F.lit(n / min(n, per_class)))
        sample = first if sample is None else sample.unionByName(first)
    texts = (docs.select("doc_id", "text").join(F.broadcast(table(sample, "sample")), "doc_id")
             .groupBy("doc_id", "y", "w").agg(F.min("text").alias("text")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, values = [], []
            for text in batch.column("text"):
                x = term_counts(text.as_py())
                ids.append(np.flatnonzero(x).astype(np.int32))
                values.append(x[ids[-1]])
            yield pa.RecordBatch.from_arrays([batch.column(c) for c in ("doc_id", "y", "w")] + [pa.array(ids, pa.list_(pa.int32())), pa.array(values, pa.list_(pa.float32()))],
                                             ["doc_id", "y", "w", "ids", "counts"])

    found = texts.mapInArrow(run, "doc_id long, y int, w double, ids array<int>, counts array<float>").toArrow().sort_by("doc_id")
    if found.num_rows == 0:
        return None
    counts = np.zeros((found.num_rows, TERMS), np.float32)
    for row, i, c in zip(counts, found["ids"], found["counts"]):
        row[i.values.to_numpy()] = c.values.to_numpy()
    return fit(counts, found["y"].to_numpy(), found["w"].to_numpy())


def scored(docs: DataFrame, model: Model | None, text: str = "text", out: str = "score") -> DataFrame:
    """``docs`` with a score of every whole text; 0.5 for all when there is no model."""
    if model is None:
        return docs.withColumn(out, F.lit(0.5))
    spark = docs.sparkSession
    ship(spark)
    shared = spark.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK):
                part = batch.slice(at, BLOCK)
                counts = np.stack([term_counts(t.as_py()) for t in part.column(text)])
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(score(known, counts), pa.float64())], [*part.schema.names, out])

    return docs.mapInArrow(run, StructType([*docs.schema.fields, StructField(out, DoubleType())]))


def report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score and predicted per row of ``docs`` (doc_id, text).

    Null and empty texts score 0; repeated rows get equal scores; a null doc_id is never held out; other columns are
    ignored; without labels all score 0.5.
    """
    found = scored(docs.select("doc_id", "text"), train(docs, labels))
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Rows of ``docs`` whose text scores 0.5 or more, all columns as they are."""
    model = train(docs, labels)
    row = docs.select(F.struct("*").alias("row"), F.col("text").alias("text"))
    return scored(row, model).filter(F.col("score") >= 0.5).select("row.*")
