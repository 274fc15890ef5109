"""What the two classifiers share: folds, labelled samples, calibration and scoring."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martline.llm.common import byte_texts


#: Different texts of one labelled id that a fit sees at most.
TEXTS_PER_ID = 4


def logistic_curve(margin: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and offset of the logistic curve that maps margins to P(label 1)."""
    good, bad = (y > 0).sum(), (y <= 0).sum()
    want = np.where(y > 0, (good + 1) / (good + 2), 1 / (bad + 2))
    a, b = 1.0, 0.0
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a * margin + b, -30, 30)))
        s = np.maximum(p * (1 - p), 1e-9)
        grad = np.array([((p - want) * margin).sum() + 1e-3 * a, (p - want).sum()])
        hess = np.array([[(s * margin * margin).sum() + 1e-3, (s * margin).sum()],
                         [(s * margin).sum(), s.sum() + 1e-6]])
        step = np.linalg.solve(hess, grad)
        a, b = a - step[0], b - step[1]
        if np.abs(step).max() < 1e-8:
            break
    return float(max(a, 1e-6)), float(b)


def cell_counts(rows: list[np.ndarray], cells: int) -> np.ndarray:
    """How many rows have each cell."""
    out = np.zeros(cells)
    for at in range(0, len(rows), 1000):
        out += np.bincount(np.concatenate(rows[at:at + 1000]), minlength=cells)
    return out


def probabilities(model: np.ndarray, rows: Iterator[np.ndarray]) -> np.ndarray:
    """P(label 1) of rows of cells; a model is weights, bias, curve slope and curve offset."""
    bias, a, b = model[-3:]
    margin = np.array([model[r].sum() for r in rows]) + bias
    return 1 / (1 + np.exp(-np.clip(a * margin + b, -500, 500)))


def fold(doc_id: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds`` (null for a null id)."""
    return F.crc32(doc_id.cast("string")) % folds


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, keep: Column, rows: int) -> DataFrame:
    """(doc_id, text, label) of at most ``rows`` labelled documents.

    Ids are chosen in the order of a hash; an id with several labels takes their
    mean (>= 0.5 is 1), null labels and ids don't count.  The chosen ids are at
    most ``rows`` long-integer pairs, which bounds their broadcast.
    """
    one = (labels.select(F.col("doc_id").cast("long").alias("id"), F.col(label).cast("double").alias("y"))
           .where(F.col("id").isNotNull() & F.col("y").isNotNull()).where(keep)
           .groupBy("id").agg((F.avg("y") >= 0.5).cast("int").alias("y"))
           .orderBy(F.xxhash64("id"), "id").limit(rows))
    return (docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
            .join(F.broadcast(one), F.col("doc_id") == F.col("id")).select("doc_id", "text", "y"))


def few_of_each(found: DataFrame) -> DataFrame:
    """At most ``TEXTS_PER_ID`` rows (doc_id, digest, ...) of each id, repeated ones once.

    An id's digests fall into that many classes, and the least of each class stays.  The
    aggregation is partial per task, so an id that holds a third of all rows sends a
    few rows of each task, and the fit has at most ``TEXTS_PER_ID`` rows per chosen id.
    """
    return (found.groupBy("doc_id", F.pmod("digest", F.lit(TEXTS_PER_ID)).alias("class"))
            .agg(F.min_by(F.struct(*found.columns), "digest").alias("row")).select("row.*"))


def scored(docs: DataFrame, model: np.ndarray, features: Callable) -> DataFrame:
    """(doc_id, score) of every document; ``features()`` makes a worker's text-to-cells object."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = features()
        for b in batches:
            score = probabilities(model, (known.cells(t) for t in byte_texts(b.column(1))))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(score, pa.float64())], ["doc_id", "score"])

    return (docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
            .mapInArrow(run, "doc_id long, score double"))
