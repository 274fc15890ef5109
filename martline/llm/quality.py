"""Quality classifier: naive Bayes support vectors (NBSVM).

Indicators of word n-grams and word-shape n-grams are scaled by the log of the
ratio of their smoothed class counts; a linear hinge-loss model is then fitted on
them by dual coordinate descent, and its margins are mapped to probabilities by
a logistic curve fitted on rows that the model did not see.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martline.llm.common import byte_texts
from martline.llm.supervised import cell_counts, few_of_each, fold, labelled_sample, logistic_curve, probabilities, scored

#: Hashed feature space; a model is one float per cell.
CELLS = 1 << 18
#: Most labelled rows that the model is fitted on (chosen by a hash of doc_id).
MAX_ROWS = 20_000
#: Every such row of the sample is kept for the logistic curve.
CURVE_EVERY = 5
EPOCHS, COST, SMOOTH = 12, 0.05, 1.0
#: The descent goes on until its duality gap is this share of the loss, for 120 epochs at most.
GAP, EPOCHS_MOST = 0.005, 120
#: Score from which a document counts as good.
CUT = 0.3

_RUNS = re.compile(rb"[A-Z]+|[a-z\x80-\xff]+|[0-9]+|([^A-Za-z0-9\x80-\xff])\1*")


def _run_mark(m: re.Match) -> bytes:
    first = m.group()[:1]
    if first.isupper():
        return b"A" if len(m.group()) > 1 else b"B"
    if first.isdigit():
        return b"0"
    return b"a" if first.isalpha() or first >= b"\x80" else m.group()[:4]


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    return h ^ (h >> np.uint64(29))


class Features:
    """Distinct feature cells of a text: words, and 1- to 3-grams of word shapes.

    A shape writes runs of letters, capitals and digits as one mark each and keeps
    punctuation; a word that repeats the one before has a shape of its own.
    """

    LIMIT = 200_000  # words whose hashes a worker remembers

    def __init__(self) -> None:
        self.words: dict[bytes, tuple[int, int]] = {}

    def _seen(self, word: bytes) -> tuple[int, int]:
        found = self.words.get(word)
        if found is None:
            if len(self.words) >= self.LIMIT:
                self.words.clear()
            shape = _RUNS.sub(_run_mark, word)
            found = self.words[word] = (xxhash.xxh3_64_intdigest(word.lower(), 1),
                                        xxhash.xxh3_64_intdigest(shape, 2))
        return found

    def cells(self, text: bytes) -> np.ndarray:
        words = text.split()
        if not words:
            return np.zeros(1, np.int32)
        known = {w: self._seen(w) for w in dict.fromkeys(words)}
        word = np.fromiter((h for h, _ in known.values()), np.uint64, len(known))
        index = {w: i for i, w in enumerate(known)}
        order = np.fromiter(map(index.__getitem__, words), np.int64, len(words))
        shape = np.fromiter((s for _, s in known.values()), np.uint64, len(known))[order]
        shape[1:][order[1:] == order[:-1]] = np.uint64(0x5EED)
        edge = np.array([0xED6E], np.uint64)
        shape = np.concatenate([edge, shape, edge])
        two = _mix(shape[:-1] * np.uint64(3) + shape[1:])
        three = _mix(two[:-1] * np.uint64(5) + shape[2:])
        grams = np.concatenate([np.unique(shape), np.unique(two), np.unique(three)])
        found = np.concatenate([_mix(word) >> np.uint64(47), _mix(grams + np.uint64(7)) >> np.uint64(46)])
        return np.unique(found.astype(np.int32))


def _dual(rows: list[np.ndarray], y: np.ndarray, ratio: np.ndarray,
          costs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hinge-loss weights of the scaled cells (L2-regularised) by dual coordinate descent, the last of
    them the bias, and the dual variables, one per row."""
    w = np.zeros(CELLS + 1)
    alpha = np.zeros(len(rows))
    rows = [np.append(r[ratio[r] != 0], CELLS).astype(np.int32) for r in rows]
    scale = np.append(ratio, 1.0)
    norms = np.array([scale[r] @ scale[r] for r in rows])
    rng = np.random.default_rng(7)
    for epoch in range(EPOCHS_MOST):
        for i in rng.permutation(len(rows)):
            r = rows[i]
            v = scale[r]
            slope = y[i] * (w[r] @ v) - 1.0
            new = min(max(alpha[i] - slope / norms[i], 0.0), costs[i])
            if new != alpha[i]:
                w[r] += (new - alpha[i]) * y[i] * v
                alpha[i] = new
        if epoch + 1 >= EPOCHS:
            margin = np.array([w[r] @ scale[r] for r in rows])
            loss = 0.5 * (w @ w) + costs @ np.maximum(0.0, 1 - y * margin)
            if loss - (alpha.sum() - 0.5 * (w @ w)) <= GAP * loss:
                break
    return w, alpha


def _descend(rows: list[np.ndarray], y: np.ndarray, ratio: np.ndarray, costs: np.ndarray) -> np.ndarray:
    """The weights of the cells themselves."""
    w, _ = _dual(rows, y, ratio, costs)
    w[:CELLS] *= ratio
    return w


def fit_rows(rows: list[np.ndarray], label: np.ndarray) -> np.ndarray:
    """Model of the given rows: CELLS weights, bias, curve slope, curve offset."""
    y = np.where(label > 0, 1.0, -1.0)
    if len(rows) == 0 or (y > 0).all() or (y < 0).all():
        share = (y > 0).mean() if len(rows) else 0.5
        return np.append(np.zeros(CELLS + 1), [1.0, np.log((share + 1e-3) / (1 - share + 1e-3))])
    held = np.arange(len(rows)) % CURVE_EVERY == 0
    if len(set(y[held])) < 2 or len(set(y[~held])) < 2:
        held = np.zeros(len(rows), bool)
    fit = np.flatnonzero(~held)
    count = {s: SMOOTH + cell_counts([rows[i] for i in fit if y[i] == s], CELLS) for s in (1.0, -1.0)}
    ratio = np.log((count[1.0] / count[1.0].sum()) / (count[-1.0] / count[-1.0].sum()))
    ratio[count[1.0] + count[-1.0] < 2 * SMOOTH + 3] = 0.0  # too rare to say anything
    share = {s: (y[fit] == s).mean() for s in (1.0, -1.0)}
    costs = np.array([COST * 0.5 / share[y[i]] for i in fit])
    w = _descend([rows[i] for i in fit], y[fit], ratio, costs)
    seen = np.flatnonzero(held) if held.any() else fit
    margin = np.array([w[rows[i]].sum() + w[CELLS] for i in seen])
    return np.append(w, logistic_curve(margin, y[seen]))


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", folds: int = 5,
          max_rows: int = MAX_ROWS) -> np.ndarray:
    """Model fitted on labelled rows outside fold 0, at most ``max_rows`` ids.

    Features are extracted where the rows are; the fit itself is one task over
    at most ``max_rows`` ids' short rows of cell numbers, a few for each id.
    """
    sample = labelled_sample(docs, labels, label, fold(F.col("id"), folds) != 0, max_rows)

    def cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features = Features()
        for b in batches:
            found = [features.cells(t) for t in byte_texts(b.column("text"))]
            digest = [xxhash.xxh3_64_intdigest(f.tobytes()) >> 1 for f in found]
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), b.column("y"), pa.array(digest, pa.int64()),
                 pa.array(found, pa.list_(pa.int32()))], ["doc_id", "y", "digest", "cells"])

    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, y = [], []
        for b in batches:
            rows += [np.asarray(c, np.int32) for c in b.column("cells").to_numpy(zero_copy_only=False)]
            y += b.column("y").to_pylist()
        model = fit_rows(rows, np.array(y, float))
        yield pa.RecordBatch.from_arrays([pa.array([model.astype(np.float64).tobytes()])], ["model"])

    found = few_of_each(sample.mapInArrow(cells, "doc_id long, y int, digest long, cells array<int>"))
    rows = found.repartition(1).sortWithinPartitions(F.xxhash64("doc_id"), "doc_id", "digest")
    got = rows.mapInArrow(fit, "model binary").first()
    return np.frombuffer(got["model"]) if got else fit_rows([], np.zeros(0))


def quality_scores(docs: DataFrame, labels: DataFrame, folds: int = 5, cut: float = CUT,
                   max_rows: int = MAX_ROWS) -> DataFrame:
    """One row per document: doc_id, held_out, score in [0, 1], predicted (score >= cut).

    Fold 0 of ``folds`` (crc32 of doc_id) is held out of training.  Null and empty
    texts have a score too; a null doc_id is not held out.  Repeated rows each
    return.  Without labels of both classes every score is the share of ones (0.5
    without any).  Labels, lang, source and doc_id are no inputs of a score.
    """
    model = train(docs, labels, "quality", folds, max_rows)
    return (scored(docs, model, Features)
            .select("doc_id", F.coalesce(fold(F.col("doc_id"), folds) == 0, F.lit(False)).alias("held_out"),
                    "score", (F.col("score") >= cut).cast("int").alias("predicted")))


def keep_good(docs: DataFrame, labels: DataFrame, cut: float = CUT, max_rows: int = MAX_ROWS) -> DataFrame:
    """The documents whose score is at least ``cut``, all columns unchanged."""
    model = train(docs, labels, "quality", 5, max_rows)
    text = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features = Features()
        for b in batches:
            score = probabilities(model, (features.cells(t) for t in byte_texts(b.column(text))))
            yield b.filter(pa.array(score >= cut))

    return docs.mapInArrow(run, docs.schema)
