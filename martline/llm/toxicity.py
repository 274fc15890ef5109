"""Toxicity classifier with counterfactual regularisation.

A logistic model over words and word beginnings.  Sentences of the labelled texts
that name a group of people are written again with the group's term swapped, and
training penalises the squared change of the score between a sentence and its
swapped forms: what is left of a score is then about what is said, not about whom,
and neutral mentions of a group are not taken for insults.
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
from martline.llm.supervised import cell_counts, few_of_each, fold, labelled_sample, logistic_curve, scored

#: Hashed feature space; a model is one float per cell.
CELLS = 1 << 18
#: Most labelled rows that the model is fitted on (chosen by a hash of doc_id).
MAX_ROWS = 20_000
CURVE_EVERY = 5
EPOCHS, RATE, RIDGE = 10, 2.0, 1e-5
#: Standard errors by which a cell's log-count ratio must differ from zero to be used.
SURE = 2.0
#: Added to every count before the ratio is taken.
SMOOTH = 0.3
#: Weight of the squared score change between a sentence and its swapped form.
SWAP_WEIGHT = 0.5
#: Score from which a document counts as toxic.
CUT = 0.3

#: Interchangeable terms for groups of people; the first of each line is neutral.
IDENTITY_TERMS = [
    "people women men girls boys christians muslims jews hindus buddhists atheists catholics immigrants "
    "refugees foreigners natives africans asians arabs latinos blacks whites gays lesbians transgender disabled elderly",
    "person woman man girl boy christian muslim jew hindu buddhist atheist catholic immigrant refugee "
    "foreigner native african asian arab latino gay lesbian",
    "menschen frauen männer mädchen jungen christen muslime juden einwanderer flüchtlinge ausländer schwule lesben",
    "gens femmes hommes filles garçons chrétiens musulmans juifs immigrés réfugiés étrangers homosexuels lesbiennes",
    "personas mujeres hombres chicas chicos cristianos musulmanes judíos inmigrantes refugiados extranjeros gais lesbianas",
]
_GROUP = {t: line.split() for line in IDENTITY_TERMS for t in line.split()}
_SENTENCE = re.compile(r"(?<=[.!?])\s+|\n+")
_EDGES = " .,;:!?\"'()[]{}<>|*#%&$-_/"


class Features:
    """Distinct feature cells of a text: its words and their first three to five letters."""

    LIMIT = 200_000

    def __init__(self) -> None:
        self.words: dict[str, tuple[int, ...]] = {}

    def _seen(self, word: str) -> tuple[int, ...]:
        if len(self.words) >= self.LIMIT:
            self.words.clear()
        plain = word.strip(_EDGES)
        marks = [plain + " ", *(plain[:n] for n in (3, 4, 5) if len(plain) >= n)] if plain else []
        found = self.words[word] = tuple(
            xxhash.xxh3_64_intdigest(m.encode("utf-8", "replace"), 3) >> 46 for m in marks)
        return found

    def cells(self, text: bytes | str) -> np.ndarray:
        if isinstance(text, bytes):
            text = text.decode("utf-8", "replace")
        known, found = self.words, []
        for w in set(text.lower().split()):
            found += known.get(w) or self._seen(w)
        return np.unique(np.array(found, np.int32))


def swapped(sentence: str, most: int = 3) -> list[str]:
    """The sentence with its identity terms replaced: by the neutral term, and by up to
    ``most - 1`` others of the same list.  Empty if it names no group."""
    words = sentence.lower().split()
    plain = [w.strip(_EDGES) for w in words]
    named = [i for i, w in enumerate(plain) if w in _GROUP]
    out = []
    for step in range(most if named else 0):
        new = list(words)
        for i in named:
            group = _GROUP[plain[i]]
            to = group[0] if step == 0 else group[(group.index(plain[i]) + step) % len(group)]
            new[i] = words[i].replace(plain[i], to)
        if new != words:
            out.append(" ".join(new))
    return out


def swap_pairs(text: bytes, features: Features) -> list[list[int]]:
    """Cells that only the sentence has, a -1, cells that only its swapped form has."""
    pairs = []
    whole = text.decode("utf-8", "replace")
    if not any(t in _GROUP for t in {w.strip(_EDGES) for w in whole.lower().split()}):
        return pairs
    for sentence in _SENTENCE.split(whole):
        for other in swapped(sentence):
            a, b = features.cells(sentence), features.cells(other)
            left, right = np.setdiff1d(a, b), np.setdiff1d(b, a)
            pairs.append([*left.tolist(), -1, *right.tolist()])
    return pairs


def fit_rows(rows: list[np.ndarray], label: np.ndarray, pairs: list[list[int]],
             swap_weight: float = SWAP_WEIGHT) -> np.ndarray:
    """Model of the given rows: CELLS weights, bias, curve slope, curve offset."""
    y = (np.asarray(label) > 0).astype(float)
    if len(rows) == 0 or y.all() or not y.any():
        share = y.mean() if len(rows) else 0.5
        return np.append(np.zeros(CELLS + 1), [1.0, np.log((share + 1e-3) / (1 - share + 1e-3))])
    held = np.arange(len(rows)) % CURVE_EVERY == 0
    if len(set(y[held])) < 2 or len(set(y[~held])) < 2:
        held = np.zeros(len(rows), bool)
    fit = np.flatnonzero(~held)
    count = {c: SMOOTH + cell_counts([rows[i] for i in fit if y[i] == c], CELLS) for c in (1.0, 0.0)}
    ratio = np.log((count[1.0] / count[1.0].sum()) / (count[0.0] / count[0.0].sum()))
    # only what stands out of its own sampling error says something about other texts
    ratio[np.abs(ratio) < SURE * np.sqrt(1 / count[1.0] + 1 / count[0.0])] = 0.0
    scale = np.append(ratio, 1.0)
    used = {i: np.append(rows[i][ratio[rows[i]] != 0], CELLS).astype(np.int32) for i in fit}
    weight = {1.0: 0.5 / y[fit].mean(), 0.0: 0.5 / (1 - y[fit].mean())}
    w = np.zeros(CELLS + 1)
    rng = np.random.default_rng(11)
    swaps = [(np.array(p[:p.index(-1)], np.int64), np.array(p[p.index(-1) + 1:], np.int64)) for p in pairs]

    def step(cells: np.ndarray, slope: float, rate: float) -> None:
        v = scale[cells]
        w[cells] -= rate * (slope * v / (1.0 + v @ v) + RIDGE * w[cells])

    for epoch in range(EPOCHS):
        rate = RATE / (1 + epoch)
        for i in rng.permutation(fit):
            r = used[i]
            p = 1 / (1 + np.exp(-max(-30.0, min(30.0, w[r] @ scale[r]))))
            step(r, weight[y[i]] * (p - y[i]), rate)
        for k in rng.permutation(len(swaps)):
            a, b = swaps[k]
            change = w[a] @ scale[a] - w[b] @ scale[b]
            step(a, swap_weight * change, rate)
            step(b, -swap_weight * change, rate)
    w *= scale
    seen = np.flatnonzero(held) if held.any() else fit
    margin = np.array([w[rows[i]].sum() + w[CELLS] for i in seen])
    return np.append(w, logistic_curve(margin, 2 * y[seen] - 1))


def train(docs: DataFrame, labels: DataFrame, folds: int = 4, held: int = 2,
          max_rows: int = MAX_ROWS, swap_weight: float = SWAP_WEIGHT) -> np.ndarray:
    """Model fitted on labelled rows outside fold ``held``, at most ``max_rows`` ids."""
    sample = labelled_sample(docs, labels, "toxic", fold(F.col("id"), folds) != held, max_rows)

    def cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features = Features()
        for b in batches:
            texts = list(byte_texts(b.column("text")))
            found = [features.cells(t) for t in texts]
            digest = [xxhash.xxh3_64_intdigest(f.tobytes()) >> 1 for f in found]
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), b.column("y"), pa.array(digest, pa.int64()),
                 pa.array(found, pa.list_(pa.int32())),
                 pa.array([swap_pairs(t, features) for t in texts], pa.list_(pa.list_(pa.int64())))],
                ["doc_id", "y", "digest", "cells", "pairs"])

    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, y, pairs = [], [], []
        for b in batches:
            rows += [np.asarray(c, np.int32) for c in b.column("cells").to_numpy(zero_copy_only=False)]
            y += b.column("y").to_pylist()
            pairs += [p for ps in b.column("pairs").to_pylist() for p in ps]
        model = fit_rows(rows, np.array(y, float), pairs, swap_weight)
        yield pa.RecordBatch.from_arrays([pa.array([model.astype(np.float64).tobytes()])], ["model"])

    found = few_of_each(sample.mapInArrow(
        cells, "doc_id long, y int, digest long, cells array<int>, pairs array<array<long>>"))
    rows = found.repartition(1).sortWithinPartitions(F.xxhash64("doc_id"), "doc_id", "digest")
    got = rows.mapInArrow(fit, "model binary").first()
    return np.frombuffer(got["model"]) if got else fit_rows([], np.zeros(0), [])


def toxicity_scores(docs: DataFrame, labels: DataFrame, folds: int = 4, held: int = 2,
                    cut: float = CUT, max_rows: int = MAX_ROWS) -> DataFrame:
    """One row per document: doc_id, held_out, score in [0, 1], predicted (score >= cut).

    Fold ``held`` of ``folds`` (crc32 of doc_id) is held out of training.  Null and
    empty texts have a score too; a null doc_id is not held out; repeated rows
    each return.  Without labels of both classes every score is the share of
    ones (0.5 without any).  Labels, lang, source and doc_id are no inputs of a score.
    """
    model = train(docs, labels, folds, held, max_rows)
    return (scored(docs, model, Features)
            .select("doc_id", F.coalesce(fold(F.col("doc_id"), folds) == held, F.lit(False)).alias("held_out"),
                    "score", (F.col("score") >= cut).cast("int").alias("predicted")))
