"""SimHash near-dedup with the generalised pigeonhole principle.

Fingerprints of ``BITS`` bits that differ in at most ``tau`` bits are found by
cutting the bits into ``m`` parts and giving each part its own threshold
t_i >= -1 with sum(t_i + 1) = tau + 1: two fingerprints within tau must then be
within t_i in at least one part.  Correlated bits go into the same part, and
every fingerprint allots its thresholds by dynamic programming over the
estimated number of candidates, so that crowded part values are avoided where
another part can do the work.  Probing finds the fingerprints in the allotted
balls, and each candidate is verified on all bits.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martline.llm.common import byte_texts, row_key, stored
from martline.llm.components import roots

BITS = 64
SEED = 42
#: Bits of one histogram of part values; its 2^UNIT counters bound what the driver holds.
UNIT = 16
#: Data rows that one probing run compares with; larger buckets are dealt over several runs.
BLOCK = 16_384
#: Pairs compared at a time, and rows gathered before a comparison.
PAIRS, ROWS = 1 << 20, 1 << 17
#: Cost of one probed signature in units of one verified candidate.
PROBE_COST = 4.0


def _fingerprint(text: bytes, shingle: int) -> int:
    words = text.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    if len(words) <= shingle:
        grams = [joined]
    else:
        starts = [0, *(ends[:-shingle] + 1).tolist()]
        grams = [joined[a:b] for a, b in zip(starts, ends[shingle - 1:].tolist())]
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(g, SEED) for g in grams), np.uint64, len(grams))
    bits = np.unpackbits(hashes.view(np.uint8), bitorder="little").reshape(-1, BITS)
    # byte-wide counters, eight to a word, flushed before one can overflow
    lanes = np.add.reduceat(bits.view(np.uint64), np.arange(0, len(bits), 255), axis=0)
    counts = lanes.view(np.uint8).reshape(-1, BITS).sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > len(grams), bitorder="little").view(np.int64)[0])


def fingerprints(docs: DataFrame, shingle: int = 4) -> DataFrame:
    """(doc_id, k1, k2, fp): the SimHash of every whole text, as a signed 64-bit long.

    Lower-cases A-Z, splits on ASCII white space, hashes every ``shingle``-word
    shingle (repeats included; fewer words make one shingle) with XXH64.  A null
    or wordless text has fingerprint 0.
    """
    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), *row_key(),
                        F.col("text").cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fp = np.fromiter((_fingerprint(t, shingle) for t in byte_texts(b.column("text"))),
                             np.int64, b.num_rows)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("k1"), b.column("k2"),
                                              pa.array(fp)], ["doc_id", "k1", "k2", "fp"])

    return plain.mapInArrow(run, "doc_id long, k1 long, k2 long, fp long")


# ---------------------------------------------------------------- layout

def _bit_matrix(fps: np.ndarray) -> np.ndarray:
    return np.unpackbits(fps.astype(np.int64).view(np.uint8), bitorder="little").reshape(-1, BITS)


def bit_counts(nodes: DataFrame) -> tuple[int, np.ndarray]:
    """Number of fingerprints and how many have bits i and j set, for all i, j."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((BITS, BITS))
        n = 0
        for b in batches:
            x = _bit_matrix(b.column("fp").to_numpy()).astype(np.float32)
            total += x.T @ x
            n += len(x)
        both = np.append(total.astype(np.int64).ravel(), n)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(both))), pa.array(both)], ["cell", "n"])

    cells = (nodes.select("fp").mapInArrow(run, "cell long, n long")
             .groupBy("cell").agg(F.sum("n").alias("n")).collect())
    flat = np.zeros(BITS * BITS + 1, np.int64)
    for r in cells:
        flat[r["cell"]] = r["n"]
    return int(flat[-1]), flat[:-1].reshape(BITS, BITS)


def part_count(n: int, tau: int) -> int:
    """Number of parts with the least expected cost for n evenly spread fingerprints."""
    def cost(m: int) -> float:
        width, total = BITS // m, 0.0
        for i in range(m):
            t = (tau + 1) // m - 1 + (i < (tau + 1) % m)
            ball = sum(comb(width, e) for e in range(t + 1))
            total += ball * (PROBE_COST + n / 2.0 ** width)
        return total
    return min(range(2, tau + 1), key=cost) if tau >= 2 else 2


def group_bits(n: int, both: np.ndarray, m: int) -> list[np.ndarray]:
    """Cut the bits into m parts of near-equal width, correlated bits together."""
    p = np.diag(both) / max(n, 1)
    spread = np.sqrt(np.clip(p * (1 - p), 1e-12, None))
    corr = np.abs((both / max(n, 1) - np.outer(p, p)) / np.outer(spread, spread))
    np.fill_diagonal(corr, 0)
    free, parts = list(range(BITS)), []
    for i in range(m):
        width = BITS // m + (i < BITS % m)
        part = [max(free, key=lambda b: (corr[b, free].sum(), -b))]
        free.remove(part[0])
        while len(part) < width:
            part.append(max(free, key=lambda b: (corr[b, part].sum(), -b)))
            free.remove(part[-1])
        parts.append(np.array(sorted(part)))
    return parts


def _value(bits: np.ndarray, chosen: np.ndarray) -> np.ndarray:
    return bits[:, chosen].astype(np.int64) @ (np.int64(1) << np.arange(len(chosen), dtype=np.int64))


def _units(parts: list[np.ndarray]) -> list[list[np.ndarray]]:
    return [np.array_split(p, -(-len(p) // UNIT)) for p in parts]


def unit_histograms(nodes: DataFrame, units: list[list[np.ndarray]]) -> list[list[np.ndarray]]:
    """How often every value of every unit occurs among all fingerprints (at most 2^UNIT each)."""
    flat = [u for part in units for u in part]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            bits = _bit_matrix(b.column("fp").to_numpy())
            for k, chosen in enumerate(flat):
                value, n = np.unique(_value(bits, chosen), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(value + (k << 32)), pa.array(n)], ["cell", "n"])

    cells = (nodes.select("fp").mapInArrow(run, "cell long, n long")
             .groupBy("cell").agg(F.sum("n").alias("n")).toPandas())
    cell, count = cells["cell"].to_numpy(np.int64), cells["n"].to_numpy(np.int64)
    out = [np.zeros(1 << len(u)) for u in flat]
    for k in range(len(flat)):
        own = cell >> 32 == k
        out[k][cell[own] & 0xFFFFFFFF] = count[own]
    it = iter(out)
    return [[next(it) for _ in part] for part in units]


def _at_distance(hist: np.ndarray, most: int) -> np.ndarray:
    """[e, v]: fingerprints whose unit value differs from v in exactly e bits."""
    out = np.zeros((most + 1, len(hist)), np.float64)
    out[0] = hist
    index = np.arange(len(hist))
    for bit in range(len(hist).bit_length() - 1):
        flipped = out[:, index ^ (1 << bit)]
        out[1:] += flipped[:-1]
    return out.astype(np.float32)


def _ball(width: int, radius: int) -> np.ndarray:
    """All masks of at most ``radius`` set bits."""
    masks = [sum(1 << b for b in c) for e in range(radius + 1) for c in combinations(range(width), e)]
    return np.array(masks, np.int64)


class Layout:
    """Parts, histograms and the threshold allotment; shipped to the tasks (fixed size)."""

    def __init__(self, n: int, tau: int, parts: list[np.ndarray], hists: list[list[np.ndarray]]):
        self.n, self.tau, self.parts, self.units = max(n, 1), tau, parts, _units(parts)
        self.hists = [[h.astype(np.float32) for h in hs] for hs in hists]
        self.near = [[_at_distance(h, tau) for h in hs] for hs in hists]
        self.balls = [[sum(comb(len(p), e) for e in range(t + 1)) for t in range(tau + 1)] for p in parts]

    def candidates(self, part: int, bits: np.ndarray) -> np.ndarray:
        """[t, row]: estimated fingerprints within t in this part (units taken as independent)."""
        exact = None
        for unit, near in zip(self.units[part], self.near[part]):
            rows = near[:, _value(bits, unit)].astype(np.float64)
            if exact is None:
                exact = rows
            else:
                mixed = np.zeros_like(exact)
                for a in range(self.tau + 1):
                    mixed[a:] += exact[:self.tau + 1 - a] * rows[a] / self.n
                exact = mixed
        return np.cumsum(exact, axis=0)

    def thresholds(self, bits: np.ndarray) -> np.ndarray:
        """[part, row]: allotted thresholds t_i >= -1 of least cost with sum(t_i + 1) = tau + 1."""
        rows, budget = len(bits), self.tau + 1
        best = np.full((budget + 1, rows), np.inf)
        best[0] = 0
        choices = []
        for part in range(len(self.parts)):
            found = self.candidates(part, bits)
            cost = [np.zeros(rows)] + [found[t] + PROBE_COST * self.balls[part][t] for t in range(self.tau + 1)]
            new = np.full_like(best, np.inf)
            pick = np.zeros((budget + 1, rows), np.int8)
            for b in range(budget + 1):
                for s in range(b + 1):
                    total = best[b - s] + cost[s]
                    better = total < new[b]
                    new[b][better] = total[better]
                    pick[b][better] = s
            best = new
            choices.append(pick)
        left, out = np.full(rows, budget), np.empty((len(self.parts), rows), np.int64)
        for part in reversed(range(len(self.parts))):
            s = choices[part][left, np.arange(rows)].astype(np.int64)
            out[part] = s - 1
            left = left - s
        return out

    def runs(self, part: int, value: np.ndarray) -> np.ndarray:
        """Over how many runs the data rows of a bucket are dealt (a bound on its size decides)."""
        bound, at = np.full(len(value), np.inf), 0
        for unit, hist in zip(self.units[part], self.hists[part]):
            # a part's value holds its units one after the other
            bound = np.minimum(bound, hist[(value >> at) & ((1 << len(unit)) - 1)])
            at += len(unit)
        block = max(BLOCK, 4 * self.n / (1 << UNIT))
        return np.maximum(1, np.ceil(bound / block)).astype(np.int64)


def _probe_rows(layout: Layout, fps: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, bool]]:
    """(bucket, run, fingerprint, is probe) rows of a batch of fingerprints."""
    bits = _bit_matrix(fps)
    allotted = layout.thresholds(bits)
    mixed = (fps.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(33)
    for part, chosen in enumerate(layout.parts):
        value = _value(bits, chosen)
        runs = layout.runs(part, value)
        yield value | (part << 40), mixed.astype(np.int64) % runs, fps, False
        for t in range(layout.tau + 1):
            own = np.flatnonzero(allotted[part] == t)
            if not len(own):
                continue
            for masks in np.array_split(_ball(len(chosen), t), -(-layout.balls[part][t] * len(own) // ROWS)):
                probed = (value[own][:, None] ^ masks[None, :]).ravel()
                who = np.repeat(fps[own], len(masks))
                copies = layout.runs(part, probed)
                first = np.cumsum(copies) - copies
                run = np.arange(copies.sum()) - np.repeat(first, copies)
                yield np.repeat(probed, copies) | (part << 40), run, np.repeat(who, copies), True


def _forest(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each linked node with the smallest node it reaches over these links."""
    nodes, flat = np.unique(np.concatenate([u, v]), return_inverse=True)
    a, b = flat[:len(u)], flat[len(u):]
    label = np.arange(len(nodes))
    while True:
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        new = new[new]
        if np.array_equal(new, label):
            break
        label = new
    moved = label != np.arange(len(nodes))
    return nodes[moved], nodes[label[moved]]


def _close_pairs(tau: int, fp: np.ndarray, first: np.ndarray, data: np.ndarray,
                 probes: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Verified links of runs that start at ``first`` with ``data`` rows, then ``probes`` rows."""
    pairs = data * probes
    own = np.flatnonzero(pairs)
    ends = np.cumsum(pairs[own])
    total = int(ends[-1]) if len(ends) else 0
    for at in range(0, total, PAIRS):
        pos = np.arange(at, min(at + PAIRS, total))
        run = np.searchsorted(ends, pos, "right")
        inside = pos - (ends[run] - pairs[own][run])
        r = own[run]
        x = fp[first[r] + inside % data[r]]
        y = fp[first[r] + data[r] + inside // data[r]]
        apart = np.bitwise_count((x ^ y).view(np.uint64))
        close = (apart > 0) & (apart <= tau)
        if close.any():
            yield _forest(x[close], y[close])


def links(nodes: DataFrame, tau: int = 4) -> DataFrame:
    """(u, v): links that join all fingerprints of ``nodes(fp)`` within ``tau`` bits of each other.

    No link is lost: within one comparison the found pairs are replaced by a
    forest that joins the same fingerprints, so the rows stay in proportion to the
    fingerprints, not to their pairs.
    """
    n, both = bit_counts(nodes)
    parts = group_bits(n, both, part_count(n, tau))
    layout = Layout(n, tau, parts, unit_histograms(nodes, _units(parts)))

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fps = np.ascontiguousarray(b.column("fp").to_numpy())
            for at in range(0, len(fps), ROWS // 8):
                for bucket, run, fp, probe in _probe_rows(layout, fps[at:at + ROWS // 8]):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(bucket), pa.array(run.astype(np.int32)), pa.array(np.full(len(fp), probe)),
                         pa.array(fp)], ["bucket", "run", "probe", "fp"])

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(u: np.ndarray, v: np.ndarray) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], ["u", "v"])

        def compare(bucket, run, probe, fp) -> Iterator[pa.RecordBatch]:
            new = np.flatnonzero(np.append(True, (bucket[1:] != bucket[:-1]) | (run[1:] != run[:-1])))
            size = np.diff(np.append(new, len(fp)))
            probes = np.add.reduceat(probe.astype(np.int64), new)
            for u, v in _close_pairs(tau, fp, new, size - probes, probes):
                yield out(u, v)

        held = [np.zeros(0, np.int64), np.zeros(0, np.int32), np.zeros(0, bool), np.zeros(0, np.int64)]
        for b in batches:
            held = [np.concatenate([h, b.column(i).to_numpy(zero_copy_only=False)]) for i, h in enumerate(held)]
            if len(held[0]) < ROWS:
                continue
            bucket, run, probe, fp = held
            last = np.flatnonzero((bucket[1:] != bucket[:-1]) | (run[1:] != run[:-1]))
            cut = int(last[-1]) + 1 if len(last) else 0
            if cut:
                yield from compare(*(h[:cut] for h in held))
                held = [h[cut:] for h in held]
            elif probe.any():
                # one long run: its data rows came first; compare what has come, keep the data rows
                yield from compare(*held)
                held = [h[~probe] for h in held]
        if len(held[0]):
            yield from compare(*held)

    rows = nodes.select("fp").mapInArrow(spread, "bucket long, run int, probe boolean, fp long")
    return (rows.repartition("bucket", "run").sortWithinPartitions("bucket", "run", "probe")
            .mapInArrow(verify, "u long, v long"))


def _classes(prints: DataFrame, tau: int) -> DataFrame:
    """(fp, component_id) of every distinct fingerprint."""
    nodes = stored(prints.groupBy("fp").agg(F.min("doc_id").alias("least_id")), "simhash-nodes")
    root = roots(links(nodes, tau)).withColumnRenamed("node", "fp")
    joined = stored(nodes.join(root, "fp", "left")
                    .select("fp", F.coalesce("root", "fp").alias("root"), "least_id"), "simhash-classes")
    least = joined.groupBy("root").agg(F.min("least_id").alias("component_id"))
    return joined.join(least, "root").select("fp", "root", "component_id")


def near_duplicates(docs: DataFrame, shingle: int = 4, tau: int = 4) -> DataFrame:
    """One row per document: doc_id, fingerprint (16 hex digits), component_id.

    component_id is the smallest doc_id that is reachable over links of at most
    ``tau`` differing bits.  Null and wordless texts have fingerprint zero and
    are linked like any other.  Repeated rows each return; a null doc_id never is
    a component's id (null only if no document of the component has one).
    Other columns are ignored; an empty table returns no rows.
    """
    prints = stored(fingerprints(docs, shingle), "simhash")
    return (prints.join(_classes(prints, tau), "fp")
            .select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"))


def keep_one(docs: DataFrame, shingle: int = 4, tau: int = 4) -> DataFrame:
    """The documents, one of each component: the smallest doc_id (then row key), all columns kept.

    Rows that repeat doc_id and text count as one document.  Columns of the input
    come back unchanged, whatever their names.
    """
    prints = stored(fingerprints(docs, shingle), "simhash")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "k1", "k2"))
    kept = (prints.join(_classes(prints, tau).select("fp", "root"), "fp")
            .groupBy("root").agg(first.alias("first"))
            .select(F.col("first.k1").alias("kept_k1"), F.col("first.k2").alias("kept_k2")))
    names = docs.columns
    keyed = docs.select(F.struct(*[docs[f"`{c}`"] for c in names]).alias("row"), *row_key())
    return (keyed.join(kept, (F.col("k1") == F.col("kept_k1")) & (F.col("k2") == F.col("kept_k2")))
            .groupBy("k1", "k2").agg(F.first("row").alias("row"))
            .select(*[F.col("row").getField(c).alias(c) for c in names]))
