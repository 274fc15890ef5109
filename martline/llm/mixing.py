"""Mixing sources to target weights.

Words of each source are packed into blocks of a fixed length.  The mix is a
row of slots, cut into output shards; each shard draws its number of slots per
source from a multinomial distribution.  A source's slots walk, cycle after cycle,
through a pseudorandom permutation of its blocks, and slots and blocks are joined
by index.  The draws decide where in the mix a source's slots lie; slots that a
source got beyond its target go to the sources that are still short, so every
source ends on its target.
"""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martline.llm.common import WORD_PATTERN, row_key, stored, with_offsets

#: Weights given to the sources in code point order, repeating (fixed by the contract).
WEIGHTS = (5, 2, 1)
#: No source is taken more often than this.
MOST = 3
BLOCK_WORDS, SHARD_SLOTS, SEED = 128, 16_384, 20_240_611


def targets(sizes: list[int], weights: list[int], most: int = MOST) -> list[Fraction]:
    """Share all words by weight; what exceeds ``most`` times a size is shared again among the others."""
    out = [Fraction(0)] * len(sizes)
    open_, left = list(range(len(sizes))), Fraction(sum(sizes))
    while open_:
        total = sum(weights[i] for i in open_)
        share = {i: left * weights[i] / total for i in open_}
        full = [i for i in open_ if share[i] > most * sizes[i]]
        for i in full or open_:
            out[i] = Fraction(most * sizes[i]) if full else share[i]
        if not full:
            break
        left -= sum(out[i] for i in full)
        open_ = [i for i in open_ if i not in full]
    return out


def _round(half: np.ndarray, key: int, turn: int, bits: int) -> np.ndarray:
    h = (half + np.uint64((key * 0x9E3779B97F4A7C15 + turn * 0xD1B54A32D192ED03) & 0xFFFFFFFFFFFFFFFF))
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xC4CEB9FE1A85EC53)
    return (h ^ (h >> np.uint64(32))) & np.uint64((1 << bits) - 1)


def permuted(index: np.ndarray, n: int, key: int, back: bool = False) -> np.ndarray:
    """A pseudorandom permutation of 0..n-1 at ``index`` (or its inverse): four Feistel
    rounds over the next even power of two, repeated while the value lies beyond n."""
    bits = max(1, (max(n - 1, 1).bit_length() + 1) // 2)
    low = np.uint64((1 << bits) - 1)
    out = index.astype(np.uint64)
    todo = np.ones(len(out), bool)
    while todo.any():
        left, right = out[todo] >> np.uint64(bits), out[todo] & low
        for turn in range(4):
            if back:
                left, right = right ^ _round(left, key, 3 - turn, bits), left
            else:
                left, right = right, left ^ _round(right, key, turn, bits)
        out[todo] = (left << np.uint64(bits)) | right
        todo = out >= np.uint64(n)
    return out.astype(np.int64)


class Source:
    """Slots of one source: whole cycles through its blocks, then part of one, the last slot trimmed."""

    def __init__(self, index: int, size: int, target: Fraction, block: int, seed: int):
        self.index, self.size, self.block, self.seed = index, size, block, seed
        self.blocks = -(-size // block)
        self.slots, self.last_words = 0, block
        if not size:
            return
        cycles, rest = divmod(round(target), size)
        self.slots = cycles * self.blocks
        if rest:
            short = block - (size - (self.blocks - 1) * block)
            where = int(permuted(np.array([self.blocks - 1]), self.blocks, self.key(cycles), back=True)[0])
            words = lambda k: k * block - (short if where < k else 0)
            k = -(-rest // block)
            k += words(k) < rest
            self.slots += k
            self.last_words = rest - words(k - 1)

    def key(self, cycle: int) -> int:
        return self.seed + self.index * 1_000_003 + cycle * 7_919

    def place(self, slot: np.ndarray) -> np.ndarray:
        """Block of each of the source's slots."""
        cycle, out = slot // self.blocks, np.empty(len(slot), np.int64)
        for c in np.unique(cycle):
            own = cycle == c
            out[own] = permuted(slot[own] % self.blocks, self.blocks, self.key(int(c)))
        return out


def _slot_table(spark, sources: list[Source], shard_slots: int, seed: int) -> DataFrame:
    """(shard, place, source, block, words): which block stands in each slot of the mix."""
    total = sum(s.slots for s in sources)
    schema = "shard long, place long, source int, block long, words long"
    if not total:
        return spark.createDataFrame([], schema)
    shards = -(-total // shard_slots)
    share = np.array([s.slots for s in sources], float) / total

    def draw(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for shard in b.column("id").to_pylist():
                n = min(shard_slots, total - shard * shard_slots)
                drawn = np.random.default_rng([seed, shard]).multinomial(n, share)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(drawn), shard)), pa.array(np.arange(len(drawn), dtype=np.int32)),
                     pa.array(drawn.astype(np.int64))], ["shard", "source", "drawn"])

    parts = max(1, min(shards // 8, spark.sparkContext.defaultParallelism * 4)) if shards > 8 else 1
    drawn = stored(spark.range(0, shards, 1, parts).mapInArrow(draw, "shard long, source int, drawn long"), "mix-draws")
    got = {r["source"]: r["n"] for r in drawn.groupBy("source").agg(F.sum("drawn").alias("n")).collect()}
    got = np.array([got[s.index] for s in sources], np.int64)
    want = np.array([s.slots for s in sources], np.int64)
    over, short = np.maximum(got - want, 0), np.maximum(want - got, 0)
    over_start, short_end = np.cumsum(over) - over, np.cumsum(short)

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for shard, s, n, start in zip(*(b.column(c).to_pylist() for c in ("shard", "source", "drawn", "first"))):
                slot, owner = np.arange(start, start + n), np.full(n, s)
                extra = slot >= want[s]
                if extra.any():  # beyond the target: handed to the sources that are short
                    rank = over_start[s] + slot[extra] - want[s]
                    owner[extra] = np.searchsorted(short_end, rank, "right")
                    slot[extra] = want[owner[extra]] - (short_end[owner[extra]] - rank)
                block, words = np.empty(n, np.int64), np.empty(n, np.int64)
                for o in np.unique(owner):
                    own, src = owner == o, sources[o]
                    block[own] = src.place(slot[own])
                    words[own] = np.where(slot[own] == src.slots - 1, src.last_words, src.block)
                place = _round(slot.astype(np.uint64) * np.uint64(4099) + owner.astype(np.uint64),
                               seed + shard, 9, 62)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(n, shard)), pa.array(place.astype(np.int64)), pa.array(owner.astype(np.int32)),
                     pa.array(block), pa.array(words)], ["shard", "place", "source", "block", "words"])

    starts = with_offsets(drawn, "source", ["shard"], "drawn", "first")
    return starts.select("shard", "source", "drawn", "first").mapInArrow(fill, schema)


def mixed(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST,
          block_words: int = BLOCK_WORDS, shard_slots: int = SHARD_SLOTS,
          seed: int = SEED) -> tuple[DataFrame, DataFrame]:
    """(documents, mix).

    documents: row, doc_id, size, source, source_size, target.  mix: one row for
    each stretch of a document in a slot (shard, place, row, doc_id, at, n_words):
    words ``at .. at + n_words`` of the document, slots of a shard in the order
    of ``place``.  A source has one line on the driver; sources are few.
    """
    spark = docs.sparkSession
    size = F.coalesce(F.regexp_count(F.col("text").cast("string"), F.lit(WORD_PATTERN)), F.lit(0)).cast("long")
    rows = stored(docs.select(F.monotonically_increasing_id().alias("row"), *row_key(),
                              F.col("doc_id").cast("long").alias("doc_id"),
                              F.col("source").cast("string").alias("source"), size.alias("size")), "mix-sizes")
    by_source = {r["source"]: r["n"] for r in rows.groupBy("source").agg(F.sum("size").alias("n")).collect()}
    names = sorted((n for n in by_source if n is not None), key=lambda n: n.encode()) + [None] * (None in by_source)
    sizes = [by_source[n] for n in names]
    shares = targets(sizes, [weights[i % len(weights)] for i in range(len(names))], most)
    sources = [Source(i, n, t, block_words, seed) for i, (n, t) in enumerate(zip(sizes, shares))]
    lines = spark.createDataFrame(
        [(n, i, sizes[i], float(shares[i])) for i, n in enumerate(names)],
        T.StructType([T.StructField("line_source", T.StringType()), T.StructField("line", T.IntegerType()),
                      T.StructField("source_size", T.LongType()), T.StructField("target", T.DoubleType())]))
    documents = (rows.join(lines, F.col("source").eqNullSafe(F.col("line_source")))
                 .select("row", "k1", "k2", "doc_id", "source", "size", "line", "source_size", "target"))
    # the order of a source's words hangs on the rows alone, not on how they are read
    placed = with_offsets(documents.where("size > 0").select("row", "k1", "k2", "doc_id", "line", "size"),
                          "line", ["k1", "k2", "row"], "size", "start")
    begin, end = F.col("block") * block_words, (F.col("block") + 1) * block_words
    pieces = (placed.select("*", F.explode(F.sequence(
        F.floor(F.col("start") / block_words), F.floor((F.col("start") + F.col("size") - 1) / block_words))).alias("block"))
        .select("row", "doc_id", F.col("line").alias("source"), "block",
                F.greatest(begin - F.col("start"), F.lit(0)).alias("at"),
                F.greatest(F.col("start") - begin, F.lit(0)).alias("inside"),
                (F.least(end, F.col("start") + F.col("size")) - F.greatest(begin, F.col("start"))).alias("has")))
    slots = _slot_table(spark, sources, shard_slots, seed)
    mix = (slots.join(pieces, ["source", "block"])
           .select("shard", "place", "row", "doc_id", "at",
                   F.least("has", F.col("words") - F.col("inside")).alias("n_words"))
           .where("n_words > 0"))
    return documents, mix


def mix_sources(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST,
                block_words: int = BLOCK_WORDS, shard_slots: int = SHARD_SLOTS, seed: int = SEED) -> DataFrame:
    """One row per document: doc_id, size, source_size, target, taken, source.

    ``taken`` is the number of words that the mix takes from the document,
    repeats counted: at most ``most`` times its size, and together each source's
    target to the word.  Null texts have size 0; a null source comes last; repeated
    rows are documents of their own; reruns over the same rows agree.
    """
    documents, mix = mixed(docs, weights, most, block_words, shard_slots, seed)
    taken = mix.groupBy("row").agg(F.sum("n_words").alias("taken"))
    return (documents.join(taken, "row", "left")
            .select("doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).alias("taken"), "source"))
