"""Helpers shared by the corpus operators: byte views of Arrow columns, row keys, scratch tables."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from martline.session import scratch_path

#: White space of the word rule ``[^\x20\x09-\x0D]+`` (fixed by the contract).
WORD_PATTERN = r"[^\x20\x09-\x0D]+"


def byte_view(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string or binary column and its row offsets; a null row is empty."""
    if pa.types.is_string(column.type) or pa.types.is_binary(column.type):
        kind = np.int32
    else:
        column, kind = column.cast(pa.large_binary()), np.int64
    _, offsets, data = column.buffers()
    ends = np.frombuffer(offsets, kind)[column.offset:column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw, ends


def byte_texts(column: pa.Array) -> Iterator[bytes]:
    """Each row's whole text as bytes; a null is the empty text."""
    raw, ends = byte_view(column)
    view = memoryview(raw)
    for a, b in zip(ends[:-1].tolist(), ends[1:].tolist()):
        yield bytes(view[a:b])


def row_slices(ends: np.ndarray, limit: int) -> Iterator[tuple[int, int]]:
    """Consecutive row ranges of at most ``limit`` bytes each (one row may be longer)."""
    row, rows = 0, len(ends) - 1
    while row < rows:
        stop = max(row + 1, int(np.searchsorted(ends, ends[row] + limit, "right")) - 1)
        yield row, stop
        row = stop


def row_key() -> list[Column]:
    """Two 64-bit hashes ``k1, k2`` that identify a row by doc_id and text.

    Rows that repeat both are the same row for every operator here: whatever is
    decided about one holds for all its repeats.
    """
    ident = F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))
    text = F.coalesce(F.col("text"), F.lit(""))
    return [F.xxhash64(ident, text).alias("k1"),
            F.xxhash64(F.lit("row"), text, ident).alias("k2")]


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """The frame written to the shared scratch folder and read back (cuts lineage)."""
    spark = df.sparkSession
    path = scratch_path(spark, purpose)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


#: 64-bit words of a membership filter: a fixed 2 MB whatever the tables hold.
FILTER_WORDS = 1 << 18


def _bit(hash_: Column) -> tuple[Column, Column]:
    """Word and bit of a hash in a filter."""
    return (F.shiftrightunsigned(hash_, 6).bitwiseAND(FILTER_WORDS - 1).cast("int"),
            hash_.bitwiseAND(63).cast("int"))


def seen_filter(values: DataFrame, name: str) -> Callable[[Column], Column]:
    """A test whether a 64-bit hash may be among ``values``: true for all that are, and for few others.

    The filter is a bitmap of FILTER_WORDS longs, so its size is fixed; it only
    spares rows a shuffle, and an exact join must follow.
    """
    word, bit = _bit(F.col(name))
    used = (values.select(word.alias("word"), F.call_function("shiftleft", F.lit(1).cast("long"), bit).alias("bits"))
            .groupBy("word").agg(F.bit_or("bits").alias("bits")))
    full = values.sparkSession.range(FILTER_WORDS).join(used, F.col("id") == F.col("word"), "left")
    bits = full.agg(F.transform(
        F.sort_array(F.collect_list(F.struct("id", F.coalesce("bits", F.lit(0)).alias("bits")))),
        lambda x: x["bits"]).alias("bits")).scalar()

    def known(hash_: Column) -> Column:
        at, shift = _bit(hash_)
        return F.call_function("shiftright", F.get(bits, at), shift).bitwiseAND(1) == 1

    return known


def with_offsets(df: DataFrame, key: str, order: list[str], size: str, into: str) -> DataFrame:
    """Exclusive running sum of ``size`` within ``key`` in ``order``, without one task per key.

    Rows are range-partitioned by (key, order), so a hot key spreads over
    many tasks; each task sums its own stretch, and the few stretch totals give
    where every stretch begins.  ``order`` must be total within a key.
    """
    width = df.sparkSession.conf.get("spark.sql.shuffle.partitions")
    parted = (df.repartitionByRange(int(width), key, *order)
              .withColumn("stretch", F.spark_partition_id()))
    parted = stored(parted, "offsets")
    totals = parted.groupBy(key, "stretch").agg(F.sum(size).alias("stretch_sum"))
    before = Window.partitionBy(key).orderBy("stretch").rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select(F.col(key).alias("start_key"), F.col("stretch").alias("start_stretch"),
                           F.coalesce(F.sum("stretch_sum").over(before), F.lit(0)).alias("stretch_start"))
    within = (Window.partitionBy(key, "stretch").orderBy(*order)
              .rowsBetween(Window.unboundedPreceding, -1))
    local = parted.withColumn("local_start", F.coalesce(F.sum(size).over(within), F.lit(0)))
    return (local.join(starts, F.col(key).eqNullSafe(F.col("start_key"))
                       & (F.col("stretch") == F.col("start_stretch")))
            .withColumn(into, F.col("stretch_start") + F.col("local_start"))
            .drop("stretch", "stretch_start", "local_start", "start_key", "start_stretch"))
