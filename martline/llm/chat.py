"""Chat formatting with cumulative-snapshot collapse.

A logged conversation that is the beginning of a longer one is an earlier snapshot
of it.  Rolling hashes of every turn prefix identify them; anti-joins keep the
maximal conversations, which are then rendered.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from martline.llm.common import stored, with_offsets

#: Turns rendered into one row; longer conversations return several parts.
PART_TURNS = 512


def _content(role: Column, text: Column) -> list[Column]:
    return [F.xxhash64(role, F.lit("|"), text).alias("h1"), F.xxhash64(F.lit("turn"), text, F.lit("|"), role).alias("h2")]


def prefixes(turns: DataFrame) -> DataFrame:
    """(conv_id, pos, p1, p2): the 128-bit hash of every conversation's first pos + 1 turns.

    ``turns(conv_id, turn, h1, h2)`` holds each turn once.  A prefix's hash is the
    exclusive or of its turns' hashes with their positions, so it can be gathered in stretches.
    A conversation that holds a third of all turns is spread over many tasks.
    """
    placed = with_offsets(turns.withColumn("one", F.lit(1).cast("long")), "conv_id", ["turn", "h1", "h2"], "one", "pos")
    mixed = placed.select("conv_id", "pos", "turn", "h1", "h2", F.floor(F.col("pos") / PART_TURNS).alias("stretch"),
                          F.xxhash64("pos", "h1", "h2").alias("x1"), F.xxhash64("h2", "pos", "h1").alias("x2"))
    totals = mixed.groupBy("conv_id", "stretch").agg(F.bit_xor("x1").alias("t1"), F.bit_xor("x2").alias("t2"))
    before = Window.partitionBy("conv_id").orderBy("stretch").rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select(F.col("conv_id").alias("start_id"), F.col("stretch").alias("start_stretch"),
                           F.coalesce(F.bit_xor("t1").over(before), F.lit(0)).alias("s1"),
                           F.coalesce(F.bit_xor("t2").over(before), F.lit(0)).alias("s2"))
    upto = (Window.partitionBy("conv_id", "stretch").orderBy("pos")
            .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    local = mixed.withColumn("l1", F.bit_xor("x1").over(upto)).withColumn("l2", F.bit_xor("x2").over(upto))
    return (local.join(starts, F.col("conv_id").eqNullSafe(F.col("start_id"))
                       & (F.col("stretch") == F.col("start_stretch")))
            .select("conv_id", "pos", "turn", "h1", "h2", F.col("l1").bitwiseXOR(F.col("s1")).alias("p1"),
                    F.col("l2").bitwiseXOR(F.col("s2")).alias("p2")))


def maximal(found: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(conversations that are no prefix of another, all with their length and hash).

    Of equal conversations the smallest id stays.
    """
    length = found.groupBy("conv_id").agg(F.max("pos").alias("last"))
    ends = (found.join(length.withColumnRenamed("conv_id", "end_id"),
                       F.col("conv_id").eqNullSafe(F.col("end_id")) & (F.col("pos") == F.col("last")))
            .select("conv_id", "pos", "p1", "p2"))
    ends = stored(ends, "chat-ends")
    inner = (found.join(length.withColumnRenamed("conv_id", "end_id"),
                        F.col("conv_id").eqNullSafe(F.col("end_id")) & (F.col("pos") < F.col("last")))
             .select("pos", "p1", "p2").distinct())
    whole = ends.groupBy("pos", "p1", "p2").agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("logged"))
    kept = whole.join(inner, ["pos", "p1", "p2"], "left_anti")
    return kept, whole


def chat_format(conversations: DataFrame, part_turns: int = PART_TURNS) -> DataFrame:
    """Rendered maximal conversations: conv_id, part, n_turns, n_collapsed, text.

    Turns are taken in the order of ``turn`` (nulls first, ties by content hash);
    rows that repeat a conversation's turn count once; null roles and texts are
    empty; rows with a null conv_id are one conversation.  A conversation of more
    than ``part_turns`` turns returns several parts, to be read one after the other,
    so no row grows without bound.  n_collapsed counts the logged conversations that
    are equal to it or a prefix of it.  A turn is rendered as
    ``<|im_start|>role newline text<|im_end|> newline``; ``<|`` inside roles and texts
    becomes ``< |``, so no text can end its turn.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    logged = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
                                  *_content(role, text), role.alias("role"), text.alias("text"))
    found = stored(prefixes(logged.select("conv_id", "turn", "h1", "h2").distinct()), "chat-prefixes")
    kept, whole = maximal(found)
    kept = stored(kept, "chat-kept")
    mine = (found.join(kept.select(F.col("conv_id").alias("kept_id"), F.col("pos").alias("kept_last")),
                       F.col("conv_id").eqNullSafe(F.col("kept_id"))))
    covered = (mine.join(whole.select("pos", "p1", "p2", "logged"), ["pos", "p1", "p2"])
               .groupBy("conv_id").agg((F.sum("logged") - 1).alias("n_collapsed")))
    plain = lambda c: F.replace(F.col(c), F.lit("<|"), F.lit("< |"))
    piece = F.concat(F.lit("<|im_start|>"), plain("role"), F.lit("\n"), plain("text"), F.lit("<|im_end|>\n"))
    place = mine.select(F.col("conv_id").alias("at_id"), F.col("turn").alias("at_turn"), F.col("h1").alias("at_h1"),
                        F.col("h2").alias("at_h2"), "pos", (F.col("kept_last") + 1).alias("n_turns"))
    rendered = (logged.join(place, F.col("conv_id").eqNullSafe(F.col("at_id")) & F.col("turn").eqNullSafe(F.col("at_turn"))
                            & (F.col("h1") == F.col("at_h1")) & (F.col("h2") == F.col("at_h2")))
                .groupBy("conv_id", "n_turns", F.floor(F.col("pos") / part_turns).cast("int").alias("part"))
                .agg(F.sort_array(F.collect_set(F.struct("pos", piece.alias("piece")))).alias("turns")))
    return (rendered.join(covered.withColumnRenamed("conv_id", "covered_id"),
                          F.col("conv_id").eqNullSafe(F.col("covered_id")))
            .select("conv_id", "part", "n_turns", "n_collapsed", F.array_join("turns.piece", "").alias("text")))
