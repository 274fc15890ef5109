"""Benchmark decontamination by spaced-seed hashing, in DataFrame operations only.

Each mask looks at some positions of a window of tokens and ignores the others, so
a substituted token does not change the hashes of the masks that ignore it.  With
one mask more than substitutions are allowed, every overlap agrees with its
benchmark item in at least one mask: training and test hashes are joined, and the
windows around each hit are compared token by token.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martline.llm.common import row_key, seen_filter, stored

#: Tokens of a window, and substitutions that an overlap may hold.
WINDOW, SUBSTITUTIONS = 13, 2
TOKEN_PATTERN = r"[\p{L}\p{N}]+"


def masks(window: int, substitutions: int) -> list[list[int]]:
    """Positions each mask looks at: every (substitutions + 1)th, from another start."""
    step = substitutions + 1
    return [list(range(first, window, step)) for first in range(min(step, window))]


def _tokens(text: Column) -> Column:
    """64-bit hashes of a text's lower-case tokens, in order."""
    words = F.regexp_extract_all(F.lower(F.coalesce(text.cast("string"), F.lit(""))), F.lit(TOKEN_PATTERN), F.lit(0))
    return F.transform(words, lambda w: F.xxhash64(w))


def _seeds(tokens: Column, at: Column, windows: dict[int, int]) -> list[Column]:
    """One (mask, hash) per mask of every window length; null where the window passes the end."""
    out = []
    for width, allowed in sorted(windows.items()):
        for number, looked in enumerate(masks(width, allowed)):
            seed = F.xxhash64(F.lit(width * 100 + number), *[F.get(tokens, at + p) for p in looked])
            out.append((width * 100 + number, width, F.when(at + width <= F.size(tokens), seed)))
    return out


def overlaps(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW,
             substitutions: int = SUBSTITUTIONS) -> DataFrame:
    """(k1, k2, doc_id, item_id, width, pos, changed): windows of documents that overlap an item.

    A window is ``window`` tokens with at most ``substitutions`` changed ones; an
    item of fewer tokens must occur whole and unchanged.
    """
    items = (benchmark.select(F.col("item_id").cast("long").alias("item_id"), _tokens(F.col("text")).alias("tokens"))
             .where(F.size("tokens") > 0).withColumn("width", F.least(F.size("tokens"), F.lit(window))))
    items = stored(items, "benchmark")
    # at most ``window`` different lengths
    widths = [r["width"] for r in items.select("width").distinct().collect()]
    windows = {w: substitutions if w == window else 0 for w in widths}
    starts = F.explode(F.sequence(F.lit(0), F.size("tokens") - F.col("width")))
    test_windows = items.select("item_id", "tokens", "width", starts.alias("at"))
    test_seeds = F.array(*[F.struct(F.lit(n).alias("mask"), F.when(F.col("width") == w, s).alias("seed"))
                           for n, w, s in _seeds(F.col("tokens"), F.col("at"), windows)])
    test = None
    if windows:
        test = stored(test_windows.select("item_id", "width", F.slice("tokens", F.col("at") + 1, F.col("width")).alias("item_window"),
                                          F.explode(test_seeds).alias("s"))
                      .select("item_id", "width", "item_window", "s.mask", "s.seed").where("seed is not null").distinct(),
                      "benchmark-seeds")
    shape = "k1 long, k2 long, doc_id long, item_id long, width int, pos int, changed int"
    if test is None:
        return docs.sparkSession.createDataFrame([], shape)

    known = seen_filter(test, "seed")
    plain = docs.select(*row_key(), F.col("doc_id").cast("long").alias("doc_id"), _tokens(F.col("text")).alias("tokens"))
    # explode of a null gives no row: shorter documents end here, and no filter makes Spark tokenise twice
    span = F.size("tokens") - min(windows)
    at_all = plain.select("*", F.explode(F.when(span >= 0, F.sequence(F.lit(0), span))).alias("pos"))
    seeds = _seeds(F.col("tokens"), F.col("pos"), windows)

    hit = None
    for _, _, seed in seeds:
        hit = known(seed) if hit is None else hit | known(seed)
    # few windows pass the filter; only they leave the task, each with its own tokens
    near = at_all.where(hit).select("k1", "k2", "doc_id", "pos",
                                    F.slice("tokens", F.col("pos") + 1, window).alias("doc_window"),
                                    F.explode(F.array(*[F.struct(F.lit(n).alias("mask"), s.alias("seed"))
                                                        for n, _, s in seeds])).alias("s"))
    near = near.select("k1", "k2", "doc_id", "pos", "doc_window", "s.mask", "s.seed").where("seed is not null")
    pairs = F.zip_with(F.slice("doc_window", F.lit(1), F.col("width")), "item_window",
                       lambda a, b: F.when(a == b, 0).otherwise(1))
    changed = F.aggregate(pairs, F.lit(0), lambda n, x: n + x)
    allowed = F.when(F.col("width") == window, substitutions).otherwise(0)
    return (near.join(test, ["mask", "seed"])
            .withColumn("changed", changed).where(F.col("changed") <= allowed)
            .select("k1", "k2", "doc_id", "item_id", "width", "pos", "changed"))


def contaminated(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW,
                 substitutions: int = SUBSTITUTIONS) -> DataFrame:
    """One row per document and benchmark item that overlap.

    doc_id, item_id, n_windows (different window starts in the document),
    first_token, last_token (of the document's tokens that a window covers, from 0), least_changed.
    Null and empty texts and items overlap nothing.  Rows that repeat doc_id and text
    are one document, items that repeat an id are one item; other columns are ignored.
    """
    found = overlaps(docs, benchmark, window, substitutions)
    # a window meets an item by several masks and places: it counts once
    once = found.groupBy("k1", "k2", "doc_id", "item_id", "pos").agg(F.min("changed").alias("changed"),
                                                                    F.max("width").alias("width"))
    return (once.groupBy("k1", "k2", "doc_id", "item_id")
            .agg(F.count("*").alias("n_windows"), F.min("pos").alias("first_token"),
                 (F.max(F.col("pos") + F.col("width")) - 1).alias("last_token"), F.min("changed").alias("least_changed"))
            .drop("k1", "k2"))


def keep_clean(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW,
               substitutions: int = SUBSTITUTIONS) -> DataFrame:
    """The documents without any overlap, all columns unchanged."""
    found = (stored(overlaps(docs, benchmark, window, substitutions).select("k1", "k2").distinct(), "contaminated")
             .select(F.col("k1").alias("hit_k1"), F.col("k2").alias("hit_k2")))
    names = docs.columns
    keyed = docs.select(F.struct(*[docs[f"`{c}`"] for c in names]).alias("row"), *row_key())
    return (keyed.join(found, (F.col("k1") == F.col("hit_k1")) & (F.col("k2") == F.col("hit_k2")), "left_anti")
            .select(*[F.col("row").getField(c).alias(c) for c in names]))
