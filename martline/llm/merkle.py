"""Merkle manifest of a document table, checked leaf by leaf by a recursive query.

Every document is a leaf; FANOUT consecutive nodes are hashed into their parent, level
by level, first within each language and then over the languages' subroots.  The built levels
are stored as node rows that name their parent.  A recursive query of Spark then climbs
from every leaf: each step joins the parent's row, appends the siblings it holds, and folds
the (possibly tampered) hash with them.

The leaves of one run share every sibling above the run, so they climb as one row that
holds their hashes side by side: the frontier has an eighth of the leaves' rows.  The upper
nodes would be hot keys of the climb's join, so a node has one row for each block of
runs below it, and no key of the join meets more than BLOCK runs.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from martline.llm.common import stored, with_offsets

#: Children of a node, and runs that meet one row of a node.
FANOUT, BLOCK = 8, 4096
#: Bytes of a digest.
DIGEST = 32
#: The tree over the subroots; a language's tree is "=" and its name, "-" for null.
TOP = ""


def _digest(text: Column) -> Column:
    """SHA-256 of a text as 32 bytes."""
    return F.unhex(F.sha2(text, 256))


def _lower_hex(value: Column) -> Column:
    return F.lower(F.hex(value))


def _field(value: Column) -> Column:
    """A leaf's part: byte count, colon and value; a dash for null."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaves(docs: DataFrame) -> DataFrame:
    """(tree, lang, doc_id, idx, width, leaf, offered): each document's place among its language's and its
    digests, untampered and as offered.

    Rows that repeat a document follow each other.  Texts are read once and don't leave their task.
    """
    doc_id, n_chars = (F.col(c).cast("long") for c in ("doc_id", "n_chars"))
    text, lang = F.col("text").cast("string"), F.col("lang").cast("string")
    tampered = F.crc32(doc_id.cast("string")) % 3 == 0
    lowered = F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")

    def leaf(content: Column) -> Column:
        return _digest(F.concat(_field(doc_id), _field(F.col("source")), _field(lang), _field(n_chars), _field(content)))

    plain = docs.select(F.coalesce(F.concat(F.lit("="), lang), F.lit("-")).alias("tree"), lang.alias("lang"),
                        doc_id.alias("doc_id"), leaf(text).alias("leaf"),
                        F.when(tampered, leaf(lowered)).alias("changed"), F.monotonically_increasing_id().alias("row"),
                        F.lit(1).cast("long").alias("one"))
    # stored, because dealing rows out by range reads them twice
    placed = stored(with_offsets(stored(plain, "merkle-digests"), "tree", ["doc_id", "leaf", "row"], "one", "idx"),
                    "merkle-leaves")
    width = stored(placed.groupBy("tree").agg(F.count("*").alias("width")), "merkle-widths")
    return (placed.join(width, "tree")
            .select("tree", "lang", "doc_id", "idx", "width", "leaf", F.coalesce("changed", "leaf").alias("offered")))


def _level(below: DataFrame) -> DataFrame:
    """The parents of all nodes of trees that have several nodes left: (tree, level, idx, width, kids, digest)."""
    kids = F.transform(F.sort_array(F.collect_list(F.struct("idx", "digest"))), lambda x: _lower_hex(x["digest"]))
    return (below.where("width > 1").groupBy("tree", F.floor(F.col("idx") / FANOUT).alias("idx"))
            .agg((F.max("level") + 1).alias("level"), F.ceil(F.max("width") / FANOUT).alias("width"),
                 F.array_join(kids, "").alias("text"))
            .select("tree", "level", "idx", "width", F.unhex("text").alias("kids"), _digest(F.col("text")).alias("digest")))


def _levels(nodes: DataFrame) -> DataFrame:
    """The nodes (tree, level, idx, width, digest) and all levels above them, each stored as it is built."""
    now = nodes.withColumn("kids", F.lit(None).cast("binary"))
    every = now
    # one number comes back; as many rounds follow as its logarithm
    most = now.agg(F.max("width")).first()[0] or 0
    while most > 1:
        now = stored(_level(now), "merkle-level")
        every, most = every.unionByName(now), -(-most // FANOUT)
    return every


def _climbed(spark: SparkSession, runs: DataFrame, nodes: DataFrame) -> DataFrame:
    """(tree, run, folded, proof) of every run at the root: the recursive climb."""
    name = uuid.uuid4().hex
    runs.createOrReplaceTempView(f"merkle_runs_{name}")
    nodes.createOrReplaceTempView(f"merkle_nodes_{name}")
    kept = spark.conf.get("spark.sql.cteRecursionRowLimit")
    spark.conf.set("spark.sql.cteRecursionRowLimit", "-1")  # the climb has a row for each run and level
    try:
        return stored(spark.sql(f"""
            WITH RECURSIVE climb (tree, run, block, up_tree, up_level, up_idx, slot, folded, proof) AS (
                SELECT tree, run, block, up_tree, up_level, up_idx, slot, folded, proof FROM merkle_runs_{name}
                UNION ALL
                SELECT c.tree, c.run, c.block, n.up_tree, n.up_level, n.up_idx, n.slot,
                       transform(c.folded, x -> unhex(sha2(lower(hex(concat(
                           substring(n.kids, 1, {DIGEST} * c.slot), x,
                           substring(n.kids, {DIGEST} * c.slot + {DIGEST + 1})))), 256))),
                       concat(c.proof, substring(n.kids, 1, {DIGEST} * c.slot),
                              substring(n.kids, {DIGEST} * c.slot + {DIGEST + 1}))
                FROM climb c JOIN merkle_nodes_{name} n
                  ON c.up_tree = n.tree AND c.up_level = n.level AND c.up_idx = n.idx
                     AND c.tree = n.run_tree AND c.block = n.block)
            SELECT tree, run, folded, proof FROM climb WHERE up_tree IS NULL"""), "merkle-climbed")
    finally:
        spark.conf.set("spark.sql.cteRecursionRowLimit", kept)
        spark.catalog.dropTempView(f"merkle_runs_{name}")
        spark.catalog.dropTempView(f"merkle_nodes_{name}")


def verify(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, leaf, subroot, root, proof_sha256, folded_root, verified.

    A leaf is the digest of doc_id, source, lang, n_chars and text.  Leaves of a language are
    ordered by doc_id (nulls first), then by digest; rows that repeat a document are leaves of their own.  Null languages are
    one language, the first.  A table's only leaf is its own subroot and root, with
    the proof of no siblings.  Documents whose crc32 of the id's digits is divisible by three
    are offered with A-Z lower-cased; a null id has no digits and a null text stays.  Other columns are ignored.
    """
    spark = docs.sparkSession
    low = leaves(docs).withColumn("level", F.lit(0))
    # a run: FANOUT leaves (one, if a language has no more) with all that its documents need in the end
    members = F.sort_array(F.collect_list(F.struct("idx", "doc_id", "leaf", "offered")))
    runs = stored(low.groupBy("tree", F.floor(F.col("idx") / FANOUT).alias("run"))
                  .agg(F.max("lang").alias("lang"), F.max("width").alias("leaves"), members.alias("members"))
                  .withColumn("kids", F.array_join(F.transform("members.leaf", _lower_hex), ""))
                  .withColumn("digest", F.when(F.col("leaves") == 1, F.col("members")[0]["leaf"]).otherwise(_digest(F.col("kids"))))
                  .drop("kids"), "merkle-runs")
    first = runs.select("tree", F.lit(1).alias("level"), F.col("run").alias("idx"),
                        F.ceil(F.col("leaves") / FANOUT).alias("width"), "digest")
    lower = _levels(first)
    # languages in order: their place among the subroots
    tops = lower.where("width = 1").join(runs.where("run = 0").select(F.col("tree").alias("of"), "lang", "leaves"),
                                         F.col("tree") == F.col("of"))
    ranked = with_offsets(tops.select("tree", "lang", "leaves", "digest", F.lit(TOP).alias("top"),
                                      F.lit(1).cast("long").alias("one")), "top", ["lang"], "one", "place")
    subroots = stored(ranked.select("tree", "leaves", F.col("digest").alias("subroot"), "place"), "merkle-subroots")
    trees = subroots.count()
    upper = _levels(subroots.select(F.lit(TOP).alias("tree"), F.lit(0).alias("level"), F.col("place").alias("idx"),
                                    F.lit(trees).cast("long").alias("width"), F.col("subroot").alias("digest")))
    root = upper.where("width = 1").agg(F.first("digest")).first()[0]

    def pointed(nodes: DataFrame, above: DataFrame) -> DataFrame:
        """Nodes with their parent: in their own tree, above it, or none."""
        inner = nodes.where("width > 1").select("*", F.col("tree").alias("up_tree"), (F.col("level") + 1).alias("up_level"),
                                                F.floor(F.col("idx") / FANOUT).alias("up_idx"), (F.col("idx") % FANOUT).cast("int").alias("slot"))
        outer = nodes.where("width = 1").join(above, F.col("tree") == F.col("above_of"), "left").drop("above_of")
        return inner.unionByName(outer)

    above = subroots.select(F.col("tree").alias("above_of"), F.lit(TOP).alias("up_tree"), F.lit(1).alias("up_level"),
                            F.floor(F.col("place") / FANOUT).alias("up_idx"), (F.col("place") % FANOUT).cast("int").alias("slot"))
    above = above if trees > 1 else above.limit(0)
    runs_of = F.ceil(F.col("leaves") / FANOUT)
    blocks = subroots.select(F.col("tree").alias("run_tree"), "place", runs_of.alias("runs"))
    # a node's rows: one for each block of runs below it
    span = F.expr(f"CAST(power({FANOUT}, level - 1) AS BIGINT)")
    own = (pointed(lower.where("level > 1"), above).join(blocks.drop("place"), F.col("tree") == F.col("run_tree"))
           .withColumn("block", F.explode(F.sequence(F.floor(F.col("idx") * span / BLOCK), F.floor(
               (F.least((F.col("idx") + 1) * span, F.col("runs")) - 1) / BLOCK)))).drop("runs", "digest"))
    # the top tree's nodes: a row for each block of every tree below
    over = blocks.select("run_tree", "place", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("runs") - 1) / BLOCK))).alias("block"))
    heights = pointed(upper.where("level > 0"), above.limit(0))
    levels = [r["level"] for r in heights.select("level").distinct().collect()]  # a logarithm of the trees
    tall = over.withColumn("at_level", F.explode(F.array(*[F.lit(n) for n in levels]) if levels else F.expr("array_repeat(0, 0)")))
    tall = tall.select("run_tree", "block", "at_level", F.floor(
        F.col("place") / F.pow(F.lit(float(FANOUT)), F.col("at_level"))).alias("at_idx"))
    joint = (tall.join(heights, (F.col("at_level") == F.col("level")) & (F.col("at_idx") == F.col("idx")))
             .drop("at_level", "at_idx", "digest"))
    nodes = stored(own.unionByName(joint).drop("width"), "merkle-nodes")

    anchor = pointed(runs.select("tree", F.lit(1).alias("level"), F.col("run").alias("idx"), runs_of.alias("width"),
                                 "leaves", "members"), above)
    whole = F.transform("members.leaf", _lower_hex)
    folded = F.transform(F.sequence(F.lit(0), F.size("members") - 1), lambda i: _digest(F.concat(
        F.array_join(F.slice(whole, F.lit(1), i), ""), _lower_hex(F.col("members")[i]["offered"]),
        F.array_join(F.slice(whole, i + 2, F.size("members")), ""))))
    folded = F.when(F.col("leaves") == 1, F.col("members.offered")).otherwise(folded)
    start = anchor.select("tree", F.col("idx").alias("run"), F.floor(F.col("idx") / BLOCK).alias("block"), "up_tree", "up_level",
                          "up_idx", "slot", folded.alias("folded"), F.unhex(F.lit("")).alias("proof"))
    climbed = _climbed(spark, start, nodes).select(F.col("tree").alias("c_tree"), F.col("run").alias("c_run"), "folded", "proof")

    # every document from its run: siblings within the run, then those of the climb
    at_end = (runs.join(climbed, (F.col("tree") == F.col("c_tree")) & (F.col("run") == F.col("c_run")))
              .join(subroots.select(F.col("tree").alias("s_tree"), "subroot"), F.col("tree") == F.col("s_tree"))
              .select("subroot", "proof", "folded", F.col("members.leaf").alias("all"), F.posexplode("members").alias("i", "m")))
    beside = F.concat(F.array_join(F.transform(F.slice("all", F.lit(1), F.col("i")), _lower_hex), ""),
                      F.array_join(F.transform(F.slice("all", F.col("i") + 2, F.lit(FANOUT)), _lower_hex), ""))
    return at_end.withColumn("root", F.lit(root)).select(
        F.col("m.doc_id").alias("doc_id"), _lower_hex(F.col("m.leaf")).alias("leaf"), _lower_hex(F.col("subroot")).alias("subroot"),
        _lower_hex(F.col("root")).alias("root"), F.sha2(F.concat(beside, _lower_hex(F.col("proof"))), 256).alias("proof_sha256"),
        _lower_hex(F.get("folded", F.col("i"))).alias("folded_root"),
        (F.get("folded", F.col("i")) == F.col("root")).alias("verified"))
