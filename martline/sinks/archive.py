"""Archive of a batch load's files (K5, K4): a move in two phases that may stop anywhere.

1. *Intent*: a row per file with the place it is to go to, appended before anything moves.  Completed
   files come from the registry, not from a listing, so files of a load that stopped before
   its archive step are found too; rejected files come from the load's manifest.
2. *Move*: executors rename the files of all intents without an outcome, and the outcomes
   are appended.  A run that stops here leaves intents, which the next run carries out.

A move looks at both places first, so it may be tried any number of times, by a retried or
speculative task too.  Outcomes: `MOVED`; `MISSING` (neither place has the file: somebody removed it); `CHANGED`
(a file of another size lies at the old place: it is no file that was loaded, and stays).
A file whose move fails for another reason gets no outcome but its error in the report, and is tried again.

Places are unique per load, so equal names in different folders or loads never meet:
`<archive>/load_id=<id>/<path below the inbox>`.
"""

from __future__ import annotations

import sys

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martline.contracts import REGISTRY_INACTIVE
from martline.sinks.events import EventTable
from martline.sources import sales_scan
from martline.sources.sales_scan import locate

MOVE_SCHEMA = ("path string, target string, file_size long, load_id long, status string, error string, "
               "event_time timestamp_ntz")
INTENT, MOVED, MISSING, CHANGED, FAILED = "INTENT", "MOVED", "MISSING", "CHANGED", "FAILED"


def latest_moves(moves: DataFrame) -> DataFrame:
    """One row per file: its outcome, else its latest failure, else its intent."""
    names = [c.split()[0] for c in MOVE_SCHEMA.split(", ")]
    rank = F.when(F.col("status") == INTENT, 0).when(F.col("status") == FAILED, 1).otherwise(2)
    return (moves.groupBy("path").agg(F.max_by(F.struct(*names), F.struct(rank, "event_time")).alias("e"))
            .select("e.*"))


def move_table(spark: SparkSession, target_root: str) -> EventTable:
    return EventTable(spark, f"{target_root}/moves", MOVE_SCHEMA, latest_moves)


def _below(spark: SparkSession, root: str):
    """Path of a file below the inbox `root`, None where it lies elsewhere; schemes are written in several ways."""
    path = spark._jvm.org.apache.hadoop.fs.Path(root)
    fs = path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    inbox = fs.makeQualified(path).toUri().getPath().rstrip("/") + "/"
    plain = F.regexp_replace("path", "^[a-zA-Z][a-zA-Z0-9+.-]*:(//[^/]*)?", "")
    return F.when(F.startswith(plain, F.lit(inbox)), F.substring(plain, F.lit(len(inbox) + 1), F.length(plain)))


def intents(files: DataFrame, moves: DataFrame, source_root: str, archive_root: str, at) -> DataFrame:
    """Intents for the files (path, file_size, load_id) below `source_root` that have none yet."""
    below = _below(files.sparkSession, source_root)
    fresh = files.join(moves.select("path"), "path", "left_anti").withColumn("__below", below)
    return fresh.where(F.col("__below").isNotNull()).select(
        "path", F.concat(F.lit(archive_root.rstrip("/") + "/load_id="), F.col("load_id").cast("string"), F.lit("/"), "__below")
        .alias("target"), F.col("file_size").cast("long").alias("file_size"), "load_id", F.lit(INTENT).alias("status"),
        F.lit(None).cast("string").alias("error"), at.alias("event_time"))


def completed_files(registry_events: DataFrame) -> DataFrame:
    """Files (path, load_id) by the load that completed them first."""
    return (registry_events.where(F.col("status") == REGISTRY_INACTIVE).groupBy("path")
            .agg(F.min_by("load_id", F.struct("event_time", "load_id")).alias("load_id")))


def _size(fs, path: str) -> int | None:
    info = fs.get_file_info(path)
    return info.size if info.is_file else None


def move_file(source: str, target: str, size: int | None) -> str:
    """Bring one file to its place and return the outcome; safe to repeat.

    A place that has the whole file already keeps it: a copy that was cut off before it deleted
    the old file is finished, and a shorter one is written again."""
    import pyarrow.fs as pafs

    (fs, old), (to, new) = locate(source), locate(target)
    there, here = _size(to, new), _size(fs, old)
    if here is None:
        return MISSING if there is None else MOVED
    if size is not None and here != size:
        return CHANGED if there is None else MOVED
    if there == here:
        fs.delete_file(old)
        return MOVED
    to.create_dir(new.rsplit("/", 1)[0], recursive=True)
    if fs.equals(to):
        fs.move(old, new)
    else:
        pafs.copy_files(old, new, source_filesystem=fs, destination_filesystem=to)
        fs.delete_file(old)
    return MOVED


def _move(batches):
    for pdf in batches:
        status, errors = [], []
        for source, target, size in zip(pdf["path"], pdf["target"], pdf["file_size"]):
            for attempt in (1, 2):      # another attempt of this task may have been faster
                try:
                    outcome, error = move_file(source, target, None if size != size else int(size)), None
                    break
                except OSError as exc:
                    outcome, error = FAILED, f"{type(exc).__name__}: {exc}"
            status.append(outcome)
            errors.append(error)
        yield pdf.assign(status=status, error=errors)[["path", "target", "file_size", "load_id", "status", "error"]]


def carry_out(table: EventTable, at) -> DataFrame:
    """Move the files of all intents without an outcome; returns one row per tried file.

    The outcomes are written by the tasks that move, so a driver that stops loses no more than
    their commit, and the next run finds these files at their places."""
    spark = table.spark
    for module in (sys.modules[__name__], sales_scan):
        cloudpickle.register_pickle_by_value(module)
    due = latest_moves(table.read()).where(F.col("status").isin(INTENT, FAILED))
    shape = MOVE_SCHEMA.rsplit(", ", 1)[0]
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    done = (due.select("path", "target", "file_size", "load_id").repartition(tasks, "path")
            .mapInPandas(_move, shape).withColumn("event_time", at))
    return spark.read.schema(MOVE_SCHEMA).parquet(table.append(done))
