"""File registry (X1, X2, X8, P10, J6, A3): append-only status events
instead of INSERT/UPDATE on a staging table.

A file is known by its full path: equal base names in different folders are
different files.  It is registered active ('A') when a load picks it up and
inactive ('I') when the load completes; its current status is the latest event
(at equal times 'I' follows 'A').  Resume = files on hand whose current status
is still 'A' (a load that did not finish); new = files on hand never registered.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martline.contracts import REGISTRY_ACTIVE, REGISTRY_INACTIVE

EVENT_SCHEMA = ("file_id long, path string, file_name string, event_time timestamp_ntz, "
                "status string, load_id long")


def file_key(path_col: str = "path"):
    """Stable surrogate key from the natural key (no global row numbering)."""
    return F.xxhash64(F.col(path_col))


def _events(files: DataFrame, at, status: str, load_id) -> DataFrame:
    return files.select(file_key().alias("file_id"), "path", "file_name",
                        at.alias("event_time"), F.lit(status).alias("status"),
                        F.lit(load_id).cast("long").alias("load_id"))


def register_files(files: DataFrame, at, load_id=None) -> DataFrame:
    """'A' events for files a load starts on."""
    return _events(files, at, REGISTRY_ACTIVE, load_id)


def complete_files(files: DataFrame, at, load_id=None) -> DataFrame:
    """'I' events for files a load finished."""
    return _events(files, at, REGISTRY_INACTIVE, load_id)


def current_status(events: DataFrame) -> DataFrame:
    """Latest status per file: a grouped `max_by`, partial per task."""
    latest = F.struct("event_time", "status")   # 'I' sorts after 'A'
    return (events.groupBy("path")
            .agg(F.max_by("status", latest).alias("status"),
                 F.max("event_time").alias("last_event_time")))


def deciding_events(events: DataFrame) -> DataFrame:
    """The events that still say something: of a file that is active, its latest; of each load that
    completed a file, its completion.  All statuses and the set of completed loads stay as they were."""
    latest = F.struct("event_time", "status")
    names = [c.split()[0] for c in EVENT_SCHEMA.split(", ")]
    active = (events.groupBy("path").agg(F.max_by(F.struct(*names), latest).alias("e"))
              .select("e.*").where(F.col("status") == REGISTRY_ACTIVE))
    rest = [c for c in names if c not in ("path", "load_id")]
    completed = (events.where(F.col("status") == REGISTRY_INACTIVE).groupBy("path", "load_id")
                 .agg(F.max_by(F.struct(*rest), "event_time").alias("e")).select("path", "load_id", "e.*"))
    return active.unionByName(completed)


def resume_files(on_hand: DataFrame, events: DataFrame) -> DataFrame:
    """Files on hand whose latest registry status is still active."""
    active = current_status(events).where(F.col("status") == REGISTRY_ACTIVE)
    return active.join(on_hand.select("path").distinct(), "path", "left_semi")


def new_files(on_hand: DataFrame, events: DataFrame) -> DataFrame:
    """Files on hand with no registry event at all."""
    return on_hand.join(events.select("path"), "path", "left_anti")


def files_to_load(on_hand: DataFrame, events: DataFrame) -> DataFrame:
    """New and resumed files: everything on hand but what a load has completed."""
    done = current_status(events).where(F.col("status") == REGISTRY_INACTIVE)
    return on_hand.join(done.select("path"), "path", "left_anti")
