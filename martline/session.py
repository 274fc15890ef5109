"""Session construction (tests, bench) and the shared scratch location."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

# Settings every martline job relies on.  AQE lets Spark re-plan joins with
# measured sizes and split skewed shuffle partitions at runtime.
RUNTIME_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}


def build_session(app: str = "martline", cores: int | str = "*",
                  shuffle_partitions: int | None = None,
                  extra: dict[str, str] | None = None) -> SparkSession:
    """Local session for tests and the bench; on a cluster use the provided one."""
    builder = (SparkSession.builder.master(f"local[{cores}]").appName(app)
               .config("spark.ui.enabled", "false")
               .config("spark.driver.memory", "8g")
               .config("spark.sql.shuffle.partitions",
                       str(shuffle_partitions or (os.cpu_count() if cores == "*" else cores))))
    for key, value in {**RUNTIME_CONF, **(extra or {})}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def app_id(spark: SparkSession) -> str:
    """Identifier of the running application (classic or Connect session)."""
    return spark.conf.get("spark.app.id", None) or f"session-{id(spark)}"


def _context_checkpoint_dir(spark: SparkSession):
    try:
        return spark.sparkContext.getCheckpointDir()
    except Exception:  # Spark Connect: no SparkContext
        return None


def shared_root(spark: SparkSession) -> str:
    """Shared folder for lineage cuts and intermediate tables.

    On a cluster this is ``spark.checkpoint.dir`` (a location every executor
    can reach).  Only when the session has none, as in local tests, is a
    fresh local folder created and registered.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or _context_checkpoint_dir(spark)
    if not root:
        if not spark.conf.get("spark.master", "").startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        root = tempfile.mkdtemp(prefix="martline-")
        spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


def scratch_path(spark: SparkSession, purpose: str) -> str:
    """A new, unique path under the shared root; never reused, never cleared."""
    return f"{shared_root(spark)}/martline/{purpose}/{uuid.uuid4().hex}"


def written(df: DataFrame, purpose: str) -> DataFrame:
    """The frame written to the shared root once and read back: for results that a
    plan reads on several sides, and to cut lineage where every executor finds it again."""
    path = scratch_path(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def together(spark: SparkSession, *writes: Callable[[], object]) -> list:
    """Run writes that do not depend on each other at the same time: the last tasks of one share the
    cores with the first of another.  All end before the first error, in their order, is raised."""
    with ThreadPoolExecutor(len(writes)) as pool:
        running = [pool.submit(inheritable_thread_target(spark)(write)) for write in writes]
    return [r.result() for r in running]
