"""The monthly marts kept up to date by a stream (T1 with A4, A5).

Landed sales are enriched and summed per output tuple in a stateful aggregation; every
micro-batch upserts the months that it touched.  The window of the state is the day on which
a sale *arrived*, not the day on which it was made: arrivals come in order, so the watermark
can close their days, and the state store holds the tuples of a day or two, however late
a sale is.  A late sale is a part of its old month in the window of today.

In update mode a changed tuple comes with its sum so far in its window.  The sums of a
batch are written as mergeable parts under the batch's number (a repeated attempt replaces
them); the newest of a window and tuple counts, and the parts of all windows add up
to the mart.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from martline.operators import enrich, quality
from martline.operators.marts import Mart
from martline.sinks import parquet as P
from martline.sources import csv_ingest as C

#: How far the arrival times of landed files may be out of order (clocks of different machines).
ARRIVAL_SLACK = "1 day"
#: Files that a micro-batch writes of the parts of one month, so a large month is no single task.
FILES_A_MONTH = 4


def landed_stream(spark: SparkSession, landed_dir: str, max_files_per_trigger: int = 1000) -> DataFrame:
    """Stream of the rows that `file_ingest` has landed, each with the time it arrived."""
    return (spark.readStream.schema(C.LANDED_SCHEMA).option("maxFilesPerTrigger", max_files_per_trigger)
            .parquet(f"{landed_dir}/rows")
            .select(*C.LANDED_SCHEMA.names, F.col("_metadata.file_modification_time").alias("arrived_at")))


def arriving_parts(landed: DataFrame, dims: dict[str, DataFrame], mart: Mart) -> DataFrame:
    """Sum so far of every tuple and arrival day, from the state store."""
    usable = landed.where(quality.usable_sale()).withWatermark("arrived_at", ARRIVAL_SLACK)
    rich = enrich.enrich_sales(usable, dims["dim_customer"], dims["dim_store"], dims["dim_sales_team"],
                               extra=["arrived_at"])
    return (mart.prepare(rich, extra=["arrived_at"])
            .groupBy(F.window("arrived_at", "1 day").alias("day"), *mart.keys, *mart.variants)
            .agg(F.sum("total_cost").alias("part"))
            .select(F.col("day.start").alias("arrived_on"), *mart.keys, *mart.variants, "part"))


def newest(parts: DataFrame, mart: Mart) -> DataFrame:
    """The last sum of every tuple and arrival day: later batches have summed on from earlier ones."""
    return (parts.groupBy("arrived_on", *mart.keys, *mart.variants)
            .agg(F.max_by("part", "load_id").alias("part")).drop("arrived_on"))


def _upsert(spark: SparkSession, changed: DataFrame, batch_id: int, mart: Mart, root: str) -> None:
    """One micro-batch: its parts, then the months that it touched, whole.

    A stream's own session has no AQE, which would size the writes (`rebalance`): the parts are dealt out by
    month here, or each task of the state would write a file in each month; the months are made in the
    session `spark` that started the stream.  The driver holds the touched months, of which a calendar has few."""
    parts_root = f"{root}/{mart.name}_parts"
    slot = F.pmod(F.hash(*mart.keys, *mart.variants), F.lit(FILES_A_MONTH))
    P.publish_parts(changed.repartition("month", slot), parts_root, batch_id)
    folders = spark.read.schema(P.parts_schema(changed.schema)).parquet(parts_root)
    touched = P.months_of(folders.where(F.col("load_id") == batch_id))
    if touched:
        parts = P.read_parts(spark, parts_root, changed.schema, touched)
        P.refresh_months(mart.of_parts(newest(parts, mart)), f"{root}/{mart.name}", mart.month_column)


def start(landed: DataFrame, dims: dict[str, DataFrame], mart: Mart, root: str, checkpoint_dir: str,
          **trigger) -> StreamingQuery:
    """Keep `root`/<mart name> up to date; one query and one checkpoint per mart."""
    return (arriving_parts(landed, dims, mart).writeStream.outputMode("update")
            .foreachBatch(lambda changed, batch_id: _upsert(landed.sparkSession, changed, batch_id, mart, root))
            .option("checkpointLocation", checkpoint_dir)
            .trigger(**(trigger or {"availableNow": True}))
            .start())


def dropped_rows(query: StreamingQuery) -> int:
    """Rows that came after their arrival day was closed, in the progress that the query still holds."""
    return sum(state["numRowsDroppedByWatermark"] for p in query.recentProgress for state in p["stateOperators"])


def run_available(landed: DataFrame, dims: dict[str, DataFrame], mart: Mart, root: str,
                  checkpoint_dir: str) -> StreamingQuery:
    """Take in everything that has landed, then stop; rows dropped by the watermark are an error."""
    query = start(landed, dims, mart, root, checkpoint_dir)
    query.awaitTermination()
    if dropped_rows(query):
        raise RuntimeError(f"{dropped_rows(query)} sales arrived more than {ARRIVAL_SLACK} out of order")
    return query
