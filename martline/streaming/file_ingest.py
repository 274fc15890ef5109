"""Incremental file ingest (T1, K5) with Structured Streaming.

The source job decides "which files are new" by hand (a registry it updates
with SQL) and moves processed files to an archive prefix.  The file stream
source does both: its checkpointed log gives "each file once", and
`cleanSource=archive` moves consumed files to an archive directory.
`trigger(availableNow=True)` makes a scheduled run process everything that
arrived since the previous run, in bounded micro-batches, and then stop.

Every micro-batch goes through the same header check and binding by name as the
batch ingest, so a file with another column order cannot swap values.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from martline.sources import csv_ingest as C
from martline.sources import sales_scan


#: What Spark's binaryFile source returns (fixed by Spark).
_BINARY_FILE = "path string, modificationTime timestamp, length long, content binary"


def sales_file_stream(spark: SparkSession, source_glob: str, archive_dir: str | None = None,
                      max_files_per_trigger: int = 1000) -> DataFrame:
    """Stream of new sales CSV files: path, size and time.

    The binaryFile source is used for its log of files only: without its
    `content` column no file body is read."""
    reader = (spark.readStream.format("binaryFile").schema(_BINARY_FILE)
              .option("maxFilesPerTrigger", max_files_per_trigger))
    if archive_dir is not None:
        reader = (reader.option("cleanSource", "archive")
                  .option("sourceArchiveDir", archive_dir))
    return reader.load(source_glob).select(
        F.col("_metadata.file_path").alias("path"), F.col("length").alias("file_size"),
        F.col("modificationTime").alias("modified_at"))


def _complete(spark: SparkSession, folder: str) -> bool:
    mark = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/_SUCCESS")
    return mark.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).exists(mark)


def _land(files: DataFrame, batch_id: int, sink_dir: str) -> None:
    """One micro-batch: header check of its files, then one scan of the accepted ones.

    Rows and manifest replace those of an interrupted attempt at the same batch.  A batch whose rows
    are all there stays as it is (a batch of one number always holds the same files), so a
    stream that has read them never sees them again under other names."""
    spark = files.sparkSession
    if _complete(spark, f"{sink_dir}/rows/batch_id={batch_id}"):
        return
    manifest_path = f"{sink_dir}/manifest/batch_id={batch_id}"
    C.validate_headers(C.probe_headers(files)).write.mode("overwrite").parquet(manifest_path)
    manifest = spark.read.parquet(manifest_path)
    widest = manifest.where("accepted").agg(F.max(F.size("columns")).alias("n")).first()["n"]
    rows = (C.bind_lines(sales_scan.scan(spark, manifest_path), widest) if widest
            else spark.createDataFrame([], C.LANDED_SCHEMA))
    rows.write.mode("overwrite").parquet(f"{sink_dir}/rows/batch_id={batch_id}")


def read_landed(spark: SparkSession, sink_dir: str) -> DataFrame:
    """All landed rows of a stream's sink."""
    return spark.read.schema(C.LANDED_SCHEMA).parquet(f"{sink_dir}/rows")


def start(stream: DataFrame, sink_dir: str, checkpoint_dir: str, **trigger) -> StreamingQuery:
    """Start the ingest; rows land under `sink_dir`/rows, file checks under `sink_dir`/manifest.

    A batch has a folder of its own that a repeated attempt overwrites, and the checkpoint
    records consumed files, so a rerun after a crash neither loses nor duplicates rows."""
    return (stream.writeStream
            .foreachBatch(lambda files, batch_id: _land(files, batch_id, sink_dir))
            .option("checkpointLocation", checkpoint_dir)
            .trigger(**(trigger or {"availableNow": True}))
            .start())


def run_available(stream: DataFrame, sink_dir: str, checkpoint_dir: str,
                  timeout_sec: float | None = None) -> StreamingQuery:
    """Land everything available now, then stop."""
    query = start(stream, sink_dir, checkpoint_dir)
    query.awaitTermination(timeout_sec)
    return query
