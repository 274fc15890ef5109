"""Sales CSV ingest: discovery (S6), header probe (S2), contract check (U2),
typed multi-header scan (S1, S3, P1, P2, P9) and a full-width landing write.

A CSV scan binds columns by position, so files whose headers differ in order
or content would silently swap values.  Here the files that a load takes are read
once, as lines that carry their file's header (`sales_scan`); each is split by
Spark's CSV parser and bound by name.  One plan serves any number of files and
of different headers, and files that the load does not take are not opened.

Why land before counting: the landing write reads every column once; all row
metrics come from the landed table.
"""

from __future__ import annotations

import sys
from dataclasses import dataclass
from functools import reduce

from pyspark import cloudpickle

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martline.contracts import MANDATORY_COLUMNS, SALES_SCHEMA
from martline.functions import base_name, typed_or_null
from martline.sources import sales_scan
from martline.sources.sales_scan import open_file

_CONTRACT_TYPES = {f.name: f.dataType for f in SALES_SCHEMA.fields}
# Bytes of a file that are searched for its header line; a longer one is no
# header of a sales file, and the file is rejected with that reason.
HEADER_BYTES = 1 << 20
# Appended to every line as one more field: where it comes back tells how many
# fields the line has.
_END = "\u0001end"
# What a line keeps beside its values while they are read.
_LINE = ("extra", "whole", "line", "file")

MANIFEST_SCHEMA = ("path string, file_size long, modified_at timestamp, header string, "
                   "columns array<string>, probe_error string")
LANDED_SCHEMA = T.StructType(SALES_SCHEMA.fields + [
    T.StructField("is_malformed", T.BooleanType()),
    T.StructField("raw_record", T.StringType()),
    T.StructField("source_file", T.StringType())])


# --------------------------------------------------------------------------
# Discovery and header probe
# --------------------------------------------------------------------------
def _empty_files(spark: SparkSession, root: str) -> DataFrame:
    """CSV files of zero bytes, which Spark's file sources do not list.  Only
    their names are held; the listing itself is streamed."""
    jvm = spark._jvm
    path = jvm.org.apache.hadoop.fs.Path(root)
    listing = path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).listFiles(path, True)
    found = []
    while listing.hasNext():
        status = listing.next()
        if status.getLen() == 0 and status.getPath().getName().endswith(".csv"):
            found.append((status.getPath().toUri().toString(), 0, status.getModificationTime()))
    rows = spark.createDataFrame(found, "path string, file_size long, ms long")
    return rows.select("path", "file_size", F.timestamp_millis("ms").alias("modified_at"))


def list_csv_files(spark: SparkSession, root: str) -> DataFrame:
    """Every `*.csv` file under `root` (recursively) with size and mtime.
    The binaryFile source is used for its listing only: without the
    `content` column no file body is read."""
    listed = (spark.read.format("binaryFile")
              .option("pathGlobFilter", "*.csv")
              .option("recursiveFileLookup", "true")
              .load(root)
              .select(F.col("_metadata.file_path").alias("path"), F.col("length").alias("file_size"),
                      F.col("modificationTime").alias("modified_at")))
    return listed.where("file_size > 0").unionByName(_empty_files(spark, root))


def _first_line(uri: str) -> str | None:
    """First line that is not blank; at most HEADER_BYTES are read."""
    rest, read, more = b"", 0, True
    with open_file(uri) as stream:
        while more:
            chunk = stream.read(1 << 16)
            read += len(chunk)
            more = bool(chunk) and read < HEADER_BYTES
            *lines, rest = (rest + chunk).split(b"\n")
            if not chunk:
                lines.append(rest)
            for line in lines:
                text = line.rstrip(b"\r").decode("utf-8-sig", errors="replace")
                if text.strip():
                    return text
    if read >= HEADER_BYTES:
        raise ValueError(f"no header line within the first {HEADER_BYTES} bytes")
    return None


def _names(header: str) -> list[str]:
    """Column names of a header line by the CSV rules of Spark's reader: quoted
    fields, blanks kept; names that occur twice, in whatever case, count as
    none of theirs (Spark numbers them), and so do empty ones."""
    import csv

    fields = next(csv.reader([header], escapechar="\\"))
    lower = [f.lower() for f in fields]
    return [f if f and lower.count(f.lower()) == 1 else f"{f or '_c'}{i}" for i, f in enumerate(fields)]


def _probe(batches):
    """Header of each file; a file that cannot be read gets its error text
    instead (it is rejected, the run goes on)."""
    for pdf in batches:
        headers, columns, errors = [], [], []
        for path in pdf["path"]:
            header, names, error = None, [], None
            try:
                header = _first_line(path)
                names = _names(header) if header is not None else []
            except Exception as exc:  # unreadable file: reject it, keep going
                error = f"{type(exc).__name__}: {exc}"
            headers.append(header)
            columns.append(names)
            errors.append(error)
        yield pdf.assign(header=headers, columns=columns, probe_error=errors)[
            ["path", "file_size", "modified_at", "header", "columns", "probe_error"]]


def probe_headers(files: DataFrame) -> DataFrame:
    """(path, size, mtime, header, columns) for every file; a distributed probe
    that reads one line per file.

    The probe is shipped to the Python workers by value (it needs only
    pandas and pyarrow there), so executors need not have this package
    installed or on their path."""
    for module in (sys.modules[__name__], sales_scan):
        cloudpickle.register_pickle_by_value(module)
    return files.select("path", "file_size", "modified_at").mapInPandas(_probe, MANIFEST_SCHEMA)


def validate_headers(manifest: DataFrame) -> DataFrame:
    """Contract check per file: missing / extra column names, accept flag.

    A file is accepted iff no mandatory name is missing (extra names and
    any order are fine); names are compared as they stand, blanks included.
    An empty or unreadable file has no columns and is rejected.
    """
    required = F.array(*[F.lit(c) for c in MANDATORY_COLUMNS])
    return (manifest
            .withColumn("missing_columns", F.array_sort(F.array_except(required, F.col("columns"))))
            .withColumn("extra_columns", F.array_sort(F.array_except(F.col("columns"), required)))
            .withColumn("accepted", (F.size("missing_columns") == 0) & F.col("probe_error").isNull())
            .withColumn("reason", F.when(F.col("probe_error").isNotNull(),
                                         F.concat(F.lit("unreadable: "), F.col("probe_error")))
                        .when(F.col("header").isNull(), F.lit("no header"))
                        .when(~F.col("accepted"),
                              F.concat(F.lit("missing columns: "),
                                       F.array_join("missing_columns", ","))))
            .withColumn("file_name", base_name("path")))


# --------------------------------------------------------------------------
# Typed scan
# --------------------------------------------------------------------------
def bind_lines(lines: DataFrame, widest: int) -> DataFrame:
    """Typed sales rows of `lines(value, source_file, n_columns, places, additional_column)`, as `sales_scan` reads them.

    A bad value becomes NULL and flags the row, as does a line with more or
    fewer fields than its header; flagged rows keep their raw text.  Blank lines
    are no rows; a line that repeats the header further down is a bad row.
    """
    text = F.rtrim(F.col("value"), F.lit("\r"))
    known = lines.where(F.trim(text) != "")
    shape = ", ".join(f"f{i} string" for i in range(widest + 1))
    fields = F.from_csv(F.concat(text, F.lit("," + _END)), shape)
    split = known.select("source_file", text.alias("line"), "n_columns", "places", "additional_column",
                         fields.alias("__f")).select(
        "*", F.array(*[F.col(f"__f.f{i}") for i in range(widest + 1)]).alias("__v"))
    whole = F.array_position("__v", _END) == F.col("n_columns") + 1

    # One projection a step: a value is looked up, then typed, then checked once.  In one
    # expression Spark would do each of them anew wherever the value is used.
    values = split.select(
        *[F.get("__v", F.get("places", F.lit(i))).alias(c) for i, c in enumerate(MANDATORY_COLUMNS)],
        F.col("additional_column").alias("__extra"),
        F.coalesce(whole, F.lit(False)).alias("__whole"), F.col("line").alias("__line"), F.col("source_file").alias("__file"))
    # the end mark is no value of a line that is too short
    own = values.select(*[F.when((F.col(c) != "") & (F.col(c) != _END), F.col(c)).alias(c) for c in MANDATORY_COLUMNS],
                        *[f"__{n}" for n in _LINE])
    typed = own.select(*[F.col(c).alias(f"__{c}") for c in MANDATORY_COLUMNS],
                       *[typed_or_null(c, _CONTRACT_TYPES[c]).alias(c) for c in MANDATORY_COLUMNS],
                       *[f"__{n}" for n in _LINE])
    unread = reduce(lambda a, b: a | b, [F.col(f"__{c}").isNotNull() & F.col(c).isNull() for c in MANDATORY_COLUMNS])
    rows = typed.select(
        *MANDATORY_COLUMNS, F.col("__extra").alias("additional_column"),
        (unread | ~F.col("__whole")).alias("is_malformed"), F.col("__line").alias("line"),
        F.col("__file").alias("source_file"))
    return rows.select(*[f.name for f in SALES_SCHEMA.fields], "is_malformed",
                       F.when(F.col("is_malformed"), F.col("line")).alias("raw_record"), "source_file")


@dataclass
class Ingest:
    manifest: DataFrame      # one row per file: header check result
    landed: DataFrame        # typed rows of accepted files, read from the landing table
    # rows / malformed rows counted during the landing write; None when no file was accepted
    observation: Observation | None


def ingest_sales(spark: SparkSession, root: str, landing: str,
                 choose=None) -> Ingest:
    """Validate every CSV under `root`, land accepted rows to Parquet at
    `landing`/rows and the file manifest at `landing`/manifest.

    `choose(files)` may narrow the listed files (path, file_size,
    modified_at) to those that this load is to take."""
    manifest_path, rows_path = f"{landing}/manifest", f"{landing}/rows"
    files = list_csv_files(spark, root)
    files = choose(files) if choose is not None else files
    validate_headers(probe_headers(files)).write.parquet(manifest_path)
    manifest = spark.read.parquet(manifest_path)
    widest = manifest.where("accepted").agg(F.max(F.size("columns")).alias("n")).first()["n"]
    obs = Observation("landing")
    if widest:
        (bind_lines(sales_scan.scan(spark, manifest_path), widest)
         .observe(obs, F.count(F.lit(1)).alias("rows"),
                  F.count_if(F.col("is_malformed")).alias("malformed"))
         .write.parquet(rows_path))
        landed = spark.read.schema(LANDED_SCHEMA).parquet(rows_path)
    else:
        obs = None
        landed = spark.createDataFrame([], LANDED_SCHEMA)
    return Ingest(manifest, landed, obs)
