"""Sales CSV files as a Spark data source (S1, S3): only the chosen files, each line with its own header.

A plain text scan takes folders: it opens every file that was ever delivered, and its lines have to be
joined to their headers by path.  This source takes the manifest of a load instead.  Its
partitions are planned from the accepted files' sizes, as Spark plans its own file scans: large files
are cut into byte ranges, small ones share a partition.  A range holds the lines that begin in
it, so no line is read twice or lost; a line carries the places of its file's columns, and the
header itself is known by its place, not by its text.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from martline.contracts import MANDATORY_COLUMNS

NAME = "sales_csv"
SCHEMA = "value string, source_file string, n_columns int, places array<int>, additional_column string"
#: Bytes of a partition, what opening a file counts as, bytes read at a time, and lines of a batch.
PARTITION_BYTES, OPEN_BYTES, CHUNK, BATCH_LINES = 64 << 20, 1 << 20, 4 << 20, 20_000


@dataclass(frozen=True)
class Range:
    """Bytes of one file, with what its header says: how many columns it names, where the
    mandatory ones are (from 0; -1: nowhere), and the names of the others."""

    path: str
    start: int
    end: int
    n_columns: int
    places: tuple[int, ...]
    additional: str | None


@dataclass
class Ranges(InputPartition):
    ranges: tuple[Range, ...]


def locate(uri: str):
    """Filesystem and path of a URI in Arrow's filesystem layer (local, HDFS, S3, GCS ...)."""
    import pyarrow.fs as pafs

    if uri.startswith("file:") and not uri.startswith("file://"):
        uri = "file://" + uri[len("file:"):]
    for hadoop_scheme in ("s3a://", "s3n://"):
        if uri.startswith(hadoop_scheme):
            uri = "s3://" + uri[len(hadoop_scheme):]
    return pafs.FileSystem.from_uri(uri)


def open_file(uri: str):
    fs, path = locate(uri)
    return fs.open_input_file(path)


def plan_ranges(files: list[tuple], partition_bytes: int = PARTITION_BYTES) -> list[Ranges]:
    """Partitions of about ``partition_bytes`` over (path, size, columns, extra_columns)."""
    out, held, room = [], [], partition_bytes
    for path, size, columns, extra in sorted(files, key=lambda f: -f[1]):
        for start in range(0, size, partition_bytes):
            piece = Range(path, start, min(size, start + partition_bytes), len(columns),
                          tuple(columns.index(c) if c in columns else -1 for c in MANDATORY_COLUMNS), ",".join(extra) or None)
            cost = piece.end - piece.start + OPEN_BYTES
            if held and cost > room:
                out.append(Ranges(tuple(held)))
                held, room = [], partition_bytes
            held.append(piece)
            room -= cost
    return [*out, Ranges(tuple(held))] if held else out


def lines_of(stream, start: int, end: int, chunk: int = CHUNK) -> Iterator[list[bytes]]:
    """The lines that begin in start..end of an open file, in lists, without their line ends.

    A line begins at the file's start or after a newline; the last one may run on beyond ``end``.
    """
    at = max(start - 1, 0)  # the byte before tells whether a line begins at ``start``
    stream.seek(at)
    begun, rest = start == 0, b""
    while at < end:
        data = stream.read(chunk)
        if not data:
            if begun and rest:
                yield [rest]
            return
        if not begun:
            cut = data.find(b"\n") + 1
            at += cut or len(data)
            if not cut:
                continue
            data, begun = data[cut:], True
        # ``rest`` begins at ``at``
        *lines, rest = (rest + data).split(b"\n")
        out = []
        for line in lines:
            if at >= end:
                break
            out.append(line)
            at += len(line) + 1
        if out:
            yield out


def without_header(lists: Iterator[list[bytes]]) -> Iterator[list[bytes]]:
    """Lines after a file's header, which is its first line that is not blank."""
    pending = True
    for lines in lists:
        if pending:
            found = next((i for i, line in enumerate(lines) if line.decode("utf-8-sig", "replace").strip()), None)
            if found is None:
                continue
            pending, lines = False, lines[found + 1:]
        yield lines


class SalesCsvReader(DataSourceReader):
    def __init__(self, options: dict):
        self._manifest = options["manifest"]
        self._bytes = int(options.get("partitionBytes", PARTITION_BYTES))
        self._tasks = int(options.get("tasks", 1))

    def partitions(self) -> list[Ranges]:
        """Planned once per scan from the manifest's accepted files; no file is opened."""
        import pyarrow.dataset as ds
        import pyarrow.fs as pafs

        uri = self._manifest if "://" in self._manifest else "file://" + self._manifest.removeprefix("file:")
        fs, path = pafs.FileSystem.from_uri(uri)
        table = ds.dataset(path, filesystem=fs, format="parquet").to_table(
            columns=["path", "file_size", "columns", "extra_columns"], filter=ds.field("accepted"))
        rows = list(zip(*(table.column(c).to_pylist() for c in ("path", "file_size", "columns", "extra_columns"))))
        # a small load spreads over the tasks, as in Spark's own file scans
        share = sum(row[1] + OPEN_BYTES for row in rows) // self._tasks + 1
        # an empty plan would make Spark read one partition of nothing
        return plan_ranges(rows, min(self._bytes, max(share, OPEN_BYTES))) or [Ranges(())]

    def read(self, partition: Ranges):
        import pyarrow as pa

        for r in partition.ranges:
            with open_file(r.path) as stream:
                lists = lines_of(stream, r.start, r.end)
                for lines in without_header(lists) if r.start == 0 else lists:
                    for at in range(0, len(lines), BATCH_LINES):
                        value = pa.array([x.decode("utf-8", "replace") for x in lines[at:at + BATCH_LINES]], pa.string())
                        n = len(value)
                        same = pa.repeat(0, n)
                        yield pa.RecordBatch.from_arrays(
                            [value, *[pa.array([x], kind).take(same) for x, kind in (
                                (r.path, pa.string()), (r.n_columns, pa.int32()),
                                (list(r.places), pa.list_(pa.int32())), (r.additional, pa.string()))]],
                            ["value", "source_file", "n_columns", "places", "additional_column"])


class SalesCsvSource(DataSource):
    """``spark.read.format("sales_csv").option("manifest", path)``; see ``scan``."""

    @classmethod
    def name(cls) -> str:
        return NAME

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return SalesCsvReader(self.options)


def scan(spark: SparkSession, manifest_path: str, partition_bytes: int = PARTITION_BYTES) -> DataFrame:
    """Lines of the accepted files of a written manifest, each with its file and what the file's header says
    (`Range`): value, source_file, n_columns, places, additional_column.  Names are looked up once a file, not once a line.

    The source is shipped by value, so executors need pyarrow, not this package.
    """
    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    spark.dataSource.register(SalesCsvSource)
    return (spark.read.format(NAME).option("manifest", manifest_path)
            .option("partitionBytes", str(partition_bytes))
            .option("tasks", spark.conf.get("spark.sql.shuffle.partitions")).load())
