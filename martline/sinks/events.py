"""Event tables that stay small to read (X1-X3): appends, snapshots and the markers between them.

The source job updates its registry and audit rows in place.  Here every change is an event row, and
a table is a folder of appends, one folder each.  After `COMPACT_AFTER` of them a snapshot is written: the
events that still decide the table's state.  A marker then names the snapshot and the appends that it
covers; a reader takes the newest marker's snapshot and the appends that it does not cover (the tail).

Every order of writes is safe to stop in.  A snapshot holds events as they are, and the states folded
from them (latest event, set of completed loads) do not change when an event is read twice.  So a
snapshot without its marker is no more than a copy, and two writers of one marker cannot both win: the
file is created once, the other gives up.  Covered appends are deleted a generation
later, so a reader that began with the marker before still finds its files.

The driver lists folder names only: the tail, the snapshot and one generation of covered appends.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Callable
from dataclasses import dataclass

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession

#: Appends after which a table is compacted.  A load makes two of the registry.
COMPACT_AFTER = 32
_MARKERS = "_markers"                       # hidden from Spark's file listing by its underscore
_MARKER_NAME = re.compile(r"(\d{12})\.json")


@dataclass(frozen=True)
class Marker:
    """Generation, its snapshot's folder, and the folders that this snapshot stands for."""

    number: int
    snapshot: str
    covered: frozenset[str]


@dataclass(frozen=True)
class EventTable:
    """Events of `schema` under `root`; `fold` keeps those that still decide the state."""

    spark: SparkSession
    root: str
    schema: str
    fold: Callable[[DataFrame], DataFrame] = DataFrame.distinct

    # -- folders ------------------------------------------------------------
    def _path(self, name: str = ""):
        return self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}" if name else self.root)

    def _fs(self):
        return self._path().getFileSystem(self.spark._jsparkSession.sessionState().newHadoopConf())

    def _names(self, folder: str = "") -> list[str]:
        fs, path = self._fs(), self._path(folder)
        return sorted(s.getPath().getName() for s in fs.listStatus(path)) if fs.exists(path) else []

    def _committed(self) -> list[str]:
        """Append and snapshot folders whose write ended."""
        fs = self._fs()
        return [n for n in self._names() if n.startswith("append=") and fs.exists(self._path(f"{n}/_SUCCESS"))]

    # -- markers ------------------------------------------------------------
    def markers(self) -> list[Marker]:
        """Markers on hand, oldest first; one whose write was cut off counts as none."""
        out = []
        for name in self._names(_MARKERS):
            found = _MARKER_NAME.fullmatch(name)
            text = self._read_text(f"{_MARKERS}/{name}") if found else ""
            try:
                body = json.loads(text)
            except ValueError:
                continue
            out.append(Marker(int(found[1]), body["snapshot"], frozenset(body["covered"])))
        return out

    def _read_text(self, name: str) -> str:
        stream = self._fs().open(self._path(name))
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()

    def _write_marker(self, marker: Marker) -> bool:
        """False when another writer has made this generation."""
        body = json.dumps({"snapshot": marker.snapshot, "covered": sorted(marker.covered)}).encode()
        try:
            stream = self._fs().create(self._path(f"{_MARKERS}/{marker.number:012d}.json"), False)
        except Py4JJavaError as error:
            if "FileAlreadyExists" in error.java_exception.getClass().getName():
                return False
            raise
        stream.write(body)
        stream.close()
        return True

    # -- the table ----------------------------------------------------------
    def append(self, events: DataFrame) -> str:
        """Write events; returns their folder."""
        folder = f"{self.root}/append=a{uuid.uuid4().hex}"
        events.write.parquet(folder)
        return folder

    def current(self) -> tuple[str | None, list[str]]:
        """Folder of the newest snapshot (None before the first) and the tail's folders."""
        markers = self.markers()
        newest = markers[-1] if markers else Marker(0, "", frozenset())
        tail = [n for n in self._committed()
                if n.startswith("append=a") and n not in newest.covered]
        return newest.snapshot or None, tail

    def read(self) -> DataFrame:
        """The events that decide the state: one snapshot and the tail."""
        snapshot, tail = self.current()
        folders = [f"{self.root}/{n}" for n in [snapshot, *tail] if n]
        if not folders:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*folders)

    def compact(self, after: int = COMPACT_AFTER) -> bool:
        """Write a snapshot and its marker once the tail has `after` appends, then delete what
        the marker before had covered.  False when there was nothing to do, or another writer was first."""
        markers = self.markers()
        snapshot, tail = self.current()
        if len(tail) < after:
            return False
        # a marker that was cut off keeps its number: the next one goes beyond it
        numbers = [int(m[1]) for m in map(_MARKER_NAME.fullmatch, self._names(_MARKERS)) if m]
        number = max(numbers, default=0) + 1
        name = f"append=s{number:012d}-{uuid.uuid4().hex}"
        self.fold(self.read()).write.parquet(f"{self.root}/{name}")
        # snapshots of writers that stopped, or gave up, are copies: they go with the rest
        others = {n for n in self._names() if n.startswith("append=s") and n != name}
        if not self._write_marker(Marker(number, name, frozenset({*tail, *others}))):
            return False
        self._vacuum(markers)
        return True

    def _vacuum(self, before: list[Marker]) -> None:
        """Delete the folders that the markers `before` the new one had covered, and the older of these markers."""
        fs, names = self._fs(), set(self._names())
        for marker in before:
            for name in marker.covered & names:
                fs.delete(self._path(name), True)
        for marker in before[:-1]:
            fs.delete(self._path(f"{_MARKERS}/{marker.number:012d}.json"), False)
