"""Logs as a Spark data source, for batches and streams: ``spark.readStream.format("changeflow_log")`` after ``register(spark)``.

A stream's position is a number for each log stream, kept in Spark's checkpoint. A batch has at most ``batch_size`` rows over all
log streams, dealt evenly; log streams that appear while the query runs are found and start where ``start_position`` says.

Options: ``path``; ``streams`` (a comma list), ``stream_prefix``, at least one of them; ``start_position`` (``earliest`` or
``latest``); ``batch_size`` (1000); ``positions``, saved ones as JSON, ``{"stream": next_seq}``; ``log``, ``package.module:callable``
that makes another kind of log from the options, with the two methods of ``ParquetLog``.
"""

from __future__ import annotations

import importlib
import json
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import unquote

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

NAME = "changeflow_log"
SCHEMA = "stream string, seq_num long, timestamp long, headers array<struct<key:string,value:string>>, body binary"
_HEADERS = pa.list_(pa.struct([("key", pa.string()), ("value", pa.string())]))
_ARROW = pa.schema([("stream", pa.string()), ("seq_num", pa.int64()), ("timestamp", pa.int64()), ("headers", _HEADERS), ("body", pa.binary())])
LARGEST = 2**63 - 1


@dataclass
class Piece(InputPartition):
    """Records of one stream from ``start`` up to ``stop``, and where the log has them."""

    stream: str
    start: int
    stop: int
    places: tuple


class ParquetLog:
    """A folder of Parquet files with ``stream=`` directories, on any file system that pyarrow knows by its URI."""

    def __init__(self, options: dict[str, str]):
        if "path" not in options:
            raise ValueError("give the path of the log")
        path = options["path"].rstrip("/")
        self.system, self.root = fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)
        self.known: dict[str, tuple[int, int] | None] = {}

    def extents(self, wanted) -> dict[str, list[tuple[int, int, str]]]:
        """(first, last + 1, file) of every file of the wanted streams. A file's footer is read once, as files never change."""
        found: dict[str, list] = {}
        for d in self.system.get_file_info(fs.FileSelector(self.root, allow_not_found=True)):
            name = d.base_name
            if d.type != fs.FileType.Directory or not name.startswith("stream=") or not wanted(stream := unquote(name.removeprefix("stream="))):
                continue
            mine = found.setdefault(stream, [])
            for f in self.system.get_file_info(fs.FileSelector(d.path, recursive=True)):
                if f.is_file and f.base_name[0] not in "._":
                    if f.path not in self.known:
                        self.known[f.path] = self._extent(f.path)
                    if extent := self.known[f.path]:
                        mine.append((*extent, f.path))
        return found

    def _extent(self, path: str) -> tuple[int, int] | None:
        file = pq.ParquetFile(path, filesystem=self.system)
        if not file.metadata.num_rows:
            return None
        at = file.schema_arrow.get_field_index("seq_num")
        groups = [file.metadata.row_group(k).column(at).statistics for k in range(file.metadata.num_row_groups)]
        if any(s is None or not s.has_min_max for s in groups):
            seen = file.read(["seq_num"]).column(0)
            return pc.min(seen).as_py(), pc.max(seen).as_py() + 1
        return min(s.min for s in groups), max(s.max for s in groups) + 1

    def read(self, piece: Piece) -> Iterator[pa.RecordBatch]:
        for path in piece.places:
            file = pq.ParquetFile(path, filesystem=self.system)
            there = [n for n in _ARROW.names if n in file.schema_arrow.names]
            for batch in file.iter_batches(columns=there):
                seq = batch.column(there.index("seq_num"))
                batch = batch.filter(pc.and_(pc.greater_equal(seq, piece.start), pc.less(seq, piece.stop)))
                if batch.num_rows:
                    columns = {n: batch.column(k) for k, n in enumerate(there)} | {"stream": pa.array([piece.stream] * batch.num_rows, pa.string())}
                    yield pa.RecordBatch.from_arrays([columns[f.name].cast(f.type) if f.name in columns else pa.nulls(batch.num_rows, f.type) for f in _ARROW], schema=_ARROW)


def _log(options: dict[str, str]):
    if "log" not in options:
        return ParquetLog(options)
    module, _, name = options["log"].partition(":")
    return getattr(importlib.import_module(module), name)(options)


@dataclass
class Selection:
    """The options, checked."""

    named: tuple[str, ...]
    prefix: str
    latest: bool
    size: int
    saved: dict[str, int]

    @classmethod
    def of(cls, options: dict[str, str]) -> Selection:
        named = tuple(dict.fromkeys(s.strip() for s in options.get("streams", "").split(",") if s.strip()))
        prefix, start, size = options.get("stream_prefix", ""), options.get("start_position", "earliest"), int(options.get("batch_size", "1000"))
        if not named and not prefix:
            raise ValueError("give streams or stream_prefix")
        if start not in ("earliest", "latest"):
            raise ValueError(f"start_position must be earliest or latest, not {start!r}")
        if size < 1:
            raise ValueError("batch_size must be 1 or more")
        return cls(named, prefix, start == "latest", size, {k: int(v) for k, v in json.loads(options.get("positions", "{}")).items()})

    def wants(self, stream: str) -> bool:
        return stream in self.named or bool(self.prefix) and stream.startswith(self.prefix)

    def start_of(self, stream: str, extents: list[tuple]) -> int:
        return self.saved.get(stream, max((e[1] for e in extents), default=0) if self.latest else 0)


class _Batch(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.log, self.selection = _log(options), Selection.of(options)

    def partitions(self) -> list[Piece]:
        found = self.log.extents(self.selection.wants)
        # A file is a task's work.
        return [Piece(s, self.selection.start_of(s, e), LARGEST, (x[2],)) for s, e in found.items() for x in e if x[1] > self.selection.start_of(s, e)] or [Piece("", 0, 0, ())]

    def read(self, partition: Piece) -> Iterator[pa.RecordBatch]:
        yield from self.log.read(partition)


class _Stream(DataSourceStreamReader):
    def __init__(self, options: dict[str, str]):
        self.log, self.selection = _log(options), Selection.of(options)
        self.at: dict[str, int] | None = None

    def initialOffset(self) -> dict[str, int]:
        found = self.log.extents(self.selection.wants)
        return {s: self.selection.start_of(s, found.get(s, [])) for s in sorted({*found, *self.selection.named})}

    def latestOffset(self) -> dict[str, int]:
        """The next position of each stream: ``batch_size`` rows further at most."""
        at = self.initialOffset() if self.at is None else dict(self.at)
        found = self.log.extents(self.selection.wants)
        for stream in found.keys() - at.keys():
            # It is entered at its start in this batch and read from the next one on, so that a repeated batch is the same.
            at[stream] = self.selection.start_of(stream, found[stream])
        known = self.at or {}
        at = {s: p for s, p in at.items() if s in found or s in self.selection.named}  # a removed stream's position goes
        waiting = {s: max((e[1] for e in found.get(s, [])), default=0) - at[s] for s in at if self.at is None or s in known}
        left, waiting = self.selection.size, {s: n for s, n in waiting.items() if n > 0}
        for turn, stream in enumerate(sorted(waiting, key=waiting.get)):
            step = min(waiting[stream], left // (len(waiting) - turn) or (left > 0))
            at[stream] += step
            left -= step
        self.at = at
        return dict(at)

    def partitions(self, start: dict[str, int], end: dict[str, int]) -> list[Piece]:
        if self.at is None:  # the last batch before a restart, or the one that is repeated
            self.at = dict(end)
        found = self.log.extents(self.selection.wants)
        pieces = []
        for stream, stop in end.items():
            first = start.get(stream, stop)
            places = tuple(e[2] for e in found.get(stream, []) if e[0] < stop and e[1] > first)
            if first < stop and places:
                pieces.append(Piece(stream, first, stop, places))
        return pieces or [Piece("", 0, 0, ())]

    def read(self, partition: Piece) -> Iterator[pa.RecordBatch]:
        yield from self.log.read(partition)

    def commit(self, end: dict[str, int]) -> None:
        """Spark's checkpoint is the record of what is done."""


class LogSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return NAME

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> _Batch:
        return _Batch(dict(self.options))

    def streamReader(self, schema) -> _Stream:
        return _Stream(dict(self.options))


def register(spark: SparkSession) -> None:
    spark.dataSource.register(LogSource)
