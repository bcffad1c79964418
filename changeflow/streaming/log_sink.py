"""A log as a sink of Spark's: tasks stage, the driver publishes a batch once.

``df.write.format("changeflow_log_sink").mode("append").option("path", p).save()``, or ``writeStream`` with it, after ``register(spark)``.
Rows need a ``stream``; all their columns are kept. A task writes Parquet files below ``_staging``, which no reader looks
at, and tells the driver their names. The driver writes down what a batch consists of, in one file that appears whole, and
then moves the files below ``stream=`` directories. A batch that comes again finds that list and finishes it, whatever
its tasks staged anew; rows never go through the driver. A task that fails leaves nothing but staged files.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from dataclasses import dataclass, field
from urllib.parse import quote

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceStreamArrowWriter, WriterCommitMessage

NAME = "changeflow_log_sink"
#: Rows of one stream that a file has at most, and streams that a task keeps files open for.
FILE_ROWS, OPEN = 5_000_000, 64


@dataclass
class Staged(WriterCommitMessage):
    """Files of a task: (stream, name below ``_staging``, rows)."""

    files: list[tuple[str, str, int]] = field(default_factory=list)


class Folder:
    """The log's folder on any file system that pyarrow knows by its URI."""

    def __init__(self, options: dict[str, str]):
        if "path" not in options:
            raise ValueError("give the path of the log")
        path = options["path"].rstrip("/")
        self.system, self.root = fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)

    def exists(self, path: str) -> bool:
        return self.system.get_file_info(path).type != fs.FileType.NotFound

    def stage(self, batches: Iterator[pa.RecordBatch]) -> Staged:
        made, writers = Staged(), {}
        folder = f"{self.root}/_staging"
        self.system.create_dir(folder, recursive=True)

        def close(stream: str) -> None:
            name, writer, rows = writers.pop(stream)
            writer.close()
            made.files.append((stream, name, rows))

        try:
            for batch in batches:
                streams = batch.column(batch.schema.get_field_index("stream"))
                for stream in sorted(x for x in streams.unique().to_pylist() if x is not None):
                    part = batch.filter(pa.compute.equal(streams, stream)).drop_columns(["stream"])
                    if stream in writers and writers[stream][2] + part.num_rows > FILE_ROWS:
                        close(stream)
                    if stream not in writers:
                        if len(writers) >= OPEN:
                            close(min(writers, key=lambda s: writers[s][2]))
                        name = f"{uuid.uuid4().hex}.parquet"
                        writers[stream] = [name, pq.ParquetWriter(f"{folder}/{name}", part.schema, filesystem=self.system), 0]
                    writers[stream][1].write_batch(part)
                    writers[stream][2] += part.num_rows
                if streams.null_count:
                    raise ValueError("a record without a stream")
        finally:
            for stream in list(writers):
                close(stream)
        return made

    def publish(self, batch: str, messages: list[Staged | None]) -> None:
        """Move a batch's files into place; what a batch consists of is decided once."""
        listed = f"{self.root}/_batches/{batch}.json"
        mine = [f for m in messages if m is not None for f in m.files]
        if not self.exists(listed):
            self.system.create_dir(f"{self.root}/_batches", recursive=True)
            draft = f"{self.root}/_batches/.{uuid.uuid4().hex}"
            with self.system.open_output_stream(draft) as out:
                out.write(json.dumps(mine).encode())
            self.system.move(draft, listed)
        with self.system.open_input_stream(listed) as given:
            wanted = [tuple(f) for f in json.loads(given.read())]
        for k, (stream, name, _) in enumerate(wanted):
            folder = f"{self.root}/stream={quote(stream, safe='')}"
            target, source = f"{folder}/{batch}-{k:05}.parquet", f"{self.root}/_staging/{name}"
            if not self.exists(target) and self.exists(source):
                self.system.create_dir(folder, recursive=True)
                self.system.move(source, target)
        self.drop([f for f in mine if tuple(f) not in wanted])

    def drop(self, files: list) -> None:
        for _, name, _ in files:
            if self.exists(f"{self.root}/_staging/{name}"):
                self.system.delete_file(f"{self.root}/_staging/{name}")


class _Sink:
    def __init__(self, options: dict[str, str], schema):
        if "stream" not in schema.names:
            raise ValueError(f"no column 'stream'; there are {', '.join(schema.names)}")
        self.folder = Folder(options)
        self.prefix = options.get("batch_prefix", "batch")

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Staged:
        return self.folder.stage(iterator)


class _StreamSink(_Sink, DataSourceStreamArrowWriter):
    def commit(self, messages, batchId: int) -> None:  # noqa: N803
        self.folder.publish(f"{self.prefix}-{batchId:012}", messages)

    def abort(self, messages, batchId: int) -> None:  # noqa: N803
        self.folder.drop([f for m in messages if m is not None for f in m.files])


class _BatchSink(_Sink, DataSourceArrowWriter):
    def commit(self, messages) -> None:
        self.folder.publish(f"once-{uuid.uuid4().hex}", messages)

    def abort(self, messages) -> None:
        self.folder.drop([f for m in messages if m is not None for f in m.files])


class LogSink(DataSource):
    """Options: ``path``; ``batch_prefix``, a name of its own for each query that writes to one log."""

    @classmethod
    def name(cls) -> str:
        return NAME

    def writer(self, schema, overwrite: bool) -> _BatchSink:
        if overwrite:
            raise ValueError("a log is appended to")
        return _BatchSink(dict(self.options), schema)

    def streamWriter(self, schema, overwrite: bool) -> _StreamSink:
        return _StreamSink(dict(self.options), schema)


def register(spark: SparkSession) -> None:
    spark.dataSource.register(LogSink)
