"""Wiring of the operators into Structured Streaming: log streams in, all sinks, merged tables, counters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from changeflow.operators.layout import laid_out
from changeflow.operators.messages import send_messages
from changeflow.operators.relational import last_operations, merge_into
from changeflow.operators.state import ORDER, compacted, first_by_key, latest_by_key

HEADER = T.StructType([T.StructField("key", T.StringType()), T.StructField("value", T.StringType())])
RECORD = T.StructType([
    T.StructField("seq_num", T.LongType()), T.StructField("timestamp", T.LongType()), T.StructField("headers", T.ArrayType(HEADER)),
    T.StructField("body", T.BinaryType()), T.StructField("stream", T.StringType()),
])


def read_log_stream(spark: SparkSession, path: str, *, schema: T.StructType = RECORD, files_per_batch: int | None = None) -> DataFrame:
    """Records of a Parquet log with ``stream=`` directories; streams that appear later are found.

    Positions are Spark's own: a checkpoint remembers what was read, a failed batch is read again.
    """
    reader = spark.readStream.schema(schema)
    if files_per_batch is not None:
        if files_per_batch < 1:
            raise ValueError("files_per_batch must be 1 or more")
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path)


def _started(writer, checkpoint: str, trigger: dict | None) -> StreamingQuery:
    """``trigger`` as Spark's own, such as ``{"processingTime": "10 seconds"}``; without it, all that is there and then an end."""
    return writer.option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()


def write_log_stream(records: DataFrame, path: str, checkpoint: str, *, trigger: dict | None = None) -> StreamingQuery:
    """Append records to a Parquet log; a batch counts as done once all its files are committed."""
    return _started(records.writeStream.format("parquet").partitionBy("stream").option("path", path), checkpoint, trigger)


def batch_stream(rows: DataFrame, write: Callable[[DataFrame], None], checkpoint: str, *, trigger: dict | None = None) -> StreamingQuery:
    """Hands each batch to a batch sink. A batch that failed comes again, so a sink gets rows at least once."""
    return _started(rows.writeStream.foreachBatch(lambda batch, _: write(batch)), checkpoint, trigger)


def parquet_stream(rows: DataFrame, path: str, checkpoint: str, *, partition_columns: str | None = None, exact_paths: bool = False, trigger: dict | None = None) -> StreamingQuery:
    """Parquet files in Hive layout, each row once."""
    rows, names = laid_out(rows, partition_columns, exact_paths)
    return _started(rows.writeStream.format("parquet").partitionBy(*names).option("path", path), checkpoint, trigger)


def message_stream(rows: DataFrame, sender: Callable[[], Callable], checkpoint: str, *, size: int = 10, retries: int = 5, trigger: dict | None = None) -> StreamingQuery:
    """Rows as queue messages."""
    return batch_stream(rows, lambda batch: send_messages(batch, sender, size=size, retries=retries), checkpoint, trigger=trigger)


def relational_stream(changes: DataFrame, stage_and_merge: Callable[[DataFrame], None], keys: list[str], checkpoint: str, *, on_conflict: str = "update", order: tuple[str, ...] = ORDER, trigger: dict | None = None) -> StreamingQuery:
    """One row a key of each batch, with its order: for ``stage`` and the statements, or the MERGE of a table format.

    Records of one key that come in several batches in another order need a merge that compares the order; ``append_changes`` does.
    """
    return batch_stream(changes, lambda batch: stage_and_merge(last_operations(batch, keys, on_conflict=on_conflict, order=order)), checkpoint, trigger=trigger)


def relational_merge_stream(changes: DataFrame, url: str, table: str, keys: list[str], checkpoint: str, *, trigger: dict | None = None, **options) -> StreamingQuery:
    """Each batch merged into a table of a relational database; ``options`` are those of ``merge_into``.

    A batch that comes again is merged again, which changes nothing with ``on_conflict="update"``.
    """
    return batch_stream(changes, lambda batch: merge_into(batch, url, table, keys, **options), checkpoint, trigger=trigger)


def append_changes(changes: DataFrame, path: str, checkpoint: str, *, trigger: dict | None = None) -> StreamingQuery:
    """A keyed table that is merged when it is read: changes are appended, each once, and ``merged`` folds them.

    The result doesn't depend on the order in which files, streams or batches come, since each row brings its own.
    """
    return _started(changes.writeStream.format("parquet").option("path", path), checkpoint, trigger)


def merged(log: DataFrame, keys: list[str], *, on_conflict: str = "update", order: tuple[str, ...] = ORDER) -> DataFrame:
    """The rows of a table of appended changes."""
    return (latest_by_key if on_conflict == "update" else first_by_key)(log, keys, order=order)


def compact(log: DataFrame, path: str, keys: list[str], *, on_conflict: str = "update", order: tuple[str, ...] = ORDER) -> None:
    """Write the changes that still count to a new folder.

    It covers the files that ``log`` had when it was defined (``log.inputFiles()``). Changes appended to the old folder
    meanwhile are not in it: read them too, or stop the stream before and let it append to the new folder after.
    """
    compacted(log, keys, on_conflict=on_conflict, order=order).write.parquet(path)


class Counters(StreamingQueryListener):
    """Sums the observed metrics of streaming queries: ``totals[query][observation][metric]``.

    A query is known by its name, or by its id, which its checkpoint keeps over restarts. Two queries that use one observation
    name are counted apart; ``total`` adds them up. For counters that outlive the driver there is the ledger.
    """

    def __init__(self, report: Callable[[dict], None] | None = None):
        self.totals: dict[str, dict[str, dict[str, int]]] = {}
        self.report = report

    def total(self, observation: str, metric: str) -> int:
        """A metric over all queries."""
        return sum(mine.get(observation, {}).get(metric, 0) for mine in self.totals.values())

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        query = self.totals.setdefault(event.progress.name or str(event.progress.id), {})
        for name, row in event.progress.observedMetrics.items():
            mine = query.setdefault(name, {})
            for metric, value in row.asDict().items():
                mine[metric] = mine.get(metric, 0) + (value or 0)
        if self.report is not None:
            self.report(self.totals)
