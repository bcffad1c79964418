"""A durable ledger of progress: what each batch of a query reached and counted, readable as a table.

A batch's rows are in a folder named after the query and the batch, written over when the batch comes again: it counts once,
and a restarted query goes on counting. Spark's checkpoint stays what a query resumes from; the ledger tells others.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from changeflow.operators.progress import LARGEST
from changeflow.streaming.streams import _started

LEDGER = "query string, batch long, stream string, next_seq long, n_rows long, counters map<string,long>"


def entries(batch: DataFrame, counters: dict[str, Column], *, stream: str = "stream", seq: str = "seq_num") -> DataFrame:
    """``stream, next_seq, n_rows, counters`` of a batch's rows; a counter counts the rows where its condition holds."""
    last = F.max(seq)
    named = F.create_map(*(x for n, c in counters.items() for x in (F.lit(n), F.count_if(c)))) if counters else F.create_map().cast("map<string,long>")
    return batch.groupBy(F.col(stream).alias("stream")).agg(
        F.when(last == LARGEST, last).otherwise(last + 1).cast("long").alias("next_seq"), F.count("*").alias("n_rows"), named.alias("counters")
    )


def ledger_stream(rows: DataFrame, write: Callable[[DataFrame, int], None], ledger: str, checkpoint: str, *, counters: dict[str, Column] | None = None, stream: str = "stream", seq: str = "seq_num",
                  trigger: dict | None = None) -> StreamingQuery:
    """Each batch is written by ``write(batch, batch_id)`` and then entered; a batch that fails in between is done again as a whole.

    The batch is kept (in memory or on executors' disks) between the two, so that its source is read once.
    """
    def both(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        query = spark.sparkContext.getLocalProperty("sql.streaming.queryId")
        batch = batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            write(batch, batch_id)
            entries(batch, counters or {}, stream=stream, seq=seq).coalesce(1).write.mode("overwrite").parquet(f"{ledger.rstrip('/')}/query={query}/batch={batch_id}")
        finally:
            batch.unpersist()

    return _started(rows.writeStream.foreachBatch(both), checkpoint, trigger)


def read_ledger(spark: SparkSession, ledger: str) -> DataFrame:
    return spark.read.schema(LEDGER).parquet(ledger)


def ledger_positions(entered: DataFrame) -> DataFrame:
    """``stream, next_seq``: what ``positions`` of all rows gives."""
    return entered.groupBy("stream").agg(F.max("next_seq").alias("next_seq"))


def ledger_totals(entered: DataFrame, by: tuple[str, ...] = ("query",)) -> DataFrame:
    """``by, counter, total`` over all batches; ``rows`` counts all of them."""
    named = F.explode(F.map_concat(F.create_map(F.lit("rows"), F.col("n_rows")), "counters")).alias("counter", "value")
    return entered.select(*by, named).groupBy(*by, "counter").agg(F.sum("value").alias("total"))
