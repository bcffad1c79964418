"""Rows as messages and log records: JSON bodies, batches, routing."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from changeflow.functions.columns import encode_op, relational_cell, require_op, route_name, row_json
from changeflow.functions.schema import OP
from changeflow.operators.ranges import numbered, runs


def row_to_json(df: DataFrame, *, include_op: bool = True, op_col: str = OP, u256: tuple[str, ...] = ()) -> DataFrame:
    """``body``: one JSON object a row without its nulls; bytes as hex, 256-bit numbers as decimal text."""
    return df.select(row_json([f for f in df.schema.fields if include_op or f.name != op_col], u256).alias("body"))


def render_relational(df: DataFrame) -> DataFrame:
    """All columns as a relational statement wants them."""
    return df.select(*(relational_cell(f.name, f.dataType).alias(f.name) for f in df.schema.fields))


def to_log_records(df: DataFrame, *, stream: str | None = None, template: str | None = None, op_col: str = OP, max_bytes: int = 1048575, keep: tuple[str, ...] = (), u256: tuple[str, ...] = ()) -> DataFrame:
    """``stream, headers, body``: the row without its operation as JSON, the operation as header ``dbz.op``.

    Rows go to one stream or to the one that the template names. A body over ``max_bytes`` is an error.
    """
    if (stream is None) == (template is None):
        raise ValueError("give stream or template, one of them")
    require_op(df, op_col)
    fields = [f for f in df.schema.fields if f.name != op_col and f.name not in keep]
    body = row_json(fields, u256)
    name = F.lit(stream) if template is None else route_name(template, df.columns)
    code = encode_op(F.col(op_col))
    rows = df.select(name.alias("stream"), F.array(F.struct(F.lit("dbz.op").alias("key"), code.alias("value"))).alias("headers"), body.alias("body"), *keep)
    fail = F.raise_error(F.concat(F.lit("record of "), F.octet_length("body").cast("string"), F.lit(f" bytes; the limit is {max_bytes}"))).cast("string")
    return rows.withColumn("body", F.when(F.octet_length("body") > max_bytes, fail).otherwise(F.col("body")))


def route(df: DataFrame, template: str, *, as_col: str = "stream") -> DataFrame:
    return df.withColumn(as_col, route_name(template, df.columns))


def route_runs(df: DataFrame, *, order: tuple[str, ...], by: tuple[str, ...] = (), ranges: int | None = None) -> DataFrame:
    """``by, stream, first, last, n_rows``: neighbours of one stream in the order, within each group of ``by`` (a source
    partition, for example), or of all rows as one sequence. ``order`` begins with a number or time.
    """
    if not order:
        raise ValueError("runs need an order")
    return runs(df, "stream", list(by), list(order), ranges=ranges)


def message_batches(df: DataFrame, size: int = 10, *, by: str | None = None, order: tuple[str, ...] = (), ranges: int | None = None) -> DataFrame:
    """``[by,] batch, bodies``: JSON messages of whole rows in groups of at most ``size``.

    Batches are cut within partitions. With ``by`` each value's rows are numbered in ``order`` (which begins with a number or time),
    and all its batches but the last are full; one value may have all rows, as its numbering is dealt to ranges.
    """
    if by is None:
        def cut(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            held: list[str] = []
            for frame in frames:
                held += frame["body"].tolist()
                full = len(held) // size
                if full:
                    yield pd.DataFrame({"bodies": [held[k * size : (k + 1) * size] for k in range(full)]})
                    held = held[full * size :]
            if held:
                yield pd.DataFrame({"bodies": [held]})

        return row_to_json(df).mapInPandas(cut, "bodies array<string>")
    at = numbered(df, [by], list(order), as_col="_at", ranges=ranges)
    bodies = at.select(F.col(by), row_json(df.schema.fields).alias("body"), "_at")
    batches = bodies.groupBy(by, F.floor(F.col("_at") / size).cast("long").alias("batch"))
    return batches.agg(F.transform(F.array_sort(F.collect_list(F.struct("_at", "body"))), lambda x: x["body"]).alias("bodies"))


class SendError(RuntimeError):
    pass


def deliver(batch: list[str], send: Callable[[list[tuple[str, str]]], list[tuple[str, bool]]], *, retries: int = 5, wait: Callable[[float], None] = time.sleep) -> None:
    """Send one batch. ``send`` takes (id, body) pairs and returns (id, sender's fault) of those that failed.

    Failed ones are sent again after 100 ms, doubling up to 5 s; the sender's faults, ids that were never sent and
    running out of retries are errors.
    """
    left = {str(k): body for k, body in enumerate(batch)}
    pause = 0.1
    for attempt in range(retries + 1):
        failed = send(list(left.items()))
        if unknown := [i for i, _ in failed if i not in left]:
            raise SendError(f"failure of unknown ids {unknown}: data may be lost")
        if faults := [i for i, fault in failed if fault]:
            raise SendError(f"rejected messages {faults}")
        if not failed:
            return
        left = {i: left[i] for i, _ in failed}
        if attempt < retries:
            wait(pause)
            pause = min(5.0, pause * 2)
    raise SendError(f"{len(left)} messages failed after {retries} retries")


def send_messages(df: DataFrame, sender: Callable[[], Callable], *, size: int = 10, retries: int = 5) -> None:
    """Deliver all rows; ``sender()`` makes a partition's ``send``. Returns when all are acknowledged."""

    def partition(rows) -> None:
        send = sender()
        for row in rows:
            deliver(row.bodies, send, retries=retries)

    message_batches(df, size).foreachPartition(partition)
