"""Change rows folded to state: current rows, first writes, running totals and keyed application."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from changeflow.functions.columns import checked_op, require_op
from changeflow.functions.schema import OP

ORDER = ("lsn", "ord")


def latest_by_key(df: DataFrame, keys: list[str], *, order: tuple[str, ...] = ORDER, op_col: str = OP) -> DataFrame:
    """One live row for each key: the last operation counts, a delete removes.

    Aggregated before the one shuffle, so a hot key sends a row for each task at most.
    """
    df = checked_op(df, op_col)
    rest = [c for c in df.columns if c not in keys]
    last = df.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("_last"))
    return last.where(F.col(f"_last.{op_col}") != "d").select(*(F.col(c) if c in keys else F.col(f"_last.{c}").alias(c) for c in df.columns))


def first_by_key(df: DataFrame, keys: list[str], *, order: tuple[str, ...] = ORDER, op_col: str = OP) -> DataFrame:
    """One live row for each key: the first write after the last delete counts.

    Two aggregations that both combine before their shuffle; no key's rows are gathered.
    """
    df = checked_op(df, op_col)
    at = F.struct(*order)
    rest = [c for c in df.columns if c not in keys]
    gone = df.where(F.col(op_col) == "d").groupBy(*keys).agg(F.max(at).alias("_gone"))
    writes = df.where(F.col(op_col) != "d").join(gone, keys, "left").where(F.col("_gone").isNull() | (at > F.col("_gone")))
    first = writes.groupBy(*keys).agg(F.min_by(F.struct(*rest), at).alias("_first"))
    return first.select(*(F.col(c) if c in keys else F.col(f"_first.{c}").alias(c) for c in df.columns))


def _signed(df: DataFrame, op_col: str, complete: str | None) -> tuple[DataFrame, Column]:
    """The rows, and what each counts: d rows -1, all others 1. A d row that isn't ``complete`` is an error."""
    df, op = checked_op(df, op_col), F.col(op_col)
    if complete is not None:
        fail = F.raise_error(F.lit("a delete without a full old image can't be subtracted")).cast("boolean")
        df = df.where(F.when((op == "d") & ~F.coalesce(F.col(complete), F.lit(False)), fail).otherwise(True))
    return df, F.when(op == "d", -1).otherwise(1)


def retract_agg(df: DataFrame, by: list[str], sums: list[str], *, op_col: str = OP, complete: str | None = None) -> DataFrame:
    """Row counts and sums that stay right under updates: d rows subtract, all others add. A null is a group like any other.

    Needs updates as d (full old image) and u rows, and deletes with full images. ``complete`` names a column that tells whether a
    row's image is full (``normalize_changes`` gives one); a d row that isn't can't be subtracted anywhere and is an error.
    """
    rows, sign = _signed(df, op_col, complete)
    return rows.groupBy(*by).agg(F.sum(sign).cast("long").alias("n_rows"), *(F.sum(F.col(c) * sign).alias(f"sum_{c}") for c in sums))


def retract_extremes(df: DataFrame, by: list[str], column: str, *, k: int = 0, op_col: str = OP, complete: str | None = None) -> DataFrame:
    """``by, n_values, n_distinct, min_<column>, max_<column>[, top_<column>]`` of the rows that are left after all deletes.

    A maximum that is deleted gives way to the next one, so a running value isn't enough: the changes are folded to a signed multiset
    (a value and how often it is there), which is aggregated again. Both aggregations combine before their shuffles, and the first
    spreads a large group over its values. ``top``: the ``k`` largest with repeats, largest first; only ``k`` values of a group
    leave a task. Nulls count as no values. A group without values is left out. More deletes of a value than writes are an error.
    """
    if k < 0:
        raise ValueError(f"k must not be negative: {k}")
    rows, sign = _signed(df, op_col, complete)
    sets = rows.where(F.col(column).isNotNull()).groupBy(*by, column).agg(F.sum(sign).cast("long").alias("_times"))
    fail = F.raise_error(F.concat(F.lit(f"more deletes than writes of a value of {column}: "), F.col(column).cast("string"))).cast("boolean")
    there = sets.where(F.when(F.col("_times") < 0, fail).otherwise(F.col("_times") > 0))
    found = [F.sum("_times").alias("n_values"), F.count("*").alias("n_distinct"), F.min(column).alias(f"min_{column}"), F.max(column).alias(f"max_{column}")]
    folded = there.groupBy(*by).agg(*found)
    if not k:
        return folded
    first = there.withColumn("_place", F.row_number().over(Window.partitionBy(*by).orderBy(F.col(column).desc()))).where(F.col("_place") <= k)
    repeated = F.sort_array(F.flatten(F.collect_list(F.array_repeat(column, F.least("_times", F.lit(k)).cast("int")))), asc=False)
    tops = first.groupBy(*by).agg(F.slice(repeated, 1, k).alias(f"top_{column}"))
    if not by:
        return folded.where("n_values > 0").crossJoin(F.broadcast(tops))  # one row each
    names = [f"_by{i}" for i in range(len(by))]
    tops = tops.select(*(F.col(c).alias(n) for c, n in zip(by, names, strict=True)), f"top_{column}")
    same = [F.col(c).eqNullSafe(F.col(n)) for c, n in zip(by, names, strict=True)]
    return folded.join(tops, same).drop(*names)


def change_counts(df: DataFrame, by: tuple[str, ...] = (), *, op_col: str = OP) -> DataFrame:
    df = checked_op(df, op_col)
    op = F.col(op_col)
    return df.groupBy(*by).agg(F.count("*").alias("n_rows"), F.count_if(op == "i").alias("n_inserts"), F.count_if(op == "u").alias("n_updates"), F.count_if(op == "d").alias("n_deletes"))


def null_operations(df: DataFrame, by: tuple[str, ...] = (), *, op_col: str = OP) -> DataFrame:
    """``by, n_rows, n_rejected``: the rows whose operation is null, on which every fold and sink would fail."""
    require_op(df, op_col)
    return df.groupBy(*by).agg(F.count("*").alias("n_rows"), F.count_if(F.col(op_col).isNull()).alias("n_rejected"))


def split_ops(df: DataFrame, *, op_col: str = OP) -> tuple[DataFrame, DataFrame]:
    """(upserts, deletes); without an op column all rows are upserts, a null operation is an error."""
    if op_col not in df.columns:
        return df, df.limit(0)
    df, op = checked_op(df, op_col), F.col(op_col)
    return df.where(op != "d"), df.where(op == "d")


def apply_changes(target: DataFrame, changes: DataFrame, keys: list[str], *, on_conflict: str = "update", order: tuple[str, ...] = ORDER, op_col: str = OP) -> DataFrame:
    """The target after the changes. ``on_conflict``: ``update`` or ``nothing`` (the row that is there stays).

    Within the changes the last operation of a key counts. Without keys rows are appended and a delete is an error.
    """
    if on_conflict not in ("update", "nothing"):
        raise ValueError(f"on_conflict must be update or nothing, not {on_conflict!r}")
    columns = target.columns
    changes = checked_op(changes, op_col)
    if not keys:
        fail = F.raise_error(F.lit("deletes need keys")).cast("boolean")
        return target.unionByName(changes.where(F.when(F.col(op_col) == "d", fail).otherwise(True)).select(*columns))
    old = target.select("*", F.lit("i").alias(op_col), F.lit(0).alias("_era"), *(F.lit(None).cast(changes.schema[c].dataType).alias(f"_o_{c}") for c in order))
    new = changes.select(*columns, op_col, F.lit(1).alias("_era"), *(F.col(c).alias(f"_o_{c}") for c in order))
    fold = latest_by_key if on_conflict == "update" else first_by_key
    return fold(old.unionByName(new), keys, order=("_era", *(f"_o_{c}" for c in order)), op_col=op_col).select(*columns)


def fold_changes(state: DataFrame, changes: DataFrame, keys: list[str], *, on_conflict: str = "update", order: tuple[str, ...] = ORDER, op_col: str = OP) -> DataFrame:
    """Change rows that stand for all rows of both, whatever order they came in and however often.

    ``update``: the last row of each key, a delete included. ``nothing``: each key's last delete and all writes after it, since
    a delete that comes late can bring back the write after it. ``latest_by_key`` or ``first_by_key`` of the result is the table.
    """
    if on_conflict not in ("update", "nothing"):
        raise ValueError(f"on_conflict must be update or nothing, not {on_conflict!r}")
    return _folded(state.unionByName(changes.select(*state.columns)), keys, on_conflict, order, op_col)


def compacted(log: DataFrame, keys: list[str], *, on_conflict: str = "update", order: tuple[str, ...] = ORDER, op_col: str = OP) -> DataFrame:
    """The change rows of a log that still count, as ``fold_changes`` of nothing and the log."""
    return _folded(log, keys, on_conflict, order, op_col)


def _folded(rows: DataFrame, keys: list[str], on_conflict: str, order: tuple[str, ...], op_col: str) -> DataFrame:
    if on_conflict not in ("update", "nothing"):
        raise ValueError(f"on_conflict must be update or nothing, not {on_conflict!r}")
    rows = checked_op(rows, op_col)
    at = F.struct(*order)
    if on_conflict == "update":
        rest = [c for c in rows.columns if c not in keys]
        last = rows.groupBy(*keys).agg(F.max_by(F.struct(*rest), at).alias("_last"))
        return last.select(*(F.col(c) if c in keys else F.col(f"_last.{c}").alias(c) for c in rows.columns))
    gone = rows.where(F.col(op_col) == "d").groupBy(*keys).agg(F.max(at).alias("_gone"))
    kept = rows.join(gone, keys, "left").where(F.col("_gone").isNull() | (at >= F.col("_gone")))
    return kept.select(*rows.columns).dropDuplicates([*keys, *order])
