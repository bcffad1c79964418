"""Hive partition layout of files."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from changeflow.functions.columns import hive_path_segment
from changeflow.functions.schema import parse_partition_columns


#: Rows of one file, where no other number is given.
FILE_ROWS = 1_000_000


def write_parquet(df: DataFrame, path: str, *, partition_columns: str | None = None, exact_paths: bool = False, file_rows: int | None = None) -> None:
    """Append Parquet files, one directory for each combination of partition values.

    Spark leaves partition columns out of the files. ``exact_paths`` keeps them: rows are laid out by
    one column ``segment`` with the percent-encoded path, which also tells empty text from null and
    allows all columns as partition columns. An empty table writes no file. ``file_rows`` gives files of about
    that many rows, never more: each directory gets as many as its rows ask for.
    """
    rows, names = laid_out(df, partition_columns, exact_paths)
    if df.isEmpty():
        return
    if file_rows is not None:
        rows = dealt(rows, names, file_rows)
    writer = rows.write.mode("append").partitionBy(*names)
    (writer.option("maxRecordsPerFile", file_rows) if file_rows else writer).parquet(path.rstrip("/"))


def dealt(df: DataFrame, names: list[str], file_rows: int = FILE_ROWS) -> DataFrame:
    """Rows dealt to tasks by directory and a salt, as many salts as a directory's rows fill files.

    The histogram, a row for each directory, is an aggregation of its own before the one shuffle of the rows. The salt is a hash of the
    row, so a repeated task deals them alike. A large directory is written by many tasks, small ones share one.
    """
    if file_rows < 1:
        raise ValueError("file_rows must be 1 or more")
    keys = [f"_d{i}" for i in range(len(names))]
    sizes = df.groupBy(*(F.col(c).alias(k) for c, k in zip(names, keys, strict=True))).agg(F.ceil(F.count("*") / file_rows).cast("int").alias("_files"))
    sizes = sizes.persist()
    try:
        directories, files = sizes.agg(F.count("*"), F.sum("_files")).first()
    finally:
        sizes.unpersist()
    same = F.lit(True)
    for c, k in zip(names, keys, strict=True):
        same = same & F.col(c).eqNullSafe(F.col(k))
    few = F.broadcast(sizes) if directories <= 100_000 else sizes
    known = df.crossJoin(few) if not names else df.join(few, same)  # without directories there is one row of sizes
    plain = [F.col(f.name) if f.dataType.typeName() not in ("map", "variant") else F.col(f.name).cast("string") for f in df.schema.fields]
    salted = known.withColumn("_salt", F.pmod(F.xxhash64(*plain), F.col("_files")))
    return salted.repartition(max(1, min(int(files or 1), 100_000)), *names, "_salt").select(*df.columns)


def laid_out(df: DataFrame, partition_columns: str | None, exact_paths: bool) -> tuple[DataFrame, list[str]]:
    """Rows, and the columns whose values make their directories."""
    names = parse_partition_columns(partition_columns, df.schema)
    if names and exact_paths:
        return df.withColumn("segment", hive_path_segment(names)), ["segment"]
    return df, list(names or [])


def partition_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """``segment, n_rows`` of a layout, before it is written."""
    return df.groupBy(hive_path_segment(columns).alias("segment")).agg(F.count("*").alias("n_rows"))
