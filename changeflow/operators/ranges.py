"""Orders over many rows, dealt to ranges: numbering and runs without a task that holds one group."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: Ranges that one order is dealt to at most, and rows for which one is made.
RANGES, ROWS = 256, 1_000_000


def cuts_of(df: DataFrame, column: str, ranges: int | None = None) -> list:
    """Values of a number or time column that part its rows evenly; one small job, as Spark's own range partitioning runs.

    Without ``ranges``: one for each million rows, at least one for each shuffle partition, 256 at most.
    """
    if ranges is not None and ranges < 1:
        raise ValueError("ranges must be 1 or more")
    most = ranges or RANGES
    shares = [k / most for k in range(1, most)]
    count, found = df.agg(F.count(column), F.percentile_approx(column, shares) if shares else F.lit(None)).first()
    if not count or not found:
        return []
    if ranges is None:
        wanted = min(most, max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-count // ROWS)))
        found = [found[(k * most) // wanted - 1] for k in range(1, wanted)]
    return sorted(set(found))


def range_of(value: Column, cuts: list) -> Column:
    """The number of cuts at or below a value, by halving; a null is in the first range."""
    def tree(low: int, high: int) -> Column:
        if low == high:
            return F.lit(low)
        middle = (low + high) // 2
        return F.when(value >= F.lit(cuts[middle]), tree(middle + 1, high)).otherwise(tree(low, middle))

    return tree(0, len(cuts))


def numbered(df: DataFrame, by: list[str], order: list[str], *, as_col: str, ranges: int | None = None) -> DataFrame:
    """Rows with their number from 0 on within ``by``, in ``order``, whose first column has to be a number or time.

    A group's rows are numbered in ranges of the order, each a window of its own; counts of the ranges before, a small table,
    are added. So a group with all rows is worked on by as many tasks as there are ranges.
    """
    ranged = df.withColumn("_range", range_of(F.col(order[0]), cuts_of(df, order[0], ranges)))
    sizes = ranged.groupBy(*by, "_range").agg(F.count("*").alias("_n"))
    before = F.coalesce(F.sum("_n").over(Window.partitionBy(*by).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = sizes.select(*(F.col(c).alias(f"_by{i}") for i, c in enumerate(by)), F.col("_range").alias("_r"), before.alias("_before"))
    own = ranged.withColumn("_own", F.row_number().over(Window.partitionBy(*by, "_range").orderBy(*order)) - 1)
    same = F.col("_range") == F.col("_r")
    for i, c in enumerate(by):
        same = same & F.col(c).eqNullSafe(F.col(f"_by{i}"))
    return own.join(offsets, same).select(*df.columns, (F.col("_own") + F.col("_before")).alias(as_col))


def runs(df: DataFrame, value: str, by: list[str], order: list[str], *, ranges: int | None = None) -> DataFrame:
    """``by, value, first, last, n_rows``: neighbours in the order that share ``value``, within each group of ``by``, or of all rows.

    Runs are found within ranges of the order, a window for each group and range. Only the first and the last run of a
    range can go on in the next, so only these, two rows for a range, are stitched in a second pass.
    """
    keys = [*by, "_range"]
    place = Window.partitionBy(*keys).orderBy(*order)
    ranged = df.select(*dict.fromkeys([*by, value, *order])).withColumn("_range", range_of(F.col(order[0]), cuts_of(df, order[0], ranges)))
    starts = ranged.withColumn("_new", (~F.col(value).eqNullSafe(F.lag(value).over(place)) | (F.row_number().over(place) == 1)).cast("int"))
    found = starts.withColumn("_run", F.sum("_new").over(place)).groupBy(*keys, "_run").agg(
        F.first(value).alias("_value"), F.min(order[0]).alias("first"), F.max(order[0]).alias("last"), F.count("*").alias("n_rows")
    )
    marked = found.withColumn("_last", F.max("_run").over(Window.partitionBy(*keys)))
    ends = (F.col("_run") == 1) | (F.col("_run") == F.col("_last"))
    shown = [*by, F.col("_value").alias(value), "first", "last", "n_rows"]
    in_order = Window.partitionBy(*by).orderBy("_range", "_run")
    goes_on = F.col("_value").eqNullSafe(F.lag("_value").over(in_order)) & (F.lag("_range").over(in_order) < F.col("_range")) & (F.col("_run") == 1)
    stitched = marked.where(ends).withColumn("_new", (~F.coalesce(goes_on, F.lit(False))).cast("int")).withColumn("_island", F.sum("_new").over(in_order))
    stitched = stitched.groupBy(*by, "_island").agg(F.first("_value").alias("_value"), F.min("first").alias("first"), F.max("last").alias("last"), F.sum("n_rows").alias("n_rows"))
    return marked.where(~ends).select(*shown).unionByName(stitched.select(*shown))
