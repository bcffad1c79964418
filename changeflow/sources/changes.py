"""Change events of database tables.

An event has ``lsn, ord, tbl, kind``, the new image ``new`` and the old image ``old`` (maps of text
by column), and ``old_kind``: ``full`` or ``key``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from changeflow.functions.columns import cell_text
from changeflow.functions.schema import OP, WIDER
from changeflow.operators.ranges import range_of

ROWS = ("insert", "copy", "update", "delete")


def changes_for(df: DataFrame, table: str) -> DataFrame:
    """Events of one table; a bare name is in ``public``."""
    return df.where(F.col("tbl") == (table if "." in table else f"public.{table}"))


def unclaimed_tables(df: DataFrame, claimed: list[str]) -> DataFrame:
    """``tbl, events`` of tables that nobody reads."""
    names = [t if "." in t else f"public.{t}" for t in claimed]
    return df.where(~F.col("tbl").isin(names)).groupBy("tbl").agg(F.count("*").alias("events"))


def normalize_changes(df: DataFrame, schema: T.StructType, *, keys: list[str], emit_update_before: bool = False, complete: str | None = None, op_col: str = OP, observation: Observation | None = None) -> DataFrame:
    """``op, lsn, ord, seq, declared columns``: inserts and copies as i, updates as u, deletes as d.

    With ``emit_update_before`` an update with a full old image gives a d row of that image first.
    A delete that knows only the key has nulls elsewhere; a value missing from an image is null.
    ``complete`` names one more column: whether the row's image is full, which running totals ask for.
    Events that are no rows, and deletes without an old image, are left out and counted. One pass
    without a shuffle; order is ``(lsn, ord, seq)``.
    """
    if missing := [k for k in keys if k not in schema.names]:
        raise ValueError(f"key columns that don't exist: {', '.join(missing)}")
    row = F.col("kind").isin(*ROWS)
    lost = (F.col("kind") == "delete") & F.col("old").isNull()
    if observation is not None:
        df = df.observe(
            observation, F.count_if(~F.coalesce(row, F.lit(False))).alias("other_events"), F.count_if(lost).alias("deletes_without_image"),
            F.count_if((F.col("kind") == "update") & (F.coalesce("old_kind", F.lit("")) != "full")).alias("updates_without_before"),
        )

    def image(of: str, key_only: Column) -> Column:
        values = []
        for f in schema.fields:
            v = F.col(of)[f.name].try_cast(f.dataType)
            values.append((v if f.name in keys else F.when(~key_only, v)).alias(f.name))
        return F.struct(*values)

    only_key = F.coalesce(F.col("old_kind") == "key", F.lit(False))
    is_full = lambda of: F.forall(F.array(*(F.lit(f.name) for f in schema.fields)), lambda c: F.map_contains_key(of, c))
    whole = (lambda c: [F.coalesce(c, F.lit(False)).alias("full")]) if complete else (lambda c: [])
    before = F.struct(F.lit("d").alias("op"), image("old", only_key).alias("row"), *whole(is_full(F.col("old")) & (F.col("old_kind") == "full")))
    after = F.struct(F.when(F.col("kind") == "update", "u").otherwise("i").alias("op"), image("new", F.lit(False)).alias("row"), *whole(is_full(F.col("new"))))
    rows = F.when(F.col("kind") == "delete", F.array(before))
    if emit_update_before:
        full = (F.col("kind") == "update") & F.col("old").isNotNull() & F.coalesce(F.col("old_kind") == "full", F.lit(False))
        rows = rows.when(full, F.array(before, after))
    events = df.where(row & ~lost).select("lsn", "ord", F.posexplode(rows.otherwise(F.array(after))).alias("seq", "x"))
    return events.select(F.col("x.op").alias(op_col), "lsn", "ord", "seq", *(F.col("x.row")[f.name].alias(f.name) for f in schema.fields), *([F.col("x.full").alias(complete)] if complete else []))


def align_by_name(df: DataFrame, schema: T.StructType, *, keep: tuple[str, ...] = (OP,)) -> DataFrame:
    """The declared columns in their order, matched by name: others go, missing ones are null."""
    first = [F.col(c) for c in keep if c in df.columns and c not in schema.names]
    return coerce(df.select(*first, *(F.col(f.name) if f.name in df.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields)), schema)


def coerce(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Declared columns in their types: text is parsed, narrow numbers widened, all else that differs is null."""
    out = {}
    for f in schema.fields:
        have, want = df.schema[f.name].dataType, f.dataType
        if have == want:
            continue
        if isinstance(have, (T.StringType, T.NullType)) or (have.simpleString(), want.simpleString()) in WIDER:
            out[f.name] = F.col(f.name).try_cast(want)
        else:
            out[f.name] = F.lit(None).cast(want)
    return df.withColumns(out) if out else df


def to_text(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.withColumns({c: cell_text(c, df.schema[c].dataType) for c in columns})


def snapshot_rows(df: DataFrame, columns: list[str], *, op_col: str = OP) -> DataFrame:
    """A table's rows as inserts before all live changes."""
    return df.select(F.lit("i").alias(op_col), F.lit(0).cast("long").alias("lsn"), F.lit(0).cast("long").alias("ord"), *columns)


def with_snapshot(snapshot: DataFrame, changes: DataFrame) -> DataFrame:
    return snapshot.unionByName(changes, allowMissingColumns=True)


def read_ranges(spark: SparkSession, url: str, table: str, key: str, cuts: list, *, properties: dict[str, str] | None = None) -> DataFrame:
    """A relational table read in key ranges, a connection and a task for each; a row without a key is in the first.

    ``key`` as it is to stand in a condition; ``cuts`` are numbers (``ranges.cuts_of`` an earlier copy, for example), sorted.
    """
    if sorted(set(cuts)) != list(cuts) or not all(isinstance(c, (int, float)) for c in cuts):
        raise ValueError("cuts must be distinct numbers in order")
    if not cuts:
        return spark.read.jdbc(url, table, properties=properties or {})
    low = [f"({key} < {cuts[0]} OR {key} IS NULL)"]
    parts = low + [f"{key} >= {a} AND {key} < {b}" for a, b in zip(cuts, cuts[1:], strict=False)] + [f"{key} >= {cuts[-1]}"]
    return spark.read.jdbc(url, table, predicates=parts, properties=properties or {})


def snapshot_by_ranges(table: DataFrame, changes: DataFrame, key: str, cuts: list, marks: DataFrame, *, op_col: str = OP) -> DataFrame:
    """A table that was copied range by range while changes went on, and these changes: change rows whose fold is the table.

    ``marks`` has ``range, low, high`` for each range of ``cuts``: the log's positions right before and right after it was read. A
    copied row has all changes up to ``low`` in it, and maybe some up to ``high``. So a change of the key between the two wins over
    the copied row, which is left out; other copied rows are inserts at ``low``, after all changes that they contain. Changes up to
    ``low`` stay, for keys that were deleted before the copy. A range without marks is an error. Only keys changed
    between the marks are shuffled to the copied rows; the marks are broadcast, one row for each range.
    """
    if marks.count() > len(cuts) + 1:
        raise ValueError("more marks than ranges")
    between = F.broadcast(marks.select(F.col("range").alias("_range"), F.col("low").cast("long").alias("_low"), F.col("high").cast("long").alias("_high")))
    placed = lambda df: df.withColumn("_range", range_of(F.col(key), cuts)).join(between, "_range", "left")
    fail = F.raise_error(F.concat(F.lit("no marks of range "), F.col("_range").cast("string"))).cast("long")
    copied = placed(table).withColumn("_low", F.coalesce("_low", fail))
    changed = placed(changes).where((F.col("lsn") > F.col("_low")) & (F.col("lsn") <= F.col("_high"))).select(F.col(key).alias("_key")).distinct()
    kept = copied.join(changed, F.col(key).eqNullSafe(F.col("_key")), "left_anti")
    rows = kept.select(F.lit("i").alias(op_col), F.col("_low").alias("lsn"), F.lit(2**31 - 1).cast("long").alias("ord"), *table.columns)
    return rows.unionByName(changes, allowMissingColumns=True)
