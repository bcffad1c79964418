"""Changes applied to a table of a relational database: staged in bulk, then merged by one or two statements.

Dialects: ``mysql``, and ``standard`` SQL with MERGE. Rows go through Spark's JDBC source, in as many connections as there are
partitions; statements go through a connection of the same source, so there is no client of our own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from changeflow.functions.columns import checked_op
from changeflow.functions.schema import OP, create_table_sql, quoted, relational_type
from changeflow.operators.state import ORDER


def merge_statements(table: str, staging: str, columns: list[str], keys: list[str], *, on_conflict: str = "update", op_col: str = OP, dialect: str = "mysql") -> list[str]:
    """Statements that bring staged rows (one for each key) into the table: deletes first, then writes."""
    if on_conflict not in ("update", "nothing"):
        raise ValueError(f"on_conflict must be update or nothing, not {on_conflict!r}")
    if not keys:
        raise ValueError("a merge needs keys")
    q = lambda name: quoted(name, dialect)
    names = ", ".join(map(q, columns))
    same = " AND ".join(f"t.{q(k)} = s.{q(k)}" for k in keys)
    rest = [c for c in columns if c not in keys]
    cleared = f" OR s.{q('_cleared')}" if on_conflict == "nothing" else ""
    if dialect != "mysql":
        write = f"MERGE INTO {q(table)} t USING {q(staging)} s ON {same}"
        update = f" WHEN MATCHED AND s.{q(op_col)} <> 'd' THEN UPDATE SET " + ", ".join(f"{q(c)} = s.{q(c)}" for c in rest)
        insert = f" WHEN NOT MATCHED AND s.{q(op_col)} <> 'd' THEN INSERT ({names}) VALUES ({', '.join(f's.{q(c)}' for c in columns)})"
        return [f"{write} WHEN MATCHED AND (s.{q(op_col)} = 'd'{cleared}) THEN DELETE", write + (update if on_conflict == "update" and rest else "") + insert]
    if on_conflict == "nothing" or not rest:
        rest = keys[:1]  # assigning a key to itself changes nothing
        change = ", ".join(f"{q(c)} = {q(table)}.{q(c)}" for c in rest)
    else:
        change = ", ".join(f"{q(c)} = VALUES({q(c)})" for c in rest)
    return [
        f"DELETE t FROM {q(table)} t JOIN {q(staging)} s ON {same} WHERE s.{q(op_col)} = 'd'{cleared}",
        f"INSERT INTO {q(table)} ({names}) SELECT {names} FROM {q(staging)} s WHERE s.{q(op_col)} <> 'd' ON DUPLICATE KEY UPDATE {change}",
    ]


def last_operations(changes: DataFrame, keys: list[str], *, on_conflict: str = "update", order: tuple[str, ...] = ORDER, op_col: str = OP) -> DataFrame:
    """One row for each key of the changes, deletes included (without their other values): what is left to do to the table.

    ``update`` is one aggregation that combines before its shuffle. With ``nothing`` the first write after a key's last delete
    is staged, and ``_cleared`` tells keys that were deleted before: the row in the table goes first.
    """
    if on_conflict not in ("update", "nothing"):
        raise ValueError(f"on_conflict must be update or nothing, not {on_conflict!r}")
    changes = checked_op(changes, op_col)
    at, rest = F.struct(*order), [c for c in changes.columns if c not in keys]
    if on_conflict == "update":
        last = changes.groupBy(*keys).agg(F.max_by(F.struct(*rest), at).alias("_last"))
        value = lambda c: F.col(f"_last.{c}") if c == op_col else F.when(F.col(f"_last.{op_col}") != "d", F.col(f"_last.{c}"))
        return last.select(*(F.col(c) if c in keys else value(c).alias(c) for c in changes.columns))
    gone = changes.where(F.col(op_col) == "d").groupBy(*keys).agg(F.max(at).alias("_gone"))
    gone = gone.select(*(F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)), "_gone")
    same = F.lit(True)
    for i, k in enumerate(keys):
        same = same & F.col(k).eqNullSafe(F.col(f"_k{i}"))
    # A deleted key's row stands for itself beside its writes, so that all keys come out of one aggregation.
    kept = changes.join(gone, same, "left").where((F.col(op_col) == "d") | F.col("_gone").isNull() | (at > F.col("_gone")))
    live = F.when(F.col(op_col) != "d", F.struct(*rest))
    first = kept.groupBy(*keys).agg(F.min_by(live, F.when(F.col(op_col) != "d", at)).alias("_first"), F.bool_or(F.col(op_col) == "d").alias("_cleared"))
    value = lambda c: F.coalesce(F.col(f"_first.{c}"), F.lit("d")) if c == op_col else F.col(f"_first.{c}")
    return first.select(*(F.col(c) if c in keys else value(c).alias(c) for c in changes.columns), "_cleared")


def _stored(name: str, kind: T.DataType) -> Column:
    """A column as the source can write it: nested values as JSON, what no table has as text."""
    if isinstance(kind, (T.StructType, T.ArrayType, T.MapType)):
        return F.to_json(name).alias(name)
    plain = (T.BooleanType, T.NumericType, T.BinaryType, T.DateType, T.TimestampType, T.TimestampNTZType, T.StringType)
    return F.col(name) if isinstance(kind, plain) else F.col(name).cast("string").alias(name)


def run_statement(spark: SparkSession, url: str, statement: str, *, properties: dict[str, str] | None = None, probe: str = "SELECT 1 AS x") -> None:
    """Run one statement in the database, in the connection of a one-row read. A task that fails is repeated, so it has to bear that.

    ``probe`` is a query of one row in the database's dialect.
    """
    options = {"url": url, "query": probe, "sessionInitStatement": statement} | (properties or {})
    spark.read.format("jdbc").options(**options).load().collect()


def stage(df: DataFrame, url: str, staging: str, *, keys: list[str] = (), batch_size: int = 1000, dialect: str = "mysql", properties: dict[str, str] | None = None) -> None:
    """Write rows to a new staging table, ``batch_size`` to a statement; the driver's jar has to be on the class path.

    Times keep their microseconds, bytes and decimals are themselves, nested values are JSON. MySQL's table is made first, since
    Spark's own types for it lose fractions of seconds and long bytes; elsewhere Spark makes it, text keys as VARCHAR(255).
    """
    if batch_size < 1:
        raise ValueError("batch_size must be 1 or more")
    rows = df.select(*(_stored(f.name, f.dataType) for f in df.schema.fields))
    options = {"batchsize": str(batch_size)} | (properties or {})
    if dialect == "mysql":
        plain = T.StructType([T.StructField(f.name, f.dataType) for f in df.schema.fields])
        for statement in (f"DROP TABLE IF EXISTS {quoted(staging)}", create_table_sql(plain, staging, [], op_col="")):
            run_statement(df.sparkSession, url, statement, properties=properties)
        rows.write.mode("append").options(**options).jdbc(url, quoted(staging))
        return
    short = [f"{quoted(f.name)} VARCHAR(255)" for f in rows.schema.fields if f.name in (*keys, OP) and relational_type(f.dataType, dialect) == "CLOB"]
    options |= {"createTableColumnTypes": ", ".join(short)} if short else {}
    rows.write.mode("overwrite").options(**options).jdbc(url, quoted(staging, dialect))


def merge_into(changes: DataFrame, url: str, table: str, keys: list[str], *, staging: str | None = None, on_conflict: str = "update", order: tuple[str, ...] = ORDER, op_col: str = OP,
               batch_size: int = 1000, dialect: str = "mysql", properties: dict[str, str] | None = None, probe: str = "SELECT 1 AS x") -> None:
    """Apply changes to a table of the database: what is left to do for each key is staged, then merged in the database.

    Columns are those of the changes without the operation and the order. Staging and merging again changes nothing, so a batch of
    a stream may be repeated. Two merges of one table at a time need staging tables of their own.
    """
    staging = staging or f"{table}_staging"
    columns = [c for c in changes.columns if c not in (op_col, *order)]
    rows = last_operations(changes, keys, on_conflict=on_conflict, order=order, op_col=op_col)
    stage(rows.drop(*order), url, staging, keys=keys, batch_size=batch_size, dialect=dialect, properties=properties)
    for statement in merge_statements(table, staging, columns, keys, on_conflict=on_conflict, op_col=op_col, dialect=dialect):
        run_statement(changes.sparkSession, url, statement, properties=properties, probe=probe)
