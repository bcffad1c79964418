"""Progress of streams and versions of schemas, as tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

LARGEST = 2**63 - 1


def positions(df: DataFrame) -> DataFrame:
    """``stream, next_seq``: one after the last record, staying at the largest number there is."""
    last = F.max("seq_num")
    return df.groupBy("stream").agg(F.when(last == LARGEST, last).otherwise(last + 1).alias("next_seq"))


def merge_positions(old: DataFrame, new: DataFrame) -> DataFrame:
    """Saved positions moved forward, never back; streams that are no longer tracked don't come back."""
    rows = old.join(new.select("stream", F.col("next_seq").alias("_new")), "stream", "left")
    return rows.select("stream", F.greatest("next_seq", "_new").alias("next_seq"))


def catalog_diff(listed: DataFrame, known: DataFrame, exact: tuple[str, ...] = ()) -> DataFrame:
    """``stream, change``: ``new`` ones that are listed (and not marked deleted), ``removed`` ones that no longer are.

    Streams named exactly are kept although they aren't listed.
    """
    there = listed.where(~F.coalesce(F.col("deleted"), F.lit(False))) if "deleted" in listed.columns else listed
    there = there.select("stream").distinct()
    known = known.select("stream").distinct()
    new = there.join(known, "stream", "left_anti").withColumn("change", F.lit("new"))
    gone = known.join(there, "stream", "left_anti").where(~F.col("stream").isin(*exact)).withColumn("change", F.lit("removed"))
    return new.union(gone)


def schema_asof(events: DataFrame, versions: DataFrame, *, ranges: int = 64) -> DataFrame:
    """Events with ``snapshot_id``: the newest version of their table at or before their ``lsn``, null where none is.

    Events and versions are sorted together within ranges of ``lsn`` of about equal numbers of events, so a table that holds
    most events is spread over ``ranges`` groups; each table's newest version is carried over from range to range.
    """
    shares = [k / ranges for k in range(1, ranges)]
    cuts = (events.agg(F.percentile_approx("lsn", shares)).first()[0] or []) if shares else []
    at_range = lambda at: sum(((at >= c).cast("int") for c in sorted(set(cuts))), F.lit(0))
    known = versions.select("tbl", F.col("snapshot_id").cast("long").alias("snapshot_id")).distinct()
    asked = events.select("tbl", F.col("lsn").alias("_at"), F.struct(*events.columns).alias("_event"), F.lit(None).cast("long").alias("snapshot_id"))
    given = known.select("tbl", F.col("snapshot_id").alias("_at"), F.lit(None).cast(asked.schema["_event"].dataType).alias("_event"), "snapshot_id")
    rows = asked.unionByName(given).withColumn("_range", F.coalesce(at_range(F.col("_at")), F.lit(0)))
    seen = Window.partitionBy("tbl", "_range").orderBy("_at", F.col("_event").isNotNull()).rowsBetween(Window.unboundedPreceding, 0)
    found = rows.withColumn("_own", F.last("snapshot_id", ignorenulls=True).over(seen)).where(F.col("_event").isNotNull())
    newest = known.groupBy("tbl", at_range(F.col("snapshot_id")).alias("_range")).agg(F.max("snapshot_id").alias("_newest"))
    each = known.select("tbl").distinct().select("tbl", F.explode(F.sequence(F.lit(0), F.lit(len(cuts)))).alias("_range"))
    before = Window.partitionBy("tbl").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    carried = each.join(newest, ["tbl", "_range"], "left").select("tbl", "_range", F.max("_newest").over(before).alias("_carried"))
    joined = found.join(carried, ["tbl", "_range"], "left")
    version = F.when(F.col("_event.lsn").isNotNull(), F.coalesce("_own", "_carried"))
    return joined.select(*(F.col(f"_event.{c}").alias(c) for c in events.columns), version.alias("snapshot_id"))


def prune_versions(versions: DataFrame, retention: int | dict[str, int]) -> DataFrame:
    """The newest version at or before the retention point and all newer; tables without such a version keep all.

    ``retention`` is one point, or one for each table by name; tables that are not named keep all.
    """
    point = F.lit(retention) if not isinstance(retention, dict) else F.lit(None).cast("long")
    if isinstance(retention, dict):
        for name, at in retention.items():
            point = F.when(F.col("tbl") == name, F.lit(at)).otherwise(point)
    kept = versions.groupBy("tbl").agg(F.max(F.when(F.col("snapshot_id") <= point, F.col("snapshot_id"))).alias("_kept"))
    rows = versions.join(kept, "tbl").where(F.col("_kept").isNull() | (F.col("snapshot_id") >= F.col("_kept")))
    return rows.select(*versions.columns)


def dedupe_replay(df: DataFrame, keys: tuple[str, ...] = ("stream", "seq_num"), *, watermark: str | None = None) -> DataFrame:
    """One row for each record, however often it was read; streams need the column of a watermark set before."""
    return df.dropDuplicatesWithinWatermark(list(keys)) if watermark else df.dropDuplicates(list(keys))
