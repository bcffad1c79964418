"""One query for each operator, on tables and feeds; ``oracles`` has their DuckDB counterparts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from changeflow.functions.columns import clamp_timestamp, hash_name, hive_path_segment, lossy_utf8, to_u256, u256_to_text
from changeflow.operators.layout import partition_counts
from changeflow.operators.messages import message_batches, render_relational, route, route_runs, row_to_json, to_log_records
from changeflow.operators.progress import catalog_diff, dedupe_replay, merge_positions, positions, prune_versions, schema_asof
from changeflow.operators.relational import last_operations
from changeflow.operators.state import apply_changes, change_counts, first_by_key, fold_changes, latest_by_key, null_operations, retract_agg, retract_extremes, split_ops
from changeflow.plans.feeds import CUTS, FULL_ORDERS, MARKS, ORDERS, changes, envelope, shared_path, versioned
from changeflow.sources.changes import align_by_name, changes_for, coerce, normalize_changes, snapshot_by_ranges, snapshot_rows, to_text, unclaimed_tables, with_snapshot
from changeflow.sources.envelope import decode_by_version, decode_json, from_position, malformed_rows, select_streams
from changeflow.sources.envelope import envelope as raw_envelope

EVENT = "event_id:int64,user_id:int64,event_type:string?"
QUERIES = {}


def query(f):
    QUERIES[f.__name__] = f
    return f


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last good record of each user, decoded from the log."""
    rows = decode_json(envelope(spark, sf_dir), EVENT, on_malformed="skip", include_metadata=True)
    return latest_by_key(rows, ["user_id"], order=("_timestamp", "event_id"))


@query
def envelope_raw(spark, sf_dir):
    return raw_envelope(envelope(spark, sf_dir)).select(F.col("_op").alias("op"), "stream", "seq_num", "timestamp", "headers", "body")


@query
def restore_op(spark, sf_dir):
    return raw_envelope(envelope(spark, sf_dir)).groupBy(F.col("_op").alias("op")).agg(F.count("*").alias("n_rows"))


@query
def stream_exact(spark, sf_dir):
    return select_streams(envelope(spark, sf_dir), streams=" events/click, events/view,events/click").select("stream", "seq_num", "event_id")


@query
def stream_prefix(spark, sf_dir):
    return select_streams(envelope(spark, sf_dir), stream_prefix="events/p").select("stream", "seq_num", "event_id")


@query
def resume_positions(spark, sf_dir):
    log = envelope(spark, sf_dir)
    saved = log.where("stream <> 'events/click'").groupBy("stream").agg(F.floor(F.count("*") / 2).alias("next_seq"))
    return from_position(log, saved).select("stream", "seq_num")


@query
def resume_latest(spark, sf_dir):
    log = envelope(spark, sf_dir)
    saved = log.where("stream = 'events/click'").groupBy("stream").agg(F.floor(F.count("*") / 2).alias("next_seq"))
    return from_position(log, saved, start_position="latest").select("stream", "seq_num")


@query
def decode_skip(spark, sf_dir):
    return decode_json(envelope(spark, sf_dir), EVENT, on_malformed="skip").withColumnRenamed("_op", "op")


@query
def decode_metadata(spark, sf_dir):
    rows = decode_json(envelope(spark, sf_dir), "event_id:int64,user_id:string", include_metadata=True, on_malformed="skip")
    return rows.select(F.col("_op").alias("op"), "event_id", "user_id", F.col("_stream").alias("stream"), F.col("_seq_num").alias("seq_num"), F.col("_timestamp").alias("at"))


@query
def malformed_report(spark, sf_dir):
    return malformed_rows(envelope(spark, sf_dir), EVENT).groupBy("stream").agg(F.count("*").alias("n_rows"), F.min("seq_num").alias("first_seq"))


@query
def headers_json(spark, sf_dir):
    return raw_envelope(envelope(spark, sf_dir, more_headers=True)).select("stream", "seq_num", "headers")


@query
def table_demux(spark, sf_dir):
    return changes_for(changes(spark, sf_dir), "customer").select("k", "lsn", "kind")


@query
def unclaimed(spark, sf_dir):
    return unclaimed_tables(changes(spark, sf_dir), ["orders"])


def _orders(spark, sf_dir, **options) -> DataFrame:
    rows = normalize_changes(changes_for(changes(spark, sf_dir), "orders"), ORDERS, keys=["k"], **options)
    return rows.withColumnRenamed("_op", "op") if options.pop("renamed", False) else rows


def _shown(rows: DataFrame) -> DataFrame:
    return rows.withColumnRenamed("_op", "op").drop("ord")


@query
def normalized(spark, sf_dir):
    return _shown(_orders(spark, sf_dir)).drop("seq")


@query
def update_before(spark, sf_dir):
    return _shown(_orders(spark, sf_dir, emit_update_before=True))


@query
def key_only_delete(spark, sf_dir):
    return _shown(_orders(spark, sf_dir).where("_op = 'd'")).select("k", "status", "price")


@query
def partial_update(spark, sf_dir):
    """Images of every third order lack the status, as unchanged large values do."""
    events = changes_for(changes(spark, sf_dir), "orders").where("kind in ('insert', 'copy', 'update')")
    partial = events.withColumn("new", F.when(F.col("k") % 3 == 0, F.map_filter("new", lambda k, v: k != "status")).otherwise(F.col("new")))
    return _shown(normalize_changes(partial, ORDERS, keys=["k"])).drop("seq")


@query
def aligned(spark, sf_dir):
    wanted = T.StructType([T.StructField("o_orderstatus", T.StringType()), T.StructField("o_missing", T.IntegerType()), T.StructField("o_orderkey", T.LongType())])
    return align_by_name(_table(spark, sf_dir, "orders"), wanted)


@query
def coerced_cells(spark, sf_dir):
    rows = _table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_orderstatus").alias("status"), F.col("o_custkey").cast("int").alias("custkey"), F.col("o_orderkey").cast("string").alias("key_text"))
    return coerce(rows, T.StructType.fromDDL("o_orderkey string, status long, custkey long, key_text long"))


@query
def cell_texts(spark, sf_dir):
    rows = _table(spark, sf_dir, "events").select(
        "event_id", "ts", F.to_date("ts").alias("day"), F.col("value").cast("decimal(18,2)").alias("amount"), F.col("event_type").cast("binary").alias("raw"), F.array("event_id", F.lit(None).cast("long")).alias("list")
    )
    return to_text(rows, ["ts", "day", "amount", "raw", "list"])


@query
def snapshot_plus_changes(spark, sf_dir):
    live = _orders(spark, sf_dir).where("_op <> 'i'").select("_op", "lsn", "ord", "k", "status")
    old = _table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("k"), F.col("o_orderstatus").alias("status"))
    return with_snapshot(snapshot_rows(old, ["k", "status"]), live).withColumnRenamed("_op", "op")


@query
def current_state(spark, sf_dir):
    return _shown(latest_by_key(_orders(spark, sf_dir), ["k"])).drop("seq")


@query
def first_write_wins(spark, sf_dir):
    again = _orders(spark, sf_dir).where("_op = 'i' and k % 10 = 0").withColumns({"lsn": F.col("lsn") + 5, "status": F.lit("A")})
    return _shown(first_by_key(_orders(spark, sf_dir).union(again), ["k"])).drop("seq")


@query
def retraction_totals(spark, sf_dir):
    rows = normalize_changes(changes(spark, sf_dir, full=True), FULL_ORDERS, keys=["k"], emit_update_before=True)
    return retract_agg(rows, ["status"], ["price"])


@query
def op_counts(spark, sf_dir):
    return change_counts(_orders(spark, sf_dir).withColumn("part", F.col("k") % 8), ("part",))


def _target(spark, sf_dir) -> DataFrame:
    orders = _table(spark, sf_dir, "orders").where("o_orderkey % 2 = 0")
    return orders.select(F.col("o_orderkey").alias("k"), F.col("o_custkey").alias("custkey"), F.lit("OLD").alias("status"), F.col("o_totalprice").cast("decimal(18,2)").alias("price"))


@query
def apply_upsert(spark, sf_dir):
    return apply_changes(_target(spark, sf_dir), _orders(spark, sf_dir), ["k"])


@query
def apply_ignore(spark, sf_dir):
    return apply_changes(_target(spark, sf_dir), _orders(spark, sf_dir).where("_op <> 'd'"), ["k"], on_conflict="nothing")


@query
def apply_delete(spark, sf_dir):
    return apply_changes(_target(spark, sf_dir), _orders(spark, sf_dir).where("_op = 'd'"), ["k"])


@query
def append_without_keys(spark, sf_dir):
    return apply_changes(_target(spark, sf_dir), _orders(spark, sf_dir).where("_op = 'u'"), [])


@query
def hive_segment(spark, sf_dir):
    parts = _table(spark, sf_dir, "part").select("p_partkey", F.when(F.col("p_partkey") % 10 != 0, F.col("p_name")).alias("name"), F.concat(F.lit("foo/bar=baz*~ +é"), F.col("p_partkey").cast("string")).alias("odd"))
    return parts.select("p_partkey", hive_path_segment(["odd", "name"]).alias("segment"))


@query
def layout_counts(spark, sf_dir):
    rows = _table(spark, sf_dir, "events").select(F.when(F.col("event_id") % 10 != 0, F.col("event_type")).alias("event_type"), F.to_date("ts").alias("day"))
    return partition_counts(rows, ["event_type", "day"])


@query
def sql_filter(spark, sf_dir):
    """A SQL step between source and sink; the operation column goes along."""
    rows = decode_json(envelope(spark, sf_dir), EVENT, on_malformed="skip").withColumnRenamed("_op", "op")
    return spark.sql("select * from {log} where event_id is not null and event_id % 2 = 0", log=rows)


@query
def row_json(spark, sf_dir):
    rows = _table(spark, sf_dir, "events").select("event_id", F.when(F.col("event_id") % 3 != 0, F.col("event_type")).alias("event_type"), F.col("user_id"))
    return row_to_json(rows)


@query
def relational_cells(spark, sf_dir):
    rows = _table(spark, sf_dir, "events").select("event_id", F.when(F.col("event_id") % 2 == 0, F.date_trunc("second", "ts").cast("timestamp_ntz")).otherwise(F.col("ts")).alias("at"), F.to_date("ts").alias("day"), F.col("value").cast("decimal(18,2)").alias("amount"))
    return render_relational(rows)


@query
def log_records(spark, sf_dir):
    rows = _shown(_orders(spark, sf_dir)).select("op", "k", "status", "lsn")
    records = to_log_records(rows, stream="orders", op_col="op")
    return records.select("stream", records.headers[0]["key"].alias("header"), records.headers[0]["value"].alias("code"), "body")


@query
def routed(spark, sf_dir):
    return route(_table(spark, sf_dir, "events").select("event_id", "event_type", "user_id"), "events/{event_type}/by-{user_id}")


@query
def stream_runs(spark, sf_dir):
    """Runs of neighbouring records of one stream, in each user's sequence."""
    rows = envelope(spark, sf_dir).select("stream", "event_id", (F.col("event_id") % 997).alias("source"))
    return route_runs(rows, order=("event_id",), by=("source",))


@query
def batched_messages(spark, sf_dir):
    """Ten to a batch; users are the unit that keeps an order."""
    rows = _table(spark, sf_dir, "events").select("user_id", "event_id")
    return message_batches(rows, 10, by="user_id", order=("event_id",)).select("user_id", "batch", F.size("bodies").cast("long").alias("n_messages"), F.array_join("bodies", "|").alias("bodies"))


@query
def u256_text(spark, sf_dir):
    """Small numbers, and 2**256 - 2**128 plus them."""
    rows = _table(spark, sf_dir, "events").select("event_id", F.lpad(F.hex("event_id"), 64, "0").alias("digits"))
    large = F.concat(F.lit("f" * 32), F.substring("digits", 33, 32))
    return rows.select("event_id", u256_to_text(F.unhex("digits")).alias("small"), u256_to_text(F.unhex(large)).alias("large"))


@query
def u256_round_trip(spark, sf_dir):
    """2**256 - 1 less the event's number, to bytes and back."""
    low = F.lpad((F.lit(584007913129639935) - F.col("event_id")).cast("string"), 18, "0")
    rows = _table(spark, sf_dir, "events").select("event_id", F.concat(F.lit("115792089237316195423570985008687907853269984665640564039457"), low).alias("text"))
    return rows.withColumn("raw", to_u256(F.col("text"))).select("event_id", "text", F.lower(F.hex("raw")).alias("raw"), u256_to_text(F.col("raw")).alias("back"))


@query
def hashed_names(spark, sf_dir):
    return _table(spark, sf_dir, "part").select("p_partkey", hash_name(F.col("p_name")).cast("string").alias("id"))


@query
def next_positions(spark, sf_dir):
    return positions(envelope(spark, sf_dir))


@query
def progress_merge(spark, sf_dir):
    log = envelope(spark, sf_dir)
    old = positions(log.where("event_id % 2 = 0 and stream <> 'events/click'").withColumn("seq_num", F.col("seq_num") + F.when(F.col("stream") == "events/view", 100000).otherwise(-3)))
    return merge_positions(old, positions(log))


@query
def stream_catalog_diff(spark, sf_dir):
    log = envelope(spark, sf_dir)
    listed = log.select("stream", (F.col("stream") == "events/view").alias("deleted"))
    known = log.where("stream in ('events/click', 'events/view')").select(F.explode(F.array("stream", F.concat("stream", F.lit("-gone")), F.lit("events/pinned"))).alias("stream"))
    return catalog_diff(listed, known, ("events/pinned",))


def _versions(spark, sf_dir) -> DataFrame:
    """Schema versions at the first order of every customer."""
    orders = _table(spark, sf_dir, "orders")
    return orders.groupBy("o_custkey").agg((F.min("o_orderkey") * 10).alias("snapshot_id")).select(F.lit("public.orders").alias("tbl"), "snapshot_id")


@query
def versions_asof(spark, sf_dir):
    return schema_asof(changes(spark, sf_dir).select("tbl", "k", "lsn", "kind"), _versions(spark, sf_dir))


@query
def versions_pruned(spark, sf_dir):
    """One table is pruned at its own point, the other keeps all versions."""
    both = _versions(spark, sf_dir)
    return prune_versions(both.union(both.select(F.lit("public.customer"), "snapshot_id")), {"public.orders": 5000})


@query
def lossy_bodies(spark, sf_dir):
    """Bodies with bytes that are no UTF-8, as text."""
    rows = _table(spark, sf_dir, "events")
    body = F.when(F.col("event_id") % 3 == 0, F.concat(F.col("event_type").cast("binary"), F.unhex(F.lit("FF41C3")))).otherwise(F.col("event_type").cast("binary"))
    return rows.select("event_id", lossy_utf8(body).alias("body"))


@query
def clamped_timestamps(spark, sf_dir):
    """Milliseconds as timestamps; those beyond the range stay at its end."""
    rows = _table(spark, sf_dir, "events")
    millis = F.unix_millis(F.col("ts").cast("timestamp")) + F.when(F.col("event_id") % 4 == 0, F.lit(2**62)).otherwise(0)
    return rows.select("event_id", F.unix_millis(clamp_timestamp(millis)).alias("millis"))


@query
def split_operations(spark, sf_dir):
    """Upserts and deletes as a sink takes them."""
    puts, gone = split_ops(_orders(spark, sf_dir))
    return puts.select(F.lit("put").alias("part"), "k", "lsn").union(gone.select(F.lit("gone"), "k", "lsn"))


@query
def body_sizes(spark, sf_dir):
    """Records within the size limit; longer ones would be an error."""
    rows = _orders(spark, sf_dir).select("_op", "k", "lsn")
    return to_log_records(rows, stream="orders", max_bytes=64).select("stream", F.octet_length("body").cast("long").alias("n_bytes"), "body")


@query
def staged_ignores(spark, sf_dir):
    """What insert-ignore leaves to do to a table, keys that were deleted before marked."""
    return last_operations(_orders(spark, sf_dir), ["k"], on_conflict="nothing").select("k", F.col("_op").alias("op"), F.col("_cleared").alias("cleared"), "status")


@query
def folded_log(spark, sf_dir):
    """The state of a change log that arrives in two parts, the later one first."""
    rows = _orders(spark, sf_dir)
    state = fold_changes(rows.where("lsn % 10 >= 2"), rows.where("lsn % 10 < 2"), ["k"])
    return _shown(latest_by_key(state, ["k"])).drop("seq")


@query
def deduped_replay(spark, sf_dir):
    log = envelope(spark, sf_dir)
    return dedupe_replay(log.union(log.where("seq_num % 3 = 0"))).select("stream", "seq_num", "event_id")


@query
def extremes_under_retraction(spark, sf_dir):
    """Smallest, largest, distinct and the three largest prices of what is left after all updates and deletes."""
    rows = normalize_changes(changes(spark, sf_dir, full=True), FULL_ORDERS, keys=["k"], emit_update_before=True, complete="full")
    found = retract_extremes(rows, ["status"], "price", k=3, complete="full")
    return found.withColumn("top_price", F.array_join(F.transform("top_price", lambda x: x.cast("string")), ","))


@query
def null_operation_counts(spark, sf_dir):
    """How many rows of each table a fold would reject."""
    rows = changes(spark, sf_dir).select("tbl", F.when(F.col("k") % 11 != 0, F.col("kind")).alias("_op"))
    return null_operations(rows, ("tbl",))


@query
def log_runs(spark, sf_dir):
    """Runs of the whole log as one sequence."""
    rows = envelope(spark, sf_dir).select(F.when(F.col("event_id") % 40 < 25, "events/most").otherwise(F.col("stream")).alias("stream"), "event_id")
    return route_runs(rows, order=("event_id",))


@query
def batches_of_one_user(spark, sf_dir):
    """All rows in one order: full batches but for the last."""
    rows = _table(spark, sf_dir, "events").select(F.lit(1).alias("user"), "event_id")
    return message_batches(rows, 10, by="user", order=("event_id",)).select("batch", F.size("bodies").cast("long").alias("n_messages"), F.array_join("bodies", "|").alias("bodies"))


@query
def nested_bytes(spark, sf_dir):
    """Bytes as hex and 256-bit numbers as decimals, at every depth."""
    raw = F.col("event_type").cast("binary")
    rows = _table(spark, sf_dir, "events").select("event_id", F.struct(raw.alias("b"), F.array(raw, F.lit(None).cast("binary")).alias("l")).alias("s"), F.unhex(F.lpad(F.hex("event_id"), 64, "0")).alias("n"))
    return row_to_json(rows, u256=("n",))


@query
def snapshot_ranges(spark, sf_dir):
    """The state of orders from a copy made range by range while changes went on, and these changes."""
    old = _table(spark, sf_dir, "orders").where("o_orderkey % 9 <> 0").select(F.col("o_orderkey").alias("k"), F.lit("COPY").alias("status"))
    live = _orders(spark, sf_dir).select("_op", "lsn", "ord", "k", "status")
    marks = spark.createDataFrame(MARKS, "range int, low long, high long")
    rows = snapshot_by_ranges(old, live, "k", list(CUTS), marks)
    return latest_by_key(rows, ["k"]).select("k", F.col("_op").alias("op"), "lsn", "status")


@query
def decoded_by_version(spark, sf_dir):
    """Images read by the schema in force: a column added, one widened, one dropped."""
    events, versions = versioned(spark, sf_dir)
    return decode_by_version(events, versions, "k:int64,cust:int64,status:string").drop("tbl")


def _written_log(spark, sf_dir) -> str:
    path = shared_path(spark, "log")
    rows = envelope(spark, sf_dir).withColumn("timestamp", F.unix_millis(F.col("timestamp").cast("timestamp")))
    rows.select("stream", "seq_num", "timestamp", "headers", "body").write.partitionBy("stream").parquet(path)
    return path


@query
def log_source(spark, sf_dir):
    """The log of events read through the data source, as raw records."""
    from changeflow.sources.log_source import NAME, register

    register(spark)
    log = spark.read.format(NAME).option("path", _written_log(spark, sf_dir)).option("stream_prefix", "events/").load()
    return raw_envelope(log, op_col="op").withColumn("timestamp", F.unix_millis("timestamp"))


@query
def log_sink(spark, sf_dir):
    """Change rows appended to a log by tasks that stage and a driver that publishes, and read again."""
    from changeflow.streaming.log_sink import NAME, register

    register(spark)
    path = shared_path(spark, "sink")
    to_log_records(_orders(spark, sf_dir).select("_op", "k", "lsn"), stream="orders").write.format(NAME).mode("append").option("path", path).save()
    rows = spark.read.schema("headers array<struct<key:string,value:string>>, body string, stream string").parquet(path)
    return rows.select("stream", F.col("headers")[0]["value"].alias("code"), "body")
