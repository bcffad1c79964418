"""Change events and log records derived from the given tables, in SQL that Spark and DuckDB share."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

TABLES = ("nation", "customer", "part", "orders", "events")

CHANGES = """
select o_orderkey as k, o_orderkey*10+1 as lsn, 'public.orders' as tbl, case when o_orderkey % 7 = 0 then 'copy' else 'insert' end as kind,
       o_custkey as custkey, o_orderstatus as status, cast(o_totalprice as decimal(18,2)) as price,
       cast(null as varchar(9)) as old_kind, cast(null as varchar(9)) as old_status, cast(null as decimal(18,2)) as old_price from orders
union all select o_orderkey, o_orderkey*10+2, 'public.orders', 'update', o_custkey, 'U', cast(cast(o_totalprice as decimal(18,2)) + 1 as decimal(18,2)),
       case when o_orderkey % 2 = 0 then 'full' else 'key' end, case when o_orderkey % 2 = 0 then o_orderstatus end,
       case when o_orderkey % 2 = 0 then cast(o_totalprice as decimal(18,2)) end from orders where o_orderkey % 3 = 0
union all select o_orderkey, o_orderkey*10+3, 'public.orders', 'delete', null, null, null,
       case when o_orderkey % 35 = 0 then null when o_orderkey % 4 = 0 then 'full' else 'key' end,
       case when o_orderkey % 4 = 0 then o_orderstatus end, null from orders where o_orderkey % 5 = 0
union all select c_custkey, 900000000 + c_custkey, 'public.customer', 'insert', c_custkey, null, null, null, null, null from customer
union all select n_nationkey, 990000000 + n_nationkey, 'public.orders', 'truncate', null, null, null, null, null, null from nation where n_nationkey < 2
"""

#: Updates and deletes with full old images, as running totals need them.
FULL_CHANGES = """
select o_orderkey as k, o_orderkey*10+1 as lsn, 'public.orders' as tbl, 'insert' as kind, o_orderstatus as status, cast(o_totalprice as decimal(18,2)) as price,
       cast(null as varchar(9)) as old_kind, cast(null as varchar(9)) as old_status, cast(null as decimal(18,2)) as old_price from orders
union all select o_orderkey, o_orderkey*10+2, 'public.orders', 'update', 'U', cast(cast(o_totalprice as decimal(18,2)) + 1 as decimal(18,2)), 'full', o_orderstatus, cast(o_totalprice as decimal(18,2)) from orders where o_orderkey % 3 = 0
union all select o_orderkey, o_orderkey*10+3, 'public.orders', 'delete', null, null, 'full',
       case when o_orderkey % 3 = 0 then 'U' else o_orderstatus end,
       case when o_orderkey % 3 = 0 then cast(cast(o_totalprice as decimal(18,2)) + 1 as decimal(18,2)) else cast(o_totalprice as decimal(18,2)) end from orders where o_orderkey % 5 = 0
"""

ENVELOPE = """
select event_id, event_type, concat('events/', event_type) as stream, cast(event_id as bigint) as seq_num, ts,
       case when event_id % 50 = 0 then 'bogus' when event_id % 5 = 1 then 'c' when event_id % 5 = 2 then 'u'
            when event_id % 5 = 3 then 'd' when event_id % 5 = 4 then 'r' end as dbz_op,
       case when event_id % 97 = 1 then 'not json'
            when event_id % 101 = 1 then '{"event_id":1,"user_id":1}{"event_id":2,"user_id":2}'
            when event_id % 103 = 1 then ' '
            else concat('{"event_id":', cast(event_id as varchar(30)), ',"user_id":"', cast(user_id as varchar(30)), '","event_type":"', event_type, '"}') end as body
from events
"""


#: Rows of orders as JSON images, in three eras of their table's schema: a column is added, then one widened and one dropped.
VERSIONED = """
select o_orderkey as k, cast(o_orderkey as bigint) * 10 as lsn,
       case when o_orderkey % 83 = 0 then '{"k":"x' || o_orderkey || '"}'
            when o_orderkey % 3 = 0 then '{"k":' || o_orderkey || ',"status":"' || o_orderstatus || '"}'
            else '{"k":' || o_orderkey || ',"status":"' || o_orderstatus || '","cust":"' || o_custkey || '","extra":1}' end as body
from orders
"""
#: Snapshot ids and schemas of the eras.
ERAS = ((100, "k:int32,status:string"), (20000, "k:int32,status:string,cust:int32?"), (90000, "k:int64,cust:int32?"))


def _sql(spark: SparkSession, sf_dir: str, text: str) -> DataFrame:
    """Runs a feed on the tables it names, given as arguments so that no view is left in the session."""
    used = {t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in TABLES if f"from {t}" in text}
    text = text.replace("{", "{{").replace("}", "}}")
    for t in used:
        text = text.replace(f"from {t}", f"from {{{t}}}")
    return spark.sql(text, **used)


def changes(spark: SparkSession, sf_dir: str, *, full: bool = False) -> DataFrame:
    """Events with images as maps of text by column."""
    flat = _sql(spark, sf_dir, FULL_CHANGES if full else CHANGES)
    text = lambda c: F.col(c).cast("string")
    key = [F.lit("k"), text("k")]
    cust = [] if full else [F.lit("custkey"), text("custkey")]
    new = F.create_map(*key, *cust, F.lit("status"), text("status"), F.lit("price"), text("price"))
    old = F.create_map(*key, F.lit("status"), text("old_status"), F.lit("price"), text("old_price"))
    return flat.select(
        "k", "lsn", F.lit(0).cast("long").alias("ord"), "tbl", "kind", F.when(F.col("kind") != "delete", new).alias("new"), F.when(F.col("old_kind").isNotNull(), old).alias("old"), "old_kind"
    )


_STATUS, _PRICE = T.StructField("status", T.StringType()), T.StructField("price", T.DecimalType(18, 2))
ORDERS = T.StructType([T.StructField("k", T.LongType()), T.StructField("custkey", T.LongType()), _STATUS, _PRICE])
FULL_ORDERS = T.StructType([T.StructField("k", T.LongType()), _STATUS, _PRICE])


def envelope(spark: SparkSession, sf_dir: str, *, more_headers: bool = False) -> DataFrame:
    """Records with their operation as a header, as binary bodies."""
    rows = _sql(spark, sf_dir, ENVELOPE)
    header = lambda k, v: F.struct(F.lit(k).alias("key"), v.alias("value"))
    own = F.when(F.col("dbz_op").isNull(), F.array().cast("array<struct<key:string,value:string>>")).otherwise(F.array(header("dbz.op", F.col("dbz_op"))))
    if more_headers:
        own = F.concat(own, F.array(header("k", F.lit("1")), header("a", F.col("event_type")), header("k", F.lit("2"))))
    return rows.select("stream", "seq_num", F.col("ts").alias("timestamp"), own.alias("headers"), F.col("body").cast("binary").alias("body"), "event_id", "event_type")


def versioned(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Images of one table, and its schema versions."""
    rows = _sql(spark, sf_dir, VERSIONED).withColumn("tbl", F.lit("public.orders"))
    return rows, spark.createDataFrame([("public.orders", at, text) for at, text in ERAS], "tbl string, snapshot_id long, schema string")


#: A copy of orders by key ranges, with the log's positions around each range's read.
CUTS = (1500, 4000, 9000)
MARKS = tuple((r, 12000 * r, 12000 * r + 30000) for r in range(len(CUTS) + 1))


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path in the folder that the driver and all executors share; a temporary one only where Spark is one process."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        folder = tempfile.mkdtemp(prefix="spark-changeflow-")
    return f"{folder.rstrip('/')}/{name}-{uuid.uuid4().hex}"
