import json

import pytest
from changeflow.sources.log_source import NAME, ParquetLog, Selection, register
from changeflow.streaming.streams import RECORD
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

FLAT = "seq_num long, timestamp long, headers array<struct<key:string,value:string>>, body binary, stream string"


def append(spark, log, stream, first, n, files=1):
    rows = [(k, 1000 + k, [("dbz.op", "c")] if k % 2 else [], bytearray(f"{stream}:{k}".encode()), stream) for k in range(first, first + n)]
    spark.createDataFrame(rows, FLAT).repartition(files).write.mode("append").partitionBy("stream").parquet(log)


def reader(kind, path, **options):
    return kind.format(NAME).options(**({"path": path} | options)).load()


def test_batch_reads_what_parquet_holds(spark, tmp_path):
    register(spark)
    log = str(tmp_path / "log")
    for stream, first, n in (("app/1", 0, 40), ("app/2", 5, 30), ("a b%=é", 0, 3), ("other", 0, 7)):
        append(spark, log, stream, first, n, 3)
    whole = spark.read.schema(RECORD).parquet(log)
    shown = ["stream", "seq_num", "timestamp", F.to_json("headers").alias("headers"), F.col("body").cast("string").alias("body")]
    key = lambda df: sorted(map(tuple, df.select(*shown).collect()))
    assert key(reader(spark.read, log, stream_prefix="a")) == key(whole.where("stream like 'a%'"))
    assert key(reader(spark.read, log, streams=" other, app/2,other")) == key(whole.where("stream in ('other', 'app/2')"))
    assert key(reader(spark.read, f"file://{log}", stream_prefix="app/", positions='{"app/1": 38, "app/2": 99}')) == key(whole.where("stream = 'app/1' and seq_num >= 38"))
    assert reader(spark.read, log, stream_prefix="app/", start_position="latest").count() == 0
    assert reader(spark.read, log, stream_prefix="none").count() == 0
    assert reader(spark.read, str(tmp_path / "nothing"), streams="x").count() == 0


def drained(spark, log, tmp_path, steps, **options):
    """Rows by batch, after each step; the query is stopped and started again between steps."""
    batches, out = {}, []
    for step in steps:
        step()
        rows = reader(spark.readStream, log, **options)
        take = lambda df, n: batches.setdefault(n, []).extend((r.stream, r.seq_num) for r in df.select("stream", "seq_num").collect())
        query = rows.writeStream.foreachBatch(take).option("checkpointLocation", str(tmp_path / "c")).trigger(processingTime="0 seconds").start()
        try:
            query.processAllAvailable()
        finally:
            query.stop()
        out.append({n: sorted(b) for n, b in batches.items() if b})
    return out


def test_no_batch_exceeds_its_size_and_restarts_go_on(spark, tmp_path):
    register(spark)
    log = str(tmp_path / "log")

    def first():
        append(spark, log, "app/1", 0, 25, 2)
        append(spark, log, "app/2", 0, 4)
        append(spark, log, "zzz", 0, 9)

    def second():
        append(spark, log, "app/1", 25, 9)
        append(spark, log, "app/3", 100, 17)

    one, two, three = drained(spark, log, tmp_path, [first, second, lambda: None], stream_prefix="app/", batch_size="7")
    assert sorted(x for b in one.values() for x in b) == sorted([("app/1", k) for k in range(25)] + [("app/2", k) for k in range(4)])
    # Every row once over the restart, and the stream that came later from its first record on.
    want = [("app/1", k) for k in range(34)] + [("app/2", k) for k in range(4)] + [("app/3", k) for k in range(100, 117)]
    assert sorted(x for b in two.values() for x in b) == want and three == two
    assert max(map(len, two.values())) == 7 and len(two) >= 8


def test_latest_counts_for_late_streams_too(spark, tmp_path):
    register(spark)
    log = str(tmp_path / "log")
    append(spark, log, "app/1", 0, 10)
    seen = []
    rows = reader(spark.readStream, log, stream_prefix="app/", start_position="latest", batch_size="5")
    query = rows.writeStream.foreachBatch(lambda df, n: seen.extend((r.stream, r.seq_num) for r in df.collect())).option("checkpointLocation", str(tmp_path / "c")).trigger(processingTime="0 seconds").start()
    try:
        query.processAllAvailable()
        append(spark, log, "app/1", 10, 3)
        append(spark, log, "app/2", 0, 6)
        query.processAllAvailable()
        append(spark, log, "app/2", 6, 2)
        query.processAllAvailable()
    finally:
        query.stop()
    assert sorted(seen) == [("app/1", 10), ("app/1", 11), ("app/1", 12), ("app/2", 6), ("app/2", 7)]


def test_shares_of_a_batch(spark, tmp_path):
    """Streams with little to read leave the rest to others."""
    from changeflow.sources.log_source import _Stream

    log = str(tmp_path / "log")
    for stream, n in (("a/1", 2), ("a/2", 100), ("a/3", 100)):
        append(spark, log, stream, 0, n)
    source = _Stream({"path": log, "stream_prefix": "a/", "batch_size": "20"})
    assert source.latestOffset() == {"a/1": 2, "a/2": 9, "a/3": 9}
    assert source.latestOffset() == {"a/1": 2, "a/2": 19, "a/3": 19}
    for _ in range(20):
        last = source.latestOffset()
    assert last == {"a/1": 2, "a/2": 100, "a/3": 100}
    assert sum(p.stop - p.start for p in source.partitions({"a/1": 0}, {"a/1": 2, "a/2": 5})) == 2
    assert json.loads(json.dumps(last)) == last


def test_a_log_of_another_kind(spark, tmp_path):
    """Any object with ``extents`` and ``read`` is a log."""
    append(spark, log := str(tmp_path / "log"), "s", 0, 5)
    register(spark)
    assert reader(spark.read, log, streams="s", log="changeflow.sources.log_source:ParquetLog").count() == 5


def test_options_are_checked(spark):
    for bad in ({}, {"streams": " , "}, {"streams": "a", "start_position": "middle"}, {"streams": "a", "batch_size": "0"}):
        with pytest.raises(ValueError):
            Selection.of(bad)
    with pytest.raises(ValueError):
        ParquetLog({})
    register(spark)
    with pytest.raises(PySparkException):
        reader(spark.read, "/tmp/x").collect()
