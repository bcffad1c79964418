import json
import os

import pytest
from changeflow.operators.messages import to_log_records
from changeflow.operators.progress import positions
from changeflow.sources import log_source
from changeflow.streaming import log_sink
from changeflow.streaming.ledger import ledger_positions, ledger_stream, ledger_totals, read_ledger
from changeflow.streaming.log_sink import Folder, Staged
from changeflow.streaming.streams import read_log_stream, write_log_stream
from pyspark.sql import functions as F

FLAT = "seq_num long, timestamp long, headers array<struct<key:string,value:string>>, body binary, stream string"


def append(spark, log, stream, first, n):
    rows = [(k, 1000 + k, [("dbz.op", "c")], bytearray(f"{k}".encode()), stream) for k in range(first, first + n)]
    spark.createDataFrame(rows, FLAT).repartition(3).write.mode("append").partitionBy("stream").parquet(log)


def seen(spark, out):
    if not any(d.startswith("stream=") for d in os.listdir(out)):
        return []
    return sorted((r.stream, r.seq_num) for r in spark.read.parquet(out).collect())


def test_failed_task_leaves_nothing_and_the_retry_gives_each_row_once(spark, tmp_path):
    log_sink.register(spark)
    log, out, flag = str(tmp_path / "log"), str(tmp_path / "out"), str(tmp_path / "broken")
    for stream, n in (("a/1", 300), ("b c", 200)):
        append(spark, log, stream, 0, n)
    open(flag, "w").close()

    def breaks(batches):
        for k, b in enumerate(batches):
            yield b.iloc[: len(b) // 2]
            if os.path.exists(flag):
                raise RuntimeError("half the rows are gone")
            yield b.iloc[len(b) // 2 :]

    def run():
        rows = read_log_stream(spark, log).mapInPandas(breaks, read_log_stream(spark, log).schema)
        query = rows.writeStream.format(log_sink.NAME).option("path", out).option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
        query.awaitTermination()

    with pytest.raises(Exception, match="half the rows"):
        run()
    assert seen(spark, out) == []
    os.remove(flag)
    run()
    want = sorted([("a/1", k) for k in range(300)] + [("b c", k) for k in range(200)])
    assert seen(spark, out) == want
    append(spark, log, "a/1", 300, 50)
    run()
    assert seen(spark, out) == sorted(want + [("a/1", k) for k in range(300, 350)])
    assert len(os.listdir(f"{out}/_batches")) == 2
    # The log that was written is one that can be read.
    log_source.register(spark)
    assert spark.read.format(log_source.NAME).option("path", out).option("stream_prefix", "a/").load().count() == 350


def test_a_batch_is_published_once(spark, tmp_path):
    """The same batch again, with other staged files, after a crash before, between and after its moves."""
    import pyarrow as pa

    folder = Folder({"path": str(tmp_path)})
    rows = pa.RecordBatch.from_pydict({"stream": ["x", "y", "x"], "v": [1, 2, 3]})
    count = lambda: sum(f.endswith(".parquet") for _, _, fs in os.walk(tmp_path) for f in fs)
    first = folder.stage(iter([rows]))
    assert sorted((s, n) for s, _, n in first.files) == [("x", 2), ("y", 1)]
    folder.publish("batch-1", [first, None])
    again = folder.stage(iter([rows]))
    folder.publish("batch-1", [again])
    assert count() == 2 and seen_values(spark, tmp_path) == [("x", 1), ("x", 3), ("y", 2)]
    # Listed, but only one of its files was moved before a crash.
    third = folder.stage(iter([rows]))
    with open(tmp_path / "_batches" / "batch-2.json", "w") as f:
        json.dump(third.files, f)
    os.makedirs(tmp_path / "stream=x", exist_ok=True)
    os.rename(tmp_path / "_staging" / third.files[0][1], tmp_path / f"stream={third.files[0][0]}" / "batch-2-00000.parquet")
    folder.publish("batch-2", [folder.stage(iter([rows]))])
    assert seen_values(spark, tmp_path) == sorted([("x", 1), ("x", 3), ("y", 2)] * 2)
    folder.drop(folder.stage(iter([rows])).files)
    assert os.listdir(tmp_path / "_staging") == []
    with pytest.raises(ValueError):
        folder.stage(iter([pa.RecordBatch.from_pydict({"stream": pa.array([None], pa.string()), "v": [1]})]))
    assert isinstance(first, Staged)


def seen_values(spark, path):
    return sorted((r.stream, r.v) for r in spark.read.parquet(str(path)).collect())


def test_batch_writes_and_many_streams(spark, tmp_path, monkeypatch):
    log_sink.register(spark)
    out = str(tmp_path / "out")
    changes = spark.range(400).select(F.lit("i").alias("_op"), "id", (F.col("id") % 150).cast("string").alias("tenant"))
    to_log_records(changes, template="t/{tenant}").write.format(log_sink.NAME).mode("append").option("path", out).save()
    back = spark.read.parquet(out)
    assert back.count() == 400 and back.select("stream").distinct().count() == 150
    assert {r.op for r in back.select(F.col("headers")[0]["value"].alias("op")).collect()} == {"c"}
    with pytest.raises(Exception, match="stream"):
        spark.range(3).write.format(log_sink.NAME).mode("append").option("path", out).save()
    with pytest.raises(Exception, match="appended"):
        back.write.format(log_sink.NAME).mode("overwrite").option("path", out).save()


def test_ledger_counts_each_row_once_over_failures_and_restarts(spark, tmp_path):
    log, ledger, checkpoint = (str(tmp_path / x) for x in ("log", "ledger", "c"))
    fails, written = [True], []

    def write(batch, batch_id):
        written.append(batch_id)
        batch.count()
        if batch_id == 1 and fails and fails.pop():
            raise RuntimeError("down")

    def run():
        rows = read_log_stream(spark, log, files_per_batch=1)
        counters = {"even": F.col("seq_num") % 2 == 0, "none": F.col("body").isNull()}
        ledger_stream(rows, write, ledger, checkpoint, counters=counters).awaitTermination()

    append(spark, log, "a", 0, 30)
    append(spark, log, "b", 5, 10)
    with pytest.raises(Exception, match="down"):
        run()
    run()
    append(spark, log, "a", 30, 7)
    run()
    entered = read_ledger(spark, ledger)
    rows = spark.read.parquet(log)
    assert sorted(map(tuple, ledger_positions(entered).collect())) == sorted(map(tuple, positions(rows).collect())) == [("a", 37), ("b", 15)]
    totals = {r.counter: r.total for r in ledger_totals(entered).collect()}
    assert totals == {"rows": 47, "even": rows.where("seq_num % 2 = 0").count(), "none": 0}
    assert len(written) > len(set(written)) and entered.select("query").distinct().count() == 1
    assert {r.counter: r.total for r in ledger_totals(entered, ("stream",)).where("stream = 'b'").collect()} == {"rows": 10, "even": 5, "none": 0}


def test_poison_stalls_the_stream_and_a_repair_goes_on(spark, tmp_path):
    """A malformed record fails its batch again and again; once its file is repaired, nothing is lost or repeated."""
    from changeflow.sources.envelope import decode_json

    log, out, checkpoint = (str(tmp_path / x) for x in "loc")

    def put(name, bodies):
        rows = [(k, 0, [("dbz.op", "c")], bytearray(b.encode()), "s") for k, b in bodies]
        spark.createDataFrame(rows, FLAT).drop("stream").coalesce(1).write.mode("overwrite").parquet(str(tmp_path / "made"))
        os.makedirs(f"{log}/stream=s", exist_ok=True)
        (made,) = [f for f in os.listdir(tmp_path / "made") if f.endswith(".parquet")]
        os.replace(tmp_path / "made" / made, f"{log}/stream=s/{name}.parquet")
        crc = f"{log}/stream=s/.{name}.parquet.crc"
        if os.path.exists(crc):
            os.remove(crc)

    def run():
        rows = decode_json(read_log_stream(spark, log, files_per_batch=1), "id:int64", include_metadata=True)
        kept = rows.select("_op", "id", F.col("_stream").alias("stream"), F.col("_seq_num").alias("seq"))
        write_log_stream(kept, out, checkpoint).awaitTermination()

    put("a", [(0, '{"id":0}')])
    run()
    put("b", [(1, '{"id":1}'), (2, "poison")])
    for _ in range(2):
        with pytest.raises(Exception, match="seq_num 2"):
            run()
        assert [r.id for r in spark.read.parquet(out).collect()] == [0]
    put("b", [(1, '{"id":1}'), (2, '{"id":2}')])
    put("c", [(3, '{"id":3}')])
    run()
    assert sorted(r.id for r in spark.read.parquet(out).collect()) == [0, 1, 2, 3]
