import itertools
import random
import shutil
from pathlib import Path

import pytest
from changeflow.operators.messages import to_log_records
from changeflow.operators.state import apply_changes, first_by_key, fold_changes, latest_by_key
from changeflow.sources.envelope import decode_json, from_position, select_streams
from changeflow.streaming.streams import Counters, append_changes, compact, merged, message_stream, parquet_stream, read_log_stream, relational_stream, write_log_stream
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

RECORD = "stream string, seq_num long, timestamp long, headers array<struct<key:string,value:string>>, body binary"
CHANGE = "_op string, lsn long, ord long, id long, v string"


def records(spark, stream, first, ops):
    rows = [(stream, first + i, 1700000000000, [("dbz.op", op)] if op else [], bytearray(f'{{"id":{n},"v":"{v}"}}'.encode())) for i, (op, n, v) in enumerate(ops)]
    return spark.createDataFrame(rows, RECORD)


def changes_of(log):
    changes = decode_json(log, "id:int64,v:string", include_metadata=True)
    return changes.select("_op", F.col("_seq_num").alias("lsn"), F.lit(0).cast("long").alias("ord"), "id", "v")


def held(df):
    return sorted((r.id, r.v) for r in df.collect())


def test_merge_resume_and_replay(spark, tmp_path):
    log, table, checkpoint = (str(tmp_path / x) for x in "ltc")
    one, two = [(None, 1, "a"), ("c", 2, "b"), ("u", 1, "a2")], [("d", 2, ""), ("c", 3, "c")]

    def run():
        rows = select_streams(read_log_stream(spark, log, files_per_batch=1), stream_prefix="app/")
        append_changes(changes_of(rows), table, checkpoint).awaitTermination()
        return merged(spark.read.schema(CHANGE).parquet(table), ["id"])

    records(spark, "app/1", 0, one).repartition(3).write.partitionBy("stream").parquet(log)
    records(spark, "other", 0, [("c", 77, "x")]).write.mode("append").partitionBy("stream").parquet(log)
    assert held(run()) == [(1, "a2"), (2, "b")]
    # A stream that is new in the second run is found, nothing is read twice.
    records(spark, "app/2", 10, two).write.mode("append").partitionBy("stream").parquet(log)
    assert held(run()) == [(1, "a2"), (3, "c")]
    assert spark.read.parquet(table).count() == 5
    batch = changes_of(select_streams(spark.read.parquet(log), stream_prefix="app/"))
    assert held(latest_by_key(batch, ["id"])) == [(1, "a2"), (3, "c")]
    # Compacted, with a change appended afterwards that is older than what is there.
    compact(spark.read.schema(CHANGE).parquet(table), str(tmp_path / "n"), ["id"])
    spark.createDataFrame([("u", 1, 0, 1, "late"), ("i", 9, 0, 2, "older than the delete")], CHANGE).write.mode("append").parquet(str(tmp_path / "n"))
    assert held(merged(spark.read.schema(CHANGE).parquet(str(tmp_path / "n")), ["id"])) == [(1, "a2"), (3, "c")]


@pytest.mark.parametrize("on_conflict", ["update", "nothing"])
def test_batches_in_every_order(spark, on_conflict):
    """Deletes, re-created rows and repeated batches: always what one batch of all gives."""
    batches = [[("i", 1, 0, 1, "a"), ("u", 5, 0, 1, "b")], [("d", 2, 0, 1, None), ("i", 3, 0, 2, "x")], [("i", 3, 0, 1, "c"), ("d", 4, 0, 2, None)]]
    frames = [spark.createDataFrame(b, CHANGE) for b in batches]
    fold = latest_by_key if on_conflict == "update" else first_by_key
    every = fold(frames[0].union(frames[1]).union(frames[2]), ["id"])
    expected = held(every)
    target = spark.createDataFrame([], "id long, v string")
    assert expected == held(apply_changes(target, frames[0].union(frames[1]).union(frames[2]), ["id"], on_conflict=on_conflict)) == [(1, "b" if on_conflict == "update" else "c")]
    for way in itertools.permutations(range(3)):
        state = frames[0].limit(0)
        for k in [*way, random.choice(way)]:
            state = fold_changes(state, frames[k], ["id"], on_conflict=on_conflict)
        assert held(fold(state, ["id"])) == expected


def test_sinks(spark, tmp_path):
    log = str(tmp_path / "log")
    records(spark, "app/1", 0, [("c", 1, "a"), ("u", 1, "b"), ("d", 2, None)]).coalesce(1).write.partitionBy("stream").parquet(log)
    rows = changes_of(read_log_stream(spark, log))
    parquet_stream(rows, out := str(tmp_path / "p"), str(tmp_path / "c1"), partition_columns="v").awaitTermination()
    assert sorted((r.id, r.v) for r in spark.read.parquet(out).where("_op <> 'd'").collect()) == [(1, "a"), (1, "b")]
    staged = []
    relational_stream(rows, lambda batch: staged.extend(batch.collect()), ["id"], str(tmp_path / "c2"), trigger={"once": True}).awaitTermination()
    assert sorted((r.id, r._op, r.v) for r in staged) == [(1, "u", "b"), (2, "d", None)]
    sent = str(tmp_path / "sent")

    def sender():
        def send(batch):
            with open(sent, "a") as f:
                f.writelines(body + "\n" for _, body in batch)
            return []

        return send

    message_stream(rows.select("id", "v"), sender, str(tmp_path / "c3")).awaitTermination()
    assert sorted(open(sent)) == ['{"id":1,"v":"a"}\n', '{"id":1,"v":"b"}\n', '{"id":2,"v":"None"}\n']


def test_stream_keeps_running_and_starts_at_the_tail(spark, tmp_path):
    log, out = str(tmp_path / "log"), str(tmp_path / "out")
    records(spark, "app/1", 0, [("c", 1, "old")]).write.partitionBy("stream").parquet(log)
    tails = spark.createDataFrame([("app/1", 1)], "stream string, next_seq long")
    with pytest.raises(ValueError):
        from_position(read_log_stream(spark, log), start_position="latest")
    rows = from_position(read_log_stream(spark, log), start_position="latest", tails=tails)
    query = append_changes(changes_of(rows), out, str(tmp_path / "c"), trigger={"processingTime": "200 milliseconds"})
    try:
        query.processAllAvailable()
        records(spark, "app/1", 1, [("u", 1, "new")]).write.mode("append").partitionBy("stream").parquet(log)
        records(spark, "app/2", 0, [("c", 5, "found while running")]).write.mode("append").partitionBy("stream").parquet(log)
        query.processAllAvailable()
        assert held(spark.read.schema(CHANGE).parquet(out)) == [(1, "new"), (5, "found while running")]
    finally:
        query.stop()


def test_log_sink_and_counters(spark, tmp_path):
    counters = Counters()
    spark.streams.addListener(counters)
    log, out = str(tmp_path / "log"), str(tmp_path / "out")
    records(spark, "app/1", 0, [("c", 1, "a"), ("d", 1, "a")]).write.partitionBy("stream").parquet(log)
    rows = decode_json(read_log_stream(spark, log), "id:int64,v:string").observe("sink", F.count(F.lit(1)).alias("rows"))
    write_log_stream(to_log_records(rows, stream="copy"), out, str(tmp_path / "c")).awaitTermination()
    got = spark.read.parquet(out).collect()
    assert sorted((r.stream, r.headers[0].value, r.body) for r in got) == [("copy", "c", '{"id":1,"v":"a"}'), ("copy", "d", '{"id":1,"v":"a"}')]
    other = write_log_stream(to_log_records(rows.where("_op = 'i'"), stream="other"), str(tmp_path / "o"), str(tmp_path / "c2"))
    other.awaitTermination()
    for _ in range(100):
        if counters.total("sink", "rows") == 4:
            break
        spark.sparkContext._jvm.Thread.sleep(100)
    spark.streams.removeListener(counters)
    assert counters.totals[str(other.id)] == {"sink": {"rows": 2}}
    assert len(counters.totals) == 2 and counters.total("sink", "rows") == 4


def test_a_poison_record_stalls_the_stream_until_it_is_repaired(spark, tmp_path):
    log, table, checkpoint = (str(tmp_path / x) for x in "ltc")

    def run():
        append_changes(changes_of(read_log_stream(spark, log, files_per_batch=1)), table, checkpoint).awaitTermination()

    def lone_file(folder):
        return next(p for p in Path(folder).rglob("*.parquet"))

    records(spark, "app/1", 0, [("c", 1, "a")]).coalesce(1).write.partitionBy("stream").parquet(log)
    run()
    poison = records(spark, "app/1", 1, [("c", 2, "b")]).withColumn("body", F.lit(b"{not json"))
    poison.coalesce(1).write.partitionBy("stream").parquet(str(tmp_path / "poison"))
    bad = Path(log) / "stream=app%2F1" / "part-bad.parquet"
    shutil.copyfile(lone_file(tmp_path / "poison"), bad)
    for _ in range(2):  # a restart meets it again: nothing is skipped
        with pytest.raises(StreamingQueryException, match="malformed record"):
            run()
    records(spark, "app/1", 2, [("c", 3, "c")]).coalesce(1).write.mode("append").partitionBy("stream").parquet(log)
    with pytest.raises(StreamingQueryException, match="malformed record"):
        run()  # what comes after it waits
    assert held(spark.read.schema(CHANGE).parquet(table)) == [(1, "a")]
    records(spark, "app/1", 1, [("c", 2, "b")]).coalesce(1).write.partitionBy("stream").parquet(str(tmp_path / "repaired"))
    shutil.copyfile(lone_file(tmp_path / "repaired"), bad)
    run()
    assert held(spark.read.schema(CHANGE).parquet(table)) == [(1, "a"), (2, "b"), (3, "c")]
