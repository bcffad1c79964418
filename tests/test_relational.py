"""Relational tables, on the Derby that comes with Spark."""

import datetime
import random
import uuid
from decimal import Decimal

import pytest
from changeflow.functions.schema import create_table_sql
from changeflow.operators.relational import last_operations, merge_into, run_statement, stage
from changeflow.operators.state import apply_changes
from changeflow.streaming.streams import relational_merge_stream
from pyspark.sql import functions as F

PROBE = "SELECT 1 AS x FROM SYSIBM.SYSDUMMY1"
CHANGE = "_op string, lsn long, ord long, id long, v string"
#: Derby's text for lengths that are not known is a CLOB, which Spark reads as text.
ALL = "flag boolean, b1 byte, b2 short, b4 int, b8 long, f4 float, f8 double, text string, raw binary, day date, at timestamp, local timestamp_ntz, amount decimal(18,4), s struct<a:int,t:string>, l array<long>, m map<string,long>"


@pytest.fixture
def url():
    return f"jdbc:derby:memory:{uuid.uuid4().hex};create=true"


def everything(spark):
    at = datetime.datetime(2024, 2, 29, 23, 59, 58, 123456)
    row = (True, -7, 300, -70000, 2**62, 0.5, -1.25, "x\u00e9 'quoted'", bytearray(b"\x00\xff\x01"), at.date(), at.replace(tzinfo=datetime.UTC), at, Decimal("-12.3400"), (1, "t"), [1, 2], {"k": 3})
    return spark.createDataFrame([row, (None,) * 16], ALL)


def test_all_types_come_back(spark, url):
    df = everything(spark)
    stage(df, url, "s", dialect="standard")
    back = {r.B8 if hasattr(r, "B8") else r.b8: r for r in spark.read.jdbc(url, '"s"').collect()}
    want = {r.b8: r for r in df.collect()}
    assert set(back) == set(want)
    for c in df.columns[:13]:
        # Zone-less times come back as times of the session's zone, UTC here.
        got, given = back[2**62][c], want[2**62][c]
        assert got == given, c
    assert (back[2**62].s, back[2**62].l, back[2**62].m) == ('{"a":1,"t":"t"}', "[1,2]", '{"k":3}')
    assert all(back[None][c] is None for c in df.columns)
    stage(df.limit(1), url, "s", dialect="standard", batch_size=1)
    assert spark.read.jdbc(url, '"s"').count() == 1


@pytest.mark.parametrize("on_conflict", ["update", "nothing"])
def test_merges_equal_changes_applied(spark, url, on_conflict):
    rng = random.Random(3)
    target = spark.createDataFrame([(k, f"t{k}") for k in range(0, 14, 2)], "id long, v string")
    run_statement(spark, url, create_table_sql(target.schema, "t", ["id"], dialect="standard"), probe=PROBE)
    target.write.mode("append").jdbc(url, '"t"')
    want = target
    for batch in range(3):
        # Later batches are later changes.
        changes = spark.createDataFrame([(rng.choice("iud"), 100 * batch + n, 0, rng.randrange(14), f"c{batch}.{n}") for n in range(25)], CHANGE)
        for _ in range(2):  # a repeated batch of an upsert changes nothing
            merge_into(changes, url, "t", ["id"], on_conflict=on_conflict, dialect="standard", probe=PROBE)
            if on_conflict == "nothing":
                break
        want = spark.createDataFrame(apply_changes(want, changes, ["id"], on_conflict=on_conflict).collect(), "id long, v string")
        assert sorted(map(tuple, spark.read.jdbc(url, '"t"').collect())) == sorted(map(tuple, want.collect()))


def test_composite_text_keys_and_times(spark, url):
    rows = [("i", 1, 0, "a", 1, datetime.datetime(2024, 1, 1, 1, 1, 1, 5), bytearray(b"\xff")), ("u", 2, 0, "a", 1, datetime.datetime(2024, 1, 1, 1, 1, 1, 999999), bytearray(b"")), ("i", 1, 0, "b", 1, None, None), ("d", 3, 0, "b", 1, None, None)]
    df = spark.createDataFrame(rows, "_op string, lsn long, ord long, name string, n int, at timestamp_ntz, raw binary")
    run_statement(spark, url, create_table_sql(df.drop("lsn", "ord").schema, "t", ["name", "n"], dialect="standard"), probe=PROBE)
    merge_into(df, url, "t", ["name", "n"], dialect="standard", probe=PROBE)
    (got,) = spark.read.jdbc(url, '"t"').collect()
    assert (got.name, got.n, got["at"], bytes(got.raw)) == ("a", 1, datetime.datetime(2024, 1, 1, 1, 1, 1, 999999), b"")


def test_last_operations_read_the_changes_once(spark):
    df = spark.createDataFrame([("i", 1, 0, 1, "a")], CHANGE)
    count = lambda on: last_operations(df, ["id"], on_conflict=on)._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")
    assert count("update") == 1 and count("nothing") <= 4


@pytest.mark.parametrize("on_conflict", ["update", "nothing"])
def test_null_keys_and_deletes(spark, on_conflict):
    df = spark.createDataFrame([("i", 1, 0, None, "a"), ("d", 2, 0, None, None), ("u", 3, 0, None, "b"), ("d", 1, 0, 2, "old image"), ("i", 1, 0, 3, "c")], CHANGE)
    got = sorted(((r.id, r._op, r.v) for r in last_operations(df, ["id"], on_conflict=on_conflict).collect()), key=str)
    assert got == [(2, "d", None), (3, "i", "c"), (None, "u", "b")]


def test_stream_into_a_table(spark, url, tmp_path):
    """Two runs of a stream, the second after more changes."""
    log, checkpoint = str(tmp_path / "log"), str(tmp_path / "c")
    run_statement(spark, url, create_table_sql(spark.createDataFrame([], "id long, v string").schema, "t", ["id"], dialect="standard"), probe=PROBE)
    for batch, want in (([("i", 1, 0, 1, "a"), ("i", 2, 0, 2, "b")], [(1, "a"), (2, "b")]), ([("d", 3, 0, 1, None), ("u", 4, 0, 2, "b2"), ("i", 5, 0, 3, "c")], [(2, "b2"), (3, "c")])):
        spark.createDataFrame(batch, CHANGE).write.mode("append").parquet(log)
        changes = spark.readStream.schema(CHANGE).parquet(log)
        relational_merge_stream(changes, url, "t", ["id"], checkpoint, dialect="standard", probe=PROBE).awaitTermination()
        assert sorted(map(tuple, spark.read.jdbc(url, '"t"').collect())) == want


def test_statements_of_a_dialect():
    from changeflow.operators.relational import merge_statements

    gone, put = merge_statements("t", "s", ["id", "v"], ["id"], on_conflict="nothing", dialect="standard")
    assert gone == 'MERGE INTO "t" t USING "s" s ON t."id" = s."id" WHEN MATCHED AND (s."_op" = \'d\' OR s."_cleared") THEN DELETE'
    assert put == 'MERGE INTO "t" t USING "s" s ON t."id" = s."id" WHEN NOT MATCHED AND s."_op" <> \'d\' THEN INSERT ("id", "v") VALUES (s."id", s."v")'
    assert "UPDATE" in merge_statements("t", "s", ["id", "v"], ["id"], dialect="standard")[1]
    assert "`a``b`" in merge_statements("t", "s", ["a`b"], ["a`b"])[1]
    with pytest.raises(ValueError):
        merge_statements("t", "s", ["id"], ["id"], dialect="oracle")


def test_streamed_batches_are_read_once(spark, url):
    """Whatever a batch is made from runs once for each aggregation of it, not for each statement."""
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            seen.add(len(b))
            yield b

    run_statement(spark, url, create_table_sql(spark.createDataFrame([], "id long, v string").schema, "t", ["id"], dialect="standard"), probe=PROBE)
    df = spark.createDataFrame([("i", k, 0, k, "a") for k in range(50)], CHANGE).mapInPandas(count, CHANGE)
    merge_into(df.where(F.col("id") >= 0), url, "t", ["id"], dialect="standard", probe=PROBE)
    assert seen.value == 50
