import datetime as dt
from decimal import Decimal

import pytest
from changeflow.sources.changes import align_by_name, changes_for, coerce, normalize_changes, snapshot_rows, unclaimed_tables, with_snapshot
from changeflow.sources.envelope import decode_by_version, decode_json, envelope, from_position, is_single_json_object, malformed_rows, select_streams
from pyspark.errors import PySparkException
from pyspark.sql import Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

RECORD = "stream string, seq_num long, timestamp long, headers array<struct<key:string,value:string>>, body binary"

LOG = "stream string, seq_num long, timestamp long, headers array<struct<key:string,value:string>>, body binary"


def log(spark, bodies, stream="s"):
    return spark.createDataFrame([(stream, i, 1700000000000 + i, [], bytearray(b.encode()) if isinstance(b, str) else b) for i, b in enumerate(bodies)], LOG)


BODIES = [
    ('{"id":1}', True), ('{"id":1}{"id":2}', False), ('{"id":1},{"id":2}', False), ("", False), ("  \n", False), ("text", False), ("[1]", False), ("1", False),
    (' {"id":1}\n', True), ('{"id":1}],[2', False), ('{"id":"7"}', True), ('{"id":null}', True), ("{}", True), ('{"id":1} x', False), ("null", False),
]


def test_single_json_object(spark):
    df = spark.createDataFrame([(b,) for b, _ in BODIES], "b string")
    assert [r.v for r in df.select(is_single_json_object(F.col("b")).alias("v")).collect()] == [fine for _, fine in BODIES]


def test_decode_types(spark):
    body = '{"id":"7","n":1.5,"flag":"true","day":"2024-01-02","at":"2024-01-02T03:04:05","big":18446744073709551615,"nested":{"a":[1]},"a.b":"dot","extra":1}'
    row = decode_json(log(spark, [body]), "id:int64,n:string,flag:bool,day:date,at:timestamp,big:uint64,nested:string,a.b:string,gone:int32?").first()
    assert tuple(row) == ("i", 7, "1.5", True, dt.date(2024, 1, 2), dt.datetime(2024, 1, 2, 3, 4, 5), Decimal(18446744073709551615), '{"a":[1]}', "dot", None)


@pytest.mark.parametrize("body", ['{"id":1.5}', '{"id":"x"}', '{"id":null}', "{}", '{"id":300}', '{"id":-1}', "not json", '{"id":1}{"id":2}', None, b"\xff"])
def test_malformed(spark, body):
    body = bytearray(body) if isinstance(body, bytes) else body
    rows = log(spark, ['{"id":1}', body, '{"id":2}'])
    skipped = decode_json(rows, "id:uint8", on_malformed="skip", include_metadata=True)
    assert [(r.id, r._seq_num) for r in skipped.collect()] == [(1, 0), (2, 2)]
    assert [r.seq_num for r in malformed_rows(rows, "id:uint8").collect()] == [1]
    with pytest.raises(PySparkException, match="stream s, seq_num 1"):
        decode_json(rows, "id:uint8").collect()
    with pytest.raises(PySparkException):
        decode_json(rows, "id:uint8").select("_op").collect()  # also where no value is read
    with pytest.raises(ValueError):
        decode_json(rows, "id:uint8", on_malformed="drop")


def test_counts(spark):
    seen = Observation("decode")
    decode_json(log(spark, ['{"id":1}', "x"]), "id:int64", on_malformed="skip", observation=seen).collect()
    assert seen.get == {"malformed": 1, "records": 2}
    ops = Observation("ops")
    rows = log(spark, ["{}"]).withColumn("headers", F.expr("array(named_struct('key', 'dbz.op', 'value', 'bogus'))"))
    assert envelope(rows, observation=ops).first()._op == "i" and ops.get["unknown_ops"] == 1


def test_stream_selection(spark):
    rows = spark.createDataFrame([(s, i) for i, s in enumerate(["a", "b", "pre/1", "pre/2"])], "stream string, seq_num long")
    names = lambda df: [r.stream for r in df.collect()]
    assert names(select_streams(rows, streams=" a, b ,a")) == ["a", "b"]
    assert names(select_streams(rows, streams=["b"], stream_prefix="pre/")) == ["b", "pre/1", "pre/2"]
    for bad in ({}, {"streams": " , "}):
        with pytest.raises(ValueError):
            select_streams(rows, **bad)


def test_positions(spark):
    rows = spark.createDataFrame([(s, i) for s in "ab" for i in range(4)], "stream string, seq_num long")
    saved = spark.createDataFrame([("a", 2)], "stream string, next_seq long")
    at = lambda df: sorted((r.stream, r.seq_num) for r in df.collect())
    assert at(from_position(rows, saved)) == [("a", 2), ("a", 3)] + [("b", i) for i in range(4)]
    assert at(from_position(rows, saved, start_position="latest")) == [("a", 2), ("a", 3)]
    assert at(from_position(rows, start_position="latest")) == [] and len(at(from_position(rows))) == 8
    with pytest.raises(ValueError):
        from_position(rows, start_position="middle")


USERS = T.StructType([T.StructField("id", T.LongType()), T.StructField("name", T.StringType()), T.StructField("active", T.BooleanType())])
EVENT = "lsn long, ord long, tbl string, kind string, new map<string,string>, old map<string,string>, old_kind string"


def events(spark):
    new = {"id": "1", "name": "grace", "active": "true"}
    old = {"id": "1", "name": "ada", "active": "true"}
    rows = [
        (1, 0, "public.users", "insert", old, None, None), (2, 0, "public.users", "update", new, old, "full"), (3, 0, "public.users", "update", {"id": "1"}, {"id": "1"}, "key"),
        (4, 0, "public.users", "delete", None, {"id": "1", "name": "x"}, "key"), (5, 0, "public.users", "delete", None, None, None), (6, 0, "public.users", "truncate", None, None, None),
        (7, 0, "public.users", "copy", {"id": "2", "name": "bo", "active": "maybe"}, None, None), (8, 0, "public.other", "insert", {"id": "9"}, None, None), (9, 0, "public.users", "begin", None, None, None),
    ]
    return spark.createDataFrame(rows, EVENT)


@pytest.mark.parametrize("before", [False, True])
def test_normalize(spark, before):
    seen = Observation(f"changes-{before}")
    rows = normalize_changes(changes_for(events(spark), "users"), USERS, keys=["id"], emit_update_before=before, observation=seen)
    # Sorted here: a sort in Spark looks at its input twice, and the counters with it.
    got = [tuple(r)[0:2] + tuple(r)[4:] for r in sorted(rows.collect(), key=lambda r: (r.lsn, r.ord, r.seq))]
    want = [("i", 1, 1, "ada", True), ("d", 2, 1, "ada", True), ("u", 2, 1, "grace", True), ("u", 3, 1, None, None), ("d", 4, 1, None, None), ("i", 7, 2, "bo", None)]
    assert got == [w for w in want if before or w[:2] != ("d", 2)]
    assert seen.get == {"other_events": 2, "deletes_without_image": 1, "updates_without_before": 1}
    with pytest.raises(ValueError):
        normalize_changes(events(spark), USERS, keys=["nope"])


def test_unclaimed(spark):
    assert [tuple(r) for r in unclaimed_tables(events(spark), ["users"]).collect()] == [("public.other", 1)]


def test_align_and_coerce(spark):
    df = spark.createDataFrame([("x", 1, 2.5, "u", "12")], "extra string, b int, f float, _op string, s string")
    got = align_by_name(df, T.StructType.fromDDL("f double, missing date, b bigint, s int"))
    assert got.columns == ["_op", "f", "missing", "b", "s"] and tuple(got.first()) == ("u", 2.5, None, 1, 12)
    assert tuple(coerce(df.select("b", "s"), T.StructType.fromDDL("b string, s boolean")).first()) == (None, None)


def test_snapshot(spark):
    snap = snapshot_rows(spark.createDataFrame([(1, "a")], "id long, name string"), ["id", "name"])
    live = spark.createDataFrame([("u", 5, 0, 1)], "_op string, lsn long, ord long, id long")
    assert [tuple(r) for r in with_snapshot(snap, live).orderBy("lsn").collect()] == [("i", 0, 0, 1, "a"), ("u", 5, 0, 1, None)]


def test_values_are_taken_strictly(spark):
    """One value a body: what is taken for the type, and what is malformed."""
    cases = {
        "int64": {"7": 7, '"7"': 7, "1e3": 1000, "5.0": 5, "-0": 0, "1.5": None, '"1.5"': None, "true": None, "[1]": None, '{"a":1}': None, '""': None, "9223372036854775808": None},
        "float64": {"1.5": 1.5, '"2"': 2.0, "true": None, "[1.0]": None, '"x"': None},
        "uint8": {"255": 255, "256": None, "-1": None, "true": None},
        "uint64": {"18446744073709551615": 18446744073709551615, "18446744073709551616": None, "0.5": None},
        "bool": {"true": True, '"False"': False, "1": None, '"yes"': None},
        "date": {'"2024-02-29"': "2024-02-29", '"2023-02-29"': None, "2024": None, "true": None},
        "string": {'"a\\u00e9"': "a\u00e9", "1.50": "1.5", "12345678901234567890.5": "12345678901234567890.5", "true": "true", '{"b": 1}': '{"b":1}'},
    }
    for kind, values in cases.items():
        bodies = [(f'{{"v":{text}}}', n) for n, text in enumerate(values)]
        df = spark.createDataFrame([("s", n, 0, [], bytearray(b.encode())) for b, n in bodies], RECORD)
        got = {r._seq_num: r.v for r in decode_json(df, f"v:{kind}", on_malformed="skip", include_metadata=True).collect()}
        assert {n: str(v) for n, v in got.items()} == {n: str(v) for n, v in enumerate(values.values()) if v is not None}, kind
        assert malformed_rows(df, f"v:{kind}").count() == sum(v is None for v in values.values())


def test_bodies_that_are_one_object(spark):
    good = ['{"id":1}', ' \t\r\n{"id":1}\n', '{"id":1,"x":1,"x":2}', '{"x":{"id":2},"id":1}', '{"id":2,"id":1}', '{"id":1,"y":"],["}']
    bad = ["{'id':1}", "{id:1}", '{"id":NaN}', '{"id":1}{"id":2}', '{"id":1},{"id":2}', '[{"id":1}]', "null", "1", '"id"', "", " ", '{"id":1', '{"id":1}],[2', '{"id":1}]', "\u00a0{}", '{"id":null}', "{}", '{"id":01}', '{"id":1,}']
    for bodies, fine in ((good, True), (bad, False)):
        df = spark.createDataFrame([("s", n, 0, [], bytearray(b.encode())) for n, b in enumerate(bodies)], RECORD)
        assert [r.id for r in decode_json(df, "id:int64", on_malformed="skip").collect()] == [1] * (len(bodies) if fine else 0)
        assert malformed_rows(df, "id:int64").count() == (0 if fine else len(bodies))


def test_a_body_is_parsed_once(spark):
    df = spark.createDataFrame([("s", 0, 0, [], bytearray(b'{"id":1}'))], RECORD)
    for mode in ("skip", "error"):
        plan = decode_json(df, "id:int64,v:string?", on_malformed=mode)._jdf.queryExecution().executedPlan().toString()
        assert plan.count("from_json(") == 1


def test_images_decoded_by_the_schema_in_force(spark):
    events = spark.createDataFrame([
        ("t", 5, '{"id":1}'), ("t", 10, '{"id":1,"v":2}'), ("t", 15, '{"id":"x","v":"2"}'), ("t", 20, '{"id":3000000000,"v":1.5}'), ("t", 25, '{"v":7}'),
        ("t", 30, '{"id":1,"v":"2024"}'), ("t", 31, "{}{}"), ("u", 30, '{"id":"text","v":null}'), ("none", 1, "{}"), ("t", None, '{"id":1}'),
    ], "tbl string, lsn long, body string")
    versions = spark.createDataFrame([("t", 10, "id:int32,v:string?"), ("t", 20, "id:int64,v:float64?"), ("t", 30, "id:int64"), ("u", 1, "id:string,v:int64?")], "tbl string, snapshot_id long, schema string")
    got = {(r.tbl, r.lsn): (r.snapshot_id, r.id, r.v, r.malformed) for r in decode_by_version(events, versions, "id:int64,v:string,more:date").collect()}
    assert got == {
        ("t", 5): (None, None, None, True), ("t", 10): (10, 1, "2", False), ("t", 15): (10, None, "2", True), ("t", 20): (20, 3000000000, None, False), ("t", 25): (20, None, None, True),
        ("t", 30): (30, 1, None, False), ("t", 31): (30, None, None, True), ("u", 30): (1, None, None, False), ("none", 1): (None, None, None, True), ("t", None): (None, None, None, True),
    }
    with pytest.raises(ValueError):
        decode_by_version(events, versions, "id:int64", most=3)
    with pytest.raises(ValueError):
        decode_by_version(events, versions.union(versions.select("tbl", "snapshot_id", F.lit("id:bool"))), "id:int64")
