import json
import random

import pytest
from changeflow.operators.layout import partition_counts, write_parquet
from changeflow.operators.messages import SendError, deliver, message_batches, render_relational, route_runs, row_to_json, to_log_records
from changeflow.operators.progress import catalog_diff, dedupe_replay, merge_positions, positions, prune_versions, schema_asof
from changeflow.operators.ranges import cuts_of, numbered, range_of
from changeflow.operators.relational import last_operations
from changeflow.operators.state import apply_changes, change_counts, first_by_key, fold_changes, latest_by_key, null_operations, retract_agg, retract_extremes, split_ops
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

CHANGE = "_op string, lsn long, ord long, id long, v string"
ROWS = [("i", 1, 0, 1, "a"), ("d", 2, 0, 1, None), ("i", 3, 0, 1, "b"), ("u", 4, 0, 1, "c"), ("i", 1, 1, 2, "x"), ("d", 9, 0, 2, None), ("i", 5, 0, 3, "p"), ("i", 5, 1, 3, "q")]


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_folds(spark):
    df = spark.createDataFrame(ROWS, CHANGE)
    assert rows(latest_by_key(df, ["id"]).select("id", "v")) == [(1, "c"), (3, "q")]
    assert rows(first_by_key(df, ["id"]).select("id", "v")) == [(1, "b"), (3, "p")]
    assert rows(latest_by_key(df, ["id", "v"]).select("id", "v")) == [(1, "a"), (1, "b"), (1, "c"), (2, "x"), (3, "p"), (3, "q")]
    assert latest_by_key(df.limit(0), ["id"]).count() == 0


def test_latest_combines_before_its_only_shuffle(spark):
    plan = latest_by_key(spark.createDataFrame(ROWS, CHANGE), ["id"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "partial_max_by" in plan and "Window" not in plan


def test_retraction(spark):
    df = spark.createDataFrame([("i", "A", 5), ("i", "A", 7), ("d", "A", 5), ("u", "B", 6), ("d", "B", 6)], "_op string, g string, n long")
    assert rows(retract_agg(df, ["g"], ["n"])) == [("A", 1, 7), ("B", 0, 0)]
    # A null is a group; an image that isn't complete is an error where the rows tell so.
    none = spark.createDataFrame([("i", None, 4), ("d", None, 4)], df.schema)
    assert rows(retract_agg(df.union(none), ["g"], ["n"])) == [("A", 1, 7), ("B", 0, 0), (None, 0, 0)]
    told = df.withColumn("full", F.col("_op") != "d")
    with pytest.raises(PySparkException):
        retract_agg(told, ["g"], ["n"], complete="full").collect()
    assert rows(retract_agg(told.withColumn("full", F.lit(True)), ["g"], ["n"], complete="full")) == [("A", 1, 7), ("B", 0, 0)]


def test_extremes_under_retraction(spark):
    """A deleted maximum gives way to the next, against folding the changes by hand."""
    rng = random.Random(8)
    for by in (["g"], ["g", "h"], []):
        held, log = [], []
        for _ in range(400):
            if held and rng.random() < 0.45:
                log.append(("d", *held.pop(rng.randrange(len(held)))))
            else:
                held.append((rng.choice(["A", "B", None]), rng.randrange(2), rng.choice([None, *range(9)])))
                log.append((rng.choice("iu"), *held[-1]))
        rng.shuffle(log)
        groups = {}
        for g, h, v in held:
            if v is not None:
                groups.setdefault((g, h)[: len(by)], []).append(v)
        want = [(*k, len(v), len(set(v)), min(v), max(v), sorted(v, reverse=True)[:3]) for k, v in groups.items()]
        got = retract_extremes(spark.createDataFrame(log, "_op string, g string, h long, v long"), by, "v", k=3)
        assert rows(got) == sorted(want, key=str)
    df = spark.createDataFrame([("i", "A", 5), ("i", "A", 7), ("d", "A", 7)], "_op string, g string, n long")
    assert rows(retract_extremes(df, ["g"], "n")) == [("A", 1, 1, 5, 5)]
    assert retract_extremes(df.union(df.where("_op = 'd'").withColumn("n", F.lit(5))), ["g"], "n").count() == 0
    with pytest.raises(PySparkException):
        retract_extremes(df.union(df.where("_op = 'd'")), ["g"], "n").collect()
    with pytest.raises(ValueError):
        retract_extremes(df, ["g"], "n", k=-1)


def test_null_operations_are_errors(spark):
    df = spark.createDataFrame([("i", 1, 0, 1, "a"), (None, 2, 0, 1, "b"), ("u", 3, 0, 2, "c")], CHANGE)
    target = spark.createDataFrame([(1, "old")], "id long, v string")
    calls = [
        lambda: latest_by_key(df, ["id"]), lambda: first_by_key(df, ["id"]), lambda: retract_agg(df, ["v"], ["id"]), lambda: change_counts(df), lambda: split_ops(df)[0],
        lambda: split_ops(df)[1], lambda: apply_changes(target, df, ["id"]), lambda: apply_changes(target, df, ["id"], on_conflict="nothing"), lambda: apply_changes(target, df, []),
        lambda: fold_changes(df.limit(0), df, ["id"]), lambda: fold_changes(df.limit(0), df, ["id"], on_conflict="nothing"), lambda: last_operations(df, ["id"]),
        lambda: last_operations(df, ["id"], on_conflict="nothing"), lambda: retract_extremes(df, ["v"], "id"), lambda: to_log_records(df, stream="s"),
    ]
    for call in calls:
        with pytest.raises(PySparkException, match="(?i)null"):
            call().collect()
    assert rows(null_operations(df, ("v",))) == [("a", 1, 0), ("b", 1, 1), ("c", 1, 0)]
    assert rows(latest_by_key(df.where("_op is not null"), ["id"]).select("id", "v")) == [(1, "a"), (2, "c")]


def test_counts_and_split(spark):
    df = spark.createDataFrame(ROWS, CHANGE)
    assert rows(change_counts(df)) == [(8, 5, 1, 2)]
    up, gone = split_ops(df)
    assert (up.count(), gone.count()) == (6, 2)
    assert split_ops(df.drop("_op"))[1].count() == 0
    with pytest.raises(PySparkException):
        split_ops(df.withColumn("_op", F.lit(None).cast("string")))[0].collect()


def test_apply(spark):
    target = spark.createDataFrame([(1, "old"), (2, "old"), (7, "stays")], "id long, v string")
    df = spark.createDataFrame(ROWS, CHANGE)
    assert rows(apply_changes(target, df, ["id"])) == [(1, "c"), (3, "q"), (7, "stays")]
    writes = df.where("_op <> 'd'")
    assert rows(apply_changes(target, writes, ["id"], on_conflict="nothing")) == [(1, "old"), (2, "old"), (3, "p"), (7, "stays")]
    once = apply_changes(target, df, ["id"])
    assert rows(apply_changes(once, df, ["id"])) == rows(once)
    assert apply_changes(target, writes, []).count() == 9
    with pytest.raises(PySparkException):
        apply_changes(target, df, []).collect()
    with pytest.raises(ValueError):
        apply_changes(target, df, ["id"], on_conflict="replace")
    # Composite keys, and a key that is deleted and written again.
    two = spark.createDataFrame([("i", 1, 0, 1, "a"), ("d", 2, 0, 1, "a"), ("i", 3, 0, 1, "a")], CHANGE)
    assert rows(apply_changes(target.limit(0), two, ["id", "v"])) == [(1, "a")]


def test_write_parquet(spark, tmp_path):
    df = spark.createDataFrame([(1, "", "x y"), (2, None, "x y"), (3, "a/b", "z")], "id long, dt string, c string")
    write_parquet(df, f"{tmp_path}/plain/")
    write_parquet(df, f"{tmp_path}/plain")
    assert spark.read.parquet(f"{tmp_path}/plain").count() == 6
    write_parquet(df, f"{tmp_path}/exact", partition_columns="dt,c", exact_paths=True)
    back = spark.read.parquet(f"{tmp_path}/exact")
    assert rows(back.select("id", "dt", "c")) == rows(df)
    assert rows(back.select("segment").distinct()) == [("dt=/c=x%20y",), ("dt=__HIVE_DEFAULT_PARTITION__/c=x%20y",), ("dt=a%2Fb/c=z",)]
    assert partition_counts(df, ["c"]).count() == 2
    write_parquet(df, f"{tmp_path}/hive", partition_columns="c")
    assert spark.read.parquet(f"{tmp_path}/hive").where("c = 'z'").count() == 1
    with pytest.raises(ValueError):
        write_parquet(df, f"{tmp_path}/x", partition_columns="nope")


def test_json(spark):
    df = spark.createDataFrame([("u", 1, None, bytearray(b"\x01\xff"))], "_op string, id long, v string, b binary")
    assert row_to_json(df).first().body == '{"_op":"u","id":1,"b":"01ff"}'
    assert row_to_json(df, include_op=False).first().body == '{"id":1,"b":"01ff"}'
    big = df.withColumn("b", F.unhex(F.lit("00" * 31 + "0a")))
    assert row_to_json(big, include_op=False, u256=("b",)).first().body == '{"id":1,"b":"10"}'
    assert render_relational(df.select("id", "v")).first().id == 1


def test_one_json_for_all_ways(spark):
    """Bytes are hex at every depth and 256-bit numbers decimal, alone, in batches and in log records."""
    kind = "id long, b binary, s struct<b:binary,n:long>, a array<binary>, m map<string,array<struct<x:binary>>>, big binary, _op string"
    raw = bytearray(b"\x01\xff")
    df = spark.createDataFrame([(1, raw, (raw, None), [raw, None], {"k": [(raw,), (None,)]}, bytearray(31) + bytearray([7]), "i"), (2, None, None, None, None, None, "u")], kind)
    body = '{"id":1,"b":"01ff","s":{"b":"01ff"},"a":["01ff",null],"m":{"k":[{"x":"01ff"},{}]},"big":"7"}'
    plain = row_to_json(df, include_op=False, u256=("big",)).collect()
    logged = to_log_records(df, stream="s", u256=("big",)).collect()
    assert [r.body for r in plain] == [r.body for r in logged] == [body, '{"id":2}']
    rest = df.drop("big")
    cut = [b for r in message_batches(rest).collect() for b in r.bodies]
    by = [b for r in message_batches(rest, by="id", order=("id",)).collect() for b in r.bodies]
    assert sorted(cut) == sorted(by) == sorted(r.body for r in row_to_json(rest).collect())
    with pytest.raises(PySparkException):
        row_to_json(df, u256=("b",)).collect()


def test_log_records(spark):
    df = spark.createDataFrame([("i", 1, "acme"), ("d", 2, "globex")], "_op string, id long, tenant string")
    got = to_log_records(df, template="t/{tenant}").collect()
    assert [(r.stream, r.headers[0].value, r.body) for r in got] == [("t/acme", "c", '{"id":1,"tenant":"acme"}'), ("t/globex", "d", '{"id":2,"tenant":"globex"}')]
    with pytest.raises(PySparkException):
        to_log_records(df, stream="s", max_bytes=5).collect()
    for bad in ({}, {"stream": "s", "template": "t"}):
        with pytest.raises(ValueError):
            to_log_records(df, **bad)
    with pytest.raises(ValueError):
        to_log_records(df.drop("_op"), stream="s")


def test_runs(spark):
    df = spark.createDataFrame([(k, c, "one") for k, c in enumerate("aabba")], "seq long, stream string, source string")
    assert rows(route_runs(df, order=("seq",), by=("source",)).drop("source")) == [("a", 0, 1, 2), ("a", 4, 4, 1), ("b", 2, 3, 2)]
    with pytest.raises(ValueError):
        route_runs(df, order=())


def by_hand(given, size=None):
    """Runs of (group, seq, stream) rows."""
    out, group = {}, {}
    for g, seq, stream in sorted(given, key=lambda r: (str(r[0]), r[1])):
        mine = out.setdefault(g, [])
        if mine and group.get(g) == stream:
            mine[-1][2:] = [seq, mine[-1][3] + 1]
        else:
            mine.append([stream, seq, seq, 1])
        group[g] = stream
    return sorted(((g, *r) for g, rs in out.items() for r in rs), key=str)


@pytest.mark.parametrize("ranges", [1, 2, 7, 40, None])
def test_runs_across_ranges(spark, ranges):
    rng = random.Random(ranges or 0)
    for choice in ("ab", "a", ["a", None], "abcdef"):
        given = [(rng.choice(["x", "x", "x", "y", None]), 3 * k, rng.choice(choice) if rng.random() < 0.4 else choice[0]) for k in range(300)]
        rng.shuffle(given)
        df = spark.createDataFrame(given, "source string, seq long, stream string")
        assert rows(route_runs(df, order=("seq",), by=("source",), ranges=ranges)) == by_hand(given)
        one = [(0, seq, stream) for _, seq, stream in given]
        assert rows(route_runs(df, order=("seq",), ranges=ranges)) == sorted((r[1:] for r in by_hand(one)), key=str)
    assert route_runs(df.limit(0), order=("seq",)).count() == 0


def test_one_source_is_dealt_to_ranges(spark):
    """No task of a window has more than its range, also when all rows are one sequence."""
    df = spark.range(8000).select(F.col("id").alias("seq"), (F.col("id") % 3).cast("string").alias("stream"))
    plan = route_runs(df, order=("seq",), ranges=8)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("SinglePartition") <= 2 and "hashpartitioning(_range" in plan
    users = df.withColumn("user", F.lit(1))
    at = numbered(users, ["user"], ["seq"], as_col="at", ranges=8)
    assert at.where("at <> seq").count() == 0 and at.count() == 8000
    groups = range_of(F.col("seq"), cuts_of(users, "seq", 8))
    assert users.groupBy(groups.alias("r")).count().agg(F.max("count"), F.count("*")).first()[:] <= (1400, 8)
    sizes = [r.n for r in message_batches(users, 10, by="user", order=("seq",), ranges=8).select(F.size("bodies").alias("n")).collect()]
    assert sizes == [10] * 800


def test_batches(spark):
    df = spark.range(1007).repartition(1)
    assert sorted(len(r.bodies) for r in message_batches(df).collect()) == [7] + [10] * 100
    by = spark.range(25).withColumn("k", F.col("id") % 2)
    # All but a user's last batch are full, whatever the ranges.
    for ranges in (1, 3, None):
        found = message_batches(spark.range(97).withColumn("k", F.col("id") % 2), 10, by="k", order=("id",), ranges=ranges).orderBy("k", "batch").collect()
        assert [len(r.bodies) for r in found] == [10] * 4 + [9] + [10] * 4 + [8]
        assert [json.loads(b)["id"] for r in found if r.k == 1 for b in r.bodies] == list(range(1, 97, 2))
    assert sorted((r.k, r.batch, len(r.bodies)) for r in message_batches(by, by="k", order=("id",)).collect()) == [(0, 0, 10), (0, 1, 3), (1, 0, 10), (1, 1, 2)]


def test_delivery():
    sent, waits = [], []

    def flaky(batch):
        sent.append([i for i, _ in batch])
        return [("1", False)] if len(sent) < 3 else []

    deliver(["a", "b", "c"], flaky, wait=waits.append)
    assert sent == [["0", "1", "2"], ["1"], ["1"]] and waits == [0.1, 0.2]
    for answer in ([("9", False)], [("0", True)], [("0", False)]):
        with pytest.raises(SendError):
            deliver(["a"], lambda batch, answer=answer: answer, wait=lambda s: None)


def test_progress(spark):
    log = spark.createDataFrame([("a", 4), ("a", 2), ("b", 2**63 - 1)], "stream string, seq_num long")
    assert rows(positions(log)) == [("a", 5), ("b", 2**63 - 1)]
    old = spark.createDataFrame([("a", 100), ("c", 3)], "stream string, next_seq long")
    new = spark.createDataFrame([("a", 50), ("c", 7), ("gone", 9)], "stream string, next_seq long")
    assert rows(merge_positions(old, new)) == [("a", 100), ("c", 7)]
    listed = spark.createDataFrame([("a", False), ("n", None), ("x", True)], "stream string, deleted boolean")
    known = spark.createDataFrame([("a",), ("x",), ("pinned",)], "stream string")
    assert rows(catalog_diff(listed, known, ("pinned",))) == [("n", "new"), ("x", "removed")]
    twice = log.union(log)
    assert dedupe_replay(twice).count() == 3


def test_versions(spark):
    versions = spark.createDataFrame([("t", 100), ("t", 200), ("t", 300), ("u", 500)], "tbl string, snapshot_id long")
    asked = spark.createDataFrame([("t", 50), ("t", 250), ("t", 300), ("none", 9)], "tbl string, lsn long")
    assert rows(schema_asof(asked, versions)) == [("none", 9, None), ("t", 250, 200), ("t", 300, 300), ("t", 50, None)]
    assert rows(prune_versions(versions, 250)) == [("t", 200), ("t", 300), ("u", 500)]
    assert prune_versions(versions, 10).count() == 4
    assert rows(prune_versions(versions, {"t": 250, "gone": 1})) == [("t", 200), ("t", 300), ("u", 500)]
    assert prune_versions(versions, {"u": 900}).count() == 4


def test_versions_by_brute_force(spark):
    rng = random.Random(2)
    versions = [(rng.choice("ab"), rng.randrange(60)) for _ in range(25)]
    events = [(rng.choice("abc"), rng.choice([None, *range(70)]), k) for k in range(300)]
    got = schema_asof(spark.createDataFrame(events, "tbl string, lsn long, snapshot_id0 long"), spark.createDataFrame(versions, "tbl string, snapshot_id long"), ranges=7).collect()
    assert len(got) == 300
    for tbl, lsn, _, found in got:
        assert found == max((v for t, v in versions if t == tbl and lsn is not None and v <= lsn), default=None)
    none = spark.createDataFrame([], "tbl string, lsn long")
    assert schema_asof(none, spark.createDataFrame(versions, "tbl string, snapshot_id long")).count() == 0


def test_relational_statements_do_what_changes_do(spark):
    from changeflow.operators.relational import last_operations, merge_statements

    """Staged rows and the two statements, acted out on a dict, against the same changes applied."""
    rng = random.Random(6)
    for on_conflict in ("update", "nothing"):
        for _ in range(4):
            target = {k: f"t{k}" for k in range(0, 12, 2)}
            changes = [(rng.choice("iud"), n, 0, rng.randrange(12), f"c{n}") for n in range(20)]
            df = spark.createDataFrame(changes, "_op string, lsn long, ord long, id long, v string")
            staged = last_operations(df, ["id"], on_conflict=on_conflict).collect()
            gone, put = merge_statements("t", "s", ["id", "v"], ["id"], on_conflict=on_conflict)
            assert ("_cleared" in gone) == (on_conflict == "nothing")
            table = dict(target)
            for r in staged:
                if r._op == "d" or on_conflict == "nothing" and r._cleared:
                    table.pop(r.id, None)
            for r in staged:
                if r._op != "d" and (on_conflict == "update" or r.id not in table):
                    table[r.id] = r.v
            want = apply_changes(spark.createDataFrame(list(target.items()), "id long, v string"), df, ["id"], on_conflict=on_conflict).collect()
            assert table == {r.id: r.v for r in want}


def test_relational(spark):
    from changeflow.operators.relational import last_operations, merge_statements, stage

    gone, put = merge_statements("t", "s", ["id", "v"], ["id"])
    assert gone == "DELETE t FROM `t` t JOIN `s` s ON t.`id` = s.`id` WHERE s.`_op` = 'd'"
    assert put == "INSERT INTO `t` (`id`, `v`) SELECT `id`, `v` FROM `s` s WHERE s.`_op` <> 'd' ON DUPLICATE KEY UPDATE `v` = VALUES(`v`)"
    assert merge_statements("t", "s", ["id", "v"], ["id"], on_conflict="nothing")[1].endswith("UPDATE `id` = `t`.`id`")
    for bad in ({"keys": []}, {"keys": ["id"], "on_conflict": "x"}):
        with pytest.raises(ValueError):
            merge_statements("t", "s", ["id"], **bad)
    with pytest.raises(ValueError):
        stage(spark.range(1), "jdbc:none", "s", batch_size=0)
    df = spark.createDataFrame(ROWS, CHANGE)
    assert rows(last_operations(df, ["id"]).select("id", "_op", "v")) == [(1, "u", "c"), (2, "d", None), (3, "i", "q")]
