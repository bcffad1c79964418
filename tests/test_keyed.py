import random

import pytest
from changeflow.operators.state import first_by_key, latest_by_key, retract_agg
from changeflow.streaming.keyed import keyed_changes

CHANGE = "_op string, lsn long, ord long, id long, v string, n decimal(12,2)"


def history(seed, n):
    from decimal import Decimal

    rng = random.Random(seed)
    rows = [(rng.choice("iuud"), 2**60 + k // 2, k % 2, rng.randrange(9), rng.choice(["a", "b", None]), Decimal(rng.randrange(100)) / 4) for k in range(n)]
    rng.shuffle(rows)
    return rows + rng.sample(rows, n // 5)  # some come again


def run(spark, folder, checkpoint, **options):
    """All files that are there, one a batch; returns the net changes of each batch in order."""
    out = []
    rows = keyed_changes(spark.readStream.schema(CHANGE).option("maxFilesPerTrigger", 1).parquet(folder), ["id"], **options)
    query = rows.writeStream.outputMode("update").foreachBatch(lambda df, n: out.append(df.collect())).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return out


def followed(table, batches):
    """The table that net changes make; they have to fit it."""
    for batch in batches:
        for r in sorted(batch, key=lambda r: "diu".index(r._op)):
            assert (r.id in table) == (r._op != "i"), r
            if r._op == "d":
                assert table.pop(r.id)[1:] == tuple(r)[1:]
            else:
                table[r.id] = tuple(r)
    return table


@pytest.mark.parametrize("on_conflict", ["update", "nothing"])
def test_shuffled_batches_and_a_restart(spark, tmp_path, on_conflict):
    given, log, checkpoint = history(4, 120), str(tmp_path / "log"), str(tmp_path / "c")
    fold = latest_by_key if on_conflict == "update" else first_by_key
    table, at = {}, 0
    for part in (40, 90, len(given)):
        for start in range(at, part, 25):
            spark.createDataFrame(given[start : min(part, start + 25)], CHANGE).coalesce(1).write.mode("append").parquet(log)
        at = part
        batches = run(spark, log, checkpoint, on_conflict=on_conflict)  # a new query each time, on the state that is there
        table = followed(table, batches)
        want = fold(spark.createDataFrame(given[:part], CHANGE), ["id"]).collect()
        assert {k: v[1:] for k, v in table.items()} == {r.id: tuple(r)[1:] for r in want}
    assert len(batches) >= 2


def test_net_changes_keep_totals(spark, tmp_path):
    """With images before updates the net changes give running totals."""
    given, log = history(6, 80), str(tmp_path / "log")
    for start in range(0, len(given), 30):
        spark.createDataFrame(given[start : start + 30], CHANGE).coalesce(1).write.mode("append").parquet(log)
    net = [r for b in run(spark, log, str(tmp_path / "c"), emit_update_before=True) for r in b]
    got = retract_agg(spark.createDataFrame(net, CHANGE), ["v"], ["n"]).where("n_rows > 0").collect()
    live = latest_by_key(spark.createDataFrame(given, CHANGE), ["id"]).withColumn("_op", latest_op())
    assert sorted(map(tuple, got), key=str) == sorted(map(tuple, retract_agg(live, ["v"], ["n"]).collect()), key=str)


def latest_op():
    from pyspark.sql import functions as F

    return F.lit("i")


def test_arguments(spark):
    rows = spark.createDataFrame([], CHANGE)
    with pytest.raises(ValueError):
        keyed_changes(rows, [])
    with pytest.raises(ValueError):
        keyed_changes(rows, ["id"], on_conflict="x")
    with pytest.raises(ValueError):
        keyed_changes(rows.drop("_op"), ["id"])
