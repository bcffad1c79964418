import itertools
import os

import numpy as np
import pytest
from changeflow.llm.ann import buckets, fitted, hadamard, nearest
from pyspark.sql import functions as F


def brute(rows, k):
    clean = {(i, tuple(v)) for i, v in rows if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)}
    out = []
    for i, v in sorted(clean):
        if i % 100 == 0:
            near = sorted((np.sqrt(((np.array(v) - np.array(w)) ** 2).sum()), j) for j, w in clean if j != i and len(w) == len(v))[:k]
            out += [(i, r + 1, j, s) for r, (s, j) in enumerate(near)]
    return out


def test_equals_brute_force_where_all_buckets_are_probed(spark):
    rng = np.random.default_rng(3)
    rows = [(i, [float(x) for x in rng.normal(size=6)]) for i in range(301)]
    rows += [(1000 + i, rows[0][1]) for i in range(40)] + [(2000 + i, rows[5][1]) for i in range(3)]
    rows += [(None, [1.0]), (400, None), (401, []), (402, [0.0] * 6), (403, [None, 1.0]), (404, [float("nan"), 1.0]), (405, [float("inf")]), (500, [1.0, 2.0]), (501, [1.5, 2.0]), rows[0], rows[0]]
    df = spark.createDataFrame([(*r, "a", 1.0) for r in rows], "vec_id long, embedding array<double>, cls string, score double")
    got = [tuple(r) for r in nearest(df, F.col("vec_id") % 100 == 0, probes=16, tables=2, cell_rows=50, cell_queries=2).orderBy("query_id", "rank").collect()]
    want = brute(rows, 10)
    assert [g[:3] for g in got] == [w[:3] for w in want]
    assert np.allclose([g[3] for g in got], [w[3] for w in want], rtol=0, atol=1e-12)


def test_recall_with_production_parameters(spark):
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(20, 64))
    rows = [(i, [float(x) for x in centres[i % 20] + 0.9 * rng.normal(size=64)]) for i in range(3000)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = {(r.query_id, r.vec_id) for r in nearest(df, F.col("vec_id") % 100 == 0).collect()}
    want = {(w[0], w[2]) for w in brute([(i, [float(np.float32(x)) for x in v]) for i, v in rows], 10)}
    assert len(got & want) >= 0.9 * len(want)


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.1"), reason="no test tables")
def test_recall_on_the_given_table(spark):
    df = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    got = {(r.query_id, r.vec_id) for r in nearest(df, F.col("vec_id") % 100 == 0).collect()}
    want = {(w[0], w[2]) for w in brute([(r.vec_id, r.embedding) for r in df.collect()], 10)}
    assert len(got) == len(want)
    assert len(got & want) >= 0.9 * len(want)


def test_tight_clusters_take_more_hashes_and_few_candidates(spark):
    rng = np.random.default_rng(7)
    centres = rng.normal(size=(400, 32))
    vecs = [centres[i % 400] + 0.15 * rng.normal(size=32) for i in range(8000)]
    classes = spark.createDataFrame([(str(i), [float(x) for x in v]) for i, v in enumerate(vecs)], "cls string, vec array<double>")
    hashes, probes = fitted(classes, classes.where(F.col("cls").cast("int") % 100 == 0), k=10, tables=8, recall=0.96, seed=20)
    assert hashes > 1
    unit = np.stack(vecs) / np.linalg.norm(vecs, axis=1)[:, None]
    meet = np.zeros((80, 8000), bool)
    for t in range(8):
        own, near = buckets(unit, t, hashes, 1, 20)[:, 0], buckets(unit[::100], t, hashes, probes, 20)
        meet |= np.stack([np.isin(own, row) for row in near])
    assert meet.mean() < 0.1
    true = np.argsort(((np.stack(vecs)[::100, None] - np.stack(vecs)[None]) ** 2).sum(2), axis=1)[:, 1:11]
    assert np.take_along_axis(meet, true, 1).mean() >= 0.96


def test_nearest_buckets_by_brute_force():
    unit = np.random.default_rng(1).normal(size=(4, 3))
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    one = [buckets(unit, 2 * 3 + j, 1, 8, 5) for j in range(3)]  # the rotations of table 2 with three hashes, as tables of one
    got = buckets(unit, 2, 3, 512, 5)
    for i in range(4):
        assert sorted(got[i].tolist()) == sorted(a * 64 + b * 8 + c for a, b, c in itertools.product(range(8), repeat=3))
        assert got[i, 0] == one[0][i, 0] * 64 + one[1][i, 0] * 8 + one[2][i, 0]
    assert (buckets(unit, 2, 3, 40, 5) == got[:, :40]).all()


def test_empty(spark):
    assert nearest(spark.createDataFrame([], "vec_id long, embedding array<float>"), F.col("vec_id") % 100 == 0).count() == 0


@pytest.mark.parametrize("n", [1, 2, 64])
def test_hadamard_keeps_lengths(n):
    x = np.random.default_rng(0).normal(size=(5, n))
    assert np.allclose(np.linalg.norm(hadamard(x), axis=1), np.linalg.norm(x, axis=1))
