import hashlib
import os
import random
import zlib
from collections import defaultdict

import duckdb
import pytest
from changeflow.llm import merkle
from changeflow.llm.merkle import audited, manifest, oracle_sql
from pyspark.sql import functions as F

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def tree(hashes):
    """The root, and for each leaf its (left, right) siblings from below."""
    ways, under = [[] for _ in hashes], [[k] for k in range(len(hashes))]
    while len(hashes) > 1:
        up, groups = [], []
        for k in range(0, len(hashes), 8):
            run = hashes[k : k + 8]
            for j in range(len(run)):
                for m in under[k + j]:
                    ways[m].append(("".join(run[:j]), "".join(run[j + 1 :])))
            up.append(H(*run))
            groups.append(sum(under[k : k + 8], []))
        hashes, under = up, groups
    return hashes[0], ways


def brute(rows):
    def leaf(r, text):
        i, _, lang, source, n = r
        return H(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (i, source, lang, n, text)))

    by = defaultdict(list)
    for r in rows:
        by[r[2]].append((r[0] is not None, r[0] or 0, leaf(r, r[1]), r))
    langs = sorted(by, key=lambda x: (x is not None, (x or "").encode()))
    for x in langs:
        by[x].sort(key=lambda y: y[:3])
    sub = {x: tree([y[2] for y in by[x]]) for x in langs}
    out = []
    if langs:
        root, tops = tree([sub[x][0] for x in langs])
        for x, top in zip(langs, tops, strict=True):
            for (_, _, h, r), own in zip(by[x], sub[x][1], strict=True):
                text = r[1]
                if text is not None and r[0] is not None and zlib.crc32(str(r[0]).encode()) % 3 == 0:
                    text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
                again = leaf(r, text)
                for a, b in own + top:
                    again = H(a, again, b)
                out.append((r[0], h, sub[x][0], root, H(*(a + b for a, b in own + top)), again, again == root))
    return out


def order(rows):
    return sorted((tuple(r) for r in rows), key=str)


def corpus(n, seed=3):
    rng = random.Random(seed)
    rows = [(i, rng.choice(["Ab c", "É x", "", None, "low"]) if rng.random() < 0.3 else f"Text {i}", rng.choice(["en", "en", "en", "de", None, ""]), rng.choice(["s", None]), i) for i in range(n)]
    return rows + [rows[0]] * 3 + [(None, "A", "en", None, None), (None, "A", "en", None, None), (None, "b", None, None, None), (5, "other text, same id", "en", "s", -1), (7, "Alone", "zz", "s", 1)]


@pytest.mark.parametrize("n,digits", [(0, 4), (1, 4), (7, 4), (8, 1), (9, 1), (200, 1), (700, 2)])
def test_equals_brute_force(spark, monkeypatch, n, digits):
    monkeypatch.setattr(merkle, "DIGITS", digits)
    rows = corpus(n) if n > 1 else corpus(2)[:n]
    assert order(audited(spark.createDataFrame(rows, SCHEMA)).collect()) == order(brute(rows))


def test_many_groups(spark, monkeypatch):
    monkeypatch.setattr(merkle, "DIGITS", 1)
    rows = [(i, f"T{i}", f"l{i % 90}", None, 1) for i in range(150)]
    assert order(audited(spark.createDataFrame(rows, SCHEMA)).collect()) == order(brute(rows))


def test_equals_sql(spark, tmp_path):
    rows = corpus(90)
    df = spark.createDataFrame(rows, SCHEMA)
    df.coalesce(1).write.parquet(str(tmp_path / "d"))
    c = duckdb.connect()
    c.execute(f"create view documents as select * from '{tmp_path}/d/*.parquet'")
    assert order(c.execute(oracle_sql()).fetchall()) == order(brute(rows))


def test_columns_with_clashing_names(spark):
    rows = corpus(20)
    df = spark.createDataFrame(rows, SCHEMA)
    for c in ("group", "key", "h", "n", "rank", "block", "kids", "way", "leaf", "root", "tampered", "_at", "_tie", "_g"):
        df = df.withColumn(c, F.lit("x"))
    assert order(audited(df).collect()) == order(brute(rows))


def test_long_text(spark):
    rows = [(0, "Äb c" * 500_000, "en", "s", 1), (1, "A" * 1_000_000, "en", "s", 1)]
    assert order(audited(spark.createDataFrame(rows, SCHEMA)).collect()) == order(brute(rows))


def test_other_tables(spark):
    """Any hash as leaf, any key; ranks are those of the keys."""
    df = spark.range(300).select(F.concat(F.lit("k"), F.lpad(F.col("id").cast("string"), 4, "0")).alias("name"), (F.col("id") % 2).alias("side"))
    rows = manifest(df, group="side", key="name", leaf=F.sha2("name", 256)).orderBy("group", "rank").collect()
    assert [r.key for r in rows] == [f"k{i:04}" for side in (0, 1) for i in range(side, 300, 2)]
    assert len({r.root for r in rows}) == 1 and len({r.subroot for r in rows}) == 2


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.001"), reason="no test tables")
def test_query(spark):
    from changeflow.llm.queries import QUERIES

    rows = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text", "lang", "source", "n_chars").collect()]
    assert order(QUERIES["op11_merkle_manifest"](spark, "/root/testdata/sf0.001").collect()) == order(brute(rows))
