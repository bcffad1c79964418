import os
import random
import re
from collections import defaultdict

import numpy as np
import pytest
import xxhash
from changeflow.llm import simhash
from changeflow.llm.components import components
from changeflow.llm.simhash import fingerprint, fit, forest, links, near_duplicates, part_masks
from pyspark.sql import functions as F


def print_of(text, k=3):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    hashes = [xxhash.xxh64_intdigest(" ".join(words[i : i + k]).encode(), 42) for i in range(max(1, len(words) - k + 1))] if words else []
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes)) if hashes else 0


def joined(items, near):
    root = {x: x for x in items}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for k, x in enumerate(items):
        for y in items[:k]:
            if near(x, y):
                a, b = sorted((find(x), find(y)))
                root[b] = a
    return {x: find(x) for x in items}


def brute(rows, bits=2):
    prints = [(i, print_of(t)) for i, t in rows]
    group = joined(sorted({p for _, p in prints}), lambda x, y: (x ^ y).bit_count() <= bits)
    low = defaultdict(list)
    for i, p in prints:
        if i is not None:
            low[group[p]].append(i)
    return [(i, f"{p:016x}", min(low[group[p]], default=None)) for i, p in prints]


def order(rows):
    return sorted((tuple(r) for r in rows), key=str)


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def points_of(seed, n, clusters):
    """Scattered fingerprints, and balls of near ones."""
    rng = random.Random(seed)
    out = {rng.getrandbits(64) for _ in range(n)}
    for size, width in clusters:
        centre = rng.getrandbits(64)
        for _ in range(size):
            x = centre
            for _ in range(rng.randrange(width + 1)):
                x ^= 1 << rng.randrange(64)
            out.add(x)
    return sorted(signed(x) for x in out)


@pytest.mark.parametrize("text", [None, "", " \t", "one", "two words", "Three Words Here", "É a B c  d\ne", "a b c " * 50, "a b c d e f"])
@pytest.mark.parametrize("piece", [1, 7, 1 << 20])
def test_fingerprint(text, piece):
    assert fingerprint(text or "", 3, piece) == print_of(text)


def corpus(seed):
    rng, rows = random.Random(seed), []
    for _ in range(60):
        words = [f"w{rng.randrange(3000)}" for _ in range(rng.randrange(1, 400))]
        rows.append(words)
        for _ in range(rng.randrange(3)):
            near = list(words)
            near[rng.randrange(len(near))] = "X"
            rows += [near, near[:-1], words]
    texts = [" ".join(r) for r in rows] + ["", None, "  ", "same", "Same", "a b"] + ["copied text of many"] * 40
    rng.shuffle(texts)
    return [(3 * k, t) for k, t in enumerate(texts)] + [(None, "only here, without an id"), (None, "same"), (0, "again under one id")]


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_brute_force(spark, seed):
    rows = corpus(seed)
    got = near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"))
    assert got.columns == ["doc_id", "fingerprint", "component_id"]
    assert order(got.collect()) == order(brute(rows))


@pytest.mark.parametrize("parts,bits,clusters", [(2, 2, [(300, 6), (200, 3)]), (1, 2, [(300, 5)]), (3, 2, [(300, 6)]), (2, 5, [(100, 8)]), (2, 0, [(50, 2)])])
def test_shards_lose_no_link(spark, parts, bits, clusters):
    """Many rounds, small shards, visitors in cells: components equal those of all pairs."""
    points = points_of(parts, 400, clusters)
    df = spark.createDataFrame([(p,) for p in points], "fp long")
    found = {r.id: r.component for r in components(links(df, bits=bits, parts=parts, homes=40, visitors=30, levels=2)).collect()}
    want = joined(points, lambda x, y: ((x ^ y) & (1 << 64) - 1).bit_count() <= bits)
    assert {p: found.get(p, p) for p in points} == want


def test_half_that_is_alike(spark):
    """Points that agree on one half can't be split by its distances."""
    rng = random.Random(4)
    points = sorted({signed((7 << 32) | rng.getrandbits(32)) for _ in range(500)} | {signed((7 << 32) | (1 << k)) for k in range(32)})
    df = spark.createDataFrame([(p,) for p in points], "fp long")
    found = {r.id: r.component for r in components(links(df, homes=50, levels=3)).collect()}
    assert {p: found.get(p, p) for p in points} == joined(points, lambda x, y: (x ^ y).bit_count() <= 2)


@pytest.mark.parametrize("seed", range(4))
def test_forest_within_a_shard(seed, monkeypatch):
    monkeypatch.setattr(simhash, "LEAF", 8)
    points = np.array(points_of(seed, 200, [(120, 4), (80, 2)]))
    np.random.default_rng(seed).shuffle(points)
    home, visit = points[:250], points[250:]
    for mask, radius in ((-1, 2), *((m, 1) for m in part_masks())):
        a, b = forest(home, visit, mask, radius, 2)
        assert len(a) < len(points)
        where = {int(p): k for k, p in enumerate(points)}
        linked = defaultdict(set)
        for x, y in zip(a.tolist(), b.tolist(), strict=True):
            linked[y].add(x)
        got = {frozenset({y, *xs}) for y, xs in linked.items()}
        all_near = lambda x, y: (int(x ^ y) & (1 << 64) - 1).bit_count() <= 2
        near = lambda x, y, n=near_of(mask, radius): all_near(x, y) and n(x, y) and min(where[x], where[y]) < len(home)
        full = lambda x, y: all_near(x, y) and min(where[x], where[y]) < len(home)
        least, most = groups(points, near), groups(points, full)
        # Pairs within the half's radius are all found; others may be met by chance.
        assert all(any(g <= h for h in got) for g in least) and all(any(h <= g for g in most) for h in got)


def near_of(mask, radius):
    return lambda x, y: (int(x ^ y) & mask & (1 << 64) - 1).bit_count() <= radius


def groups(points, near):
    by = defaultdict(set)
    for x, r in joined(sorted(points.tolist()), near).items():
        by[r].add(x)
    return [frozenset(g) for g in by.values() if len(g) > 1]


def test_fitted_trees_are_balanced():
    points = np.array(points_of(1, 2000, []))
    for mask in part_masks():
        vantages, cuts, largest = fit(points, mask, 1)
        assert len(vantages) == len(cuts) == 31 and largest < 2000 / 32 * 5


def test_empty_and_other_columns(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert near_duplicates(empty).collect() == []
    rows = corpus(3)[:60]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for c in ("fp", "low", "n", "component", "id", "shard", "home", "fingerprint", "component_id"):
        df = df.withColumn(c, F.lit("x"))
    assert order(near_duplicates(df).collect()) == order(brute(rows))


def test_very_long_text(spark):
    rows = [(1, "long words of a text " * 300_000), (2, "x" * 3_000_000), (3, "short")]
    assert order(near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()) == order(brute(rows))


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.001"), reason="no test tables")
def test_query(spark):
    from changeflow.llm.queries import QUERIES

    rows = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()]
    assert order(QUERIES["op13_vantage_points"](spark, "/root/testdata/sf0.001").collect()) == order(brute(rows))
