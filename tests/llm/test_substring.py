import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest
from changeflow.llm import substring
from changeflow.llm.substring import Parse, deduplicated, word_hashes


def brute(rows, window):
    docs = [(i, re.findall(r"[^\x20\x09-\x0D]+", t or "")) for i, t in rows]
    seen = Counter(tuple(w[k : k + window]) for _, w in docs for k in range(len(w) - window + 1))
    out = []
    for i, w in docs:
        gone = [False] * len(w)
        for k in range(len(w) - window + 1):
            if seen[tuple(w[k : k + window])] > 1:
                gone[k : k + window] = [True] * window
        kept = " ".join(x for x, g in zip(w, gone, strict=True) if not g)
        out.append((i, len(w), sum(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out)


def corpus(seed, vocabulary):
    rng, rows = random.Random(seed), []
    words = lambda n: [f"w{rng.randrange(vocabulary)}" for _ in range(n)]
    passages = [words(rng.randrange(30, 60)) for _ in range(6)]
    for _ in range(120):
        parts = words(rng.randrange(0, 90))
        if rng.random() < 0.5:
            parts += passages[rng.randrange(6)] + words(rng.randrange(0, 40))
        if rng.random() < 0.1:
            parts += ["same"] * rng.randrange(20, 80) + words(10)
        if rng.random() < 0.1:
            parts += ["x", "y", "z"] * rng.randrange(5, 30)
        rows.append(parts)
        if rng.random() < 0.1:
            rows.append(parts)
    return [(i, rng.choice([" ", "\n"]).join(r)) for i, r in enumerate([*rows, [], ["Éa\xa0b"] * 40])] + [(900, None), (901, " \t")]


@pytest.mark.parametrize("seed,vocabulary,window", [(1, 5000, 35), (2, 12, 35), (3, 60, 35)])
def test_equals_brute_force(spark, monkeypatch, seed, vocabulary, window):
    monkeypatch.setattr(substring, "SLICE", 7)
    rows = corpus(seed, vocabulary)
    df = spark.createDataFrame([(*r, 1, "k") for r in rows], "doc_id long, text string, n_words int, key string")
    assert sorted(tuple(r) for r in deduplicated(df, window=window).collect()) == brute(rows, window)


def test_equal_windows_share_their_core():
    rng = np.random.default_rng(3)
    for _ in range(200):
        common = rng.integers(0, 9, 35)
        cores = []
        for _ in range(2):
            before, after = rng.integers(0, 9, rng.integers(0, 30)), rng.integers(0, 9, rng.integers(0, 30))
            p = Parse(word_hashes([b"%d" % x for x in [*before, *common, *after]]))
            i = len(before)
            a, b = p.left[i], p.right[i + 35]
            cores.append((a - i, b - i, p.names[p.at[a] : p.at[b]].tolist()) if a < b else None)
        assert cores[0] == cores[1]


def test_names_tell_windows_apart():
    """Windows of one text and of its copies in other surroundings: names are equal where the words are, and only there."""
    rng, window = np.random.default_rng(5), 35
    for vocabulary in (2, 4, 40):
        base, names = rng.integers(0, vocabulary, 400).tolist(), {}
        base[100:160] = [1] * 60
        for _ in range(12):
            a, n = int(rng.integers(0, 360)), int(rng.integers(30, 120))
            text = [*rng.integers(0, vocabulary, rng.integers(0, 40)).tolist(), *base[a : a + n], *rng.integers(0, vocabulary, rng.integers(5, 40)).tolist()]
            if len(text) < window:
                continue
            p = Parse(word_hashes([b"%d" % x for x in text]), twice=True)
            one, two = p.window_names(np.arange(len(text) - window + 1), window)
            for k, name in enumerate(zip(one.tolist(), two.tolist(), strict=True)):
                names.setdefault(tuple(text[k : k + window]), set()).add(name)
        assert all(len(x) == 1 for x in names.values())
        for half in (0, 1):
            assert len({next(iter(x))[half] for x in names.values()}) == len(names)


def test_edges(spark):
    long = " ".join(f"w{i}" for i in range(50000))
    rows = [(1, long), (None, long), (2, "a b " * 100), (3, "short"), (3, "short")]
    got = {(r.doc_id, r.n_words, r.n_removed) for r in deduplicated(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {(1, 50000, 0), (None, 50000, 0), (2, 200, 200), (3, 1, 0)}
    assert deduplicated(spark.createDataFrame([], "doc_id long, text string")).count() == 0
