import random
import re

import numpy as np
import pytest
from changeflow.llm import jaccard
from changeflow.llm.components import components
from changeflow.llm.jaccard import bitmap, leaf, shingle_hashes, similar_groups, traverse, tree, words_of


def shingles(text, k):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    return {tuple(words[i : i + k]) for i in range(max(1, len(words) - k + 1))} if words else set()


def brute(rows, k, percent):
    sets = [(i, shingles(t, k)) for i, t in rows]
    comp = {i: i for i, _ in rows}

    def find(x):
        while comp[x] != x:
            x = comp[x]
        return x

    for a, (i, x) in enumerate(sets):
        for j, y in sets[:a]:
            if x and y and 100 * len(x & y) >= percent * len(x | y):
                p, q = sorted((find(i), find(j)))
                comp[q] = p
    return {i: (len(s), find(i)) for i, s in sets}


def edited(words, n, rng):
    out = list(words)
    for _ in range(n):
        out[rng.randrange(len(out))] = f"e{rng.randrange(10**6)}"
    return out


def corpus(seed):
    rng, rows = random.Random(seed), []
    line = [f"line{i}" for i in range(40)]
    mass = [f"m{i}" for i in range(90)]
    for _ in range(40):
        base = [f"w{rng.randrange(400)}" for _ in range(rng.randrange(3, 120))]
        rows.append(base)
        for _ in range(rng.randrange(0, 5)):
            rows.append(edited(base, rng.randrange(0, 4), rng))
        if rng.random() < 0.5:
            rows.append(base[: len(base) // 2] + line + base[len(base) // 2 :])
    rows += [edited(mass, rng.randrange(0, 5), rng) for _ in range(60)]
    rows += [line + [f"q{rng.randrange(10**6)}" for _ in range(rng.randrange(0, 9))] for _ in range(30)]
    rows += [mass] * 30
    rng.shuffle(rows)
    texts = [rng.choice(["{}", " {}\n", "{}"]).format(rng.choice([" ", "\t"]).join(w.upper() if rng.random() < 0.1 else w for w in r)) for r in rows]
    return [(3 * i, t) for i, t in enumerate([*texts, None, "", "  \n", "one", "one", "two words", "É É É É", "é é é é"])]


@pytest.mark.parametrize("seed,k,percent,hot", [(1, 4, 85, 8), (2, 5, 80, 64), (3, 4, 85, 3)])
def test_equals_brute_force(spark, monkeypatch, seed, k, percent, hot):
    monkeypatch.setattr(jaccard, "CELL", 16)
    rows = corpus(seed)
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, text string, cls string, n int")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in similar_groups(df, shingle_words=k, percent=percent, hot=hot).collect()}
    assert got == brute(rows, k, percent)


def test_links_between_texts_of_different_leaders(spark, monkeypatch):
    """Chains in which a text links to its neighbours only, so most leaders hang together by texts that they settle; a gap parts two."""
    monkeypatch.setattr(jaccard, "CELL", 4)
    starts = [*range(0, 400, 8), *range(408, 600, 8)]
    windows = [np.arange(s, s + 100, dtype="u8") for s in starts]
    pairs = [(i, i + 1) for i in range(len(windows) - 1)]
    assert [p for p in pairs if not jaccard.linked(*(windows[i] for i in p), 85)] == [(49, 50)]
    sets = spark.createDataFrame([(i, w.tobytes()) for i, w in enumerate(windows)], "rep long, hashes binary")
    members = spark.createDataFrame([(0, i, 1.0) for i in range(len(windows))], "pivot long, rep long, close double")
    got = {r.id: r.component for r in components(jaccard._dense_links(members, sets, 85)).collect()}
    assert got == {i: 0 if i < 50 else 50 for i in range(len(windows))}


def test_leaders_meet_in_all_cells(spark, monkeypatch):
    """Two leaders each, of five texts near the other; of pairs 0 to 7 one text of each links, whichever cells they fall into."""
    monkeypatch.setattr(jaccard, "CELL", 2)
    apart = lambda at: np.arange(at, at + 40, dtype="u8")
    between, sets = [], []
    for k in range(9):
        for side in (0, 1):
            for i in range(1, 6):
                rep = 100 * k + 10 * side + i
                between.append((k % 3, 100 * k + 10 * side, 100 * k + 10 * (1 - side), rep))
                sets.append((rep, apart(10**6 * (k + 1) if i == 3 and k < 8 else 1000 * rep).tobytes()))
    between = spark.createDataFrame(between, "pivot long, leader long, other long, rep long")
    known = spark.createDataFrame([(700, 710)], "a long, b long")
    got = jaccard._between_leaders([between], [known], spark.createDataFrame(sets, "rep long, hashes binary"), 85)
    assert sorted((r.a, r.b) for f in got for r in f.collect()) == [(100 * k + 3, 100 * k + 13) for k in range(7)]
    assert len(got) == 2 and got[1].count() > 0


def test_long_text_and_null_ids(spark):
    long = " ".join(f"w{i}" for i in range(60000))
    rows = [(1, long), (2, long + " more"), (None, long), (4, "a b c d e"), (4, "a b c d e")]
    got = similar_groups(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert len(got) == 5
    assert {(r.doc_id, r.component_id) for r in got} == {(1, 1), (2, 1), (None, None), (4, 4)}
    assert similar_groups(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_tree_prunes_but_loses_nothing():
    rng = random.Random(7)
    sets = [shingle_hashes(words_of(" ".join(f"w{rng.randrange(3000)}" for _ in range(rng.randrange(20, 300)))), 2) for _ in range(60)]
    sets += [s[: int(len(s) * 0.95)] for s in sets[:20]]
    top = tree([leaf(i, len(s), bitmap(s)) for i, s in enumerate(sets)])
    pairs = {tuple(sorted(p)) for p in traverse(top, top, 85)}
    true = {(i, j) for j in range(len(sets)) for i in range(j) if jaccard.linked(sets[i], sets[j], 85)}
    assert true and true <= pairs and len(pairs) < 200
    assert np.all(np.diff(sets[0].astype("f8")) > 0)


def test_components(spark):
    rng = random.Random(5)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)] + [(i, i + 1) for i in range(1000, 1060)] + [(2000, i) for i in range(2001, 2050)]
    comp = {x: x for p in links for x in p}
    for _ in range(100):
        for a, b in links:
            comp[a] = comp[b] = min(comp[a], comp[b])
    got = {r.id: r.component for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert all(got.get(x, x) == c for x, c in comp.items())
