import random

import numpy as np
import pytest
from changeflow.llm import decontam
from changeflow.llm.decontam import Index, block_max_wand, find, halves, words_of


def corpus(seed=1):
    rng = random.Random(seed)
    common = [f"c{i}" for i in range(15)]
    words = lambda n: [rng.choice(common) if rng.random() < 0.4 else f"w{rng.randrange(900)}" for _ in range(n)]
    items = [(i, " ".join(words(rng.randrange(12, 60))).replace(" c3 ", ". ")) for i in range(70)]
    docs, leaks = [], set()
    for d in range(120):
        w = words(rng.randrange(0, 300))
        if d % 3 == 0:
            i = rng.randrange(70)
            at = rng.randrange(len(w) + 1)
            text = items[i][1].upper() if d % 2 else items[i][1] + "!"
            w = w[:at] + [text] + w[at:]
            leaks.add((d, i))
        docs.append((d, " ".join(w)))
    return docs, items, leaks


@pytest.mark.parametrize("threshold", [0.2, 0.4, 0.7])
def test_wand_finds_what_full_scoring_finds(threshold):
    docs, items, _ = corpus()
    index = Index.build(items)
    for _, text in docs:
        terms = sorted({index.terms[w] for w in words_of(text) if w in index.terms})
        full: dict[int, float] = {}
        for t in terms:
            for i, x in index.postings[t]:
                full[i] = full.get(i, 0) + x
        want = {i for i, s in full.items() if s >= threshold - 1e-9}
        got = dict(block_max_wand(index, np.array(terms, int), threshold))
        assert set(got) == want and all(abs(got[i] - full[i]) < 1e-9 for i in want)


@pytest.mark.parametrize("in_one", [50_000, 30])
def test_leaks_are_found_and_clean_documents_are_not(spark, monkeypatch, in_one):
    monkeypatch.setattr(decontam, "INDEX_ITEMS", in_one)
    docs, items, leaks = corpus()
    got = find(spark.createDataFrame([(*d, 1) for d in docs], "doc_id long, text string, item_id int"), spark.createDataFrame([(*i, 2.0) for i in items], "item_id long, text string, score double"))
    assert {(r.doc_id, r.item_id) for r in got.collect()} == leaks


def test_edges(spark):
    items = [(1, "Where is it? over there in the old house by the sea"), (1, "Where is it? over there in the old house by the sea"), (None, "null id of a test"), (2, None), (3, "")]
    docs = [(1, None), (2, ""), (None, "so where is it, over there in the old house by the sea"), (4, "filler " * 30000 + "Where is it? over there in the old house by the SEA " + "filler " * 500)]
    got = find(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")).collect()
    assert {(r.doc_id, r.item_id) for r in got} == {(None, 1), (4, 1)}
    none = spark.createDataFrame([], "item_id long, text string")
    assert find(spark.createDataFrame(docs, "doc_id long, text string"), none).count() == 0
    assert find(none.select(none.item_id.alias("doc_id"), "text"), spark.createDataFrame(items, "item_id long, text string")).count() == 0
    assert halves("one sentence only") == ([b"one", b"sentence"], [b"only"])


def test_slices_score_as_one_index(spark, monkeypatch):
    import random

    from changeflow.llm import decontam

    rng = random.Random(3)
    vocabulary = [f"w{k}" for k in range(60)]
    items = [(i, " ".join(rng.choices(vocabulary, k=rng.randrange(6, 30)))) for i in range(24)] + [(99, ""), (None, "w1 w2")]
    texts = [(i, " ".join(rng.choices(vocabulary, k=40)) + " " + " ".join(w for w in items[i][1].split() if rng.random() < 0.85)) for i in range(24)]
    docs, benchmark = spark.createDataFrame(texts, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    found = lambda: sorted((r.doc_id, r.item_id, round(r.score, 9), r.passages) for r in decontam.find(docs, benchmark, threshold=0.5, least_overlap=0.2).collect())
    whole = found()
    monkeypatch.setattr(decontam, "INDEX_ITEMS", 5)
    assert whole and found() == whole
