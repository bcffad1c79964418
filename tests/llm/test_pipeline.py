import random

import corpus_pipeline
import pytest
from corpus_pipeline import STAGES, run

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    """Documents with a known fate each."""
    rng = random.Random(11)
    words = lambda n: [f"w{rng.randrange(3000)}" for _ in range(n)]
    docs, labels, fate = [], [], {}

    def add(text, kind):
        docs.append((len(docs), text, "en", "s", len(text or "")))
        fate[len(docs) - 1] = kind

    items = [(i, " ".join(words(30))) for i in range(20)]
    for k in range(600):
        w = words(40)
        toxic = k % 5 == 0
        if toxic:
            w[7] = rng.choice(["idiot", "moron", "stupid"])
        add(" ".join(w), "toxic" if toxic else "kept")
        labels.append((len(docs) - 1, 1, int(toxic)))
        if k % 50 == 1:
            add(" ".join(w[:-1]), "copy")
        if k % 50 == 2:
            add(" ".join([*words(30), items[k // 50][1].upper(), *words(30)]), "leak")
        if k % 50 == 3:
            add(" ".join([*words(30), f"jo.{k}@mail.example.com", *words(5)]), "private")
    add(None, "kept")
    add("", "kept")
    path = tmp_path_factory.mktemp("corpus")
    spark.createDataFrame(docs, COLUMNS).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return str(path), docs, fate


def test_stages_take_what_they_should(spark, corpus):
    path, docs, fate = corpus
    table = spark.read.parquet(f"{path}/documents.parquet")
    left = {d[0] for d in docs}
    for (_, stage), kind in zip(STAGES[:3], ("toxic", "copy", "leak"), strict=True):
        table = stage(spark, table, path)
        assert dict(table.dtypes) == {"doc_id": "bigint", "text": "string", "lang": "string", "source": "string", "n_chars": "bigint"}
        table = spark.createDataFrame(table.collect(), COLUMNS)
        now = {r.doc_id for r in table.collect()}
        assert left - now == {i for i in left if fate[i] == kind}
        left = now
    after = {r.doc_id: r for r in STAGES[3][1](spark, table, path).collect()}
    assert set(after) == left
    for i, text, *_ in docs:
        if i in left:
            assert (after[i].text != (text or "")) == (fate[i] == "private") and after[i].n_chars == len(after[i].text)
            assert f"jo.{i}@" not in after[i].text


def test_run(spark, corpus):
    path, _, fate = corpus
    got = {r.doc_id: r for r in run(spark, path).collect()}
    assert set(got) == {i for i, kind in fate.items() if kind in ("kept", "private")}
    assert all(r.round_trip and r.n_ids == len(r.ids) for r in got.values())
    assert corpus_pipeline.ORACLE_SQL is None


def test_repeated_rows(spark):
    docs = spark.createDataFrame([(1, "a b c d e f", "x"), (1, "a b c d e f", "x"), (2, "A b c d e f", "y"), (None, "q", "z")], "doc_id long, text string, rep string")
    got = sorted(map(tuple, corpus_pipeline.ngram_join(spark, docs, "").collect()), key=str)
    assert got == [(1, "a b c d e f", "x"), (None, "q", "z")]


def test_different_texts_under_one_id(spark):
    base = [f"w{k}" for k in range(60)]
    near = " ".join([*base[:-1], "x"])
    rows = [(5, " ".join(base)), (5, "quite another text of some words here"), (5, "quite another text of some words here"), (7, near), (3, near + " y"), (9, None), (9, "")]
    got = corpus_pipeline.ngram_join(spark, spark.createDataFrame(rows, "doc_id long, text string"), "").collect()
    kept = sorted((r.doc_id, r.text or "") for r in got)
    assert kept == sorted([(3, near + " y"), (5, "quite another text of some words here"), (9, "")])


@pytest.mark.parametrize("name,stage", STAGES)
def test_stages_on_odd_tables(spark, corpus, name, stage):
    path, *_ = corpus
    schema = "doc_id long, text string, lang string, source string, n_chars long, score double, raw double, component_id long, ids array<int>"
    empty = spark.createDataFrame([], schema)
    assert stage(spark, empty, path).count() == 0
    rows = [(None, None), (1, ""), (2, "stone " * 60000), (3, "mail a.b@example.com " * 2), (3, "mail a.b@example.com " * 2), (None, "no id")]
    odd = spark.createDataFrame([(*r, "en", None, None, 0.5, None, 4, [1]) for r in rows], schema)
    out = stage(spark, odd, path).collect()
    assert len(out) == (5 if name == "ngram_join" else 6)
    if name != "sentencepiece":
        assert {(r.doc_id, r.score) for r in out} >= {(None, 0.5), (1, 0.5), (2, 0.5), (3, 0.5)}


def test_run_leaves_only_its_result(spark, tmp_path):
    import os

    import corpus_pipeline
    from changeflow.llm.common import scratch_owner, scratch_path, shared_folder

    before = set(os.listdir(shared_folder(spark)))
    rows = corpus_pipeline.run(spark, "/root/testdata/sf0.001")
    assert rows.count() > 0
    left = set(os.listdir(shared_folder(spark))) - before
    assert len(left) == 1 and next(iter(left)).startswith("pipeline-sentencepiece")
    try:
        with scratch_owner(spark):
            spark.range(3).write.parquet(scratch_path(spark, "x"))
            raise RuntimeError
    except RuntimeError:
        pass
    assert set(os.listdir(shared_folder(spark))) - before == left
