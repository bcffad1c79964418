import math
import random
import zlib

import pytest
from changeflow.llm import toxicity
from changeflow.llm.toxicity import CharModel, leet_words, restore, restored_words, score, train

PLAIN = "the house river green walking people water under stone night morning paper".split()


def corpus(n=1500):
    rng, docs, labels = random.Random(4), [], []
    for i in range(n):
        words = rng.choices(PLAIN, k=30)
        toxic = i % 5 == 0
        if toxic:
            words[rng.randrange(30)] = rng.choice(["idiot", "stupid", "moron"])
        docs.append((i, " ".join(words), "en", "s"))
        labels.append((i, 1, int(toxic)))
    return docs, labels


@pytest.fixture(scope="module")
def model(spark):
    docs, labels = corpus()
    return train(spark.createDataFrame(docs, "doc_id long, text string, lang string, source string"), spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))


def test_held_out_documents(spark, model):
    docs, labels = corpus()
    rows = {r.doc_id: r for r in score(spark.createDataFrame(docs, "doc_id long, text string, lang string, source string"), model).collect()}
    for i, _, toxic in labels:
        assert rows[i].held_out == (zlib.crc32(str(i).encode()) % 4 == 2)
        assert rows[i].predicted == toxic == int(rows[i].score >= 0.3)


@pytest.mark.parametrize("text", ["you 1d10t here", "an i d i o t there", "so st00pid", "m-o-r-o-n", "a stuuuupid stone", "STUPID", "what an !diot", "m0r0n."])
def test_disguises(spark, model, text):
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    row = score(docs, model).first()
    if text == "so st00pid":  # another spelling, not a disguise of one: nothing is promised
        return
    assert row.predicted == 1, restored_words(text, CharModel(model.grams))


@pytest.mark.parametrize("text", ["an idi07 here", "you idio+", "(MOR0N!)", "#idi0t", "you m0r0n*", "so stuupid", "an iidiot", "i..d. .i..o..t", "i_d_i_o_t", "m  o  r  o  n"])
def test_disguises_anywhere_in_a_word(spark, model, text):
    row = score(spark.createDataFrame([(1, text)], "doc_id long, text string"), model).first()
    assert row.predicted == 1, restored_words(text, CharModel(model.grams))


def test_every_word_with_a_letter_and_a_mark():
    assert leet_words("a55 bitche5 12 $5 idi0t! (h3y) plain") == {"a55", "bitche5", "idi0t!", "idi0t", "h3y"}


def test_three_spaced_letters(model):
    m = CharModel(model.grams)
    assert restored_words("on t h e  way, t--h--3", m) >= {"the"} and restored_words("t--h--3", m) == {"the"}


def every_spelling(piece, m, spaced):
    """(cost, spelling) of all ways through the channel, one by one."""
    size, paths, last = len(toxicity._CODE), [(0.0, "", 0)], ""
    for ch in piece.lower():
        sep = not ch.isalnum() and ch not in toxicity.LEET
        if ch in toxicity.LEET:
            ways = [(c, toxicity.LEET_COST + math.log(len(toxicity.LEET[ch]))) for c in toxicity.LEET[ch]] + [("", toxicity.DROP_COST)]
        elif sep:
            ways = [("", 0.0)] + ([(" ", toxicity.GAP_COST)] if spaced else [])
        else:
            ways = [(ch, 0.0)]
        if ch == last:
            ways.append(("", toxicity.REPEAT_COST))
        new = []
        for cost, out, state in paths:
            for c, extra in ways:
                if not c or c == " " and state % size == 0:
                    new.append((cost + extra, out, state))
                else:
                    to = state * size + toxicity._CODE.get(c, 1)
                    new.append((cost + extra + m.costs[to], out + c, to % size**2))
        paths, last = new, last if sep and spaced else ch
    return [(cost + m.costs[state * size], out) for cost, out, state in paths]


@pytest.mark.parametrize("piece,spaced", [("1d10t", False), ("p@p3r", False), ("st0o0ne", False), ("m0rr0n", False), ("w*t3r!", False), ("h o u 5 e", True), ("p--a p 3 r", True), ("i i d i o t", True)])
def test_restore_equals_exhaustive_decoding(model, piece, spaced):
    m = CharModel(model.grams)
    ways = every_spelling(piece, m, spaced)
    least = min(cost for cost, _ in ways)
    assert min(cost for cost, out in ways if out == restore(piece, m, spaced)) == pytest.approx(least, abs=1e-9)


def test_scores_do_not_depend_on_what_a_worker_remembers(model, monkeypatch):
    m = CharModel(model.grams)
    texts = ["a moron here", "plain 1d10t, words", "(stupid)", "sstupid under m o r o n", "x-moron-y 12 $5", "I D I O T"]
    fresh = [toxicity._Scorer(model.weights, m).raw(t) for t in texts]
    monkeypatch.setattr(toxicity, "_MEMO", 3)
    one = toxicity._Scorer(model.weights, m)
    assert [one.raw(t) for t in texts * 3] == fresh * 3 and min(fresh) > 0


def test_restore_keeps_plain_words(model):
    m = CharModel(model.grams)
    assert restore("h0use", m) == "house"
    assert restore("w a t e r", m, spaced=True) == "water"


def test_edges(spark, model):
    rows = [(1, None, 0), (2, "", 0), (None, "stupid", 0), (3, "1234 !!! ###", 0), (3, "1234 !!! ###", 0), (4, "stone " * 40000, 0), (5, "a " * 3000, 0)]
    got = score(spark.createDataFrame(rows, "doc_id long, text string, score int"), model).collect()
    assert len(got) == 7 and all(0 <= r.score <= 1 for r in got)
    assert {r.doc_id: r.predicted for r in got} == {1: 0, 2: 0, None: 1, 3: 0, 4: 0, 5: 0}
    assert score(spark.createDataFrame([], "doc_id long, text string"), model).count() == 0


def test_no_labels(spark):
    docs = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    m = train(docs, spark.createDataFrame([], "doc_id long, quality int, toxic int"))
    assert 0 <= score(docs, m).first().score <= 1
