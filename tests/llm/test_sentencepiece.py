import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from changeflow.llm.sentencepiece import SPACE, Pieces, round_trip

PATH = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def vocabulary():
    return Pieces(PATH)


def plain_viterbi(v, text):
    """Best total score over all segmentations, without any window."""
    best = [0.0] + [None] * len(text)
    for i in range(len(text)):
        if best[i] is None:
            continue
        for j in range(i + 1, min(len(text), i + v.longest) + 1):
            s = v.score.get(text[i:j])
            if s and (best[j] is None or best[i] + s[0] > best[j]):
                best[j] = best[i] + s[0]
        if text[i] not in v.score and (best[i + 1] is None or best[i] + v.unknown_score > best[i + 1]):
            best[i + 1] = best[i] + v.unknown_score
    return best[-1]


@pytest.mark.parametrize("seed", range(5))
def test_stream_is_optimal_and_lossless(vocabulary, seed):
    rng = random.Random(seed)
    for _ in range(60):
        text = SPACE + "".join(rng.choice("abcdethinosr  .,éß你\n") for _ in range(rng.randrange(1, 60))).replace(" ", SPACE)
        ids = list(vocabulary.stream(text))
        total = sum(vocabulary.score[vocabulary.text[i]][0] for i in ids if i not in vocabulary.byte_of) + sum(vocabulary.unknown_score for c in text if c not in vocabulary.score)
        assert total == pytest.approx(plain_viterbi(vocabulary, text), rel=1e-12)
        assert vocabulary.decode(ids) == text.replace(SPACE, " ")[1:]
        assert list(vocabulary.encode(text.replace(SPACE, " ")[1:])) == ids


def test_same_as_the_library_in_unigram_mode(vocabulary):
    """The best of the library's own lattice on the same pieces and scores."""
    pb = pytest.importorskip("sentencepiece.sentencepiece_model_pb2")
    from sentencepiece import SentencePieceProcessor

    model = pb.ModelProto()
    with open(PATH, "rb") as f:
        model.ParseFromString(f.read())
    model.trainer_spec.model_type = 1
    library = SentencePieceProcessor(model_proto=model.SerializeToString())
    for text in ["That and onesen erblest it hein.", "Licensed under the Apache License", "Éan anieroi la euxen", "a", "the", "der die das Straße"]:
        assert [vocabulary.text[i] for i in vocabulary.encode(text)] == library.nbest_encode_as_pieces(text, 2)[0]


def test_streams_in_pieces_of_any_size(vocabulary):
    rng = random.Random(9)
    for _ in range(40):
        text = SPACE + "".join(rng.choice("abcdeth.,!'|#0é你\n " + "’“" * (rng.random() < 0.3)) for _ in range(rng.randrange(1, 400))).replace(" ", SPACE)
        at, parts = 0, []
        while at < len(text):
            parts.append(text[at : (at := at + rng.randrange(1, 40))])
        ids = list(vocabulary.stream(parts))
        assert ids == list(vocabulary.stream([text])) == vocabulary.encode(text.replace(SPACE, " ")[1:]).tolist()
    one = "a" * 3000  # one stretch without any sure boundary
    assert list(vocabulary.stream(one)) == list(vocabulary.stream([one])) and vocabulary.decode(list(vocabulary.stream(one))) == one


def test_window_stays_small(vocabulary):
    fed = []

    def characters():
        for k in range(20000):
            fed.append(k)
            yield "abcdefghij "[k % 11].replace(" ", SPACE)

    first = next(vocabulary.stream(characters()))
    assert first and len(fed) < 200


@pytest.mark.parametrize("decode_first", [True, False])
def test_texts_with_any_word_share_a_worker(decode_first):
    v, text = Pieces(PATH), "a\ndecoded b\ndecoded\ndecoded\ndecoded c"
    if decode_first:
        assert v.decode([]) == ""
    ids = list(v.encode(text))
    assert ids == list(v.stream(SPACE + text.replace(" ", SPACE))) and v.decode(ids) == text
    assert list(v.encode("a\ndecoded b")) == list(v.stream(SPACE + "a\ndecoded" + SPACE + "b"))


def test_rows(spark, vocabulary):
    rows = [(1, "hello  world\n\ttab \U0001f600 你好"), (2, None), (3, ""), (None, " lead and trail "), (4, "word " * 50000), (4, "x" * 5000), (5, SPACE), (6, "a\x00b")]
    df = spark.createDataFrame([(*r, [1], "s") for r in rows], "doc_id long, text string, ids array<int>, text_sha256 string")
    got = round_trip(df, PATH).collect()
    assert len(got) == len(rows)
    assert {r.doc_id for r in got if not r.round_trip} == {5}
    one = next(r for r in got if r.doc_id == 1)
    ids = vocabulary.encode(rows[0][1])
    assert (one.n_ids, one.ids_crc32) == (len(ids), zlib.crc32(np.array(ids, "<i4").tobytes()))
    assert {(r.doc_id, r.n_ids) for r in got} >= {(2, 0), (3, 0)}
    assert round_trip(spark.createDataFrame([], "doc_id long, text string"), PATH).count() == 0
