import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from changeflow.llm import tokenbin
from changeflow.llm.tokenbin import WordEncoder, from_planes, read_ids, read_range, read_tokens, to_planes, write_tokens

PATH = public_tokenizers.path("word_bpe_49k.json")
ROWS = [
    (3, "Hello, World! it's", "x"), (1, None, "x"), (2, "", "x"), (7, "a\x1cb c Straße İ ΣΣ don't <|endoftext|>x", "x"),
    (5, "word " * 9000 + "end", "y"), (7, "a", None), (None, "null id", "z"), (9, " \n\t ", "z"), (11, "é 你好 12345 \U0001f600", "z"),
]


def expected(rows):
    from tokenizers import Tokenizer

    t, at, out = Tokenizer.from_file(PATH), 0, []
    for doc_id, text, _ in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or "")):
        ids = [*t.encode(text or "", add_special_tokens=False).ids, 1]
        out.append((doc_id, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    return out


@pytest.mark.parametrize("planes", ["byte", "bit"])
def test_store_matches_direct_encoding(spark, tmp_path, planes):
    docs = spark.createDataFrame(ROWS, "doc_id long, text string, start string")
    write_tokens(docs, path := str(tmp_path / "s"), tokenizer=PATH, planes=planes, block_ids=256)
    got = [tuple(r) for r in read_tokens(spark, path).orderBy("start").collect()]
    assert got == expected(ROWS)
    index = spark.read.parquet(f"{path}/index").orderBy("first_id").collect()
    assert [r.first_id for r in index][0] == 0 and sum(r.n_ids for r in index) == got[-1][1] + got[-1][2]
    for r in read_ids(spark, path).collect():
        assert zlib.crc32(np.array(r.ids, "<u4").tobytes()) == {(g[0], g[1]): g[3] for g in got}[r.doc_id, r.start]


def test_words_apart_equal_whole_texts():
    encoder = WordEncoder(PATH)
    assert encoder.by_word
    rng = random.Random(3)
    characters = [chr(k) for k in range(1, 256)] + list("  ''..,!_ab \n")
    texts = ["".join(rng.choices(characters, k=rng.randrange(60))) for _ in range(3000)] + ["a!!'s", "it's. '!x", "a_b__c", "!'", "x²³ ¼", "don't.", "a.b'll!c"]
    for text, ids in zip(texts, encoder.encode_many(texts), strict=True):
        assert ids.tolist() == encoder.tokenizer.encode(text, add_special_tokens=False).ids, text


def test_added_tokens():
    """Every added token, alone, inside words and in other cases, as the library encodes it."""
    encoder = WordEncoder(PATH)
    added = [t.content for t in encoder.tokenizer.get_added_tokens_decoder().values()]
    assert added and encoder.by_word
    texts = [form.format(t, t) for t in [*added, *(x.upper() for x in added), *(x[:-1] for x in added)] for form in ("{}", "hello {} world", "in{}side", "{}{}", "a!{}'s", "\u00e9 {}\n", "{}.")]
    for text, ids in zip(texts, encoder.encode_many(texts), strict=True):
        assert ids.tolist() == encoder.tokenizer.encode(text, add_special_tokens=False).ids, text


def test_words_are_kept_for_the_next_task(monkeypatch):
    class Task:
        get = staticmethod(lambda: Task)
        partitionId = staticmethod(lambda: 0)  # noqa: N815

    monkeypatch.setattr(tokenbin, "TaskContext", Task)
    monkeypatch.setattr(tokenbin, "_WORKER", {})
    batch = pa.record_batch([pa.array([1, 2]), pa.array([" some words, and\xa0more", "Some words"])], names=["doc_id", "text"])
    run = tokenbin._encode_shards(PATH, 1, 256, "byte", 3)
    first = [b.to_pylist() for b in run(iter([batch]))]
    encoder = tokenbin._WORKER[PATH]
    learnt, learn = [], encoder._learn
    monkeypatch.setattr(encoder, "_learn", lambda new: learnt.extend(new) or learn(new))
    assert [b.to_pylist() for b in run(iter([batch]))] == first and learnt == []
    monkeypatch.setattr(tokenbin, "KEPT_WORDS", 3)  # but no more than the bound
    assert [b.to_pylist() for b in run(iter([batch]))] == first and not encoder.memo
    assert [b.to_pylist() for b in run(iter([batch]))] == first and len(learnt) == 5


def test_ranges_by_the_index(spark, tmp_path, monkeypatch):
    monkeypatch.setattr("changeflow.llm.tokenbin.SHARD_BYTES", 5000)
    write_tokens(spark.createDataFrame(ROWS, "doc_id long, text string, start string"), path := str(tmp_path / "s"), tokenizer=PATH, block_ids=256)
    assert len({r.shard for r in spark.read.parquet(f"{path}/index").collect()}) > 4
    whole = [x for r in read_ids(spark, path).orderBy("start").collect() for x in r.ids]
    for start, stop in ((0, len(whole)), (0, 1), (250, 260), (256, 512), (1000, 5000), (len(whole) - 3, len(whole) + 9), (7, 7), (10**9, 10**9 + 5)):
        pieces = read_range(spark, path, start, stop).orderBy("at").collect()
        assert [x for r in pieces for x in r.ids] == whole[start:stop]
        assert not pieces or pieces[0].at == start
    with pytest.raises(ValueError):
        read_range(spark, path, 5, 4)


def test_rows_without_id_are_spread(spark, tmp_path):
    rows = [(None, f"{k:05} some text", "x") for k in range(400)]
    write_tokens(spark.createDataFrame(rows, "doc_id long, text string, start string"), path := str(tmp_path / "s"), tokenizer=PATH, block_ids=64)
    assert len({r.shard for r in spark.read.parquet(f"{path}/chunks").collect()}) == 4
    assert [tuple(r) for r in read_tokens(spark, path).orderBy("start").collect()] == expected(rows)


def test_tokenizer_that_keeps_case(tmp_path):
    import json

    kept = json.load(open(PATH))
    kept["normalizer"]["normalizers"] = [x for x in kept["normalizer"]["normalizers"] if x["type"] != "Lowercase"]
    (tmp_path / "cased.json").write_text(json.dumps(kept))
    encoder = WordEncoder(str(tmp_path / "cased.json"))
    assert not encoder.by_word
    for text in ("Hello World", "hello WORLD!"):
        assert encoder.encode(text).tolist() == encoder.tokenizer.encode(text, add_special_tokens=False).ids


def test_empty_table(spark, tmp_path):
    docs = spark.createDataFrame([], "doc_id long, text string")
    write_tokens(docs, path := str(tmp_path / "s"), tokenizer=PATH)
    assert read_tokens(spark, path).count() == 0


def test_planes_round_trip():
    ids = np.random.default_rng(0).integers(0, 2**32, 1001, dtype="u4")
    for planes in ("byte", "bit"):
        assert (from_planes(to_planes(ids, planes), 1001) == ids).all()
    with pytest.raises(ValueError):
        write_tokens(None, "", tokenizer="", planes="nibble")
