import math
import re

from changeflow.llm.licenses import DECIDING, EXCLUDED, PHRASES, SPAN, TEMPLATES, THRESHOLD, oracle_sql, scan

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower(t):
    return re.sub("[A-Z]", lambda m: m.group().lower(), t or "")


def brute(text):
    w = WORD.findall(lower(text))
    places = [(i, label) for p, label in PHRASES.items() for i in range(len(w)) if w[i : i + len(p.split())] == p.split()]
    more, best = set(), 0.0
    lines = (text or "").split("\n")
    for block in [*lines, *("\n".join(lines[i : i + SPAN]) for i in range(len(lines)))]:
        have = set(WORD.findall(lower(block)))
        for label, t in TEMPLATES:
            need = set(WORD.findall(lower(t)))
            if need & set(DECIDING.get(label, "").split()) <= have and not have & set(EXCLUDED.get(label, "").split()) and len(have & need) >= math.ceil(THRESHOLD * len(need) - 1e-9):
                more.add(label)
                best = max(best, len(have & need) / len(need))
    at = [i for i, _ in places]
    base = {label for _, label in places}
    return (len(w), len(at), min(at, default=None), max(at, default=None), ",".join(sorted(base)), ",".join(sorted(base | more)), 1.0 if at else best)


TEXTS = [
    None, "", "  ..\n ", "MIT License mit-license MIT\nLicense", "cc by cc by-nc CC BY", "This work is licensed under the GNU General Public License, version 3.",
    "Licensed under the Apache License, Version 2.0.\nmore words", "Redistribution and use in source or binary forms with or without modification are permitted if the following conditions are met",
    "mit licensee, apache  license!", "the of and to in by or " * 500, "word " * 60000 + "mit license", "É mit license Ümit license", "mit\x00license", "subject to the terms of some Mozilla Public License",
    "Permission is hereby granted, free of\ncharge, to any person obtaining a copy of this software\nand associated documentation files (the MIT License)", "under the terms of\nthe GNU Lesser General\nPublic License\nas published by the Free Software Foundation",
    *(t for _, t in TEMPLATES),
]


def rows(df):
    return sorted(tuple(r) for r in df.select("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score").collect())


def test_equals_brute_force(spark):
    df = spark.createDataFrame([(i, t, "x", 1) for i, t in enumerate(TEXTS)], "doc_id long, text string, labels string, n_words int")
    assert rows(scan(df)) == [(i, *brute(t)) for i, t in enumerate(TEXTS)]


def test_oracle(spark, tmp_path):
    import duckdb

    texts = [t for t in TEXTS if "\x00" not in (t or "") and len(t or "") < 10**5]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(str(tmp_path / "d"))
    c = duckdb.connect()
    c.execute(f"create view documents as select * from '{tmp_path}/d/*.parquet'")
    sql = f"select doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score from ({oracle_sql()}) order by doc_id"
    assert [tuple(r) for r in c.execute(sql).fetchall()] == [(i, *brute(t)) for i, t in enumerate(texts)]


def test_notices_get_their_own_label(spark):
    lines = {
        "Released under the MIT License.": "mit,mit-notice", "Released under the BSD License": "bsd", "Licensed under CC BY 4.0.": "cc-by", "Licensed under CC BY-NC 4.0.": "cc-by,cc-by-nc", "Licensed under CC BY-SA 4.0": "cc-by,cc-by-sa",
        "it under the terms of the GNU Affero General Public License as published by the Free Software Foundation": "agpl",
        "you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation": "gpl,gpl-notice",
        "you can redistribute it and/or modify it\nunder the terms of the GNU Lesser General Public License\nas published by the Free Software Foundation": "lgpl",
    }
    df = spark.createDataFrame(list(enumerate(lines)), "doc_id long, text string")
    assert [r.labels for r in scan(df).orderBy("doc_id").collect()] == list(lines.values())


def test_rows(spark):
    df = spark.createDataFrame([(None, "mit license"), (1, "mit license"), (1, "mit license")], "doc_id long, text string")
    assert [r.labels for r in scan(df).collect()] == ["mit"] * 3
    assert scan(spark.createDataFrame([], "doc_id long, text string")).count() == 0
