"""Benchmark decontamination: every passage of every document queries a BM25 index of the test items.

Impacts are divided by the score that an item gives itself, so a score is the share of the item's
weight that the passage holds and one threshold serves all items. Passages whose terms could not
reach it with their largest impacts are skipped, then blocks of items, by the terms' largest impacts
in each. Items found are verified on the passage's words, question and answer apart.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from changeflow.llm.common import doc_texts, freeing, written

_TABLE = bytes(b if chr(b).isalnum() or b >= 128 else 32 for b in range(256))
#: Items of one posting block; items of one index, which is broadcast (about 60 words each: 50 MB).
BLOCK, INDEX_ITEMS = 16, 50_000
K1, B = 1.2, 0.75


def words_of(text: str) -> list[bytes]:
    """Lower-case words; ASCII marks and white space separate."""
    return text.lower().encode("utf-8", "surrogatepass").translate(_TABLE).split()


def halves(text: str) -> tuple[list[bytes], list[bytes]]:
    """Question and answer of a test item: its first sentence and the rest, or two halves where there is one sentence."""
    ends = [k for k, c in enumerate(text) if c in ".?!\n" and words_of(text[:k]) and words_of(text[k:])]
    if ends:
        return words_of(text[: ends[0]]), words_of(text[ends[0] :])
    w = words_of(text)
    return w[: (len(w) + 1) // 2], w[(len(w) + 1) // 2 :]


def overlap(part: list[bytes], region: list[bytes], gram: int = 3) -> float:
    """Share of a part's word n-grams that the region has; shorter parts are compared whole. An empty part is there."""
    if not part:
        return 1.0
    g = min(gram, len(part))
    mine = Counter(tuple(part[k : k + g]) for k in range(len(part) - g + 1))
    there = {tuple(region[k : k + g]) for k in range(len(region) - g + 1)}
    return sum(n for x, n in mine.items() if x in there) / sum(mine.values())


@dataclass
class Index:
    """Postings by term, ordered by item and cut at every ``BLOCK`` items; each piece has its largest impact."""

    items: list[int]
    parts: list[tuple[list[bytes], list[bytes]]]
    terms: dict[bytes, int]
    postings: list[list[tuple[int, float]]]
    longest: int

    def __post_init__(self):
        flat = [p for ps in self.postings for p in ps]
        self.item_of = np.array([i for i, _ in flat], "i8")
        self.impact = np.array([x for _, x in flat], "f8")
        term = np.repeat(np.arange(len(self.postings)), [len(p) for p in self.postings])
        new = np.ones(len(flat), bool)
        new[1:] = (term[1:] != term[:-1]) | (self.item_of[1:] // BLOCK != self.item_of[:-1] // BLOCK)
        self.first = np.append(np.flatnonzero(new), len(flat))
        self.block = self.item_of[self.first[:-1]] // BLOCK
        self.block_max = np.maximum.reduceat(self.impact, self.first[:-1]) if flat else np.zeros(0)
        self.pieces = np.searchsorted(term[self.first[:-1]], np.arange(len(self.postings) + 1))
        #: Largest impact of each term in any item.
        self.most = np.maximum.reduceat(self.block_max, self.pieces[:-1]) if flat else np.zeros(0)

    @classmethod
    def build(cls, rows: list[tuple[int, str]], counted: tuple[int, int, int, dict[bytes, int]] | None = None) -> Index:
        """``counted``: items, words, longest item and items of each term in the whole benchmark, where ``rows`` are a slice of it."""
        bags = [Counter(words_of(t)) for _, t in rows]
        sizes = [sum(b.values()) for b in bags]
        n, total, longest, df = counted or (len(bags), sum(sizes), max(sizes, default=0), Counter(t for b in bags for t in b))
        mean = total / max(1, n)
        lists: dict[bytes, list[tuple[int, float]]] = {}
        for i, bag in enumerate(bags):
            size = sum(bag.values())
            weight = {t: math.log(1 + (n - df[t] + 0.5) / (df[t] + 0.5)) * f * (K1 + 1) / (f + K1 * (1 - B + B * size / mean)) for t, f in bag.items()}
            own = sum(weight.values())
            for t, w in weight.items():
                lists.setdefault(t, []).append((i, w / own))
        terms = {t: k for k, t in enumerate(lists)}
        return cls([i for i, _ in rows], [halves(t) for _, t in rows], terms, list(lists.values()), longest)


def _ranges(starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The numbers of all ranges, one after the other."""
    sizes = ends - starts
    return np.repeat(starts - np.concatenate([[0], np.cumsum(sizes)[:-1]]), sizes) + np.arange(sizes.sum())


def block_max_wand(index: Index, terms: np.ndarray, threshold: float) -> list[tuple[int, float]]:
    """All (item number, score) with at least ``threshold``.

    A query whose terms' largest impacts don't reach the threshold ends at once. Then blocks of items
    are ruled out by the sum of the terms' largest impacts there, and only postings in the blocks
    that are left are scored.
    """
    threshold -= 1e-9
    if index.most[terms].sum() < threshold:
        return []
    pieces = _ranges(index.pieces[terms], index.pieces[terms + 1])
    bound = np.bincount(index.block[pieces], weights=index.block_max[pieces])
    pieces = pieces[bound[index.block[pieces]] >= threshold]
    if not len(pieces):
        return []
    at = _ranges(index.first[pieces], index.first[pieces + 1])
    score = np.bincount(index.item_of[at], weights=index.impact[at])
    return [(int(i), float(score[i])) for i in np.flatnonzero(score >= threshold)]


def contaminated(text: str, index: Index, threshold: float, least: float) -> list[tuple[int, float, float, float, int]]:
    """(item number, best score, question overlap, answer overlap, passages) of a document's verified items."""
    words = words_of(text)
    ids = np.fromiter(map(index.terms.get, words, repeat(-1)), "i8", len(words))
    hits = np.flatnonzero(ids >= 0)
    if not len(hits):
        return []
    # Passages are two neighbouring strides; each stride's terms count once for the bound.
    stride = max(1, index.longest)
    keys = np.unique((hits // stride) * len(index.most) + ids[hits])
    strides = -(-len(words) // stride)
    bound = np.bincount(keys // len(index.most), weights=index.most[keys % len(index.most)], minlength=strides)
    ahead = np.append(bound[1:], 0.0)
    best: dict[int, list] = {}
    for s in np.flatnonzero(bound + ahead >= threshold - 1e-9):
        at, to = int(s) * stride, (int(s) + 2) * stride
        if s and to - stride >= len(words):  # the last stride is in the passage before
            continue
        terms = np.unique(ids[at:to])
        terms = terms[terms >= 0]
        for item, score in block_max_wand(index, terms, threshold):
            got = best.setdefault(item, [0.0, 0.0, 0.0, 0])
            region = words[max(0, at - stride) : to + stride]
            q, a = (overlap(p, region) for p in index.parts[item])
            if min(q, a) >= least:
                best[item] = [max(got[0], score), max(got[1], q), max(got[2], a), got[3] + 1]
    return [(i, *x) for i, x in sorted(best.items()) if x[3]]


def find(docs: DataFrame, benchmark: DataFrame, *, threshold: float = 0.6, least_overlap: float = 0.6) -> DataFrame:
    """``doc_id, item_id, score, question_overlap, answer_overlap, passages`` of every verified leak.

    Passages of two strides (a stride has as many words as the longest item) cover each whole text;
    every passage above ``threshold`` is taken. An item counts when at least ``least_overlap`` of
    the word 3-grams of its question and of its answer stand in the passage or next to it.

    Null and empty texts and items match nothing. Items with a null id are left out. Repeated items
    are found each, repeated rows are searched each. Empty tables give no rows. The index is
    broadcast; a benchmark of more than ``INDEX_ITEMS`` items is searched in several passes.
    """
    shape = "doc_id long, item_id long, score double, question_overlap double, answer_overlap double, passages int"
    out = None
    for bc in _indexes(docs.sparkSession, benchmark):

        def run(batches: Iterator[pa.RecordBatch], bc=bc) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                index, found = bc.value, []
                for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                    found += [(doc_id, index.items[i], *x) for i, *x in contaminated(text.as_py(), index, threshold, least_overlap)]
                columns = zip(*found, strict=True) if found else [()] * 6
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, [pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.float64(), pa.int32()], strict=True)], names=["doc_id", "item_id", "score", "question_overlap", "answer_overlap", "passages"])

        one = doc_texts(docs).mapInArrow(freeing(run), shape)
        out = one if out is None else out.union(one)
    return out


def _indexes(spark, benchmark: DataFrame) -> Iterator:
    """Broadcast indexes of at most about ``INDEX_ITEMS`` items, weighted and cut into passages as one index of all would be."""
    items = benchmark.where("item_id is not null").select(F.col("item_id").cast("long").alias("item_id"), F.coalesce("text", F.lit("")).alias("text"))
    passes = 1 + max(0, items.count() - 1) // INDEX_ITEMS
    if passes == 1:
        rows = items.orderBy("item_id", "text").collect()
        yield spark.sparkContext.broadcast(Index.build([(r.item_id, r.text) for r in rows if words_of(r.text)]))
        return
    shape = "term binary, items long, words long, longest long"
    counts = items.select("text").mapInArrow(freeing(_term_counts), shape).groupBy("term").agg(F.sum("items").alias("items"), F.sum("words").alias("words"), F.max("longest").alias("longest"))
    counts = written(counts, "benchmark-terms")
    whole = counts.where("term is null").first()
    for k in range(passes):
        part = items.where(F.pmod(F.xxhash64("item_id"), F.lit(passes)) == k)
        mine = part.select("text").mapInArrow(freeing(_term_counts), shape).where("term is not null").select("term").distinct()
        df = {bytes(r.term): r["items"] for r in counts.join(mine, "term").select("term", "items").collect()}
        rows = [(r.item_id, r.text) for r in part.orderBy("item_id", "text").collect() if words_of(r.text)]
        yield spark.sparkContext.broadcast(Index.build(rows, (whole["items"], whole["words"], whole["longest"], df) if whole else None))


def _term_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Items of each term; under no term the number of items with words, their words and the longest."""
    for batch in batches:
        bags = [b for b in (words_of(t.as_py()) for t in batch.column(0)) if b]
        if bags:
            df, sizes = Counter(t for b in bags for t in set(b)), [len(b) for b in bags]
            none = [0] * len(df)
            columns = ([*df, None], pa.binary()), ([*df.values(), len(bags)], pa.int64()), ([*none, sum(sizes)], pa.int64()), ([*none, max(sizes)], pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(*c) for c in columns], names=["term", "items", "words", "longest"])


def clean_documents(docs: DataFrame, benchmark: DataFrame, *, threshold: float = 0.6, least_overlap: float = 0.6) -> DataFrame:
    """The rows of ``docs``, all columns as they are, whose text holds no item; null texts stay."""
    for bc in _indexes(docs.sparkSession, benchmark):

        def run(batches: Iterator[pa.RecordBatch], bc=bc) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                texts = batch.column(batch.schema.names.index("text"))
                yield batch.filter(pa.array([not contaminated(t.as_py() or "", bc.value, threshold, least_overlap) for t in texts], pa.bool_()))

        docs = docs.mapInArrow(freeing(run), docs.schema)
    return docs
