"""Toxicity scores on text restored by a noisy-channel decoder.

Words that look disguised (leetspeak, spaced-out letters, repeated letters) become lattices of
possible spellings; Viterbi finds the likeliest under a character trigram model counted over all
documents. Words of the plain and the restored text are then looked up in a model of words and word
beginnings learned from labels.
"""

from __future__ import annotations

import math
import re
from array import array
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from changeflow.llm.common import doc_texts, freeing, small_batches, written

# What a character of leetspeak may stand for.
LEET = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "gb", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "*": "aeiou", "€": "e", "#": "h",
}
#: Costs (nats) of the channel: a leet character for a letter, a dropped character, a kept separator, a dropped repeat.
LEET_COST, DROP_COST, GAP_COST, REPEAT_COST = 1.0, 5.0, 2.5, 0.3

#: Letters that the language model tells apart; all others share one symbol, so it has a proven bound.
ALPHABET = "abcdefghijklmnopqrstuvwxyzßàáâäåæçèéêëìíîïñòóôöøùúûüœ"
EDGE, OTHER = " ", "?"
#: Symbols of the character model by number; 0 is a word's edge.
_CODE = {c: k for k, c in enumerate(EDGE + OTHER + ALPHABET)}
_SIZE = len(_CODE)

WORD = re.compile(r"[^\W\d_]+")
_MARK = re.escape("".join(LEET))
_LEET = re.compile(rf"[{_MARK}]+")
_WORDLIKE = re.compile(rf"(?:[^\W\d_]|[{_MARK}])+")
_ONE = rf"(?:[^\W_]|[{_MARK}])"
_SPACED = re.compile(rf"(?<!{_ONE}){_ONE}(?:[ .\-_/]+{_ONE}(?!{_ONE})){{2,}}")
#: What every spaced-out stretch holds; cheaper to look for.
_SPACED_HINT = re.compile(rf"[ .\-_/]{_ONE}[ .\-_/]+{_ONE}(?!{_ONE})")
_REPEATED = re.compile(r"(.)\1")
#: Marks that also stand beside words as punctuation.
_BESIDE = "!*#+|"
#: Word beginnings of these lengths are features beside whole words.
BEGINNINGS = (4, 5, 6, 7)
#: Words or features that a worker remembers; it bounds memory, not results.
_MEMO = 150_000


def features(word: str) -> list[str]:
    return [word, *("^" + word[:k] for k in BEGINNINGS if len(word) > k)]


class CharModel:
    """Trigram costs (negative log-probabilities) with backing off by interpolation, for every three symbols."""

    def __init__(self, counts: dict[str, int]):
        n = np.zeros((_SIZE, _SIZE, _SIZE))
        for g, k in counts.items():
            n[tuple(_CODE.get(c, 1) for c in g)] += k
        uni, bi = n.sum((0, 1)), n.sum(0)
        p1 = (uni + 0.5) / (uni.sum() + 0.5 * 64)
        p2 = (bi + 4 * p1) / (bi.sum(1, keepdims=True) + 4)
        p3 = (n + 4 * p2) / (n.sum(2, keepdims=True) + 4)
        self.costs = array("d", (-np.log(p3)).ravel().tobytes())


def restore(piece: str, model: CharModel, spaced: bool = False) -> str:
    """The likeliest plain spelling of a disguised word, or of spaced-out letters, by Viterbi; a state is the last two symbols."""
    best: dict[int, tuple[float, str]] = {0: (0.0, "")}
    last, costs = "", model.costs
    for ch in piece.lower():
        options: list[tuple[str, float]] = []
        if ch in LEET:
            options = [(c, LEET_COST + math.log(len(LEET[ch]))) for c in LEET[ch]] + [("", DROP_COST)]
        elif spaced and not ch.isalnum():
            options = [("", 0.0), (EDGE, GAP_COST)]
        elif ch.isalpha():
            options = [(ch, 0.0)]
        else:
            options = [("", 0.0)]
        if ch == last:
            options.append(("", REPEAT_COST))
        nxt: dict[int, tuple[float, str]] = {}
        for state, (cost, out) in best.items():
            for c, extra in options:
                if not c or (c == EDGE and state % _SIZE == 0):
                    to, total, text = state, cost + extra, out
                else:
                    to = state * _SIZE + _CODE.get(c, 1)
                    total, text = cost + extra + costs[to], out + c
                    to %= _SIZE * _SIZE
                if to not in nxt or total < nxt[to][0]:
                    nxt[to] = (total, text)
        best = nxt
        if spaced and not ch.isalnum() and ch not in LEET:
            continue
        last = ch
    return min((cost + costs[state * _SIZE], out) for state, (cost, out) in best.items())[1]


def leet_words(text: str) -> set[str]:
    """Words with at least one letter and one leet character, also without the punctuation at their ends."""
    found, at = set(), 0
    for m in _LEET.finditer(text):
        first, end = m.span()
        if first < at or not (text[end : end + 1].isalpha() or first and text[first - 1].isalpha()):
            continue
        while first > at and (text[first - 1].isalpha() or text[first - 1] in LEET):
            first -= 1
        word = _WORDLIKE.match(text, first)
        at = max(end, word.end())
        w = word.group(0).lower()
        found.update((w, w.rstrip(_BESIDE), w.strip(_BESIDE)))
    return {w for w in found if not w.isalpha() and any(map(str.isalpha, w))}


def spaced_stretches(text: str) -> set[str]:
    return {m.group(0).lower() for m in _SPACED.finditer(text)} if _SPACED_HINT.search(text) else set()


def restored_words(text: str, model: CharModel) -> set[str]:
    """Words of all leet words and spaced-out stretches of a text, restored."""
    found = {w for piece in leet_words(text) for w in WORD.findall(restore(piece, model))}
    return found | {w for piece in spaced_stretches(text) for w in WORD.findall(restore(piece, model, True))}


def _word_counts(text: str) -> list[str]:
    return WORD.findall(text.lower())


def _trigrams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of character trigrams; a task sends each trigram once for every batch of words."""

    def flush(words: Counter) -> pa.RecordBatch:
        grams: Counter = Counter()
        for w, n in words.items():
            for word in WORD.findall(w):
                s = EDGE + EDGE + "".join(c if c in _CODE else OTHER for c in word) + EDGE
                for k in range(len(s) - 2):
                    grams[s[k : k + 3]] += n
        return pa.RecordBatch.from_arrays([pa.array(list(grams), pa.string()), pa.array(list(grams.values()), pa.int64())], names=["gram", "n"])

    words: Counter = Counter()
    for batch in batches:
        for text in batch.column(0):
            words.update(text.as_py().lower().split())
        if len(words) > _MEMO:
            yield flush(words)
            words = Counter()
    if words:
        yield flush(words)


def character_counts(docs: DataFrame) -> DataFrame:
    """``gram, n`` of all documents: at most (letters + 2) ** 3 rows, whatever the corpus."""
    return doc_texts(docs).select("text").mapInArrow(freeing(_trigrams), "gram string, n long").groupBy("gram").agg(F.sum("n").alias("n"))


def _feature_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def flush(counts: Counter) -> pa.RecordBatch:
        names, toxic = zip(*counts, strict=True)
        return pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(toxic, pa.int32()), pa.array(list(counts.values()), pa.int64())], names=["feature", "toxic", "n"])

    counts: Counter = Counter()
    for batch in batches:
        for text, toxic in zip(batch.column(0), batch.column(1), strict=True):
            label = toxic.as_py()
            counts.update((f, label) for f in {f for w in set(_word_counts(text.as_py())) for f in features(w)})
        if len(counts) > _MEMO:
            yield flush(counts)
            counts = Counter()
    if counts:
        yield flush(counts)


@dataclass
class ToxicityModel:
    weights: dict[str, float]
    grams: dict[str, int]
    curve: list[tuple[float, float]]

    def calibrated(self, raw: float) -> float:
        """Between the points of the calibration curve, linearly; 0 to 1."""
        (x0, y0) = self.curve[0]
        for x1, y1 in self.curve:
            if raw <= x1:
                return y1 if x1 == x0 else y0 + (y1 - y0) * (raw - x0) / (x1 - x0)
            x0, y0 = x1, y1
        return self.curve[-1][1]


class _Scorer:
    """Scores texts by their blank-separated tokens, which hold whole words; each token is looked at once while it is remembered."""

    def __init__(self, weights: dict[str, float], model: CharModel):
        self.weights, self.model = weights, model
        #: A word with another beginning has no weight.
        self.begins = {f.lstrip("^")[: BEGINNINGS[0]] for f in weights}
        self.starts = {b[:k] for b in self.begins for k in range(1, len(b) + 1)}
        self.long = {b for b in self.begins if len(b) == BEGINNINGS[0]}  # may go on
        self.dull: set[str] = set()
        self.known: dict[str, float] = {}

    def word(self, w: str) -> float:
        if w[: BEGINNINGS[0]] not in self.begins:
            return 0.0
        return max(self.weights.get(f, 0.0) for f in features(w))

    def may_hide(self, w: str) -> bool:
        """Whether any way through the channel spells a word with a weighted beginning; it needs no look at the costs."""
        starts, last = {""}, ""
        for ch in w:
            new = set(starts) if ch in LEET or ch == last else set()
            for c in LEET.get(ch, ch):
                for p in starts:
                    p += c
                    if p in self.long:
                        return True
                    if p in self.starts:
                        new.add(p)
            if not new:
                return False
            starts, last = new, ch
        return not starts.isdisjoint(self.begins)

    def restored(self, w: str) -> float:
        return max(map(self.word, WORD.findall(restore(w, self.model))), default=0.0) if self.may_hide(w) else 0.0

    def token(self, token: str) -> float:
        plain = token.isalpha()
        words = [token] if plain else WORD.findall(token)
        best = 0.0
        for w in words:
            if w[: BEGINNINGS[0]] in self.begins:
                best = max(best, self.word(w))
            if _REPEATED.search(w):
                best = max(best, self.restored(w))
        if not plain and words and _LEET.search(token):
            best = max([best, *map(self.restored, leet_words(token))])
        return best

    def raw(self, text: str) -> float:
        best = 0.0
        for t in set(text.lower().split()) - self.dull:
            s = self.known.get(t)
            if s is None:
                s = self.token(t)
                if s:
                    self.known[t] = s
                else:
                    self.dull.add(t)
            best = max(best, s)
        if len(self.dull) + len(self.known) > _MEMO:
            self.dull, self.known = set(), {}
        spaced = [w for piece in spaced_stretches(text) for w in WORD.findall(restore(piece, self.model, True))]
        return max([best, *map(self.word, spaced)])


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def _lower_bound(t: Column, n: Column, z: float) -> Column:
    """Wilson's lower bound of the share t / n."""
    p, zz = t / n, z * z
    return (p + zz / (2 * n) - z * F.sqrt(p * (1 - p) / n + zz / (4 * n * n))) / (1 + zz / n)


def _raw_scores(bc):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = None
        for batch in batches:
            if scorer is None:
                scorer = _Scorer(*bc.value)
            raw = [scorer.raw(t.as_py()) for t in batch.column("text")]
            rest = [batch.column(k) for k in range(batch.num_columns) if batch.schema.names[k] != "text"]
            yield pa.RecordBatch.from_arrays([*rest, pa.array(raw, pa.float64())], names=[*(n for n in batch.schema.names if n != "text"), "raw"])

    return run


def _monotone(bins: list[tuple[float, int, int]]) -> list[tuple[float, float]]:
    """Share of toxic rows by raw score, made non-decreasing by pooling adjacent violators."""
    pools: list[list] = []
    for x, toxic, n in bins:
        pools.append([[x], toxic, n])
        while len(pools) > 1 and pools[-2][1] * pools[-1][2] >= pools[-1][1] * pools[-2][2]:
            xs, t, m = pools.pop()
            pools[-1] = [pools[-1][0] + xs, pools[-1][1] + t, pools[-1][2] + m]
    curve = [(x, (t + 0.02) / (n + 0.2)) for xs, t, n in pools for x in (xs[0], xs[-1])]
    for k in range(1, len(curve)):  # smoothing must not turn the order round
        curve[k] = (curve[k][0], max(curve[k][1], curve[k - 1][1] + 1e-6))
    return [(0.0, min(0.01, curve[0][1])), *(c for c in curve if c[0] > 0), (1.0, max(0.99, curve[-1][1]))]


def train(docs: DataFrame, labels: DataFrame, *, labelled_rows: int = 40_000, lift: float = 2.0, z: float = 3.0) -> ToxicityModel:
    """Learn from at most about ``labelled_rows`` labelled documents outside the held-out fold.

    The bound is on labels only; rows are taken by a hash of doc_id. Two thirds give the weights,
    Wilson's lower bound of the toxic share among documents with a word or beginning where that is
    at least ``lift`` times the share among all (and a tenth): less is no sign of toxicity. The rest
    turns the largest weight of a text into a share. The character model counts all documents.
    Labels that are null are left out; a doc_id with several labels is toxic if one says so.
    """
    spark = docs.sparkSession
    known = labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & ~held_out(F.col("doc_id")))
    known = known.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
    share = min(1.0, labelled_rows / max(1, known.count()))
    known = known.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < int(share * (1 << 30)))
    sample = written(doc_texts(docs).join(F.broadcast(known), "doc_id"), "toxicity-sample")
    calibration = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 3
    counts = sample.where(~calibration).select("text", "toxic").mapInArrow(freeing(_feature_counts), "feature string, toxic int, n long")
    counts = counts.groupBy("feature").agg(F.sum(F.col("n") * F.col("toxic")).alias("t"), F.sum("n").alias("n")).where("t >= 3")
    weight = _lower_bound(F.col("t"), F.col("n"), z)
    usual = sample.agg(F.avg("toxic")).first()[0] or 0.0
    # As many as the labelled rows have beginnings of words in three toxic rows or more.
    weights = {r.feature: r.weight for r in counts.select("feature", weight.alias("weight")).where(F.col("weight") >= max(0.1, min(0.5, lift * usual))).collect()}
    grams = {r.gram: r.n for r in character_counts(docs).collect()}
    bc = spark.sparkContext.broadcast((weights, CharModel(grams)))
    scored = sample.where(calibration).select("doc_id", "text", "toxic").mapInArrow(freeing(_raw_scores(bc)), "doc_id long, toxic int, raw double")
    bins = scored.groupBy(F.round("raw", 2).alias("x")).agg(F.sum("toxic").alias("t"), F.count("*").alias("n")).orderBy("x").collect()
    return ToxicityModel(weights, grams, _monotone([(r.x, r.t, r.n) for r in bins] or [(0.5, 1, 2)]))


def score(docs: DataFrame, model: ToxicityModel, *, threshold: float = 0.3) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every row; empty and null texts get the lowest score.

    Repeated rows are scored each; a null doc_id is kept and is not held out. An empty table gives
    no rows. Only doc_id and text are read, other columns never matter.
    """
    bc = docs.sparkSession.sparkContext.broadcast((model.weights, CharModel(model.grams)))
    raw = doc_texts(docs).mapInArrow(freeing(_raw_scores(bc)), "doc_id long, raw double")
    curve = F.lit(model.curve[-1][1])
    for (x0, y0), (x1, y1) in reversed(list(zip(model.curve, model.curve[1:], strict=False))):
        curve = F.when(F.col("raw") <= x1, F.lit(y1) if x1 == x0 else F.lit(y0) + (F.col("raw") - x0) * ((y1 - y0) / (x1 - x0))).otherwise(curve)
    scored = raw.withColumn("score", F.least(F.lit(1.0), F.greatest(F.lit(0.0), curve)))
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def clean_documents(docs: DataFrame, model: ToxicityModel, *, threshold: float = 0.3) -> DataFrame:
    """The rows of ``docs``, all columns as they are, whose text scores below ``threshold``; null texts stay."""
    small_batches(docs.sparkSession)
    bc = docs.sparkSession.sparkContext.broadcast((model.weights, CharModel(model.grams)))
    curve = ToxicityModel({}, {}, model.curve)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = None
        for batch in batches:
            if scorer is None:
                scorer = _Scorer(*bc.value)
            texts = batch.column(batch.schema.names.index("text"))
            yield batch.filter(pa.array([curve.calibrated(scorer.raw(t.as_py() or "")) < threshold for t in texts], pa.bool_()))

    return docs.mapInArrow(freeing(run), docs.schema)
