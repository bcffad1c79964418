"""Exact removal of repeated word windows, found by recompression.

A text's words are named by hashes. First runs of one word, then, round after round, neighbouring
pairs get names of their own: a pair forms where the left symbol's class bit is 0 and the right
one's is 1, so equal substrings are cut alike but for a few symbols at their ends. Names are hashes
of what they stand for, hence the same in all tasks, and each round is local.

A window can only be repeated if every long symbol within its common core is shared. Windows that
pass are verified by 128 bits made of their core's symbols and the few words on either side of it.
Both steps shuffle packed arrays by name.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from changeflow.llm.common import doc_texts, written

_A, _B, _C = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
#: Rounds of pairing, words of a symbol that counts as evidence, entries of a bucket, texts of a slice.
ROUNDS, LONG, BUCKET, SLICE = 5, 4, 500_000, 1000
PACKED = "bucket int, h1 binary, h2 binary, keys binary, places binary"
_EMPTY = hashlib.sha256(b"").hexdigest()


def mix(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(30))
    x = x * _B
    x = x ^ (x >> np.uint64(27))
    x = x * _C
    return x ^ (x >> np.uint64(31))


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), "u8", len(words))


class Spans:
    """Hashes of any spans of a sequence, each from two prefix sums."""

    def __init__(self, x: np.ndarray, base: np.uint64):
        n = len(x)
        self.back = np.cumprod(np.concatenate([np.ones(1, "u8"), np.full(n, pow(int(base), -1, 1 << 64), "u8")]))
        powers = np.cumprod(np.concatenate([np.ones(min(1, n), "u8"), np.full(max(0, n - 1), base)]))
        self.total = np.concatenate([np.zeros(1, "u8"), np.cumsum(x * powers, dtype="u8")])

    def of(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """From a up to b, which isn't below a; the length counts too."""
        return mix((self.total[b] - self.total[a]) * self.back[a] + (b - a).astype("u8") * _C)


class Parse:
    """Symbols of a text after all rounds, and the core that any two equal windows have in common.

    With ``twice``, symbols get a second, independent name, for 128 bits in all.
    """

    def __init__(self, h: np.ndarray, rounds: int = ROUNDS, *, twice: bool = False):
        n = len(h)
        new = np.concatenate([[True], h[1:] != h[:-1]])
        starts = np.flatnonzero(new)
        ends = np.append(starts[1:], n)
        run = np.cumsum(new) - 1
        names = mix(h[starts] + (ends - starts).astype("u8") * _A)
        self.words = (h, mix(h ^ _C)) if twice else (h,)
        others = mix(self.words[1][starts] + (ends - starts).astype("u8") * _B) if twice else None
        # A run may go on outside of a window, so the core starts and ends beside it.
        self.left = np.append(ends[run], n)
        self.right = np.concatenate([[0], starts[run]])
        at = np.zeros(n + 1, np.int64)
        for r in range(rounds):
            at[starts] = np.arange(len(starts))
            at[n] = len(starts)
            second = (mix(names + np.uint64(r + 1) * _C) >> np.uint64(63)).astype(bool)
            # A first symbol that could be the second of a pair reaching outside is not common; likewise at the end.
            s = at[self.left]
            self.left = np.where(np.append(second, False)[s], np.append(ends, n)[s], self.left)
            s = at[self.right] - 1
            self.right = np.where((s >= 0) & ~second[s], starts[s], self.right)
            pair = ~second[:-1] & second[1:]
            names = names.copy()
            names[:-1][pair] = mix(names[:-1][pair] * _A + names[1:][pair] + np.uint64(r))
            keep = np.concatenate([[True], ~pair])
            if twice:
                others = others.copy()
                others[:-1][pair] = mix(others[:-1][pair] * _B + others[1:][pair] + np.uint64(r))
                others = others[keep]
            names, starts = names[keep], starts[keep]
            ends = np.append(starts[1:], n)
        at[starts] = np.arange(len(starts))
        at[n] = len(starts)
        self.n, self.names, self.others, self.starts, self.at = n, names, others, starts, at
        self.evidence = ends - starts >= LONG

    def candidates(self, window: int, shared: np.ndarray) -> np.ndarray:
        """Starts of windows without an unshared long symbol in their core; ``shared`` has starts of symbols."""
        alone = self.evidence.copy()
        alone[self.at[shared]] = False
        total = np.concatenate([[0], np.cumsum(alone)])
        a, b = self.at[self.left[: self.n - window + 1]], self.at[self.right[window:]]
        return np.flatnonzero((b <= a) | (total[np.maximum(b, a)] == total[a]))

    def blind(self, window: int) -> bool:
        """Whether some window has no long symbol in its core."""
        total = np.concatenate([[0], np.cumsum(self.evidence)])
        a, b = self.at[self.left[: self.n - window + 1]], self.at[self.right[window:]]
        return bool(((b <= a) | (total[np.maximum(b, a)] == total[a])).any())

    def window_names(self, starts: np.ndarray, window: int) -> list[np.ndarray]:
        """Two independent 64-bit names of the windows at ``starts``: the words before the core, its symbols, the words after it.

        Equal windows have one core, so they get the same names; a window without a core is named by its words.
        """
        left, right = self.left[starts], self.right[starts + window]
        none = right <= left
        left, right = np.where(none, starts, left), np.where(none, starts, right)
        found = []
        for base, words, names in zip((_A, _B), self.words, (self.names, self.others), strict=True):
            w, s = Spans(words, base), Spans(names, base)
            core = s.of(np.where(none, 0, self.at[left]), np.where(none, 0, self.at[right]))
            found.append(mix((w.of(starts, left) * base + core) * base + w.of(right, starts + window)))
        return found


def _text_key(words: list[bytes]) -> bytes:
    """128-bit name of a word sequence."""
    return xxhash.xxh3_128_digest(b" ".join(words), seed=17)


def _keys(packed: bytes) -> np.ndarray:
    """Packed keys as rows of two numbers."""
    return np.frombuffer(packed, "u8").reshape(-1, 2)


def _sketches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for text in batch.column(1):
            words = text.as_py().encode("utf-8", "surrogatepass").split()
            rows.append((_text_key(words), len(words), hashlib.sha256(b" ".join(words)).hexdigest()))
        key, n, sha = zip(*rows, strict=True) if rows else ((), (), ())
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(key, pa.binary()), pa.array(n, pa.int64()), pa.array(sha, pa.string())], names=["doc_id", "key", "n_words", "sha"])


def _pack(h1: np.ndarray, h2: np.ndarray, keys: np.ndarray, places: np.ndarray, buckets: int) -> pa.RecordBatch:
    """Packed entries of a slice. What repeats within the slice is settled here: its places go to a
    bucket of their own (below 0), and one entry with place -1 tells other slices."""
    order = np.lexsort((h2, h1))
    h1, h2, keys, places = h1[order], h2[order], keys[order], places[order]
    new = np.concatenate([[True], (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])]) if len(h1) else np.zeros(0, bool)
    starts = np.flatnonzero(new)
    many = np.diff(np.append(starts, len(h1))) > 1
    repeated = np.repeat(many, np.diff(np.append(starts, len(h1))))
    rows = []
    if repeated.any():
        rows.append((-1 - int(h1[0] >> np.uint64(7)) % buckets, b"", b"", keys[repeated].tobytes(), places[repeated].astype("i4").tobytes()))
    sent = starts
    p = np.where(many, -1, places[sent]).astype("i4")
    k, a, b = np.where(many[:, None], np.uint64(0), keys[sent]), h1[sent], h2[sent]
    bucket = ((a >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(int)  # rises with a
    found, first = np.unique(bucket, return_index=True)
    for c, s, e in zip(found, first, [*first[1:], len(a)], strict=False):
        rows.append((int(c), a[s:e].tobytes(), b[s:e].tobytes(), k[s:e].tobytes(), p[s:e].tobytes()))
    types = [pa.int32(), *[pa.binary()] * 4]
    return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows, strict=True) if rows else [()] * 5, types, strict=True)], names=["bucket", "h1", "h2", "keys", "places"])


def _repeats(targets: int):
    """Places of a bucket's entries whose hash is there more than once, packed for each target bucket of texts."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        keys = _keys(b"".join(pdf["keys"]))
        places = np.frombuffer(b"".join(pdf["places"]), "i4")
        if pdf["bucket"].iloc[0] >= 0:
            h1, h2 = np.frombuffer(b"".join(pdf["h1"]), "u8"), np.frombuffer(b"".join(pdf["h2"]), "u8")
            order = np.lexsort((h2, h1))
            h1, h2, keys, places = h1[order], h2[order], keys[order], places[order]
            starts = np.flatnonzero(np.concatenate([[True], (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])]))
            sizes = np.diff(np.append(starts, len(h1)))
            keep = np.repeat(sizes > 1, sizes) & (places >= 0)
            keys, places = keys[keep], places[keep]
        target = (keys[:, 0] % np.uint64(targets)).astype(np.int64)
        order = np.argsort(target, kind="stable")
        keys, places = keys[order], places[order]
        found, first = np.unique(target[order], return_index=True)
        ends = np.append(first[1:], len(keys))
        cut = [slice(s, e) for s, e in zip(first, ends, strict=False)]
        return pd.DataFrame({"target": found, "keys": [keys[c].tobytes() for c in cut], "places": [places[c].tobytes() for c in cut]})

    return run


def _gathered(pdf: pd.DataFrame) -> pd.DataFrame:
    """(key, places): one row for each text of a target bucket."""
    keys = _keys(b"".join(pdf["keys"]))
    places = np.frombuffer(b"".join(pdf["places"]), "i4")
    order = np.lexsort((keys[:, 1], keys[:, 0]))
    keys, places = keys[order], places[order]
    first = np.flatnonzero(np.concatenate([np.ones(min(1, len(keys)), bool), (keys[1:] != keys[:-1]).any(axis=1)]))
    ends = np.append(first[1:], len(keys))
    return pd.DataFrame({"key": [keys[s].tobytes() for s in first], "places": [places[s:e].tobytes() for s, e in zip(first, ends, strict=False)]})


def _by_text(entries: DataFrame, buckets: int) -> DataFrame:
    """(key, places) of all texts with a repeated hash."""
    repeats = entries.groupBy("bucket").applyInPandas(_repeats(buckets), "target long, keys binary, places binary")
    return repeats.groupBy("target").applyInPandas(_gathered, "key binary, places binary")


def _slices(batches: Iterator[pa.RecordBatch], window: int) -> Iterator[list[tuple]]:
    """(key, words, other column) of texts long enough for a window, some at a time.

    Batches have a row's text, the keys it may have or may not have, and what goes with it.
    """
    for batch in batches:
        part, size = [], 0
        only, but = ("only" in batch.schema.names), ("but" in batch.schema.names)
        marks = batch.column("only" if only else "but") if only or but else None
        extra = batch.column("places") if "places" in batch.schema.names else None
        for k, text in enumerate(batch.column("text")):
            words = text.as_py().encode("utf-8", "surrogatepass").split()
            if len(words) < window:
                continue
            key = _text_key(words)
            mark = marks[k].as_py() if marks is not None else None
            if (only and key != mark) or (but and mark and key in mark):
                continue
            part.append((key, words) if extra is None else (key, words, extra[k].as_py()))
            size += len(words)
            if len(part) >= SLICE or size > 1_000_000:
                yield part
                part, size = [], 0
        if part:
            yield part


def _symbols(window: int, buckets: int):
    """Texts to packed names of long symbols; a text with windows that have none is named by place -2."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _slices(batches, window):
            names, keys, places, blind = [], [], [], []
            for key, words in part:
                p = Parse(word_hashes(words))
                names.append(p.names[p.evidence])
                places.append(p.starts[p.evidence])
                keys.append(np.broadcast_to(_keys(key), (len(places[-1]), 2)))
                if p.blind(window):
                    blind.append(key)
            names = np.concatenate(names)
            yield _pack(names, np.zeros(len(names), "u8"), np.concatenate(keys), np.concatenate(places), buckets)
            if blind:
                yield pa.RecordBatch.from_arrays([pa.array([-1 - int(_keys(blind[0])[0, 0]) % buckets], pa.int32()), pa.array([b""]), pa.array([b""]), pa.array([b"".join(blind)]), pa.array([np.full(len(blind), -2, "i4").tobytes()])], names=["bucket", "h1", "h2", "keys", "places"])

    return run


def _windows(window: int, buckets: int):
    """Texts with the places of shared symbols to packed names of candidate windows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _slices(batches, window):
            one, two, keys, places = [], [], [], []
            for key, words, shared in part:
                at = np.frombuffer(shared, "i4")
                p = Parse(word_hashes(words), twice=True)
                starts = p.candidates(window, at[at >= 0])
                a, b = p.window_names(starts, window)
                one.append(a)
                two.append(b)
                places.append(starts)
                keys.append(np.broadcast_to(_keys(key), (len(starts), 2)))
            yield _pack(np.concatenate(one), np.concatenate(two), np.concatenate(keys), np.concatenate(places), buckets)

    return run


def covered(n: int, starts: np.ndarray, window: int) -> np.ndarray:
    steps = np.zeros(n + 1, np.int64)
    np.add.at(steps, starts, 1)
    np.add.at(steps, starts + window, -1)
    return np.cumsum(steps[:n]) > 0


def _kept(window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _slices(batches, window):
            rows = []
            for key, words, places in part:
                gone = covered(len(words), np.frombuffer(places, "i4"), window)
                kept = b" ".join([w for w, g in zip(words, gone.tolist(), strict=True) if not g])
                rows.append((key, int(gone.sum()), hashlib.sha256(kept).hexdigest(), kept))
            key, n, sha, kept = zip(*rows, strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(key, pa.binary()), pa.array(n, pa.int64()), pa.array(sha, pa.string()), pa.array([x.decode("utf-8", "replace") for x in kept], pa.string())], names=["key", "removed", "kept_sha", "kept"])

    return run


def _with_places(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(text, only, places) of the wanted (doc_id, key, places) rows.

    Texts are narrowed down by id first; ids and keys are broadcast only where they are few.
    """
    ids = wanted.select("doc_id", F.col("key").alias("only"))
    few = ids.count() <= 500_000  # 12 MB
    texts = docs.join(F.broadcast(ids) if few else ids, "doc_id").select("text", "only")
    return texts.join(wanted.select(F.col("key").alias("only"), "places"), "only")


def repeated_windows(docs: DataFrame, *, window: int = 35) -> tuple[DataFrame, DataFrame]:
    """Sketches of all rows (doc_id, key, n_words, sha) and, for texts that lose something, (key, removed, kept_sha, kept).

    ``key`` names a word sequence. A text that several rows have is judged once.
    """
    docs = doc_texts(docs)
    sketches = written(docs.mapInArrow(_sketches, "doc_id long, key binary, n_words long, sha string"), "substring-sketches")
    long = sketches.where(F.col("doc_id").isNotNull() & (F.col("n_words") >= window))
    reps = written(long.groupBy("key").agg(F.min("doc_id").alias("doc_id"), F.count("*").alias("copies"), F.max("n_words").alias("n_words")).select("doc_id", "key", "copies", "n_words"), "substring-texts")
    words = reps.agg(F.sum("n_words")).first()[0] or 0
    buckets = 1 + int(words * 0.11) // BUCKET

    # Rows whose words another row with a smaller id has.
    copied = long.select("doc_id", "key").join(reps.select("key", F.col("doc_id").alias("rep")), "key").where("doc_id <> rep")
    copied = written(copied.groupBy("doc_id").agg(F.collect_set("key").alias("but")), "substring-copies")
    few = copied.count() <= 500_000
    texts = docs.where("doc_id is not null").join(F.broadcast(copied) if few else copied, "doc_id", "left").select("text", "but")
    entries = texts.mapInArrow(_symbols(window, buckets), PACKED)
    touched = written(_by_text(entries, buckets).join(reps.select("doc_id", "key"), "key").select("doc_id", "key", "places"), "substring-touched")
    texts = _with_places(docs, touched)
    buckets = 1 + int(words * 0.3) // BUCKET
    repeated = _by_text(texts.mapInArrow(_windows(window, buckets), PACKED), buckets)
    # A text with copies is gone whole; it only had to be there for others.
    hit = written(repeated.join(reps.where("copies = 1").select("doc_id", "key"), "key").select("doc_id", "key", "places"), "substring-hit")
    kept = _with_places(docs, hit).mapInArrow(_kept(window), "key binary, removed long, kept_sha string, kept string")
    copies = reps.where("copies > 1").select("key", F.col("n_words").alias("removed"), F.lit(_EMPTY).alias("kept_sha"), F.lit("").alias("kept"))
    return sketches, kept.union(copies)


def deduplicated(docs: DataFrame, *, window: int = 35) -> DataFrame:
    """``doc_id, n_words, n_removed, kept_sha256`` of every row.

    Words are runs without ASCII white space, unchanged. Words in a window of ``window`` words whose
    sequence also starts anywhere else, in another row or the same one, are removed.

    Null, empty and blank texts have no words. Texts shorter than a window lose nothing. Repeated
    rows are places of their own, so they remove each other. Rows with a null doc_id take no part
    and come back whole. An empty table gives no rows. Windows are compared by 128 bits of
    their symbols and words, texts by a 128-bit hash of their words.
    """
    sketches, lost = repeated_windows(docs, window=window)
    joined = sketches.join(lost.select("key", "removed", "kept_sha"), "key", "left")
    mine = F.col("doc_id").isNotNull() & F.col("removed").isNotNull()
    return joined.select(
        "doc_id", "n_words", F.when(mine, F.col("removed")).otherwise(F.lit(0).cast("long")).alias("n_removed"), F.when(mine, F.col("kept_sha")).otherwise(F.col("sha")).alias("kept_sha256")
    )
