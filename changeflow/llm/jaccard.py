"""Exact n-gram Jaccard join of documents with signature trees.

1. Every distinct text gets a sketch: its shingle count, a token bitmap and its lowest shingle
   hashes. Under one order of all shingles, two linked texts share one of their first
   ``n - ceil(t * n) + 1`` shingles; a sketch holds half as many again.
2. Texts meet in groups by shared hash. Within a group a signature tree (nodes hold OR-combined
   bitmaps and size ranges) is traversed against itself; node pairs whose largest possible overlap
   is too small are pruned. What remains is verified on the whole shingle sets.
3. Hashes of more than ``hot`` texts (passages that many documents share) come last in the order.
   A text that keeps enough other hashes does without them. One that doesn't is *crowded*. Crowded texts
   and the few that may link to them are counted anew by all of their shingles. Those with enough rare ones
   meet by these; the others are *dense* (mass near copies): leaders settle them, trees in cells of
   bounded size what leaders leave, and texts between leaders that no link connects.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from changeflow.llm.common import doc_texts, freeing, written
from changeflow.llm.components import components

_A, _B, _C = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
#: Entries that one bucket of hashes holds on average, and texts that one side of a cell holds.
BUCKET, CELL, HOT = 150_000, 1024, 64
#: Entries that a task sorts at a time, and leaders of a large group in a round.
FLUSH, LEADERS = 200_000, 8
#: Flags of packed entries besides 0: a hash without a text, a text's number of hashes.
MARK, NUMBER = 1, 2
#: Rows of ids and keys that may be broadcast: 30 MB.
FEW = 1_000_000


def words_of(text: str) -> list[bytes]:
    """Runs without ASCII white space, A-Z in lower case."""
    return text.encode("utf-8", "surrogatepass").lower().split()


def shingle_hashes(words: list[bytes], k: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of all k-word shingles; shorter texts are one shingle."""
    if not words:
        return np.zeros(0, "u8")
    if len(words) < k:
        return np.array([xxhash.xxh3_64_intdigest(b" ".join(words), seed=len(words))], "u8")
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, words), "u8", len(words))
    n = len(words) - k + 1
    x = h[:n].copy()
    for j in range(1, k):
        x = x * _A + h[j : n + j]
    x ^= x >> np.uint64(30)
    x *= _B
    x ^= x >> np.uint64(27)
    x *= _C
    x ^= x >> np.uint64(31)
    return np.unique(x)


def prefix_length(n, percent: int):
    """Two sets linked at ``percent`` share one of this many first elements, in any common order."""
    return n - (-(-percent * n // 100)) + 1


def sketch_length(n: int, percent: int) -> int:
    p = prefix_length(n, percent)
    return min(n, p + p // 2 + 4)


def bitmap(hashes: np.ndarray, fine: int = 1) -> bytes:
    """``fine`` to twice as many bits for each element, a power of two of them."""
    m = max(64, 1 << (fine * len(hashes) - 1).bit_length())
    bits = np.zeros(m, np.uint8)
    bits[(hashes >> np.uint64(20)) & np.uint64(m - 1)] = 1
    return np.packbits(bits, bitorder="little").tobytes()


class Node:
    __slots__ = ("bits", "m", "low", "high", "excess", "children", "item")

    def __init__(self, bits: int, m: int, low: int, high: int, excess: int, children=(), item=None):
        self.bits, self.m, self.low, self.high, self.excess, self.children, self.item = bits, m, low, high, excess, children, item


def _fold(bits: int, m: int, to: int) -> int:
    while m > to:
        m //= 2
        bits = (bits >> m) | (bits & ((1 << m) - 1))
    return bits


def leaf(item, n: int, raw: bytes) -> Node:
    bits = int.from_bytes(raw, "little")
    return Node(bits, len(raw) * 8, n, n, n - bits.bit_count(), (), item)


def tree(leaves: list[Node], fan: int = 4) -> Node:
    """Leaves by size, parents over ``fan`` neighbours; a parent has the OR of their bitmaps, folded to the shortest."""
    level = sorted(leaves, key=lambda x: (x.low, x.bits))
    while len(level) > 1:
        up = []
        for k in range(0, len(level), fan):
            part = level[k : k + fan]
            m = min(x.m for x in part)
            bits = 0
            for x in part:
                bits |= _fold(x.bits, x.m, m)
            # Elements beyond one a bit: of the folded bitmap, for the member with most of them.
            excess = max(x.excess + x.bits.bit_count() - _fold(x.bits, x.m, m).bit_count() if x.m > m else x.excess for x in part)
            up.append(Node(bits, m, min(x.low for x in part), max(x.high for x in part), excess, part))
        level = up
    return level[0]


def may_link(u: Node, v: Node, percent: int) -> bool:
    """Whether the largest possible overlap of a text under ``u`` and one under ``v`` reaches the least they need."""
    if 100 * u.high < percent * v.low or 100 * v.high < percent * u.low:
        return False
    m = min(u.m, v.m)
    a, b = _fold(u.bits, u.m, m), _fold(v.bits, v.m, m)
    common = (a & b).bit_count()
    # A text has at most as many elements at the common bits as there are bits, and its excess.
    most = min(
        common + min(u.excess + u.bits.bit_count() - a.bit_count(), v.excess + v.bits.bit_count() - b.bit_count()), u.high, v.high
    )
    return (100 + percent) * most >= percent * (u.low + v.low)


def traverse(u: Node, v: Node, percent: int, same=None) -> Iterator[tuple]:
    """Pairs of leaf items that may link; ``same(x, y)`` tells pairs of nodes that need no look."""
    stack = [(u, v)]
    while stack:
        x, y = stack.pop()
        if x is y:
            kids = x.children
            stack += [(kids[i], kids[j]) for i in range(len(kids)) for j in range(i, len(kids))]
        elif (same is None or not same(x, y)) and may_link(x, y, percent):
            if not x.children and not y.children:
                yield x.item, y.item
            elif not y.children or (x.children and x.high - x.low >= y.high - y.low):
                stack += [(c, y) for c in x.children]
            else:
                stack += [(x, c) for c in y.children]


def linked(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    inter = len(np.intersect1d(x, y, assume_unique=True))
    return 100 * inter >= percent * (len(x) + len(y) - inter)


class Union:
    def __init__(self):
        self.up: dict = {}

    def find(self, x):
        root = x
        while self.up.get(root, root) != root:
            root = self.up[root]
        while self.up.get(x, x) != root:
            self.up[x], x = root, self.up[x]
        return root

    def join(self, x, y) -> bool:
        a, b = self.find(x), self.find(y)
        if a == b:
            return False
        self.up[max(a, b)] = min(a, b)
        return True


def _keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        words = [words_of(t.as_py()) for t in batch.column(1)]
        keys = [xxhash.xxh3_128_digest(b" ".join(w)) if w else None for w in words]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(keys, pa.binary())], names=["doc_id", "cls"])


def _sketches(k: int, percent: int):
    """(doc_id, text, dropped) to sketches, but for empty texts and those of a class in ``dropped``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for doc_id, text, dropped in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2).to_pylist(), strict=True):
                words = words_of(text.as_py())
                cls = xxhash.xxh3_128_digest(b" ".join(words))
                if words and cls not in (dropped or ()):
                    h = shingle_hashes(words, k)
                    rows.append((doc_id, cls, len(h), bitmap(h), h[: sketch_length(len(h), percent)].tobytes()))
            columns = zip(*rows, strict=True) if rows else [()] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, [pa.int64(), pa.binary(), pa.int32(), pa.binary(), pa.binary()], strict=True)], names=["rep", "cls", "n", "bits", "low"])

    return run


def _dealt(hashes: np.ndarray, reps: np.ndarray, flags: np.ndarray, bucket: np.ndarray) -> pa.RecordBatch:
    order = np.argsort(bucket, kind="stable")
    hashes, reps, flags = hashes[order], reps[order], flags[order]
    found, starts = np.unique(bucket[order], return_index=True)
    ends = [*starts[1:], len(hashes)]
    cut = lambda a: pa.array([a[s:e].tobytes() for s, e in zip(starts, ends, strict=True)], pa.binary())
    return pa.RecordBatch.from_arrays([pa.array(found, pa.int32()), cut(hashes), cut(reps), cut(flags)], names=["bucket", "hashes", "reps", "flags"])


def _bucket_of(hashes: np.ndarray, buckets: int) -> np.ndarray:
    return ((hashes >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(int)


def _gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(hashes, reps) of (rep, hashes) rows, about ``FLUSH`` entries at a time."""
    held, n = [], 0
    for batch in batches:
        for at in range(0, batch.num_rows, 1000):
            rows = batch.slice(at, 1000)
            parts = [np.frombuffer(b.as_py(), "u8") for b in rows.column(1)]
            reps = rows.column(0).to_numpy(zero_copy_only=False).astype("i8")
            held.append((np.concatenate(parts), np.repeat(reps, [len(p) for p in parts])))
            n += len(held[-1][0])
            if n >= FLUSH:
                yield np.concatenate([h for h, _ in held]), np.concatenate([r for _, r in held])
                held, n = [], 0
    if n:
        yield np.concatenate([h for h, _ in held]), np.concatenate([r for _, r in held])


def _bucketed(buckets: int, hot: int | None = None):
    """(rep, hashes) to packed entries of each bucket of the hash space.

    With ``hot``, a hash of more entries at a time is not sent with each: one MARK goes to its bucket, and each text's
    NUMBER of such hashes goes to some bucket, so a hash that a third of all texts share loads no bucket.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for hashes, reps in _gathered(batches):
            flags = np.zeros(len(hashes), "u1")
            bucket = _bucket_of(hashes, buckets)
            if hot is not None:
                found, inverse, counts = np.unique(hashes, return_inverse=True, return_counts=True)
                many = counts[inverse] > hot
                marks = found[counts > hot]
                texts, numbers = np.unique(reps[many], return_counts=True)
                hashes = np.concatenate([hashes[~many], marks, numbers.astype("u8")])
                reps = np.concatenate([reps[~many], np.zeros(len(marks), "i8"), texts])
                flags = np.concatenate([flags[~many], np.full(len(marks), MARK), np.full(len(texts), NUMBER)]).astype("u1")
                bucket = np.concatenate([bucket[~many], _bucket_of(marks, buckets), texts % buckets])
            if len(hashes):
                yield _dealt(hashes, reps, flags, bucket)

    return run


def _distinct_bucketed(buckets: int):
    """As ``_bucketed``, but each hash once for all texts of a flush, as a MARK."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for hashes, _ in _gathered(batches):
            hashes = np.unique(hashes)
            yield _dealt(hashes, np.zeros(len(hashes), "i8"), np.full(len(hashes), MARK, "u1"), _bucket_of(hashes, buckets))

    return run


def _lowest_bucketed(buckets: int):
    """As ``_bucketed``, but each hash once for all texts of a flush, with the smallest of them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for hashes, reps in _gathered(batches):
            hashes, reps = _lowest(hashes, reps)
            yield _dealt(hashes, reps, np.zeros(len(hashes), "u1"), _bucket_of(hashes, buckets))

    return run


def _lowest(hashes: np.ndarray, reps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.lexsort((reps, hashes))
    found, first = np.unique(hashes[order], return_index=True)
    return found, reps[order][first]


def _entries(pdf: pd.DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return np.frombuffer(b"".join(pdf["hashes"]), "u8"), np.frombuffer(b"".join(pdf["reps"]), "i8"), np.frombuffer(b"".join(pdf["flags"]), "u1")


def _meetings(hot: int):
    """(pivot, rep, shared, hot) of a bucket: all texts of a cold hash meet at the smallest; hot hashes are only counted, for each text."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        hashes, reps, flags = _entries(pdf)
        h, r = hashes[flags == 0], reps[flags == 0]
        order = np.lexsort((r, h))
        h, r = h[order], r[order]
        found, starts, counts = np.unique(h, return_index=True, return_counts=True)
        many = np.repeat((counts > hot) | np.isin(found, hashes[flags == MARK]), counts)
        pivot = np.where(many, 0, np.repeat(r[starts], counts)) if len(h) else r
        kept = many | np.repeat(counts > 1, counts)
        counted = flags == NUMBER
        met = pd.DataFrame({"pivot": np.concatenate([pivot[kept], np.zeros(counted.sum(), "i8")]), "rep": np.concatenate([r[kept], reps[counted]])})
        met["hot"] = np.concatenate([many[kept], np.ones(counted.sum(), bool)])
        met["shared"] = np.concatenate([np.ones(kept.sum(), "i8"), hashes[counted].astype("i8")])
        return met.groupby(["hot", "pivot", "rep"], as_index=False)["shared"].sum()[["pivot", "rep", "shared", "hot"]]

    return run


def _hits(pdf: pd.DataFrame) -> pd.DataFrame:
    """(rep, hits): how many of a text's hashes are among the marked ones of a bucket; hashes of many texts count as if they were."""
    hashes, reps, flags = _entries(pdf)
    hit = (flags == 0) & np.isin(hashes, hashes[flags == MARK])
    counted = flags == NUMBER
    rows = pd.DataFrame({"rep": np.concatenate([reps[hit], reps[counted]]), "hits": np.concatenate([np.ones(hit.sum(), "i8"), hashes[counted].astype("i8")])})
    return rows.groupby("rep", as_index=False)["hits"].sum()


def _pivots(pdf: pd.DataFrame) -> pd.DataFrame:
    """The smallest text of every hash of a bucket, packed."""
    hashes, reps, _ = _entries(pdf)
    hashes, reps = _lowest(hashes, reps)
    return pd.DataFrame({"bucket": [pdf["bucket"].iloc[0]], "hashes": [hashes.tobytes()], "reps": [reps.tobytes()]})


def _at_pivots(entries: pd.DataFrame, pivots: pd.DataFrame) -> pd.DataFrame:
    """(pivot, rep, shared) of a share of a bucket's entries."""
    if not len(entries):
        return pd.DataFrame([], columns=["pivot", "rep", "shared"])
    hashes, reps, _ = _entries(entries)
    known, lowest = np.frombuffer(b"".join(pivots["hashes"]), "u8"), np.frombuffer(b"".join(pivots["reps"]), "i8")
    met = pd.DataFrame({"pivot": lowest[np.searchsorted(known, hashes)], "rep": reps, "shared": 1})
    return met.groupby(["pivot", "rep"], as_index=False)["shared"].sum()


def _candidates(percent: int):
    """Pairs that the signature trees of a call's pivots leave; two dense texts are not compared here."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pairs: set[tuple[int, int]] = set()
        for _, g in pdf.groupby(["pivot", "whole"]):
            if len(g) < 2:
                continue
            items = list(g[["rep", "dense", "n", "bits"]].itertuples(index=False, name=None))
            plain = [leaf(r, n, b) for r, c, n, b in items if not c]
            full = [leaf(r, n, b) for r, c, n, b in items if c]
            if plain:
                top = tree(plain)
                pairs.update((min(p), max(p)) for p in traverse(top, top, percent))
                if full:
                    pairs.update((min(p), max(p)) for p in traverse(top, tree(full), percent))
        return pd.DataFrame(sorted(pairs), columns=["a", "b"])

    return run


def _verify(percent: int):
    """Exact links among a call's pairs; pairs that are connected already need no look."""

    def run(pairs: pd.DataFrame, sets: pd.DataFrame) -> pd.DataFrame:
        of = {r: np.frombuffer(b, "u8") for r, b in zip(sets["rep"], sets["hashes"], strict=True)}
        union, links = Union(), []
        for a, b in zip(pairs["a"].tolist(), pairs["b"].tolist(), strict=True):
            if union.find(a) != union.find(b) and linked(of[a], of[b], percent):
                union.join(a, b)
                links.append((a, b))
        return pd.DataFrame(links, columns=["a", "b"])

    return run


def _shared_with(leaders: list[np.ndarray]):
    """A function that tells how many elements a set shares with each of the leaders."""
    known, at = np.unique(np.concatenate(leaders), return_inverse=True)
    has = np.zeros((len(known), len(leaders)), "i8")
    has[at, np.repeat(np.arange(len(leaders)), [len(x) for x in leaders])] = 1

    def shared(x: np.ndarray) -> np.ndarray:
        places = np.minimum(np.searchsorted(known, x), len(known) - 1)
        return has[places[known[places] == x]].sum(axis=0)

    return shared


def _led(percent: int):
    """(pivot, rep, leader, near): of a block's texts, the first leader that each links to, and leaders within twice that distance.

    Jaccard distance is a metric: a text farther than that from a leader links to no text that links to the leader.
    A text without a leader names all leaders near it; one with a leader those that its block doesn't connect with its own.
    Rows without ``rep`` are links of leaders: with each other, and with texts that link to several, as far as they connect more leaders.
    """
    near = max(0, 2 * percent - 100)

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        out = []
        for pivot, g in pdf.groupby("pivot"):
            sets = {r: np.frombuffer(b, "u8") for r, b in zip(g["rep"], g["hashes"], strict=True)}
            leaders, texts = (sorted(set(g["rep"][g["leads"] == leads])) for leads in (True, False))
            sizes = np.array([len(sets[x]) for x in leaders])
            shared = _shared_with([sets[x] for x in leaders])
            union, close, own = Union(), {}, {}
            for r in dict.fromkeys(leaders + texts):
                inter = shared(sets[r])
                whole = len(sets[r]) + sizes - inter
                close[r] = [leaders[k] for k in np.flatnonzero(100 * inter >= near * whole)]
                hits = [leaders[k] for k in np.flatnonzero(100 * inter >= percent * whole)]
                own[r] = r if r in leaders else hits[0] if hits else None
                out += [(pivot, None, x, [r]) for x in hits if union.join(own[r], x)]
            for r in texts:
                apart = [x for x in close[r] if own[r] is None or union.find(x) != union.find(own[r])]
                out.append((pivot, r, own[r], apart))
        return pd.DataFrame(out, columns=["pivot", "rep", "leader", "near"]).astype({"rep": "Int64", "leader": "Int64"})

    return run


def _cell_links(percent: int):
    """Links among the texts of each cell of a call that join its components, on whole sets.

    A cell with one side compares all its texts; one with two compares side 0 with side 1. With a leader, side 0 is connected
    already; with a partner of the leader, side 1 is too, and one link is all there is to find.
    """

    def cell(pdf: pd.DataFrame) -> list[tuple[int, int]]:
        sets = {r: np.frombuffer(b, "u8") for r, b in zip(pdf["rep"], pdf["hashes"], strict=True)}
        sides = [sorted(set(pdf["rep"][pdf["side"] == s])) for s in (0, 1)]
        if not sides[0]:  # one block of two is empty; the other has a cell of its own
            return []
        one = not sides[1]
        union, links = Union(), []
        if not pd.isna(pdf["leader"].iloc[0]):
            if one:
                return []
            for x in sides[0]:
                union.join(sides[0][0], x)
        paired = not pd.isna(pdf["partner"].iloc[0])
        if paired:
            for x in sides[1]:
                union.join(sides[1][0], x)

        def look(x, y):
            if x != y and union.find(x) != union.find(y) and linked(sets[x], sets[y], percent):
                union.join(x, y)
                links.append((min(x, y), max(x, y)))

        # First all against one, so that groups of near copies fall together in one go.
        everyone = sorted(sets, key=lambda r: (len(sets[r]), r))
        rest = everyone
        for _ in range(4):
            if len(rest) > 2:
                middle = rest[len(rest) // 2]
                for r in rest:
                    look(middle, r)
                rest = [r for r in rest if union.find(r) != union.find(middle)]
        tops = [tree([leaf(r, len(sets[r]), bitmap(sets[r], 4)) for r in side]) for side in sides if side]
        memo: dict[int, tuple] = {}

        def members(node: Node) -> tuple:
            if id(node) not in memo:
                memo[id(node)] = (node.item,) if not node.children else sum((members(c) for c in node.children), ())
            return memo[id(node)]

        def same(u: Node, v: Node) -> bool:
            first = union.find(members(u)[0])
            return all(union.find(x) == first for x in members(u)) and all(union.find(x) == first for x in members(v))

        for x, y in traverse(tops[0], tops[0] if one else tops[1], percent, same):
            look(x, y)
            if paired and links:
                break
        return links

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        found = {p for _, g in pdf.groupby(["pivot", "leader", "partner", "i", "j"], dropna=False) for p in cell(g)}
        return pd.DataFrame(sorted(found), columns=["a", "b"])

    return run


def _grid(rows: DataFrame, others: DataFrame | None = None) -> DataFrame:
    """``pivot, leader, partner, i, j, side, rep``: cells of about ``CELL`` texts a side that bring all texts of a pivot together.

    With ``others``, texts of ``rows`` meet those of ``others`` with the same pivot, leader and partner (if any), and not one another.
    """
    def blocks(df: DataFrame, by: list[str], name: str = "cells") -> DataFrame:
        return df.groupBy(*by).agg(F.ceil(F.count("*") / CELL).cast("int").alias(name))

    own, none = F.pmod(F.xxhash64("rep"), F.col("cells")).cast("int").alias("own"), F.lit(None).cast("long")
    if others is None:
        cut = rows.join(blocks(rows, ["pivot"]), "pivot").select("pivot", "rep", own, F.explode(F.sequence(F.lit(0), F.col("cells") - 1)).alias("other"))
        return cut.select("pivot", none.alias("leader"), none.alias("partner"), F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), (F.col("own") > F.col("other")).cast("int").alias("side"), "rep")
    by, out = ["pivot", "leader", *(c for c in rows.columns if c == "partner")], []
    partner = F.col("partner") if "partner" in by else none.alias("partner")
    for side, (mine, theirs) in enumerate(((rows, others), (others, rows))):
        cut = mine.select(*by, "rep").join(blocks(mine, by), by).join(blocks(theirs, by, "across"), by)
        cut = cut.select(*by, "rep", own, F.explode(F.sequence(F.lit(0), F.col("across") - 1)).alias("other"))
        i, j = ("own", "other") if side == 0 else ("other", "own")
        out.append(cut.select("pivot", "leader", partner, F.col(i).alias("i"), F.col(j).alias("j"), F.lit(side).alias("side"), "rep"))
    return out[0].union(out[1])


def _solved(cells: DataFrame, sets: DataFrame, percent: int, name: str) -> DataFrame:
    """Links of all cells; small cells go many to a call."""
    cells = written(cells, f"{name}-cells")
    calls = F.lit(1 + cells.count() // CELL)
    called = cells.join(sets, "rep").withColumn("call", F.pmod(F.xxhash64("pivot", "leader", "partner", "i", "j"), calls))
    return written(called.groupBy("call").applyInPandas(_cell_links(percent), "a long, b long").distinct(), name)


def _dense_links(members: DataFrame, sets: DataFrame, percent: int, rounds: int = 3) -> DataFrame:
    """Links that connect the dense texts of every group ``(pivot, rep, close)``, ``close`` telling how few of a text's shingles are rare.

    A group of one cell is solved there. Of a larger one, all texts are held against a few leaders, the closest and some others;
    texts that link to a leader are settled, but for those that come near it without a link. The rest is led again, a few rounds;
    what then remains meets in cells. So a text is sent once a round, and only texts that no leader settles are multiplied, and
    those between two leaders that no link connects.
    """
    links, between = [], []
    left = members
    for turn in range(rounds):
        sized = left.groupBy("pivot").agg(
            F.count("*").alias("texts"),
            F.array_distinct(F.array(*(F.max_by("rep", F.struct(*([F.col("close")] if k < LEADERS // 2 else []), F.xxhash64("rep", F.lit(k + LEADERS * turn)))) for k in range(LEADERS)))).alias("leaders"),
        ).where("texts > 1")
        sized = written(sized, "jaccard-groups")
        small = left.join(sized.where(f"texts <= {CELL}").select("pivot"), "pivot").select("pivot", "rep")
        links.append(_solved(_grid(small), sets, percent, "jaccard-small"))
        large = sized.where(f"texts > {CELL}").withColumn("blocks", F.ceil(F.col("texts") / CELL).cast("int"))
        if large.isEmpty():
            return _union(links + _between_leaders(between, links, sets, percent))
        asked = left.join(large.select("pivot", "blocks"), "pivot").select("pivot", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int").alias("block"), "rep", F.lit(False).alias("leads"))
        leaders = large.select("pivot", F.explode("leaders").alias("rep"), "blocks").select("pivot", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), "rep", F.lit(True).alias("leads"))
        led = asked.union(leaders).join(sets, "rep").groupBy("pivot", "block").applyInPandas(_led(percent), "pivot long, rep long, leader long, near array<long>")
        led = written(led, "jaccard-led")
        links.append(led.where("rep is not null and leader is not null and rep <> leader").select(F.least("rep", "leader").alias("a"), F.greatest("rep", "leader").alias("b")))
        links.append(led.where("rep is null").select("leader", F.explode("near").alias("other")).distinct().select(F.least("leader", "other").alias("a"), F.greatest("leader", "other").alias("b")))
        settled = led.where("rep is not null and leader is not null").select("pivot", "leader", "rep")
        between.append(led.where("rep is not null and leader is not null").select("pivot", "leader", F.explode("near").alias("other"), "rep"))
        rest = led.where("rep is not null and leader is null")
        shell = rest.select("pivot", F.explode("near").alias("leader"), "rep")
        if not shell.isEmpty():
            links.append(_solved(_grid(settled, shell), sets, percent, "jaccard-shell"))
        left = written(rest.select("pivot", "rep").join(members, ["pivot", "rep"]).select(*members.columns), "jaccard-left")
    links.append(_solved(_grid(left), sets, percent, "jaccard-rest"))
    return _union(links + _between_leaders(between, links, sets, percent))


def _between_leaders(between: list[DataFrame], links: list[DataFrame], sets: DataFrame, percent: int) -> list[DataFrame]:
    """Links between texts that two leaders settled, which ``links`` leave apart; ``between`` has texts ``(pivot, leader, other, rep)`` near another leader.

    Of two such texts that link, each is near the leader of the other. Any one link connects the leaders, so cells of the
    diagonal, which send no text twice, go first; pairs of leaders that stay apart then meet in all other cells.
    """
    found: list[DataFrame] = []
    near = written(_union(between), "jaccard-between") if between else None
    for cells in ("i = j", "i <> j"):
        if near is None or near.isEmpty():
            break
        ids = components(_union(links + found))
        component = lambda c: ids.select(F.col("id").alias(c), F.col("component").alias(f"{c}_component"))
        pairs = near.select("leader", "other").distinct().join(component("leader"), "leader", "left").join(component("other"), "other", "left")
        apart = pairs.where("coalesce(leader_component, leader) <> coalesce(other_component, other)").select("leader", "other")
        near = written(near.join(apart, ["leader", "other"]), "jaccard-between")
        sides = [near.where(c).select("pivot", F.least("leader", "other").alias("leader"), F.greatest("leader", "other").alias("partner"), "rep") for c in ("leader < other", "leader > other")]
        found.append(_solved(_grid(*sides).where(cells), sets, percent, "jaccard-across"))
    return found


def _union(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.union(f)
    return out


def _whole_sets(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [shingle_hashes(words_of(t.as_py()), k).tobytes() for t in batch.column(2)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(sets, pa.binary())], names=["rep", "part", "hashes"])

    return run


def _sets_of(docs: DataFrame, ids: DataFrame, k: int, name: str, *, keep: bool = True) -> DataFrame:
    """``rep, part, hashes``: whole shingle sets of some documents, from their texts, for each of ``ids``, which is broadcast where it is small."""
    ids = ids if "part" in ids.columns else ids.select("rep", F.lit(None).cast("long").alias("part"))
    ids = written(ids.select("rep", "part").distinct(), name)
    few = ids.count() <= FEW
    picked = docs.join(F.broadcast(ids) if few else ids, docs["doc_id"] == ids["rep"]).select("rep", "part", "text")
    sets = picked.mapInArrow(freeing(_whole_sets(k)), "rep long, part long, hashes binary")
    return written(sets, f"{name}-sets") if keep else sets


def similar_groups(docs: DataFrame, *, shingle_words: int = 5, percent: int = 80, hot: int = HOT) -> DataFrame:
    """``doc_id, n_shingles, component_id, text_class`` of every row of a documents table.

    Two documents link when the Jaccard similarity of their sets of word shingles is at least
    ``percent`` hundredths, computed exactly; ``component_id`` is the smallest doc_id reachable.
    Equal word sequences form one class (``text_class``, its smallest doc_id) and are compared once.

    Texts shorter than a shingle are one shingle. Null, empty and blank texts have no shingles and
    link with nothing. Rows with a null doc_id come back with a null component and link nothing;
    they have a shingle count where a row with an id has the same words, else 0. doc_ids are taken
    for unique: of different texts under one doc_id, links of any count for it. Repeated rows are
    equal texts. An empty table gives no rows. Shingles are compared by 64-bit hashes.
    """
    docs = doc_texts(docs)
    keys = written(docs.mapInArrow(freeing(_keys), "doc_id long, cls binary"), "jaccard-keys")
    classes = written(keys.where("doc_id is not null and cls is not null").groupBy("cls").agg(F.min("doc_id").alias("doc_id")), "jaccard-classes")
    # Rows whose words another row with a smaller id has; all others are their class's representative.
    copies = keys.join(classes.withColumnRenamed("doc_id", "rep"), "cls").where("doc_id <> rep").groupBy("doc_id").agg(F.collect_set("cls").alias("dropped"))
    copies = written(copies, "jaccard-copies")
    few = copies.count() <= FEW
    picked = docs.where("doc_id is not null").join(F.broadcast(copies) if few else copies, "doc_id", "left").select("doc_id", "text", "dropped")
    sketch = "rep long, cls binary, n int, bits binary, low binary"
    reps = written(picked.mapInArrow(freeing(_sketches(shingle_words, percent)), sketch), "jaccard-sketches")
    if reps.count() > classes.count():  # repeated rows
        reps = written(reps.dropDuplicates(["rep", "cls"]), "jaccard-sketches")
    buckets = 1 + int((reps.agg(F.sum(F.length("low") / 8)).first()[0] or 0) // BUCKET)

    packed = "bucket int, hashes binary, reps binary, flags binary"
    meeting = "pivot long, rep long, shared long, hot boolean"
    met = written(reps.select("rep", "low").mapInArrow(freeing(_bucketed(buckets, hot)), packed).groupBy("bucket").applyInPandas(_meetings(hot), meeting), "jaccard-met")
    # Of the spare hashes that a sketch holds beyond its prefix, more than half are hot: crowded.
    least = lambda n: f"({n} - cast(ceil({percent} * {n} / 100.0) as int) + 1)"
    spare = lambda n: f"(least({n}, {least(n)} + cast(floor({least(n)} / 2) as int) + 4) - {least(n)})"
    sizes = reps.select("rep", "n")
    held = met.where("hot").groupBy("rep").agg(F.sum("shared").alias("h")).join(sizes, "rep")
    crowded = written(held.where(f"2 * h > {spare('n')}").select("rep"), "jaccard-crowded")
    plain = reps.join(F.broadcast(crowded) if crowded.count() <= FEW else crowded, "rep", "left_anti")

    # A link leaves at most the prefix without a partner, so at least half the spare hashes of the smaller text have one.
    # Texts that share fewer hashes with all others together link with none; few texts share that many by chance.
    # A text has at most as many rows here as its sketch has hashes, so a window over them holds no more.
    cold = met.where("not hot").join(plain.select("rep", "n"), "rep").withColumn("total", F.sum("shared").over(Window.partitionBy("rep")))
    smallest = f"cast(ceil({percent} * n / 100.0) as int)"
    apart = cold.where(f"2 * (total - 1) >= {spare(smallest)}").select("pivot", "rep", F.lit(False).alias("whole"), F.lit(False).alias("dense"))

    # Plain texts that link to a crowded one have all but a prefix of their sketch among the shingles of crowded texts; they join those.
    crowded_sets = _sets_of(docs, crowded, shingle_words, "jaccard-crowded-texts").select("rep", "hashes")
    marks = crowded_sets.mapInArrow(freeing(_distinct_bucketed(buckets)), packed)
    hits = plain.select("rep", "low").mapInArrow(freeing(_bucketed(buckets, hot)), packed).union(marks).groupBy("bucket").applyInPandas(_hits, "rep long, hits long")
    touched = hits.groupBy("rep").agg(F.sum("hits").alias("hits")).join(plain.select("rep", "n"), "rep").where(f"hits > {spare('n')}").select("rep")
    touched_sets = _sets_of(docs, touched, shingle_words, "jaccard-touched").select("rep", "hashes")
    sets = crowded_sets.union(touched_sets)

    # Among these, whole sets are counted: texts with a prefix of cold shingles (or a partner with one) meet by those.
    entries = sets.agg(F.sum(F.length("hashes") / 8)).first()[0] or 0
    close = written(sets.mapInArrow(freeing(_bucketed(1 + int(entries // BUCKET), hot)), packed).groupBy("bucket").applyInPandas(_meetings(hot), meeting), "jaccard-close")
    counted = close.where("hot").groupBy("rep").agg(F.sum("shared").alias("h")).join(sizes, "rep")
    dense = written(counted.where(f"n - h < {least('n')}").select("rep", (F.col("h") / F.col("n")).alias("close")), "jaccard-dense")
    whole = close.where("not hot").join(dense.select("rep", F.lit(True).alias("dense")), "rep", "left").select("pivot", "rep", F.lit(True).alias("whole"), F.coalesce("dense", F.lit(False)).alias("dense"))

    # Pivots go many to a call: a call for each would cost more than its trees.
    members = written(apart.union(whole).distinct(), "jaccard-members")
    members = members.withColumn("call", F.pmod(F.xxhash64("pivot", "whole"), F.lit(1 + members.count() // 2000)))
    signed = members.join(reps.select("rep", "n", "bits"), "rep")
    pairs = written(signed.groupBy("call").applyInPandas(_candidates(percent), "a long, b long").distinct(), "jaccard-pairs")
    # Pairs that hang together are verified together, so a set is sent once; only components of many pairs take several calls.
    reached = components(pairs)
    held = pairs.join(reached, pairs["a"] == reached["id"]).select("a", "b", "component")
    cells = held.groupBy("component").agg(F.ceil(F.count("*") / (4 * CELL)).alias("cells"))
    calls = F.lit(1 + pairs.count() // (2 * CELL))
    asked = written(held.join(cells, "component").select("a", "b", F.pmod(F.xxhash64("component", F.pmod(F.xxhash64("a"), F.col("cells"))), calls).alias("call")), "jaccard-asked")
    texts = asked.select(F.col("call").alias("part"), F.explode(F.array("a", "b")).alias("rep")).distinct()
    found = asked.groupBy("call").cogroup(_sets_of(docs, texts, shingle_words, "jaccard-asked-texts", keep=False).groupBy("part"))
    found = written(found.applyInPandas(_verify(percent), "a long, b long").distinct(), "jaccard-links")

    # Dense texts among themselves: all that share a hash of their prefix meet at the smallest. A bucket's entries are dealt out
    # in shares, each with the smallest texts of the bucket's hashes.
    lows = reps.join(dense, "rep").select("rep", F.substring("low", F.lit(1), F.expr(f"8 * {least('n')}")).alias("low"))
    dealt = written(lows.mapInArrow(freeing(_bucketed(buckets)), packed), "jaccard-dense-entries")
    shares = dealt.groupBy("bucket").agg(F.ceil(F.sum(F.length("hashes") / 8) / BUCKET).cast("int").alias("shares"))
    lowest = lows.mapInArrow(freeing(_lowest_bucketed(buckets)), packed).groupBy("bucket").applyInPandas(_pivots, "bucket int, hashes binary, reps binary")
    lowest = lowest.join(shares, "bucket").select("bucket", F.explode(F.sequence(F.lit(0), F.col("shares") - 1)).alias("share"), "hashes", "reps")
    shared = dealt.join(shares, "bucket").withColumn("share", F.pmod(F.xxhash64("reps"), F.col("shares")).cast("int")).drop("shares")
    together = shared.groupBy("bucket", "share").cogroup(lowest.groupBy("bucket", "share")).applyInPandas(_at_pivots, "pivot long, rep long, shared long")
    together = written(together.select("pivot", "rep").distinct().join(dense, "rep").select("pivot", "rep", "close"), "jaccard-together")
    links = found.union(_dense_links(together, sets, percent))

    ids = components(links)
    by_class = reps.select("cls", "rep", "n").join(ids, reps["rep"] == ids["id"], "left").select("cls", "n", F.col("rep").alias("text_class"), F.coalesce("component", "rep").alias("component_id"))
    out = keys.join(by_class, "cls", "left")
    own = lambda c: F.when(F.col("cls").isNull(), F.col("doc_id")).when(F.col("doc_id").isNotNull(), F.col(c))
    return out.select("doc_id", F.coalesce(F.col("n").cast("long"), F.lit(0).cast("long")).alias("n_shingles"), own("component_id").alias("component_id"), own("text_class").alias("text_class"))

