"""Near duplicates by SimHash fingerprints, found with vantage-point trees.

1. A text's fingerprint has the bits that most of its shingle hashes have. Equal fingerprints are one point from here on.
2. Points are partitioned by their Hamming distance to vantage points. A node of a tree has a vantage point and a radius;
   points within it go inside, others outside. A point near the border is sent to the other side as a visitor, since a
   partner of it may live there: by the triangle inequality distances of partners to one vantage point differ by no more
   than they differ from each other, so all other branches are pruned. Spark splits oversized shards by five levels a round,
   with trees fitted on bounded samples of each; what a tree is fitted on affects the balance only.
3. Within a shard the same trees go on in memory down to a few points, which are compared. Only a spanning forest of
   the links of a shard is kept, never all pairs; components are found by rounds of joins.

There is a tree for each half of the bits (``PARTS``), which measures distances on that half alone: two fingerprints that
differ in ``bits`` places differ in at most half as many within one of the halves, so borders are half as wide.
Shards that a half can't split (all points alike on it) are split by whole distances.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from changeflow.llm.common import doc_texts, written
from changeflow.llm.components import components

SEED = 42
#: Bytes of a text whose words are in memory at once.
PIECE = 1 << 20
#: Points that a shard is home to, visitors of one cell of it, points of a sample, levels of a round and rounds.
HOMES, VISITORS, SAMPLE, LEVELS, ROUNDS = 8192, 262_144, 2048, 5, 12
PARTS, WIDTH = 2, 64
#: Points that are compared with each other, not split any more.
LEAF = 96
#: Rows of shards, trees and points that may be broadcast.
FEW, FEW_TREES = 1_000_000, 50_000


def _pieces(data: bytes, size: int) -> Iterator[list[bytes]]:
    """Words of the text, in pieces that end at white space."""
    at = 0
    while at < len(data):
        end = at + size
        while end < len(data) and not data[end : end + 1].isspace():
            end += 1
        yield data[at:end].split()
        at = end


def fingerprint(text: str, k: int, piece: int = PIECE) -> int:
    """The 64 bits that are set in over half of the XXH64 of all ``k``-word shingles; 0 without words."""
    counts, n, tail, seen = np.zeros(WIDTH, np.int64), 0, [], False
    for words in _pieces(text.encode("utf-8", "surrogatepass").lower(), piece):
        words = tail + words
        if len(words) < k:
            tail = words
            continue
        data = b" ".join(words)
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
        starts = np.concatenate(([0], ends[:-1]))[: len(words) - k + 1].tolist()
        digest = xxhash.xxh64_intdigest
        hashes = np.fromiter((digest(data[a:b], SEED) for a, b in zip(starts, (ends[k - 1 :] - 1).tolist(), strict=True)), "<u8", len(starts))
        for part in range(0, len(hashes), 1 << 16):
            counts += np.unpackbits(hashes[part : part + (1 << 16), None].view(np.uint8), axis=1, bitorder="little").sum(0, dtype=np.int64)
        n, seen, tail = n + len(hashes), True, words[len(words) - k + 1 :]
    if not seen:
        return xxhash.xxh64_intdigest(b" ".join(tail), SEED) if tail else 0
    return int(np.packbits(2 * counts > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, *, shingle_words: int = 3) -> DataFrame:
    """``doc_id, fp``: fingerprints as signed longs. A null text has no words."""

    def batch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            values = np.array([fingerprint(t.as_py(), shingle_words) for t in b.column("text")], np.uint64)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(values.view(np.int64))], ["doc_id", "fp"])

    return doc_texts(docs).mapInArrow(batch, "doc_id long, fp long")


# --- Trees ---------------------------------------------------------------------------------------------------------


def part_masks(parts: int = PARTS) -> list[int]:
    """Neighbouring bits, equally many in each part, as signed longs."""
    cuts = [WIDTH * p // parts for p in range(parts + 1)]
    return [int(np.array(((1 << (b - a)) - 1) << a, np.uint64).view(np.int64)) for a, b in zip(cuts, cuts[1:], strict=False)]


def distances(points: np.ndarray, vantage: np.int64, mask: int) -> np.ndarray:
    # Of unsigned numbers: numpy counts the bits of a negative one's absolute value.
    return np.bitwise_count(((points ^ vantage) & np.int64(mask)).view(np.uint64)).astype(np.int16)


def choose(points: np.ndarray, mask: int, radius: int) -> tuple[int, int]:
    """A vantage point among the points, and a radius that halves them about, with few points at the border."""
    best = (2.0, int(points[0]), WIDTH)
    for at in range(0, len(points), max(1, len(points) // 6)):
        count = np.bincount(distances(points, points[at], mask), minlength=WIDTH + 1)
        inside = np.cumsum(count) / len(points)
        for cut in range(WIDTH):
            if 0.25 <= inside[cut] <= 0.75:
                border = count[max(0, cut + 1 - radius) : cut + 1 + radius].sum() / len(points)
                cost = border + abs(inside[cut] - 0.5)
                if cost < best[0]:
                    best = (cost, int(points[at]), cut)
        if best[0] == 2.0:  # no balanced cut yet: any that splits
            there = np.flatnonzero((inside > 0) & (inside < 1))
            if len(there):
                cut = int(there[np.argmin(np.abs(inside[there] - 0.5))])
                best = (1.99, int(points[at]), cut)
    return best[1], best[2]


def fit(points: np.ndarray, mask: int, radius: int, levels: int = LEVELS) -> tuple[list[int], list[int], int]:
    """Vantage points and radii of a tree in breadth-first order, and the points of its largest leaf."""
    vantages, cuts, level = [], [], [np.sort(points)]
    for _ in range(levels):
        below = []
        for p in level:
            v, cut = choose(p, mask, radius) if len(p) > 1 else (0, WIDTH)
            vantages.append(v)
            cuts.append(cut)
            inside = distances(p, np.int64(v), mask) <= cut
            below += [p[inside], p[~inside]]
        level = below
    return vantages, cuts, max(map(len, level))


def _trees(rows: DataFrame, big: DataFrame, parts: int, bits: int, levels: int) -> DataFrame:
    """``part, shard, mask, radius, vantages, cuts`` of oversized shards, each fitted on a sample of its homes."""
    masks = part_masks(parts)

    def tree(frame: pd.DataFrame) -> pd.DataFrame:
        part, shard = int(frame["part"].iat[0]), int(frame["shard"].iat[0])
        points = np.unique(frame["fp"].to_numpy(np.int64))
        mask, radius = masks[part], bits // parts
        vantages, cuts, largest = fit(points, mask, radius, levels)
        if 2 * largest > len(points):
            mask, radius = -1, bits
            vantages, cuts, _ = fit(points, mask, radius, levels)
        return pd.DataFrame({"part": [part], "shard": [shard], "mask": [mask], "radius": [radius], "vantages": [vantages], "cuts": [cuts]})

    share = F.least(F.lit(1.0), F.lit(float(SAMPLE)) / F.col("homes")) * 1_000_000
    sample = rows.where("home").join(_small(big), ["part", "shard"]).where(F.pmod(F.xxhash64("fp", "shard"), F.lit(1_000_000)) < share)
    fitted = sample.select("part", "shard", "fp").groupBy("part", "shard").applyInPandas(tree, "part int, shard long, mask long, radius int, vantages array<long>, cuts array<int>")
    return written(fitted, "simhash-trees")


def _small(rows: DataFrame, few: int = FEW) -> DataFrame:
    return F.broadcast(rows) if rows.count() <= few else rows


def _split(rows: DataFrame, trees: DataFrame, levels: int) -> DataFrame:
    """``part, shard, fp, home`` one round down: homes on their side, and visitors wherever a partner may be."""
    at = rows.join(_small(trees, FEW_TREES), ["part", "shard"]).withColumn("node", F.lit(0))
    go = lambda k, home: F.struct((F.col("node") * 2 + k).alias("node"), home.alias("home"))
    for _ in range(levels):
        d = F.bit_count(F.col("fp").bitwiseXOR(F.get("vantages", F.col("node"))).bitwiseAND(F.col("mask")))
        at = at.select("part", "shard", "fp", "home", "mask", "radius", "vantages", "cuts", "node", d.alias("d"), F.get("cuts", F.col("node")).alias("cut"))
        inside, far, near = F.col("d") <= F.col("cut"), F.col("d") + F.col("radius") > F.col("cut"), F.col("d") - F.col("radius") <= F.col("cut")
        yes, no = F.lit(True), F.lit(False)
        # Of two homes that part here only the inner one travels.
        home = F.when(inside & far, F.array(go(1, yes), go(2, no))).when(inside, F.array(go(1, yes))).otherwise(F.array(go(2, yes)))
        visitor = F.when(near & far, F.array(go(1, no), go(2, no))).when(near, F.array(go(1, no))).otherwise(F.array(go(2, no)))
        at = at.select("part", "shard", "fp", "mask", "radius", "vantages", "cuts", F.explode(F.when(F.col("home"), home).otherwise(visitor)).alias("to"))
        at = at.select("part", "shard", "fp", "mask", "radius", "vantages", "cuts", "to.node", "to.home")
    return at.select("part", (F.col("shard") * 2**levels + F.col("node") - (2**levels - 1)).alias("shard"), "fp", "home")


# --- Links within a shard ------------------------------------------------------------------------------------------


class Forest:
    """Union-find over positions."""

    def __init__(self, n: int) -> None:
        self.parent = np.arange(n)

    def roots(self, of: np.ndarray) -> np.ndarray:
        while True:
            up = self.parent[of]
            if (up == of).all():
                return of
            self.parent[of] = self.parent[up]
            of = up

    def join(self, of: np.ndarray) -> None:
        roots = np.unique(self.roots(of))
        self.parent[roots] = roots[0]


def forest(homes: np.ndarray, visitors: np.ndarray, mask: int, radius: int, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Links (as a spanning forest) of homes with each other and with visitors: at most ``bits`` bits apart."""
    points = np.concatenate([homes, visitors])
    found = Forest(len(points))
    todo = [(np.arange(len(homes)), np.arange(len(homes), len(points)))]
    while todo:
        h, v = todo.pop()
        if not len(h) or len(h) + len(v) < 2:
            continue
        halves = []
        if len(h) > LEAF:
            vantage, cut = choose(points[h], mask, radius)
            d, e = distances(points[h], np.int64(vantage), mask), distances(points[v], np.int64(vantage), mask)
            inner, travels = d <= cut, (d <= cut) & (d + radius > cut)
            halves = [(h[inner], v[e - radius <= cut]), (h[~inner], np.concatenate([v[e + radius > cut], h[travels]]))]
            if max(len(x) for x, _ in halves) == len(h):
                halves = []
        if halves:
            todo += halves
            continue
        for others in (h, v):
            for start in range(0, len(others), 1 << 15):
                these = others[start : start + (1 << 15)]
                for block in range(0, len(h), LEAF):
                    mine = h[block : block + LEAF]
                    near = np.bitwise_count((points[mine][:, None] ^ points[these][None, :]).view(np.uint64)) <= bits
                    for row in np.flatnonzero(near.any(1)):
                        found.join(np.append(these[near[row]], mine[row]))
    root = found.roots(np.arange(len(points)))
    linked = np.flatnonzero(root != np.arange(len(points)))
    return points[linked], points[root[linked]]


def links(points: DataFrame, *, bits: int = 2, parts: int = PARTS, homes: int | None = None, visitors: int | None = None, levels: int = LEVELS) -> DataFrame:
    """``a, b``: links of distinct fingerprints ``fp`` that join the same components as all pairs at most ``bits`` bits apart."""
    homes, visitors, masks = homes or HOMES, visitors or VISITORS, part_masks(parts)
    rows = points.select(F.explode(F.array(*(F.lit(p) for p in range(parts)))).alias("part"), F.lit(0).cast("long").alias("shard"), "fp", F.lit(True).alias("home"))
    done = []
    for _ in range(ROUNDS):
        sizes = rows.groupBy("part", "shard").agg(F.count_if("home").alias("homes"))
        big = written(sizes.where(F.col("homes") > homes), "simhash-big")
        if big.isEmpty():
            break
        done.append(rows.join(_small(big), ["part", "shard"], "left_anti"))
        rows = written(_split(rows, _trees(rows, big, parts, bits, levels), levels), "simhash-shards")
    done.append(rows)
    # Shards of one round have numbers of their own.
    placed = done[0].withColumn("round", F.lit(0))
    for k, more in enumerate(done[1:], 1):
        placed = placed.unionByName(more.withColumn("round", F.lit(k)))
    keys = ["round", "part", "shard"]
    sizes = placed.groupBy(*keys).agg(F.count_if("home").alias("_homes"), F.count_if(~F.col("home")).alias("_visitors"))
    sizes = written(sizes.where("_homes > 0 and _homes + _visitors > 1").select(*keys, F.greatest(F.lit(1), F.ceil(F.col("_visitors") / visitors)).cast("int").alias("_cells")), "simhash-sizes")
    # Many visitors are dealt to cells; each cell has all homes of its shard.
    own = F.when(F.col("home"), F.sequence(F.lit(0), F.col("_cells") - 1)).otherwise(F.array(F.pmod(F.xxhash64("fp"), F.col("_cells")).cast("int")))
    celled = placed.join(_small(sizes), keys).select(*keys, F.explode(own).alias("cell"), "fp", "home")

    def search(frame: pd.DataFrame) -> pd.DataFrame:
        here, home = frame["fp"].to_numpy(np.int64), frame["home"].to_numpy(bool)
        a, b = forest(np.sort(here[home]), np.sort(here[~home]), masks[int(frame["part"].iat[0])], bits // parts, bits)
        return pd.DataFrame({"a": a, "b": b})

    return celled.groupBy(*keys, "cell").applyInPandas(search, "a long, b long")


def near_duplicates(docs: DataFrame, *, shingle_words: int = 3, bits: int = 2) -> DataFrame:
    """``doc_id, fingerprint`` (16 hex digits), ``component_id``: the smallest doc_id that links of at most ``bits`` bits reach.

    Every row gives a row, repeated ones too. A null text, an empty one and one of white space have fingerprint 0 and are linked
    like others. A null doc_id is no smallest id: only rows without any other have a null component_id. Other columns are ignored.
    """
    prints = written(fingerprints(docs, shingle_words=shingle_words), "simhash-prints")
    points = written(prints.groupBy("fp").agg(F.min("doc_id").alias("low"), F.count("*").alias("n")), "simhash-points")
    linked = written(components(links(points.select("fp"), bits=bits)), "simhash-components")
    named = points.join(linked, F.col("fp") == F.col("id"), "left").select("fp", "low", "n", F.coalesce("component", "fp").alias("component"), F.col("id").isNotNull().alias("linked"))
    lows = named.where("linked").groupBy("component").agg(F.min("low").alias("_low"))
    # Only points with company need a look at their component.
    ids = named.where("linked").join(lows, "component").select("fp", F.col("_low").alias("_component"))
    ids = written(ids.unionByName(named.where("not linked and n > 1").select("fp", F.col("low").alias("_component"))), "simhash-ids")
    rows = prints.join(_small(ids), "fp", "left")
    return rows.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), F.coalesce("_component", "doc_id").alias("component_id"))
