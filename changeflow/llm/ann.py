"""Nearest neighbours by cross-polytope hashing with multiprobe tables and exact reranking."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from changeflow.llm.common import written

#: Rows that may be broadcast.
FEW = 1_000_000
#: Rotations and probes of a table that ``fitted`` chooses from, and all buckets of one rotation.
HASHES, PROBES, ALL = (1, 2, 3), (1, 2, 4, 8, 16, 32, 64, 128, 256), 1 << 20


def _width(dim: int) -> int:
    """The next power of two, which the Hadamard transform needs."""
    return 1 << max(0, dim - 1).bit_length()


def hadamard(x: np.ndarray) -> np.ndarray:
    """Fast Walsh-Hadamard transform of each row, scaled to keep lengths."""
    rows, n = x.shape
    x, h = x.copy(), 1
    while h < n:
        pairs = x.reshape(rows, n // (2 * h), 2, h)
        x = np.concatenate([pairs[:, :, :1] + pairs[:, :, 1:], pairs[:, :, :1] - pairs[:, :, 1:]], axis=2).reshape(rows, n)
        h *= 2
    return x / np.sqrt(n)


def rotated(unit: np.ndarray, table: int, seed: int) -> np.ndarray:
    """Three rounds of random signs and Hadamard: a pseudo-random rotation, one for each table."""
    n = _width(unit.shape[1])
    x = np.zeros((len(unit), n))
    x[:, : unit.shape[1]] = unit
    signs = np.random.default_rng([seed, table, n]).choice([-1.0, 1.0], size=(3, n))
    for s in signs:
        x = hadamard(x * s)
    return x


def _scaled(vectors: np.ndarray) -> np.ndarray:
    """Unit vectors. Divided by the largest component first: squares of very large or small ones would overflow or vanish."""
    unit = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return unit / np.linalg.norm(unit, axis=1, keepdims=True)


def buckets(unit: np.ndarray, table: int, hashes: int, probes: int, seed: int) -> np.ndarray:
    """The ``probes`` nearest buckets of a table for each vector, nearest first; the first is its own.

    A bucket is one signed axis of each of ``hashes`` rotations: ``k`` stands for ``+axis k``, ``n + k`` for ``-axis k``. Nearness of
    axes is how much less they score than the nearest one; losses of the rotations add up as squares. Every beginning of a near
    bucket is near itself, so only ``probes`` of them go into the next rotation.
    """
    at, loss = np.zeros((len(unit), 1), np.int64), np.zeros((len(unit), 1))
    for j in range(hashes):
        x = rotated(unit, table * hashes + j, seed)
        score = np.concatenate([x, -x], axis=1)
        axes = np.argsort(-score, axis=1, kind="stable")[:, :probes]
        less = (score.max(axis=1, keepdims=True) - np.take_along_axis(score, axes, 1)) ** 2
        both = (loss[:, :, None] + less[:, None, :]).reshape(len(unit), -1)
        code = (at[:, :, None] * score.shape[1] + axes[:, None, :]).reshape(len(unit), -1)
        first = np.argsort(both, axis=1, kind="stable")[:, :probes]
        at, loss = np.take_along_axis(code, first, 1), np.take_along_axis(both, first, 1)
    return at


def usable(vector: Column) -> Column:
    """Not null, not empty, not zero, without null or non-finite components."""
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return vector.isNotNull() & (F.size(vector) > 0) & F.coalesce(fine, F.lit(False)) & F.exists(vector, lambda x: x != 0)


def _by_length(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(length, names, vectors) of a batch of (cls, vec), one for each length of vectors."""
    names, lists = np.array(batch.column(0).to_pylist(), dtype=object), batch.column(1)
    sizes = np.diff(lists.offsets.to_numpy())
    flat = lists.flatten().to_numpy()
    starts = np.concatenate([[0], np.cumsum(sizes)])
    for dim in np.unique(sizes):
        own = np.flatnonzero(sizes == dim)
        yield int(dim), names[own], np.stack([flat[starts[i] : starts[i] + dim] for i in own])


def _probes(tables: int, hashes: int, probes: int, seed: int):
    """(cls, vec) to (dim, table, bucket, cls, raw) rows, ``probes`` nearest buckets a table."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for dim, names, vectors in _by_length(batch):
                for s in range(0, len(names), 128):  # bounds the products of probes and axes
                    own, part = names[s : s + 128], vectors[s : s + 128]
                    unit, raw = _scaled(part), [v.tobytes() for v in part]
                    for t in range(tables):
                        near = buckets(unit, t, hashes, probes, seed)
                        k = near.shape[1]
                        yield pa.RecordBatch.from_arrays(
                            [
                                pa.array(np.full(len(own) * k, dim), pa.int32()), pa.array(np.full(len(own) * k, t), pa.int32()), pa.array(near.ravel(), pa.int64()),
                                pa.array(np.repeat(own, k), pa.string()), pa.array([b for b in raw for _ in range(k)], pa.binary()),
                            ],
                            names=["dim", "table", "bucket", "cls", "raw"],
                        )

    return run


def _exact(asked: list[tuple[str, np.ndarray]], keep: int):
    """(query_cls, cls, vec, score): the ``keep`` nearest of a task's vectors for each asked one, itself left out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: list[list[tuple[float, str, np.ndarray]]] = [[] for _ in asked]
        for batch in batches:
            for dim, names, vectors in _by_length(batch):
                for (name, q), mine in zip(asked, best, strict=True):
                    if len(q) == dim:
                        apart = distances(np.broadcast_to(q, vectors.shape), vectors)
                        apart[names == name] = np.inf
                        near = np.argsort(apart, kind="stable")[:keep]
                        mine += [(apart[i], names[i], vectors[i]) for i in near if np.isfinite(apart[i])]
                        mine.sort(key=lambda x: x[:2])
                        del mine[keep:]
        rows = [(asked[i][0], name, v, d) for i, mine in enumerate(best) for d, name, v in mine]
        columns = zip(*rows, strict=True) if rows else [()] * 4
        types = [pa.string(), pa.string(), pa.list_(pa.float64()), pa.float64()]
        yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, types, strict=True)], names=["query_cls", "cls", "vec", "score"])

    return run


def _judged(asked: dict[str, np.ndarray], others: list[np.ndarray], tables: int, seed: int):
    """(query_cls, near) to (hashes, probes, n_hit, n_near, n_met, n_rows, n_looked): how many of a query's true neighbours, and of the
    ``others``, each choice finds."""

    def first_found(q: np.ndarray, own: list[np.ndarray], hashes: int, most: int) -> np.ndarray:
        """The place among the query's probes at which each vector is first found in some table."""
        found = np.full(len(own[0]), 2**31)
        for t in range(tables):
            near = buckets(_scaled(q[None]), t, hashes, most, seed)[0]
            order = np.argsort(near)
            at = np.minimum(np.searchsorted(near[order], own[t]), len(near) - 1)
            found = np.where(near[order][at] == own[t], np.minimum(found, order[at]), found)
        return found

    def own(vectors: np.ndarray, hashes: int) -> list[np.ndarray]:
        return [buckets(_scaled(vectors), t, hashes, 1, seed)[:, 0] for t in range(tables)]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known: dict[tuple[int, int], list[np.ndarray]] = {}
        for pdf in batches:
            rows = []
            for name, near in zip(pdf["query_cls"], pdf["near"], strict=True):
                q, near = asked[name], np.stack(near)
                axes, alike = 2 * _width(len(q)), [o for o in others if len(o) == len(q)] or [q]
                for hashes in (h for h in HASHES if axes**h < 2**62):
                    if (len(q), hashes) not in known:
                        known[len(q), hashes] = own(np.stack(alike), hashes)
                    most = axes if hashes == 1 else min(axes**hashes, PROBES[-1])
                    hit, met = first_found(q, own(near, hashes), hashes, most), first_found(q, known[len(q), hashes], hashes, most)
                    for probes in (*PROBES, ALL) if hashes == 1 else PROBES:
                        rows.append((hashes, probes, int((hit < probes).sum()), len(hit), int((met < probes).sum()), len(met), min(probes, axes**hashes)))
            yield pd.DataFrame(rows, columns=["hashes", "probes", "n_hit", "n_near", "n_met", "n_rows", "n_looked"])

    return run


def fitted(classes: DataFrame, queries: DataFrame, *, k: int, tables: int, recall: float, seed: int, sample: int = 64) -> tuple[int, int]:
    """(hashes, probes) with the fewest expected candidates that reach ``recall`` on a sample of ``sample`` queries.

    The sample's true neighbours come from one pass over all vectors; whether a pair meets depends on its two vectors alone, so every
    choice is judged without an index. Candidates are estimated on ``8 * sample`` rows. The driver holds these two samples and a row for
    each choice. One hash with all its buckets probed finds everything, so some choice always reaches ``recall``.
    """
    asked = {r.cls: np.array(r.vec) for r in queries.orderBy(F.xxhash64("cls"), "cls").limit(sample).collect()}
    others = [np.array(r.vec) for r in classes.orderBy(F.xxhash64("cls", F.lit(1)), "cls").limit(8 * sample).collect()]
    by_nearness = Window.partitionBy("query_cls").orderBy("score", "cls")
    exact = classes.select("cls", "vec").mapInArrow(_exact(list(asked.items()), k), "query_cls string, cls string, vec array<double>, score double")
    near = exact.withColumn("at", F.row_number().over(by_nearness)).where(F.col("at") <= k).groupBy("query_cls").agg(F.collect_list("vec").alias("near"))
    shape = "hashes int, probes int, n_hit long, n_near long, n_met long, n_rows long, n_looked long"
    choices = near.mapInPandas(_judged(asked, others, tables, seed), shape).groupBy("hashes", "probes")
    sums = choices.agg(F.sum("n_hit").alias("hit"), F.sum("n_near").alias("near"), F.sum("n_met").alias("met"), F.sum("n_rows").alias("rows"), F.max("n_looked").alias("looked"))
    n = classes.count()
    good = [(r.met / r.rows * n + r.looked * tables, r.hashes, r.probes) for r in sums.collect() if r.hit >= recall * r.near]
    return min(good)[1:] if good else (1, 1)


def distances(q: np.ndarray, v: np.ndarray) -> np.ndarray:
    """Euclidean distances of two stacks of vectors row by row, in double precision; scaled where squares would overflow or vanish."""
    apart = q - v
    most = np.abs(apart).max(axis=1, initial=0)
    odd = (most > 0) & ((most > 1e150) | (most < 1e-150)) & np.isfinite(most)
    scale = np.where(odd, most, 1.0)
    return scale * np.sqrt(((apart / scale[:, None]) ** 2).sum(axis=1))


def _rerank(keep: int):
    """The ``keep`` nearest of a cell's vectors for each of its queries, ties at the last place kept."""

    def run(queries: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        if queries.empty or rows.empty:
            return pd.DataFrame({"query_cls": [], "cls": [], "score": []})
        q = np.stack([np.frombuffer(b) for b in queries["raw"]])
        v = np.stack([np.frombuffer(b) for b in rows["raw"]])
        # By the cell's largest component, so that no square overflows; what is small beside it then ties and is compared exactly.
        scale = max(np.abs(q).max(), np.abs(v).max())
        a, b = q / scale, v / scale
        near = (a**2).sum(1)[:, None] + (b**2).sum(1)[None] - 2 * a @ b.T
        k = min(keep, len(v)) - 1
        slack = 4e-9
        at, to = np.nonzero(near <= np.partition(near, k, axis=1)[:, k : k + 1] + slack)
        return pd.DataFrame({"query_cls": queries["cls"].to_numpy()[at], "cls": rows["cls"].to_numpy()[to], "score": distances(q[at], v[to])})

    return run


def nearest(rows: DataFrame, is_query: Column, *, k: int = 10, id_col: str = "vec_id", vector_col: str = "embedding", tables: int = 8, hashes: int | None = None, probes: int | None = None,
            recall: float = 0.96, seed: int = 20, cell_rows: int = 4096, cell_queries: int = 1024) -> DataFrame:
    """The ``k`` nearest rows of each query row: ``query_id, rank, vec_id, score`` (Euclidean).

    Every usable row is hashed into one bucket of each of ``tables`` tables; a query looks into its
    ``probes`` nearest buckets of each. Candidates are reranked exactly on the original vectors.
    A bucket is an axis of each of ``hashes`` rotations, so there are more of them with more hashes.
    Without ``hashes`` and ``probes`` both are ``fitted`` to the vectors, for ``recall``.

    Equal vectors are hashed and compared once: a class keeps its ``k + 1`` smallest ids, which is
    all that any query can return of it, so copies cost nothing and lose nothing. Buckets are cut
    into cells of about ``cell_rows`` rows and ``cell_queries`` queries, so a hot bucket spreads over tasks.

    Rows with a null id, or a vector that is null, empty, zero or holds null or non-finite
    components take no part. Repeated rows count once. A row never finds its own id. Vectors are
    compared with those of the same length only. Ties go to the smaller id. Fewer than ``k``
    candidates give all. An empty table gives no rows.
    """
    vector = F.col(vector_col).cast("array<double>")
    flags = rows.select(F.col(id_col).cast("long").alias("id"), vector.alias("vec"), F.coalesce(is_query, F.lit(False)).alias("asked"))
    clean = flags.where(F.col("id").isNotNull() & usable(F.col("vec")))
    # Adding zero makes -0.0 into 0.0, so that equal vectors are equal as keys.
    clean = clean.withColumn("vec", F.transform("vec", lambda x: x + F.lit(0.0))).distinct()
    smallest = clean.withColumn("at", F.row_number().over(Window.partitionBy("vec").orderBy("id"))).where(F.col("at") <= k + 1)
    classes = smallest.groupBy("vec").agg(F.array_sort(F.collect_list("id")).alias("ids"))
    classes = written(classes.withColumn("cls", F.concat_ws(":", F.col("ids")[0], F.xxhash64("vec"))), "ann-classes")
    asked = written(clean.where("asked").join(classes, "vec").select("id", "cls"), "ann-queries")
    query_vectors = classes.join(asked.select("cls").distinct(), "cls", "left_semi").select("cls", "vec")

    if hashes is None and probes is None:
        hashes, probes = fitted(classes, query_vectors, k=k, tables=tables, recall=recall, seed=seed)
    hashes, probes = hashes or 1, probes or 1

    bucket = ["dim", "table", "bucket"]
    shape = "dim int, table int, bucket long, cls string, raw binary"
    index = classes.select("cls", "vec").mapInArrow(_probes(tables, hashes, 1, seed), shape)
    look = query_vectors.mapInArrow(_probes(tables, hashes, probes, seed), shape)
    # One row for each bucket that has rows and queries.
    n_rows = index.groupBy(bucket).agg(F.count("*").alias("n_rows"))
    n_queries = look.groupBy(bucket).agg(F.count("*").alias("n_queries"))
    cuts = n_rows.join(n_queries, bucket).selectExpr(*bucket, f"cast(ceil(n_rows / {cell_rows}) as int) as row_cells", f"cast(ceil(n_queries / {cell_queries}) as int) as query_cells")
    cuts = written(cuts, "ann-cuts")
    cuts = F.broadcast(cuts) if cuts.count() <= FEW else cuts
    own = lambda cells, salt: F.pmod(F.xxhash64("cls", F.lit(salt)), F.col(cells)).cast("int")
    left = look.join(cuts, bucket).withColumn("query_cell", own("query_cells", 1)).withColumn("row_cell", F.explode(F.sequence(F.lit(0), F.col("row_cells") - 1)))
    right = index.join(cuts, bucket).withColumn("row_cell", own("row_cells", 2)).withColumn("query_cell", F.explode(F.sequence(F.lit(0), F.col("query_cells") - 1)))
    cell = [*bucket, "row_cell", "query_cell"]
    found = left.select(*cell, "cls", "raw").groupBy(cell).cogroup(right.select(*cell, "cls", "raw").groupBy(cell)).applyInPandas(_rerank(k + 1), "query_cls string, cls string, score double")

    # k + 1 nearest classes hold the k + 1 nearest rows, and one of those may be the query itself.
    best = found.groupBy("query_cls", "cls").agg(F.min("score").alias("score")).join(classes.select("cls", "ids"), "cls")
    by_nearness = Window.partitionBy("query_cls").orderBy("score", F.col("ids")[0])
    best = best.withColumn("at", F.row_number().over(by_nearness)).where(F.col("at") <= k + 1)
    flat = best.select("query_cls", "score", F.explode("ids").alias("vec_id"))
    lists = flat.groupBy("query_cls").agg(F.slice(F.array_sort(F.collect_list(F.struct("score", "vec_id"))), 1, k + 1).alias("near"))
    mine = asked.join(lists, asked["cls"] == lists["query_cls"])
    others = F.slice(F.filter("near", lambda x: x["vec_id"] != F.col("id")), 1, k)
    return mine.select(F.col("id").alias("query_id"), F.posexplode(others).alias("at", "hit")).select(
        "query_id", (F.col("at") + 1).cast("int").alias("rank"), F.col("hit.vec_id").alias("vec_id"), F.col("hit.score").alias("score")
    )
