"""Merkle manifest of a dataset: a hash tree over all rows, and a proof for each row.

Rows are ranked within their group (a language) by a range shuffle. The digits of a rank, base 8, name the
way from a leaf to the root. Within blocks of 8**4 leaves the digit columns are grouped away one by one, each
time nesting the children as structs in their parent; all of it happens behind one shuffle by block. The roots of
blocks are the leaves of the next tier, until each group has one root; the groups' roots are a tree of their own.
Proofs come from above: nested children are exploded level by level, each with the hashes of its siblings, so no
leaf is ever joined. Only whole blocks, one row for 4,096 leaves, are joined to the way above them, where a group has
more than one.

Nulls are leaves' values like others, and a null group is a group. Equal keys are ordered by their leaf, equal rows are
leaves of their own. An empty table gives no rows. Other columns of the table are neither hashed nor returned.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from changeflow.llm.common import ascii_lower, written

#: Children of a node are 2**BITS; digits of a rank within a block.
BITS, DIGITS = 3, 4
FAN = 1 << BITS
#: The columns of a leaf, in their order.
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
#: Rows of ways to the root that may be broadcast, each of a few KB, and of offsets of ranks.
FEW_WAYS, FEW_OFFSETS = 10_000, 1_000_000


def hashed(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def leaf_hash(values: list[Column]) -> Column:
    """Lengths in bytes keep neighbouring values apart; a null is a dash."""
    texts = [v.cast("string") for v in values]
    return hashed(F.concat(*(F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts)))


def folded(leaf: Column, way: Column) -> Column:
    """The root that a leaf and its siblings lead to."""
    return F.aggregate(way, leaf, lambda h, step: hashed(F.concat(step["left"], h, step["right"])))


def proof(way: Column) -> Column:
    """Hashes of all siblings, from the leaf up and left to right, as one text."""
    return F.array_join(F.transform(way, lambda s: F.concat(s["left"], s["right"])), "")


def _ranked(nodes: DataFrame, name: str) -> DataFrame:
    """``nodes`` (``group, key, h, ...``) with ``rank`` within the group, by key and hash, and ``n``, the group's size."""
    spread = nodes.withColumn("_tie", F.monotonically_increasing_id())
    order = ["group", "key", "h", "_tie"]
    placed = spread.repartitionByRange(*order).sortWithinPartitions(*order).drop("_tie").withColumn("_at", F.monotonically_increasing_id())
    placed = written(placed, f"{name}-sorted").withColumn("_part", F.shiftright("_at", 33))
    parts = placed.groupBy("group", "_part").agg(F.min("_at").alias("_first"), F.count("*").alias("_here"))
    parts = written(parts, f"{name}-parts")
    before = F.sum("_here").over(Window.partitionBy("group").orderBy("_part")) - F.col("_here") - F.col("_first")
    sized = parts.select(F.col("group").alias("_g"), F.col("_part").alias("_p"), before.alias("_shift"), F.sum("_here").over(Window.partitionBy("group")).alias("n"))
    sized = F.broadcast(sized) if parts.count() <= FEW_OFFSETS else sized
    joined = placed.join(sized, F.col("group").eqNullSafe(F.col("_g")) & (F.col("_part") == F.col("_p")))
    return joined.select(*nodes.columns, (F.col("_at") + F.col("_shift")).alias("rank"), "n")


def _count(level: int) -> Column:
    """Nodes of the group at this level of a tier, of which ``n`` tells those at the lowest."""
    return F.shiftright(F.col("n") + (FAN**level - 1), BITS * level)


def _blocks(leaves: DataFrame, carried: list[str]) -> DataFrame:
    """``group, n, block, h, kids``: one row for a block, its nodes nested; a node without neighbours in its group goes up as it is."""
    digit = lambda k: F.shiftright("rank", BITS * k).bitwiseAND(FAN - 1).cast("int")
    block = F.shiftright("rank", BITS * DIGITS)
    rows = leaves.select("group", "n", block.alias("block"), *(digit(k).alias(f"d{k}") for k in range(DIGITS)), "h", *carried).repartition("group", "block")
    inner = carried
    for level in range(DIGITS):
        keys = ["group", "n", "block", *(f"d{k}" for k in reversed(range(level + 1, DIGITS)))]
        rows = rows.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct(f"d{level}", "h", *inner))).alias("kids"))
        up = F.when(_count(level) > 1, hashed(F.array_join(F.col("kids")["h"], ""))).otherwise(F.col("kids")[0]["h"])
        rows = rows.withColumn("h", up)
        inner = ["kids"]
    return rows


def _ways(blocks: DataFrame, above: DataFrame, carried: list[str], lead: list[str]) -> DataFrame:
    """``group, rank, leaf, way`` and what leaves carry, from blocks and ``(_g, _b, lead..., way)`` of their roots."""
    few = above.count() <= FEW_WAYS
    rows = blocks.join(F.broadcast(above) if few else above, F.col("group").eqNullSafe(F.col("_g")) & (F.col("block") == F.col("_b")))
    rows = rows.select("group", "n", F.col("block").alias("rank"), *lead, "way", "kids")
    for level in reversed(range(DIGITS)):
        rows = rows.select("group", "n", "rank", *lead, "way", F.col("kids")["h"].alias("_hs"), F.posexplode("kids").alias("_i", "_kid"))
        step = F.struct(F.array_join(F.slice("_hs", F.lit(1), F.col("_i")), "").alias("left"), F.array_join(F.slice("_hs", F.col("_i") + 2, F.lit(FAN)), "").alias("right"))
        way = F.when(_count(level) > 1, F.concat(F.array(step), F.col("way"))).otherwise(F.col("way"))
        rest = [F.col("_kid.kids").alias("kids")] if level else [F.col("_kid.h").alias("leaf"), *(F.col(f"_kid.{c}").alias(c) for c in carried)]
        rows = rows.select("group", "n", (F.col("rank") * FAN + F.col(f"_kid.d{level}")).alias("rank"), *lead, way.alias("way"), *rest)
    return rows


def _tree(ranked: DataFrame, carried: list[str], name: str) -> tuple[list[DataFrame], DataFrame]:
    """The tiers of blocks from the lowest up, and ``group, h`` of the roots."""
    tiers = [written(_blocks(ranked, carried), f"{name}-blocks")]
    while True:
        top = tiers[-1]
        roots = top.select("group", F.col("block").alias("rank"), _count(DIGITS).alias("n"), "h")
        if roots.where("n > 1").isEmpty():
            return tiers, roots.select("group", "h")
        tiers.append(written(_blocks(roots, []), f"{name}-blocks"))


def _paths(tiers: list[DataFrame], above: DataFrame, carried: list[str], lead: list[str]) -> DataFrame:
    """Ways of all leaves, from those of the roots: ``above`` has ``group, lead..., way``."""
    over = above.select(F.col("group").alias("_g"), F.lit(0).cast("long").alias("_b"), *lead, "way")
    for blocks in reversed(tiers[1:]):
        over = _ways(blocks, over, [], lead).select(F.col("group").alias("_g"), F.col("rank").alias("_b"), *lead, "way")
    return _ways(tiers[0], over, carried, lead)


def manifest(rows: DataFrame, *, group: str, key: str, leaf: Column, carry: dict[str, Column] | None = None) -> DataFrame:
    """``group, key, leaf, rank, subroot, root, way`` and what is carried, one row for each of ``rows``.

    ``way`` holds, from the leaf up to the root of all groups, the joined hashes to the left and to the right. What is
    carried travels with each leaf and isn't hashed; it has to be small and of a type with an order.
    """
    carry = carry or {}
    nodes = rows.select(F.col(group).alias("group"), F.col(key).alias("key"), leaf.alias("h"), *(v.alias(k) for k, v in carry.items()))
    kept = ["key", *carry]
    tiers, subroots = _tree(_ranked(written(nodes, "merkle-leaves"), "merkle"), kept, "merkle")
    groups = subroots.select(F.lit(0).alias("group"), F.col("group").alias("key"), "h")
    group_tiers, roots = _tree(_ranked(groups, "merkle-groups"), ["key"], "merkle-groups")
    top = roots.select("group", F.col("h").alias("root"), F.array().cast(WAY).alias("way"))
    above = _paths(group_tiers, top, ["key"], ["root"]).select(F.col("key").alias("group"), F.col("leaf").alias("subroot"), "root", "way")
    return _paths(tiers, above, kept, ["subroot", "root"]).select("group", "key", "leaf", "rank", "subroot", "root", "way", *carry)


WAY = T.ArrayType(T.StructType([T.StructField("left", T.StringType()), T.StructField("right", T.StringType())]))


def audited(docs: DataFrame) -> DataFrame:
    """``doc_id, leaf, subroot, root, proof_sha256, folded_root, verified`` of every document.

    Documents whose id has a CRC-32 that 3 divides are tampered with after the manifest was made: their text's A-Z are
    lower-cased. A document whose leaf differs is found out. A null doc_id has no CRC and is left alone.
    """
    text = lambda t: leaf_hash([t if c == "text" else F.col(c) for c in FIELDS])
    tampered = F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0, text(ascii_lower(F.col("text"))))
    found = manifest(docs, group="lang", key="doc_id", leaf=text(F.col("text")), carry={"tampered": tampered})
    again = folded(F.coalesce("tampered", "leaf"), F.col("way"))
    found = found.select(F.col("key").alias("doc_id"), "leaf", "subroot", "root", hashed(proof(F.col("way"))).alias("proof_sha256"), again.alias("folded_root"))
    return found.withColumn("verified", F.col("folded_root") == F.col("root"))


def oracle_sql() -> str:
    """The same in DuckDB's SQL: levels by recursion, CRC-32 bit by bit (DuckDB has none)."""
    cell = lambda c: f"coalesce(strlen({c}::varchar) || ':' || {c}::varchar, '-')"
    text_hash = lambda text: f"sha256({' || '.join(cell(text if c == 'text' else c) for c in FIELDS)})"
    step = "c"
    for _ in range(8):
        step = f"list_transform([{step}], lambda c: xor(c >> 1, CASE WHEN c & 1 = 1 THEN 3988292384::BIGINT ELSE 0::BIGINT END))[1]"
    crc = f"xor(list_reduce(list_transform(string_split(doc_id::varchar, ''), lambda x: ascii(x)::BIGINT), lambda a, b: list_transform([xor(a, b)], lambda c: {step})[1], 4294967295::BIGINT), 4294967295::BIGINT)"
    lower = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    sides = "coalesce(string_agg({t}.h, '' ORDER BY {t}.i) FILTER ({t}.i < {at}), '') AS l, coalesce(string_agg({t}.h, '' ORDER BY {t}.i) FILTER ({t}.i > {at}), '') AS r"
    return f"""
WITH RECURSIVE hashed AS (
  SELECT row_number() OVER () AS uid, doc_id, coalesce('=' || lang, '') AS g, {text_hash("text")} AS leaf,
    CASE WHEN {crc} % 3 = 0 THEN {text_hash(lower)} ELSE {text_hash("text")} END AS other
  FROM documents),
placed AS (SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i FROM hashed),
nodes AS (
  SELECT g, 0 AS lvl, i, leaf AS h, count(*) OVER (PARTITION BY g) AS n FROM placed
  UNION ALL
  SELECT g, lvl + 1, i // 8, string_agg_hash, n2 FROM (
    SELECT g, lvl, i // 8 AS i8, sha256(string_agg(h, '' ORDER BY i)) AS string_agg_hash, any_value((n + 7) // 8) AS n2, min(i) AS i
    FROM nodes WHERE n > 1 GROUP BY g, lvl, i // 8)),
subroots AS (SELECT g, h AS subroot, row_number() OVER (ORDER BY g) - 1 AS i, count(*) OVER () AS n FROM nodes WHERE n = 1),
tops AS (
  SELECT 0 AS lvl, i, subroot AS h, n FROM subroots
  UNION ALL
  SELECT lvl + 1, i8, hh, n2 FROM (
    SELECT lvl, i // 8 AS i8, sha256(string_agg(h, '' ORDER BY i)) AS hh, any_value((n + 7) // 8) AS n2 FROM tops WHERE n > 1 GROUP BY lvl, i // 8)),
own AS (
  SELECT p.uid, t.lvl AS step, {sides.format(t="t", at="(p.i >> (3 * t.lvl))")}
  FROM placed p JOIN nodes t ON t.g = p.g AND t.n > 1 AND t.i // 8 = p.i >> (3 * t.lvl + 3) GROUP BY p.uid, t.lvl, p.i),
group_way AS (
  SELECT s.g, t.lvl + 100 AS step, {sides.format(t="t", at="(s.i >> (3 * t.lvl))")}
  FROM subroots s JOIN tops t ON t.n > 1 AND t.i // 8 = s.i >> (3 * t.lvl + 3) GROUP BY s.g, t.lvl, s.i),
steps AS (SELECT uid, step, l, r FROM own UNION ALL SELECT p.uid, w.step, w.l, w.r FROM placed p JOIN group_way w ON w.g = p.g),
numbered AS (SELECT *, row_number() OVER (PARTITION BY uid ORDER BY step) AS k, count(*) OVER (PARTITION BY uid) AS last FROM steps),
folds AS (
  SELECT uid, 0 AS k, other AS h FROM placed
  UNION ALL
  SELECT f.uid, f.k + 1, sha256(w.l || f.h || w.r) FROM folds f JOIN numbered w ON w.uid = f.uid AND w.k = f.k + 1),
ends AS (SELECT uid, arg_max(h, k) AS folded_root FROM folds GROUP BY uid),
proofs AS (SELECT uid, string_agg(l || r, '' ORDER BY step) AS siblings FROM steps GROUP BY uid),
final AS (SELECT h AS root FROM tops WHERE n = 1)
SELECT p.doc_id, p.leaf, s.subroot, f.root, sha256(coalesce(q.siblings, '')) AS proof_sha256, e.folded_root, e.folded_root = f.root AS verified
FROM placed p JOIN subroots s ON s.g = p.g CROSS JOIN final f LEFT JOIN proofs q ON q.uid = p.uid LEFT JOIN ends e ON e.uid = p.uid
"""
