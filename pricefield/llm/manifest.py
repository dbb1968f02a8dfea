"""Merkle manifest of a dataset: hash trees per group, a proof per row, and the check of changed rows."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import join_key, settle, table

#: Levels of a tree are folded several at a time, as many as fit in this number of slot columns.
SLOTS = 8


def digest(*parts: Column) -> Column:
    """SHA-256 of the parts put together, as lower-case hex; null parts count as empty."""
    return F.sha2(F.concat_ws("", *parts), 256)


def field(value: Column) -> Column:
    """A value with its length in UTF-8 bytes before it, `-` for null: two rows cannot give one text."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(*values: Column) -> Column:
    return digest(*[field(v) for v in values])


def placed(nodes: DataFrame, *order: str) -> DataFrame:
    """Append `pos` (from 0 in the order of `order` inside each tree) and `n` (nodes of the tree).

    Nodes are dealt out by ranges of (tree, order), so a tree that holds most of them is spread; each part
    is numbered on its own and only the counts per tree and part meet in a window. The parts are written
    with their number, so a task that is run again finds the same parts.
    """
    parts = nodes.repartitionByRange("tree", *order).withColumn("part", F.spark_partition_id())
    parts = settle(parts, "tree-parts")
    counts = parts.groupBy("tree", "part").agg(F.count("*").alias("rows"))
    before = F.sum("rows").over(Window.partitionBy("tree").orderBy("part")) - F.col("rows")
    counts = counts.select("tree", "part", before.alias("before"), F.sum("rows").over(Window.partitionBy("tree")).alias("n"))
    inside = F.row_number().over(Window.partitionBy("tree", "part").orderBy(*order))
    rows = parts.withColumn("inside", inside).join(counts, ["tree", "part"])
    return rows.withColumn("pos", F.col("before") + F.col("inside") - 1).drop("part", "inside", "before")


def nodes_left(n: Column, fanout: int, levels: int) -> Column:
    """Nodes of a tree of n leaves after so many levels."""
    width = fanout**levels
    return F.floor((n + (width - 1)) / F.lit(width))


class Fold:
    """Several levels of all trees at once, from one row of slot columns per block of consecutive nodes.

    Conditional aggregates spread the nodes of a block into columns s0, s1, ...; `d<level>_<k>` is the k-th
    node of a level above them. A node is the hash of its children's columns put together, one after another.
    """

    def __init__(self, nodes: DataFrame, fanout: int, carried: list[str]):
        self.fanout = fanout
        self.levels = max(1, int(math.log(SLOTS, fanout) + 1e-9))
        self.width = fanout**self.levels
        self.carried = carried
        slot = F.pmod("pos", F.lit(self.width))
        keep = F.struct("node", *carried)
        slots = [F.max(F.when(slot == i, keep)).alias(f"s{i}") for i in range(self.width)]
        rows = nodes.groupBy("tree", "n", F.floor(F.col("pos") / self.width).alias("block")).agg(*slots)
        rows = rows.withColumns({f"d0_{i}": F.col(f"s{i}.node") for i in range(self.width)})
        for level in range(self.levels):
            below = self.width // fanout**level
            rows = rows.withColumns({f"d{level + 1}_{k}": self._parent(level, k) for k in range(below // fanout)})
        self.rows = settle(rows, "tree-fold")

    def _children(self, level: int, parent: int) -> list[Column]:
        return [F.col(f"d{level}_{parent * self.fanout + i}") for i in range(self.fanout)]

    def _several(self, level: int) -> Column:
        return nodes_left(F.col("n"), self.fanout, level) > 1

    def _parent(self, level: int, parent: int) -> Column:
        children = self._children(level, parent)
        return F.when(self._several(level) & children[0].isNotNull(), digest(*children)).otherwise(children[0])

    def above(self) -> DataFrame:
        """The nodes above all blocks: (tree, n, pos, node); a tree with one node is finished."""
        left = nodes_left(F.col("n"), self.fanout, self.levels)
        return self.rows.select("tree", left.alias("n"), F.col("block").alias("pos"), F.col(f"d{self.levels}_0").alias("node"))

    def _siblings(self, slot: Column) -> Column:
        """Per level the hashes before and behind the own slot's column, left out itself."""
        steps = []
        for level in range(self.levels):
            columns = F.array(*[F.col(f"d{level}_{k}") for k in range(self.width // self.fanout**level)])
            at = F.floor(slot / self.fanout**level).cast("int")
            first = at - F.pmod(at, F.lit(self.fanout))
            before = F.slice(columns, first + 1, at - first)
            behind = F.slice(columns, at + 2, first + (self.fanout - 1) - at)
            step = F.struct(F.array_join(before, "").alias("before"), F.array_join(behind, "").alias("behind"))
            steps.append(F.when(self._several(level), step))
        return F.array_compact(F.array(*steps))

    def down(self, upper: DataFrame) -> DataFrame:
        """upper(tree, pos, path, subroot) of the nodes above the blocks to (tree, pos, node, path, subroot) of the blocks' nodes."""
        upper = upper.select("tree", F.col("pos").alias("block"), "path", "subroot")
        slots = F.posexplode(F.array(*[F.col(f"s{i}") for i in range(self.width)])).alias("slot", "s")
        rows = self.rows.join(upper, ["tree", "block"]).select("*", slots).where("s IS NOT NULL")
        path = F.concat(self._siblings(F.col("slot")), "path").alias("path")
        return rows.select("tree", (F.col("block") * self.width + F.col("slot")).alias("pos"), "s.*", path, "subroot")


def grow(nodes: DataFrame, fanout: int, carried: list[str]) -> tuple[list[Fold], DataFrame]:
    """Fold nodes(tree, n, pos, node) until every tree has one node; the folds and the roots (tree, node)."""
    height = nodes.agg(F.max("n")).first()[0] or 1
    folds: list[Fold] = []
    done = 1
    while done < height or not folds:
        folds.append(Fold(nodes, fanout, carried if not folds else []))
        nodes = folds[-1].above()
        done *= folds[-1].width
    return folds, nodes.select("tree", "node")


def descend(folds: list[Fold], upper: DataFrame) -> DataFrame:
    for i, fold in enumerate(reversed(folds)):
        upper = fold.down(upper)
        if i + 1 < len(folds):
            upper = settle(upper.select("tree", "pos", "path", "subroot"), "tree-paths")
    return upper


def refold(start: Column, path: Column) -> Column:
    """The root that a leaf and its siblings give."""
    return F.aggregate(path, start, lambda node, step: digest(step["before"], node, step["behind"]))


def manifest(rows: DataFrame, leaf: Column, group: Column, order: Column, changed: Column | None = None, fanout: int = 2) -> DataFrame:
    """Per row: `id` (the order column), leaf, subroot, root, `path` (its siblings, from the leaf to the root),
    proof_sha256, folded_root and verified.

    The rows of a group are the leaves of its tree, by `order`; every `fanout` consecutive nodes become the
    hash of their hashes put together (the last run may have fewer, even one) until one is left, the group's
    subroot. The subroots, ordered by group, form the root in the same way. `changed` is the leaf that is
    checked against the manifest, by default the row's own; folded_root is made of it and the original
    siblings, and the row is verified if that is the root.

    A null group is a group of its own and stands first; null orders stand first in their group. Rows of one
    group and order are placed by their leaf; rows that repeat as a whole are leaves of their own and
    get proofs of their own. Texts only enter hashes, so very long ones cost a reading. An empty table gives no rows.
    Only the four given expressions are read, so no other column can clash.
    """
    slim = rows.select(
        join_key(group).alias("tree"), group.cast("string").alias("group"), order.alias("id"), leaf.alias("node"),
        (leaf if changed is None else changed).alias("shown"),
    ).withColumn("shown", F.when(F.col("shown") != F.col("node"), F.col("shown")))
    slim = settle(slim, "tree-leaves")
    folds, roots = grow(placed(slim.drop("group"), "id", "node", "shown"), fanout, ["id", "shown"])
    roots = roots.join(slim.select("tree", "group").distinct(), "tree").select(F.lit("").alias("tree"), "group", "node", F.col("tree").alias("below"))
    tops, root = grow(placed(roots, "group"), fanout, ["below"])
    top = descend(tops, root.select("tree", F.lit(0).cast("long").alias("pos"), F.array().cast("array<struct<before:string,behind:string>>").alias("path"), F.lit("").alias("subroot")))
    upper = top.select(F.col("below").alias("tree"), F.lit(0).cast("long").alias("pos"), "path", F.col("node").alias("subroot"))
    root = settle(root.select("node"), "tree-root")
    whole = descend(folds, upper)
    folded = refold(F.coalesce("shown", "node"), F.col("path"))
    siblings = F.array_join(F.transform("path", lambda s: F.concat(s["before"], s["behind"])), "")
    whole = whole.select(
        "id", F.col("node").alias("leaf"), "subroot", root.scalar().alias("root"), "path",
        F.sha2(siblings, 256).alias("proof_sha256"), folded.alias("folded_root"),
    )
    return whole.withColumn("verified", F.col("folded_root") == F.col("root"))


def op12_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's proof; where 7 divides the CRC-32 of the id, the shown leaf has one character too many."""
    docs = table(spark, sf_dir, "documents")
    doc_id, n_chars = F.col("doc_id"), F.col("n_chars")
    tampered = F.crc32(doc_id.cast("string").cast("binary")) % 7 == 0

    def leaf(count: Column) -> Column:
        return leaf_digest(doc_id, F.col("source"), F.col("lang"), count, F.col("text"))

    done = manifest(docs, leaf(n_chars), F.col("lang"), doc_id, F.when(tampered, leaf(n_chars + 1)))
    return done.select(
        F.col("id").alias("doc_id"), "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified",
    )


#: CRC-32 is folded bit by bit over the decimal digits. Trees up to 2^40 leaves.
OP12_SQL = r"""
WITH RECURSIVE t AS (
  SELECT doc_id, lang, n_chars, concat(
      CASE WHEN doc_id IS NULL THEN '-' ELSE strlen(CAST(doc_id AS VARCHAR)) || ':' || doc_id END,
      CASE WHEN source IS NULL THEN '-' ELSE strlen(source) || ':' || source END,
      CASE WHEN lang IS NULL THEN '-' ELSE strlen(lang) || ':' || lang END) AS head,
    CASE WHEN text IS NULL THEN '-' ELSE strlen(text) || ':' || text END AS tail,
    list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: CAST(ascii(c) AS BIGINT))),
      lambda a, b: list_reduce(list_prepend(xor(a, b), [CAST(x AS BIGINT) FOR x IN range(8)]),
        lambda c, i: xor(c >> 1, CAST(3988292384 AS BIGINT) * (c & 1)))) AS crc
  FROM documents
), leaves AS (
  SELECT doc_id, lang, sha256(head || coalesce(strlen(CAST(n_chars AS VARCHAR)) || ':' || n_chars, '-') || tail) AS leaf,
    sha256(head || coalesce(strlen(CAST(n_chars + 1 AS VARCHAR)) || ':' || (n_chars + 1), '-') || tail) AS other,
    xor(crc, CAST(4294967295 AS BIGINT)) % 7 = 0 AS tampered
  FROM t
), base AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf, CASE WHEN tampered AND other <> leaf THEN other END NULLS FIRST) - 1 AS pos,
    count(*) OVER (PARTITION BY lang) AS n
  FROM leaves
), up AS (
  SELECT lang, 0 AS lvl, n, pos, leaf AS d FROM base
  UNION ALL
  SELECT lang, any_value(lvl) + 1, any_value((n + 1) // 2), pos // 2, sha256(string_agg(d, '' ORDER BY pos)) FROM up WHERE n > 1 GROUP BY lang, pos // 2
), subs AS (
  SELECT lang, d AS subroot, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS pos, count(*) OVER () AS n FROM up WHERE n = 1
), top AS (
  SELECT 0 AS lvl, n, pos, subroot AS d FROM subs
  UNION ALL
  SELECT any_value(lvl) + 1, any_value((n + 1) // 2), pos // 2, sha256(string_agg(d, '' ORDER BY pos)) FROM top WHERE n > 1 GROUP BY pos // 2
), down AS (
  SELECT doc_id, lang, pos AS at, 0 AS lvl, n, pos, FALSE AS over, CASE WHEN tampered THEN other ELSE leaf END AS node, '' AS proof, leaf FROM base
  UNION ALL
  SELECT d.doc_id, d.lang, d.at,
    CASE WHEN d.over OR d.n > 1 THEN d.lvl + 1 ELSE 0 END, CASE WHEN d.over OR d.n > 1 THEN (d.n + 1) // 2 ELSE s.n END,
    CASE WHEN d.over OR d.n > 1 THEN d.pos // 2 ELSE s.pos END, d.over OR d.n = 1,
    CASE WHEN NOT d.over AND d.n = 1 THEN d.node
         WHEN d.pos % 2 = 0 THEN sha256(d.node || coalesce(u.d, t.d, '')) ELSE sha256(coalesce(u.d, t.d, '') || d.node) END,
    CASE WHEN NOT d.over AND d.n = 1 THEN d.proof ELSE d.proof || coalesce(u.d, t.d, '') END, d.leaf
  FROM down d JOIN subs s ON s.lang IS NOT DISTINCT FROM d.lang
  LEFT JOIN up u ON NOT d.over AND d.n > 1 AND u.lang IS NOT DISTINCT FROM d.lang AND u.lvl = d.lvl AND u.pos = xor(d.pos, CAST(1 AS BIGINT))
  LEFT JOIN top t ON d.over AND t.lvl = d.lvl AND t.pos = xor(d.pos, CAST(1 AS BIGINT))
  WHERE NOT (d.over AND d.n = 1)
)
SELECT down.doc_id, leaf, subroot, r.d AS root, sha256(proof) AS proof_sha256, node AS folded_root, node = r.d AS verified
FROM down JOIN subs ON subs.lang IS NOT DISTINCT FROM down.lang CROSS JOIN (SELECT d FROM top WHERE n = 1) r
WHERE over AND down.n = 1
"""
