"""Merkle manifest of a table: digests of rows, of groups and of the whole, with a proof for every row.

A group's rows are the leaves of a tree, the trees' roots the leaves of one more. A level is a table of nodes
(tree, idx, n, digest), n being the nodes of the tree on that level. It joins itself: every node works out the places of
its siblings (idx XOR 1 in a binary tree, else the other slots of its run by offset) and finds them by equality on
(tree, idx), which spreads a tree of any size over all tasks. Rows in slot zero then know their whole run and emit its parent.

Proofs come down again: a node's path is its siblings and then its parent's path.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from perigee.session import work_table

ARITY = 3
#: What of a document enters its leaf, in this order.
COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")


def digest(text: Column) -> Column:
    return F.sha2(text, 256)


def field(value: Column) -> Column:
    """A value as it enters a leaf: its UTF-8 byte count, a colon and itself; `-` if null."""
    value = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-"))


def leaf_digest(*values: Column) -> Column:
    """Digest of a row's values in their order; different values are never written alike."""
    return digest(F.concat(*map(field, values)))


def with_rank(rows: DataFrame, *order: str) -> DataFrame:
    """`rows` with `at`, their place in ascending `order` (null first, text by its UTF-8 bytes), from 0.

    Rows are dealt by ranges and sorted within them; the sizes of the ranges before give the rest, so nothing
    is sorted in one task. Equal rows get places of their own and may lie in several ranges.
    """
    numbered = rows.withColumn("__row", F.monotonically_increasing_id())
    dealt = numbered.repartitionByRange(*order, "__row").sortWithinPartitions(*order, "__row")
    # The id holds the range in its upper bits and counts on within it.
    dealt = work_table(dealt.drop("__row").withColumn("__at", F.monotonically_increasing_id()), "merkle-ranges")
    part = F.shiftright("__at", 33)
    # One row per range: no more of them than shuffle partitions.
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    firsts = dealt.groupBy(part.alias("__part")).agg(F.count("*").alias("__size"))
    firsts = firsts.select("__part", F.coalesce(F.sum("__size").over(before), F.lit(0)).alias("__first"))
    placed = dealt.withColumn("__part", part).join(F.broadcast(firsts), "__part")
    at = F.col("__first") + F.col("__at").bitwiseAND(F.lit((1 << 33) - 1))
    return placed.select(*(f"`{name}`" for name in rows.columns), at.alias("at"))


def planted(leaves: DataFrame, group: str, *order: str) -> DataFrame:
    """`leaves` with their tree, their place idx in it and its size n. Trees are numbered in the groups' order."""
    ranked = work_table(with_rank(leaves, group, *order), "merkle-ranked")
    trees = ranked.groupBy(F.col(group).alias("__group")).agg(F.min("at").alias("tree"), F.count("*").alias("n"))
    joined = ranked.join(trees, F.col(group).eqNullSafe(F.col("__group")))
    return joined.select(*(f"`{name}`" for name in leaves.columns), "tree", (F.col("at") - F.col("tree")).alias("idx"), "n")


def sibling_places(idx: Column, arity: int) -> list[Column]:
    """Where a node's siblings are, if there are so many."""
    if arity == 2:
        return [idx.bitwiseXOR(F.lit(1))]
    slot = idx % arity
    return [idx - slot + (slot + k) % arity for k in range(1, arity)]


def with_siblings(nodes: DataFrame, arity: int) -> DataFrame:
    """`nodes` with slot, siblings (their digests in order) and, in slot zero, the digest of the parent."""
    out = nodes
    for k, place in enumerate(sibling_places(F.col("idx"), arity)):
        others = nodes.select(F.col("tree").alias("__tree"), F.col("idx").alias("__idx"), F.col("digest").alias(f"__d{k}"))
        out = out.withColumn(f"__p{k}", place)
        out = out.join(others, (F.col("tree") == F.col("__tree")) & (F.col(f"__p{k}") == F.col("__idx")), "left")
        out = out.drop("__tree", "__idx")
    found = F.array(*(F.struct(F.col(f"__p{k}").alias("idx"), F.col(f"__d{k}").alias("digest")) for k in range(arity - 1)))
    found = F.array_sort(F.filter(found, lambda s: s["digest"].isNotNull()))["digest"]
    out = out.withColumn("siblings", found).withColumn("slot", (F.col("idx") % arity).cast("int"))
    parent = F.when(F.col("slot") == 0, digest(F.concat("digest", F.array_join("siblings", ""))))
    return out.select(*(f"`{name}`" for name in nodes.columns), "slot", "siblings", parent.alias("parent"))


def grown(leaves: DataFrame, arity: int) -> tuple[list[DataFrame], DataFrame]:
    """Levels of the trees above `leaves` (tree, idx, n, digest and any others), and the roots (tree, digest).

    A level has the nodes of the trees that are not at their root yet; the first keeps the leaves' other columns.
    """
    levels, nodes = [], leaves
    roots = nodes.filter("n = 1").select("tree", "digest")
    while (nodes.agg(F.max("n")).first()[0] or 1) > 1:
        levels.append(work_table(with_siblings(nodes.filter("n > 1"), arity), "merkle-level"))
        idx, n = F.col("idx") / F.lit(arity), F.ceil(F.col("n") / F.lit(arity))
        nodes = levels[-1].filter("slot = 0").select(
            "tree", F.floor(idx).cast("long").alias("idx"), n.cast("long").alias("n"), F.col("parent").alias("digest")
        )
        roots = roots.union(nodes.filter("n = 1").select("tree", "digest"))
    return levels, roots


def with_paths(levels: list[DataFrame], tops: DataFrame, arity: int) -> DataFrame:
    """The nodes of the lowest level with `path` and the columns that `tops` (tree, path and any others) has for the tree."""
    above = tops.withColumn("idx", F.lit(0).cast("long"))
    step = F.array(F.struct("slot", "siblings"))
    for number, level in reversed(list(enumerate(levels))):
        parents = above.withColumnsRenamed({"tree": "__tree", "idx": "__idx", "path": "__path"})
        over = F.floor(F.col("idx") / F.lit(arity)).cast("long")
        own = ["tree", "idx"] if number else [name for name in level.columns if name not in ("slot", "siblings", "parent")]
        found = level.join(parents, (F.col("tree") == F.col("__tree")) & (over == F.col("__idx")))
        others = [name for name in tops.columns if name not in ("tree", "path")]
        found = found.select(*own, *others, F.concat(step, "__path").alias("path"))
        if number:
            # The roots of trees that begin below come along.
            later = above.filter("idx = 0").join(level.select("tree").distinct(), "tree", "left_anti")
            found = work_table(found.unionByName(later), "merkle-paths")
        above = found
    return above


def proof_digest(path: Column) -> Column:
    """Digest of a path's siblings, from the leaf up and from left to right."""
    return digest(F.array_join(F.flatten(path["siblings"]), ""))


def folded(leaf: Column, path: Column) -> Column:
    """The root that a leaf and the siblings on its path make."""

    def up(below: Column, step: Column) -> Column:
        before = F.slice(step["siblings"], F.lit(1), step["slot"])
        after = F.slice(step["siblings"], step["slot"] + 1, F.size(step["siblings"]))
        return digest(F.concat(F.array_join(before, ""), below, F.array_join(after, "")))

    return F.aggregate(path, leaf, up)


def manifest(rows: DataFrame, group: str, order: Sequence[str], arity: int = ARITY) -> tuple[DataFrame, str | None]:
    """`rows` (digest, `group`, `order` and any others) with tree, idx, n, subroot and path; and the root.

    A group's rows, ascending by `order`, make a tree: while several nodes remain, every `arity` of them in a row (the last
    run may be shorter, even of one) become the digest of their digests. A lone leaf is its tree's root. The groups'
    roots, null first, make the tree above. `path` has for each level up to the root the node's slot and its siblings.

    Equal rows are leaves of their own, next to each other; rows equal in `order` but not in their digest stand by the digest.
    An empty table has no root (None). Columns named like those added are replaced.
    """
    rows = rows.drop("tree", "idx", "n", "slot", "siblings", "parent", "path", "subroot", "at")
    leaves = work_table(planted(work_table(rows, "merkle-leaves"), group, *order, "digest"), "merkle-planted")
    levels, subroots = grown(leaves, arity)
    subroots = work_table(with_rank(work_table(subroots, "merkle-subroots"), "tree"), "merkle-subroots")
    trees = subroots.agg(F.count("*")).first()[0]
    above = subroots.select(
        F.lit(0).cast("long").alias("tree"), F.col("at").alias("idx"), F.lit(trees).cast("long").alias("n"), "digest",
        F.col("tree").alias("of"), F.col("digest").alias("subroot"),
    )
    upper, roots = grown(above, arity)
    root = roots.first()
    empty = F.array().cast("array<struct<slot: int, siblings: array<string>>>")
    tops = with_paths(upper, roots.select("tree", empty.alias("path")), arity) if upper else above.withColumn("path", empty)
    tops = work_table(tops.select(F.col("of").alias("tree"), "path", "subroot"), "merkle-tops")
    lone = leaves.filter("n = 1").join(tops, "tree")
    if levels:
        lone = lone.unionByName(with_paths(levels, tops, arity))
    return lone, root and root["digest"]


def tampered(text: Column, doc_id: Column) -> Column:
    """The text without its line ends where 2 divides the CRC-32 of the decimal id, else as it is."""
    return F.when(F.crc32(doc_id.cast("string")) % 2 == 0, F.translate(text, "\n", "")).otherwise(text)


def op13_merkle(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    values = {name: F.col(name) for name in COLUMNS}
    changed = values | {"text": tampered(F.col("text"), F.col("doc_id"))}
    leaves = docs.select(
        "doc_id", "source", leaf_digest(*values.values()).alias("digest"), leaf_digest(*changed.values()).alias("changed")
    )
    found, root = manifest(leaves, "source", ["doc_id"])
    fold = found.withColumn("folded_root", folded(F.col("changed"), F.col("path")))
    return fold.select(
        "doc_id",
        F.col("digest").alias("leaf"),
        "subroot",
        F.lit(root).cast("string").alias("root"),
        proof_digest(F.col("path")).alias("proof_sha256"),
        "folded_root",
        (F.col("folded_root") == F.lit(root).cast("string")).alias("verified"),
    )


OP13_SQL = r"""
WITH RECURSIVE fields AS (
  SELECT doc_id, source, text,
    concat(coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id, '-'), coalesce(strlen(source) || ':' || source, '-'),
      coalesce(strlen(lang) || ':' || lang, '-'), coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-')) AS head,
    list_reduce(
      list_concat([4294967295::BIGINT], flatten(list_transform(string_split(doc_id::VARCHAR, ''),
        lambda c: list_transform(range(8), lambda i: (ascii(c) >> i::INTEGER)::BIGINT & 1)))),
      lambda crc, bit: xor(crc >> 1, CASE WHEN (xor(crc, bit) & 1) = 1 THEN 3988292384::BIGINT ELSE 0::BIGINT END)) AS crc
  FROM documents),
hashed AS (
  SELECT doc_id, source, sha256(head || coalesce(strlen(text) || ':' || text, '-')) AS leaf,
    sha256(head || coalesce(strlen(changed) || ':' || changed, '-')) AS changed
  FROM (SELECT *, CASE WHEN xor(crc, 4294967295::BIGINT) % 2 = 0 THEN replace(text, chr(10), '') ELSE text END AS changed
        FROM fields)),
leaves AS (
  SELECT *, row_number() OVER () AS k, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS idx,
    count(*) OVER (PARTITION BY source) AS n
  FROM hashed),
nodes AS (
  SELECT source, 0 AS level, idx, n, leaf AS digest FROM leaves
  UNION ALL
  SELECT source, level + 1, idx // 3, (n + 2) // 3, sha256(string_agg(digest, '' ORDER BY idx))
  FROM nodes WHERE n > 1 GROUP BY source, level, idx // 3, n),
subroots AS (
  SELECT source, digest AS subroot, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS idx, count(*) OVER () AS n
  FROM nodes WHERE n = 1),
tops AS (
  SELECT 0 AS level, idx, n, subroot AS digest FROM subroots
  UNION ALL
  SELECT level + 1, idx // 3, (n + 2) // 3, sha256(string_agg(digest, '' ORDER BY idx))
  FROM tops WHERE n > 1 GROUP BY level, idx // 3, n),
runs AS (
  SELECT source, level, idx // 3 AS run, list(digest ORDER BY idx) AS d FROM nodes GROUP BY 1, 2, 3),
top_runs AS (SELECT level, idx // 3 AS run, list(digest ORDER BY idx) AS d FROM tops GROUP BY 1, 2),
walk AS (
  SELECT k, source, 0 AS level, idx, n, '' AS proof, changed AS fold FROM leaves
  UNION ALL
  SELECT k, w.source, w.level + 1, idx // 3, (n + 2) // 3,
    proof || array_to_string(list_concat(d[1 : idx % 3], d[idx % 3 + 2 :]), ''),
    sha256(array_to_string(d[1 : idx % 3], '') || fold || array_to_string(d[idx % 3 + 2 :], ''))
  FROM walk w JOIN runs r ON r.source IS NOT DISTINCT FROM w.source AND r.level = w.level AND r.run = idx // 3
  WHERE n > 1),
top_walk AS (
  SELECT k, 0 AS level, s.idx, s.n, proof, fold FROM walk w JOIN subroots s ON s.source IS NOT DISTINCT FROM w.source
  WHERE w.n = 1
  UNION ALL
  SELECT k, w.level + 1, idx // 3, (n + 2) // 3,
    proof || array_to_string(list_concat(d[1 : idx % 3], d[idx % 3 + 2 :]), ''),
    sha256(array_to_string(d[1 : idx % 3], '') || fold || array_to_string(d[idx % 3 + 2 :], ''))
  FROM top_walk w JOIN top_runs r ON r.level = w.level AND r.run = idx // 3
  WHERE n > 1)
SELECT doc_id, leaf, subroot, t.digest AS root, sha256(proof) AS proof_sha256, fold AS folded_root,
  fold = t.digest AS verified
FROM leaves l JOIN subroots s ON s.source IS NOT DISTINCT FROM l.source
JOIN top_walk w ON w.k = l.k AND w.n = 1
JOIN tops t ON t.n = 1
"""
