"""Merkle manifest of a data set: one tree per group, one tree over the groups' roots.

A leaf is the digest of a row's fields. In every group the leaves stand in order of the id; runs of
``arity`` consecutive nodes become the digest of their digests, until one is left, the subroot. The
subroots, ordered by group (null first, then by UTF-8 bytes), become the root in the same way.

All trees grow together, level by level. At a level every node computes the places of its siblings
(its own place XOR 1 in a binary tree, its place with another slot otherwise), equijoins the level
with itself on them, and the rows of slot 0 emit the parents. What the joins found is kept: it is the
proof of the level. Proofs are put together from the root downwards in bands of ``BAND`` levels, so that a node's
path above its band is shuffled once for all leaves below it. Each level and each band is a written
table, so a lost executor costs a task retry. Places are counted per range partition and offset, so a
group that holds a third of all rows is spread over tasks; joins on places spread it likewise.

Defined results: a null field is ``-`` and thus unlike an empty one; a null group is a group of its
own, the first; rows with a null id come last in their group; equal ids are ordered by their leaf, and
repeated rows are leaves of their own; a lone leaf is its subroot, a lone subroot the root; an empty
proof is the digest of nothing; an empty table gives an empty result; very long texts are digested
whole; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from punctua.llm.common import join_on
from punctua.sources.storage import Scratch, staged

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
ARITY = 2
BAND = 6
AUDIT = 7
_PATH = "array<struct<before: string, after: string>>"


def field_text(value: Column) -> Column:
    """A field as the leaf's digest takes it: the number of its bytes, a colon, its value; null is ``-``."""
    text = value.cast("string")
    return F.when(text.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text), F.lit(":"), text))


def leaf_digest(fields: list[Column]) -> Column:
    return F.sha2(F.concat(*map(field_text, fields)), 256)


def placed(leaves: DataFrame, scratch: Scratch) -> DataFrame:
    """``leaves`` with ``place`` (0, 1, ... in its ``tree``, by the column ``rank``) and ``width`` (leaves of the tree)."""
    ranged = scratch.staged(
        leaves.repartitionByRange("tree", "rank").withColumn("range", F.spark_partition_id()), "leaves")
    tree = Window.partitionBy("tree")
    facts = ranged.groupBy("tree", "range").agg(F.count("*").alias("n")).select(
        "tree", "range", F.sum("n").over(tree).alias("width"), (F.sum("n").over(tree.orderBy("range")) - F.col("n")).alias("before"))
    local = F.row_number().over(Window.partitionBy("tree", "range").orderBy("rank"))
    return join_on(ranged.withColumn("local", local), facts, ["tree", "range"]).withColumn(
        "place", F.col("local") + F.col("before") - 1).drop("local", "before", "range")


def _run(arity: int) -> Column:
    """The place of a node's parent; with the arity of several levels, that of its ancestor."""
    return F.expr(f"place div {arity}L")


def with_siblings(nodes: DataFrame, arity: int) -> DataFrame:
    """Every node with the digests of the siblings before and after it, each joined to one text."""
    slot = F.col("place") % arity
    found, before, after = nodes, [], []
    for shift in range(1, arity):
        sibling = F.col("place").bitwiseXOR(F.lit(1)) if arity == 2 else F.col("place") - slot + (slot + shift) % arity
        others = nodes.select(F.col("tree").alias("_tree"), F.col("place").alias("_place"), F.col("digest").alias(f"_digest{shift}"))
        found = found.withColumn("_sibling", sibling)
        found = found.join(others, (F.col("tree") == F.col("_tree")) & (F.col("_sibling") == F.col("_place")), "left").drop("_tree", "_place")
    for shift in range(1, arity):
        # The sibling at slot + shift stands behind the node unless that passes the run's end.
        digest = F.coalesce(F.col(f"_digest{shift}"), F.lit(""))
        behind = slot + shift < arity
        after.append(F.when(behind, digest).otherwise(F.lit("")))
        before.append(F.when(behind, F.lit("")).otherwise(digest))
    joined = {"before": F.concat(*before), "after": F.concat(*after)} if arity > 1 else {}
    return found.withColumns(joined).select(*nodes.columns, "before", "after")


def _parents(level: DataFrame, arity: int) -> DataFrame:
    """The next level: rows of slot 0 emit the digest of their run. A subroot stays as it is."""
    run = F.sha2(F.concat("digest", "after"), 256)
    return level.where(F.col("place") % arity == 0).select(
        "tree", _run(arity).alias("place"), F.expr(f"(width + {arity - 1}) div {arity}L").alias("width"),
        F.when(F.col("width") > 1, run).otherwise(F.col("digest")).alias("digest"))


def grow(leaves: DataFrame, arity: int, scratch: Scratch) -> tuple[list[DataFrame], DataFrame]:
    """The levels with their siblings, lowest first, and the subroots ``tree, digest``.

    ``leaves`` has ``tree, place, width, digest``. Trees of lesser height wait as their subroot.
    """
    widest = leaves.agg(F.max("width")).first()[0] or 0
    levels, nodes = [], leaves
    while widest > 1:
        levels.append(scratch.staged(with_siblings(nodes, arity), "level"))
        nodes = _parents(levels[-1], arity)
        widest = -(-widest // arity)
    return levels, nodes.select("tree", "digest")


def paths(levels: list[DataFrame], above: DataFrame, arity: int, scratch: Scratch) -> DataFrame:
    """``tree, place, path`` of the lowest level: the siblings from there upwards, then those of ``above``
    (``tree, path``, one row per tree)."""
    whole = above.withColumn("place", F.lit(0).cast("long")).select("tree", "place", "path")
    top = len(levels)
    while top:
        low = max(0, top - BAND)
        part = None
        for level in reversed(levels[low:top]):
            own = F.when(F.col("width") > 1, F.array(F.struct("before", "after"))).otherwise(F.array().cast(_PATH))
            steps = level.select("tree", "place", own.alias("own"))
            if part is None:
                part = steps.select("tree", "place", F.col("own").alias("path"))
                continue
            upper = part.select(F.col("tree").alias("_tree"), F.col("place").alias("_place"), "path")
            part = steps.join(upper, (F.col("tree") == F.col("_tree")) & (_run(arity) == F.col("_place"))).select(
                "tree", "place", F.concat("own", "path").alias("path"))
        upper = whole.select(F.col("tree").alias("_tree"), F.col("place").alias("_place"), F.col("path").alias("_path"))
        band = arity ** (top - low)
        whole = part.join(upper, (F.col("tree") == F.col("_tree")) & (_run(band) == F.col("_place"))).select(
            "tree", "place", F.concat("path", "_path").alias("path"))
        if low:
            whole = scratch.staged(whole, "paths")
        top = low
    return whole


def folded(leaf: Column, path: Column) -> Column:
    """The root that a leaf and the siblings on its path give."""
    return F.aggregate(path, leaf, lambda digest, step: F.sha2(F.concat(step["before"], digest, step["after"]), 256))


def proof_digest(path: Column) -> Column:
    """The digest of all siblings on a path, from the leaf upwards, left to right."""
    return F.sha2(F.array_join(F.transform(path, lambda step: F.concat(step["before"], step["after"])), ""), 256)


def manifest(
    docs: DataFrame, scratch: Scratch, fields=FIELDS, group: str = "lang", order: str = "doc_id", arity: int = ARITY,
    altered: dict[str, Column] | None = None, audited: Column | None = None,
) -> DataFrame:
    """Per row the order column, ``leaf``, ``subroot``, ``root``, ``path`` and ``checked_leaf``.

    ``path`` has a step per level, from the leaf upwards: the digests of the siblings ``before`` and
    ``after``. ``checked_leaf`` is the leaf as an audit finds it: with the expressions ``altered`` in place of the
    fields of these names where ``audited`` holds, the same as ``leaf`` elsewhere. The result reads tables
    of ``scratch``.
    """
    leaf = leaf_digest([F.col(name) for name in fields])
    again = leaf_digest([(altered or {}).get(name, F.col(name)) for name in fields])
    leaves = docs.select(
        F.col(order).alias("id"), F.coalesce(F.concat(F.lit(":"), F.col(group).cast("string")), F.lit("")).alias("tree"),
        leaf.alias("digest"), (F.when(audited, again) if audited is not None else F.lit(None).cast("string")).alias("again"),
        F.monotonically_increasing_id().alias("uid"),
    ).withColumn("rank", F.struct(F.col("id").isNull().alias("no_id"), "id", "digest", "uid"))
    numbered = scratch.staged(placed(leaves, scratch).drop("rank"), "placed")
    levels, subroots = grow(numbered.select("tree", "place", "width", "digest"), arity, scratch)
    groups = subroots.select(F.lit("").alias("tree"), F.struct("tree").alias("rank"), F.col("tree").alias("name"), "digest")
    groups = scratch.staged(placed(groups, scratch).drop("rank"), "groups")
    tops, root = grow(groups.select("tree", "place", "width", "digest"), arity, scratch)
    nothing = F.array().cast(_PATH).alias("path")
    above = paths(tops, root.select("tree", nothing), arity, scratch) if tops else groups.select("tree", "place", nothing)
    # Subroot and root travel as the last step of a path: no join on the group, which may be hot.
    ends = F.array(F.struct(F.col("digest").alias("before"), F.lit(next((row[0] for row in root.select("digest").collect()), "")).alias("after")))
    base = scratch.staged(
        groups.join(above, ["tree", "place"]).select(F.col("name").alias("tree"), F.concat("path", ends).alias("path")), "above")
    whole = paths(levels, base, arity, scratch)
    last = F.element_at("path", -1)
    return numbered.join(whole, ["tree", "place"]).select(
        F.col("id").alias(order), F.col("digest").alias("leaf"), last["before"].alias("subroot"), last["after"].alias("root"),
        F.slice("path", 1, F.size("path") - 1).alias("path"), F.coalesce("again", "digest").alias("checked_leaf"))


def audit(docs: DataFrame) -> DataFrame:
    """The manifest of ``documents`` and the verdict on every row; where ``AUDIT`` divides the CRC-32 of
    the id (never of a null one), the audit finds ``n_chars`` larger by 1; a null stays null."""
    typed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "source", "lang", F.col("n_chars").cast("long").alias("n_chars"), "text")
    with Scratch(docs.sparkSession) as scratch:
        found = manifest(
            typed, scratch, altered={"n_chars": F.try_add("n_chars", F.lit(1))},
            audited=F.crc32(F.col("doc_id").cast("string").cast("binary")) % AUDIT == 0)
        return staged(found.select(
            "doc_id", "leaf", "subroot", "root", proof_digest(F.col("path")).alias("proof_sha256"),
            folded(F.col("checked_leaf"), F.col("path")).alias("folded_root"),
        ).withColumn("verified", F.col("folded_root") == F.col("root")), "audit")
