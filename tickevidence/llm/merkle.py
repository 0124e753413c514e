"""A Merkle manifest of a dataset: few stored levels, proofs from recomputed ones.

Rows become leaves; per group (``lang``) the leaves stand in order, and every ``FAN``
consecutive nodes become the digest of their digests until one node, the subroot, is
left. Subroots in the order of their groups make one more tree, whose top is the root.

Only every ``KEEP``-th level is stored. A stored node and its stored descendants one step
below form an aligned subtree of at most ``FAN ** KEEP`` nodes. To extract proofs, the
missing nodes of each subtree are computed again from its stored descendants, the
siblings of every descendant are put in front of the path of the subtree's top, and
the recomputed nodes are dropped. Subtrees are the unit of work, whatever a group's size.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickevidence.llm.common import numbered
from tickevidence.session import stage_table

#: Nodes under one parent, and levels between two stored ones.
FAN, KEEP = 8, 2
STEP = FAN**KEEP

#: A proof: per level from below the digests left and right of the node, each joined to one string.
PATH = "array<struct<left string, right string>>"


def digest(*parts: Column | str) -> Column:
    """Lowercase hex sha256 of the concatenated parts."""
    return F.sha2(F.concat(*parts), 256)


def field(value: Column) -> Column:
    """``-`` for NULL, else the number of UTF-8 bytes, a colon and the value as text."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def row_digest(columns: list[Column]) -> Column:
    return digest(*[field(c) for c in columns])


def group_key(group: str) -> Column:
    """The group as text that is never NULL; the NULL group sorts before all others, those by their UTF-8 bytes."""
    return F.when(F.col(group).isNull(), "-").otherwise(F.concat(F.lit("="), F.col(group)))


@dataclass
class Tree:
    """Stored levels, lowest first: (grp, position, n, digest), n being the nodes of the group on that level."""

    levels: list[DataFrame]

    @property
    def tops(self) -> DataFrame:
        """One row per group: grp and the digest of its top."""
        found = [level.filter("n = 1").select("grp", "digest") for level in self.levels]
        out = found[0]
        for more in found[1:]:
            out = out.unionByName(more)
        return out


def _joined(nodes: str) -> str:
    return f"array_join({nodes}, '')"


def _subtrees(level: DataFrame, extra: list[str]) -> DataFrame:
    """Aligned subtrees of a stored level: members in order, their digests, and the recomputed nodes between."""
    members = F.sort_array(F.collect_list(F.struct("position", "digest", *extra)))
    out = level.withColumn("subtree", F.floor(F.col("position") / STEP))
    out = out.groupBy("grp", "subtree").agg(F.first("n").alias("n"), members.alias("members"))
    out = out.withColumn("low", F.expr("members.digest"))
    # A group of at most FAN nodes has its top right above them; there is no level between.
    last = f"cast((size(low) - 1) div {FAN} as int)"
    runs = f"transform(sequence(0, {last}), i -> sha2({_joined(f'slice(low, i * {FAN} + 1, {FAN})')}, 256))"
    return out.withColumn("mid", F.expr(runs))


def build(leaves: DataFrame, name: str) -> Tree:
    """The stored levels over ``leaves`` (grp, position from 0 without gaps, n, digest, and columns that stay on the leaves).

    A group of one leaf is its own top. Each level is staged once; the loop ends
    when every group has come down to one node, after log64 of the largest group.
    """
    levels = [leaves]
    while True:
        above = _subtrees(levels[-1].filter("n > 1").select("grp", "position", "n", "digest"), [])
        top = F.when(F.col("n") <= FAN, F.get("mid", F.lit(0))).otherwise(F.expr(f"sha2({_joined('mid')}, 256)"))
        n = F.ceil(F.col("n") / STEP)
        above = above.select("grp", F.col("subtree").alias("position"), n.alias("n"), top.alias("digest"))
        above = stage_table(above, f"{name}-{len(levels) * KEEP}")
        if above.isEmpty():
            return Tree(levels)
        levels.append(above)


def proofs(tree: Tree, above: DataFrame, extra: list[str] | None = None, wanted: DataFrame | None = None) -> DataFrame:
    """Every leaf with ``path``, the siblings from itself to the end of ``above``.

    ``above`` holds, per group, the path that continues from the group's top, and any
    further columns for all its leaves. ``extra`` names columns of the leaves to carry.
    ``wanted`` (grp, position) restricts the work to the subtrees on the way to those leaves.
    """
    extra = extra or []
    carried = [c for c in above.columns if c not in ("grp", "path")]
    asked = None if wanted is None else [wanted]
    for _ in tree.levels[1:]:
        if asked is not None:
            asked.append(asked[-1].select("grp", F.floor(F.col("position") / STEP).alias("position")).distinct())
    found = None
    for depth in reversed(range(len(tree.levels))):
        own = extra if depth == 0 else []
        level = tree.levels[depth].select("grp", "position", "n", "digest", *own)
        if asked is not None:
            whole = asked[depth].select("grp", F.floor(F.col("position") / STEP).alias("subtree")).distinct()
            level = level.withColumn("subtree", F.floor(F.col("position") / STEP)).join(whole, ["grp", "subtree"], "left_semi").drop("subtree")
        tops = level.filter("n = 1").join(above, "grp").select("grp", "position", "digest", *own, "path", *carried)
        if found is not None:
            upper = found.select("grp", F.col("position").alias("subtree"), F.col("path").alias("upper"), *carried)
            below = _subtrees(level.filter("n > 1"), own).join(upper, ["grp", "subtree"])
            first = f"(i - i % {FAN})"
            left = _joined(f"slice(low, {first} + 1, i % {FAN})")
            right = _joined(f"slice(low, i + 2, {FAN - 1} - i % {FAN})")
            mid_left = _joined(f"slice(mid, 1, cast(i div {FAN} as int))")
            mid_right = _joined(f"slice(mid, cast(i div {FAN} as int) + 2, {FAN})")
            step = f"array(struct({left} as left, {right} as right))"
            both = f"array(struct({left} as left, {right} as right), struct({mid_left} as left, {mid_right} as right))"
            path = f"concat(if(n <= {FAN}, {step}, {both}), upper)"
            rows = F.expr(f"transform(members, (m, i) -> struct(m as member, {path} as path))")
            below = below.select("grp", *carried, F.explode(rows).alias("row"))
            below = below.select("grp", *[F.col(f"row.member.{c}") for c in ("position", "digest", *own)], "row.path", *carried)
            tops = tops.unionByName(below)
        found = tops
    if wanted is not None:
        found = found.join(wanted, ["grp", "position"], "left_semi")
    return found


def path_digest(path: str = "path") -> Column:
    """The digest of all siblings of a path, from the leaf upwards, each level from left to right."""
    return F.sha2(F.array_join(F.transform(F.col(path), lambda p: F.concat(p["left"], p["right"])), ""), 256)


def folded(leaf: Column, path: str = "path") -> Column:
    """The root that a leaf and its siblings give."""
    return F.aggregate(F.col(path), leaf, lambda at, p: F.sha2(F.concat(p["left"], at, p["right"]), 256))


@dataclass
class Manifest:
    """The tree of each group, and the tree over the groups' tops."""

    groups: Tree
    top: Tree


def manifest(rows: DataFrame, group: str, order: list[str], columns: list[str], extra: dict[str, Column] | None = None) -> Manifest:
    """The manifest of ``rows``: the digest of ``columns`` is the leaf, ``order`` places it within its group.

    A NULL group is a group of its own, the first; NULLs in ``order`` come first; equal
    keys go by their digests, so that repeated rows give the same root in any order.
    ``extra`` are further columns to keep on the leaves, computed in the one pass that
    reads the rows. An empty table gives trees without nodes.
    """
    kept = {f"key_{k}": F.col(c) for k, c in enumerate(order)} | (extra or {})
    leaf = row_digest([F.col(c) for c in columns])
    leaves = rows.select(group_key(group).alias("grp"), leaf.alias("digest"), *[c.alias(k) for k, c in kept.items()])
    leaves = stage_table(leaves.withColumn("row_key", F.monotonically_increasing_id()), "leaves")
    keys = [k for k in kept if k.startswith("key_")]
    placed = numbered(leaves, ["grp"], [*keys, "digest", "row_key"], "leaves-in-order").withColumnRenamed("total", "n")
    groups = build(placed, "level")
    tops = groups.tops.select(F.lit("all").alias("grp"), F.col("grp").alias("member"), "digest")
    return Manifest(groups, build(numbered(tops, ["grp"], ["member"], "subroots").withColumnRenamed("total", "n"), "top-level"))


def all_proofs(of: Manifest, extra: list[str], wanted: DataFrame | None = None) -> DataFrame:
    """Every leaf (or the ``wanted`` ones) with digest, path to the root, subroot, root and the ``extra`` columns."""
    end = of.top.tops.select("grp", F.expr(f"cast(array() as {PATH})").alias("path"), F.col("digest").alias("root"))
    above = proofs(of.top, end, ["member"])
    above = above.select(F.col("member").alias("grp"), "path", F.col("digest").alias("subroot"), "root")
    return proofs(of.groups, above, extra, wanted)
