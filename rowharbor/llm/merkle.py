"""Merkle manifest of a dataset: leaves per row, one tree per group, one tree over the groups, and a proof for every row.

Every three consecutive nodes of a level become one (the last run may be shorter), until one is left. Positions come from a range
partition by group and id: tasks number their own rows, and the sizes of the (group, task) runs shift them, so no group is sorted
in one task. A tree is cut into superblocks of ``3 ** rounds`` leaves (729), so that no run crosses a border.

Upwards, each superblock is reduced to its node, and those nodes are again dealt into superblocks, until one node is left. Downwards,
the members of a superblock and the outer nodes that it needs (the siblings on the way from its node to the root) are
cogrouped by superblock: one task finishes the local reduction, joins local and outer siblings to the proof of each member and,
at the leaves, folds the observed leaf with it. What moves per superblock is its members and one list of some dozens of digests.

Defined cases: NULL fields are written ``-``; a NULL id comes first and a NULL group is the first tree; rows that share an id are
ordered by leaf, and equal rows take neighbouring places; an empty table gives no rows. A text of any length is hashed where it
is read and goes no further. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from hashlib import sha256

import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from rowharbor.session import cut_lineage

FAN = 3
ROUNDS = 6

#: ``monotonically_increasing_id`` keeps the place within a task in this many bits.
_PLACE_BITS = 33


def digest(texts: Iterable[str]) -> str:
    return sha256("".join(texts).encode()).hexdigest()


def leaf_of(values: Sequence[Column]) -> Column:
    """Digest of the values of a row, each with its length in bytes, or ``-`` where it is NULL."""
    written = [v.cast("string") for v in values]
    return F.sha2(F.concat(*[F.when(v.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(v).cast("string"), F.lit(":"), v)) for v in written]), 256)


def positions(rows: DataFrame, group: str, order: Sequence[str], label: str) -> DataFrame:
    """Rows with ``position`` (from 0) and ``count`` within their group; NULLs are one group and come first."""
    placed = rows.repartitionByRange(*[F.col(c).asc_nulls_first() for c in (group, *order)])
    placed = placed.sortWithinPartitions(*[F.col(c).asc_nulls_first() for c in (group, *order)])
    stored = cut_lineage(placed.withColumn("place", F.monotonically_increasing_id()), label).withColumn("task", F.shiftright("place", _PLACE_BITS))
    runs = stored.groupBy(group, "task").agg(F.count(F.lit(1)).alias("n"), F.min("place").alias("first"))
    own = Window.partitionBy(group)
    before = F.coalesce(F.sum("n").over(own.orderBy("task").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    runs = runs.select(F.col(group).alias("run_group"), F.col("task").alias("run_task"), (before - F.col("first")).alias("shift"), F.sum("n").over(own).alias("count"))
    joined = stored.join(runs, stored[group].eqNullSafe(runs["run_group"]) & (stored["task"] == runs["run_task"]))
    return joined.withColumn("position", F.col("place") + F.col("shift")).drop("place", "task", "run_group", "run_task", "shift")


def reduced(nodes: Sequence[str], count: int, rounds: int) -> list[list[str]]:
    """The levels over the members of one superblock of a tree of ``count``: up to its node, or up to the top if it is the only one."""
    levels, alone = [list(nodes)], count <= FAN**rounds
    while len(levels[-1]) > 1 if alone else len(levels) <= rounds:
        last = levels[-1]
        levels.append([digest(last[i : i + FAN]) for i in range(0, len(last), FAN)])
    return levels


def local_path(levels: Sequence[Sequence[str]], at: int) -> list[str]:
    """What stands left and right of a member within its run, and so on upwards: two texts per level."""
    path = []
    for nodes in levels[:-1]:
        start = at - at % FAN
        path += ["".join(nodes[start:at]), "".join(nodes[at + 1 : start + FAN])]
        at //= FAN
    return path


def fold(leaf: str, path: Sequence[str]) -> str:
    """The root that a leaf and its siblings lead to."""
    for left, right in zip(path[::2], path[1::2], strict=True):
        leaf = digest((left, leaf, right))
    return leaf


def _block(rounds: int) -> Column:
    return F.expr(f"position div {FAN**rounds}")


def reduce_blocks(nodes: DataFrame, rounds: int) -> DataFrame:
    """``tree, position, digest, count`` of the superblocks of ``nodes`` (same columns)."""

    def run(key, pdf):
        count = int(pdf["count"].iloc[0])
        top = reduced(pdf.sort_values("position")["digest"], count, rounds)[-1][0]
        return pd.DataFrame([(key[0], key[1], top, -(-count // FAN**rounds))], columns=["tree", "position", "digest", "count"])

    dealt = nodes.select("tree", "position", "digest", "count", _block(rounds).alias("block"))
    return dealt.groupBy("tree", "block").applyInPandas(run, "tree long, position long, digest string, count long")


def ladder(nodes: DataFrame, rounds: int, label: str) -> list[DataFrame]:
    """The nodes themselves, the nodes of their superblocks, of the superblocks of those and so on; the last has one per tree."""
    rungs = [nodes]
    while (rungs[-1].agg(F.max("count")).first()[0] or 0) > 1:
        rungs.append(cut_lineage(reduce_blocks(rungs[-1], rounds), label))
    return rungs


def outer_paths(members: DataFrame, outer: DataFrame, rounds: int) -> DataFrame:
    """``tree, position, top, path`` of nodes, from those of their superblocks."""

    def run(key, pdf, above):
        pdf = pdf.sort_values("position")
        levels = reduced(pdf["digest"], pdf["count"].iloc[0], rounds)
        rest = list(above["path"].iloc[0])
        paths = [local_path(levels, i) + rest for i in range(len(pdf))]
        return pd.DataFrame({"tree": key[0], "position": pdf["position"], "top": above["top"].iloc[0], "path": paths})

    return _cogrouped(members, outer, rounds, run, "tree long, position long, top string, path array<string>")


def proofs(leaves: DataFrame, outer: DataFrame, rounds: int) -> DataFrame:
    """Leaves with ``top``, ``proof`` (siblings from left to right, level by level) and ``folded_root`` of the observed leaf."""

    def run(key, pdf, above):
        pdf = pdf.sort_values("position")
        levels = reduced(pdf["digest"], pdf["count"].iloc[0], rounds)
        rest = list(above["path"].iloc[0])
        paths = [local_path(levels, i) + rest for i in range(len(pdf))]
        folded = [fold(leaf, path) for leaf, path in zip(pdf["observed"], paths, strict=True)]
        out = pd.DataFrame({"has_id": pdf["has_id"], "id": pdf["id"], "leaf": pdf["digest"], "subroot": above["top"].iloc[0]})
        return out.assign(proof=[[t for t in path if t] for path in paths], folded_root=folded)

    # A NULL among whole numbers would turn them into floats on the way to pandas.
    whole = leaves.withColumns({"has_id": F.col("id").isNotNull(), "id": F.coalesce("id", F.lit(0))})
    return _cogrouped(whole, outer, rounds, run, "has_id boolean, id long, leaf string, subroot string, proof array<string>, folded_root string")


def _cogrouped(members: DataFrame, outer: DataFrame, rounds: int, run, ddl: str) -> DataFrame:
    dealt = members.withColumn("block", _block(rounds)).groupBy("tree", "block")
    above = outer.withColumnRenamed("position", "block").groupBy("tree", "block")
    return dealt.cogroup(above).applyInPandas(run, ddl)


def manifest(rows: DataFrame, fields: Sequence[str], observed: Sequence[Column] | None = None, id_column: str = "doc_id", group: str = "source", rounds: int = ROUNDS) -> DataFrame:
    """``id, leaf, subroot, root, proof, folded_root, verified`` of every row.

    ``fields`` are what a leaf covers; ``observed`` are the values under audit in their place (the same if not given), whose
    leaf is folded with the siblings of the manifest and holds if it leads to the root.
    """
    own = [F.col(c) for c in fields]
    hashed = rows.select(F.col(group).alias("grp"), F.col(id_column).cast("long").alias("id"), leaf_of(own).alias("digest"), leaf_of(observed or own).alias("observed"))
    placed = positions(cut_lineage(hashed, "merkle-leaves"), "grp", ["id", "digest", "observed"], "merkle-placed")
    groups = cut_lineage(placed.groupBy("grp").agg(F.first("count").alias("n")).withColumn("forest", F.lit(0)), "merkle-groups")
    trees = positions(groups, "forest", ["grp"], "merkle-trees").select(F.col("grp").alias("own_grp"), F.col("position").alias("tree"))
    leaves = cut_lineage(placed.join(trees, placed["grp"].eqNullSafe(trees["own_grp"])).drop("grp", "own_grp"), "merkle-members")

    rungs = ladder(leaves, rounds, "merkle-blocks")
    subroots = rungs[-1].select(F.lit(0).cast("long").alias("tree"), F.col("tree").alias("position"), "digest")
    n_trees = trees.count()
    crowns = ladder(subroots.withColumn("count", F.lit(n_trees).cast("long")), rounds, "merkle-crowns")
    root = (crowns[-1].first() or {"digest": None})["digest"]

    path = crowns[-1].select("tree", "position", F.col("digest").alias("top"), F.array().cast("array<string>").alias("path"))
    for members in crowns[-2::-1]:
        path = outer_paths(members, path, rounds)
    tops = subroots.select(F.col("position").alias("tree"), F.col("digest").alias("subroot"))
    path = path.select(F.col("position").alias("tree"), F.lit(0).cast("long").alias("position"), "path").join(tops, "tree").withColumnRenamed("subroot", "top")
    path = cut_lineage(path, "merkle-paths")
    for members in rungs[-2:0:-1]:
        path = cut_lineage(outer_paths(members, path, rounds), "merkle-paths")
    proven = proofs(leaves, path, rounds).withColumn("id", F.when(F.col("has_id"), F.col("id"))).drop("has_id")
    return proven.withColumn("root", F.lit(root).cast("string")).withColumn("verified", F.col("folded_root") == F.col("root"))
