"""The dataset manifest against a plain tree."""

from __future__ import annotations

import zlib
from collections import Counter

from pyspark.sql import functions as F

from llm import brute
from rowharbor.llm import merkle
from rowharbor.llm.queries import MANIFEST_FIELDS, QUERIES

FOLDER = "/root/testdata/sf0.001"


def leaf(values):
    return brute.sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def tree(nodes):
    """Root, and for every node the runs it stands in, with its place in each."""
    levels, paths = [list(nodes)], [[] for _ in nodes]
    while len(levels[-1]) > 1:
        last = levels[-1]
        runs = [last[i : i + 3] for i in range(0, len(last), 3)]
        for i, path in enumerate(paths):
            at = i // 3 ** (len(levels) - 1)
            path.append((runs[at // 3], at % 3))
        levels.append([brute.sha("".join(r)) for r in runs])
    return levels[-1][0], paths


def plain(rows, observed):
    """rows: (id, source, ...) tuples; observed: the leaf under audit of each."""
    groups: dict = {}
    for row in rows:
        groups.setdefault(row[1], []).append(row)
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    made = {g: sorted(((r[0] is not None, r[0], leaf(r), observed(r)) for r in groups[g]), key=lambda x: (x[0], x[1] or 0, *x[2:])) for g in order}
    trees = {g: tree([m[2] for m in made[g]]) for g in order}
    root, crown = tree([trees[g][0] for g in order])
    out = Counter()
    for g, above in zip(order, crown, strict=True):
        for (_, i, own, seen), below in zip(made[g], trees[g][1], strict=True):
            proof = []
            for run, at in below + above:
                proof += run[:at] + run[at + 1 :]
                seen = brute.sha("".join([*run[:at], seen, *run[at + 1 :]]))
            out[i, own, trees[g][0], root, brute.sha("".join(proof)), seen, seen == root] += 1
    return out


def tampered(row):
    i, *rest, text = row
    cut = i is not None and text is not None and zlib.crc32(str(i).encode()) % 2 == 0
    return leaf((i, *rest, text.replace("\n", "") if cut else text))


def test_whole_table(spark):
    rows = spark.read.parquet(f"{FOLDER}/documents.parquet").select(*MANIFEST_FIELDS).collect()
    got = Counter(map(tuple, QUERIES["op12_merkle_manifest"](spark, FOLDER).collect()))
    assert got == plain([tuple(r) for r in rows], tampered)
    assert {r[-1] for r in got} == {True, False}


def run(docs, fields=("doc_id", "source", "text"), rounds=merkle.ROUNDS):
    text = F.when(F.crc32(F.col("doc_id").cast("string")) % 2 == 0, F.replace("text", F.lit("\n"), F.lit(""))).otherwise(F.col("text"))
    found = merkle.manifest(docs, fields, [text if c == "text" else F.col(c) for c in fields], rounds=rounds)
    return Counter(map(tuple, found.select("id", "leaf", "subroot", "root", F.sha2(F.array_join("proof", ""), 256), "folded_root", "verified").collect()))


SCHEMA = "doc_id long, source string, text string, leaf string, tree int, position int, path string, grp string, id string, count int, root string"


def made(spark, rows):
    return spark.createDataFrame([(*r, "x", 1, 2, "p", "g", "i", 3, "r") for r in rows], SCHEMA).repartition(3)


def test_cases(spark):
    rows = [(1, "a", "x\ny"), (2, "a", None), (3, None, "z"), (4, None, ""), (5, "b", "lone\n"), (None, "a", "no id\n"), (None, "a", "none\n"), (2, "a", None)]
    rows += [(2, "a", "other"), (7, "é", "\n" * 50), (8, "", "long " * 200_000), (2**62, "a", "\n"), (2**62 + 1, "a", "\n\n"), (-3, "Z", "\n")]
    assert run(made(spark, rows)) == plain(rows, tampered)


def test_one_row_and_none(spark):
    assert run(made(spark, [(1, "a", "x")])) == plain([(1, "a", "x")], tampered)
    assert run(made(spark, [])) == Counter()


def test_many_superblocks(spark):
    """Blocks of three: several rounds of blocks of blocks, in one large tree beside small ones and in the tree of trees."""
    rows = [(i, "hot" if i % 3 else f"s{i % 40:02}", f"line\n{i}") for i in range(110)]
    assert run(made(spark, rows), rounds=1) == plain(rows, tampered)


def test_more_leaves_than_a_superblock(spark):
    n = 3**merkle.ROUNDS * 3 + 2
    rows = [(i, "hot", f"{i}\n") for i in range(n)] + [(n + i, f"s{i}", "x") for i in range(3**merkle.ROUNDS + 5)]
    assert run(made(spark, rows)) == plain(rows, tampered)
