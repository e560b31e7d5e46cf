"""Merkle manifest of a table, of which only every second level is stored, with proofs for all rows."""

from __future__ import annotations

from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from cellweave.session import cut_lineage, discard

#: Consecutive nodes under one parent.
ARITY = 16
#: Levels from one stored level to the next.
STEP = 2
#: Nodes of an aligned subtree between two stored levels.
SPAN = ARITY**STEP

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def digest(text: str) -> str:
    return sha256(text.encode()).hexdigest()


def leaf_digest(*fields: Column) -> Column:
    """Digest of the fields, each as its UTF-8 byte count, a colon and its value, or ``-`` for NULL."""
    texts = [f.cast("string") for f in fields]
    return F.sha2(F.concat(*[F.coalesce(F.concat(F.octet_length(t), F.lit(":"), t), F.lit("-")) for t in texts]), 256)


def subtree(nodes: list[str], block: int) -> list[list[str]]:
    """Levels of an aligned subtree from its stored nodes up to the next stored one, which stands alone in the last.

    Only block 0 can be a whole tree, which ends at its root and may be less than ``STEP`` levels high.
    """
    levels = [nodes]
    for _ in range(STEP):
        if block == 0 and len(levels[-1]) == 1:
            break
        below = levels[-1]
        levels.append([digest("".join(below[i : i + ARITY])) for i in range(0, len(below), ARITY)])
    return levels


def siblings(levels: list[list[str]], i: int) -> list[str]:
    """For each level below the last: place in the run and, after a colon, the digests of the run's others."""
    out = []
    for level in levels[:-1]:
        first, at = i - i % ARITY, i % ARITY
        run = level[first : first + ARITY]
        out.append(f"{at}:{''.join(run[:at] + run[at + 1 :])}")
        i //= ARITY
    return out


def fold(leaf: str, path: list[str]) -> str:
    """The root that follows from a leaf and its siblings."""
    for step in path:
        at, others = step.split(":")
        cut = int(at) * 64
        leaf = digest(others[:cut] + leaf + others[cut:])
    return leaf


def proof_digest(path: list[str]) -> str:
    return digest("".join(step.split(":")[1] for step in path))


def numbered(rows: DataFrame, order: str) -> DataFrame:
    """Written ``rows`` with ``pos``, the place within ``tree`` by ``order`` (NULL first), ``digest`` and ``tie``.

    Rows are range-partitioned, so that no tree, however large, is one task's.  Only one tree can go
    on from one partition to the next, so one offset per partition is all that the driver holds.
    """
    keys = [F.col("tree"), F.col(order).asc_nulls_first(), F.col("digest"), F.col("tie")]
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = cut_lineage(rows.repartitionByRange(parts, *keys).withColumn("part", F.spark_partition_id()))
    sizes = ranged.groupBy("part", "tree").agg(F.count("*").alias("n"))
    ends = sizes.groupBy("part").agg(
        F.min(F.struct("tree", "n")).alias("first"), F.max(F.struct("tree", "n")).alias("last")
    )
    offsets, open_tree, so_far = [], None, 0
    for part, first, last in sorted(tuple(r) for r in ends.collect()):
        before = so_far if first["tree"] == open_tree else 0
        if before:
            offsets.append((part, first["tree"], before))
        so_far = last["n"] + (before if last["tree"] == first["tree"] else 0)
        open_tree = last["tree"]
    starts = rows.sparkSession.createDataFrame(offsets, "part int, tree string, before long")
    place = F.row_number().over(Window.partitionBy("part", "tree").orderBy(*keys[1:])) - 1
    out = ranged.withColumn("place", place).join(F.broadcast(starts), ["part", "tree"], "left")
    out = cut_lineage(out.withColumn("pos", F.col("place") + F.coalesce("before", F.lit(0))).drop("part", "place", "before"))
    discard(ranged)
    return out


def stored_levels(leaves: DataFrame) -> list[DataFrame]:
    """``tree, pos, digest`` tables of every ``STEP``-th level above ``leaves``; the last has one node per tree."""

    def top(key: tuple, part: pa.Table) -> pa.Table:
        tree, block = (k.as_py() for k in key)
        nodes = [d for _, d in sorted(zip(part["pos"].to_pylist(), part["digest"].to_pylist(), strict=True))]
        return pa.table({"tree": [tree], "pos": pa.array([block], pa.int64()), "digest": [subtree(nodes, block)[-1][0]]})

    levels = [leaves.select("tree", "pos", "digest")]
    highest = leaves.agg(F.max("pos")).first()[0] or 0
    while highest or len(levels) == 1:
        grouped = levels[-1].groupBy("tree", F.expr(f"pos div {SPAN}").alias("block"))
        levels.append(cut_lineage(grouped.applyInArrow(top, "tree string, pos long, digest string")))
        highest //= SPAN
    return levels


def paths(nodes: DataFrame, above: DataFrame) -> DataFrame:
    """Written ``tree, pos, path, subroot`` of stored nodes, from those of the next stored level, ``above``.

    Each aligned subtree is made anew from its stored nodes, gives its siblings and is forgotten.
    """

    def down(key: tuple, part: pa.Table, over: pa.Table) -> pa.Table:
        block = key[1].as_py()
        found = sorted(zip(part["pos"].to_pylist(), part["digest"].to_pylist(), strict=True))
        rest = over["path"][0].as_py()
        levels = subtree([d for _, d in found], block)
        return pa.table(
            {
                "tree": [key[0].as_py()] * len(found),
                "pos": pa.array([p for p, _ in found], pa.int64()),
                "path": pa.array([siblings(levels, i) + rest for i in range(len(found))], pa.list_(pa.string())),
                "subroot": pa.array([over["subroot"][0].as_py()] * len(found), pa.string()),
            }
        )

    low = nodes.select("tree", "pos", "digest").groupBy("tree", F.expr(f"pos div {SPAN}").alias("block"))
    high = above.groupBy("tree", F.col("pos").alias("block"))
    return cut_lineage(low.cogroup(high).applyInArrow(down, "tree string, pos long, path array<string>, subroot string"))


def top_paths(levels: list[DataFrame], tops: DataFrame) -> DataFrame:
    """Paths of the first stored level above the leaves, from ``tops``, those of the last one."""
    found = tops
    for nodes in reversed(levels[1:-1]):
        over, found = found, paths(nodes, found)
        discard(over)
    return found


def manifest(docs: DataFrame) -> DataFrame:
    """``doc_id, leaf, subroot, root, proof_sha256, folded_root, verified`` for every row of ``docs``.

    A leaf is the digest of a row's ``FIELDS``.  The leaves of a source, by ascending id, make a tree in which
    ``ARITY`` consecutive nodes have one parent; its root is the subroot, and the subroots, by source,
    make the tree of the root.  Of the levels only every ``STEP``-th is stored.  A proof needs
    the others: each aligned subtree of at most ``SPAN`` stored nodes is a group, in which they are computed
    again.  The row's siblings up to the root are digested, and folded with the leaf, of
    which the text is lower-cased first (A-Z) where 5 divides the crc32 of the id.

    A NULL source is a source of its own and comes first, as do NULL ids, which are never tampered with.  Rows of
    equal ids follow each other by their leaf's digest; of equal rows each is a leaf.  NULL and empty texts differ.
    An empty table gives an empty result.  Other columns are ignored.
    """
    text = F.when(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.translate("text", UPPER, LOWER)).otherwise(F.col("text"))
    leaves = cut_lineage(
        docs.select(
            F.coalesce(F.concat(F.lit("="), F.col("source")), F.lit("")).alias("tree"),
            "doc_id",
            leaf_digest(*[F.col(c) for c in FIELDS]).alias("digest"),
            leaf_digest(*[F.col(c) for c in FIELDS[:-1]], text).alias("changed"),
            F.monotonically_increasing_id().alias("tie"),
        ).withColumn("changed", F.when(F.col("changed") != F.col("digest"), F.col("changed")))
    )
    placed = numbered(leaves, "doc_id").drop("tie")
    discard(leaves)
    levels = stored_levels(placed)
    # the trees' roots are the leaves of one more tree
    subroots = levels[-1].select(F.lit("").alias("tree"), F.col("tree").alias("name"), "digest", F.lit(0).alias("tie"))
    heads = numbered(subroots, "name")
    upper = stored_levels(heads)
    found = upper[-1].first()  # one node, or none of an empty table
    root = found["digest"] if found else None
    ends = upper[-1].select("tree", "pos", F.array().cast("array<string>").alias("path"), F.lit(None).cast("string").alias("subroot"))
    of_heads = paths(heads, top_paths(upper, ends))
    tops = heads.select("pos", "name", F.col("digest").alias("subroot")).join(of_heads.select("pos", "path"), "pos")
    tops = cut_lineage(tops.select(F.col("name").alias("tree"), F.lit(0).cast("long").alias("pos"), "path", "subroot"))
    over = top_paths(levels, tops)
    kind = docs.schema["doc_id"].dataType.simpleString()

    def proofs(key: tuple, part: pa.Table, over: pa.Table) -> pa.Table:
        part = part.sort_by("pos")
        rest, subroot = over["path"][0].as_py(), over["subroot"][0].as_py()
        nodes = part["digest"].to_pylist()
        levels = subtree(nodes, key[1].as_py())
        proof, folded = [], []
        for i, (leaf, changed) in enumerate(zip(nodes, part["changed"].to_pylist(), strict=True)):
            path = siblings(levels, i) + rest
            proof.append(proof_digest(path))
            folded.append(fold(changed or leaf, path))
        n = len(nodes)
        return pa.table(
            {
                "doc_id": part["doc_id"],
                "leaf": part["digest"],
                "subroot": [subroot] * n,
                "root": [root] * n,
                "proof_sha256": proof,
                "folded_root": folded,
                "verified": [x == root for x in folded],
            }
        )

    low = placed.groupBy("tree", F.expr(f"pos div {SPAN}").alias("block"))
    high = over.groupBy("tree", F.col("pos").alias("block"))
    return low.cogroup(high).applyInArrow(
        proofs,
        f"doc_id {kind}, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean",
    )
