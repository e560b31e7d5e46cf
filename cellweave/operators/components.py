"""Connected regions of a raster mask (4 neighbours), as joins and aggregates."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cellweave.operators.geometry import BLOCK
from cellweave.session import cut_lineage, sized_join

col, lit = F.col, F.lit

#: a contracted graph counted to have at most this many edges is finished in one step
FINISH_EDGES = 50_000


def _runs(mask: DataFrame, keys: list[str]) -> DataFrame:
    """Cells with the first column ``c0`` of their horizontal run."""
    w = Window.partitionBy(*keys, "r").orderBy("c")
    return (
        mask.select(*keys, "r", "c")
        .withColumn("__g", col("c") - F.row_number().over(w))
        .withColumn("c0", F.min("c").over(Window.partitionBy(*keys, "r", "__g")))
        .withColumn("node", col("r").cast("long") * lit(1 << 31) + col("c0"))
        .drop("__g")
    )


def _run_edges(runs: DataFrame, keys: list[str]) -> DataFrame:
    """Pairs of runs in neighbouring rows that overlap; they meet through column blocks."""
    blocked = runs.withColumn(
        "blk", F.explode(F.sequence(F.floor(col("c0") / BLOCK).cast("int"), F.floor(col("c1") / BLOCK).cast("int")))
    )
    below = blocked.select(
        *keys, (col("r") - 1).alias("r"), "blk", col("c0").alias("d0"), col("c1").alias("d1"), col("node").alias("b")
    )
    return (
        blocked.join(below, [*keys, "r", "blk"])
        .where((col("c0") <= col("d1")) & (col("d0") <= col("c1")))
        .select(*keys, col("node").alias("a"), "b")
        .distinct()
    )


def _contract(edges: DataFrame, keys: list[str]) -> DataFrame:
    """Each node of the graph points to the neighbour with the smallest hash, or to itself."""
    both = edges.unionByName(edges.select(*keys, col("b").alias("a"), col("a").alias("b")))
    rank = lambda c: F.struct(F.xxhash64(col(c)).alias("h"), col(c).alias("v"))
    best = both.groupBy(*keys, "a").agg(F.min(rank("b")).alias("m"))
    return best.select(*keys, "a", F.least(col("m"), rank("a"))["v"].alias("p"))


def _settle(edges: DataFrame, keys: list[str]) -> DataFrame:
    """Roots of a graph of bounded size, one small table per key."""

    def roots(pdf: pd.DataFrame) -> pd.DataFrame:
        nodes, at = np.unique(pdf[["a", "b"]].to_numpy(), return_inverse=True)
        a, b = at.reshape(-1, 2).T
        label = np.arange(len(nodes))
        while True:
            low = np.minimum(label[a], label[b])
            new = label.copy()
            np.minimum.at(new, a, low)
            np.minimum.at(new, b, low)
            new = new[new]
            if np.array_equal(new, label):
                break
            label = new
        out = pd.DataFrame({"a": nodes, "p": nodes[label]})
        for k in keys:
            out[k] = pdf[k].iloc[0]
        return out[[*keys, "a", "p"]]

    schema = edges.select(*keys, "a", col("a").alias("p")).schema
    return edges.groupBy(*keys).applyInPandas(roots, schema)


def edge_components(
    edges: DataFrame, keys: Sequence[str] = (), max_rounds: int = 64, finish_edges: int = FINISH_EDGES
) -> tuple[DataFrame, int] | None:
    """``keys, a, p``: the root of every node of an undirected graph of pairs ``a, b``, and a bound of its rows.

    Every node joins its smallest-hash neighbour and the graph is rebuilt on the survivors, which
    shrinks it by a constant factor per round, so rounds grow with log(size) and not with the
    diameter.  ``edges`` should be a written table.  None for a graph without edges.
    """
    keys = list(keys)
    parents = []
    for _ in range(max_rounds):
        n = edges.count()
        if n == 0:
            break
        if n <= finish_edges:
            parents.append((cut_lineage(_settle(edges, keys)), 2 * n))
            break
        parent = cut_lineage(_contract(edges, keys))
        parents.append((parent, 2 * n))
        pa = parent.select(*keys, "a", col("p").alias("x"))
        pb = parent.select(*keys, col("a").alias("b"), col("p").alias("y"))
        moved = sized_join(
            sized_join(edges, pa, [*keys, "a"], bound=2 * n), pb, [*keys, "b"], bound=2 * n
        )
        edges = cut_lineage(
            moved.where(col("x") != col("y"))
            .select(*keys, F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"))
            .distinct()
        )
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    if not parents:
        return None
    label, size = parents[-1]
    for parent, above in reversed(parents[:-1]):
        upper = label.select(*keys, col("a").alias("p"), col("p").alias("q"))
        label = sized_join(parent, upper, [*keys, "p"], "left", bound=size).select(
            *keys, "a", F.coalesce("q", "p").alias("p")
        )
        size = above
    return label, size


def connected_components(
    mask: DataFrame, keys: Sequence[str] = (), max_rounds: int = 64, finish_edges: int = FINISH_EDGES
) -> DataFrame:
    """``keys, r, c, component`` for every row of ``mask`` (cells that are on).

    Cells first fold into horizontal runs, whose graph ``edge_components`` contracts.
    A component is named by its smallest (row, first column) run.
    """
    keys = list(keys)
    cells = _runs(mask, keys)
    runs = cut_lineage(cells.groupBy(*keys, "r", "c0", "node").agg(F.max("c").alias("c1")))
    edges = cut_lineage(_run_edges(runs, keys))
    found = edge_components(edges, keys, max_rounds, finish_edges)
    if found is None:
        return cells.select(*keys, "r", "c", col("node").alias("component"))
    label, size = found
    names = label.groupBy(*keys, "p").agg(F.least(F.min("a"), col("p")).alias("component"))
    label = sized_join(label, names, [*keys, "p"], bound=size).select(*keys, col("a").alias("node"), "component")
    return sized_join(cells, label, [*keys, "node"], "left", bound=size).select(
        *keys, "r", "c", F.coalesce("component", "node").alias("component")
    )


def component_sizes(labelled: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    return labelled.groupBy(*keys, "component").agg(F.count("*").alias("size"))
