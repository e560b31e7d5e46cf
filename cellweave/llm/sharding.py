"""Shards by a consistent-hash ring with virtual nodes and bounded loads."""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cellweave.session import cut_lineage

#: The ring is divided into this many cells, of 2**48 hash values each.
CELLS = 1 << 16
#: Places of a shard on the ring.
VIRTUAL_NODES = 64
#: Rows that one task ranks, about.
UNIT_ROWS = 50_000


def ring(docs: DataFrame, shards: int, virtual_nodes: int) -> list[int]:
    """The shard that owns each virtual node, in ring order, as ``(cell, shard)`` of bounded number."""
    nodes = docs.sparkSession.range(shards * virtual_nodes).select(
        F.shiftrightunsigned(F.xxhash64(F.lit("node"), (F.col("id") / virtual_nodes).cast("int"), F.col("id") % virtual_nodes), 48).alias("cell"),
        (F.col("id") / virtual_nodes).cast("int").alias("shard"),
    )
    return [(r["cell"], r["shard"]) for r in nodes.orderBy("cell", "shard").collect()]


def walk(loads: Sequence[int], owners: Sequence[int], capacity: Sequence[int]) -> list[tuple[int, int, int, int, int]]:
    """Pieces ``arc, start, rows, shard, slot``: where the rows of every arc go.

    Every arc first offers its rows to the shard at its end.  What a full shard cannot take
    continues to the next virtual node clockwise, and so on.  There are at most as many pieces as
    arcs and shards together, and all that this sees is one count per arc.
    """
    n = len(owners)
    room, used = list(capacity), [0] * len(capacity)
    pieces, waiting = [], [(arc, 0, rows) for arc, rows in enumerate(loads) if rows]
    for step in range(n):
        left = []
        for arc, start, rows in waiting:
            shard = owners[(arc + step) % n]
            took = min(rows, room[shard])
            if took:
                pieces.append((arc, start, took, shard, used[shard]))
                room[shard] -= took
                used[shard] += took
            if took < rows:
                left.append((arc, start + took, rows - took))
        waiting = left
        if not waiting:
            return pieces
    if waiting:
        raise ValueError("the shards have less room than there are rows")
    return pieces


def capacities(rows: int, shards: int, slack: float) -> list[int]:
    """Rows that each shard may hold: with slack 0 the mean, so counts differ by one at most."""
    if slack > 0:
        return [-int(-rows * (1 + slack) // shards)] * shards
    return [rows // shards + (s < rows % shards) for s in range(shards)]


def shard_documents(
    docs: DataFrame,
    shards: int = 40,
    id_col: str = "doc_id",
    text_col: str = "text",
    slack: float = 0.0,
    virtual_nodes: int = VIRTUAL_NODES,
    unit_rows: int = UNIT_ROWS,
) -> DataFrame:
    """``id, size, text_crc32, shard, slot`` for every row.

    A row's place on the ring is the hash of its text, so equal texts stand together; they are put
    into one shard unless it is full, whose overflow continues clockwise.  ``slack`` bounds the
    load: no shard holds more than ``(1 + slack)`` times the mean; 0 makes counts at most one apart.
    ``slot`` numbers a shard's rows from 0 without gaps.

    NULL texts count no bytes and share one place (their ``text_crc32`` is NULL).  Rows with equal
    ids or wholly equal rows all get a slot of their own; which of them gets which is open.  A cell
    of the ring with many rows, such as those of one text, is split by a hash of the id, so no task
    ranks more than about ``unit_rows``.  An empty table gives an empty result.
    """
    rows = cut_lineage(
        docs.select(
            F.col(id_col).alias("id"),
            (F.coalesce(F.octet_length(F.col(text_col).cast("string")), F.lit(0)) + 16).cast("long").alias("size"),
            F.crc32(F.col(text_col).cast("binary")).alias("text_crc32"),
            F.xxhash64(F.col(text_col).cast("string")).alias("point"),
        )
    )
    cell = F.shiftrightunsigned("point", 48).cast("int")
    nodes = ring(docs, shards, virtual_nodes)
    # a cell belongs to the first node at or after it; past the last one, to the first of the ring
    ends = F.lit(json.dumps([c for c, _ in nodes]))
    by_cell = (
        docs.sparkSession.range(1)
        .select(F.posexplode(F.from_json(ends, "array<int>")).alias("arc", "end"))
        .withColumn("from", F.coalesce(F.lag("end").over(Window.orderBy("arc")) + 1, F.lit(0)))
        .where("from <= end")
        .select("arc", F.explode(F.sequence("from", "end")).alias("cell"))
    )
    last = nodes[-1][0]
    if last + 1 < CELLS:
        by_cell = by_cell.unionByName(
            docs.sparkSession.range(last + 1, CELLS).select(F.lit(0).alias("arc"), F.col("id").cast("int").alias("cell"))
        )
    counted = rows.groupBy(cell.alias("cell")).count()  # one row per cell of the ring at most
    cells = cut_lineage(
        counted.join(F.broadcast(by_cell), "cell").select(
            "cell", "arc", "count", F.ceil(F.col("count") / unit_rows).cast("int").alias("salts")
        )
    )
    loads = {r["arc"]: r["rows"] for r in cells.groupBy("arc").agg(F.sum("count").alias("rows")).collect()}
    pieces = walk(
        [loads.get(a, 0) for a in range(len(nodes))], [s for _, s in nodes], capacities(sum(loads.values()), shards, slack)
    )
    salt = F.when(F.col("salts") > 1, F.pmod(F.xxhash64("id"), F.col("salts"))).otherwise(F.lit(0)).cast("int")
    units = rows.withColumn("cell", cell).join(F.broadcast(cells), "cell").withColumn("salt", salt)
    # cells after the last node come before those of the ring's start on arc 0
    order = F.when(F.col("cell") > last, F.col("cell") - CELLS).otherwise(F.col("cell"))
    before = (
        units.groupBy("arc", "cell", "salt")
        .agg(F.count("*").alias("n"))
        .select(
            F.col("cell").alias("u_cell"),
            F.col("salt").alias("u_salt"),
            (F.sum("n").over(Window.partitionBy("arc").orderBy(order, "salt")) - F.col("n")).alias("before"),
        )
    )
    ranked = units.withColumn("rank", F.row_number().over(Window.partitionBy("cell", "salt").orderBy("point", "id", "size")) - 1)
    placed = ranked.join(before, (F.col("cell") == F.col("u_cell")) & (F.col("salt") == F.col("u_salt")))
    where = docs.sparkSession.range(1).select(
        F.explode(F.from_json(F.lit(json.dumps(pieces)), "array<array<long>>")).alias("p")
    )
    where = where.select(*[F.col("p")[i].alias(name) for i, name in enumerate(("p_arc", "start", "rows", "shard", "base"))])
    at = F.col("before") + F.col("rank")
    return placed.join(
        F.broadcast(where), (F.col("arc") == F.col("p_arc")) & (at >= F.col("start")) & (at < F.col("start") + F.col("rows"))
    ).select("id", "size", "text_crc32", F.col("shard").cast("int").alias("shard"), (F.col("base") + at - F.col("start")).alias("slot"))
