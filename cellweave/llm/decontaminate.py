"""Benchmark decontamination by greedy string tiling."""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellweave.llm.common import U, list_column, mix, small_batches, text_parts
from cellweave.session import cut_lineage

#: Tokens of the shortest tile.
MIN_MATCH = 5
#: Share of an item's tokens that tiles must cover.
THRESHOLD = 0.8
#: Item tokens that are sent to the executors at once.
BLOCK_TOKENS = 1_000_000

MATCH = "array<struct<item: long, coverage: double, matched: int, tokens: int, tiles: int>>"
_BASE = 0xD1B54A32D192ED03


def windows(tokens: np.ndarray, length: int) -> np.ndarray:
    """Running Karp-Rabin hashes of all windows: one step per token, from prefix sums of a polynomial."""
    n = len(tokens)
    if n < length:
        return np.empty(0, U)
    with np.errstate(over="ignore"):
        up, down = np.full(n, _BASE, U), np.full(n, pow(_BASE, -1, 1 << 64), U)
        up[0] = down[0] = 1
        power, inverse = np.multiply.accumulate(up), np.multiply.accumulate(down)
        sums = np.concatenate([np.zeros(1, U), np.cumsum(tokens * power)])
        return mix((sums[length:] - sums[: n - length + 1]) * inverse[: n - length + 1])


def runs(at_text: np.ndarray, at_item: np.ndarray, length: int) -> list[tuple[int, int, int]]:
    """Seeds on one diagonal that follow each other grow to maximal matches ``text, item, length``."""
    diagonal = at_text - at_item
    order = np.lexsort((at_text, diagonal))
    d, p = diagonal[order], at_text[order]
    first = np.concatenate([[True], (d[1:] != d[:-1]) | (p[1:] != p[:-1] + 1)])
    start = np.flatnonzero(first)
    n = np.diff(np.concatenate([start, [len(p)]]))
    return [(a, a - b, m + length - 1) for a, b, m in zip(p[start].tolist(), d[start].tolist(), n.tolist(), strict=True)]


def tile(matches: list[tuple[int, int, int]], item_tokens: int, min_match: int) -> list[tuple[int, int, int]]:
    """Greedy tiles ``text, item, length``: the longest match free of marks is marked, again and again.

    A match that meets marks is cut to what lies between them; pieces of ``min_match`` tokens or
    more wait for their turn.  Ties go to the first in the text, then in the item.
    """
    heap = [(-n, a, b) for a, b, n in matches]
    heapq.heapify(heap)
    item_marks = np.zeros(item_tokens, bool)
    text_marks: set[int] = set()
    tiles = []
    while heap:
        n, a, b = heapq.heappop(heap)
        n = -n
        free = [not item_marks[b + i] and a + i not in text_marks for i in range(n)]
        if all(free):
            item_marks[b : b + n] = True
            text_marks.update(range(a, a + n))
            tiles.append((a, b, n))
            continue
        i = 0
        while i < n:
            j = i
            while j < n and free[j]:
                j += 1
            if j - i >= min_match:
                heapq.heappush(heap, (i - j, a + i, b + i))
            i = j + 1
    return tiles


class Items:
    """Token hashes of a block of items, with their seeds in order."""

    def __init__(self, ids: list[int | None], tokens: list[np.ndarray], min_match: int):
        self.ids, self.sizes, self.min_match = ids, [len(t) for t in tokens], min_match
        seeds = [windows(t, min_match) for t in tokens]
        n = [len(s) for s in seeds]
        key = np.concatenate([*seeds, np.empty(0, U)])
        order = np.argsort(key, kind="stable")
        self.seed = key[order]
        self.item = np.repeat(np.arange(len(n)), n)[order]
        self.place = np.concatenate([*(np.arange(m) for m in n), np.empty(0, np.int64)]).astype(np.int64)[order]
        self.maybe = np.zeros(1 << 20, bool)
        self.maybe[self.seed >> U(44)] = True

    def match(self, tokens: np.ndarray, threshold: float, hashes: np.ndarray | None = None) -> list[tuple]:
        """Items of which tiles cover ``threshold`` or more in this text."""
        key = windows(tokens, self.min_match) if hashes is None else hashes
        where = np.flatnonzero(self.maybe[key >> U(44)])
        lo = np.searchsorted(self.seed, key[where], "left")
        n = np.searchsorted(self.seed, key[where], "right") - lo
        if not n.any():
            return []
        starts = np.cumsum(n) - n
        at = np.repeat(lo - starts, n) + np.arange(n.sum())
        text, item, place = np.repeat(where, n), self.item[at], self.place[at]
        order = np.argsort(item, kind="stable")
        out = []
        for group in np.split(order, np.flatnonzero(np.diff(item[order])) + 1):
            i = int(item[group[0]])
            size = self.sizes[i]
            covered = np.zeros(size + 1, np.int64)  # what any tiles could cover at most
            np.add.at(covered, place[group], 1)
            np.add.at(covered, place[group] + self.min_match, -1)
            if np.count_nonzero(np.cumsum(covered)[:size]) < threshold * size:
                continue
            tiles = tile(runs(text[group], place[group], self.min_match), size, self.min_match)
            matched = sum(t[2] for t in tiles)
            if matched >= threshold * size:
                out.append((self.ids[i], matched / size, matched, size, len(tiles)))
        return out


def item_tokens(items: DataFrame, item_col: str, text_col: str) -> DataFrame:
    """``id, tokens``: hashes of every item's words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j, words, counts in text_parts(batch.column(1)):
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(i, j - i), list_column(words.view(np.int64), counts, pa.int64())], names=["id", "tokens"]
                )

    rows = items.select(F.col(item_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, "id long, tokens array<long>")


def matches(
    docs: DataFrame,
    items: DataFrame,
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    min_match: int = MIN_MATCH,
    threshold: float = THRESHOLD,
    block_tokens: int = BLOCK_TOKENS,
    into: str = "matches",
) -> DataFrame:
    """``docs`` with the column ``into``: the items found in each text, their coverage and number of tiles.

    Windows of ``min_match`` words that text and item share are seeds; seeds grow to matches, and
    the longest matches are marked as tiles until none of ``min_match`` words is free.  An item is
    found when tiles cover ``threshold`` of its words, in whatever order they stand in the text.

    Items are few next to documents but without a known bound, so their words are counted and sent
    in blocks of about ``block_tokens``; each block is one more column over the same scan.
    Texts are read whole and each on its own, so nothing is shuffled.  NULL and empty texts and
    items, and items of fewer than ``min_match`` words, match nothing.  Repeated documents and
    items are matched each.  An empty table on either side gives no match.
    """
    small_batches(docs.sparkSession)
    tokens = cut_lineage(item_tokens(items, item_col, item_text_col).where(F.size("tokens") >= min_match))
    total = tokens.agg(F.sum(F.size("tokens"))).first()[0] or 0
    blocks = max(1, -(-total // block_tokens))
    tokens = tokens.withColumn("block", F.pmod(F.xxhash64("id", "tokens"), F.lit(blocks)))
    out, parts = docs, []
    for block in range(blocks):
        rows = tokens.where(F.col("block") == block).orderBy("id", "tokens").collect()
        sent = docs.sparkSession.sparkContext.broadcast(
            ([r["id"] for r in rows], [np.array(r["tokens"], np.int64).view(U) for r in rows])
        )
        parts.append(_finder(sent, min_match, threshold)(F.col(text_col).cast("string")))
    return out.withColumn(into, F.concat(*parts) if len(parts) > 1 else parts[0])


def _finder(sent, min_match: int, threshold: float):
    state: list[Items] = []

    def run(texts: pa.Array) -> pa.Array:
        if not state:
            state.append(Items(*sent.value, min_match))
        items, found, sizes = state[0], [], []
        for _, _, words, counts in text_parts(texts):
            ends = np.cumsum(counts)
            key = windows(words, min_match)
            hot = np.flatnonzero(items.maybe[key >> U(44)])
            hot = hot[np.isin(key[hot], items.seed)]
            rows = np.searchsorted(ends, hot, "right")
            touched = set(rows[hot + min_match <= ends[rows]].tolist())
            for r, (end, n) in enumerate(zip(ends.tolist(), counts.tolist(), strict=True)):
                some = items.match(words[end - n : end], threshold, key[end - n : max(end - n, end - min_match + 1)]) if r in touched else []
                sizes.append(len(some))
                found += some
        columns = [list(c) for c in zip(*found, strict=True)] if found else [[]] * 5
        kinds = (pa.int64(), pa.float64(), pa.int32(), pa.int32(), pa.int32())
        structs = pa.StructArray.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["item", "coverage", "matched", "tokens", "tiles"]
        )
        offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
        return pa.ListArray.from_arrays(pa.array(offsets), structs)

    return F.arrow_udf(run, MATCH)
