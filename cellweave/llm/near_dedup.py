"""Near-duplicate documents by min-max hashing, confirmed on whole shingle sets."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cellweave.llm.common import U, distinct_per_row, hot_join, list_column, may_match, mix, random_words, shingles, small_batches, text_parts
from cellweave.operators.components import edge_components
from cellweave.session import cut_lineage, discard

#: Signature values in a band.
ROWS = 6
#: Chance that a pair right at the threshold shares no band.
MISS = 1e-6
#: Bytes of shingle sets that one task compares with each other.
BLOCK_BYTES = 16 << 20
#: Text bytes that one step turns into shingles; a worker holds some 50 times as much, and keeps it after its task.
SKETCH_BYTES = 1 << 18


def bands_for(threshold: float, rows: int = ROWS, miss: float = MISS) -> int:
    """Bands that a pair at ``threshold`` misses with probability ``miss`` at most, made even."""
    n = math.ceil(math.log(miss) / math.log1p(-(threshold**rows)))
    return n + n % 2


def min_max_bands(values: np.ndarray, counts: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """Band hashes per row with values.

    Each permutation is evaluated once and gives two signature values, the smallest and the
    largest image; half of the bands are made of minima, half of maxima.
    """
    starts = np.concatenate([[0], np.cumsum(counts)[:-1]])[counts > 0]
    add, mul = random_words(bands * rows // 2, 31), random_words(bands * rows // 2, 37)
    low = np.zeros((bands // 2, len(starts)), U)
    high = np.zeros((bands // 2, len(starts)), U)
    with np.errstate(over="ignore"):
        for i in range(bands * rows // 2):
            image = (values ^ add[i]) * mul[i]
            image ^= image >> U(29)
            image *= U(0xBF58476D1CE4E5B9)
            low[i // rows] = mix(low[i // rows] + np.minimum.reduceat(image, starts))
            high[i // rows] = mix(high[i // rows] + np.maximum.reduceat(image, starts))
        both = np.concatenate([low, high])
        return mix(both + random_words(bands, 41)[:, None]).T


def _set_keys(values: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """128 bits that name a set of hashes, whatever its order."""
    out = np.zeros((2, len(counts)), U)
    full = counts > 0
    starts = np.concatenate([[0], np.cumsum(counts)[:-1]])[full]
    if len(starts):
        with np.errstate(over="ignore"):
            for i, salt in enumerate(random_words(2, 43)):
                out[i, full] = mix(np.add.reduceat(mix(values + salt), starts))
    return out[0].view(np.int64), out[1].view(np.int64)


def row_keys(id_col: str, text_col: str) -> list[Column]:
    """128 bits that name a row by its id and text; never NULL."""
    pair = [F.col(id_col), F.col(text_col).cast("string")]
    return [F.xxhash64(*pair).alias("row1"), F.xxhash64(F.lit(1), *reversed(pair)).alias("row2")]


def sketch(docs: DataFrame, id_col: str, text_col: str, k: int, bands: int, rows: int = ROWS) -> DataFrame:
    """``id, row1, row2, n_shingles, key1, key2, bands``.

    128 bits that name the row, set size, 128 bits that name the set, and band hashes.
    """
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j, words, counts in text_parts(batch.column(1), SKETCH_BYTES):
                values, sizes = distinct_per_row(*shingles(words, counts, k))
                key1, key2 = _set_keys(values, sizes)
                full = sizes > 0
                hashes = min_max_bands(values, sizes, bands, rows) if full.any() else np.empty((0, bands), U)
                yield pa.RecordBatch.from_arrays(
                    [
                        *[batch.column(c).slice(i, j - i) for c in (0, 2, 3)],
                        pa.array(sizes, pa.int64()),
                        pa.array(key1),
                        pa.array(key2),
                        list_column(hashes.reshape(-1).view(np.int64), full * bands, pa.int64()),
                    ],
                    names=["id", "row1", "row2", "n_shingles", "key1", "key2", "bands"],
                )

    return docs.select(
        F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"), *row_keys(id_col, text_col)
    ).mapInArrow(
        run, f"id {kind}, row1 long, row2 long, n_shingles long, key1 long, key2 long, bands array<long>"
    )


def _sets(members: DataFrame, k: int) -> DataFrame:
    """Whole shingle sets of ``bin, part, comp, node, key2, block, text`` rows, without the text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j, words, counts in text_parts(batch.column(0), SKETCH_BYTES):
                values, sizes = distinct_per_row(*shingles(words, counts, k))
                key1, key2 = _set_keys(values, sizes)
                cols = [batch.column(c).slice(i, j - i) for c in range(1, batch.num_columns)]
                yield pa.RecordBatch.from_arrays(
                    [*cols, pa.array(key1), pa.array(key2), list_column(values.view(np.int64), sizes, pa.int64())],
                    names=["node", "name2", "comp", "blocks", "bin", "key1", "key2", "shingles"],
                )

    return members.select("text", "node", "name2", "comp", "blocks", "bin").mapInArrow(
        run, "node long, name2 long, comp long, blocks int, bin long, key1 long, key2 long, shingles array<long>"
    )


def link_sets(values: np.ndarray, offsets: np.ndarray, num: int, den: int) -> tuple[np.ndarray, np.ndarray]:
    """Edges that span the graph of all pairs of sets with ``den * common >= num * united``.

    Breadth first: a set is compared, as a whole and exactly, with all sets that are not yet
    reached, so a large group costs one pass per member over what is left, and gives one edge per
    member.
    """
    sizes = np.diff(offsets)
    tokens = np.unique(values, return_inverse=True)[1]
    flag = np.zeros(int(tokens.max()) + 1 if len(tokens) else 0, dtype=bool)
    a, b = [], []

    def gather(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        n = sizes[rows]
        starts = np.concatenate([[0], np.cumsum(n)[:-1]])
        return tokens[np.repeat(offsets[rows] - starts, n) + np.arange(n.sum())], starts

    rest = np.argsort(sizes, kind="stable")
    store, starts = gather(rest)
    alive = np.ones(len(rest), dtype=bool)
    queue: list[int] = []
    at = 0
    while True:
        if queue:
            x = queue.pop()
        else:
            while at < len(rest) and not alive[at]:
                at += 1
            if at == len(rest):
                break
            x = int(rest[at])
            alive[at] = False
        left = np.count_nonzero(alive)
        if left == 0:
            break
        if left * 2 < len(rest):
            rest = rest[alive]
            store, starts = gather(rest)
            alive = np.ones(len(rest), dtype=bool)
            at = 0
        mine = tokens[offsets[x] : offsets[x + 1]]
        flag[mine] = True
        # sizes within the threshold of each other: a run, as the sets are ordered by size
        ordered = sizes[rest]
        lo = np.searchsorted(ordered, -(-num * len(mine) // den), "left")
        hi = np.searchsorted(ordered, den * len(mine) // num, "right")
        if hi > lo:
            end = starts[hi] if hi < len(starts) else len(store)
            common = np.add.reduceat(flag[store[starts[lo] : end]].astype(np.int32), starts[lo:hi] - starts[lo])
            united = ordered[lo:hi] + len(mine) - common
            hit = lo + np.flatnonzero((den * common >= num * united) & alive[lo:hi])
            alive[hit] = False
            a += [x] * len(hit)
            b += rest[hit].tolist()
            queue += rest[hit].tolist()
        flag[mine] = False
    return np.array(a, np.int64), np.array(b, np.int64)


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    k: int = 5,
    num: int = 80,
    den: int = 100,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """``id, n_shingles, component_id, kept, row1, row2, chosen`` for every row of ``docs``.

    Documents whose sets of ``k``-word shingles have a Jaccard similarity of ``num / den`` or more
    are linked; ``component_id`` is the smallest id that links reach.  ``row1, row2`` name the row by
    id and text; ``chosen`` is true for one such name per group, of a row with the smallest id.

    1. Every text becomes a set of shingle hashes, of which min-max hashing makes band hashes.
       Equal sets form one class, so copies cost one row each from here on.
    2. Classes that share a band hash with the first class of its bucket become a candidate group
       (one row per class and bucket, never pairs).
    3. The groups' whole sets are compared exactly. Small groups share a task; a group whose sets
       pass ``block_bytes`` is cut into blocks, and every pair of blocks is a task of bounded size.
       Tasks return the edges of a spanning forest.
    4. Components of these edges give the answer.

    NULL, empty or white-space texts have no shingles and stand alone.  Texts of fewer than ``k``
    words are one shingle.  Repeated rows are copies.  A row with a NULL id is kept in the sense
    of ``id <=> component_id``.  An empty table gives an empty result; other columns are ignored.
    """
    small_batches(docs.sparkSession)
    bands = bands_for(num / den)
    marks = cut_lineage(sketch(docs, id_col, text_col, k, bands))
    best = F.min(F.struct(F.col("id").isNull().alias("none"), "id", "row1", "row2"))
    classes = cut_lineage(
        marks.where("n_shingles > 0")
        .groupBy(F.col("key1").alias("node"), "key2")
        .agg(best.alias("rep"), F.first("n_shingles").alias("n"), F.count("*").alias("copies"), F.first("bands").alias("bands"))
    )
    # what is needed of a row from here on, without its band hashes
    ids = cut_lineage(marks.select("id", "row1", "row2", "n_shingles", F.col("key1").alias("node")))
    discard(marks)
    total = ids.count()
    buckets = classes.select("node", F.posexplode("bands").alias("band", "bucket")).select(
        "node", F.xxhash64("band", "bucket").alias("bucket")
    )
    buckets = cut_lineage(buckets)
    heads = buckets.groupBy("bucket").agg(F.min("node").alias("head"), F.count("*").alias("size")).where("size > 1")
    stars = cut_lineage(
        hot_join(buckets, heads, "bucket", "size", buckets.count())
        .where("node <> head")
        .select(F.col("head").alias("a"), F.col("node").alias("b"))
        .distinct()
    )
    discard(buckets)
    found = edge_components(stars)
    labels = None
    if found is not None:
        edges = _confirm(docs, classes, found[0], id_col, text_col, k, num, den, block_bytes)
        linked = edge_components(edges)
        discard(edges)
        if linked is not None:
            labels = linked[0]
    discard(stars)
    if labels is None:
        named = classes.select("node", F.col("rep").alias("first"), "copies")
    else:
        roots = classes.join(labels.select(F.col("a").alias("node"), "p"), "node", "left").withColumn(
            "p", F.coalesce("p", "node")
        )
        roots = cut_lineage(roots.select("node", "p", "rep", "copies"))
        discard(classes)
        firsts = roots.groupBy("p").agg(F.min("rep").alias("first"), F.count("*").alias("of_root"))
        named = hot_join(roots, firsts, "p", "of_root", roots.count()).select("node", "first", "copies")
    full = hot_join(ids.where("n_shingles > 0"), named, "node", "copies", total).select(
        "id",
        "row1",
        "row2",
        "n_shingles",
        F.col("first.id").alias("component_id"),
        ((F.col("row1") == F.col("first.row1")) & (F.col("row2") == F.col("first.row2"))).alias("chosen"),
    )
    alone = ids.where("n_shingles = 0").select(
        "id", "row1", "row2", "n_shingles", F.col("id").alias("component_id"), F.lit(True).alias("chosen")
    )
    both = full.unionByName(alone).withColumn("kept", F.col("id").eqNullSafe(F.col("component_id")))
    return both.select("id", "n_shingles", "component_id", "kept", "row1", "row2", "chosen")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """One row of each group of near duplicates, all columns: one with the smallest id.

    Of rows with equal id and text one stays.  Of a group without ids one stays as well, the first by its
    text's hash.  Texts without words are no duplicates of others, only of repetitions of the same row.

    Rows that stay are not moved, as far as a filter of at most ``MAX_BUCKETS`` numbers can tell them;
    repeated rows are combined before the others move.
    """
    marks = near_duplicates(docs, id_col, text_col, **options)
    names = marks.groupBy("row1", "row2").agg(F.max("chosen").alias("stays"), F.count("*").alias("n"))
    touched = cut_lineage(names.where("not stays or n > 1").select("row1", "row2", "stays"))
    rows = docs.select(*row_keys(id_col, text_col), F.struct("*").alias("row"))
    rows, flag = may_match(rows, F.col("row1"), touched, "row1", touched.count())
    moved = rows.where(F.col(flag).isNotNull()).groupBy("row1", "row2").agg(F.first("row").alias("row"))
    moved = moved.join(touched, ["row1", "row2"], "left").where(F.coalesce("stays", F.lit(True))).select("row")
    out = rows.where(F.col(flag).isNull()).select("row").unionByName(moved)
    return out.select(*[F.col("row").getField(c).alias(c) for c in docs.columns])


def _confirm(
    docs: DataFrame, classes: DataFrame, groups: DataFrame, id_col: str, text_col: str, k: int, num: int, den: int, block_bytes: int
) -> DataFrame:
    """Written edges ``a, b`` between classes of a candidate group whose whole sets are similar enough."""
    members = classes.join(groups.select(F.col("a").alias("node"), F.col("p").alias("comp")), "node").select(
        "node", "key2", F.col("rep.row1").alias("rep1"), F.col("rep.row2").alias("rep2"), "n", "comp"
    )
    members = cut_lineage(members)
    n_members = members.count()
    sizes = members.groupBy("comp").agg(
        F.ceil(F.sum(F.col("n") * 8) / F.lit(block_bytes)).cast("int").alias("blocks"), F.count("*").alias("of_comp")
    )
    bins = max(1, -(-(members.agg(F.sum("n")).first()[0] or 0) * 8 // block_bytes))
    placed = hot_join(members, sizes, "comp", "of_comp", n_members).select(
        "rep1",
        "rep2",
        F.col("key2").alias("name2"),
        "node",
        "comp",
        "blocks",
        F.when(F.col("blocks") == 1, F.pmod(F.xxhash64("comp"), F.lit(4 * bins))).otherwise(F.col("comp")).alias("bin"),
    )
    # one text of each class moves; repeated rows are combined before
    texts = docs.select(*row_keys(id_col, text_col), F.col(text_col).cast("string").alias("text"))
    texts, flag = may_match(texts, F.col("row1"), members, "rep1", n_members)
    texts = texts.where(F.col(flag).isNotNull()).groupBy("row1", "row2").agg(F.first("text").alias("text"))
    sets = _sets(texts.join(placed, (F.col("row1") == F.col("rep1")) & (F.col("row2") == F.col("rep2"))), k)
    sets = sets.where("node = key1 and name2 = key2").drop("key1", "name2", "key2")
    mine = F.pmod(F.xxhash64("node"), F.col("blocks"))
    tasks = sets.withColumn("mine", mine).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        "bin", "blocks", F.least("mine", "other").alias("i"), F.greatest("mine", "other").alias("j"), "comp", "node", "shingles"
    )

    def confirm(part: pa.Table) -> pa.Table:
        comp = part["comp"].to_numpy()
        nodes = part["node"].to_numpy()
        column = part["shingles"].combine_chunks()
        column = column.chunk(0) if isinstance(column, pa.ChunkedArray) else column
        offsets = column.offsets.to_numpy().astype(np.int64)
        values = column.values.to_numpy()
        order = np.lexsort((nodes, comp))
        cuts = np.flatnonzero(np.diff(comp[order])) + 1
        a, b = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
        for group in np.split(order, cuts):
            group = group[np.concatenate([[True], np.diff(nodes[group]) != 0])]  # rows of a repeated id
            if len(group) < 2:
                continue
            n = offsets[group + 1] - offsets[group]
            to = np.concatenate([[0], np.cumsum(n)])
            own = values[np.repeat(offsets[group] - to[:-1], n) + np.arange(to[-1])]
            x, y = link_sets(own, to, num, den)
            a.append(nodes[group[x]])
            b.append(nodes[group[y]])
        return pa.table({"a": np.concatenate(a), "b": np.concatenate(b)})

    edges = cut_lineage(tasks.groupBy("bin", "blocks", "i", "j").applyInArrow(confirm, "a long, b long"))
    discard(members)
    return edges
