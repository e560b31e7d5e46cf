"""Whitening of embeddings from the covariance of distinct vectors, weighted by how often each occurs."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cellweave.llm.common import hot_join
from cellweave.session import cut_lineage

#: Steps per unit of an entry, and what is added so that whole numbers are positive.
SCALE, SHIFT = 64, 1_000_000
#: Components at most.
COMPONENTS = 32
#: Rows of vectors in one matrix.
STEP_ROWS = 4096
#: Share of the variance below which a direction counts as empty.
EMPTY = 1e-12


def whole_numbers(vector: Column) -> Column:
    """Entries as whole numbers."""
    return F.transform(vector.cast("array<double>"), lambda c: F.floor(c * SCALE).cast("long") + F.lit(SHIFT).cast("long"))


def usable(vector: Column) -> Column:
    """True for vectors that are not NULL and hold only finite numbers."""
    wrong = F.exists(vector, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == F.lit(float("inf"))))
    return F.coalesce(vector.isNotNull() & ~wrong, F.lit(False))


def matrices(column: pa.Array, *others: pa.Array) -> Iterator[tuple[np.ndarray, ...]]:
    """Equally long vectors as matrices of at most ``STEP_ROWS`` rows, with the matching parts of other columns."""
    for at in range(0, len(column), STEP_ROWS):
        part = column.slice(at, STEP_ROWS)
        yield part.flatten().to_numpy(zero_copy_only=False).reshape(len(part), -1), *[
            o.slice(at, STEP_ROWS).to_numpy(zero_copy_only=False) for o in others
        ]


def weighted_sum(vectors: DataFrame, terms) -> np.ndarray:
    """The sum over partitions of the matrix that ``terms(x, weights)`` adds up; ``vectors`` is ``x, n``.

    Partial sums meet in a shuffle, entry by entry; the driver gets one matrix of the vectors' width.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            for x, n in matrices(batch.column(0), batch.column(1)):
                part = np.atleast_2d(terms(x, n))
                total = part if total is None else total + part
        if total is not None:
            kind = pa.from_numpy_dtype(total.dtype)
            yield pa.RecordBatch.from_arrays([pa.array(range(len(total)), pa.int32()), pa.array(list(total), pa.list_(kind))], names=["i", "row"])

    kind = "long" if np.issubdtype(np.asarray(terms(np.ones((1, 1), np.int64), np.ones(1, np.int64))).dtype, np.integer) else "double"
    parts = vectors.select("x", "n").mapInArrow(run, f"i int, row array<{kind}>")
    sums = parts.select("i", F.posexplode("row").alias("j", "v")).groupBy("i", "j").agg(F.sum("v").alias("v")).toPandas()
    out = np.zeros((sums["i"].max() + 1, sums["j"].max() + 1), np.int64 if kind == "long" else float)
    out[sums["i"], sums["j"]] = sums["v"]
    return out


def centred(x: np.ndarray, total: np.ndarray, n: int) -> np.ndarray:
    """``x - total / n``, from an exact whole numerator."""
    return (x * np.int64(n) - total) / n


def whiten(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """``id, component, n, deviation, whitened, explained, identity_error`` for every usable row and component.

    1. Vectors become whole numbers, and equal ones one row with their count, which is their weight.
    2. Weighted sums, exact, and then the weighted product of the centred vectors, both added up by partition, give mean and
       covariance; the driver finds the eigenvectors of this one matrix.
    3. The distinct vectors' projections give the covariance that they really have, and so ``identity_error``.
    4. Each distinct vector is projected once, and its answer joined back to its rows, of which a third or more may be equal.

    Rows go whose vector is NULL or holds an entry that is NULL or not finite.  Repeated rows and ids, NULL ids included, each get their
    answer.  Vectors of different lengths are an error, as they have no common covariance.  Directions without variance cannot
    be whitened and are left out, so equal vectors alone, empty vectors and an empty table give an empty result; components number up to the
    smaller of ``components`` and the width.  ``deviation`` is exact, and NULL where it passes 64 bits.  Other columns are ignored.
    """
    kind = rows.schema[id_col].dataType.simpleString()
    schema = f"id {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    spark = rows.sparkSession
    used = rows.where(usable(F.col(vector_col))).select(F.col(id_col).alias("id"), whole_numbers(F.col(vector_col)).alias("x"))
    key = F.concat(F.hex(F.xxhash64("x")), F.lit("-"), F.hex(F.xxhash64(F.lit(1), F.reverse("x"))))
    used = used.select("id", key.alias("key"), "x")
    vectors = cut_lineage(used.groupBy("key").agg(F.first("x").alias("x"), F.count("*").alias("n")))
    shape = vectors.agg(F.sum("n"), F.min(F.size("x")), F.max(F.size("x"))).first()
    n, width = shape[0] or 0, shape[2] or 0
    if n and shape[1] != width:
        raise ValueError(f"vectors of {shape[1]} and of {width} entries")
    if not width:
        return spark.createDataFrame([], schema)

    total = weighted_sum(vectors, lambda x, w: (x * w[:, None]).sum(axis=0))[0]

    def product(x: np.ndarray, w: np.ndarray) -> np.ndarray:
        c = centred(x, total, n) if len(x[0]) == width else x.astype(float)
        return (c * w[:, None]).T @ c

    covariance = weighted_sum(vectors, product) / n
    values, axes = np.linalg.eigh(covariance)
    values, axes = values[::-1], axes[:, ::-1]
    trace = float(np.trace(covariance))
    count = int(np.count_nonzero(values[:components] > EMPTY * trace)) if trace > 0 else 0
    if not count:
        return spark.createDataFrame([], schema)
    projection = axes[:, :count] / np.sqrt(values[:count])
    explained = values[:count] / trace

    def check(x: np.ndarray, w: np.ndarray) -> np.ndarray:
        y = centred(x, total, n) @ projection if len(x[0]) == width else x.astype(float)
        return np.vstack([(y * w[:, None]).T @ y, w @ y])

    seen = weighted_sum(vectors, check) / n
    mean = seen[count]
    error = float(np.abs(seen[:count] - np.outer(mean, mean) - np.eye(count)).max())

    def deviations(x: np.ndarray) -> list[int | None]:
        d = x * np.int64(n) - total
        if float((d.astype(float) ** 2).sum(axis=1).max()) < 2.0**62:
            return (d * d).sum(axis=1).tolist()
        exact = [sum(int(v) ** 2 for v in row) for row in d]
        return [v if v < 1 << 63 else None for v in exact]

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = 0
            for (x,) in matrices(batch.column(1)):
                y = centred(x, total, n) @ projection
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(at, len(x)),
                        batch.column(2).slice(at, len(x)),
                        pa.array(deviations(x), pa.int64()),
                        pa.array(list(y), pa.list_(pa.float64())),
                    ],
                    names=["key", "copies", "deviation", "y"],
                )
                at += len(x)

    answers = vectors.select("key", "x", "n").mapInArrow(project, "key string, copies long, deviation long, y array<double>")
    joined = hot_join(used.select("id", "key"), answers, "key", "copies", n)
    share = F.element_at(F.array(*[F.lit(float(e)) for e in explained]), F.col("component"))
    return (
        joined.select("id", "deviation", F.posexplode("y").alias("place", "whitened"))
        .withColumn("component", F.col("place") + 1)
        .select("id", "component", F.lit(n).cast("long").alias("n"), "deviation", "whitened", share.alias("explained"), F.lit(error).alias("identity_error"))
    )
