"""Whitening against numpy on all rows."""

import math
import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from cellweave.llm import queries
from cellweave.llm.whitening import whiten

SF = os.environ.get("LLM_SF_DIR", "/root/testdata/sf0.001")
KIND = "vec_id long, embedding array<float>, label int"


def compare(rows, found, components=32):
    used = [(i, v) for i, v in rows if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    x = np.array([[math.floor(64 * float(c)) + 1000000 for c in v] for _, v in used], dtype=object)
    n, total = len(x), x.sum(axis=0)
    c = np.array([[float(n * a - s) / n for a, s in zip(r, total, strict=True)] for r in x])
    cov = c.T @ c / n
    values = np.linalg.eigvalsh(cov)[::-1]
    k = min(components, len(values), int((values > 1e-12 * np.trace(cov)).sum()))
    assert len(found) == n * k
    want = sorted((i is not None, i or 0, sum(int(n * a - s) ** 2 for a, s in zip(r, total, strict=True))) for (i, _), r in zip(used, x, strict=True))
    assert sorted((r.vec_id is not None, r.vec_id or 0, r.deviation) for r in found if r.component == 1) == want
    assert {r.n for r in found} == {n}
    for r in found:
        assert r.explained == pytest.approx(values[r.component - 1] / np.trace(cov), rel=1e-9)
    assert len({r.identity_error for r in found}) == 1 and found[0].identity_error < 1e-6
    # whitened values have unit covariance, and projecting back gives the best approximation of this many components
    by_row = {}
    for r in found:
        by_row.setdefault(r.vec_id, {})[r.component] = r.whitened
    ids = [i for i, _ in used]
    if len(set(ids)) == n:
        y = np.array([[by_row[i][j + 1] for j in range(k)] for i in ids])
        assert np.allclose(y.T @ y / n, np.eye(k), atol=1e-6)
        axes = c.T @ y / n / np.sqrt(values[:k])
        assert np.allclose(axes.T @ axes, np.eye(k), atol=1e-6)
        assert np.allclose(cov @ axes, axes * values[:k], atol=1e-6 * values[0])
    return by_row


def test_whole_table(spark):
    df = queries.table(spark, SF, "embeddings")
    rows = [(r.vec_id, r.embedding) for r in df.collect()]
    compare(rows, queries.QUERIES["op12_whitening"](spark, SF).collect())


def test_copies_nulls_and_clashing_names(spark):
    rng = np.random.default_rng(5)
    vectors = rng.normal(size=(300, 6)).astype(np.float32).tolist()
    rows = list(enumerate(vectors)) + [(1000 + i, vectors[0]) for i in range(250)]
    rows += [(2000, None), (2001, [1.0, None, 1.0, 1.0, 1.0, 1.0]), (2002, [float("nan")] * 6), (2003, [float("-inf")] * 6)]
    df = spark.createDataFrame([(i, v, 0) for i, v in rows], KIND)
    for c in ("key", "x", "n", "id", "copies", "y"):
        df = df.withColumn(c, F.lit(c))
    answers = compare(rows, whiten(df.repartition(7)).withColumnRenamed("id", "vec_id").collect())
    assert all(answers[1000 + i] == answers[0] for i in range(250))


def test_repeated_and_null_ids(spark):
    rows = [(None, [0.5, 1.0]), (None, [0.5, 1.0]), (3, [2.0, -1.0]), (3, [2.0, -1.0]), (3, [0.0, 7.0])]
    compare(rows, whiten(spark.createDataFrame([(i, v, 0) for i, v in rows], KIND)).withColumnRenamed("id", "vec_id").collect())


def test_direction_without_variance_is_left_out(spark):
    rows = [(i, [float(i), 3.0]) for i in range(9)]
    compare(rows, whiten(spark.createDataFrame([(i, v, 0) for i, v in rows], KIND)).withColumnRenamed("id", "vec_id").collect())


@pytest.mark.parametrize("vectors", [[], [None], [[]], [[1.0, 2.0]] * 3])
def test_nothing_to_whiten(spark, vectors):
    assert whiten(spark.createDataFrame([(i, v, 0) for i, v in enumerate(vectors)], KIND)).collect() == []


def test_different_lengths_are_an_error(spark):
    with pytest.raises(ValueError, match="entries"):
        whiten(spark.createDataFrame([(1, [1.0], 0), (2, [1.0, 2.0], 0)], KIND))


def test_deviation_beyond_64_bits_is_null(spark):
    rows = [(i, [float(i % 2) * 1e8, float(i)], 0) for i in range(4)]
    assert {r.deviation for r in whiten(spark.createDataFrame(rows, KIND)).collect()} == {None}
