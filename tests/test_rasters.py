"""Ranks, nodata, components, classes and resampling on small fixtures."""

import itertools
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from cellweave.functions import raster as rf
from cellweave.operators import classify as cl
from cellweave.operators import components as cc
from cellweave.operators import grid as gr
from cellweave.operators import nodata as nd
from cellweave.operators import quantiles as qt
from cellweave.operators import temporal as tm
from cellweave.operators import zonal as zn
from cellweave.schema import Grid


def table(spark, array, **keys):
    rows = [(*keys.values(), r, c, float(v)) for (r, c), v in np.ndenumerate(array)]
    names = "".join(f"{k} int, " for k in keys)
    return spark.createDataFrame(rows, f"{names}r int, c int, value double")


@pytest.mark.parametrize("small", [True, False])
def test_percentiles_with_a_hot_group(spark, small):
    rnd = np.random.default_rng(0)
    values = {0: rnd.normal(size=3000), 1: np.repeat([1.0, 2.0], [700, 3]), 2: np.array([5.0])}
    rows = [(k, float(v)) for k, vs in values.items() for v in vs] + [(2, float("nan")), (2, None)]
    df = spark.createDataFrame(rows, "k int, value double")
    ps = {"a": 0.0, "b": 10.0, "c": 50.0, "d": 99.9, "e": 100.0}
    for r in qt.group_percentiles(df, ["k"], ps, small=small).collect():
        assert np.allclose([r[n] for n in ps], np.percentile(values[r.k], list(ps.values())))


def test_unknown_statistics(spark):
    with pytest.raises(ValueError):
        zn.split_stats(["mode7"])
    with pytest.raises(ValueError):
        tm.temporal_stat(spark.range(1).selectExpr("1 r", "1 c", "1.0D value"), "mode")
    with pytest.raises(ValueError):
        rf.mask_values(spark.range(1).selectExpr("1.0D value"), 1, "near")


def test_nan_is_not_above_a_limit(spark):
    df = spark.createDataFrame([(float("nan"),), (5.0,), (1.0,)], "value double")
    got = [r.value for r in rf.mask_values(df, 3, "greater").collect()]
    assert np.isnan(got[0]) and got[1:] == [-9999.0, 1.0]
    outside = [r.value for r in rf.mask_ranges(df, [(0, 2)], inside=False, nodata=0).collect()]
    assert outside == [0.0, 0.0, 1.0]


@pytest.mark.parametrize("finish", [0, 10**6])
def test_components_of_random_masks(spark, finish):
    rnd = np.random.default_rng(1)
    mask = rnd.random((40, 60)) < 0.58
    mask[5, :] = mask[:, 7] = True
    df = spark.createDataFrame([(0, int(r), int(c)) for r, c in np.argwhere(mask)], "k int, r int, c int")
    got = {(r.r, r.c): r.component for r in cc.connected_components(df, ["k"], finish_edges=finish).collect()}
    seen, label = set(), {}
    for start in map(tuple, np.argwhere(mask)):
        if start in seen:
            continue
        stack, part = [start], []
        seen.add(start)
        while stack:
            r, c = stack.pop()
            part.append((r, c))
            for n in ((r - 1, c), (r + 1, c), (r, c - 1), (r, c + 1)):
                if 0 <= n[0] < 40 and 0 <= n[1] < 60 and mask[n] and n not in seen:
                    seen.add(n)
                    stack.append(n)
        name = min(int(r) * 2**31 + int(c) for r, c in part)
        label.update({(int(r), int(c)): name for r, c in part})
    assert got == label


def test_long_snake_is_one_component(spark):
    cells = []
    for r in range(41):
        cells += [(r, c) for c in range(30)] if r % 2 == 0 else [(r, 29 if r % 4 == 1 else 0)]
    df = spark.createDataFrame(cells, "r int, c int")
    assert cc.connected_components(df).select("component").distinct().count() == 1


def reference_outlier(v, z=4.0, p=0.001):
    if len(v) < 100 or v.std() == 0:
        return None
    far = v[np.abs((v - v.mean()) / v.std()) > z]
    for val, n in zip(*np.unique(far, return_counts=True)):
        if n / len(far) > 0.5 and n / len(v) > 0.001:
            return float(val)
    s, k = np.sort(v), int(len(v) * 0.01)
    if s[k] - s[0] > 0.1 * (s[-1] - s[0]) and s[0] < np.percentile(v, p * 100) and len(set(s[:k])) == 1:
        return float(s[0])
    return None


@pytest.mark.parametrize("small", [True, False])
def test_outlier_detection(spark, small):
    rnd = np.random.default_rng(2)
    base = rnd.normal(100, 10, 2000).round(3)
    cases = {
        0: base,
        1: np.concatenate([base, np.full(40, -5000.0)]),
        2: np.concatenate([base, np.full(30, 9000.0)]),
        3: np.concatenate([base, [-400.0, 700.0]]),
        4: np.full(500, 3.0),
        5: base[:50],
        6: np.concatenate([rnd.uniform(0, 100, 3000).round(3), np.full(30, -80.0)]),
    }
    rows = [(k, i, 0, float(v)) for k, vs in cases.items() for i, v in enumerate(vs)]
    df = spark.createDataFrame(rows, "k int, r int, c int, value double")
    got = {r.k: r.nodata for r in nd.detect_nodata_outlier(df, ["k"], small=small).collect()}
    for k, v in cases.items():
        assert got.get(k) == reference_outlier(v), k


def test_common_sentinels_follow_the_dtype(spark):
    values = [255.0] * 5 + [-1.0] * 5 + [3.0] * 90
    df = spark.createDataFrame([(i, 0, v) for i, v in enumerate(values)], "r int, c int, value double")
    assert nd.detect_nodata_common(df, dtype="float64").first().nodata == -1.0
    assert nd.detect_nodata_common(df, dtype="uint8").first().nodata == 255.0
    assert nd.stored_value(65535, "int16") is None and nd.stored_value(-9999, "uint16") is None


def test_validate_nodata_blob(spark):
    a = np.arange(400, dtype=float).reshape(20, 20) % 50
    a[:8, :8] = -9999
    r = nd.validate_nodata(table(spark, a), -9999.0).first()
    assert r.is_valid and r.confidence == pytest.approx(1.0) and r.coherence == 1.0


def test_sample_windows(spark):
    a = table(spark, np.zeros((40, 40)))
    assert nd.sample_windows(a, 40, 40, None).count() == 1600
    assert nd.sample_windows(a, 40, 40, 410).count() == 800  # 20x20 centre, then one corner


def brute_jenks(v, k):
    v, best = sorted(v), None
    for cut in itertools.combinations(range(1, len(v)), k - 1):
        parts = [v[a:b] for a, b in zip((0, *cut), (*cut, len(v)))]
        cost = sum(((np.array(p) - np.mean(p)) ** 2).sum() for p in parts)
        if best is None or cost < best[0] - 1e-9:
            best = (cost, [v[0], *[p[-1] for p in parts]])
    return best[1]


def test_natural_breaks_match_brute_force(spark):
    rnd = random.Random(6)
    for trial in range(4):
        values = [round(rnd.expovariate(0.1), 2) for _ in range(14)]
        df = spark.createDataFrame([(0, i, v) for i, v in enumerate(values)], "r int, c int, value double")
        assert cl.class_breaks(df, "jenks", 4).first().breaks == pytest.approx(brute_jenks(values, 4))


def test_natural_breaks_of_many_values(spark):
    df = spark.range(6000).select(F.col("id").cast("int").alias("r"), F.lit(0).alias("c"), (F.col("id") * 1.0).alias("value"))
    breaks = cl.class_breaks(df, "jenks", 3).first().breaks
    assert breaks[0] == 0 and breaks[-1] == 5999 and breaks == sorted(breaks)
    assert abs(breaks[1] - 2000) < 20 and abs(breaks[2] - 4000) < 20


def test_log_breaks_without_positives(spark):
    df = spark.createDataFrame([(0, i, -float(i)) for i in range(5)], "r int, c int, value double")
    assert cl.class_breaks(df, "log", 2).first().breaks == [-4.0, -2.0, 0.0]


def test_natural_breaks_with_few_values():
    groups = pd.DataFrame({"w": [1.0, 2.0], "s1": [3.0, 8.0], "s2": [9.0, 32.0], "lo": [3.0, 4.0], "hi": [3.0, 4.0]})
    assert cl.natural_breaks(groups, 5) == [3.0, 3.0, 4.0]


SRC = Grid(0.0, 12.0, 1.0, 1.0, 12, 12, nodata=-9.0)


@pytest.mark.parametrize("method", ["nearest", "bilinear", "cubic", "lanczos", "average", "mode"])
def test_aligning_to_the_own_grid_is_identity(spark, method):
    a = np.random.default_rng(3).integers(0, 50, (12, 12)).astype(float)
    out, grid = gr.align(table(spark, a), SRC, SRC, method)
    assert grid == SRC
    assert {(r.r, r.c): r.value for r in out.collect()} == pytest.approx({rc: v for rc, v in np.ndenumerate(a)})


@pytest.mark.parametrize("method", gr.RESAMPLING_METHODS)
def test_constant_fields_stay_constant(spark, method):
    dst = Grid(1.3, 10.7, 0.7, 0.9, 9, 8)
    out, _ = gr.align(table(spark, np.full((12, 12), 4.0)), SRC, dst, method)
    values = [r.value for r in out.collect()]
    assert len(values) == 72 and values == pytest.approx([4.0] * 72)


@pytest.mark.parametrize("method", ["bilinear", "cubic", "cubic_spline"])
def test_linear_fields_stay_linear(spark, method):
    a = np.fromfunction(lambda r, c: 3 * c - 2 * r + 100, (12, 12))
    dst = Grid(4.0, 8.0, 0.5, 0.5, 8, 8)
    for r in gr.resample(table(spark, a), SRC, dst, method).collect():
        c, row = (4.0 + (r.c + 0.5) * 0.5) - 0.5, (12 - (8.0 - (r.r + 0.5) * 0.5)) - 0.5
        assert r.value == pytest.approx(3 * c - 2 * row + 100)


def test_no_overlap_is_an_error(spark):
    with pytest.raises(ValueError):
        gr.plan_alignment(spark, SRC, Grid(100.0, 50.0, 1.0, 1.0, 5, 5))


def test_nodata_leaves_kernels(spark):
    a = np.full((12, 12), 5.0)
    a[5, 5] = -9.0
    out = gr.resample(table(spark, a), SRC, Grid(0.5, 11.5, 1.0, 1.0, 11, 11), "bilinear")
    assert {r.value for r in out.collect()} == {5.0}


def test_adaptive_partition_keeps_every_point(spark):
    rnd = random.Random(8)
    rows = [(i, rnd.uniform(0, 100) if i % 3 else 17.0, rnd.uniform(0, 100) if i % 3 else 42.0) for i in range(900)]
    df = spark.createDataFrame(rows, "id int, x double, y double")
    out = gr.adaptive_partition(df, 0.0, 0.0, 100.0, limit=50, min_size=1.0, depth=6).collect()
    assert len(out) == 900
    assert all(r.cell_count <= 50 or r.depth == 6 for r in out)


def test_month_errors(spark):
    files = spark.createDataFrame([("/d/a_2020_03.tif",), ("/d/b_2021_03.tif",), ("/d/c.tif",)], "path string")
    with pytest.raises(ValueError, match="several files"):
        tm.detect_months(files)
    with pytest.raises(ValueError, match="no month"):
        tm.detect_months(files.where("path not like '%b_%'"), skip_undetected=False)
    found = tm.detect_months(files.where("path not like '%b_%'"))
    assert [r.month for r in found.collect()] == [3]
    with pytest.raises(ValueError, match="missing"):
        tm.require_complete(found)
    manual = tm.detect_months(files, "manual", mapping={"c.tif": 5})
    assert [(r.path, r.month) for r in manual.collect()] == [("/d/c.tif", 5)]


def test_temporal_without_nodata_skips_nan(spark):
    df = spark.createDataFrame([(0, 0, 1.0), (0, 0, float("nan")), (0, 1, float("nan"))], "r int, c int, value double")
    got = {r.c: r.value for r in tm.temporal_stat(df, "mean").collect()}
    assert got[0] == 1.0 and np.isnan(got[1])


def test_empty_zone_keeps_a_row(spark):
    edges = spark.createDataFrame(
        [(1, 0.0, 0.0, 4.0, 0.0), (1, 4.0, 0.0, 4.0, 4.0), (1, 4.0, 4.0, 0.0, 4.0), (1, 0.0, 4.0, 0.0, 0.0)],
        "zone_id int, x1 double, y1 double, x2 double, y2 double",
    )
    far = edges.selectExpr("2 zone_id", "x1 + 500 x1", "y1", "x2 + 500 x2", "y2")
    zones = spark.createDataFrame([(1, "a"), (2, "b")], "zone_id int, name string")
    cells = table(spark, np.arange(144.0).reshape(12, 12))
    out = zn.enrich(zones, {"d": (cells, SRC)}, edges.unionByName(far), ["count", "mean"]).orderBy("zone_id").collect()
    assert out[0].d_count == 16 and out[1].d_count is None and out[1].d_mean is None


def test_zones_are_projected_to_the_raster(spark):
    """A raster in another CRS, and one in a CRS without a projection."""
    m = 111319.49079327358  # metres per degree of longitude in web Mercator
    ring = [(1.0, 1.0), (5.0, 1.0), (5.0, 5.0), (1.0, 5.0), (1.0, 1.0)]
    rows = [(7, *a, *b) for a, b in zip(ring, ring[1:])]
    edges = spark.createDataFrame(rows, "zone_id int, x1 double, y1 double, x2 double, y2 double")
    zones = edges.select("zone_id").distinct()
    cells = table(spark, np.ones((12, 12)))
    mercator = Grid(0.0, 12 * m, m, m, 12, 12, crs="EPSG:3857")
    unknown = Grid(0.0, 12.0, 1.0, 1.0, 12, 12, crs="EPSG:2154")
    with pytest.warns(UserWarning, match="skipped raster odd"):
        out = zn.enrich(zones, {"plain": (cells, SRC), "merc": (cells, mercator), "odd": (cells, unknown)}, edges, ["count"])
    r = out.first()
    assert (r.plain_count, r.merc_count, r.odd_count) == (16, 16, None)
