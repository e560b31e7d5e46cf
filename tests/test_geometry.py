"""Spatial operators against brute force on random polygons, with and without broadcasts."""

import math
import random

import pytest
from pyspark.sql import functions as F

from cellweave.functions import crs
from cellweave.operators import geometry as g
from cellweave.schema import Grid

GRID = Grid(left=0.0, top=10.0, px_w=0.25, px_h=0.5, width=40, height=20, nodata=-1.0)


def star(cx, cy, n, r, seed):
    rnd = random.Random(seed)
    pts = []
    for k in range(n):
        a, d = 2 * math.pi * k / n, r * rnd.uniform(0.3, 1.0)
        pts.append((cx + d * math.cos(a), cy + d * math.sin(a)))
    return pts


ZONES = {1: star(3, 5, 17, 2.8, 1), 2: star(6.5, 4, 40, 3.2, 2), 3: star(5, 5, 9, 0.3, 3)}


def edge_rows(zones):
    return [
        (z, *ring[i], *ring[(i + 1) % len(ring)]) for z, ring in zones.items() for i in range(len(ring))
    ]


@pytest.fixture(scope="module")
def edges(spark):
    return spark.createDataFrame(edge_rows(ZONES), "zone_id int, x1 double, y1 double, x2 double, y2 double").cache()


def inside(ring, x, y):
    hit = False
    for (x1, y1), (x2, y2) in zip(ring, ring[1:] + ring[:1]):
        if (y1 > y) != (y2 > y) and x < (x2 - x1) * (y - y1) / (y2 - y1) + x1:
            hit = not hit
    return hit


def cell_centres():
    return {(r, c): (c * 0.25 + 0.125, 10 - r * 0.5 - 0.25) for r in range(20) for c in range(40)}


@pytest.fixture(scope="module")
def cells(spark):
    rows = [(r, c, float(r * 100 + c)) for r, c in cell_centres()]
    return spark.createDataFrame(rows, "r int, c int, value double").cache()


@pytest.mark.parametrize("max_rows", [10**6, 0])
def test_cells_in_zones(edges, cells, max_rows):
    got = {(r.zone_id, r.r, r.c) for r in g.cells_in_zones(cells, edges, GRID, max_rows=max_rows).collect()}
    want = {(z, *rc) for z, ring in ZONES.items() for rc, (x, y) in cell_centres().items() if inside(ring, x, y)}
    assert got == want


@pytest.mark.parametrize("max_rows", [10**6, 0])
def test_points_in_polygons(spark, edges, max_rows):
    rnd = random.Random(5)
    points = [(i, rnd.uniform(0, 10), rnd.uniform(0, 10)) for i in range(1500)]
    df = spark.createDataFrame(points, "id int, x double, y double")
    got = {(r.id, r.zone_id) for r in g.points_in_polygons(df, edges, ["id"], max_rows=max_rows).collect()}
    assert got == {(i, z) for i, x, y in points for z, ring in ZONES.items() if inside(ring, x, y)}


def test_full_tiles_exist(edges):
    """Large zones are mostly answered by tiles without any edge test."""
    index = g.zone_index(edges)
    tiles = g.zone_tiles(edges.join(index, "zone_id"))
    assert tiles.where("full").count() > 0


def touched_cells(ring):
    """Cells whose centre is inside or that an edge passes, by dense sampling."""
    out = {rc for rc, (x, y) in cell_centres().items() if inside(ring, x, y)}
    for (x1, y1), (x2, y2) in zip(ring, ring[1:] + ring[:1]):
        for k in range(20001):
            t = k / 20000
            x, y = x1 + t * (x2 - x1), y1 + t * (y2 - y1)
            rc = (math.floor((10 - y) / 0.5), math.floor(x / 0.25))
            if 0 <= rc[0] < 20 and 0 <= rc[1] < 40:
                out.add(rc)
    return out


@pytest.mark.parametrize("max_rows", [10**6, 0])
def test_clip_touched(edges, cells, max_rows):
    one = edges.where("zone_id = 1")
    got = {(r.r, r.c) for r in g.clip_raster(cells, one, GRID, all_touched=True, max_rows=max_rows).collect()}
    assert got == touched_cells(ZONES[1])


def test_clip_fill_covers_the_crop_window(edges, cells):
    one = edges.where("zone_id = 1")
    w = g.crop_window(one, GRID).first()
    got = g.clip_raster(cells, one, GRID, fill=True)
    assert got.count() == (w.r_max - w.r_min + 1) * (w.c_max - w.c_min + 1)
    kept = g.clip_raster(cells, one, GRID)
    assert got.where("value <> -1").count() == kept.where("value <> -1").count()


def segment_distance(x, y, e):
    x1, y1, x2, y2 = e
    dx, dy = x2 - x1, y2 - y1
    t = max(0, min(1, ((x - x1) * dx + (y - y1) * dy) / (dx * dx + dy * dy)))
    return math.hypot(x - x1 - t * dx, y - y1 - t * dy)


@pytest.mark.parametrize("max_rows", [10**6, 0])
def test_within_distance(spark, edges, max_rows):
    rnd = random.Random(9)
    points = [(i, rnd.uniform(-2, 12), rnd.uniform(-2, 12)) for i in range(800)]
    df = spark.createDataFrame(points, "id int, x double, y double")
    one = edges.where("zone_id = 2")
    got = {r.id for r in g.within_distance(df, one, 0.7, ["id"], max_rows=max_rows).collect()}
    ring = [e[1:] for e in edge_rows({2: ZONES[2]})]
    want = {i for i, x, y in points if inside(ZONES[2], x, y) or min(segment_distance(x, y, e) for e in ring) <= 0.7}
    assert got == want


@pytest.mark.parametrize("max_rows", [10**6, 0])
def test_clip_lines_keeps_inside_length(spark, edges, max_rows):
    rnd = random.Random(3)
    lines = [(i, *(rnd.uniform(0, 10) for _ in range(4))) for i in range(60)]
    df = spark.createDataFrame(lines, "id int, x1 double, y1 double, x2 double, y2 double")
    one = edges.where("zone_id = 1")
    pieces = g.clip_lines(df, one, ["id"], max_rows=max_rows)
    got = {r.id: r.m for r in g.line_length(pieces, ["id"], "m").collect()}
    for i, x1, y1, x2, y2 in lines:
        n = 4000
        hits = sum(inside(ZONES[1], x1 + (k + 0.5) / n * (x2 - x1), y1 + (k + 0.5) / n * (y2 - y1)) for k in range(n))
        assert abs(got.get(i, 0.0) - hits / n * math.hypot(x2 - x1, y2 - y1)) < 0.02


def test_features_within_random_triangles(spark, edges):
    rnd = random.Random(4)
    shapes = {}
    for i in range(120):
        cx, cy = rnd.uniform(3, 10), rnd.uniform(1, 7)
        shapes[i] = [(cx + rnd.uniform(-0.4, 0.4), cy + rnd.uniform(-0.4, 0.4)) for _ in range(3)]
    rows = edge_rows(shapes)
    df = spark.createDataFrame(rows, "fid int, x1 double, y1 double, x2 double, y2 double")
    got = {r.fid for r in g.features_within(df, edges.where("zone_id = 2").drop("zone_id"), ["fid"]).collect()}
    want = set()
    for i, ring in shapes.items():
        samples = [
            (x1 + k / 400 * (x2 - x1), y1 + k / 400 * (y2 - y1))
            for (x1, y1), (x2, y2) in zip(ring, ring[1:] + ring[:1])
            for k in range(400)
        ]
        if all(inside(ZONES[2], x, y) for x, y in samples):
            want.add(i)
    assert got == want


def test_dissolve_keeps_area(spark):
    squares = {i: [(i, 0), (i + 1, 0), (i + 1, 1), (i, 1)] for i in range(5)}
    rows = [(z, float(a), float(b), float(c), float(d)) for z, a, b, c, d in edge_rows(squares)]
    df = spark.createDataFrame(rows, "zone_id int, x1 double, y1 double, x2 double, y2 double")
    out = g.dissolve(df)
    assert out.count() == 12
    assert out.agg(F.sum(F.hypot(F.col("x2") - F.col("x1"), F.col("y2") - F.col("y1")))).first()[0] == 12


def test_no_nested_loop_between_cells_and_zones(edges, cells):
    plan = g.cells_in_zones(cells, edges, GRID)._jdf.queryExecution().toString()
    assert "NestedLoop" not in plan and "CartesianProduct" not in plan


def test_albers_area_of_one_degree(spark):
    ring = {0: [(0.0, 0.0), (1.0, 0.0), (1.0, 1.0), (0.0, 1.0)]}
    df = spark.createDataFrame(edge_rows(ring), "zone_id int, x1 double, y1 double, x2 double, y2 double")
    km2 = g.polygon_area(g.project_edges(df, crs.to_albers), ["zone_id"], "km2").first()[1]
    assert abs(km2 - 12308.46) < 0.1


@pytest.mark.parametrize("code", ["ESRI:102022", "EPSG:3857", "EPSG:32733", "EPSG:32628"])
def test_projection_inverts(spark, code):
    df = spark.createDataFrame([(13.5, -20.25), (17.0, 11.5), (15.0, 0.0)], "lon double, lat double")
    fwd, back = crs.projection("EPSG:4326", code), crs.projection(code, "EPSG:4326")
    lon, lat = back(*fwd(F.col("lon"), F.col("lat")))
    if code == "EPSG:32628":
        df = df.withColumn("lon", F.col("lon") - 30)
    for r in df.select("lon", "lat", lon.alias("a"), lat.alias("b")).collect():
        assert abs(r.lon - r.a) < 1e-7 and abs(r.lat - r.b) < 1e-7  # about a centimetre


def test_utm_central_meridian(spark):
    x, y = crs.to_utm(F.lit(15.0), F.lit(0.0), 33)
    r = spark.range(1).select(x.alias("x"), y.alias("y")).first()
    assert abs(r.x - 500000) < 1e-6 and abs(r.y) < 1e-6
    # one degree of latitude on the central meridian, scaled by 0.9996
    x, y = crs.to_utm(F.lit(15.0), F.lit(1.0), 33)
    assert abs(spark.range(1).select(y).first()[0] - 110574.3886 * 0.9996) < 0.01


def test_unknown_projection():
    with pytest.raises(ValueError):
        crs.projection("EPSG:4326", "EPSG:2154")


def within(spark, shapes, area):
    kind = "fid string, x1 double, y1 double, x2 double, y2 double"
    outline = spark.createDataFrame(edge_rows(area), kind).drop("fid")
    return {r.fid for r in g.features_within(spark.createDataFrame(edge_rows(shapes), kind), outline, ["fid"]).collect()}


def test_features_within_keeps_contact_with_every_side(spark):
    square = {"a": [(0.0, 0.0), (4.0, 0.0), (4.0, 4.0), (0.0, 4.0)]}
    unit = lambda x, y: [(x, y), (x + 1.0, y), (x + 1.0, y + 1.0), (x, y + 1.0)]
    shapes = {"left": unit(0.0, 1.5), "right": unit(3.0, 1.5), "top": unit(1.5, 3.0), "bottom": unit(1.5, 0.0), "free": unit(1.5, 1.5)}
    shapes |= {"corner": unit(3.0, 3.0), "all": square["a"], "over": unit(3.5, 1.0), "away": unit(5.0, 1.0), "next": unit(4.0, 1.0)}
    assert within(spark, shapes, square) == {"left", "right", "top", "bottom", "free", "corner", "all"}


def test_features_within_drops_what_fills_a_notch_or_hole(spark):
    areas, shapes = {}, {}
    for turn in range(4):
        area = [(0, 0), (4, 0), (4, 4), (0, 4), (0, 3), (1, 2), (0, 1)]
        notch = [(0, 1), (1, 2), (0, 3)]
        beside = [(0, 3), (1, 2), (1, 3)]
        for _ in range(turn):
            area, notch, beside = ([(4 - y, x) for x, y in ring] for ring in (area, notch, beside))
        moved = lambda ring: [(x + 10.0 * (turn + 1), float(y)) for x, y in ring]  # noqa: B023, E731
        areas[f"a{turn}"], shapes[f"notch{turn}"], shapes[f"beside{turn}"] = moved(area), moved(notch), moved(beside)
    hole = [(1.0, 1.0), (3.0, 1.0), (3.0, 3.0), (1.0, 3.0)]
    areas |= {"a": [(0.0, 0.0), (4.0, 0.0), (4.0, 4.0), (0.0, 4.0)], "hole": hole}
    around = [(0.5, 0.5), (3.5, 0.5), (3.5, 3.5), (0.5, 3.5)]
    touching = [(0.0, 1.0), (1.0, 1.0), (1.0, 3.0), (0.0, 3.0)]
    shapes |= {"hole": hole, "around": around, "touching": touching}
    assert within(spark, shapes, areas) == {"touching", *(f"beside{turn}" for turn in range(4))}
