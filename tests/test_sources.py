"""Files, S2 facts, names, streams."""

import gzip
import json
import os
import random
import zipfile

import pytest
from pyspark.sql import functions as F

from cellweave.functions import s2, text
from cellweave.operators import places as pl
from cellweave.operators import roads as rd
from cellweave.schema import BUILDINGS
from cellweave.sources import files as fl
from cellweave.sources import rasters as rs
from cellweave.sources import vectors as vc
from cellweave.schema import Grid
from cellweave.streaming.rowwise import read_stream, run_available


def test_known_tokens(spark):
    pts = [(40.7, -74.0, "89c25"), (51.5, -0.12, "4876"), (0.0, 0.0, "1000000000000001"[:2])]
    df = spark.createDataFrame([p[:2] for p in pts], "lat double, lon double")
    got = [r.t for r in df.select(s2.token(F.col("lat"), F.col("lon"), 12).alias("t")).collect()]
    for t, (_, _, want) in zip(got, pts):
        assert t.startswith(want), (t, want)


def test_parent_prefix_and_counts(spark):
    for level in (1, 2, 4):
        cells = s2.all_cells(spark, level)
        assert cells.select("token").distinct().count() == 6 * 4**level
    rnd = random.Random(1)
    df = spark.createDataFrame([(rnd.uniform(-89, 89), rnd.uniform(-179, 179)) for _ in range(200)], "lat double, lon double")
    ids = df.select(s2.cell_id(F.col("lat"), F.col("lon"), 6).alias("a"), s2.cell_id(F.col("lat"), F.col("lon"), 9).alias("b"))
    for r in ids.collect():
        a, b = r.a % 2**64, r.b % 2**64
        low = a & -a
        assert a - low < b < a + low


def test_points_lie_in_their_polygon_and_covering(spark):
    rnd = random.Random(2)
    pts = [(i, rnd.uniform(-35, 35), rnd.uniform(-20, 50)) for i in range(150)]
    df = spark.createDataFrame(pts, "id int, lat double, lon double").withColumn("token", s2.token(F.col("lat"), F.col("lon"), 6))
    ring = df.select("*", s2.token_polygon(F.col("token"), 6).alias("ring")).collect()
    for r in ring:
        assert len(r.ring) == 5 and r.ring[0] == r.ring[4]
        assert min(p.y for p in r.ring) - 0.1 <= r.lat <= max(p.y for p in r.ring) + 0.1
        assert min(p.x for p in r.ring) - 0.1 <= r.lon <= max(p.x for p in r.ring) + 0.1
    boxes = df.select("id", (F.col("lon") - 0.2).alias("min_x"), (F.col("lat") - 0.2).alias("min_y"),
                      (F.col("lon") + 0.2).alias("max_x"), (F.col("lat") + 0.2).alias("max_y"))
    cover = {(r.id, r.token) for r in s2.covering(boxes, ["id"], 6).collect()}
    assert all((r.id, r.token) in cover for r in ring)
    inner = [(i, s2.token(F.lit(lat + dy), F.lit(lon + dx), 6)) for i, lat, lon in pts[:10] for dx in (-0.19, 0.19) for dy in (-0.19, 0.19)]
    row = spark.range(1).select(*[t.alias(f"t{k}") for k, (_, t) in enumerate(inner)]).first()
    assert all((i, row[k]) in cover for k, (i, _) in enumerate(inner))


def test_covering_guard(spark):
    boxes = spark.createDataFrame([(1, -20.0, -20.0, 50.0, 30.0)], "id int, min_x double, min_y double, max_x double, max_y double")
    with pytest.raises(ValueError):
        s2.covering(boxes, ["id"], 6, max_cells=10)
    more = [s2.covering(boxes, ["id"], level).count() for level in (4, 5)]
    assert more[0] < more[1]


@pytest.mark.parametrize(
    "raw,want",
    [("My-Dataset.tif", "my_dataset"), ("2022 PM25__v1.TIFF", "data_2022_pm25_v1f"), ("__a..b__", "a_b"), ("lc", "lc")],
)
def test_dataset_names(spark, raw, want):
    assert spark.range(1).select(text.clean_dataset_name(F.lit(raw))).first()[0] == want


def test_month_names(spark):
    names = ["data_2022_03.tif", "KEN_Nairobi_odiac_2022_12.tif", "x.201901-201901.tif", "pm_Sept.tif", "plain_99.tif", "a_13_07.tif"]
    df = spark.createDataFrame([(n,) for n in names], "path string")
    assert [r[0] for r in df.select(text.month_from_filename(F.col("path"))).collect()] == [3, 12, 1, 9, None, 7]


def test_geojson_geometries(spark, tmp_path):
    geoms = {
        "Point": [1.0, 2.0], "LineString": [[0, 0], [1, 1], [2, 0]], "MultiLineString": [[[0, 0], [1, 1]], [[5, 5], [6, 6]]],
        "Polygon": [[[0, 0], [4, 0], [4, 4], [0, 0]], [[1, 1], [2, 1], [2, 2], [1, 1]]],
        "MultiPolygon": [[[[0, 0], [1, 0], [1, 1], [0, 0]]], [[[5, 5], [6, 5], [6, 6], [5, 5]], [[5.1, 5.1], [5.2, 5.1], [5.2, 5.2], [5.1, 5.1]]]],
    }
    feats = [{"type": "Feature", "properties": {"n": k, "v": i}, "geometry": {"type": k, "coordinates": c}} for i, (k, c) in enumerate(geoms.items())]
    src = tmp_path / "in.geojson"
    src.write_text(json.dumps({"type": "FeatureCollection", "features": feats}))
    df = vc.read_features(spark, str(src))
    assert {r.crs for r in df.collect()} == {"EPSG:4326"}
    out = str(tmp_path / "out")
    vc.write_features(df.withColumn("n", df.properties["n"]), out, "geojson", ["n"])
    back = {}
    for name in os.listdir(out):
        if name.endswith(".txt"):
            doc = json.loads((tmp_path / "out" / name).read_text())
            assert doc["type"] == "FeatureCollection"
            back.update({f["properties"]["n"]: f["geometry"] for f in doc["features"]})
    for k, c in geoms.items():
        assert back[k]["type"] == k and json.dumps(back[k]["coordinates"]) == json.dumps(json.loads(json.dumps(c), parse_int=float))
    lines = str(tmp_path / "lines")
    vc.write_features(df.withColumn("n", df.properties["n"]), lines, "geojsonl", ["n"])
    assert vc.read_features(spark, lines, lines=True).count() == 5
    with pytest.warns(UserWarning):
        vc.write_features(df.select("geom_type", "parts", "shape"), str(tmp_path / "odd"), "gpkg")


def test_empty_collection_is_an_error(spark, tmp_path):
    (tmp_path / "e.geojson").write_text('{"type":"FeatureCollection","features":[]}')
    with pytest.raises(ValueError):
        vc.read_features(spark, str(tmp_path / "e.geojson"))


def test_buildings_files(spark, tmp_path):
    with gzip.open(tmp_path / "a_buildings.csv.gz", "wt") as f:
        f.write('5.1,-0.2,42.5,0.9,"POLYGON((0 0, 1 0, 1 1, 0 0))",6CPX\n5.2,-0.3,7.0,0.7,"POLYGON((0 0, 1 0, 1 1, 0 0))",6CPY\n')
    df = vc.read_buildings(spark, str(tmp_path / "*.csv.gz"), partitions=3)
    assert df.schema == BUILDINGS and df.count() == 2
    vc.write_csv(df, str(tmp_path / "out"), polygons=False, plus_codes=True)
    head = spark.read.option("header", True).csv(str(tmp_path / "out"))
    assert head.columns == ["latitude", "longitude", "area_in_meters", "confidence", "full_plus_code"]


def test_listing_and_archives(spark, tmp_path):
    for n in ("b.tif", "A.TIF", "c.geojson", "d.txt"):
        (tmp_path / n).write_text("x")
    files = fl.scan_files(spark, str(tmp_path))
    assert [os.path.basename(r.path) for r in fl.list_files(files, [".tif"]).collect()] == ["A.TIF", "b.tif"]
    assert fl.require_single(files, "*.geojson").count() == 1
    with pytest.raises(ValueError):
        fl.require_single(files, "*.tif")
    with pytest.raises(ValueError):
        fl.require_single(files, "*.shp")
    with zipfile.ZipFile(tmp_path / "z.zip", "w") as z:
        for n in ("d/a.shp", "d/a.dbf", "d/a.prj", "d/b.dbf", "x.tif", "note.txt", "d/"):
            z.writestr(n, "x")
    got = {r.entry for r in fl.list_archive_entries(spark, str(tmp_path)).collect()}
    assert got == {"d/a.shp", "d/a.dbf", "d/a.prj", "x.tif"}


def test_cells_on_disk(spark, tmp_path):
    grid = Grid(0.0, 4.0, 1.0, 1.0, 4, 4, nodata=-1.0)
    cells = spark.range(32).selectExpr("concat('r', id % 2) raster_id", "1 + cast(id % 2 as int) band", "cast(id / 8 as int) r", "cast(id % 8 as int) c",
                                       "case when id < 5 then null else double(id) end value")
    rs.write_cells(cells, str(tmp_path / "t"), grid, {"statistic": "mean"})
    back = rs.read_cells(spark, str(tmp_path / "t"), ["r1"], [2, 7])
    assert back.count() == 16 and back.where("value = -1").count() == 2
    plan = back._jdf.queryExecution().toString()
    assert "PartitionFilters: [" in plan and "raster_id" in plan.split("PartitionFilters")[1][:200]
    meta = rs.read_rasters(spark, str(tmp_path / "t")).collect()
    assert len(meta) == 2 and meta[0].tags == {"statistic": "mean"} and meta[0].nodata == -1.0


def test_lanes(spark):
    cases = [("2", 2), ("2;3", 2), ("4-5", 4), ("2.7", 2), ("two", None), ("", None), (None, None), ("nan", None), (" 3 ", 3)]
    df = spark.createDataFrame([(a,) for a, _ in cases], "lanes string")
    assert [r[0] for r in df.select(rd.parse_lanes(F.col("lanes"))).collect()] == [b for _, b in cases]


def test_guards(spark):
    df = spark.createDataFrame([("Kenya",), ("Ghana",)], "name string")
    with pytest.raises(ValueError):
        pl.filter_in(df, "name", ["Mali"])
    with pytest.raises(ValueError, match="Mali"):
        pl.require_names(spark.createDataFrame([("Mali",)], "name string"), df, "name")
    with pytest.raises(ValueError):
        pl.pending(df, df, ["name"], "error")
    assert pl.pending(df, df.limit(1), ["name"]).count() == 1
    assert pl.union_parts([]) is None
    with pytest.raises(ValueError):
        pl.require_columns(df, ["iso3"])


def test_truncated_names_do_not_clash(spark):
    df = spark.range(1).selectExpr("1 area_in_meters", "2 area_in_metres", "3 area_in_me", "4 short", "5 geometry")
    assert text.truncate_columns(df).columns == ["area_in_01", "area_in_02", "area_in_me", "short", "geometry"]


def test_stream_of_masks(spark, tmp_path):
    from cellweave.functions.raster import mask_values

    df = spark.range(100).selectExpr("cast(id as int) r", "0 c", "double(id) value")
    df.write.parquet(str(tmp_path / "in"))
    stream = read_stream(spark, str(tmp_path / "in"), df.schema)
    q = run_available(stream, lambda d: mask_values(d, 49, "greater", nodata=-1), str(tmp_path / "out"), str(tmp_path / "ck"))
    q.awaitTermination()
    assert spark.read.parquet(str(tmp_path / "out")).where("value = -1").count() == 50


def test_malformed_features_are_never_lost(spark, tmp_path):
    good = '{"type":"Feature","id":"1","properties":{},"geometry":{"type":"Point","coordinates":[1,2]}}'
    crs = '"crs":{"type":"name","properties":{"name":"urn:ogc:def:crs:EPSG::3857"}},'
    for name, text in {"a": f'{{"type":"FeatureCollection",{crs}"features":[{good},{good}]}}', "b": f'{{"type":"FeatureCollection","features":[{good}'}.items():
        (tmp_path / f"{name}.geojson").write_text(text)
    path = str(tmp_path / "*.geojson")
    with pytest.raises(ValueError, match="1 malformed"):
        vc.read_features(spark, path)
    assert [r["file"][-9:] for r in vc.rejected_features(spark, path).collect()] == ["b.geojson"]
    rows = vc.read_features(spark, path, strict=False).collect()
    assert len({r["feature_id"] for r in rows}) == 2 and {(r["given_id"], r["crs"]) for r in rows} == {("1", "EPSG:3857")}
    lines = tmp_path / "l.jsonl"
    lines.write_text(f"{good}\n{good}\n{good[:-9]}\n\n{good}\n")
    assert vc.rejected_features(spark, str(lines), lines=True).count() == 1
    rows = vc.read_features(spark, str(lines), lines=True, strict=False).collect()
    assert len({r["feature_id"] for r in rows}) == len(rows) == 3


def test_malformed_buildings_are_never_lost(spark, tmp_path):
    with gzip.open(tmp_path / "x.csv.gz", "wt") as f:
        f.write("1.5,2.5,10,0.9,POINT,8F\n1.5,abc,10,0.9,POINT,8F\n")
    with pytest.raises(Exception, match="(?i)malformed"):
        vc.read_buildings(spark, str(tmp_path / "x.csv.gz")).collect()
    rows = vc.read_buildings(spark, str(tmp_path / "x.csv.gz"), rejected="bad").collect()
    assert [r["bad"] for r in rows] == [None, "1.5,abc,10,0.9,POINT,8F"]
