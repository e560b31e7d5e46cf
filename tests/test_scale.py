"""Queries on tables with other keys, times and sizes than the given ones."""

import os

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from cellweave.functions import s2
from cellweave.operators import geometry as g
from cellweave.operators import temporal as tm
from cellweave.session import BROADCAST_ROWS, sized_join
from cellweave.sources import vectors as vc
from compare import connect, diff

FOLDER = "/root/testdata/sf0.001"


def changed(tmp_path, **tables):
    """The small tables, some of them replaced by the rows of an SQL text."""
    con = connect(FOLDER)
    for f in os.listdir(FOLDER):
        name = f[: -len(".parquet")]
        if name in tables:
            con.execute(f"copy ({tables[name]}) to '{tmp_path}/{f}' (format parquet)")
        else:
            os.symlink(f"{FOLDER}/{f}", f"{tmp_path}/{f}")
    return str(tmp_path)


def same_as_sql(spark, folder, name):
    return diff(entry.queries()[name](spark, folder), connect(folder), entry.oracle_sql()[name])


@pytest.mark.parametrize("name", ["filter_scenes", "median_composite", "cloud_free_composite"])
def test_no_scene_in_the_period_gives_no_rows(spark, tmp_path, name):
    folder = changed(tmp_path, events="select * replace (ts - interval 1 year as ts) from events")
    assert same_as_sql(spark, folder, name) == ""


def test_validate_rows_on_large_ids(spark, tmp_path):
    folder = changed(tmp_path, customer="select * replace (c_custkey + 150000 as c_custkey) from customer")
    assert same_as_sql(spark, folder, "validate_rows") == ""


def test_features_within_that_touch_the_border(spark, tmp_path):
    folder = changed(tmp_path, customer="select * replace (c_custkey + 5400 as c_custkey) from customer")
    assert same_as_sql(spark, folder, "features_within") == ""


def test_a_side_of_many_rows_is_never_broadcast(spark, tmp_path):
    """A small file whose rows are exploded looks small to Spark."""
    spark.range(2).write.parquet(f"{tmp_path}/t")
    big = spark.range(10).select((F.col("id") % 2).alias("k"))
    small = spark.read.parquet(f"{tmp_path}/t").select(F.col("id").alias("k"), F.explode(F.sequence(F.lit(1), F.lit(BROADCAST_ROWS))).alias("n"))
    joined = sized_join(big, small, ["k"], "left_semi", F.col("n") > 5)
    assert "Broadcast" not in joined._jdf.queryExecution().executedPlan().toString()
    assert joined.count() == 10
    assert "BroadcastHashJoin" in sized_join(big, small.limit(9), ["k"])._jdf.queryExecution().executedPlan().toString()


def test_copies_of_a_polygon_are_one_polygon_of_an_area(spark):
    square = [(0.0, 0.0, 2.0, 0.0), (2.0, 0.0, 2.0, 2.0), (2.0, 2.0, 0.0, 2.0), (0.0, 2.0, 0.0, 0.0)]
    hole = [(0.5, 0.5, 1.0, 0.5), (1.0, 0.5, 1.0, 1.0), (1.0, 1.0, 0.5, 1.0), (0.5, 1.0, 0.5, 0.5)]
    rows = [(z, *e) for z in range(40) for e in (square[::-1] if z % 2 else square + hole)]
    edges = spark.createDataFrame(rows, "zone_id int, x1 double, y1 double, x2 double, y2 double")
    area = g._area(edges, "zone_id").collect()
    assert sorted({r["__zone"] for r in area}) == [0, 1] and len(area) == 12
    points = spark.createDataFrame([(1, 0.7, 0.7), (2, 1.5, 1.5), (3, 2.5, 1.0)], "id int, x double, y double")
    assert sorted(r.id for r in g.points_in_area(points, edges, ["id"], zone="zone_id").collect()) == [1, 2]


def test_equal_boxes_are_compared_once(spark):
    """Of n copies of a road and of a place one pair of boxes is tested, and n * n rows come out."""
    box = "double, min_y double, max_x double, max_y double"
    roads = spark.createDataFrame([(i, "KEN", 0.1, 0.1, 0.4, 0.4) for i in range(300)], f"osm_id int, iso3 string, min_x {box}")
    places = spark.createDataFrame([(i, "KEN", 0.3, 0.3, 0.9, 0.9) for i in range(200)], f"place_id int, iso3 string, min_x {box}")
    hit = g.roads_by_place(roads, places, 0.5)
    assert hit.count() == 60_000 and hit.distinct().count() == 60_000
    plan = hit._jdf.queryExecution().optimizedPlan().toString()
    tested = plan.index("least") if "least" in plan else plan.index("greatest")
    assert "Aggregate [iso3" in plan[tested:]  # the test of a pair stands above the removal of copies


@pytest.mark.parametrize("max_rows", [10, BROADCAST_ROWS])
def test_places_and_roads_of_equal_boxes_are_joined_as_lists(spark, max_rows):
    """Joins meet lists, which the last step unrolls; NULL ids and rows that occur twice are kept."""
    box = "double, min_y double, max_x double, max_y double"
    left, right = (0.1, 0.1, 0.4, 0.4), (0.7, 0.1, 0.8, 0.2)
    rows = [(i, "KEN", "trunk", *left) for i in range(1300)] + [(7, "KEN", None, *left)] * 20 + [(None, "GHA", "x", *right), (1, None, "x", *left)]
    roads = spark.createDataFrame(rows, f"osm_id int, iso3 string, highway string, min_x {box}")
    rows = [(i, "KEN", 0.3, 0.3, 0.9, 0.9) for i in range(600)] + [(3, "KEN", 0.3, 0.3, 0.9, 0.9)] * 5 + [(None, "GHA", 0.0, 0.0, 0.9, 0.9)] * 2
    places = spark.createDataFrame([*rows, (8, None, 0.0, 0.0, 0.9, 0.9), (9, "KEN", None, 0.0, 0.9, 0.9)], f"place_id int, iso3 string, min_x {box}")
    hit = g.roads_by_place(roads, places, 0.5, max_rows=max_rows)
    p = places.select("iso3", "place_id", *[F.col(c).alias(f"p_{c}") for c in ("min_x", "min_y", "max_x", "max_y")])
    meet = "min_x <= p_max_x and max_x >= p_min_x and min_y <= p_max_y and max_y >= p_min_y"
    pairs = roads.join(p, "iso3").where(meet).select("iso3", "place_id", "osm_id", "highway")
    assert hit.count() == pairs.count() == 1320 * 605 + 2
    assert hit.exceptAll(pairs).isEmpty() and pairs.exceptAll(hit).isEmpty()
    plan = hit._jdf.queryExecution().optimizedPlan().toString()
    assert "explode(__places" in plan[: plan.index("Join")] and "explode(__list" in plan[: plan.index("Join")]


def test_a_join_has_as_many_tasks_as_asked_for(spark):
    """Few bytes, whose tasks Spark would merge; -0.0 and NaN are keys like others."""
    left = spark.createDataFrame([(i % 7, "a", 0.0 if i % 2 else float("nan"), i) for i in range(99)], "k int, s string, x double, i int")
    right = spark.createDataFrame([(k, "a", x, k) for k in range(9) for x in (-0.0, float("nan"))] + [(None, "a", 0.0, 0)], "k int, s string, x double, v int")
    joined = sized_join(left, right, ["k", "s", "x"], max_rows=1, tasks=37)
    assert sorted((r.i, r.v) for r in joined.collect()) == [(i, i % 7) for i in range(99)] and joined.columns == ["k", "s", "x", "i", "v"]
    assert joined.select(F.spark_partition_id()).rdd.getNumPartitions() == 37


def test_lists_of_equal_boxes_are_bounded(spark):
    """A box of many different rows, one of many equal rows and one of few."""
    rows = [(i, 1) for i in range(5000)] + [(0, 2)] * 3000 + [(1, 3), (None, 3)]
    lists = g._in_lists(spark.createDataFrame(rows, "id int, box int"), ["box"])
    assert lists.agg(F.sum("__rows")).first()[0] == len(rows)
    assert lists.where((F.col("__rows") > 2 * g.LISTED) | (F.col("__part") >= F.col("__parts"))).isEmpty()
    back = lists.select(F.explode("__list").alias("v"), "box").select("v.id", "box").collect()
    assert sorted(map(str, back)) == sorted(f"Row(id={i}, box={b})" for i, b in rows)


def test_written_documents_are_of_bounded_size(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(vc, "FILE_BYTES", 20_000, raising=False)
    point = F.array(F.array(F.struct(F.col("id").cast("double").alias("x"), F.lit(1.0).alias("y"))))
    features = spark.range(2000).coalesce(1).select("id", point.alias("parts"), F.array(F.lit(1)).alias("shape"), F.lit("Point").alias("geom_type"))
    vc.write_features(features, f"{tmp_path}/f", "geojson", ["id"])
    sizes = [os.path.getsize(f"{tmp_path}/f/{n}") for n in os.listdir(f"{tmp_path}/f") if n.endswith(".txt")]
    assert max(sizes) < 30_000 and len(sizes) > 5
    back = vc.read_features(spark, f"{tmp_path}/f")
    assert sorted(int(r[0]) for r in back.select(F.col("properties")["id"]).collect()) == list(range(2000))


def test_months_of_one_file_of_names_are_searched_by_all_tasks(spark):
    rows = spark.range(9000).coalesce(1).select("id", F.concat(F.lit("/a/x_2020_0"), F.col("id") % 10, F.lit(".tif")).alias("path"))
    found = tm.detect_months(rows, "filename", check=False)
    assert found.rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
    assert found.where("month = id % 10").count() == found.count() == 8100
    assert tm.detect_months(rows, "filename", keys=["id"]).count() == 8100


def test_s2_covering_keeps_no_boxes_in_memory(spark, tmp_path):
    """Cells of the level are few and broadcast; boxes, repeated ones too, are neither sorted nor gathered."""
    folder = changed(tmp_path, customer="select * from customer union all select * from customer where c_custkey % 3 = 0")
    plan = entry.queries()["s2_covering"](spark, folder)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "Aggregate" not in plan and "Sort" not in plan
    assert same_as_sql(spark, folder, "s2_covering") == ""


@pytest.mark.parametrize("level", [0, 3, 6])
def test_cells_span_no_more_stripes_than_counted(spark, level):
    cells = s2.all_cells(spark, level).select(F.max(F.floor("max_y") - F.floor("min_y") + 1))
    assert cells.first()[0] <= int(s2.MAX_DIAGONAL / 2**level) + 2
