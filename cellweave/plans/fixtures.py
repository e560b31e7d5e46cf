"""Views that derive cells, zones, buildings, roads and scenes from the driver's tables.

The SQL is shared by Spark and the oracle; ``D0`` marks a double literal.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cellweave.schema import Grid
from cellweave.session import shared_folder as scratch  # noqa: F401

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents")

#: Twelve monthly rasters; values are whole cents, so sums are exact in any order.
GRID = Grid(left=-20.0, top=10.0, px_w=0.0625, px_h=0.0625, width=200, height=200, nodata=-9999.0)

VIEWS: dict[str, str] = {
    "cells": """
        select month, r, c, -20.0D0 + c*0.0625D0 + 0.03125D0 as x, 10.0D0 - r*0.0625D0 - 0.03125D0 as y,
               case when (r*7 + c*3 + month) % 11 = 0 then -9999.0D0 else round(value*100) end as value
        from (select month, r, c, max(l_extendedprice) as value
              from (select cast(extract(month from l_shipdate) as int) as month,
                           cast(l_partkey % 200 as int) as r,
                           cast((l_suppkey*13 + l_partkey + l_orderkey) % 200 as int) as c,
                           l_extendedprice from lineitem) a
              group by month, r, c) b""",
    "zone_ring": """
        select cast(n_nationkey as int) as zone_id, k as seq,
          -20.0D0 + (n_nationkey % 5)*2.0D0
            + case k when 1 then 1.9D0 when 2 then 1.9D0 when 3 then 1.0D0 when 4 then 1.0D0 else 0.1D0 end as px,
          8.0D0 - floor(n_nationkey/5.0D0)*2.0D0
            + case k when 2 then 1.1D0 when 3 then 1.1D0 when 4 then 1.9D0 when 5 then 1.9D0 else 0.1D0 end as py
        from nation cross join (select 0 as k union all select 1 union all select 2 union all select 3
                                union all select 4 union all select 5 union all select 6) q""",
    "edges": """
        select a.zone_id, a.px as x1, a.py as y1, b.px as x2, b.py as y2
        from zone_ring a join zone_ring b on a.zone_id = b.zone_id and b.seq = a.seq + 1""",
    "zones": """
        select cast(n_nationkey as int) as zone_id, n_name as name, n_regionkey as country from nation""",
    "aoi": """
        select e.x1, e.y1, e.x2, e.y2 from edges e join zones z on e.zone_id = z.zone_id where z.country = 1""",
    "buildings": """
        select c_custkey as building_id,
          10.0D0 - ((c_custkey*7919) % 8000)*0.00125D0 as latitude,
          -20.0D0 + ((c_custkey*104729) % 8000)*0.00125D0 as longitude,
          abs(c_acctbal)/10.0D0 as area_in_meters,
          0.5D0 + ((c_custkey*31) % 500)/1000.0D0 as confidence
        from customer""",
    "building_edges": """
        select building_id, k,
          longitude + case k when 0 then 0.0D0 when 1 then 0.25D0 when 2 then 0.25D0 else 0.0D0 end as x1,
          latitude + case k when 0 then 0.0D0 when 1 then 0.0D0 when 2 then 0.25D0 else 0.25D0 end as y1,
          longitude + case k when 0 then 0.25D0 when 1 then 0.25D0 when 2 then 0.0D0 else 0.0D0 end as x2,
          latitude + case k when 0 then 0.0D0 when 1 then 0.25D0 when 2 then 0.25D0 else 0.0D0 end as y2
        from buildings cross join (select 0 as k union all select 1 union all select 2 union all select 3) q""",
    "highways": """
        select p_partkey as osm_id,
          case p_partkey % 7 when 0 then 'motorway' when 1 then 'trunk' when 2 then 'primary;secondary'
            when 3 then 'residential' when 4 then 'footway' when 5 then ' primary ' else null end as highway,
          case p_size % 5 when 0 then '2' when 1 then '2;3' when 2 then '2-3' when 3 then 'two' else null end as lanes,
          case p_size % 6 when 0 then 'Asphalt' when 1 then 'concrete' when 2 then ' gravel' when 3 then 'dirt'
            when 4 then 'sett' else null end as surface,
          -20.0D0 + ((p_partkey*37) % 800)*0.0125D0 as x1, 10.0D0 - ((p_partkey*53) % 800)*0.0125D0 as y1,
          -20.0D0 + ((p_partkey*37) % 800)*0.0125D0 + ((p_partkey % 9)-4)*0.25D0 as x2,
          10.0D0 - ((p_partkey*53) % 800)*0.0125D0 + ((p_partkey % 5)-2)*0.25D0 as y2
        from part""",
    "highway_copies": """
        select * from highways union all select * from highways where osm_id % 10 = 0""",
    "nan_cells": """
        select month, r, c, x, y, case when (r + c*2) % 13 = 0 then cast('NaN' as double) else value end as value from cells""",
    "squares": """
        select cast(s_suppkey as int) as zone_id, -20.0D0 + (s_suppkey*37 % 92)*0.125D0 as x0, 10.0D0 - (s_suppkey*61 % 92 + 6)*0.125D0 as y0,
          (1 + s_suppkey % 5)*0.125D0 as side from supplier
        union all
        select cast(s_suppkey + 10000000 as int), -20.0D0 + (s_suppkey*37 % 92)*0.125D0, 10.0D0 - (s_suppkey*61 % 92 + 6)*0.125D0,
          (1 + s_suppkey % 5)*0.125D0 from supplier where s_suppkey % 4 = 0""",
    "square_edges": """
        select zone_id, k, x0 + case when k in (1, 2) then side else 0.0D0 end as x1, y0 + case when k in (2, 3) then side else 0.0D0 end as y1,
          x0 + case when k in (0, 1) then side else 0.0D0 end as x2, y0 + case when k in (1, 2) then side else 0.0D0 end as y2
        from squares cross join (select 0 as k union all select 1 union all select 2 union all select 3) q
        union all
        select zone_id, k + 4, x0 + case when k in (1, 2) then 0.375D0 else 0.25D0 end, y0 + case when k in (2, 3) then 0.375D0 else 0.25D0 end,
          x0 + case when k in (0, 1) then 0.375D0 else 0.25D0 end, y0 + case when k in (1, 2) then 0.375D0 else 0.25D0 end
        from squares cross join (select 0 as k union all select 1 union all select 2 union all select 3) q where side = 0.625D0""",
    "places": """
        select c_custkey as place_id,
          case c_custkey % 6 when 0 then 'KEN' when 1 then 'GHA' when 2 then 'NGA' when 3 then 'XYZ'
            when 4 then 'ZAF' else null end as iso3,
          concat('City ', cast(c_custkey % 97 as varchar(20)), '/', c_mktsegment) as name,
          c_mktsegment as segment
        from customer""",
    "boxes": """
        select c_custkey as box_id,
          -20.0D0 + ((c_custkey*104729) % 8000)*0.01D0 as left_x,
          20.0D0 - ((c_custkey*7919) % 8000)*0.0075D0 as bottom_y,
          -20.0D0 + ((c_custkey*104729) % 8000)*0.01D0 + (c_custkey % 40 + 1)*0.125D0 as right_x,
          20.0D0 - ((c_custkey*7919) % 8000)*0.0075D0 + (c_custkey % 25 + 1)*0.125D0 as top_y
        from customer""",
    "files": """
        select c_custkey as file_id, cast(c_custkey % 12 + 1 as int) as month_no,
          concat('/data/', lower(c_mktsegment), '/', case c_custkey % 9
            when 0 then concat('KEN_City', cast(c_custkey as varchar(20)), '_odiac_2022_', lpad(cast(c_custkey % 12 + 1 as varchar(20)), 2, '0'), '.tif')
            when 1 then concat('pm25_', cast(c_custkey as varchar(20)), '.2019', lpad(cast(c_custkey % 12 + 1 as varchar(20)), 2, '0'), '-201912.TIF')
            when 2 then concat('LST ', cast(c_custkey as varchar(20)), '_2020-', lpad(cast(c_custkey % 14 + 1 as varchar(20)), 2, '0'), '.tif')
            when 3 then concat('9 emission-', cast(c_custkey as varchar(20)), '_', lpad(cast(c_custkey % 15 as varchar(20)), 2, '0'), '.tif')
            when 4 then concat('land_cover_', cast(c_custkey as varchar(20)), '_march.tiff')
            when 5 then concat('area', cast(c_custkey as varchar(20)), '.GeoJSON')
            when 6 then concat('pack', cast(c_custkey as varchar(20)), '.tar.gz')
            when 7 then concat('.notes', cast(c_custkey as varchar(20)), '.txt')
            else concat('grid ', cast(c_custkey as varchar(20)), '.tif.tiff') end) as path,
          concat('2021-', lpad(cast(c_custkey % 13 as varchar(20)), 2, '0')) as period
        from customer""",
    "archive_entries": """
        select concat('a', cast(p_partkey % 50 as varchar(20)), '.zip') as archive,
          concat('d', cast(p_partkey % 20 as varchar(20)), '/layer', cast(p_partkey % 300 as varchar(20)),
            case p_size % 8 when 0 then '.shp' when 1 then '.shx' when 2 then '.DBF' when 3 then '.prj'
              when 4 then '.tif' when 5 then '.txt' when 6 then '/' else '.geojson' end) as entry
        from part""",
    "catalog": """
        select o_orderkey as item_id, o_orderdate as start_datetime,
          concat('/data/item_', cast(o_orderkey as varchar(20)), '.tif') as href, o_orderpriority as collection
        from orders""",
    "gridded": """
        select cast(month as int) as month, lat, lon, max(v) as v
        from (select cast(extract(month from l_shipdate) as int) as month, (l_partkey % 40)*0.5D0 - 10.0D0 as lat,
                     (l_suppkey % 30)*0.5D0 as lon, l_extendedprice as v from lineitem) a
        group by month, lat, lon""",
    "scenes": """
        select event_id % 24 as scene_id, min(ts) as ts, ((event_id % 24)*37 % 50)*1.0D0 as cloudy_pct
        from events group by event_id % 24""",
    "scene_pixels": """
        select event_id % 24 as scene_id, cast(user_id % 20 as int) as r, cast(floor(event_id/24.0D0) % 20 as int) as c,
          cast(min(event_id % 12) as int) as "SCL", max(round(value*100)) as "B4", min(round(value*50)) as "B3",
          max(round(value*25)) as "B2"
        from events group by event_id % 24, cast(user_id % 20 as int), cast(floor(event_id/24.0D0) % 20 as int)""",
    "rgba": """
        select cast(o_custkey % 40 as int) as raster_id, cast(b as int) as band, cast(o_orderkey % 130 as int) as r,
          cast(floor(o_orderkey/130.0D0) % 130 as int) as c,
          case when b < 4 then 1.0D0 * max(o_orderkey % 256)
            when o_custkey % 40 % 3 = 0 then 255.0D0
            when o_custkey % 40 % 3 = 1 then 1.0D0 * max(o_orderkey % 2 * 255)
            else 1.0D0 * max(200 + o_orderkey % 50) end as value
        from orders cross join (select 1 as b union all select 2 union all select 3 union all select 4) q
        where b < 4 or o_custkey % 40 < 30
        group by o_custkey % 40, b, o_orderkey % 130, floor(o_orderkey/130.0D0) % 130""",
    "landcover": """
        select month, r, c, x, y, 10.0D0 * floor((r*3 + c*5 + month + floor(value/100000.0D0)) % 12) as value from cells""",
    "outcomes": """
        select cast(o_custkey % 20 as int) as run, concat('item', cast(o_orderkey as varchar(20))) as item,
          case when o_orderstatus = 'F' then 'failed' when o_custkey % 20 = 7 then 'failed' else 'success' end as status,
          case when o_orderstatus = 'F' then 'timeout' when o_custkey % 20 = 7 then 'no data' else null end as error
        from orders""",
    "downloads": """
        select o_orderkey as region_id, o_orderdate as download_date from orders""",
}

NEEDS: dict[str, tuple[str, ...]] = {
    name: tuple(v for v in VIEWS if v != name and re.search(rf"\b{v}\b", sql)) for name, sql in VIEWS.items()
}


def _closure(names: tuple[str, ...]) -> list[str]:
    out: list[str] = []
    for n in names:
        for d in (*_closure(NEEDS[n]), n):
            if d not in out:
                out.append(d)
    return out


def with_views(body: str, *names: str) -> str:
    """Oracle SQL: the views as common table expressions, then ``body``."""
    if not names:
        return body.replace("D0", "::double")
    ctes = ",\n".join(f"{n} as ({VIEWS[n]})" for n in _closure(names))
    own = re.match(r"\s*with\s+(recursive\s+)?", body)
    if own is None:
        return f"with {ctes}\n{body}".replace("D0", "::double")
    recursive = "recursive " if own.group(1) else ""
    return f"with {recursive}{ctes},\n{body[own.end():]}".replace("D0", "::double")


def _ring_corner(k):
    z = F.col("n_nationkey")
    dx = F.when(k.isin(1, 2), 1.9).when(k.isin(3, 4), 1.0).otherwise(0.1)
    dy = F.when(k.isin(2, 3), 1.1).when(k.isin(4, 5), 1.9).otherwise(0.1)
    return -20.0 + (z % 5) * 2.0 + dx, 8.0 - F.floor(z / 5.0) * 2.0 + dy


def _corners(t: Tables, last: int) -> DataFrame:
    return t.nation.withColumn("seq", F.explode(F.sequence(F.lit(0), F.lit(last))))


def _zone_ring(t: Tables) -> DataFrame:
    x, y = _ring_corner(F.col("seq"))
    return _corners(t, 6).select(F.col("n_nationkey").cast("int").alias("zone_id"), "seq", x.alias("px"), y.alias("py"))


def _edges(t: Tables, regions: tuple[int, ...] | None = None) -> DataFrame:
    (x1, y1), (x2, y2) = _ring_corner(F.col("seq")), _ring_corner(F.col("seq") + 1)
    rows = _corners(t, 5)
    if regions:
        rows = rows.where(F.col("n_regionkey").isin(*regions))
    ends = [x1.alias("x1"), y1.alias("y1"), x2.alias("x2"), y2.alias("y2")]
    return rows.select(*([] if regions else [F.col("n_nationkey").cast("int").alias("zone_id")]), *ends)


def _building_edges(t: Tables) -> DataFrame:
    rows = t.buildings.withColumn("k", F.explode(F.sequence(F.lit(0), F.lit(3))))
    up = lambda base, *ks: F.col(base) + F.when(F.col("k").isin(*ks), 0.25).otherwise(0.0)
    return rows.select(
        "building_id", "k", up("longitude", 1, 2).alias("x1"), up("latitude", 2, 3).alias("y1"),
        up("longitude", 0, 1).alias("x2"), up("latitude", 1, 2).alias("y2"),
    )


#: the polygon views without the joins of their SQL text: same rows, one narrow step
_NARROW = {
    "zone_ring": _zone_ring,
    "edges": _edges,
    "aoi": lambda t: _edges(t, (1,)),
    "building_edges": _building_edges,
}


class Tables:
    """The derived views of one data folder as DataFrames."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    def __getattr__(self, name: str) -> DataFrame:
        if name in TABLES:
            return self.table(name)
        if name not in VIEWS:
            raise AttributeError(name)
        if name in _NARROW:
            return _NARROW[name](self)
        sql = VIEWS[name].replace("D0", "D").replace('"', "`")
        used = [t for t in (*TABLES, *NEEDS[name]) if re.search(rf"\b{t}\b", sql)]
        frames = {}
        for t in used:
            sql = re.sub(rf"(?<![.\w{{]){t}(?![.\w}}])", f"{{{t}}}", sql)
            frames[t] = getattr(self, t)
        return self.spark.sql(sql, **frames)
