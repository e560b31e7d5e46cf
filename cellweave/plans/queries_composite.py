"""Registered user-level jobs."""

from __future__ import annotations

from pyspark.sql import functions as F

from cellweave.functions import s2
from cellweave.operators import temporal as tm
from cellweave.plans import composite as cp
from cellweave.plans import oracle_text as ot
from cellweave.plans.fixtures import GRID
from cellweave.plans.queries_raster import CELL, MEMBERS, SCENES, comparable
from cellweave.plans.queries_vector import INSIDE, PIECES
from cellweave.plans.registry import query
from cellweave.schema import Grid

col = F.col
HALF = Grid(left=-20.0, top=10.0, px_w=0.125, px_h=0.125, width=100, height=100, nodata=-9999.0)
TOUCHED = """c.r between floor((10.0D0 - greatest(e.y1, e.y2))/0.0625D0) and floor((10.0D0 - least(e.y1, e.y2))/0.0625D0)
 and c.c between floor((least(e.x1, e.x2) + 20.0D0)/0.0625D0) and floor((greatest(e.x1, e.x2) + 20.0D0)/0.0625D0)"""


@query("city_enrichment", "cells edges zones", f"""
with z as (select * from zones where country in (1, 3)), ze as (select e.* from edges e join z on z.zone_id = e.zone_id),
peak as (select r, c, x, y, max(value) as value from cells where value <> -9999.0D0 group by r, c, x, y),
hit as (select distinct r, c, value from (select c.r, c.c, c.value from peak c join ze e on {INSIDE.format(x='c.x', y='c.y')}
  group by c.r, c.c, c.value having count(*) % 2 = 1 union all select c.r, c.c, c.value from peak c join ze e on {TOUCHED}) q),
half as (select r // 2 as r, c // 2 as c, avg(value) as value from hit group by r // 2, c // 2),
hc as (select *, -20.0D0 + (c + 0.5D0)*0.125D0 as x, 10.0D0 - (r + 0.5D0)*0.125D0 as y from half),
m as (select e.zone_id, h.r, h.c, h.value from hc h join ze e on {INSIDE.format(x='h.x', y='h.y')} group by all having count(*) % 2 = 1),
s as (select zone_id, round(avg(value), 2) as a, max(value) as b, count(value) as n from m group by zone_id),
p as (select zone_id, {ot.albers_x('x1', 'y1')} as x1, {ot.albers_y('x1', 'y1')} as y1, {ot.albers_x('x2', 'y2')} as x2, {ot.albers_y('x2', 'y2')} as y2 from ze),
area as (select zone_id, round(abs(sum(x1*y2 - x2*y1)) / 2 / 1000000, 2) as area_km2 from p group by zone_id)
select z.zone_id, z.name, z.country, a as pm25_mean, b as pm25_max, n as pm25_count, area_km2 from z left join s on s.zone_id = z.zone_id
 left join area on area.zone_id = z.zone_id""")
def city_enrichment(t):
    cells = tm.temporal_stat(t.cells.select(*CELL), "max", nodata=-9999.0)
    out = cp.city_enrichment(t.zones, t.edges, cells, GRID, HALF, ["mean", "max", "count"], "pm25", [1, 3])
    return out.withColumns({"pm25_mean": F.round("pm25_mean", 2), "area_km2": F.round("area_km2", 2)})


@query("buildings_for_aoi", "buildings aoi", f"""
select b.building_id, b.latitude, b.longitude, b.area_in_meters, b.confidence from buildings b join aoi e on {INSIDE.format(x='b.longitude', y='b.latitude')}
where b.confidence >= 0.6 and b.area_in_meters >= 20 and b.area_in_meters <= 900 group by all having count(*) % 2 = 1""")
def buildings_for_aoi(t):
    keyed = t.buildings.withColumn("s2_token", s2.token(col("latitude"), col("longitude"), 6))
    return cp.buildings_for_aoi(keyed, t.aoi, "building_id", 0.6, 20, 900, token="s2_token").drop("s2_token")


UTM_PIECES = f"""
, l as (select osm_id, x1 + t*(x2-x1) as px1, y1 + t*(y2-y1) as py1, x1 + t2*(x2-x1) as px2, y1 + t2*(y2-y1) as py2 from kept),
u as (select osm_id, {ot.utm_x('px1', 'py1', 28)} as x1, {ot.utm_y('px1', 'py1', 28)} as y1, {ot.utm_x('px2', 'py2', 28)} as x2, {ot.utm_y('px2', 'py2', 28)} as y2 from l),
n as (select osm_id, count(*) as pieces, round(sum(sqrt((x2-x1)*(x2-x1)+(y2-y1)*(y2-y1))), 2) as length_m from u group by osm_id)
"""


@query("roads_for_cities", "highways aoi", PIECES + UTM_PIECES + """
select h.osm_id, trim(surface) as surface, trim(highway) as highway, case lower(trim(surface)) when 'asphalt' then 'paved' when 'concrete' then 'paved'
  when 'gravel' then 'unpaved' when 'dirt' then 'unpaved' end as surface_type, pieces, length_m from highways h join n on n.osm_id = h.osm_id
where h.osm_id % 7 in (0, 2, 5) and not (x1 = x2 and y1 = y2)""")
def roads_for_cities(t):
    roads = cp.roads_for_area(t.highway_copies, t.aoi, ["motorway", "primary"], ["surface"], 28)
    return roads.withColumn("length_m", F.round("length_m", 2))


@query("emissions_report", "cells edges", MEMBERS + """
, v as (select zone_id, r, c, printf('2022-%02d', month) as period, value from m where value <> -9999.0D0),
a as (select zone_id, r, c, 'annual' as period, avg(value) as value from v group by zone_id, r, c),
bad as (select zone_id, r, c, printf('2022-%02d', month) as period, null as value from m where value = -9999.0D0 union all
  select zone_id, r, c, 'annual', null from m where value = -9999.0D0)
select zone_id, period, round(coalesce(avg(value), 'nan'::double), 3) as mean, coalesce(min(value), 'nan'::double) as min, coalesce(max(value), 'nan'::double) as max,
 round(coalesce(stddev_pop(value), 'nan'::double), 2) as std, round(coalesce(sum(value), 'nan'::double) * 27720) as sum_27720, count(value) as count
from (select * from v union all select * from a union all select * from bad) q group by zone_id, period""")
def emissions_report(t):
    return comparable(cp.emissions_report(t.cells, t.edges, GRID, "month", 2022))


@query("annual_air_quality", "cells aoi", f"""
with hit as (select c.month, c.r, c.c, c.value from cells c join aoi e on {INSIDE.format(x='c.x', y='c.y')} where c.value <> -9999.0D0
  group by all having count(*) % 2 = 1),
k as (select *, 'annual' as season from hit union all select *, case when month in (12, 1, 2) then 'DJF' when month in (3, 4, 5) then 'MAM'
  when month in (6, 7, 8) then 'JJA' else 'SON' end from hit),
st as (select season, 'mean' as statistic, r, c, avg(value) as value from k group by season, r, c union all
  select season, 'max', r, c, max(value) from k group by season, r, c)
select season, statistic, round(avg(value), 1) as mean, round(min(value), 1) as min, max(value) as max, round(stddev_pop(value), 1) as std from st group by season, statistic""")
def annual_air_quality(t):
    out = cp.annual_air_quality(t.cells.select(*CELL), t.aoi, GRID)
    return out.withColumns({"mean": F.round("mean", 1), "min": F.round("min", 1), "std": F.round("std", 1)})


@query("cloud_free_composite", "scenes scene_pixels", f"""
with s as ({SCENES}), q as (select p.r, p.c, case when "SCL" not in (3, 8, 9, 10) then "B4" end as a, case when "SCL" not in (3, 8, 9, 10) then "B3" end as b,
  case when "SCL" not in (3, 8, 9, 10) then "B2" end as d from scene_pixels p join s on p.scene_id = s.scene_id),
m as (select r, c, median(a) as a, median(b) as b, median(d) as d from q group by r, c)
select r, c, cast(floor(least(greatest(a*0.0001D0, 0.0D0), 0.3D0)*(255/0.3D0)) as int) as "B4", cast(floor(least(greatest(b*0.0001D0, 0.0D0), 0.3D0)*(255/0.3D0)) as int) as "B3",
  cast(floor(least(greatest(d*0.0001D0, 0.0D0), 0.3D0)*(255/0.3D0)) as int) as "B2" from m""")
def cloud_free_composite(t):
    return cp.cloud_free_composite(t.scene_pixels, t.scenes, "2024-01-01 00:00:10", "2024-02-01")
