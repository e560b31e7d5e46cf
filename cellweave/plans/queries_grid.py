"""Grid snapping, resampling, mosaics, tiles and density queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from cellweave.functions import crs
from cellweave.operators import grid as gr
from cellweave.operators import quality as ql
from cellweave.plans import oracle_text as ot
from cellweave.plans.fixtures import GRID
from cellweave.plans.registry import query
from cellweave.schema import Grid

col, lit = F.col, F.lit
CELL = ["month", "r", "c", "value"]
REF = Grid(left=-20.0, top=20.0, px_w=0.3, px_h=0.3, width=200, height=180)
SIDES = ("left_x", "bottom_y", "right_x", "top_y")


def _box():
    return [col(s) for s in SIDES]


@query("bounds_intersection", "boxes", """
select a.box_id, greatest(a.left_x, b.left_x) as left_x, greatest(a.bottom_y, b.bottom_y) as bottom_y, least(a.right_x, b.right_x) as right_x,
  least(a.top_y, b.top_y) as top_y from boxes a join (select box_id, left_x, bottom_y, left_x + 12.0D0 as right_x, bottom_y + 9.0D0 as top_y from boxes) b
  on b.box_id = a.box_id + 99 where greatest(a.left_x, b.left_x) < least(a.right_x, b.right_x) and greatest(a.bottom_y, b.bottom_y) < least(a.top_y, b.top_y)""")
def bounds_intersection(t):
    other = t.boxes.select((col("box_id") - 99).alias("box_id"), col("left_x").alias("l"), col("bottom_y").alias("b"))
    common = gr.bounds_intersection(_box(), [col("l"), col("b"), col("l") + 12.0, col("b") + 9.0])
    found = t.boxes.join(other, "box_id").select("box_id", common.alias("box")).where("box is not null")
    return found.select("box_id", col("box.left").alias("left_x"), col("box.bottom").alias("bottom_y"), col("box.right").alias("right_x"), col("box.top").alias("top_y"))


@query("aligned_grid", "boxes", """
with o as (select *, round_even((left_x + 20.0D0) / 0.3D0, 0) as co, round_even((20.0D0 - top_y) / 0.3D0, 0) as ro from boxes)
select box_id, cast(co as int) as c_off, cast(ro as int) as r_off, cast(round_even((right_x - (-20.0D0 + co*0.3D0)) / 0.3D0, 0) as int) as width,
  cast(round_even(((20.0D0 - ro*0.3D0) - bottom_y) / 0.3D0, 0) as int) as height, -20.0D0 + co*0.3D0 as left_x, 20.0D0 - ro*0.3D0 as top_y from o""")
def aligned_grid(t):
    out = t.boxes.select("box_id", gr.aligned_grid(REF, *_box()).alias("g"))
    return out.select("box_id", "g.c_off", "g.r_off", "g.width", "g.height", col("g.left").alias("left_x"), col("g.top").alias("top_y"))


@query("snap_bounds", "boxes", """
select box_id, 0.0D0 + round_even((left_x - 0.0D0)/0.25D0, 0)*0.25D0 as left_x, 0.0D0 + round_even((bottom_y - 0.0D0)/0.25D0, 0)*0.25D0 as bottom_y,
  0.0D0 + round_even((right_x - 0.0D0)/0.25D0, 0)*0.25D0 as right_x, 0.0D0 + round_even((top_y - 0.0D0)/0.25D0, 0)*0.25D0 as top_y from boxes""")
def snap_bounds(t):
    sides = gr.snap_bounds(_box(), 0.25)
    return t.boxes.select("box_id", *[s.alias(n) for s, n in zip(sides, SIDES)])


_CORNERS = [(x, y) for x in ("left_x", "right_x") for y in ("bottom_y", "top_y")]


@query("reproject_bounds", "boxes", f"""
select box_id, round(least({', '.join(ot.albers_x(*c) for c in _CORNERS)}), 2) as left_x, round(least({', '.join(ot.albers_y(*c) for c in _CORNERS)}), 2) as bottom_y,
  round(greatest({', '.join(ot.albers_x(*c) for c in _CORNERS)}), 2) as right_x, round(greatest({', '.join(ot.albers_y(*c) for c in _CORNERS)}), 2) as top_y from boxes""")
def reproject_bounds(t):
    sides = crs.reproject_bounds(*_box(), "EPSG:4326", "ESRI:102022")
    return t.boxes.select("box_id", *[F.round(s, 2).alias(n) for s, n in zip(sides, SIDES)])


@query("bbox_polygon", "boxes", """
select box_id, i as seq, case when i in (0, 1, 4) then right_x else left_x end as x, case when i in (1, 2) then top_y else bottom_y end as y
from boxes cross join (select 0 as i union all select 1 union all select 2 union all select 3 union all select 4) q""")
def bbox_polygon(t):
    return t.boxes.select("box_id", F.posexplode(gr.bbox_polygon(*_box())).alias("seq", "p")).select("box_id", "seq", "p.x", "p.y")


@query("raster_info", "boxes", """
select box_id, left_x + 10*0.125D0 as right_x, top_y - 20*0.25D0 as bottom_y, 0.125D0 as pixel_size_x,
  round((left_x + 10*0.125D0 - left_x)*(top_y - (top_y - 20*0.25D0))*111.32D0*111.32D0, 6) as area from boxes""")
def raster_info(t):
    rasters = t.boxes.select("box_id", col("left_x").alias("left"), col("top_y").alias("top"), lit(10).alias("width"), lit(20).alias("height"),
                             lit(0.125).alias("px_w"), lit(0.25).alias("px_h"), lit("EPSG:4326").alias("crs"))
    return ql.raster_info(rasters).select("box_id", col("right").alias("right_x"), col("bottom").alias("bottom_y"), "pixel_size_x",
                                          F.round("approximate_area_km2", 6).alias("area"))


# ------------------------------------------------------------------ resampling

#: half the pixel size, shifted by a quarter pixel, reaching over the right and lower border
FINE = Grid(left=-20.0 + 1 / 64, top=10.0 - 1 / 64, px_w=1 / 32, px_h=1 / 32, width=420, height=420, nodata=-9999.0)
COARSE = Grid(left=-20.0 + 1 / 64, top=10.0 - 1 / 64, px_w=0.25, px_h=0.25, width=60, height=60, nodata=-9999.0)
MERCATOR = Grid(left=-2220000.0, top=1110000.0, px_w=9000.0, px_h=9000.0, width=120, height=120, crs="EPSG:3857")

#: the source pixel size, shifted by a quarter pixel
SHIFTED = Grid(left=-20.0 + 1 / 64, top=10.0 - 1 / 64, px_w=1 / 16, px_h=1 / 16, width=220, height=220, nodata=-9999.0)

# rows and columns of the fine grid within the common box
FINE_SIZE = 400
# number of target rows or columns in the common box, and the source position of the centre of number i
_AXES = {"fine": (FINE_SIZE, "(i + 0.5D0)/2 + 0.25D0"), "shifted": (200, "(i + 0.5D0) + 0.25D0")}


def _kernel_oracle(kernel: str, radius: int, value: str, target: str) -> str:
    size, centre = _AXES[target]
    k = lambda d: kernel.replace("{d}", d)
    return f"""
with src as (select month, r, c, value from cells where value <> -9999.0D0),
axis as (select i, {centre} as f from range({size}) q(i)),
tap as (select i, s, abs(f - 0.5D0 - s) as d from axis, range(-4, 205) p(s) where abs(f - 0.5D0 - s) <= {radius}),
w as (select i, s, {k('d')} as w from tap),
t as (select src.month, a.i as r, b.i as c, a.w * b.w as w, value from src join w a on a.s = src.r join w b on b.s = src.c where a.w * b.w <> 0)
select month, cast(r as int) as r, cast(c as int) as c, {value} as value from t group by month, r, c having sum(w) > 0.000001"""


SINC = "case when {d} = 0 then 1.0D0 else sin(pi()*{d})/(pi()*{d}) end * case when {d} = 0 then 1.0D0 else sin(pi()*{d}/3)/(pi()*{d}/3) end"
_KERNELS = {
    "bilinear": (1, "greatest(1 - {d}, 0.0D0)", "sum(w*value)/sum(w)"),
    "cubic": (2, "case when {d} <= 1 then (1.5D0*{d} - 2.5D0)*{d}*{d} + 1 when {d} < 2 then ((-0.5D0*{d} + 2.5D0)*{d} - 4)*{d} + 2 else 0.0D0 end",
              "sum(w*value)/sum(w)"),
    "cubic_spline": (2, "case when {d} <= 1 then (0.5D0*{d} - 1)*{d}*{d} + 2.0D0/3 when {d} < 2 then (2-{d})*(2-{d})*(2-{d})/6 else 0.0D0 end",
                     "round(sum(w*value)/sum(w)/1000 + 0.0003D0)"),
    "lanczos": (3, "case when {d} < 3 then " + SINC + " else 0.0D0 end", "round(sum(w*value)/sum(w)/10000 + 0.00003D0)"),
}

for _method, (_radius, _kernel, _value) in _KERNELS.items():

    _target = "fine" if _method == "bilinear" else "shifted"

    def _aligned(t, method=_method, ref=FINE if _target == "fine" else SHIFTED):
        out, _ = gr.align(t.cells.select(*CELL), GRID, ref, method, ["month"])
        scale = {"cubic_spline": 1000.0, "lanczos": 10000.0}.get(method)
        # inexact weights: compare coarse values, shifted so that whole cents are never ties
        return out if scale is None else out.withColumn("value", F.round(col("value") / scale + 0.3 / scale))

    query(f"align_{_method}", "cells", _kernel_oracle(_kernel, _radius, _value, _target))(_aligned)


@query("align_nearest", "cells", f"""
select month, cast(a.i as int) as r, cast(b.i as int) as c, value from cells
 join (select i, floor((i + 0.5D0)/2 + 0.25D0) as s from range({FINE_SIZE}) q(i)) a on a.s = cells.r
 join (select i, floor((i + 0.5D0)/2 + 0.25D0) as s from range({FINE_SIZE}) q(i)) b on b.s = cells.c
where value <> -9999.0D0""")
def align_nearest(t):
    aligned, _ = gr.align(t.cells.select(*CELL), GRID, FINE, "nearest", ["month"])
    return aligned


COARSE_AXIS = """select i, s, least((i + 1)*4 + 0.25D0, s + 1.0D0) - greatest(i*4 + 0.25D0, s*1.0D0) as w from range(50) q(i), range(200) p(s)
  where least((i + 1)*4 + 0.25D0, s + 1.0D0) > greatest(i*4 + 0.25D0, s*1.0D0)"""


@query("align_average", "cells", f"""
with axis as ({COARSE_AXIS})
select month, cast(a.i as int) as r, cast(b.i as int) as c, sum(a.w*b.w*value)/sum(a.w*b.w) as value from cells
 join axis a on a.s = cells.r join axis b on b.s = cells.c where value <> -9999.0D0 group by month, a.i, b.i""")
def align_average(t):
    aligned, _ = gr.align(t.cells.select(*CELL), GRID, COARSE, "average", ["month"])
    return aligned


@query("align_mode", "landcover", f"""
with axis as ({COARSE_AXIS}),
s as (select month, a.i as r, b.i as c, value, sum(a.w*b.w) as w from landcover l join axis a on a.s = l.r join axis b on b.s = l.c group by month, a.i, b.i, value)
select month, cast(r as int) as r, cast(c as int) as c, value from
 (select *, row_number() over (partition by month, r, c order by w desc, value) as n from s) q where n = 1""")
def align_mode(t):
    aligned, _ = gr.align(t.landcover.select(*CELL), GRID, COARSE, "mode", ["month"])
    return aligned


@query("reproject_nearest", "cells", """
with ax as (select i, -2220000.0D0 + (i + 0.5D0)*9000.0D0 as m, 1110000.0D0 - (i + 0.5D0)*9000.0D0 as n from range(120) q(i)),
 cols as (select i, floor((degrees(m / 6378137.0D0) + 20.0D0) / 0.0625D0) as s from ax),
 rws as (select i, floor((10.0D0 - degrees(2*atan(exp(n / 6378137.0D0)) - pi()/2)) / 0.0625D0) as s from ax)
select month, cast(a.i as int) as r, cast(b.i as int) as c, value from cells join rws a on a.s = cells.r join cols b on b.s = cells.c where value <> -9999.0D0""")
def reproject_nearest(t):
    return gr.resample(t.cells.select(*CELL), GRID, MERCATOR, "nearest", ["month"])


@query("reproject_bilinear", "cells", """
with ax as (select i, -2220000.0D0 + (i + 0.5D0)*9000.0D0 as m, 1110000.0D0 - (i + 0.5D0)*9000.0D0 as n from range(120) q(i)),
 cols as (select i, (degrees(m / 6378137.0D0) + 20.0D0) / 0.0625D0 as f from ax),
 rws as (select i, (10.0D0 - degrees(2*atan(exp(n / 6378137.0D0)) - pi()/2)) / 0.0625D0 as f from ax),
 ct as (select i, cast(floor(f - 0.5D0) as int) + k as s, greatest(0.0D0, 1 - abs(f - 0.5D0 - (floor(f - 0.5D0) + k))) as w from cols, range(2) z(k)),
 rt as (select i, cast(floor(f - 0.5D0) as int) + k as s, greatest(0.0D0, 1 - abs(f - 0.5D0 - (floor(f - 0.5D0) + k))) as w from rws, range(2) z(k))
select month, cast(a.i as int) as r, cast(b.i as int) as c, round(sum(a.w*b.w*value)/sum(a.w*b.w)/1000 + 0.0003D0) as value from cells
 join rt a on a.s = cells.r join ct b on b.s = cells.c where value <> -9999.0D0 and a.w*b.w <> 0 group by month, a.i, b.i having sum(a.w*b.w) > 0.000001""")
def reproject_bilinear(t):
    out = gr.resample(t.cells.select(*CELL), GRID, MERCATOR, "bilinear", ["month"])
    return out.withColumn("value", F.round(col("value") / 1000.0 + 0.0003))


# ------------------------------------------------------------------ mosaics and tiles


@query("mosaic", "cells", "select r, c, arg_min(value, month) as value from cells where value <> -9999.0D0 group by r, c")
def mosaic(t):
    return gr.mosaic(t.cells.select(*CELL).where("value <> -9999"), "month")


@query("downsample", "cells", "select month, cast(r/6 as int) as r, cast(c/6 as int) as c, value from cells where r % 6 = 0 and c % 6 = 0")
def downsample(t):
    return gr.downsample(t.cells.select(*CELL), 200, 200, 30)


@query("tile_grid", "boxes", """
with s as (select *, abs(right_x-left_x)*111000*abs(top_y-bottom_y)*111000 < 150000.0D0*150000 as small,
   ceil((right_x-left_x)/(150000/111000.0D0)) as nx, ceil((top_y-bottom_y)/(150000/111000.0D0)) as ny from boxes)
select box_id, cast(i as int) as i, cast(j as int) as j, left_x + i*(150000/111000.0D0) as tile_left, bottom_y + j*(150000/111000.0D0) as tile_bottom,
  case when small then right_x else least(left_x + i*(150000/111000.0D0) + (150000/111000.0D0), right_x) end as tile_right,
  case when small then top_y else least(bottom_y + j*(150000/111000.0D0) + (150000/111000.0D0), top_y) end as tile_top
from s, range(40) p(i), range(40) q(j) where case when small then i = 0 and j = 0 else i < nx and j < ny end""")
def tile_grid(t):
    boxes = t.boxes.select("box_id", *[c.alias(n) for c, n in zip(_box(), gr.BOX)])
    return gr.tile_grid(boxes, 150000).drop(*gr.BOX)


@query("metric_cell_count", "buildings", f"""
select concat_ws('_', cast(floor(({ot.albers_x('longitude', 'latitude')} + 6000000.0D0)/15000.0D0) as bigint),
  cast(floor(({ot.albers_y('longitude', 'latitude')} + 1000000.0D0)/15000.0D0) as bigint)) as grid_id, count(*) as n from buildings group by 1""")
def metric_cell_count(t):
    return gr.count_per_cell(gr.metric_cell(t.buildings, -6000000.0, -1000000.0, 15000.0))


@query("metric_grid", "boxes", f"""
with b as (select box_id, least({', '.join(ot.albers_x(*c) for c in _CORNERS)}) as x0, least({', '.join(ot.albers_y(*c) for c in _CORNERS)}) as y0,
  greatest({', '.join(ot.albers_x(*c) for c in _CORNERS)}) as x1, greatest({', '.join(ot.albers_y(*c) for c in _CORNERS)}) as y1 from boxes)
select box_id, concat_ws('_', i, j) as grid_id from b, range(40) p(i), range(40) q(j) where i < ceil((x1-x0)/50000.0D0) and j < ceil((y1-y0)/50000.0D0)""")
def metric_grid(t):
    boxes = t.boxes.select("box_id", *[c.alias(n) for c, n in zip(_box(), gr.BOX)])
    return gr.metric_grid(boxes, 50000.0).select("box_id", "grid_id")


@query("adaptive_partition", "buildings", """
with p as (select building_id, least(63, greatest(0, cast(floor((longitude + 20.0D0)/0.15625D0) as int))) as i,
   least(63, greatest(0, cast(floor(latitude/0.15625D0) as int))) as j from buildings),
d as (select building_id, d, i >> (6 - d) as ci, j >> (6 - d) as cj, count(*) over (partition by d, i >> (6 - d), j >> (6 - d)) as n from p, range(7) q(d)),
ok as (select building_id, min(d) as d from d where n <= 20 or d = 6 group by building_id)
select d.building_id, cast(d.d as int) as depth, concat_ws('_', cast(d.d as int), cast(ci as int), cast(cj as int)) as cell_id, n as cell_count
from d join ok on d.building_id = ok.building_id and d.d = ok.d""".replace("i >> (6 - d)", "i >> cast(6 - d as int)").replace("j >> (6 - d)", "j >> cast(6 - d as int)"))
def adaptive_partition(t):
    points = t.buildings.select("building_id", "longitude", "latitude")
    split = gr.adaptive_partition(points, -20.0, 0.0, 10.0, limit=20, min_size=0.001, depth=6, x="longitude", y="latitude")
    return split.select("building_id", "depth", "cell_id", "cell_count")
