"""Zonal, temporal, nodata, classification and imagery queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from cellweave.functions.raster import classify_by, cloud_mask, mask_nodata, mask_ranges, mask_values, scale_uint8
from cellweave.operators import classify as cl
from cellweave.operators import components as cc
from cellweave.operators import geometry as g
from cellweave.operators import imagery as im
from cellweave.operators import nodata as nd
from cellweave.operators import quality as ql
from cellweave.operators import quantiles as qt
from cellweave.operators import temporal as tm
from cellweave.operators import zonal as zn
from cellweave.plans.fixtures import GRID
from cellweave.plans.registry import query
from cellweave.session import sized_join

MEMBERS = """
with m as (select c.month, c.r, c.c, c.value, e.zone_id from cells c join edges e
           on (e.y1 > c.y) <> (e.y2 > c.y) and c.x < (e.x2-e.x1)*(c.y-e.y1)/(e.y2-e.y1)+e.x1
           group by all having count(*) % 2 = 1)
"""
CELL = ["month", "r", "c", "value"]


def _rounded(df, *names, digits=4):
    return df.withColumns({n: F.round(n, digits) for n in names})


@query("zonal_stats", "cells edges", MEMBERS + """
select zone_id, month, avg(value) as mean, max(value) as max, min(value) as min, round(stddev_pop(value), 4) as std,
  sum(value) as sum, count(value) as count
from (select zone_id, month, case when value <> -9999.0D0 then value end as value from m) v group by zone_id, month""")
def zonal_stats(t):
    stats = ["mean", "max", "min", "std", "sum", "count"]
    return _rounded(zn.zonal_stats(t.cells.select(*CELL), t.edges, GRID, stats, by=["month"]), "std")


@query("zonal_percentiles", "cells edges", MEMBERS + """
select zone_id, month, median(value) as median, round(quantile_cont(value, 0.25), 6) as percentile_25,
  round(quantile_cont(value, 0.75), 6) as percentile_75
from (select zone_id, month, case when value <> -9999.0D0 then value end as value from m) v group by zone_id, month""")
def zonal_percentiles(t):
    stats = ["median", "percentile_25", "percentile_75"]
    out = zn.zonal_stats(t.cells.select(*CELL), t.edges, GRID, stats, by=["month"])
    return _rounded(out, "percentile_25", "percentile_75", digits=6)


@query("zonal_percentiles_distributed", "cells edges", MEMBERS + """
select zone_id, count(*) as count, median(value) as median, round(quantile_cont(value, 0.25), 6) as percentile_25,
  round(quantile_cont(value, 0.9), 6) as percentile_90 from m where value <> -9999.0D0 group by zone_id""")
def zonal_percentiles_distributed(t):
    stats = ["count", "median", "percentile_25", "percentile_90"]
    out = zn.zonal_stats(t.cells.select(*CELL), t.edges, GRID, stats, small=False)
    return _rounded(out, "percentile_25", "percentile_90", digits=6)


@query("group_percentiles", "cells", """
select month, round(quantile_cont(value, 0.1), 6) as p10, quantile_cont(value, 0.5) as p50, max(value) as p100
from cells where value <> -9999.0D0 group by month""")
def group_percentiles(t):
    valid = mask_nodata(t.cells.select(*CELL), -9999.0)
    return _rounded(qt.group_percentiles(valid, ["month"], {"p10": 10.0, "p50": 50.0, "p100": 100.0}), "p10", digits=6)


@query("cells_in_zones", "cells edges", MEMBERS + "select * from m")
def cells_in_zones(t):
    return g.cells_in_zones(t.cells.select(*CELL), t.edges, GRID)


_MONTHLY = ", ".join(
    f"max(case when month = {m} then a end) as m{m:02d}_mean, max(case when month = {m} then b end) as m{m:02d}_max" for m in range(1, 13)
)


@query("enrich_zones", "cells edges zones", MEMBERS + f"""
, s as (select zone_id, month, avg(value) as a, max(value) as b from m where value <> -9999.0D0 group by zone_id, month)
select z.zone_id, z.name, z.country, {_MONTHLY} from zones z left join s on z.zone_id = s.zone_id group by z.zone_id, z.name, z.country""")
def enrich_zones(t):
    names = {m: f"m{m:02d}" for m in range(1, 13)}
    return zn.enrich_by_key(t.zones, t.cells.select(*CELL), t.edges, GRID, "month", names, ["mean", "max"])


@query("enrich_zones_datasets", "cells edges zones", MEMBERS + """
, s as (select zone_id, avg(value) as a, max(value) as b from m where value <> -9999.0D0 and month <= 6 group by zone_id)
, u as (select zone_id, avg(value) as a, max(value) as b from m where value <> -9999.0D0 and month > 6 group by zone_id)
select z.zone_id, z.name, z.country, s.a as first_half_mean, s.b as first_half_max, u.a as second_half_mean, u.b as second_half_max
from zones z left join s on z.zone_id = s.zone_id left join u on z.zone_id = u.zone_id""")
def enrich_zones_datasets(t):
    cells = t.cells.select(*CELL)
    parts = {
        "first_half": (cells.where("month <= 6"), GRID),
        "second_half": (cells.where("month > 6"), GRID),
    }
    return zn.enrich(t.zones, parts, t.edges, ["mean", "max"])


@query("mask_values", "cells", """
select month, r, c, case when value = 500000.0D0 or value = -9999.0D0 then -1.0D0 else value end as equal_value,
  case when value > 5000000.0D0 then -9999.0D0 else value end as greater_value,
  case when value < 2000000.0D0 then -9999.0D0 else value end as less_value from cells""")
def mask_values_query(t):
    df = t.cells.select(*CELL, F.col("value").alias("equal_value"), F.col("value").alias("greater_value"), F.col("value").alias("less_value"))
    df = mask_values(df, [500000.0, -9999.0], "equal", nodata=-1.0, value="equal_value")
    df = mask_values(df, 5000000.0, "greater", raster_nodata=-9999.0, value="greater_value")
    return mask_values(df, 2000000.0, "less", value="less_value").drop("value")


@query("mask_values_bands", "cells", """
select month, r, c, case when month in (1, 3) and (value >= 6000000.0D0 or value >= 9000000.0D0) then -9999.0D0 else value end as ge_value,
  case when month in (1, 3) and value <= 1000000.0D0 then 0.0D0 else value end as le_value from cells""")
def mask_values_bands(t):
    df = t.cells.select("month", "r", "c", F.col("value").alias("ge_value"), F.col("value").alias("le_value"))
    df = mask_values(df, [6000000.0, 9000000.0], "greater_equal", bands=[1, 3, 99], value="ge_value", band="month")
    return mask_values(df, 1000000.0, "less_equal", nodata=0.0, bands=[1, 3], value="le_value", band="month")


@query("mask_ranges", "cells", """
select month, r, c, case when value between 1000000.0D0 and 2000000.0D0 or value between 5000000.0D0 and 6000000.0D0
    then -9999.0D0 else value end as inside_value,
  case when value between 0.0D0 and 4000000.0D0 then value else -1.0D0 end as outside_value from cells""")
def mask_ranges_query(t):
    df = t.cells.select("month", "r", "c", F.col("value").alias("inside_value"), F.col("value").alias("outside_value"))
    df = mask_ranges(df, [(1e6, 2e6), (5e6, 6e6)], value="inside_value")
    return mask_ranges(df, [(0, 4e6)], inside=False, nodata=-1.0, value="outside_value")


@query("mask_nodata", "cells", """
select month, count(value) as pixels, count(case when abs(value + 9999.0D0) > 0.000001D0 then 1 end) as valid,
  sum(case when value <> -9999.0D0 then value end) as total from cells group by month""")
def mask_nodata_query(t):
    masked = mask_nodata(t.cells.select(*CELL), -9999.0)
    return masked.groupBy("month").agg(
        F.count("*").alias("pixels"), F.count("value").alias("valid"), F.sum("value").alias("total")
    )


for _name, _sql in {
    "mean": "avg(v)", "median": "median(v)", "sum": "sum(v)", "min": "min(v)", "max": "max(v)",
    "std": "round(stddev_pop(v), 4)",
}.items():

    def _temporal(t, stat=_name):
        out = tm.temporal_stat(t.cells.select(*CELL), stat, nodata=-9999.0)
        return _rounded(out, "value") if stat == "std" else out

    query(f"temporal_{_name}", "cells", f"""
    select r, c, coalesce({_sql}, -9999.0D0) as value
    from (select r, c, case when value <> -9999.0D0 then value end as v from cells) q group by r, c""")(_temporal)


@query("seasonal_mean", "cells", """
select season, r, c, coalesce(avg(case when value <> -9999.0D0 then value end), -9999.0D0) as value
from cells join (select 12 as m, 'DJF' as season union all select 1, 'DJF' union all select 2, 'DJF' union all
  select 3, 'MAM' union all select 4, 'MAM' union all select 5, 'MAM' union all select 6, 'JJA' union all select 7, 'JJA'
  union all select 8, 'JJA' union all select 9, 'SON' union all select 10, 'SON' union all select 11, 'SON' union all
  select 5, 'LONG' union all select 6, 'LONG' union all select 7, 'LONG' union all select 8, 'LONG' union all select 9, 'LONG') s
on s.m = cells.month group by season, r, c""")
def seasonal_mean(t):
    seasons = {**tm.SEASONS, "LONG": (5, 6, 7, 8, 9)}
    return tm.seasonal_stat(t.cells.select(*CELL), "mean", seasons, nodata=-9999.0)


@query("summary_table", "cells", """
select season, round(avg(value), 1) as mean, min(value) as min, max(value) as max, round(stddev_pop(value), 1) as std, max(n) as months
from (select case when month in (12, 1, 2) then 'DJF' when month in (3, 4, 5) then 'MAM' when month in (6, 7, 8) then 'JJA'
  else 'SON' end as season, r, c, max(value) as value, 3 as n from cells where value <> -9999.0D0 group by 1, 2, 3) q group by season""")
def summary_table(t):
    valid = t.cells.select(*CELL).where("value <> -9999")
    seasonal = tm.seasonal_stat(valid, "max", nodata=-9999.0).withColumn("months", F.lit(3))
    return _rounded(tm.summary_table(seasonal, ["season"], months="months"), "mean", "std", digits=1)


@query("period_stats", "cells edges", MEMBERS + """
, v as (select zone_id, r, c, cast(month as varchar) as period, value from m where value <> -9999.0D0),
a as (select zone_id, r, c, 'annual' as period, avg(value) as value from v group by zone_id, r, c)
select zone_id, period, round(avg(value), 3) as mean, min(value) as min, max(value) as max, round(stddev_pop(value), 2) as std,
  round(sum(value) * 27720) as sum_27720, count(value) as count from (select * from v union all select * from a) q group by zone_id, period""")
def period_stats(t):
    valid = mask_nodata(t.cells.select(*CELL), -9999.0)
    members = g.cells_in_zones(valid, t.edges, GRID).where("value is not null")
    monthly = members.withColumn("period", F.col("month").cast("string"))
    return comparable(zn.period_stats(monthly, ["zone_id"], "period"))


def comparable(stats):
    """Means over 1 to 12 months are multiples of 1/27720, so scaled sums are whole numbers."""
    out = _rounded(_rounded(stats, "mean", digits=3), "std", digits=2)
    return out.withColumn("sum_27720", F.round(F.col("sum") * 27720)).drop("sum")


@query("annual_mean", "cells", """
select r, c, avg(case when value <> -9999.0D0 then value end) as value from cells group by r, c""")
def annual_mean(t):
    return zn.annual_mean(mask_nodata(t.cells.select(*CELL), -9999.0))


@query("raster_summary", "cells", """
select month, min(v) as min, max(v) as max, avg(v) as mean, round(stddev_pop(v), 3) as std, count(v) as valid_pixels,
  count(*) as total_pixels from (select month, case when value <> -9999.0D0 then value end as v from cells) q group by month""")
def raster_summary(t):
    return _rounded(ql.raster_summary(t.cells.select(*CELL), ["month"], -9999.0), "std", digits=3)


# ------------------------------------------------------------------ nodata


@query("detect_nodata_common", "cells", """
select month, case when count(case when value = -9999.0D0 then 1 end) > 0.001 * count(*) then -9999.0D0 end as nodata
from cells group by month""")
def detect_nodata_common(t):
    return nd.detect_nodata_common(t.cells.select(*CELL), ["month"], "float64")


OUTLIER = """
, s as (select k, count(*) as n, avg(v) as mu, stddev_pop(v) as sd, quantile_cont(v, 0.001) as lo, quantile_cont(v, 0.999) as hi,
        list_sort(list(v)) as a from base group by k),
far as (select b.k, b.v, count(*) as cnt from base b join s on b.k = s.k where s.sd <> 0 and abs((b.v - s.mu)/s.sd) > 4 group by b.k, b.v),
tot as (select k, sum(cnt) as far from far group by k),
pick as (select far.k, max(far.v) as v from far join tot on far.k = tot.k join s on far.k = s.k
         where cnt > 0.5 * far and cnt > 0.001 * n group by far.k),
gap as (select k, case when a[cast(floor(n*0.01) as int) + 1] - a[1] > 0.1 * (a[n] - a[1]) and a[1] < lo
          and a[cast(floor(n*0.01) as int)] = a[1] then a[1] end as v from s)
"""


@query("detect_nodata_outlier", "cells", """
with base as (select month as k, case when value = -9999.0D0 and (r + c) % 3 = 0 then -900000000.0D0
    when value = -9999.0D0 then 5000000.0D0 else value end as v from cells)
""" + OUTLIER + """
select s.k as month, coalesce(pick.v, gap.v) as nodata from s left join pick on s.k = pick.k left join gap on s.k = gap.k
where s.n >= 100 and s.sd <> 0""")
def detect_nodata_outlier(t):
    sentinel = F.when((F.col("value") == -9999.0) & ((F.col("r") + F.col("c")) % 3 == 0), -9e8)
    value = sentinel.when(F.col("value") == -9999.0, 5e6).otherwise(F.col("value"))
    return nd.detect_nodata_outlier(t.cells.select("month", "r", "c", value.alias("value")), ["month"])


@query("detect_nodata", "cells", """
with base as (select month as k, value as v from cells)
""" + OUTLIER + """
, common as (select k, case when count(case when v = -9999.0D0 then 1 end) > 0.001 * count(*) then -9999.0D0 end as v from base group by k)
select common.k as month, coalesce(common.v, pick.v, gap.v) as nodata from common left join pick on common.k = pick.k
left join gap on common.k = gap.k""")
def detect_nodata(t):
    return nd.detect_nodata(t.cells.select(*CELL), ["month"])


@query("sample_windows", "cells", """
select month, r, c, value from cells where r between 36 and 163 and c between 36 and 163 union all
select month, r, c, value from cells where r <= 127 and c <= 127""")
def sample_windows(t):
    return nd.sample_windows(t.cells.select(*CELL), 200, 200, 16500)


MASK = "value > 7000000.0D0"
COMPONENTS = f"""
with recursive m as (select month, r, c from cells where {MASK}),
reach as (select month, r, c, r as r0, c as c0 from m
  union select m.month, m.r, m.c, reach.r0, reach.c0 from reach join m on m.month = reach.month
  and abs(m.r - reach.r) + abs(m.c - reach.c) = 1),
comp as (select month, r, c, min(cast(r0 as bigint) * 2147483648 + c0) as component from reach group by month, r, c)
"""


@query("connected_components", "cells", COMPONENTS + "select * from comp")
def connected_components(t):
    return cc.connected_components(t.cells.select(*CELL).where("value > 7000000"), ["month"])


@query("component_sizes", "cells", COMPONENTS + "select month, component, count(*) as size from comp group by month, component")
def component_sizes(t):
    return cc.component_sizes(connected_components(t), ["month"])


@query("spatial_coherence", "cells", COMPONENTS + """
, s as (select month, component, count(*) as size from comp group by month, component)
select month, round(least(1.0D0, max(size) / sum(size) / (1 + ln(count(*)))), 9) as coherence from s group by month""")
def spatial_coherence(t):
    mask = t.cells.select(*CELL).where("value > 7000000")
    return _rounded(nd.spatial_coherence(mask, ["month"]), "coherence", digits=9)


TRANSITIONS = """
, p as (select month, sum(case when value > 7000000.0D0 then 1 else 0 end) as n, count(*) as size from cells group by month),
d as (select a.month, sum(case when (a.value > 7000000.0D0) <> (b.value > 7000000.0D0) then 1 else 0 end) as t
  from cells a join cells b on a.month = b.month and ((a.r = b.r and b.c = a.c + 1) or (a.c = b.c and b.r = a.r + 1)) group by a.month)
"""


@query("transition_coherence", "cells", "with z as (select 1 as one)" + TRANSITIONS + """
select p.month, case when size < 4 then 1.0D0 when n = 0 then 0.0D0
  else greatest(0.0D0, least(1.0D0, 1.0D0 - coalesce(t, 0) / (4.0D0 * n))) end as coherence from p left join d on p.month = d.month""")
def transition_coherence(t):
    return nd.transition_coherence(t.cells.select(*CELL), F.col("value") > 7000000, ["month"])


@query("validate_nodata", "cells", """
with b as (select month, count(case when value = -9999.0D0 then 1 end) as n, count(*) as total,
  min(case when value <> -9999.0D0 then value end) as lo, max(case when value <> -9999.0D0 then value end) as hi from cells group by month),
k as (select month, n, total, n * 1.0D0 / total * 100 as share, lo, hi from b)
select month, n as nodata_pixels, total as total_pixels, share as nodata_percentage,
  round(1.0D0 / n / (1 + ln(n)), 9) as coherence,
  case when share between 0.1 and 50 then 0.3D0 else 0.0D0 end + case when -9999.0D0 < lo or -9999.0D0 > hi then 0.4D0 else 0.0D0 end
  + case when -9999.0D0 < lo and hi > lo and lo + 9999.0D0 > 0.1D0 * (hi - lo) then 0.2D0 else 0.0D0 end
  + case when 1.0D0 / n / (1 + ln(n)) > 0.5 then 0.1D0 else 0.0D0 end as confidence,
  case when share between 0.1 and 50 then 0.3D0 else 0.0D0 end + case when -9999.0D0 < lo or -9999.0D0 > hi then 0.4D0 else 0.0D0 end
  + case when -9999.0D0 < lo and hi > lo and lo + 9999.0D0 > 0.1D0 * (hi - lo) then 0.2D0 else 0.0D0 end
  + case when 1.0D0 / n / (1 + ln(n)) > 0.5 then 0.1D0 else 0.0D0 end > 0.6 as is_valid from k""")
def validate_nodata(t):
    # no two nodata cells of the view adjoin, so each is its own region
    return _rounded(nd.validate_nodata(t.cells.select(*CELL), -9999.0, ["month"]), "coherence", digits=9)


# ------------------------------------------------------------------ classes


@query("class_breaks_equal", "cells", """
, b as (select month, min(value) as lo, max(value) as hi from cells where value <> -9999.0D0 group by month)
select month, i, case when i = 8 then hi else lo + i * ((hi - lo) / 8.0D0) end as brk from b cross join range(9) q(i)""".replace(", b as", "with b as"))
def class_breaks_equal(t):
    valid = t.cells.select(*CELL).where("value <> -9999")
    return cl.class_breaks(valid, "equal_interval", 8, ["month"]).select("month", F.posexplode("breaks").alias("i", "brk"))


@query("class_breaks_quantile", "cells", """
select month, i, case i when 0 then quantile_cont(value, 0.0) when 1 then quantile_cont(value, 0.25) when 2 then quantile_cont(value, 0.5)
  when 3 then quantile_cont(value, 0.75) else quantile_cont(value, 1.0) end as brk
from cells cross join range(5) q(i) where value <> -9999.0D0 group by month, i""")
def class_breaks_quantile(t):
    valid = t.cells.select(*CELL).where("value <> -9999")
    return cl.class_breaks(valid, "quantile", 4, ["month"]).select("month", F.posexplode("breaks").alias("i", "brk"))


def _natural_oracle(source: str, bins: int, k: int) -> str:
    """Optimal classes of whole bins: a table of least costs per number of classes, then the way back."""
    return f"""
with recursive v as ({source}),
span as (select month, min(value) as lo, max(value) as hi from v group by month),
bin as (select v.month, least(coalesce(floor((value - lo) / nullif(hi - lo, 0.0D0) * {bins}.0D0), 0), {bins - 1}) as b, count(*) as w, sum(value) as s1,
  sum(value*value) as s2, min(value) as lo, max(value) as hi from v join span s on v.month = s.month group by 1, 2),
item as (select month, row_number() over (partition by month order by b) as i, lo, hi,
  sum(w) over z as w, sum(s1) over z as s1, sum(s2) over z as s2 from bin window z as (partition by month order by b)),
edge as (select month, i, w, s1, s2 from item union all select distinct month, 0, 0, 0.0D0, 0.0D0 from item),
spread as (select a.month, a.i as i, e.i as e, greatest(e.s2 - a.s2 - (e.s1 - a.s1)*(e.s1 - a.s1)/(e.w - a.w), 0.0D0) as d
  from edge a join edge e on a.month = e.month and a.i < e.i),
best as (
  select month, 1 as c, list(d order by e) as cost, list(cast(0 as bigint) order by e) as back from spread where i = 0 group by month
  union all
  select month, c, list(d order by e), list(cast(i as bigint) order by e) from (
    select s.month, b.c + 1 as c, s.e, min(case when s.i > 0 then b.cost[s.i] end + s.d) as d,
      arg_min(s.i, case when s.i > 0 then b.cost[s.i] end + s.d) filter (s.i >= b.c) as i
    from best b join spread s on b.month = s.month where b.c < {k} group by s.month, b.c, s.e) q group by month, c),
way as (
  select m.month, {k} as c, m.m as e from (select month, max(i) as m from item group by month) m
  union all
  select w.month, w.c - 1, b.back[w.e] from way w join best b on b.month = w.month and b.c = w.c where w.c > 0),
brk as (select w.month, w.c as i, case when w.c = 0 then (select min(lo) from item t where t.month = w.month) else t.hi end as brk
  from way w left join item t on t.month = w.month and t.i = w.e)
"""


@query("class_breaks_jenks", "cells", _natural_oracle("select month, value from cells where value <> -9999.0D0", cl.BINS, 5) + """
select month, cast(i as int) as i, brk from brk""")
def class_breaks_jenks(t):
    valid = t.cells.select(*CELL).where("value <> -9999")
    return cl.class_breaks(valid, "jenks", 5, ["month"]).select("month", F.posexplode("breaks").alias("i", "brk"))


@query("class_breaks_log", "cells", _natural_oracle("select month, log10(value) as value from cells where value > 0", cl.BINS, 5) + """
select month, cast(i as int) as i, round(pow(10.0D0, brk), 2) as brk from brk""")
def class_breaks_log(t):
    valid = t.cells.select(*CELL).where("value <> -9999")
    breaks = cl.class_breaks(valid, "log", 5, ["month"]).select("month", F.posexplode("breaks").alias("i", "brk"))
    return breaks.withColumn("brk", F.round("brk", 2))


@query("classify_cells", "cells", """
, b as (select month as k, min(value) as lo, max(value) as hi from cells where value <> -9999.0D0 group by month)
select month, r, c, case when value <> -9999.0D0 then cast(case when value >= hi then 8 else
  (select count(*) from range(8) q(i) where lo + i * ((hi - lo) / 8.0D0) <= value) - 1 end as int) end as class
from cells join b on month = k""".replace(", b as", "with b as"))
def classify_cells(t):
    valid = mask_nodata(t.cells.select(*CELL), -9999.0)
    breaks = cl.class_breaks(valid, "auto", 8, ["month"]).withColumnRenamed("month", "k")
    joined = sized_join(valid, breaks.withColumnRenamed("k", "month"), ["month"])
    return joined.select("month", "r", "c", classify_by(F.col("value"), F.col("breaks")).alias("class"))


@query("label_classes", "landcover", """
select month, value, n, colour, coalesce(label, concat('Class ', cast(value as varchar))) as label
from (select month, value, count(*) as n from landcover group by month, value) q join
  (select 10.0D0 as v, '#ffff64' as colour, 'Cropland' as label union all select 20.0D0, '#aaf0f0', 'Forest'
   union all select 60.0D0, '#ffb432', 'Settlement' union all select 100.0D0, '#123456', null) l on value = v""")
def label_classes(t):
    classes = t.landcover.groupBy("month", "value").agg(F.count("*").alias("n"))
    chosen = {v: cl.LAND_COVER[v] for v in (10, 20, 60)}
    legend = t.spark.createDataFrame(
        [(float(v), colour, label) for v, (colour, label) in chosen.items()] + [(100.0, "#123456", None), (70.0, None, "x")],
        "value double, colour string, label string",
    )
    return cl.label_classes(classes, legend)


# ------------------------------------------------------------------ imagery


SCENES = "select * from scenes where ts >= timestamp '2024-01-01 00:00:10' and ts < timestamp '2024-02-01 00:00:00' and cloudy_pct < 20"


@query("filter_scenes", "scenes", SCENES)
def filter_scenes(t):
    return im.filter_scenes(t.scenes, "2024-01-01 00:00:10", "2024-02-01", 20, check=False)


@query("cloud_mask", "scene_pixels", """
select scene_id, r, c, case when "SCL" not in (3, 8, 9, 10) then "B4" end as "B4",
  case when "SCL" not in (3, 8, 9, 10) then "B3" end as "B3", "SCL" from scene_pixels""")
def cloud_mask_query(t):
    return cloud_mask(t.scene_pixels.drop("B2"), ["B4", "B3"])


@query("median_composite", "scenes scene_pixels", f"""
with s as ({SCENES})
select r, c, median("B4") as "B4", median("B3") as "B3", median("B2") as "B2" from
 (select p.r, p.c, case when "SCL" not in (3, 8, 9, 10) then "B4" end as "B4", case when "SCL" not in (3, 8, 9, 10) then "B3" end as "B3",
  case when "SCL" not in (3, 8, 9, 10) then "B2" end as "B2" from scene_pixels p join s on p.scene_id = s.scene_id) q group by r, c""")
def median_composite(t):
    return im.median_composite(t.scene_pixels, filter_scenes(t))


@query("scale_uint8", "cells", """
select month, r, c, cast(floor(least(greatest(floor(value/1000.0D0) * 0.0001D0, 0.0D0), 0.3D0) * (255 / 0.3D0)) as int) as value from cells""")
def scale_uint8_query(t):
    return t.cells.select("month", "r", "c", scale_uint8(F.floor(F.col("value") / 1000.0)).alias("value"))


@query("detect_alpha", "rgba", """
with a as (select raster_id, min(value) as lo, count(distinct value) as n, count(case when value = 0 then 1 end) as zero
  from rgba where band = 4 and r < 100 and c < 100 group by raster_id)
select b.raster_id, coalesce(b.bands = 4 and n > 1 and (zero > 0 or lo < 200), false) as has_alpha
from (select raster_id, max(band) as bands from rgba group by raster_id) b left join a on a.raster_id = b.raster_id""")
def detect_alpha(t):
    return im.detect_alpha(t.rgba, ["raster_id"])


# ------------------------------------------------------------------ NaN

NAN_MEMBERS = MEMBERS.replace("from cells c", "from nan_cells c")
_NAN_STATS = """
select zone_id, month, count(value) as count, avg(value) as mean, median(value) as median, round(quantile_cont(value, 0.75), 6) as percentile_75
from (select zone_id, month, case when value <> -9999.0D0 and not isnan(value) then value end as value from m) v group by zone_id, month"""

for _name, _small in {"zonal_nan_small": True, "zonal_nan_large": False}.items():

    def _zonal_nan(t, small=_small):
        stats = ["count", "mean", "median", "percentile_75"]
        out = zn.zonal_stats(t.nan_cells.select(*CELL), t.edges, GRID, stats, by=["month"], small=small)
        return _rounded(out, "percentile_75", digits=6)

    query(_name, "cells nan_cells edges", NAN_MEMBERS + _NAN_STATS)(_zonal_nan)

_NAN_SQL = {"mean": "avg", "median": "median", "sum": "sum", "min": "min", "max": "max", "std": "stddev_pop"}

for _stat, _function in _NAN_SQL.items():

    def _temporal_nan(t, stat=_stat):
        out = tm.temporal_stat(t.nan_cells.select(*CELL), stat, nodata=-9999.0)
        return out.withColumn("value", F.round("value", 4))

    query(f"temporal_nan_{_stat}", "cells nan_cells", f"""
select r, c, case when bool_or(isnan(value)) then cast('NaN' as double) else
  round(coalesce({_function}(case when value <> -9999.0D0 and not isnan(value) then value end), -9999.0D0), 4) end as value
from nan_cells group by r, c""")(_temporal_nan)
