"""User-level jobs: chains of the operators over whole tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellweave.functions import crs, s2
from cellweave.functions.raster import mask_nodata, scale_uint8
from cellweave.operators import buildings as bd
from cellweave.operators import geometry as g
from cellweave.operators import grid as gr
from cellweave.operators import imagery as im
from cellweave.operators import places as pl
from cellweave.operators import roads as rd
from cellweave.operators import temporal as tm
from cellweave.operators import zonal as zn
from cellweave.schema import Grid
from cellweave.session import sized_join


def city_enrichment(
    zones: DataFrame, edges: DataFrame, cells: DataFrame, src: Grid, ref: Grid, stats: Sequence[str], name: str,
    countries: Sequence | None = None, country: str = "country", method: str = "average",
) -> DataFrame:
    """Chosen zones with statistics of a raster brought onto the reference grid, and their area."""
    chosen = pl.filter_in(zones, country, countries, check=False)
    outline = sized_join(edges, chosen.select("zone_id"), ["zone_id"], "left_semi")
    clipped = g.clip_raster(cells, outline, src, all_touched=True, zone="zone_id")
    aligned, grid = gr.align(clipped, src, ref, method)
    enriched = zn.enrich(chosen, {name: (aligned, grid)}, outline, stats)
    area = g.polygon_area(g.project_edges(outline, crs.to_albers), ["zone_id"], "km2")
    return enriched.join(area, "zone_id", "left")


def buildings_for_aoi(
    buildings: DataFrame, aoi: DataFrame, key: str, confidence: float, min_area: float, max_area: float | None = None,
    exact: bool = True, level: int = 6, token: str | None = None, zone: str | None = None,
) -> DataFrame:
    """Buildings of an AOI: cell tokens prune, cheap filters run next, the exact test last."""
    box = g.bounds(aoi)
    if token is not None:
        tokens = s2.covering(box.withColumn("one", F.lit(1)), ["one"], level).select(F.col("token").alias(token))
        buildings = sized_join(buildings, tokens, [token], "left_semi", bound=6 * 4**level)
    b = box.first()  # one row
    kept = bd.filter_confidence(buildings, confidence)
    kept = bd.filter_area(kept, min_area, max_area)
    kept = bd.filter_bbox(kept, (b["min_x"], b["min_y"], b["max_x"], b["max_y"]))
    if not exact:
        return kept
    return g.points_in_area(kept, aoi, [key], "longitude", "latitude", zone)


def roads_for_area(
    roads: DataFrame, aoi: DataFrame, types: Sequence[str], attributes: Sequence[str], utm: int, south: bool = False,
    zone: str | None = None,
) -> DataFrame:
    """Roads cut to the AOI, filtered, cleaned, de-duplicated and measured."""
    one = rd.dedupe(rd.validate_segments(roads))
    one = rd.filter_road_type(one, types)
    one = rd.clean_road_attributes(rd.select_road_attributes(one, attributes))
    pieces = g.clip_lines(one, aoi, ["osm_id"], zone=zone)
    planar = g.project_edges(pieces, lambda x, y: crs.to_utm(x, y, utm, south))
    lengths = planar.groupBy("osm_id").agg(
        F.count("*").alias("pieces"), F.sum(F.hypot(F.col("x2") - F.col("x1"), F.col("y2") - F.col("y1"))).alias("length_m")
    )
    return one.drop("x1", "y1", "x2", "y2").join(lengths, "osm_id")


def emissions_report(cells: DataFrame, edges: DataFrame, grid: Grid, month: str, year: int) -> DataFrame:
    """Statistics per place for every month and for the annual mean raster."""
    valid = mask_nodata(cells.select(month, "r", "c", "value"), grid.nodata)
    members = g.cells_in_zones(valid, edges, grid)
    keyed = members.withColumn("period", F.format_string(f"{year}-%02d", F.col(month)))
    return zn.period_stats(keyed, ["zone_id"], "period")


def annual_air_quality(
    cells: DataFrame, aoi: DataFrame, grid: Grid, stats: Sequence[str] = ("mean", "max"), seasons: Mapping | None = None,
    zone: str | None = None,
) -> DataFrame:
    """Spatial summary of each annual and seasonal statistic raster inside the AOI."""
    valid = mask_nodata(g.clip_raster(cells, aoi, grid, zone=zone), grid.nodata).where("value is not null")
    parts = []
    for stat in stats:
        year = tm.temporal_stat(valid, stat, nodata=grid.nodata).withColumn("season", F.lit("annual"))
        by_season = tm.seasonal_stat(valid, stat, seasons or tm.SEASONS, nodata=grid.nodata, check=False)
        parts.append(year.unionByName(by_season).withColumn("statistic", F.lit(stat)))
    return tm.summary_table(pl.union_parts(parts), ["season", "statistic"])


def cloud_free_composite(
    pixels: DataFrame, scenes: DataFrame, start: str, end: str, max_cloud: float = 20, bands: Sequence[str] = im.RGB
) -> DataFrame:
    """8-bit median composite of the scenes with little cloud."""
    kept = im.filter_scenes(scenes, start, end, max_cloud, check=False)
    composite = im.median_composite(pixels, kept, bands)
    return composite.withColumns({b: scale_uint8(F.col(b)) for b in bands})
