"""Descriptions of rasters and feature tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellweave.functions.crs import is_geographic
from cellweave.functions.raster import mask_nodata

col = F.col

# fixed value: kilometres per degree of the rough area
KM_PER_DEGREE = 111.32


def raster_summary(cells: DataFrame, keys: Sequence[str] = (), nodata: float | None = None) -> DataFrame:
    """Min, max, mean, std, valid and total pixels; nodata or NaN left out."""
    masked = mask_nodata(cells, nodata) if nodata is not None else cells
    v = F.when(~F.isnan("value"), col("value"))
    return masked.withColumn("value", v).groupBy(*keys).agg(
        F.min("value").alias("min"),
        F.max("value").alias("max"),
        F.avg("value").alias("mean"),
        F.stddev_pop("value").alias("std"),
        F.count("value").alias("valid_pixels"),
        F.count("*").alias("total_pixels"),
    )


def raster_info(rasters: DataFrame) -> DataFrame:
    """Bounds, pixel size and the rough area in km2 (geographic rasters only)."""
    right = col("left") + col("width") * col("px_w")
    bottom = col("top") - col("height") * col("px_h")
    area = (right - col("left")) * (col("top") - bottom) * F.lit(KM_PER_DEGREE) * F.lit(KM_PER_DEGREE)
    return rasters.withColumns(
        {
            "right": right,
            "bottom": bottom,
            "pixel_size_x": F.abs("px_w"),
            "pixel_size_y": F.abs("px_h"),
            "approximate_area_km2": F.when(F.coalesce(col("crs"), F.lit("")) == "EPSG:4326", area),
        }
    )


def vector_info(vertices: DataFrame, feature: str = "feature_id", geom_type: str = "geom_type") -> DataFrame:
    """One row per geometry type: features and bounds of vertex rows ``x, y``."""
    return vertices.groupBy(geom_type).agg(
        F.count_distinct(feature).alias("features"),
        F.min("x").alias("min_x"),
        F.min("y").alias("min_y"),
        F.max("x").alias("max_x"),
        F.max("y").alias("max_y"),
    )


def total_area_km2(edges: DataFrame, feature: Sequence[str], crs: str | None = None) -> DataFrame:
    """Summed polygon area in km2, in Albers when the CRS is geographic."""
    from cellweave.functions.crs import to_albers
    from cellweave.operators.geometry import polygon_area, project_edges

    planar = project_edges(edges, to_albers) if is_geographic(crs) else edges
    return polygon_area(planar, list(feature), "km2").agg(F.sum("area_km2").alias("total_area_km2"))
