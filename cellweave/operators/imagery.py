"""Satellite scenes: selection and cloud-free composites."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellweave.functions.raster import cloud_mask

RGB = ("B4", "B3", "B2")


def filter_scenes(
    scenes: DataFrame, start: str, end: str, max_cloud: float = 20, ts: str = "ts", check: bool = True
) -> DataFrame:
    """Scenes from ``start`` up to, not including, ``end`` with less than ``max_cloud`` percent."""
    at = F.col(ts)
    out = scenes.where(
        (at >= F.lit(start).cast("timestamp"))
        & (at < F.lit(end).cast("timestamp"))
        & (F.col("cloudy_pct") < F.lit(float(max_cloud)))
    )
    if check and out.isEmpty():
        raise ValueError(f"no scene between {start} and {end} with cloud below {max_cloud} %")
    return out


def median_composite(
    pixels: DataFrame,
    scenes: DataFrame | None = None,
    bands: Sequence[str] = RGB,
    cell: Sequence[str] = ("r", "c"),
    scene: str = "scene_id",
    masked: bool = False,
) -> DataFrame:
    """Per-cell median of each band over the surviving scenes, clouds left out.

    A group holds one pixel per scene, so its size is the depth of the stack.
    """
    from cellweave.session import sized_join

    wanted = pixels.select(scene, *cell, *bands, *([] if masked else ["SCL"]))
    if scenes is not None:
        wanted = sized_join(wanted, scenes.select(scene), [scene], "left_semi")
    if not masked:
        wanted = cloud_mask(wanted, bands)
    return wanted.groupBy(*cell).agg(*[F.median(b).alias(b) for b in bands])


def detect_alpha(cells: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """``keys, has_alpha``: four bands, the last of which looks like transparency in the
    top-left 100 by 100 window (several values, with 0 or one below 200)."""
    corner = cells.where((F.col("band") == 4) & (F.col("r") < 100) & (F.col("c") < 100))
    look = corner.groupBy(*keys).agg(
        F.min("value").alias("lo"), F.max("value").alias("hi"), F.bool_or(F.col("value") == 0).alias("zero")
    )
    four = cells.groupBy(*keys).agg((F.max("band") == 4).alias("four"))
    joined = four.join(look, list(keys), "left") if keys else four.join(look, F.lit(True), "left")
    alpha = F.col("four") & (F.col("hi") > F.col("lo")) & (F.col("zero") | (F.col("lo") < 200))
    return joined.select(*keys, F.coalesce(alpha, F.lit(False)).alias("has_alpha"))
