"""Building footprints: filters, column choice, summary."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellweave.operators.zonal import grouped_stats

# fixed values: default confidence and area limits
MIN_CONFIDENCE = 0.75
MIN_AREA_M2 = 10.0


def filter_confidence(df: DataFrame, threshold: float = MIN_CONFIDENCE) -> DataFrame:
    if not 0 <= threshold <= 1:
        raise ValueError("confidence threshold must be within 0 and 1")
    return df.where(F.col("confidence") >= F.lit(float(threshold)))


def filter_area(df: DataFrame, min_area: float = MIN_AREA_M2, max_area: float | None = None) -> DataFrame:
    """Inclusive on both ends; no maximum means open."""
    out = df.where(F.col("area_in_meters") >= F.lit(float(min_area)))
    return out if max_area is None else out.where(F.col("area_in_meters") <= F.lit(float(max_area)))


def filter_bbox(df: DataFrame, bounds: tuple[float, float, float, float]) -> DataFrame:
    """Inclusive on all sides of ``(min_lon, min_lat, max_lon, max_lat)``."""
    min_lon, min_lat, max_lon, max_lat = (F.lit(float(b)) for b in bounds)
    return df.where(F.col("longitude").between(min_lon, max_lon) & F.col("latitude").between(min_lat, max_lat))


def select_properties(
    df: DataFrame,
    confidence: bool = True,
    area: bool = True,
    plus_codes: bool = False,
) -> DataFrame:
    """Drop the columns that are not asked for; longitude and latitude always stay."""
    unwanted = [
        name
        for name, keep in (("confidence", confidence), ("area_in_meters", area), ("full_plus_code", plus_codes))
        if not keep
    ]
    return df.drop(*unwanted)


def limit_features(df: DataFrame, n: int | None, key: str) -> DataFrame:
    """At most ``n`` features, smallest keys first; ``None`` keeps all."""
    return df if n is None else df.orderBy(key).limit(n)


def building_summary(df: DataFrame) -> DataFrame:
    """One row: count, area (with its median) and confidence statistics.

    The median comes from the same ranking as the percentiles of zones, so it is exact at every size.
    """
    area, conf = F.col("area_in_meters"), F.col("confidence")
    median = grouped_stats(df.select(F.lit(0).alias("__all"), "area_in_meters"), ["__all"], ["median"], "area_in_meters")
    base = df.agg(
        F.count("*").alias("n"),
        F.avg(area).alias("area_mean"),
        F.min(area).alias("area_min"),
        F.max(area).alias("area_max"),
        F.avg(conf).alias("confidence_mean"),
        F.min(conf).alias("confidence_min"),
        F.max(conf).alias("confidence_max"),
    )
    # one row each
    return base.join(F.broadcast(median.select(F.col("median").alias("area_median"))), F.lit(True), "left")
