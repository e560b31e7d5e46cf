"""Road networks: type filter, attributes, validity, duplicates, summary."""

from __future__ import annotations

import warnings
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# fixed values: surface text per class
SURFACES = {
    "asphalt": "paved", "concrete": "paved", "paved": "paved",
    "unpaved": "unpaved", "gravel": "unpaved", "dirt": "unpaved", "ground": "unpaved",
}
GEOMETRY_COLUMNS = ("geometry", "parts", "geom_type", "x1", "y1", "x2", "y2")


def filter_road_type(df: DataFrame, types: Sequence[str] | str) -> DataFrame:
    """Roads any of whose ``;``-separated types is wanted; NULL never matches."""
    if types == "all" or "highway" not in df.columns:
        return df
    wanted = F.array(*[F.lit(t) for t in types])
    return df.where(F.arrays_overlap(F.transform(F.split("highway", ";"), lambda v: F.trim(v)), wanted))


def select_road_attributes(df: DataFrame, attributes: Sequence[str] | str) -> DataFrame:
    """Geometry, ``osm_id`` and ``highway`` always; unknown attributes are left out with a warning."""
    if attributes == "all":
        return df
    if "osm_id" not in df.columns and "id" in df.columns:
        df = df.withColumnRenamed("id", "osm_id")
    wanted = list(dict.fromkeys([*attributes, "highway"]))
    missing = [a for a in wanted if a not in df.columns]
    if missing:
        warnings.warn(f"attributes not in the data: {missing}", stacklevel=2)
    fixed = [c for c in ("osm_id", *GEOMETRY_COLUMNS) if c in df.columns]
    return df.select(*fixed, *[a for a in wanted if a in df.columns and a not in fixed])


def parse_lanes(lanes: Column) -> Column:
    """Number before ``;`` and ``-``, cut to an integer; else NULL."""
    head = F.trim(F.split(F.split(lanes.cast("string"), ";")[0], "-")[0])
    number = head.try_cast("double")
    usable = ~F.isnan(number) & (F.abs(number) < F.lit(2.0**31))
    return F.when(usable, number.cast("int"))


def clean_road_attributes(df: DataFrame) -> DataFrame:
    """Lanes to integers, texts trimmed, surface class added."""
    changes: dict[str, Column] = {c: F.trim(c) for c in ("name", "ref", "surface", "highway") if c in df.columns}
    if "lanes" in df.columns:
        changes["lanes"] = parse_lanes(F.col("lanes"))
    if "surface" in df.columns:
        table = F.create_map(*[F.lit(v) for pair in SURFACES.items() for v in pair])
        changes["surface_type"] = table[F.lower(F.trim("surface"))]
    return df.withColumns(changes) if changes else df


def validate_lines(df: DataFrame, parts: str = "parts", geom_type: str = "geom_type") -> DataFrame:
    """Lines with a geometry of at least two different vertices in every part.

    A line that is a single point is invalid, and mending it leaves nothing.
    """
    proper = F.forall(parts, lambda p: F.size(F.array_distinct(p)) >= 2)
    return df.where(
        F.col(parts).isNotNull()
        & (F.size(parts) > 0)
        & F.col(geom_type).isin("LineString", "MultiLineString")
        & proper
    )


def validate_segments(df: DataFrame) -> DataFrame:
    """As :func:`validate_lines` for single-segment roads ``x1, y1, x2, y2``."""
    present = F.col("x1").isNotNull() & F.col("y1").isNotNull() & F.col("x2").isNotNull() & F.col("y2").isNotNull()
    return df.where(present & ~((F.col("x1") == F.col("x2")) & (F.col("y1") == F.col("y2"))))


def dedupe(df: DataFrame, key: str = "osm_id", order: Sequence[str] | None = None) -> DataFrame:
    """One row per key, the first in ``order`` (all other columns unless given).

    Expressed as an aggregate, so copies of a hot key collapse before the shuffle.
    """
    if key not in df.columns:
        return df
    order = [c for c in (order or df.columns) if c != key]
    rest = [c for c in df.columns if c != key]
    if not rest:
        return df.distinct()
    pick = F.min_by(F.struct(*rest), F.struct(*order))
    return df.groupBy(key).agg(pick.alias("__row")).select(*[key if c == key else f"__row.{c}" for c in df.columns])


def dedupe_ranked(df: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """Window form of :func:`dedupe`, for rows too wide or types not orderable as a struct."""
    w = Window.partitionBy(key).orderBy(*order)
    return df.withColumn("__n", F.row_number().over(w)).where("__n = 1").drop("__n")


def network_summary(roads: DataFrame, length: str = "length_m") -> DataFrame:
    """Features and kilometres per road type, the most frequent type first."""
    return (
        roads.groupBy("highway")
        .agg(F.count("*").alias("features"), (F.sum(length) / 1000).alias("length_km"))
        .orderBy(F.desc("features"), "highway")
    )
