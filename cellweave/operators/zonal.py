"""Zonal statistics: cells per polygon, joined by scanline spans."""

from __future__ import annotations

import warnings
from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType

from cellweave.functions.raster import mask_nodata
from cellweave.operators.geometry import cells_in_zones
from cellweave.operators.quantiles import SMALL_ROWS, group_percentiles
from cellweave.schema import Grid
from cellweave.session import is_small

DEFAULT_STATS = ("mean", "max", "min")

_SIMPLE: dict[str, Callable[[Column], Column]] = {
    "mean": F.avg,
    "max": F.max,
    "min": F.min,
    "std": F.stddev_pop,
    "sum": F.sum,
    "count": F.count,
}


def split_stats(stats: Sequence[str]) -> tuple[list[str], dict[str, float]]:
    """Plain aggregates and rank statistics; an unknown name is an error."""
    simple, ranks = [], {}
    for s in stats:
        if s in _SIMPLE:
            simple.append(s)
        elif s == "median":
            ranks[s] = 50.0
        elif s.startswith("percentile_") and s[11:].replace(".", "", 1).isdigit() and float(s[11:]) <= 100:
            ranks[s] = float(s[11:])
        else:
            raise ValueError(f"unknown statistic {s!r}")
    return simple, ranks


def grouped_stats(
    df: DataFrame, keys: Sequence[str], stats: Sequence[str], value: str = "value", small: bool | None = None
) -> DataFrame:
    """Statistics per group over the values that are numbers: NULL and NaN are nodata.

    Rank statistics use the built-in exact ``percentile`` while the
    whole input is counted to be small, else the distributed ranking."""
    simple, ranks = split_stats(stats)
    keys = list(keys)
    if isinstance(df.schema[value].dataType, (DoubleType, FloatType)):
        df = df.withColumn(value, F.when(~F.isnan(value), F.col(value)))
    if ranks and small is None:
        small = is_small(df.select(*keys), SMALL_ROWS)
    aggs = [_SIMPLE[s](F.col(value)).alias(s) for s in simple]
    if ranks and small:
        aggs += [F.percentile(value, F.lit(p / 100.0)).alias(s) for s, p in ranks.items()]
    if ranks and not small:
        out = df.groupBy(*keys).agg(*(aggs or [F.count(value).alias("__n")]))
        extra = group_percentiles(df, keys, ranks, value, small=False)
        return out.join(extra, keys, "left").select(*keys, *stats)
    return df.groupBy(*keys).agg(*aggs).select(*keys, *stats)


def zonal_stats(
    cells: DataFrame,
    edges: DataFrame,
    grid: Grid,
    stats: Sequence[str] = DEFAULT_STATS,
    by: Sequence[str] = (),
    zone: str = "zone_id",
    small: bool | None = None,
    crs: str | None = None,
) -> DataFrame:
    """One row per zone and ``by`` key (raster) over the valid cells of the zone.

    The cell side is filtered, pruned and streamed through a join with the zone spans; what
    is shuffled are partial aggregates only.  Zones without cells have no row here, see
    :func:`enrich`.
    """
    _, ranks = split_stats(stats)
    if ranks and small is None:
        small = is_small(cells.select("r"), SMALL_ROWS)  # zones may overlap, cells bound each zone
    valid = mask_nodata(cells.select(*by, "r", "c", "value"), grid.nodata)
    members = cells_in_zones(valid, edges, grid, zone, crs=crs)
    return grouped_stats(members, [zone, *by], stats, small=small)


def enrich(
    zones: DataFrame,
    datasets: dict[str, tuple[DataFrame, Grid]],
    edges: DataFrame,
    stats: Sequence[str] = DEFAULT_STATS,
    zone: str = "zone_id",
    crs: str | None = None,
) -> DataFrame:
    """All zone columns plus ``{dataset}_{stat}`` for every raster; no overlap gives NULL.

    Every raster may have its own grid and CRS; zones in ``crs`` are projected to it.  A
    raster that can not be used is skipped with a warning and leaves NULL columns.  All rasters are reduced together and pivoted with
    an explicit list, so no extra pass finds the names.
    """
    split_stats(stats)  # an unknown statistic is an error, not a failed raster
    parts = []
    for name, (cells, grid) in datasets.items():
        try:
            part = zonal_stats(cells, edges, grid, stats, zone=zone, crs=crs)
        except (ValueError, AnalysisException) as problem:
            warnings.warn(f"skipped raster {name}: {problem}", stacklevel=2)
            continue
        parts.append(part.withColumn("dataset", F.lit(name)))
    if not parts:
        raise ValueError("none of the rasters could be used")
    wide = reduce(DataFrame.unionByName, parts).groupBy(zone)
    columns = [
        F.max(F.when(F.col("dataset") == name, F.col(s))).alias(f"{name}_{s}") for name in datasets for s in stats
    ]
    return zones.join(wide.agg(*columns), zone, "left")


def enrich_by_key(
    zones: DataFrame,
    cells: DataFrame,
    edges: DataFrame,
    grid: Grid,
    key: str,
    names: dict,
    stats: Sequence[str] = DEFAULT_STATS,
    zone: str = "zone_id",
) -> DataFrame:
    """As :func:`enrich` for rasters on one grid told apart by ``key``; ``names[key value]``
    is the column prefix.  One pass over the cells."""
    long = zonal_stats(cells.where(F.col(key).isin(list(names))), edges, grid, stats, by=[key], zone=zone)
    columns = [
        F.max(F.when(F.col(key) == k, F.col(s))).alias(f"{name}_{s}") for k, name in names.items() for s in stats
    ]
    return zones.join(long.groupBy(zone).agg(*columns), zone, "left")


def period_stats(
    cells: DataFrame, places: Sequence[str], period: str, cell: Sequence[str] = ("r", "c")
) -> DataFrame:
    """Mean, min, max, std, sum and count per place and period, plus period ``annual``.

    The annual row describes the per-cell mean over the periods.  NULL values are nodata;
    a place without valid cells gets NaN statistics and count 0.
    """
    keys = list(places)
    annual = annual_mean(cells, keys, cell).withColumn(period, F.lit("annual"))
    long = cells.select(*keys, period, *cell, "value").unionByName(annual.select(*keys, period, *cell, "value"))
    stats = grouped_stats(long, [*keys, period], ["mean", "min", "max", "std", "sum", "count"])
    return stats.select(
        *keys,
        period,
        *[F.coalesce(s, F.lit(float("nan"))).alias(s) for s in ("mean", "min", "max", "std", "sum")],
        "count",
    )


def annual_mean(cells: DataFrame, places: Sequence[str] = (), cell: Sequence[str] = ("r", "c")) -> DataFrame:
    """Per-cell mean over all periods; nodata (NULL) is left out, NaN never counts."""
    value = F.when(~F.isnan("value"), F.col("value"))
    return cells.groupBy(*places, *cell).agg(F.avg(value).alias("value"))
