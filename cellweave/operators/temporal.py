"""Monthly rasters: month detection, completeness, and statistics over time."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cellweave.functions.text import month_from_filename, month_from_tag
from cellweave.session import cut_lineage

# fixed values: months of the named seasons
SEASONS = {"DJF": (12, 1, 2), "MAM": (3, 4, 5), "JJA": (6, 7, 8), "SON": (9, 10, 11)}

_STATS = {
    "mean": F.avg,
    "median": F.median,
    "sum": F.sum,
    "min": F.min,
    "max": F.max,
    "std": F.stddev_pop,
}


def detect_months(
    files: DataFrame,
    how: str = "auto",
    path: str = "path",
    tags: str | None = None,
    tag_key: str = "temporal_period",
    patterns: Sequence[tuple[str, int]] | None = None,
    mapping: Mapping[str, int] | None = None,
    skip_undetected: bool = True,
    keys: Sequence[str] = (),
    check: bool = True,
) -> DataFrame:
    """Files with a ``month`` column; files without a month are dropped or an error.

    ``keys`` name the series a file belongs to (none: all files are one series).  Two files
    of a series with the same month are an error.
    """
    name, tag = month_from_filename(F.col(path), patterns), None
    if tags is not None:
        tag = month_from_tag(F.col(tags), tag_key)
    if how == "auto":
        month = name if tag is None else F.coalesce(name, tag)
    elif how == "filename":
        month = name
    elif how == "metadata":
        if tag is None:
            raise ValueError("month detection by metadata needs a tags column")
        month = tag
    elif how == "manual":
        if mapping is None:
            raise ValueError("manual month detection needs a mapping")
        pairs = [v for item in mapping.items() for v in (F.lit(item[0]), F.lit(int(item[1])))]
        month = F.create_map(*pairs)[F.regexp_extract(F.col(path), r"[^/]*$", 0)]
    else:
        raise ValueError(f"unknown month detection {how!r}")
    # a small file is one task, however many names it holds, and each is searched for several patterns
    spread = files.repartition(files.sparkSession.sparkContext.defaultParallelism)
    found = cut_lineage(spread.withColumn("month", month))  # else a filter would be moved before the spreading
    if check:
        report = found.agg(F.count_if(F.col("month").isNull()).alias("n")).first()
        if report["n"] and not skip_undetected:
            raise ValueError(f"no month in {report['n']} file(s); with skip_undetected and check off they have a NULL month")
        twice = duplicate_months(found, keys).count()
        if twice:
            raise ValueError(f"several files for one month in {twice} case(s); duplicate_months lists them")
    return found.where(F.col("month").isNotNull())


def duplicate_months(files: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Months that several files of a series claim."""
    return (
        files.where(F.col("month").isNotNull()).groupBy(*keys, "month").agg(F.count("*").alias("n")).where("n > 1")
    )


def missing_months(
    detected: DataFrame, keys: Sequence[str] = (), required: Sequence[int] = tuple(range(1, 13))
) -> DataFrame:
    """Required months without a file, per series."""
    wanted = F.explode(F.array(*[F.lit(int(m)) for m in required]))
    if keys:
        series = detected.select(*keys).distinct().withColumn("month", wanted)
    else:
        series = detected.sparkSession.range(1).select(wanted.alias("month"))
    return series.join(detected.select(*keys, "month"), [*keys, "month"], "left_anti")


def require_complete(detected: DataFrame, required: Sequence[int] = tuple(range(1, 13))) -> DataFrame:
    """``detected`` itself, or an error naming the missing months."""
    missing = sorted(r["month"] for r in missing_months(detected, (), required).collect())  # at most 12
    if missing:
        raise ValueError(f"incomplete monthly data, missing {missing}")
    return detected


def _masked(value: Column, nodata: float | None) -> Column:
    """Equality masks a set nodata; without one, NaN and infinities are left out."""
    if nodata is None:
        return F.when(~F.isnan(value) & (F.abs(value) != F.lit(float("inf"))), value)
    return F.when(F.isnan(value) | (value != F.lit(float(nodata))), value)


def temporal_stat(
    cells: DataFrame,
    stat: str,
    nodata: float | None = None,
    by: Sequence[str] = (),
    cell: Sequence[str] = ("r", "c"),
    value: str = "value",
) -> DataFrame:
    """Per-cell statistic over time.  A cell that is nodata throughout keeps nodata (or NaN).

    With a nodata value, NaN is an ordinary value and makes every statistic of its cell NaN.

    The time axis is just the rows of a (cell) group, so partial aggregation reduces the
    stack before the only shuffle; a group holds one row per time step.
    """
    if stat not in _STATS:
        raise ValueError(f"unknown statistic {stat!r}, choose from {', '.join(_STATS)}")
    empty = float("nan") if nodata is None else float(nodata)
    masked = _masked(F.col(value), nodata)
    agg = F.when(F.bool_or(F.isnan(masked)), F.lit(float("nan"))).otherwise(_STATS[stat](masked))
    return cells.groupBy(*by, *cell).agg(F.coalesce(agg, F.lit(empty)).alias(value))


def seasonal_stat(
    cells: DataFrame,
    stat: str,
    seasons: Mapping[str, Sequence[int]] = SEASONS,
    nodata: float | None = None,
    month: str = "month",
    cell: Sequence[str] = ("r", "c"),
    check: bool = True,
) -> DataFrame:
    """:func:`temporal_stat` within each season; a month may belong to several seasons."""
    belongs = F.array_compact(
        F.array(
            *[F.when(F.col(month).isin([int(m) for m in months]), F.lit(name)) for name, months in seasons.items()]
        )
    )
    chosen = cells.withColumn("season", F.explode(belongs))
    if check and chosen.isEmpty():
        raise ValueError("no raster matches the requested months")
    return temporal_stat(chosen, stat, nodata, by=["season"], cell=cell)


def summary_table(results: DataFrame, keys: Sequence[str], months: str | None = None) -> DataFrame:
    """Spatial mean, min, max and std of each result raster, with its month count."""
    aggs = [
        F.avg("value").alias("mean"),
        F.min("value").alias("min"),
        F.max("value").alias("max"),
        F.stddev_pop("value").alias("std"),
    ]
    if months:
        aggs.append(F.max(months).alias("months"))
    return results.groupBy(*keys).agg(*aggs)


def spatial_mismatches(rasters: DataFrame, order: str = "path") -> DataFrame:
    """Rasters that differ from the first one in CRS, size or transform, with the first reason.

    The first raster is found by an aggregate, so no row order has to be kept.
    """
    shape = ["crs", "width", "height", "px_w", "px_h", "left", "top"]
    first = rasters.agg(F.min_by(F.struct(*shape), order).alias("ref"))
    same = lambda *names: F.lit(True) if not names else _all([F.col(n).eqNullSafe(F.col(f"ref.{n}")) for n in names])
    reason = (
        F.when(~same("crs"), "crs")
        .when(~same("width", "height"), "dimension")
        .when(~same("px_w", "px_h", "left", "top"), "transform")
    )
    return (
        rasters.join(F.broadcast(first))  # one row by construction
        .withColumn("mismatch", reason)
        .where(F.col("mismatch").isNotNull())
        .select(order, "mismatch")
    )


def _all(conditions: list[Column]) -> Column:
    out = conditions[0]
    for c in conditions[1:]:
        out = out & c
    return out
