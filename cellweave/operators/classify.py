"""Class breaks of continuous rasters and labels of categorical ones."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cellweave.operators.quantiles import group_percentiles, value_counts
from cellweave.session import group_sizes, sized_join

col, lit = F.col, F.lit

#: Bins of equal width between the smallest and largest value, on which natural breaks are found.
BINS = 512

# fixed values: land cover classes: value → (colour, label)
LAND_COVER = {
    0: ("#000000", "No Data"),
    10: ("#ffff64", "Cropland"),
    20: ("#aaf0f0", "Forest"),
    30: ("#dcf064", "Grassland"),
    40: ("#c8c8c8", "Shrubland"),
    50: ("#006400", "Wetlands"),
    60: ("#ffb432", "Settlement"),
    70: ("#ffc85a", "Bare/sparse vegetation"),
    80: ("#0064c8", "Water bodies"),
    90: ("#ffffff", "Snow/ice"),
}


def label_classes(classes: DataFrame, legend: DataFrame, value: str = "value") -> DataFrame:
    """Classes with colour and label; without a colour a class is dropped, without a label it
    is ``Class v``."""
    colours = legend.where(col("colour").isNotNull()).select(col("value").alias(value), "colour", "label")
    named = F.coalesce("label", F.concat(lit("Class "), col(value).cast("string")))
    return sized_join(classes, colours, [value]).withColumn("label", named)


def _finite(cells: DataFrame) -> DataFrame:
    v = col("value")
    return cells.where(v.isNotNull() & ~F.isnan(v) & (F.abs(v) != lit(float("inf"))))


def _linspace(k: int) -> Column:
    steps = [col("lo") + lit(float(i)) * ((col("hi") - col("lo")) / lit(float(k))) for i in range(k)]
    return F.array(*steps, col("hi"))


def class_breaks(
    cells: DataFrame, method: str = "auto", k: int = 8, keys: Sequence[str] = (), bins: int = BINS
) -> DataFrame:
    """``keys, breaks``: ``k + 1`` ascending break values per raster.

    Natural breaks (``jenks``, and ``log`` on logarithms) are the optimal classes of whole bins: each
    raster's range is divided into ``bins`` bins whatever its size, so a class border is off the
    unbinned optimum's by about a bin's width, and breaks are values that occur.
    """
    keys = list(keys)
    if not keys:
        return class_breaks(cells.withColumn("__all", lit(0)), method, k, ["__all"], bins).drop("__all")
    valid = _finite(cells)
    if method == "quantile":
        percents = {f"q{i}": 100.0 * i / k for i in range(k + 1)}
        return group_percentiles(valid, keys, percents).select(
            *keys, F.array(*[col(f"q{i}") for i in range(k + 1)]).alias("breaks")
        )
    if method == "jenks":
        return _natural(valid, keys, k, bins)
    linear = valid.groupBy(*keys).agg(F.min("value").alias("lo"), F.max("value").alias("hi"))
    linear = linear.select(*keys, _linspace(k).alias("breaks"))
    if method != "log":
        return linear  # equal interval, also for "auto" and unknown names
    logs = valid.where(col("value") > 0).withColumn("value", F.log10("value"))
    power = _natural(logs, keys, k, bins).select(
        *keys, F.transform("breaks", lambda b: F.pow(lit(10.0), b)).alias("log_breaks")
    )
    return linear.join(power, keys, "left").select(*keys, F.coalesce("log_breaks", "breaks").alias("breaks"))


def _natural(valid: DataFrame, keys: list[str], k: int, bins: int) -> DataFrame:
    """Spark folds each raster to ``bins`` weighted values at most; one small group is then cut."""
    hist = value_counts(valid, keys)
    span = hist.groupBy(*keys).agg(F.min("value").alias("lo"), F.max("value").alias("hi"))
    place = F.floor((col("value") - col("lo")) / F.nullif(col("hi") - col("lo"), lit(0.0)) * lit(float(bins)))
    folded = (
        sized_join(hist, span, keys, bound=group_sizes(valid, keys)[0])
        .withColumn("__bin", F.least(F.coalesce(place, lit(0)), lit(bins - 1)))
        .groupBy(*keys, "__bin")
        .agg(
            F.sum("n").cast("double").alias("w"),
            F.sum(col("n") * col("value")).alias("s1"),
            F.sum(col("n") * col("value") * col("value")).alias("s2"),
            F.min("value").alias("lo"),
            F.max("value").alias("hi"),
        )
    )

    def cut(pdf: pd.DataFrame) -> pd.DataFrame:
        return pdf[keys].head(1).assign(breaks=[natural_breaks(pdf.sort_values("lo"), k)])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in folded.select(*keys).schema)
    return folded.groupBy(*keys).applyInPandas(cut, f"{schema}, breaks array<double>")


def natural_breaks(groups: pd.DataFrame, k: int) -> list[float]:
    """Breaks of the ``k`` classes with the least squared deviation, over sorted weighted values."""
    w, s1, s2 = (np.concatenate([[0.0], np.cumsum(groups[c].to_numpy(float))]) for c in ("w", "s1", "s2"))
    m = len(groups)
    k = min(k, m)

    # spread[i, e]: squared deviation of values i..e-1; bins by bins numbers at most
    start, end = np.arange(m)[:, None], np.arange(m + 1)[None, :]
    dw, d1, d2 = w[end] - w[start], s1[end] - s1[start], s2[end] - s2[start]
    with np.errstate(divide="ignore", invalid="ignore"):
        spread = np.where(end > start, np.maximum(d2 - d1 * d1 / dw, 0.0), np.inf)
    cost = spread[0]
    choice = np.zeros((k + 1, m + 1), dtype=int)
    for c in range(2, k + 1):
        total = cost[:m, None] + spread
        choice[c] = np.argmin(total, axis=0)
        cost = total[choice[c], np.arange(m + 1)]
    ends, end = [], m
    for c in range(k, 0, -1):
        ends.append(end)
        end = int(choice[c, end]) if c > 1 else 0
    hi, lo = groups["hi"].to_numpy(float), groups["lo"].to_numpy(float)
    return [float(lo[0]), *[float(hi[e - 1]) for e in reversed(ends)]]
