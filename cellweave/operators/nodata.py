"""Finding and judging nodata values of rasters without metadata."""

from __future__ import annotations

import math
import struct
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cellweave.operators.components import component_sizes, connected_components
from cellweave.operators.quantiles import SMALL_ROWS, ranked_values, value_counts
from cellweave.session import group_sizes, sized_join

col, lit = F.col, F.lit

# fixed values: nodata sentinels in the order they are tried
SENTINELS = (
    -9999, -999, -99, -9, -1,
    -32768, -32767, 32767, 65535, 255,
    -2147483648, -2147483647, 2147483647, 4294967295,
    -3.4028235e38, 3.4028235e38, -3.4e38, 3.4e38, -1.7976931348623157e308,
    0, -999999, -99999, -32766, -32765,
)
# fixed values: thresholds of detection and validation
MIN_SHARE = 0.001
Z_LIMIT = 4.0
TAIL = 0.001
MIN_PIXELS = 100

_INTEGER_RANGE = {
    "uint8": (0, 2**8 - 1), "uint16": (0, 2**16 - 1), "uint32": (0, 2**32 - 1),
    "int8": (-(2**7), 2**7 - 1), "int16": (-(2**15), 2**15 - 1), "int32": (-(2**31), 2**31 - 1),
    "int64": (-(2**63), 2**63 - 1),
}


def stored_value(value: float, dtype: str) -> float | None:
    """``value`` as a raster of ``dtype`` holds it, or None when it can not."""
    if dtype in _INTEGER_RANGE:
        lo, hi = _INTEGER_RANGE[dtype]
        return float(value) if float(value).is_integer() and lo <= value <= hi else None
    if dtype == "float32":
        # single precision keeps sentinels rounded, and compares them rounded
        return None if abs(value) > 3.5e38 else struct.unpack("f", struct.pack("f", value))[0]
    return float(value)


def sentinels_for(dtype: str) -> list[tuple[int, float, float]]:
    """``(order, sentinel, stored value)`` of the sentinels a dtype can hold."""
    stored = [(i, float(v), stored_value(v, dtype)) for i, v in enumerate(SENTINELS)]
    return [(i, v, s) for i, v, s in stored if s is not None]


def detect_nodata_common(cells: DataFrame, keys: Sequence[str] = (), dtype: str = "float64") -> DataFrame:
    """``keys, nodata``: the first sentinel, in list order, held by over 0.1 % of the pixels.

    One aggregate: a conditional count per sentinel and the pixel count.
    """
    known = sentinels_for(dtype)
    counts = [F.count_if(col("value") == lit(s)).alias(f"s{i}") for i, _, s in known]
    valid = cells.where(col("value").isNotNull() & ~F.isnan("value"))
    hits = valid.groupBy(*keys).agg(F.count("*").alias("n"), *counts)
    first = F.coalesce(*[F.when(col(f"s{i}") / col("n") > lit(MIN_SHARE), lit(v)) for i, v, _ in known])
    return hits.select(*keys, first.alias("nodata"))


def detect_nodata_outlier(
    cells: DataFrame, keys: Sequence[str] = (), z: float = Z_LIMIT, p: float = TAIL, small: bool | None = None
) -> DataFrame:
    """``keys, nodata``: an outlying value that dominates the outliers, or a block of equal
    values beyond a wide gap at either end.  Needs 100 pixels and a spread."""
    keys = list(keys)
    groups, rows = group_sizes(cells, keys)
    small = rows <= SMALL_ROWS if small is None else small
    hist = value_counts(cells, keys)
    n, v = col("n"), col("value")
    # population moments from raw rows, so that partial aggregation does the work
    valid = cells.where(v.isNotNull() & ~F.isnan("value"))
    moments = valid.groupBy(*keys).agg(
        F.count("*").alias("__total"), F.avg("value").alias("__mean"), F.stddev_pop("value").alias("__std")
    ).where((col("__total") >= MIN_PIXELS) & (col("__std") != 0))
    join = (lambda a, b: sized_join(a, b, keys, bound=groups)) if keys else (lambda a, b: a.join(F.broadcast(b)))
    far = join(hist, moments).where(F.abs((v - col("__mean")) / col("__std")) > lit(float(z)))
    # a value with over half of the outliers is the largest group; ties can not reach a half
    cluster = (
        far.groupBy(*keys)
        .agg(F.sum("n").alias("__far"), F.max_by("value", F.struct("n", "value")).alias("__v"), F.max("n").alias("__top"), F.max("__total").alias("__all"))
        .where((col("__top") / col("__far") > 0.5) & (col("__top") / col("__all") > lit(MIN_SHARE)))
        .select(*keys, col("__v").alias("__clustered"))
    )
    rank = lambda q: lambda t: (t - 1) * lit(q)
    targets = {
        "__first": lambda t: lit(0),
        "__last": lambda t: t - 1,
        "__k": lambda t: F.floor(t * 0.01),
        "__before_k": lambda t: F.floor(t * 0.01) - 1,
        "__t": lambda t: F.floor(t * 0.99),
        "__lo0": lambda t: F.floor(rank(p)(t)),
        "__lo1": lambda t: F.ceil(rank(p)(t)),
        "__hi0": lambda t: F.floor(rank(1 - p)(t)),
        "__hi1": lambda t: F.ceil(rank(1 - p)(t)),
    }
    if keys:
        ranks = ranked_values(hist, keys, targets, small=small, groups=groups)
    else:
        ranks = ranked_values(hist.withColumn("__all", lit(0)), ["__all"], targets, small=small, groups=1).drop("__all")
    pos = lambda q: rank(q)(col("total")) - F.floor(rank(q)(col("total")))
    low = col("__lo0") + (col("__lo1") - col("__lo0")) * pos(p)
    high = col("__hi0") + (col("__hi1") - col("__hi0")) * pos(1 - p)
    span = col("__last") - col("__first")
    bottom = (
        (col("__k") - col("__first") > 0.1 * span) & (col("__first") < low) & (col("__before_k") == col("__first"))
    )
    # the top block starts at its own gap's lower end, so equality and a gap exclude each other
    top = (col("__last") - col("__t") > 0.1 * span) & (col("__last") > high) & (col("__t") == col("__last"))
    gaps = ranks.where(col("total") >= MIN_PIXELS).select(
        *keys, F.when(bottom, col("__first")).when(top, col("__last")).alias("__gapped")
    )
    if keys:
        out = moments.select(*keys).join(cluster, keys, "left").join(gaps, keys, "left")
    else:
        out = moments.select(lit(0).alias("__o")).join(cluster, lit(True), "left").join(gaps, lit(True), "left")
    return out.select(*keys, F.coalesce("__clustered", "__gapped").alias("nodata"))


def sample_windows(cells: DataFrame, width: int, height: int, sample_size: int | None) -> DataFrame:
    """Cells of the centre and corner windows of a raster larger than ``sample_size``.

    Corners are taken in reading order while fewer than ``sample_size`` pixels are chosen;
    where windows overlap a cell counts once per window.
    """
    if not sample_size or width * height <= sample_size:
        return cells
    ratio = math.sqrt(sample_size / (width * height))
    h, w = max(1, int(height * ratio)), max(1, int(width * ratio))
    windows = [((height - h) // 2, (width - w) // 2)]
    for corner in ((0, 0), (0, width - w), (height - h, 0), (height - h, width - w)):
        if len(windows) * h * w < sample_size:
            windows.append(corner)
    inside = [col("r").between(r, r + h - 1) & col("c").between(c, c + w - 1) for r, c in windows]
    times = F.filter(F.array(*[F.when(i, lit(1)) for i in inside]), lambda x: x.isNotNull())
    return cells.withColumn("__w", F.explode(times)).drop("__w")


def detect_nodata(
    cells: DataFrame,
    keys: Sequence[str] = (),
    method: str = "auto",
    metadata_nodata: float | None = None,
    dtype: str = "float64",
    z: float = Z_LIMIT,
    p: float = TAIL,
) -> DataFrame:
    """``keys, nodata`` by metadata, then common values, then outliers, as ``method`` allows."""
    if method not in ("auto", "metadata_only", "common_values", "statistical"):
        raise ValueError(f"unknown nodata detection method {method!r}")
    keys = list(keys)
    each = cells.groupBy(*keys).agg(F.count("*").alias("__n")).drop("__n")
    if method in ("auto", "metadata_only") and metadata_nodata is not None:
        return each.withColumn("nodata", lit(float(metadata_nodata)))
    if method == "metadata_only":
        return each.withColumn("nodata", lit(None).cast("double"))
    if method == "common_values":
        return detect_nodata_common(cells, keys, dtype)
    if method == "statistical":
        return detect_nodata_outlier(cells, keys, z, p)
    common = detect_nodata_common(cells, keys, dtype)
    outlier = detect_nodata_outlier(cells, keys, z, p).withColumnRenamed("nodata", "outlier")
    joined = common.join(outlier, keys, "left") if keys else common.join(outlier, lit(True), "left")
    return joined.select(*keys, F.coalesce("nodata", "outlier").alias("nodata"))


def spatial_coherence(mask: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """``keys, coherence``: share of the largest region, damped by the number of regions."""
    sizes = component_sizes(connected_components(mask, keys), keys)
    stats = sizes.groupBy(*keys).agg(F.max("size").alias("big"), F.sum("size").alias("n"), F.count("*").alias("k"))
    return stats.select(
        *keys, F.least(lit(1.0), col("big") / col("n") * (1.0 / (1.0 + F.log("k")))).alias("coherence")
    )


def transition_coherence(cells: DataFrame, mask: Column, keys: Sequence[str] = ()) -> DataFrame:
    """``keys, coherence`` from changes between neighbours: 1 - changes / (4 * nodata cells).

    Only directly adjoining cells are compared, so absent cells count as no neighbour.
    """
    flagged = cells.select(*keys, "r", "c", mask.cast("int").alias("m"))
    across, down = Window.partitionBy(*keys, "r").orderBy("c"), Window.partitionBy(*keys, "c").orderBy("r")
    change = lambda axis, w: (
        F.when((F.lead(axis).over(w) == col(axis) + 1) & (F.lead("m").over(w) != col("m")), 1).otherwise(0)
    )
    counted = flagged.withColumns({"h": change("c", across), "v": change("r", down)})
    return (
        counted.groupBy(*keys)
        .agg(F.sum("m").alias("n"), F.sum(col("h") + col("v")).alias("t"), F.count("*").alias("size"))
        .select(
            *keys,
            F.when(col("size") < 4, lit(1.0))
            .when(col("n") == 0, lit(0.0))
            .otherwise(F.least(F.greatest(1.0 - col("t") / (4 * col("n")), lit(0.0)), lit(1.0)))
            .alias("coherence"),
        )
    )


def validate_nodata(
    cells: DataFrame, nodata: float, keys: Sequence[str] = (), coherence: DataFrame | None = None
) -> DataFrame:
    """Confidence that ``nodata`` is one, with its parts; valid above 0.6.

    ``coherence`` (``keys, coherence``) defaults to :func:`spatial_coherence`.
    """
    keys = list(keys)
    hit = col("value") == lit(float(nodata))
    valid = F.when(~hit, col("value"))
    base = cells.groupBy(*keys).agg(
        F.count_if(hit).alias("nodata_pixels"),
        F.count("*").alias("total_pixels"),
        F.min(valid).alias("lo"),
        F.max(valid).alias("hi"),
    )
    if coherence is None:
        coherence = spatial_coherence(cells.where(hit), keys)
    joined = base.join(coherence, keys, "left") if keys else base.join(coherence, lit(True), "left")
    v = lit(float(nodata))
    share = col("nodata_pixels") / col("total_pixels") * 100
    part = lambda cond, w: F.when(cond, lit(w)).otherwise(lit(0.0))
    confidence = F.least(
        lit(1.0),
        part(share.between(0.1, 50), 0.3)
        + part((v < col("lo")) | (v > col("hi")), 0.4)
        + part((v < col("lo")) & (col("hi") > col("lo")) & (col("lo") - v > 0.1 * (col("hi") - col("lo"))), 0.2)
        + part(col("coherence") > 0.5, 0.1),
    )
    return joined.select(
        *keys, "nodata_pixels", "total_pixels", share.alias("nodata_percentage"), "coherence",
        confidence.alias("confidence"), (confidence > 0.6).alias("is_valid"),
    )


def accept_nodata(detected: Column, is_valid: Column, confidence: Column) -> Column:
    """Detected value that alignment may use, else NULL."""
    return F.when(is_valid & (confidence > 0.7), detected)
