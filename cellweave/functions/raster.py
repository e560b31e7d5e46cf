"""Row-wise raster expressions: masks, nodata, scaling, classes.

numpy comparisons with NaN are false while Spark sorts NaN above all numbers, so every
comparison here is guarded with ``isnan``.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# fixed values: fallback nodata; scene classes treated as cloud; reflectance scale, stretch limit
DEFAULT_NODATA = -9999.0
CLOUD_CLASSES = (3, 8, 9, 10)
REFLECTANCE_SCALE = 0.0001
REFLECTANCE_MAX = 0.3

_OPS = {
    "equal": lambda v, k: v == k,
    "greater": lambda v, k: v > k,
    "less": lambda v, k: v < k,
    "greater_equal": lambda v, k: v >= k,
    "less_equal": lambda v, k: v <= k,
}


def _any(conditions: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a | b, conditions, F.lit(False))


def _fill(nodata: float | None, raster_nodata: float | None) -> Column:
    if nodata is None:
        nodata = DEFAULT_NODATA if raster_nodata is None else raster_nodata
    return F.lit(float(nodata))


def _in_bands(condition: Column, bands: Sequence[int] | None, band: str) -> Column:
    return condition if bands is None else condition & F.col(band).isin([int(b) for b in bands])


def mask_values(
    cells: DataFrame,
    values: float | Sequence[float],
    op: str = "equal",
    nodata: float | None = None,
    bands: Sequence[int] | None = None,
    raster_nodata: float | None = None,
    value: str = "value",
    band: str = "band",
) -> DataFrame:
    """Replace values that compare true with any of ``values`` by nodata."""
    if op not in _OPS:
        raise ValueError(f"unknown comparison operator: {op}")
    wanted = list(values) if isinstance(values, (list, tuple)) else [values]
    v = F.col(value)
    hit = ~F.isnan(v) & _any([_OPS[op](v, F.lit(float(k))) for k in wanted])
    hit = _in_bands(hit, bands, band)
    return cells.withColumn(value, F.when(hit, _fill(nodata, raster_nodata)).otherwise(v))


def mask_ranges(
    cells: DataFrame,
    ranges: Sequence[tuple[float, float]],
    inside: bool = True,
    nodata: float | None = None,
    bands: Sequence[int] | None = None,
    raster_nodata: float | None = None,
    value: str = "value",
    band: str = "band",
) -> DataFrame:
    """Replace values inside (or outside) the closed ranges by nodata."""
    v = F.col(value)
    within = ~F.isnan(v) & _any([v.between(F.lit(float(a)), F.lit(float(b))) for a, b in ranges])
    hit = _in_bands(within if inside else (v.isNotNull() & ~within), bands, band)
    return cells.withColumn(value, F.when(hit, _fill(nodata, raster_nodata)).otherwise(v))


def is_nodata(value: Column, nodata: float | None, dtype: str = "float64", tol: float = 1e-6) -> Column:
    """True where ``value`` is the nodata value: NaN, close to it (floats) or equal (integers)."""
    if nodata is None:
        return F.lit(False)
    if math.isnan(nodata):
        return F.isnan(value)
    if dtype.startswith("float"):
        return ~F.isnan(value) & (F.abs(value - F.lit(float(nodata))) <= F.lit(tol))
    return value == F.lit(float(nodata))


def mask_nodata(
    cells: DataFrame, nodata: float | None, dtype: str = "float64", tol: float = 1e-6, value: str = "value"
) -> DataFrame:
    """Nodata cells → NULL, which every Spark aggregate skips."""
    v = F.col(value)
    return cells.withColumn(value, F.when(~is_nodata(v, nodata, dtype, tol), v))


def cloud_mask(cells: DataFrame, bands: Sequence[str], scl: str = "SCL") -> DataFrame:
    """Band values of cloud and shadow pixels → NULL."""
    clear = ~F.col(scl).isin(list(CLOUD_CLASSES))
    return cells.withColumns({b: F.when(clear, F.col(b)) for b in bands})


def scale_uint8(v: Column) -> Column:
    """Reflectance counts → 0..255."""
    stretched = F.least(F.greatest(v * F.lit(REFLECTANCE_SCALE), F.lit(0.0)), F.lit(REFLECTANCE_MAX))
    return F.floor(stretched * F.lit(255 / REFLECTANCE_MAX)).cast("int")


def classify(v: Column, breaks: Sequence[float]) -> Column:
    """Class index: breaks not above ``v``, minus one; NaN and NULL stay NULL."""
    count = reduce(lambda a, b: a + b, [(v >= F.lit(float(b))).cast("int") for b in breaks])
    return F.when(v.isNotNull() & ~F.isnan(v), count - 1)


def classify_by(v: Column, breaks: Column) -> Column:
    """As :func:`classify`, with the breaks in an array column."""
    return F.when(v.isNotNull() & ~F.isnan(v), F.size(F.filter(breaks, lambda b: b <= v)) - 1)
