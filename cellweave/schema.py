"""Shared types: the raster grid and the table layouts used by the operators."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


@dataclass(frozen=True)
class Grid:
    """North-up raster geometry: row 0 is the top row, ``(left, top)`` its corner."""

    left: float
    top: float
    px_w: float
    px_h: float
    width: int
    height: int
    nodata: float | None = None
    crs: str = "EPSG:4326"
    tags: dict = field(default_factory=dict, compare=False)

    @property
    def right(self) -> float:
        return self.left + self.width * self.px_w

    @property
    def bottom(self) -> float:
        return self.top - self.height * self.px_h

    @property
    def bounds(self) -> tuple[float, float, float, float]:
        return (self.left, self.bottom, self.right, self.top)

    def x(self, c: Column | str) -> Column:
        """Column centre of column index ``c``."""
        c = F.col(c) if isinstance(c, str) else c
        return F.lit(self.left) + (c + F.lit(0.5)) * F.lit(self.px_w)

    def y(self, r: Column | str) -> Column:
        r = F.col(r) if isinstance(r, str) else r
        return F.lit(self.top) - (r + F.lit(0.5)) * F.lit(self.px_h)


POINT = T.StructType([T.StructField("x", T.DoubleType()), T.StructField("y", T.DoubleType())])
PARTS = T.ArrayType(T.ArrayType(POINT))

CELLS = T.StructType(
    [
        T.StructField("raster_id", T.StringType()),
        T.StructField("band", T.IntegerType()),
        T.StructField("r", T.IntegerType()),
        T.StructField("c", T.IntegerType()),
        T.StructField("value", T.DoubleType()),
    ]
)

BUILDINGS = T.StructType(
    [
        T.StructField("latitude", T.DoubleType()),
        T.StructField("longitude", T.DoubleType()),
        T.StructField("area_in_meters", T.DoubleType()),
        T.StructField("confidence", T.DoubleType()),
        T.StructField("geometry", T.StringType()),
        T.StructField("full_plus_code", T.StringType()),
    ]
)
