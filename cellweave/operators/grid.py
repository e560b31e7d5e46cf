"""Grids: snapping, tiling, resampling and mosaics of cell tables."""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cellweave.functions.crs import from_albers, projection, reproject_bounds, to_albers
from cellweave.functions.text import RESAMPLING_METHODS
from cellweave.schema import Grid

col, lit = F.col, F.lit

# fixed values: metres per degree of the tile size rule; default metric grid and subdivision limits
METRES_PER_DEGREE = 111000.0
METRIC_CELL_M = 1500.0
SPLIT_LIMIT, SPLIT_MIN_M, SPLIT_DEPTH = 5000, 50.0, 6

BOX = ("left", "bottom", "right", "top")


def bounds_intersection(a: Sequence[Column], b: Sequence[Column]) -> Column:
    """Common box as ``struct<left,bottom,right,top>``; NULL when the boxes share no area."""
    left, bottom = F.greatest(a[0], b[0]), F.greatest(a[1], b[1])
    right, top = F.least(a[2], b[2]), F.least(a[3], b[3])
    box = F.struct(left.alias("left"), bottom.alias("bottom"), right.alias("right"), top.alias("top"))
    return F.when((left < right) & (bottom < top), box)


def snap_bounds(box: Sequence[Column], px: float, origin: tuple[float, float] = (0.0, 0.0)) -> list[Column]:
    """Each side rounded (half to even) to the grid through ``origin``."""
    return [
        lit(origin[i % 2]) + F.bround((side - lit(origin[i % 2])) / lit(px)) * lit(px) for i, side in enumerate(box)
    ]


def aligned_grid(ref: Grid, left: Column, bottom: Column, right: Column, top: Column) -> Column:
    """Box snapped to the reference grid: offsets, size and the new origin, as a struct."""
    c_off = F.bround((left - lit(ref.left)) / lit(ref.px_w))
    r_off = F.bround((lit(ref.top) - top) / lit(ref.px_h))
    new_left = lit(ref.left) + c_off * lit(ref.px_w)
    new_top = lit(ref.top) - r_off * lit(ref.px_h)
    return F.struct(
        c_off.cast("int").alias("c_off"),
        r_off.cast("int").alias("r_off"),
        F.bround((right - new_left) / lit(ref.px_w)).cast("int").alias("width"),
        F.bround((new_top - bottom) / lit(ref.px_h)).cast("int").alias("height"),
        new_left.alias("left"),
        new_top.alias("top"),
    )


def bbox_polygon(left: Column, bottom: Column, right: Column, top: Column) -> Column:
    """Closed ring of a box."""
    corners = [(right, bottom), (right, top), (left, top), (left, bottom), (right, bottom)]
    return F.array(*[F.struct(x.alias("x"), y.alias("y")) for x, y in corners])


def plan_alignment(spark: SparkSession, src: Grid, ref: Grid) -> Grid:
    """Output grid of aligning ``src`` to ``ref``: the common box on the reference grid.

    Only one row of metadata is evaluated.  No overlap is an error.
    """
    box = reproject_bounds(*[lit(v) for v in src.bounds], src.crs, ref.crs)
    common = bounds_intersection(box, [lit(v) for v in ref.bounds])
    row = (
        spark.range(1)
        .select(common.alias("b"))
        .where(col("b").isNotNull())
        .select(aligned_grid(ref, *[col(f"b.{s}") for s in BOX]).alias("g"))
        .first()
    )
    if row is None or row["g"]["width"] <= 0 or row["g"]["height"] <= 0:
        raise ValueError("no intersection between reference and input raster")
    g = row["g"]
    return Grid(g["left"], g["top"], ref.px_w, ref.px_h, g["width"], g["height"], src.nodata, ref.crs)


# --------------------------------------------------------------------------- resampling kernels


def _sinc(x: Column) -> Column:
    px = lit(math.pi) * x
    return F.when(x == 0, lit(1.0)).otherwise(F.sin(px) / px)


def _bilinear(d: Column) -> Column:
    return F.greatest(1 - d, lit(0.0))


def _cubic(d: Column) -> Column:
    near = (1.5 * d - 2.5) * d * d + 1
    far = ((-0.5 * d + 2.5) * d - 4) * d + 2
    return F.when(d <= 1, near).when(d < 2, far).otherwise(lit(0.0))


def _cubic_spline(d: Column) -> Column:
    near = (0.5 * d - 1) * d * d + 2.0 / 3.0
    far = (2 - d) * (2 - d) * (2 - d) / 6
    return F.when(d <= 1, near).when(d < 2, far).otherwise(lit(0.0))


def _lanczos(d: Column) -> Column:
    return F.when(d < 3, _sinc(d) * _sinc(d / 3)).otherwise(lit(0.0))


#: radius and weight of |distance| in source pixels
KERNELS: dict[str, tuple[int, Callable[[Column], Column]]] = {
    "bilinear": (1, _bilinear),
    "cubic": (2, _cubic),
    "cubic_spline": (2, _cubic_spline),
    "lanczos": (3, _lanczos),
}
#: a weight sum at or below this leaves the output cell empty
MIN_WEIGHT = 1e-6


def resample(cells: DataFrame, src: Grid, dst: Grid, method: str = "nearest", by: Sequence[str] = ()) -> DataFrame:
    """Cells of ``src`` on the grid ``dst``; NULL and nodata cells never contribute.

    On one CRS the two grids differ by a scale and a shift, so every source cell knows which
    target cells it feeds: it is expanded to them with its kernel weight, and one aggregate
    per target cell finishes.  No join is needed, and neighbours combine before the shuffle.
    Nearest needs no shuffle at all.  Between CRSs the target grid is generated, projected
    back, and its kernel taps are joined to the source.
    """
    if method not in RESAMPLING_METHODS:
        raise ValueError(f"unknown resampling method {method!r}")
    v = col("value")
    valid = cells.select(*by, "r", "c", "value").where(v.isNotNull() & ~F.isnan(v))
    if src.nodata is not None and not math.isnan(src.nodata):
        valid = valid.where(v != lit(float(src.nodata)))
    if src.crs != dst.crs:
        return _gather(valid, src, dst, method, list(by))
    if method == "nearest":
        return _scatter_nearest(valid, src, dst, list(by))
    if method in ("average", "mode"):
        return _scatter_area(valid, src, dst, method, list(by))
    return _scatter_kernel(valid, src, dst, method, list(by))


def _axis(src: Grid, dst: Grid, vertical: bool) -> tuple[float, float, int]:
    """``(scale, shift, size)``: target index of a source coordinate ``s`` is ``scale*s + shift``,
    both counted in pixels from the grid corner."""
    if vertical:
        return src.px_h / dst.px_h, (dst.top - src.top) / dst.px_h, dst.height
    return src.px_w / dst.px_w, (src.left - dst.left) / dst.px_w, dst.width


def _clamped(first: Column, last: Column, size: int) -> Column:
    first, last = F.greatest(first.cast("int"), lit(0)), F.least(last.cast("int"), lit(size - 1))
    return F.when(first <= last, F.sequence(first, last))


def _scatter_nearest(cells: DataFrame, src: Grid, dst: Grid, by: list[str]) -> DataFrame:
    out = cells
    for axis, new, vertical in (("r", "__r", True), ("c", "__c", False)):
        scale, shift, size = _axis(src, dst, vertical)
        # target centre k + 0.5 lies in [s, s + 1) of the source
        lo, hi = scale * col(axis) + shift - 0.5, scale * (col(axis) + 1) + shift - 0.5
        out = out.withColumn(new, F.explode(_clamped(F.ceil(lo), F.ceil(hi) - 1, size)))
    return out.select(*by, col("__r").alias("r"), col("__c").alias("c"), "value")


def _scatter_kernel(cells: DataFrame, src: Grid, dst: Grid, method: str, by: list[str]) -> DataFrame:
    radius, kernel = KERNELS[method]
    out = cells
    for axis, new, w, vertical in (("r", "__r", "__wr", True), ("c", "__c", "__wc", False)):
        scale, shift, size = _axis(src, dst, vertical)
        stretch = max(1.0, 1.0 / scale)  # shrinking widens the kernel to the target pixel
        reach = radius * stretch * scale
        centre = scale * (col(axis) + 0.5) + shift - 0.5
        targets = _clamped(F.ceil(centre - reach), F.floor(centre + reach), size)
        distance = F.abs((col(new) + 0.5 - shift) / scale - (col(axis) + 0.5)) / stretch
        out = out.withColumn(new, F.explode(targets)).withColumn(w, kernel(distance))
    out = out.withColumn("__w", col("__wr") * col("__wc")).where(col("__w") != 0)
    return _finish(out, by)


def _finish(weighted: DataFrame, by: list[str]) -> DataFrame:
    return (
        weighted.groupBy(*by, col("__r").alias("r"), col("__c").alias("c"))
        .agg(F.sum(col("__w") * col("value")).alias("__s"), F.sum("__w").alias("__w"))
        .where(col("__w") > MIN_WEIGHT)
        .select(*by, "r", "c", (col("__s") / col("__w")).alias("value"))
    )


def _scatter_area(cells: DataFrame, src: Grid, dst: Grid, method: str, by: list[str]) -> DataFrame:
    out = cells
    for axis, new, w, vertical in (("r", "__r", "__wr", True), ("c", "__c", "__wc", False)):
        scale, shift, size = _axis(src, dst, vertical)
        lo, hi = scale * col(axis) + shift, scale * (col(axis) + 1) + shift
        overlap = F.least(hi, col(new) + 1) - F.greatest(lo, col(new))
        out = out.withColumn(new, F.explode(_clamped(F.floor(lo), F.ceil(hi) - 1, size))).withColumn(w, overlap)
    out = out.withColumn("__w", col("__wr") * col("__wc")).where(col("__w") > 0)
    return _finish(out, by) if method == "average" else _mode(out, by)


def _mode(weighted: DataFrame, by: list[str]) -> DataFrame:
    """Value with the largest weight; the smaller value on a tie."""
    keys = [*by, "__r", "__c"]
    return (
        weighted.groupBy(*keys, "value")
        .agg(F.sum("__w").alias("__w"))
        .groupBy(*keys)
        .agg(F.min_by("value", F.struct(-col("__w"), col("value"))).alias("value"))
        .select(*by, col("__r").alias("r"), col("__c").alias("c"), "value")
    )


def target_cells(spark: SparkSession, dst: Grid) -> DataFrame:
    """All cells ``r, c`` of a grid, generated in parallel."""
    n = spark.range(dst.width * dst.height)
    return n.select(
        F.floor(col("id") / dst.width).cast("int").alias("r"), (col("id") % dst.width).cast("int").alias("c")
    )


def _gather(cells: DataFrame, src: Grid, dst: Grid, method: str, by: list[str]) -> DataFrame:
    back = projection(dst.crs, src.crs)
    grid = target_cells(cells.sparkSession, dst)
    x, y = back(dst.x("c"), dst.y("r"))
    at = grid.select(
        col("r").alias("__r"), col("c").alias("__c"),
        ((lit(src.top) - y) / lit(src.px_h)).alias("__fr"),
        ((x - lit(src.left)) / lit(src.px_w)).alias("__fc"),
    )
    if method in ("average", "mode"):
        # source cells go to the target cell that holds their projected centre
        px, py = projection(src.crs, dst.crs)(src.x("c"), src.y("r"))
        binned = cells.withColumns(
            {
                "__r": F.floor((lit(dst.top) - py) / lit(dst.px_h)).cast("int"),
                "__c": F.floor((px - lit(dst.left)) / lit(dst.px_w)).cast("int"),
                "__w": lit(1.0),
            }
        ).where(col("__r").between(0, dst.height - 1) & col("__c").between(0, dst.width - 1))
        return _finish(binned, by) if method == "average" else _mode(binned, by)
    if method == "nearest":
        taps = at.select(
            "__r", "__c", F.floor("__fr").cast("int").alias("r"), F.floor("__fc").cast("int").alias("c")
        )
        return taps.join(cells, ["r", "c"]).select(*by, col("__r").alias("r"), col("__c").alias("c"), "value")
    radius, kernel = KERNELS[method]
    taps = at
    for frac, axis, w in (("__fr", "r", "__wr"), ("__fc", "c", "__wc")):
        first = F.floor(col(frac) - 0.5).cast("int") - (radius - 1)
        taps = taps.withColumn(axis, F.explode(F.sequence(first, first + (2 * radius - 1))))
        taps = taps.withColumn(w, kernel(F.abs(col(frac) - 0.5 - col(axis))))
    taps = taps.withColumn("__w", col("__wr") * col("__wc")).where(col("__w") != 0)
    return _finish(taps.join(cells, ["r", "c"]), by)


def align(
    cells: DataFrame, src: Grid, ref: Grid, method: str = "cubic", by: Sequence[str] = ()
) -> tuple[DataFrame, Grid]:
    """Cells resampled to the reference grid within the common box, and that grid."""
    dst = plan_alignment(cells.sparkSession, src, ref)
    return resample(cells, src, dst, method, by), dst


# --------------------------------------------------------------------------- mosaics, tiles


def mosaic(tiles: DataFrame, order: str = "tile", cell: Sequence[str] = ("r", "c")) -> DataFrame:
    """Overlay of tiles: the first valid value of a cell wins."""
    valid = tiles.where(col("value").isNotNull() & ~F.isnan("value"))
    return valid.groupBy(*cell).agg(F.min_by("value", order).alias("value"))


def downsample(cells: DataFrame, width: int, height: int, max_dim: int) -> DataFrame:
    """Every f-th row and column when the raster has over ``max_dim`` squared pixels."""
    n = width * height
    if n <= max_dim * max_dim:
        return cells
    f = int(math.sqrt(n / (max_dim * max_dim)))
    kept = cells.where((col("r") % f == 0) & (col("c") % f == 0))
    return kept.withColumns({"r": F.floor(col("r") / f).cast("int"), "c": F.floor(col("c") / f).cast("int")})


def tile_grid(boxes: DataFrame, size_m: float) -> DataFrame:
    """Degree tiles of each box ``left..top``; a box not above one tile area stays whole."""
    size = size_m / METRES_PER_DEGREE
    w, h = col("right") - col("left"), col("top") - col("bottom")
    area = F.abs(w) * METRES_PER_DEGREE * F.abs(h) * METRES_PER_DEGREE
    small = area < size_m * size_m
    steps = lambda span: F.when(small, lit(0)).otherwise(F.ceil(span / size).cast("int") - 1)
    lo = lambda side, i: col(side) + col(i) * lit(size)
    hi = lambda side, far, i: F.when(small, col(far)).otherwise(F.least(lo(side, i) + lit(size), col(far)))
    tiles = boxes.withColumn("i", F.explode(F.sequence(lit(0), steps(w)))).withColumn(
        "j", F.explode(F.sequence(lit(0), steps(h)))
    )
    return tiles.withColumns(
        {
            "tile_left": lo("left", "i"),
            "tile_bottom": lo("bottom", "j"),
            "tile_right": hi("left", "right", "i"),
            "tile_top": hi("bottom", "top", "j"),
        }
    )


def metric_cell(points: DataFrame, x0: float, y0: float, size: float = METRIC_CELL_M) -> DataFrame:
    """Adds ``grid_id`` (``i_j``) of the metric Albers grid with corner ``x0, y0`` to lon/lat points."""
    x, y = to_albers(col("longitude"), col("latitude"))
    i, j = F.floor((x - lit(x0)) / lit(size)), F.floor((y - lit(y0)) / lit(size))
    return points.withColumn("grid_id", F.concat_ws("_", i, j))


def metric_grid(boxes: DataFrame, size: float = METRIC_CELL_M) -> DataFrame:
    """Albers cells over each lon/lat box with their bounds back in degrees.

    The last partial row and column are kept.
    """
    x0, y0, x1, y1 = reproject_bounds(*[col(s) for s in BOX], "EPSG:4326", "ESRI:102022")
    count = lambda a, b: F.greatest(F.ceil((b - a) / lit(size)).cast("int"), lit(1)) - 1
    # one projected box per input row, before the cells are laid out
    out = boxes.withColumn("__box", F.array(x0, y0, x1, y1))
    at = lambda k: F.element_at("__box", k)
    out = out.withColumn("i", F.explode(F.sequence(lit(0), count(at(1), at(3))))).withColumn(
        "j", F.explode(F.sequence(lit(0), count(at(2), at(4))))
    )
    left, bottom = at(1) + col("i") * lit(size), at(2) + col("j") * lit(size)
    corners = [from_albers(x, y) for x in (left, left + lit(size)) for y in (bottom, bottom + lit(size))]
    return out.withColumns(
        {
            "grid_id": F.concat_ws("_", "i", "j"),
            "west": F.least(*[p[0] for p in corners]),
            "south": F.least(*[p[1] for p in corners]),
            "east": F.greatest(*[p[0] for p in corners]),
            "north": F.greatest(*[p[1] for p in corners]),
        }
    ).drop("__box", "i", "j")


def count_per_cell(points: DataFrame, cell: str = "grid_id") -> DataFrame:
    """Points per cell; empty cells have no row."""
    return points.groupBy(cell).agg(F.count("*").alias("n"))


def adaptive_partition(
    points: DataFrame,
    x0: float,
    y0: float,
    side: float,
    limit: int = SPLIT_LIMIT,
    min_size: float = SPLIT_MIN_M,
    depth: int = SPLIT_DEPTH,
    x: str = "x",
    y: str = "y",
) -> DataFrame:
    """Quadtree cell per point: a cell splits in four while it holds over ``limit`` points.

    Splitting ends at ``depth`` or when the side falls below ``min_size``; all points stay.
    Counts of all depths come from the finest cells: points are counted once, and only the
    (bounded, 4^depth) cell counts are rolled up and joined back.
    """
    deepest = 0
    while deepest < depth and side / 2**deepest >= min_size:
        deepest += 1
    fine = side / 2**deepest
    last = 2**deepest - 1
    index = lambda v, o: F.least(F.greatest(F.floor((col(v) - lit(o)) / lit(fine)), lit(0)), lit(last)).cast("int")
    placed = points.withColumns({"__i": index(x, x0), "__j": index(y, y0)})
    counts = placed.groupBy("__i", "__j").agg(F.count("*").alias("__n"))
    levels = F.explode(F.sequence(lit(0), lit(deepest))).alias("depth")
    up = F.pow(lit(2), lit(deepest) - col("depth"))
    rolled = (
        counts.select("__i", "__j", "__n", levels)
        .groupBy("depth", F.floor(col("__i") / up).cast("int").alias("i"), F.floor(col("__j") / up).cast("int").alias("j"))
        .agg(F.sum("__n").alias("n"))
    )
    # shallowest depth whose cell is within the limit, else the deepest
    fits = rolled.where((col("n") <= limit) | (col("depth") == deepest))
    candidates = (
        counts.select("__i", "__j", levels)
        .withColumns({"i": F.floor(col("__i") / up).cast("int"), "j": F.floor(col("__j") / up).cast("int")})
        .join(fits, ["depth", "i", "j"])
        .groupBy("__i", "__j")
        .agg(F.min(F.struct("depth", "i", "j", "n")).alias("__cell"))
    )
    # 4^depth cells at most: bounded whatever the number of points
    return (
        placed.join(F.broadcast(candidates) if 4**deepest <= 1_000_000 else candidates, ["__i", "__j"])
        .withColumns(
            {"depth": col("__cell.depth"), "cell_id": F.concat_ws("_", "__cell.depth", "__cell.i", "__cell.j"),
             "cell_count": col("__cell.n")}
        )
        .drop("__i", "__j", "__cell")
    )
