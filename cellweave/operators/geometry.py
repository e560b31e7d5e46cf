"""Vector operators on vertex and edge tables.

An edge table has ``x1, y1, x2, y2`` plus a zone id; holes and parts are just more edges.
The inside rule is crossing parity of a ray to the right, half-open in y::

    (y1 > y) <> (y2 > y)  and  x < (x2 - x1) * (y - y1) / (y2 - y1) + x1
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cellweave.functions.crs import projection
from cellweave.session import BROADCAST_ROWS, cut_lineage, sized_join

col, lit = F.col, F.lit

#: Columns per block of the (row, block) join key between cells and spans.
BLOCK = 512
#: A zone gets between 8 and 64 tiles along its longer side.
TILES_ACROSS = 64.0
#: Places or roads of one box travel in lists of so many, and pairs of them are unrolled for so many places at a time.
LISTED, UNROLLED = 512, 64
#: Tasks that unroll lists, for each core: they read little, so Spark would make few.
TASKS_PER_CORE = 8


def edges_from_rings(rings: DataFrame, keys: list[str], seq: str = "seq", x: str = "px", y: str = "py") -> DataFrame:
    """Consecutive ring vertices → edges; ``keys`` identify one ring."""
    w = Window.partitionBy(*keys).orderBy(seq)
    return (
        rings.select(
            *keys,
            col(x).alias("x1"),
            col(y).alias("y1"),
            F.lead(x).over(w).alias("x2"),
            F.lead(y).over(w).alias("y2"),
        )
        .where(col("x2").isNotNull())
    )


def bounds(edges: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Bounding box per key (or of everything)."""
    return edges.groupBy(*(keys or [])).agg(
        F.min(F.least("x1", "x2")).alias("min_x"),
        F.min(F.least("y1", "y2")).alias("min_y"),
        F.max(F.greatest("x1", "x2")).alias("max_x"),
        F.max(F.greatest("y1", "y2")).alias("max_y"),
    )


def edge_x_at(y: Column) -> Column:
    return (col("x2") - col("x1")) * (y - col("y1")) / (col("y2") - col("y1")) + col("x1")


def _rows_between(first: Column, last: Column, height: int | None) -> Column:
    """The rows of an edge as an array, cut to a grid of ``height`` rows where there is one."""
    if height is None:
        return F.sequence(first, last)
    first, last = F.greatest(first, lit(0)), F.least(last, lit(height - 1))
    return F.when(first <= last, F.sequence(first, last))


def scanline_spans(
    edges: DataFrame, keys: list[str], top: Column, px_h: Column, height: int | None = None
) -> DataFrame:
    """Inside intervals ``[x_lo, x_hi)`` of each zone on every grid row centre.

    Each edge is expanded over the rows whose centre it crosses; the sorted crossings of a
    row pair up into intervals.  The output grows with the outline, not with the area, and not
    beyond ``height`` rows per edge.
    """
    y_lo, y_hi = F.least("y1", "y2"), F.greatest("y1", "y2")
    first = F.ceil((top - y_hi) / px_h - 0.5).cast("int") - 1
    last = F.floor((top - y_lo) / px_h - 0.5).cast("int") + 1
    crossing = (
        edges.where(col("y1") != col("y2"))
        .withColumn("r", F.explode(_rows_between(first, last, height)))
        .withColumn("__y", top - (col("r") + 0.5) * px_h)
        .where((col("y1") > col("__y")) != (col("y2") > col("__y")))
        .select(*keys, "r", edge_x_at(col("__y")).alias("x_lo"))
    )
    w = Window.partitionBy(*keys, "r").orderBy("x_lo")
    return (
        crossing.select(
            *keys, "r", "x_lo", F.lead("x_lo").over(w).alias("x_hi"), F.row_number().over(w).alias("__n")
        )
        .where((col("__n") % 2 == 1) & (col("x_hi") > col("x_lo")))
        .drop("__n")
    )


def traversed_cells(
    edges: DataFrame, keys: list[str], left: Column, top: Column, px_w: Column, px_h: Column, height: int | None = None
) -> DataFrame:
    """Column ranges ``c_lo..c_hi`` of the grid cells each edge passes, one row per grid row.

    A cell owns its left and top border, so an edge lying on a border belongs to one cell.
    """
    row_of = lambda y: F.floor((top - y) / px_h).cast("int")
    y_lo, y_hi = F.least("y1", "y2"), F.greatest("y1", "y2")
    x_lo, x_hi = F.least("x1", "x2"), F.greatest("x1", "x2")
    row_top = top - col("r") * px_h
    row_bottom = top - (col("r") + 1) * px_h
    flat = col("y1") == col("y2")
    # the edge's own range limits the clipped one, so rounding can not push it outside
    inside = lambda v: F.least(F.greatest(v, x_lo), x_hi)
    a = F.when(flat, col("x1")).otherwise(inside(edge_x_at(F.least(y_hi, row_top))))
    b = F.when(flat, col("x2")).otherwise(inside(edge_x_at(F.greatest(y_lo, row_bottom))))
    column_of = lambda x: F.floor((x - left) / px_w).cast("int")
    return (
        edges.withColumn("r", F.explode(_rows_between(row_of(y_hi), row_of(y_lo), height)))
        .withColumns({"__a": a, "__b": b})
        .withColumns({"c_lo": column_of(F.least("__a", "__b")), "c_hi": column_of(F.greatest("__a", "__b"))})
        .drop("__a", "__b")
        .select(*keys, "r", "c_lo", "c_hi")
    )


# --------------------------------------------------------------------------- size bounds


def _steps(lo: Column, hi: Column, size: Column) -> Column:
    return F.floor(hi / size) - F.floor(lo / size) + 1


def _passed_bound(edges: DataFrame, size: float) -> int:
    """Upper bound of the tiles all edges pass: one map-side aggregate."""
    rows = _steps(F.least("y1", "y2"), F.greatest("y1", "y2"), lit(float(size)))
    cols = _steps(F.least("x1", "x2"), F.greatest("x1", "x2"), lit(float(size)))
    return int(edges.agg(F.sum(rows + cols)).first()[0] or 0)


def _mean_extent(edges: DataFrame) -> float:
    """Mean longer side of the edge boxes: a tile of that size holds an edge in a few tiles."""
    side = F.greatest(F.abs(col("x2") - col("x1")), F.abs(col("y2") - col("y1")))
    return float(edges.agg(F.avg(side)).first()[0] or 0.0)


def _spans_bound(edges: DataFrame, grid, zone: str) -> int:
    """Upper bound of the blocked spans (outline rows times blocks across, on the grid) of all zones."""
    y_lo = F.greatest(F.least("y1", "y2"), lit(grid.top - grid.height * grid.px_h))
    y_hi = F.least(F.greatest("y1", "y2"), lit(grid.top))
    rows = F.when(y_lo <= y_hi, F.least(_steps(y_lo, y_hi, lit(grid.px_h)) + 2, lit(grid.height))).otherwise(0)
    x_lo, x_hi = F.greatest(F.min(F.least("x1", "x2")), lit(grid.left)), F.least(
        F.max(F.greatest("x1", "x2")), lit(grid.left + grid.width * grid.px_w)
    )
    per_zone = edges.groupBy(zone).agg(F.sum(rows).alias("n"), F.greatest(x_hi - x_lo, lit(0.0)).alias("w"))
    return int(per_zone.agg(F.sum(col("n") * (col("w") / (grid.px_w * BLOCK) + 2))).first()[0] or 0)


# --------------------------------------------------------------------------- rasters


def zone_spans(edges: DataFrame, grid, zone: str = "zone_id") -> DataFrame:
    """Centre-rule spans of every zone on a raster grid, keyed by row and column block."""
    spans = scanline_spans(edges, [zone], lit(grid.top), lit(grid.px_h), grid.height)
    first = F.floor((col("x_lo") - grid.left) / grid.px_w - 0.5).cast("int") - 1
    last = F.ceil((col("x_hi") - grid.left) / grid.px_w - 0.5).cast("int") + 1
    return _blocks(spans, grid, first, last)


def _blocks(spans: DataFrame, grid, first: Column, last: Column) -> DataFrame:
    first = F.greatest(first, lit(0))
    last = F.least(last, lit(grid.width - 1))
    return (
        spans.where((col("r") >= 0) & (col("r") < grid.height) & (first <= last))
        .withColumn("blk", F.explode(F.sequence(F.floor(first / BLOCK).cast("int"), F.floor(last / BLOCK).cast("int"))))
    )


def on_grid_crs(edges: DataFrame, grid, crs: str | None) -> DataFrame:
    """Edges in the CRS of the raster; a missing name means EPSG:4326."""
    if (crs or "EPSG:4326") == grid.crs:
        return edges
    return project_edges(edges, projection(crs, grid.crs))


def cells_in_zones(
    cells: DataFrame,
    edges: DataFrame,
    grid,
    zone: str = "zone_id",
    max_rows: int = BROADCAST_ROWS,
    crs: str | None = None,
) -> DataFrame:
    """Cells joined to every zone that contains their centre (adds the zone column).

    Cells are never exploded, and not shuffled while the spans fit a broadcast.  Edges in
    another CRS (``crs``) are projected to the raster's.
    """
    edges = on_grid_crs(edges, grid, crs)
    x = grid.x("c")
    return sized_join(
        cells.withColumn("blk", F.floor(col("c") / BLOCK).cast("int")),
        zone_spans(edges, grid, zone),
        ["r", "blk"],
        "inner",
        (x >= col("x_lo")) & (x < col("x_hi")),
        max_rows,
        _spans_bound(edges, grid, zone),
    ).drop("blk", "x_lo", "x_hi")


def _area(edges: DataFrame, zone: str | None) -> DataFrame:
    """Edges of an area under the polygon id ``__zone``.

    An area is the union of its polygons, so each is tested on its own.  Without ids all edges
    are one polygon, which is right as long as polygons do not overlap; its id is computed from a
    column, so that a join on it stays an equi-join.  Of equal polygons one is enough for their union.
    """
    if zone:
        return cut_lineage(distinct_polygons(edges.select(col(zone).alias("__zone"), "x1", "y1", "x2", "y2"), "__zone"))
    one = F.when(col("x1").isNull(), lit(1)).otherwise(lit(0))
    return edges.select(one.alias("__zone"), "x1", "y1", "x2", "y2")


def distinct_polygons(edges: DataFrame, zone: str) -> DataFrame:
    """Edges of one polygon, that with the smallest id, of each set of equal ones.

    Polygons are equal when they have the same edges, in any order; edges are told by their number and three
    64-bit hashes, of which two are added up.
    """
    seen = lambda seed: F.xxhash64(lit(seed), "x1", "y1", "x2", "y2")
    total = lambda seed: F.sum(seen(seed).cast("decimal(20,0)"))
    shape = [F.count("*").alias("__n"), total(1).alias("__a"), total(2).alias("__b"), F.bit_xor(seen(3)).alias("__c")]
    first = edges.groupBy(zone).agg(*shape).groupBy("__n", "__a", "__b", "__c").agg(F.min(zone).alias(zone)).select(zone)
    return edges.join(first.hint("merge"), zone, "left_semi")


def clip_raster(
    cells: DataFrame,
    edges: DataFrame,
    grid,
    all_touched: bool = False,
    crop: bool = True,
    fill: bool = False,
    max_rows: int = BROADCAST_ROWS,
    crs: str | None = None,
    zone: str | None = None,
) -> DataFrame:
    """Cells of the AOI: by centre, or by any contact with ``all_touched``.

    ``zone`` names the polygon of each edge; needed where polygons of the AOI overlap.

    ``crop`` keeps only the rows and columns of the AOI box; with ``fill`` the cells of that
    window outside the AOI stay with the nodata value (0 when the raster has none).
    """
    edges = on_grid_crs(edges, grid, crs)
    anchored = _area(edges, zone)
    x = grid.x("c")
    spans = zone_spans(anchored, grid, "__zone").select(
        "r", "blk", "x_lo", "x_hi", lit(None).cast("int").alias("c_lo"), lit(None).cast("int").alias("c_hi")
    )
    hit = (x >= col("x_lo")) & (x < col("x_hi"))
    if all_touched:
        passed = traversed_cells(anchored, ["__zone"], lit(grid.left), lit(grid.top), lit(grid.px_w), lit(grid.px_h), grid.height)
        passed = _blocks(passed, grid, col("c_lo"), col("c_hi"))
        spans = spans.unionByName(
            passed.select(
                "r", "blk", lit(None).cast("double").alias("x_lo"), lit(None).cast("double").alias("x_hi"), "c_lo", "c_hi"
            )
        )
        hit = F.coalesce(hit, lit(False)) | F.coalesce(col("c").between(col("c_lo"), col("c_hi")), lit(False))
    keyed = cells.withColumn("blk", F.floor(col("c") / BLOCK).cast("int"))
    bound = _spans_bound(anchored, grid, "__zone") * (2 if all_touched else 1)
    kept = sized_join(keyed, spans, ["r", "blk"], "left_semi", hit, max_rows, bound).drop("blk")
    if not fill:
        return kept
    outside = sized_join(keyed, spans, ["r", "blk"], "left_anti", hit, max_rows, bound).drop("blk")
    if crop:
        window = crop_window(edges, grid)
        outside = (
            outside.join(F.broadcast(window))  # one row by construction
            .where(col("r").between(col("r_min"), col("r_max")) & col("c").between(col("c_min"), col("c_max")))
            .drop(*window.columns)
        )
    empty = 0.0 if grid.nodata is None else grid.nodata
    return kept.unionByName(outside.withColumn("value", lit(float(empty))))


def crop_window(edges: DataFrame, grid) -> DataFrame:
    """One row: the rows and columns of the grid that the AOI box covers."""
    box = bounds(edges)
    return box.select(
        F.greatest(F.floor((grid.top - col("max_y")) / grid.px_h).cast("int"), lit(0)).alias("r_min"),
        F.least(F.ceil((grid.top - col("min_y")) / grid.px_h).cast("int") - 1, lit(grid.height - 1)).alias("r_max"),
        F.greatest(F.floor((col("min_x") - grid.left) / grid.px_w).cast("int"), lit(0)).alias("c_min"),
        F.least(F.ceil((col("max_x") - grid.left) / grid.px_w).cast("int") - 1, lit(grid.width - 1)).alias("c_max"),
    )


# --------------------------------------------------------------------------- points


def zone_index(edges: DataFrame, zone: str = "zone_id") -> DataFrame:
    """One row per zone: tile size (a power of 8 that gives 8 to 64 tiles across), band
    origin and height, and upper bounds of the rows its tiles and bands take.

    The band height keeps the banded copy of a zone within about four rows per edge.
    """
    box = edges.groupBy(zone).agg(
        F.min(F.least("x1", "x2")).alias("min_x"),
        F.max(F.greatest("x1", "x2")).alias("max_x"),
        F.min(F.least("y1", "y2")).alias("y0"),
        F.max(F.greatest("y1", "y2")).alias("max_y"),
        F.sum(F.abs(col("y2") - col("y1"))).alias("rise"),
        F.count("*").alias("n"),
    )
    width, height = col("max_x") - col("min_x"), col("max_y") - col("y0")
    level = (F.ceil(F.log2(F.greatest(width, height, lit(1e-9)) / TILES_ACROSS) / 3) * 3).cast("int")
    size = F.pow(lit(2.0), col("level"))
    return (
        box.withColumn("level", level)
        .withColumns(
            {
                "size": size,
                "band_h": F.greatest(col("rise") / (3 * col("n")), lit(1e-12)),
                "tile_rows": (width / size + 2) * (height / size + 2),
                "band_rows": 5 * col("n"),
            }
        )
        .select(zone, "level", "size", "y0", "band_h", "tile_rows", "band_rows")
    )


def zone_tiles(indexed: DataFrame, zone: str = "zone_id") -> DataFrame:
    """Square tiles of each zone: ``full`` ones hold no outline and lie inside.

    ``indexed`` are edges joined to :func:`zone_index`.
    """
    carried = ["size", "y0", "band_h"]
    keys = [zone, "level", *carried]
    zero = lit(0.0)
    border = traversed_cells(indexed, keys, zero, zero, col("size"), col("size")).withColumn("edge", lit(True))
    border = border.withColumn("tc", F.explode(F.sequence("c_lo", "c_hi"))).drop("c_lo", "c_hi")
    centre = (col("tc") + 0.5) * col("size")
    column_of = lambda x: F.floor(col(x) / col("size")).cast("int")
    inner = (
        scanline_spans(indexed, keys, zero, col("size"))
        .withColumn("tc", F.explode(F.sequence(column_of("x_lo"), column_of("x_hi"))))
        .where((centre >= col("x_lo")) & (centre < col("x_hi")))
        .drop("x_lo", "x_hi")
        .withColumn("edge", lit(False))
    )
    return (
        border.unionByName(inner)
        .withColumnRenamed("r", "tr")
        .groupBy(zone, "level", "tr", "tc")
        .agg((~F.bool_or("edge")).alias("full"), *[F.max(c).alias(c) for c in carried])
    )


def zone_bands(indexed: DataFrame, zone: str = "zone_id") -> DataFrame:
    """Edges filed under the horizontal bands of their zone."""
    band = lambda y: F.floor((y - col("y0")) / col("band_h")).cast("long")
    return (
        indexed.where(col("y1") != col("y2"))
        .withColumn("band", F.explode(F.sequence(band(F.least("y1", "y2")), band(F.greatest("y1", "y2")))))
        .select(zone, "band", "x1", "y1", "x2", "y2")
    )


def points_in_polygons(
    points: DataFrame,
    edges: DataFrame,
    id_cols: list[str],
    x: str = "x",
    y: str = "y",
    zone: str = "zone_id",
    max_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """Points joined to every zone that contains them; ``id_cols`` must be unique.

    Tiles wholly inside a zone answer without any test.  Only points in border tiles meet
    edges, and only those of their own zone and band, so nothing is compared pairwise.
    """
    carried = points.columns
    index = zone_index(edges, zone)
    # one row: the distinct tile sizes (a few powers of 8) and the bounds of the small sides
    plan = index.agg(F.collect_set("level"), F.sum("tile_rows"), F.sum("band_rows")).first()
    levels = plan[0]
    if not levels:
        return points.join(edges.select(zone).limit(0), lit(True), "inner")
    keyed = points.withColumn("level", F.explode(F.array(*[lit(v) for v in sorted(levels)])))
    size = F.pow(lit(2.0), col("level"))
    keyed = keyed.withColumns(
        {"tr": F.floor(-col(y) / size).cast("int"), "tc": F.floor(col(x) / size).cast("int")}
    )
    indexed = edges.select(zone, "x1", "y1", "x2", "y2").join(
        index.select(zone, "level", "size", "y0", "band_h"), zone
    )
    hits = sized_join(keyed, zone_tiles(indexed, zone), ["level", "tr", "tc"], max_rows=max_rows, bound=int(plan[1]))
    sure = hits.where("full").select(*carried, zone)
    maybe = hits.where("not full").withColumn("band", F.floor((col(y) - col("y0")) / col("band_h")).cast("long"))
    crossing = ((col("y1") > col(y)) != (col("y2") > col(y))) & (col(x) < edge_x_at(col(y)))
    rest = [c for c in carried if c not in id_cols]
    tested = (
        sized_join(
            maybe.select(*carried, zone, "band"), zone_bands(indexed, zone), [zone, "band"], "inner", crossing,
            max_rows, int(plan[2]),
        )
        .groupBy(*id_cols, zone)
        .agg(F.count("*").alias("__n"), *[F.first(c).alias(c) for c in rest])
        .where(col("__n") % 2 == 1)
        .select(*carried, zone)
    )
    return sure.unionByName(tested)


def distance_sq(px: Column, py: Column) -> Column:
    """Squared distance from a point to the edge ``x1, y1, x2, y2``."""
    dx, dy = col("x2") - col("x1"), col("y2") - col("y1")
    length = dx * dx + dy * dy
    t = F.when(length == 0, lit(0.0)).otherwise(
        F.least(F.greatest(((px - col("x1")) * dx + (py - col("y1")) * dy) / length, lit(0.0)), lit(1.0))
    )
    ex, ey = px - (col("x1") + t * dx), py - (col("y1") + t * dy)
    return ex * ex + ey * ey


def points_in_area(
    points: DataFrame,
    area: DataFrame,
    id_cols: list[str],
    x: str = "x",
    y: str = "y",
    zone: str | None = None,
    max_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """Points inside any polygon of an area, each once."""
    found = points_in_polygons(points, _area(area, zone), id_cols, x, y, "__zone", max_rows).drop("__zone")
    return found.dropDuplicates(id_cols) if zone else found


def within_distance(
    points: DataFrame,
    edges: DataFrame,
    distance: float,
    id_cols: list[str],
    x: str = "x",
    y: str = "y",
    max_rows: int = BROADCAST_ROWS,
    zone: str | None = None,
) -> DataFrame:
    """Points inside the AOI or at most ``distance`` from its outline (planar units).

    This is buffer membership without building the buffered outline: each edge is filed
    under the tiles its surroundings cover, and a point only meets the edges of its tile.
    """
    if distance < 0:
        raise ValueError("distance must not be negative")
    aoi = _area(edges, zone)
    if distance == 0:
        return points_in_area(points, edges, id_cols, x, y, zone, max_rows)
    size = max(distance, _mean_extent(aoi))
    near = sized_join(
        points.withColumns({"tr": F.floor(col(y) / size).cast("long"), "tc": F.floor(col(x) / size).cast("long")}),
        dilated_tiles(aoi, size),
        ["tr", "tc"],
        "left_semi",
        distance_sq(col(x), col(y)) <= lit(distance * distance),
        max_rows,
        9 * _passed_bound(aoi, size),
    ).drop("tr", "tc")
    inside = points_in_polygons(points, aoi, id_cols, x, y, "__zone", max_rows).drop("__zone")  # repeated ids go below
    return near.unionByName(inside).dropDuplicates(id_cols)


def dilated_tiles(edges: DataFrame, tile: float) -> DataFrame:
    """Edges filed under the tiles they pass and the tiles next to those."""
    zero, size = lit(0.0), lit(float(tile))
    carried = ["x1", "y1", "x2", "y2"]
    rows = traversed_cells(edges, carried, zero, zero, size, size)
    step = F.explode(F.sequence(col("r") - 1, col("r") + 1))
    return (
        rows.withColumn("rr", step)
        .withColumn("tc", F.explode(F.sequence((col("c_lo") - 1).cast("long"), (col("c_hi") + 1).cast("long"))))
        .select(*carried, (-col("rr").cast("long") - 1).alias("tr"), "tc")
        .distinct()
    )


# --------------------------------------------------------------------------- lines and features


def segment_tiles(segments: DataFrame, keys: list[str], size: float) -> DataFrame:
    """Segments filed under the tiles they pass through."""
    zero, s = lit(0.0), lit(float(size))
    return (
        traversed_cells(segments, keys, zero, zero, s, s)
        .withColumn("tc", F.explode(F.sequence("c_lo", "c_hi")))
        .select(*keys, col("r").alias("tr"), "tc")
    )


def _aoi_tiles(aoi: DataFrame, size: float) -> DataFrame:
    named = aoi.select(
        col("x1").alias("ax1"), col("y1").alias("ay1"), col("x2").alias("ax2"), col("y2").alias("ay2"),
        "x1", "y1", "x2", "y2",
    )
    keys = ["ax1", "ay1", "ax2", "ay2"]
    # one ring of neighbour tiles, so that contact on a tile border is never missed
    rows = traversed_cells(named, keys, lit(0.0), lit(0.0), lit(float(size)), lit(float(size)))
    return (
        rows.withColumn("tr", F.explode(F.sequence(col("r") - 1, col("r") + 1)))
        .withColumn("tc", F.explode(F.sequence(col("c_lo") - 1, col("c_hi") + 1)))
        .select(*keys, "tr", "tc")
        .distinct()
    )


def clip_lines(
    segments: DataFrame,
    aoi: DataFrame,
    id_cols: list[str],
    tile: float | None = None,
    max_rows: int = BROADCAST_ROWS,
    zone: str | None = None,
) -> DataFrame:
    """Line segments cut to the AOI: pieces ``id_cols, piece, x1, y1, x2, y2``.

    Cut parameters come from a tile join with the outline; a piece between two cuts is kept
    when its middle lies inside.  ``id_cols`` name one segment; ``tile`` defaults to the mean
    size of the edges.
    """
    tile = tile or max(_mean_extent(aoi), _mean_extent(segments), 1e-9)
    base = segments.select(*id_cols, "x1", "y1", "x2", "y2")
    dx, dy = col("x2") - col("x1"), col("y2") - col("y1")
    ex, ey = col("ax2") - col("ax1"), col("ay2") - col("ay1")
    den = dx * ey - dy * ex
    wx, wy = col("ax1") - col("x1"), col("ay1") - col("y1")
    t = (wx * ey - wy * ex) / F.nullif(den, lit(0.0))
    u = (wx * dy - wy * dx) / F.nullif(den, lit(0.0))
    keys = [*id_cols, "x1", "y1", "x2", "y2"]
    cuts = (
        sized_join(
            segment_tiles(base, keys, tile),
            _aoi_tiles(aoi, tile),
            ["tr", "tc"],
            "inner",
            F.coalesce((t > 0) & (t < 1) & (u >= 0) & (u <= 1), lit(False)),
            max_rows,
            9 * _passed_bound(aoi, tile),
        )
        .select(*keys, t.alias("t"))
        .distinct()
    )
    ends = base.withColumn("t", F.explode(F.array(lit(0.0), lit(1.0))))
    w = Window.partitionBy(*id_cols).orderBy("t")
    piece = (
        ends.unionByName(cuts)
        .withColumns({"t2": F.lead("t").over(w), "piece": F.row_number().over(w)})
        .where(col("t2").isNotNull())
    )
    mid = (col("t") + col("t2")) / 2
    piece = piece.withColumns({"mx": col("x1") + mid * dx, "my": col("y1") + mid * dy})
    piece = piece.withColumnsRenamed({"x1": "sx1", "y1": "sy1", "x2": "sx2", "y2": "sy2"})
    kept = points_in_area(piece, aoi, [*id_cols, "piece"], "mx", "my", zone, max_rows)
    at = lambda a, b, s: col(a) + col(s) * (col(b) - col(a))
    return kept.select(
        *id_cols,
        "piece",
        at("sx1", "sx2", "t").alias("x1"),
        at("sy1", "sy2", "t").alias("y1"),
        at("sx1", "sx2", "t2").alias("x2"),
        at("sy1", "sy2", "t2").alias("y2"),
    )


#: Distance below which coordinates touch, and its square.
CONTACT = 1e-9
CONTACT_SQ = CONTACT**2


def features_within(
    features: DataFrame,
    aoi: DataFrame,
    id_cols: list[str],
    tile: float | None = None,
    max_rows: int = BROADCAST_ROWS,
    zone: str | None = None,
    half_open: bool = False,
) -> DataFrame:
    """Ids of the features that lie wholly inside the AOI; contact with its border is allowed.

    With ``half_open`` every corner must also be inside by the half-open rule, so that of the features that
    touch the border only those stay that touch the left or the lower one.

    ``features`` is an edge table.  Edges are cut wherever they meet the outline, at crossings,
    corners and shared stretches, so that every piece is inside, on, or outside the outline as a whole, as is its
    middle.  A feature stays when no piece is outside, when no corner of the outline lies within it, as
    those of a hole would, and when a point of its interior is inside, which tells a feature that fills a hole or a
    notch from one that fills the AOI.  With ``zone``, the polygon of each AOI edge, the outline is that of their union.
    """
    if half_open:
        at = features.select(*id_cols, col("x1").alias("vx"), col("y1").alias("vy"))
        at = at.union(features.select(*id_cols, "x2", "y2")).distinct()
        corner = [*id_cols, "vx", "vy"]
        beyond = at.join(points_in_area(at, aoi, corner, "vx", "vy", zone, max_rows).hint("merge"), corner, "left_anti")
        features = cut_lineage(features.join(beyond.select(*id_cols).distinct().hint("merge"), id_cols, "left_anti"))
    tile = tile or max(_mean_extent(aoi), _mean_extent(features), 1e-9)
    outline = union_outline(aoi, zone, max_rows=max_rows) if zone else dissolve(aoi)
    outline = cut_lineage(outline.select("x1", "y1", "x2", "y2"))
    keys = [*id_cols, "x1", "y1", "x2", "y2"]
    edges = features.select(*keys).distinct()
    pieces = cut_lineage(_cut_at_contacts(edges, outline, id_cols, tile, max_rows))
    inside = points_in_area(pieces, outline, [*id_cols, "mx", "my"], "mx", "my", None, max_rows)
    open_pieces = pieces.join(inside.hint("merge"), [*id_cols, "mx", "my"], "left_anti")
    touching = _on_outline(open_pieces, outline, id_cols, tile, max_rows)
    outside = open_pieces.join(touching.hint("merge"), [*id_cols, "mx", "my"], "left_anti").select(*id_cols).distinct()
    candidate = cut_lineage(features.select(*id_cols).distinct().join(outside.hint("merge"), id_cols, "left_anti"))
    chosen = features.join(candidate.hint("merge"), id_cols, "left_semi")
    inner = _interior_points(chosen, id_cols)
    within = points_in_area(inner, outline, id_cols, "px", "py", None, max_rows)
    out_there = inner.join(within.hint("merge"), id_cols, "left_anti")
    candidate = candidate.join(out_there.hint("merge"), id_cols, "left_anti")
    shape = chosen.select(F.struct(*id_cols).alias("__f"), "x1", "y1", "x2", "y2")
    corners = outline.select(col("x1").alias("vx"), col("y1").alias("vy")).distinct()
    held = points_in_polygons(corners, shape, ["vx", "vy"], "vx", "vy", "__f", max_rows)
    # a corner on the feature's own border is contact, not a hole
    held = (
        held.join(shape, "__f")
        .groupBy("__f", "vx", "vy")
        .agg(F.min(distance_sq(col("vx"), col("vy"))).alias("__d"))
        .where(col("__d") > CONTACT_SQ)
        .select("__f")
        .distinct()
    )
    return candidate.join(held.hint("merge"), F.struct(*[candidate[c] for c in id_cols]) == col("__f"), "left_anti")


def _cut_at_contacts(edges: DataFrame, outline: DataFrame, id_cols: list[str], tile: float, max_rows: int) -> DataFrame:
    """``id_cols, mx, my``: middles of the pieces of edges between their contacts with the outline."""
    keys = [*id_cols, "x1", "y1", "x2", "y2"]
    dx, dy = col("x2") - col("x1"), col("y2") - col("y1")
    ex, ey = col("ax2") - col("ax1"), col("ay2") - col("ay1")
    den = F.nullif(dx * ey - dy * ex, lit(0.0))
    wx, wy = col("ax1") - col("x1"), col("ay1") - col("y1")
    t, u = (wx * ey - wy * ex) / den, (wx * dy - wy * dx) / den
    crossing = F.when((u >= 0) & (u <= 1), t)
    # corners of the outline that lie on the edge, also where both run along each other
    along = lambda x, y: ((x - col("x1")) * dx + (y - col("y1")) * dy) / F.nullif(dx * dx + dy * dy, lit(0.0))
    corner = lambda x, y: F.when(distance_sq(x, y) <= CONTACT_SQ, along(x, y))
    contacts = F.filter(
        F.array(crossing, corner(col("ax1"), col("ay1")), corner(col("ax2"), col("ay2"))), lambda v: (v > 0) & (v < 1)
    )
    near = (
        (F.least("x1", "x2") <= F.greatest("ax1", "ax2") + CONTACT)
        & (F.greatest("x1", "x2") >= F.least("ax1", "ax2") - CONTACT)
        & (F.least("y1", "y2") <= F.greatest("ay1", "ay2") + CONTACT)
        & (F.greatest("y1", "y2") >= F.least("ay1", "ay2") - CONTACT)
    )
    pairs = sized_join(
        segment_tiles(edges, keys, tile), _aoi_tiles(outline, tile), ["tr", "tc"], "inner", near, max_rows, 9 * _passed_bound(outline, tile)
    )
    cuts = pairs.select(*keys, F.explode(contacts).alias("t")).distinct()
    ends = edges.select(*keys, F.explode(F.array(lit(0.0), lit(1.0))).alias("t"))
    middle = (col("t") + F.lead("t").over(Window.partitionBy(*keys).orderBy("t"))) / 2
    pieces = ends.unionByName(cuts).withColumn("m", middle).where(col("m").isNotNull())
    return pieces.select(*id_cols, (col("x1") + col("m") * dx).alias("mx"), (col("y1") + col("m") * dy).alias("my")).distinct()


def _on_outline(points: DataFrame, outline: DataFrame, id_cols: list[str], tile: float, max_rows: int) -> DataFrame:
    """``id_cols, mx, my`` of the points that lie on the outline."""
    keys = [*id_cols, "mx", "my"]
    dots = points.select(*keys, col("mx").alias("x1"), col("my").alias("y1"), col("mx").alias("x2"), col("my").alias("y2"))
    dx, dy = col("ax2") - col("ax1"), col("ay2") - col("ay1")
    length = dx * dx + dy * dy
    share = ((col("mx") - col("ax1")) * dx + (col("my") - col("ay1")) * dy) / F.nullif(length, lit(0.0))
    t = F.least(F.greatest(F.coalesce(share, lit(0.0)), lit(0.0)), lit(1.0))
    gx, gy = col("mx") - (col("ax1") + t * dx), col("my") - (col("ay1") + t * dy)
    tiles = segment_tiles(dots, [*keys, "x1", "y1", "x2", "y2"], tile).select(*keys, "tr", "tc")
    near = gx * gx + gy * gy <= CONTACT_SQ
    return sized_join(tiles, _aoi_tiles(outline, tile), ["tr", "tc"], "left_semi", near, max_rows, 9 * _passed_bound(outline, tile)).select(*keys)


def _interior_points(features: DataFrame, id_cols: list[str]) -> DataFrame:
    """``id_cols, px, py``: a point within each feature, halfway between its first two borders on a line through it.

    The line lies halfway between its two lowest corners of different height; lines have none.
    """
    feature = Window.partitionBy(*id_cols)
    above = lambda y: F.when(col(y) > col("__low"), col(y))
    line = features.withColumn("__low", F.min(F.least("y1", "y2")).over(feature))
    line = line.withColumn("py", (F.min(F.least(above("y1"), above("y2"))).over(feature) + col("__low")) / 2)
    met = line.where((F.least("y1", "y2") <= col("py")) & (F.greatest("y1", "y2") > col("py")))
    at = col("x1") + (col("py") - col("y1")) * (col("x2") - col("x1")) / (col("y2") - col("y1"))
    w = Window.partitionBy(*id_cols).orderBy("__x")
    spots = met.select(*id_cols, "py", at.alias("__x")).withColumns({"__next": F.lead("__x").over(w), "__at": F.row_number().over(w)})
    return spots.where((col("__at") == 1) & col("__next").isNotNull()).select(*id_cols, ((col("__x") + col("__next")) / 2).alias("px"), "py")


def dissolve(edges: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Union of adjoining polygons that share whole edges: borders that occur twice vanish.

    Polygons that overlap or meet in part of an edge need :func:`union_outline`.
    """
    keys = keys or []
    swap = (col("x1") > col("x2")) | ((col("x1") == col("x2")) & (col("y1") > col("y2")))
    a = lambda p, q: F.when(swap, col(q)).otherwise(col(p))
    return (
        edges.select(
            *keys, a("x1", "x2").alias("x1"), a("y1", "y2").alias("y1"), a("x2", "x1").alias("x2"), a("y2", "y1").alias("y2")
        )
        .groupBy(*keys, "x1", "y1", "x2", "y2")
        .agg(F.count("*").alias("__n"))
        .where(col("__n") % 2 == 1)
        .drop("__n")
    )


#: The sides of a piece of outline are tested at this share of its length from its middle.
SIDE = 1e-6


def union_outline(edges: DataFrame, zone: str, tile: float | None = None, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Outline of the union of polygons, as undirected edges ``x1, y1, x2, y2``.

    Edges are cut where they meet others (tile join), also at corners that lie on them, so pieces
    only meet in their ends.  A piece stays when exactly one of its sides is in a polygon.
    Overlapping, equal, nested and partly adjoining polygons and holes come right alike; gaps
    narrower than about ``SIDE`` of a piece are taken for contact.
    """
    tile = tile or max(_mean_extent(edges), 1e-9)
    base = edges.select("x1", "y1", "x2", "y2").where((col("x1") != col("x2")) | (col("y1") != col("y2"))).distinct()
    keys = ["x1", "y1", "x2", "y2"]
    dx, dy = col("x2") - col("x1"), col("y2") - col("y1")
    ex, ey = col("ax2") - col("ax1"), col("ay2") - col("ay1")
    den = F.nullif(dx * ey - dy * ex, lit(0.0))
    wx, wy = col("ax1") - col("x1"), col("ay1") - col("y1")
    t, u = (wx * ey - wy * ex) / den, (wx * dy - wy * dx) / den
    mine = F.struct(*keys) < F.struct("ax1", "ay1", "ax2", "ay2")
    cut = lambda at, px, py: F.struct(at.alias("t"), px.alias("px"), py.alias("py"))
    # both edges of a crossing take the point from the same one of them, and a corner as it is
    cross = F.when(
        (t > 0) & (t < 1) & (u >= 0) & (u <= 1),
        cut(
            t,
            F.when(u == 0, col("ax1")).when(u == 1, col("ax2")).when(mine, col("x1") + t * dx).otherwise(col("ax1") + u * ex),
            F.when(u == 0, col("ay1")).when(u == 1, col("ay2")).when(mine, col("y1") + t * dy).otherwise(col("ay1") + u * ey),
        ),
    )
    on_line = den.isNull() & (wx * dy == wy * dx)
    along = lambda px, py: ((col(px) - col("x1")) * dx + (col(py) - col("y1")) * dy) / (dx * dx + dy * dy)
    end = lambda px, py: F.when(
        on_line & (along(px, py) > 0) & (along(px, py) < 1), cut(along(px, py), col(px), col(py))
    )
    found = F.array_compact(F.array(cross, end("ax1", "ay1"), end("ax2", "ay2")))
    cuts = (
        sized_join(
            segment_tiles(base, keys, tile), _aoi_tiles(base, tile), ["tr", "tc"], "inner", F.size(found) > 0, max_rows,
            9 * _passed_bound(base, tile),
        )
        .select(*keys, F.explode(found).alias("p"))
        .select(*keys, "p.*")
    )
    ends = base.select(*keys, F.explode(F.array(cut(lit(0.0), col("x1"), col("y1")), cut(lit(1.0), col("x2"), col("y2")))).alias("p"))
    w = Window.partitionBy(*keys).orderBy("t", "px", "py")
    pieces = cuts.unionByName(ends.select(*keys, "p.*")).distinct().select(
        col("px").alias("a"), col("py").alias("b"), F.lead("px").over(w).alias("c"), F.lead("py").over(w).alias("d")
    )
    pieces = pieces.where(col("c").isNotNull() & ((col("a") != col("c")) | (col("b") != col("d"))))
    swap = (col("a") > col("c")) | ((col("a") == col("c")) & (col("b") > col("d")))
    pick = lambda p, q: F.when(swap, col(q)).otherwise(col(p))
    pieces = pieces.select(
        pick("a", "c").alias("sx1"), pick("b", "d").alias("sy1"), pick("c", "a").alias("sx2"), pick("d", "b").alias("sy2")
    ).distinct()
    pieces = cut_lineage(pieces)
    side = pieces.withColumn("side", F.explode(F.array(lit(-SIDE), lit(SIDE)))).withColumns(
        {
            "mx": (col("sx1") + col("sx2")) / 2 - col("side") * (col("sy2") - col("sy1")),
            "my": (col("sy1") + col("sy2")) / 2 + col("side") * (col("sx2") - col("sx1")),
        }
    )
    names = ["sx1", "sy1", "sx2", "sy2"]
    covered = points_in_area(side, edges, [*names, "side"], "mx", "my", zone, max_rows)
    # written, as users of the outline read it several times
    return cut_lineage(covered.groupBy(*names).count().where("count = 1").select(*[col(s).alias(k) for s, k in zip(names, keys)]))


def polygon_area(edges: DataFrame, keys: list[str], units: str = "m2", name: str | None = None) -> DataFrame:
    """Shoelace area per key over edges in planar metres; holes wind the other way."""
    if units not in ("m2", "km2"):
        raise ValueError(f"unknown units {units!r}")
    area = F.abs(F.sum(col("x1") * col("y2") - col("x2") * col("y1"))) / 2
    if units == "km2":
        area = area / 1_000_000
    return edges.groupBy(*keys).agg(area.alias(name or f"area_{units}"))


def project_edges(edges: DataFrame, forward) -> DataFrame:
    """Apply ``forward(lon, lat) -> (x, y)`` to both ends of every edge."""
    xa, ya = forward(col("x1"), col("y1"))
    xb, yb = forward(col("x2"), col("y2"))
    return edges.withColumns({"x1": xa, "y1": ya, "x2": xb, "y2": yb})


def line_length(segments: DataFrame, keys: list[str], name: str = "length_m") -> DataFrame:
    """Planar length per feature."""
    return segments.groupBy(*keys).agg(
        F.sum(F.hypot(col("x2") - col("x1"), col("y2") - col("y1"))).alias(name)
    )


def tile_prefilter(
    features: DataFrame, aoi: DataFrame, size: float, max_rows: int = BROADCAST_ROWS
) -> DataFrame:
    """Features whose box shares a tile, and overlaps, with the AOI box of that tile.

    ``features`` carries ``min_x, min_y, max_x, max_y``; candidates for an exact test.
    """
    cover = lambda lo, hi: F.explode(
        F.sequence(F.floor(col(lo) / size).cast("long"), F.floor(col(hi) / size).cast("long"))
    )
    named = aoi.select(*[col(c).alias(f"a_{c}") for c in ("min_x", "min_y", "max_x", "max_y")])
    right = named.withColumn("tx", cover("a_min_x", "a_max_x")).withColumn("ty", cover("a_min_y", "a_max_y"))
    left = features.withColumn("tx", cover("min_x", "max_x")).withColumn("ty", cover("min_y", "max_y"))
    overlap = (
        (col("min_x") <= col("a_max_x")) & (col("max_x") >= col("a_min_x"))
        & (col("min_y") <= col("a_max_y")) & (col("max_y") >= col("a_min_y"))
    )
    hit = sized_join(left, right, ["tx", "ty"], "left_semi", overlap, max_rows)
    return hit.drop("tx", "ty").distinct()


def _slices(array: Column, size: int) -> Column:
    """An array that is not empty, in consecutive arrays of at most ``size``."""
    return F.transform(F.sequence(lit(1), F.size(array), lit(size)), lambda start: F.slice(array, start, size))


def _in_lists(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Rows that agree in ``keys``, in lists of structs of their other columns, ``LISTED`` long on average and twice that at most.

    A list has ``__rows`` rows and the number ``__part``, below ``__parts``.  Rows are dealt to the parts by hash, so many
    tasks gather those of one key.  Rows with a NULL key, which join nothing, are left out.
    """
    for k in keys:
        rows = rows.where(col(k).isNotNull())
    many = cut_lineage(rows.groupBy(*keys).agg(F.count("*").alias("__rows")).where(col("__rows") > LISTED))
    hashable = [c for c, kind in rows.dtypes if "map<" not in kind]
    dealt = (
        sized_join(rows, many, keys, "left")
        .withColumn("__parts", F.coalesce(F.ceil(col("__rows") / LISTED), lit(1)).cast("int"))
        .withColumn("__part", F.pmod(F.xxhash64(*hashable), col("__parts")).cast("int"))
    )
    row = F.struct(*[c for c in rows.columns if c not in keys])
    lists = dealt.groupBy(*keys, "__parts", "__part").agg(F.collect_list(row).alias("__list"))
    # equal rows have one hash, so a list may still be too long
    lists = lists.withColumn("__list", F.explode(_slices(col("__list"), 2 * LISTED)))
    return cut_lineage(lists.withColumn("__rows", F.size("__list")))


def roads_by_place(
    roads: DataFrame, places: DataFrame, size: float, road: str = "osm_id", place: str = "place_id", iso3: str = "iso3",
    max_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """Roads of a country filed under each of its places whose box they meet.

    One road table serves all places of a country.  The join key is country and tile, so a
    place only meets the roads around it and not the whole country.  Places and roads of equal boxes
    are moved and joined as lists; only the last step unrolls them, in tasks that hold ``UNROLLED`` places and
    a list of roads at a time.  Both sides carry ``min_x, min_y, max_x, max_y``.
    """
    sides = ["min_x", "min_y", "max_x", "max_y"]
    p_sides = [f"p_{c}" for c in sides]
    cover = lambda lo, hi: F.explode(
        F.sequence(F.floor(col(lo) / size).cast("long"), F.floor(col(hi) / size).cast("long"))
    )
    tiled = lambda df: df.withColumn("tx", cover("min_x", "max_x")).withColumn("ty", cover("min_y", "max_y"))
    number = lambda parts: F.explode(F.sequence(lit(0), col(parts) - 1))
    others = [c for c in roads.columns if c not in (iso3, *sides)]
    road_lists = _in_lists(roads, [iso3, *sides])
    place_lists = _in_lists(places.select(iso3, place, *sides), [iso3, *sides])
    # equal boxes of a country have the same answer, so each pair of different boxes is tested once
    road_boxes = road_lists.groupBy(iso3, *sides).agg(F.max("__parts").alias("__parts"))
    place_boxes = place_lists.groupBy(iso3, *sides).agg(F.max("__parts").alias("__p_parts"))
    near = tiled(place_boxes).withColumnsRenamed(dict(zip(sides, p_sides)))
    # the pair counts in the tile of its common lower corner only, so no duplicates arise
    first = (F.floor(F.greatest("min_x", "p_min_x") / size) == col("tx")) & (
        F.floor(F.greatest("min_y", "p_min_y") / size) == col("ty")
    )
    overlap = (
        (col("min_x") <= col("p_max_x")) & (col("max_x") >= col("p_min_x"))
        & (col("min_y") <= col("p_max_y")) & (col("max_y") >= col("p_min_y"))
    )
    hit = sized_join(tiled(road_boxes), near, [iso3, "tx", "ty"], "inner", overlap & first, max_rows).drop("tx", "ty")
    filed = place_lists.select(
        iso3, *[col(c).alias(p) for c, p in zip(sides, p_sides)], col("__part").alias("__p_part"), col("__list")[place].alias("__places")
    )
    pairs = (
        hit.withColumn("__p_part", number("__p_parts")).join(filed.hint("merge"), [iso3, *p_sides, "__p_part"])
        .select(iso3, *sides, "__parts", F.explode(_slices(col("__places"), UNROLLED)).alias("__places"))
        .withColumn("__part", number("__parts")).drop("__parts")
    )
    listed = road_lists.agg(F.sum("__rows")).first()[0] or 0
    spark = roads.sparkSession
    both = sized_join(
        pairs, road_lists.select(iso3, *sides, "__part", "__list"), [iso3, *sides, "__part"], max_rows=max_rows, bound=listed,
        tasks=max(int(spark.conf.get("spark.sql.shuffle.partitions")), TASKS_PER_CORE * spark.sparkContext.defaultParallelism),
    )
    each = both.select(iso3, "__places", F.explode("__list").alias("__road"))
    return each.select(iso3, "__places", *[col("__road")[c].alias(c) for c in others]).select(
        iso3, F.explode("__places").alias(place), *others
    )


def geometry_size(parts: str = "parts") -> Column:
    """Number of coordinates over all parts of a feature."""
    return F.aggregate(F.transform(parts, F.size), lit(0), lambda acc, n: acc + n)


def ring_centroid(vertices: DataFrame, keys: list[str]) -> DataFrame:
    """Mean of the ring vertices, the repeated last one included."""
    return vertices.groupBy(*keys).agg(F.avg("px").alias("cx"), F.avg("py").alias("cy"))


def area_centroid(edges: DataFrame, keys: list[str]) -> DataFrame:
    """True centroid of the enclosed area."""
    cross = col("x1") * col("y2") - col("x2") * col("y1")
    return (
        edges.groupBy(*keys)
        .agg(
            F.sum(cross).alias("__a"),
            F.sum((col("x1") + col("x2")) * cross).alias("__x"),
            F.sum((col("y1") + col("y2")) * cross).alias("__y"),
        )
        .select(*keys, (col("__x") / (3 * col("__a"))).alias("cx"), (col("__y") / (3 * col("__a"))).alias("cy"))
    )
