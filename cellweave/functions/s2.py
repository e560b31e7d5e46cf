"""S2 cells as Column expressions: tokens, corners, coverings and size estimates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# fixed values: published Hilbert curve tables of the S2 library
IJ_TO_POS = (0, 1, 3, 2, 0, 3, 1, 2, 2, 3, 1, 0, 2, 1, 3, 0)
POS_TO_IJ = (0, 1, 3, 2, 0, 2, 3, 1, 3, 2, 0, 1, 3, 1, 0, 2)
POS_TO_ORIENTATION = (1, 0, 0, 3)

# fixed values: approximate cell side in degrees per level, and the default for other levels
CELL_DEGREES = {4: 5.09, 5: 2.54, 6: 1.27, 7: 0.635, 8: 0.318}
DEFAULT_CELL_DEGREES = 1.27
EARTH_AREA_KM2 = 510_000_000
# fixed value: no cell's diagonal is longer, in degrees times 2 ** level
MAX_DIAGONAL = 139.73
BUILDINGS_PER_CELL = 1000

lit = F.lit


def _table(values) -> Column:
    return F.array(*[lit(v) for v in values])


def _at(table: Column, i: Column) -> Column:
    return F.element_at(table, (i + 1).cast("int"))


def _let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once, however often the body uses it."""
    return F.transform(F.array(value), lambda v: body(v))[0]


def check_level(level: int) -> int:
    if not 0 <= level <= 30:
        raise ValueError(f"S2 level {level} is not in 0..30")
    return level


def _pick(face: Column, choices) -> Column:
    out = F.when(face == 0, choices[0])
    for k in range(1, 5):
        out = out.when(face == k, choices[k])
    return out.otherwise(choices[5])


def face_ij(lat: Column, lon: Column, level: int) -> Column:
    """``struct<face, i, j>``: face and cell coordinates of a point at ``level``."""
    side = 1 << level

    def sphere(p: Column) -> Column:
        phi, lam = F.radians(p["lat"]), F.radians(p["lon"])
        return F.struct(
            (F.cos(phi) * F.cos(lam)).alias("x"), (F.cos(phi) * F.sin(lam)).alias("y"), F.sin(phi).alias("z")
        )

    def face_of(p: Column) -> Column:
        ax, ay, az = F.abs(p["x"]), F.abs(p["y"]), F.abs(p["z"])
        return (
            F.when((ax > ay) & (ax > az), F.when(p["x"] < 0, 3).otherwise(0))
            .when(ay > az, F.when(p["y"] < 0, 4).otherwise(1))
            .otherwise(F.when(p["z"] < 0, 5).otherwise(2))
        )

    def plane(q: Column) -> Column:
        x, y, z, face = q["p"]["x"], q["p"]["y"], q["p"]["z"], q["face"]
        return F.struct(
            face.alias("face"),
            _pick(face, (y / x, -x / y, -x / z, z / x, z / y, -y / z)).alias("u"),
            _pick(face, (z / x, z / y, -y / z, y / x, -x / y, -x / z)).alias("v"),
        )

    def cell(w: Column) -> Column:
        s = F.when(w >= 0, 0.5 * F.sqrt(1 + 3 * w)).otherwise(1 - 0.5 * F.sqrt(1 - 3 * w))
        return F.least(F.greatest(F.floor(s * side), lit(0)), lit(side - 1)).cast("long")

    point = _let(F.struct(lat.alias("lat"), lon.alias("lon")), sphere)
    faced = _let(point, lambda p: F.struct(face_of(p).cast("long").alias("face"), p.alias("p")))
    flat = _let(faced, plane)
    return _let(flat, lambda q: F.struct(q["face"].alias("face"), cell(q["u"]).alias("i"), cell(q["v"]).alias("j")))


def cell_id(lat: Column, lon: Column, level: int) -> Column:
    """64-bit S2 cell id."""
    check_level(level)
    start = _let(
        face_ij(lat, lon, level),
        lambda p: F.struct(
            p["face"].alias("face"), p["i"].alias("i"), p["j"].alias("j"),
            p["face"].bitwiseAND(lit(1).cast("long")).alias("o"), lit(0).cast("long").alias("pos"),
        ),
    )
    pos_of, turn = _table(IJ_TO_POS), _table(POS_TO_ORIENTATION)

    def descend(acc: Column, k: Column) -> Column:
        half = F.pow(lit(2), k).cast("long")
        bit = lambda n: F.floor(acc[n] / half).cast("long").bitwiseAND(lit(1).cast("long"))
        quarter = _at(pos_of, acc["o"] * 4 + bit("i") * 2 + bit("j"))
        return F.struct(
            acc["face"].alias("face"), acc["i"].alias("i"), acc["j"].alias("j"),
            acc["o"].bitwiseXOR(_at(turn, quarter).cast("long")).alias("o"),
            (acc["pos"] * 4 + quarter).cast("long").alias("pos"),
        )

    def finish(acc: Column) -> Column:
        return (
            F.shiftleft(acc["face"], 61)
            + F.shiftleft(acc["pos"], 61 - 2 * level)
            + lit(1 << (60 - 2 * level)).cast("long")
        )

    if level == 0:
        return finish(start)
    return F.aggregate(F.sequence(lit(level - 1), lit(0)), start, descend, finish)


def to_token(cell: Column) -> Column:
    """Cell id → hex token without trailing zeros."""
    return F.rtrim(F.lower(F.lpad(F.hex(cell), 16, "0")), lit("0"))


def token(lat: Column, lon: Column, level: int) -> Column:
    return to_token(cell_id(lat, lon, level))


def cell_corners(face: Column, pos: Column, level: int) -> Column:
    """Corners of the ``pos``-th cell of a face as ``array<struct<x lon, y lat>>`` (four points)."""
    ij_of, turn = _table(POS_TO_IJ), _table(POS_TO_ORIENTATION)
    start = F.struct(
        pos.cast("long").alias("pos"), face.cast("long").bitwiseAND(lit(1).cast("long")).alias("o"),
        lit(0).cast("long").alias("i"), lit(0).cast("long").alias("j"), face.cast("long").alias("face"),
    )

    def descend(acc: Column, k: Column) -> Column:
        quarter = F.floor(acc["pos"] / F.pow(lit(4), k)).cast("long").bitwiseAND(lit(3).cast("long"))
        ij = _at(ij_of, acc["o"] * 4 + quarter).cast("long")
        return F.struct(
            acc["pos"].alias("pos"),
            acc["o"].bitwiseXOR(_at(turn, quarter).cast("long")).alias("o"),
            (acc["i"] * 2 + F.floor(ij / 2)).cast("long").alias("i"),
            (acc["j"] * 2 + ij.bitwiseAND(lit(1).cast("long"))).cast("long").alias("j"),
            acc["face"].alias("face"),
        )

    side = float(1 << level)

    def uv(k: Column) -> Column:
        s = k / side
        return F.when(s >= 0.5, (4 * s * s - 1) / 3).otherwise((1 - 4 * (1 - s) * (1 - s)) / 3)

    def sphere(p: Column) -> Column:
        u, v, f, one = p["u"], p["v"], p["face"], lit(1.0)
        axes = ((one, u, v), (-u, one, v), (-u, -v, one), (-one, -v, -u), (v, -one, -u), (v, u, -one))
        return F.struct(*[_pick(f, [a[n] for a in axes]).alias(name) for n, name in enumerate("xyz")])

    def degrees(p: Column) -> Column:
        x, y, z = p["x"], p["y"], p["z"]
        return F.struct(
            F.degrees(F.atan2(y, x)).alias("x"), F.degrees(F.atan2(z, F.sqrt(x * x + y * y))).alias("y")
        )

    def finish(acc: Column) -> Column:
        steps = F.array(*[F.struct(lit(di).alias("di"), lit(dj).alias("dj")) for di, dj in ((0, 0), (1, 0), (1, 1), (0, 1))])
        plane = F.transform(
            steps,
            lambda d: F.struct(uv(acc["i"] + d["di"]).alias("u"), uv(acc["j"] + d["dj"]).alias("v"), acc["face"].alias("face")),
        )
        return F.transform(F.transform(plane, lambda p: sphere(p)), lambda p: degrees(p))

    if level == 0:
        return finish(start)
    return _let(F.aggregate(F.sequence(lit(level - 1), lit(0)), start, descend), finish)


def token_polygon(tok: Column, level: int) -> Column:
    """Closed ring of a token's cell: four corners and the first again."""
    bits = F.conv(F.rpad(tok, 16, "0"), 16, -10).cast("long")
    face = F.shiftrightunsigned(bits, 61)
    pos = F.shiftrightunsigned(bits, 61 - 2 * level).bitwiseAND(lit((1 << (2 * level)) - 1).cast("long"))
    ring = cell_corners(face, pos, level)
    return F.concat(ring, F.slice(ring, 1, 1))


def all_cells(spark: SparkSession, level: int) -> DataFrame:
    """Every cell of a level with its token and latitude/longitude box."""
    check_level(level)
    per_face = 4**level
    cells = spark.range(6 * per_face).select(
        F.floor(F.col("id") / per_face).cast("long").alias("face"), (F.col("id") % per_face).alias("pos")
    )
    number = (
        F.shiftleft(F.col("face"), 61)
        + F.shiftleft(F.col("pos"), 61 - 2 * level)
        + lit(1 << (60 - 2 * level)).cast("long")
    )
    xs = F.transform("ring", lambda p: p["x"])
    ys = F.transform("ring", lambda p: p["y"])
    return (
        cells.withColumn("ring", cell_corners(F.col("face"), F.col("pos"), level))
        .withColumn("token", to_token(number))
        .withColumns({"min_y": F.array_min(ys), "max_y": F.array_max(ys)})
        # a pole cell reaches all longitudes; a box over 180 degrees wide wraps the antimeridian
        .withColumn("min_x", F.array_min(xs))
        .withColumn("max_x", F.array_max(xs))
        .select("token", "face", "pos", "min_x", "min_y", "max_x", "max_y", "ring")
    )


def covering(boxes: DataFrame, keys: list[str], level: int = 6, max_cells: int = 1_000_000) -> DataFrame:
    """Tokens of all cells whose box meets each bounding rectangle ``min_x..max_y``, a row for each rectangle and cell.

    ``max_cells`` guards against a level too fine for the area: beyond it an error is raised,
    nothing is cut off.
    """
    from cellweave.session import BROADCAST_ROWS, sized_join

    # cells and rectangles meet through one-degree latitude stripes, and count in the first that they share
    stripes = lambda lo, hi: F.explode(F.sequence(F.floor(lo).cast("int"), F.floor(hi).cast("int")))
    wraps = (F.col("max_x") - F.col("min_x")) > 180
    polar = F.greatest(F.abs("min_y"), F.abs("max_y")) > 89.999999
    cells = (
        all_cells(boxes.sparkSession, level)
        .withColumns({"wrap": wraps & ~polar, "any_lon": polar})
        .withColumn("min_y", F.when(polar & (F.col("min_y") < 0), lit(-90.0)).otherwise(F.col("min_y")))
        .withColumn("max_y", F.when(polar & (F.col("max_y") > 0), lit(90.0)).otherwise(F.col("max_y")))
        .withColumn(
            "lon_min",
            F.when(F.col("wrap"), F.array_min(F.filter(F.transform("ring", lambda p: p["x"]), lambda v: v > 0)))
            .otherwise(F.col("min_x")),
        )
        .withColumn(
            "lon_max",
            F.when(F.col("wrap"), F.array_max(F.filter(F.transform("ring", lambda p: p["x"]), lambda v: v < 0)))
            .otherwise(F.col("max_x")),
        )
        .select(
            "token", F.col("min_y").alias("c_min_y"), F.col("max_y").alias("c_max_y"),
            "lon_min", "lon_max", "wrap", "any_lon",
        )
        .withColumn("stripe", stripes(F.col("c_min_y"), F.col("c_max_y")))
    )
    number = 6 * 4**level
    stripes_bound = number * (int(MAX_DIAGONAL / 2**level) + 2)
    boxed = boxes.select(*keys, "min_x", "min_y", "max_x", "max_y")
    if stripes_bound <= BROADCAST_ROWS:  # rectangles are not moved by the join; those of one small file are work for all tasks
        boxed = boxed.repartition(*keys, "min_x", "min_y")
    boxed = boxed.withColumn("stripe", stripes(F.col("min_y"), F.col("max_y")))
    lon = (
        F.col("any_lon")
        | (F.col("wrap") & ((F.col("max_x") >= F.col("lon_min")) | (F.col("min_x") <= F.col("lon_max"))))
        | (~F.col("wrap") & (F.col("max_x") >= F.col("lon_min")) & (F.col("min_x") <= F.col("lon_max")))
    )
    lat = (F.col("max_y") >= F.col("c_min_y")) & (F.col("min_y") <= F.col("c_max_y"))
    first = F.col("stripe") == F.greatest(F.floor("min_y"), F.floor("c_min_y"))
    found = sized_join(boxed, cells, ["stripe"], "inner", lon & lat & first, bound=stripes_bound).select(*keys, "token")
    if number > max_cells:  # else no covering can be too large
        worst = found.groupBy(*keys).count().agg(F.max("count")).first()[0]
        if worst is not None and worst > max_cells:
            raise ValueError(f"covering needs {worst} cells, more than max_cells={max_cells}")
    return found


def estimate_cells(min_x: Column, min_y: Column, max_x: Column, max_y: Column, level: int = 6) -> Column:
    """Rough number of cells for a bounding box."""
    size = CELL_DEGREES.get(level, DEFAULT_CELL_DEGREES)
    area = (max_x - min_x) * (max_y - min_y)
    return F.floor(area / lit(size * size)).cast("int") + 1


def cell_area_km2(level: int) -> float:
    """Mean cell area of a level."""
    return EARTH_AREA_KM2 / (6 * 4**level)


def estimate_buildings(cells: Column) -> Column:
    return cells * BUILDINGS_PER_CELL
