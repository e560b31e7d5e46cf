"""Feature tables: GeoJSON and building tables in, GeoJSON, CSV and parquet out."""

from __future__ import annotations

import warnings
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cellweave.schema import BUILDINGS
from cellweave.session import cut_lineage, discard, sized_join

_FEATURE = T.StructType(
    [
        T.StructField("type", T.StringType()),
        T.StructField("id", T.StringType()),
        T.StructField("properties", T.MapType(T.StringType(), T.StringType())),
        # coordinates stay text: their nesting depends on the geometry type
        T.StructField(
            "geometry",
            T.StructType([T.StructField("type", T.StringType()), T.StructField("coordinates", T.StringType())]),
        ),
    ]
)
_COLLECTION = T.StructType([T.StructField("features", T.ArrayType(_FEATURE))])
_CRS = T.StructType(
    [T.StructField("crs", T.StructType([T.StructField("properties", T.StructType([T.StructField("name", T.StringType())]))]))]
)


def _points(coords: Column) -> Column:
    return F.transform(coords, lambda p: F.struct(p[0].alias("x"), p[1].alias("y")))


def _parse(kind: Column, text: Column) -> tuple[Column, Column]:
    """``(parts, rings per polygon)`` of a coordinate text."""
    depth = lambda n: F.from_json(text, "array<" * n + "double" + ">" * n)
    rings = lambda c: F.transform(c, _points)
    polygons = depth(4)
    parts = (
        F.when(kind == "Point", F.array(F.array(F.struct(depth(1)[0].alias("x"), depth(1)[1].alias("y")))))
        .when(kind.isin("LineString", "MultiPoint"), F.array(_points(depth(2))))
        .when(kind.isin("Polygon", "MultiLineString"), rings(depth(3)))
        .when(kind == "MultiPolygon", rings(F.flatten(polygons)))
    )
    shape = F.when(kind == "MultiPolygon", F.transform(polygons, F.size)).otherwise(F.array(F.size(parts)))
    return parts, shape


#: Names that a GeoJSON ``crs`` member gives to longitude and latitude.
_LONLAT = "(?i)(?:CRS84|EPSG:{1,2}4326)$"


def feature_records(spark: SparkSession, path: str | Sequence[str], lines: bool = False) -> DataFrame:
    """``file, position, f, crs, broken``: one row per feature, and per text that is no feature.

    ``broken`` holds a text that could not be parsed (a line, or what is left of a document);
    ``position`` is the place of the feature in its file.
    """
    paths = [path] if isinstance(path, str) else list(path)
    if lines:
        raw = spark.read.text(paths).select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), "value")
        raw = raw.where(F.trim("value") != "")
        schema = T.StructType([*_FEATURE, T.StructField("broken", T.StringType())])
        parsed = F.from_json("value", schema, {"columnNameOfCorruptRecord": "broken"})
        # block of the file and row within the task that reads it: unique, and the same while files are split alike
        row = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
        named = F.concat_ws("-", F.col("block").cast("string"), row.cast("string")).alias("position")
        return raw.select("file", named, parsed.alias("f"), F.lit(None).cast("string").alias("crs"), parsed["broken"].alias("broken"))
    schema = T.StructType(
        [*_COLLECTION, *_CRS, T.StructField("type", T.StringType()), T.StructField("broken", T.StringType())]
    )
    docs = (
        spark.read.schema(schema)
        .option("multiLine", True)
        .option("columnNameOfCorruptRecord", "broken")
        .json(paths)
        .select(F.col("_metadata.file_path").alias("file"), "*")
    )
    # a document that is neither broken nor a collection holds no features either
    broken = F.coalesce("broken", F.when(F.col("features").isNull(), F.concat(F.lit("no FeatureCollection but "), F.coalesce("type", F.lit("other JSON")))))
    return docs.select("file", F.posexplode_outer("features").alias("position", "f"), F.col("crs.properties.name").alias("crs"), broken.alias("broken"))


def rejected_features(spark: SparkSession, path: str | Sequence[str], lines: bool = False) -> DataFrame:
    """``file, broken``: every document or line that is no feature, in full."""
    records = feature_records(spark, path, lines)
    return records.where(F.col("broken").isNotNull()).select("file", "broken")


def read_features(
    spark: SparkSession,
    path: str | Sequence[str],
    crs: str | None = None,
    lines: bool = False,
    check: bool = True,
    strict: bool = True,
) -> DataFrame:
    """GeoJSON → ``feature_id, given_id, properties, crs, geom_type, parts, shape``.

    With ``lines`` each text line is one feature: such files split over tasks.  A
    FeatureCollection is one JSON document, so one task parses one file; :func:`write_features` bounds their size.

    ``feature_id`` is made of the file and the feature's place in it, so it is unique over files
    and the same on each read; the id in the file is ``given_id``.  ``crs``
    overrides the file's own ``crs`` member; without both it is EPSG:4326.  A malformed document or
    line is an error that counts them; :func:`rejected_features` lists all, and ``strict=False`` goes on
    without them.
    """
    records = feature_records(spark, path, lines)
    if strict:
        bad = records.where(F.col("broken").isNotNull()).count()
        if bad:
            raise ValueError(f"{bad} malformed document(s) or line(s) in {path}; rejected_features lists them")
    rows = records.where(F.col("broken").isNull() & F.col("f").isNotNull())
    parts, shape = _parse(F.col("f.geometry.type"), F.col("f.geometry.coordinates"))
    named = F.when(F.col("crs").rlike(_LONLAT), F.lit("EPSG:4326")).otherwise(
        F.regexp_replace("crs", r"^urn:ogc:def:crs:([^:]+):[^:]*:([^:]+)$", "$1:$2")
    )
    out = rows.select(
        F.concat_ws("#", "file", F.col("position").cast("string")).alias("feature_id"),
        F.col("f.id").alias("given_id"),
        F.col("f.properties").alias("properties"),
        F.coalesce(F.lit(crs), named, F.lit("EPSG:4326")).alias("crs"),
        F.col("f.geometry.type").alias("geom_type"),
        parts.alias("parts"),
        shape.alias("shape"),
    )
    if check and out.isEmpty():
        raise ValueError(f"no features could be read from {path}")
    return out


def feature_vertices(features: DataFrame, keys: Sequence[str] = ("feature_id",)) -> DataFrame:
    """``keys, part, seq, x, y``: one row per vertex."""
    return (
        features.select(*keys, F.posexplode("parts").alias("part", "ring"))
        .select(*keys, "part", F.posexplode("ring").alias("seq", "p"))
        .select(*keys, "part", "seq", F.col("p.x").alias("x"), F.col("p.y").alias("y"))
    )


def feature_edges(features: DataFrame, keys: Sequence[str] = ("feature_id",)) -> DataFrame:
    """``keys, part, seq, x1, y1, x2, y2``: consecutive vertices, without any window."""
    pairs = F.transform(
        F.sequence(F.lit(1), F.size("ring") - 1),
        lambda i: F.struct(F.get("ring", i - 1).alias("a"), F.get("ring", i).alias("b")),
    )
    return (
        features.select(*keys, F.posexplode("parts").alias("part", "ring"))
        .where(F.size("ring") > 1)
        .select(*keys, "part", F.posexplode(pairs).alias("seq", "e"))
        .select(
            *keys, "part", "seq",
            F.col("e.a.x").alias("x1"), F.col("e.a.y").alias("y1"), F.col("e.b.x").alias("x2"), F.col("e.b.y").alias("y2"),
        )
    )


def parts_from_vertices(vertices: DataFrame, keys: Sequence[str], seq: str = "seq", x: str = "px", y: str = "py") -> DataFrame:
    """Vertex rows of single-ring features → ``keys, parts, shape``."""
    ordered = F.array_sort(F.collect_list(F.struct(F.col(seq).alias("s"), F.col(x).alias("x"), F.col(y).alias("y"))))
    ring = F.transform(ordered, lambda p: F.struct(p["x"].alias("x"), p["y"].alias("y")))
    return vertices.groupBy(*keys).agg(F.array(ring).alias("parts")).withColumn("shape", F.array(F.lit(1)))


def _coordinates(kind: Column) -> Column:
    pair = lambda p: F.array(p["x"], p["y"])
    rings = F.transform("parts", lambda ring: F.transform(ring, pair))
    starts = F.transform("shape", lambda n, i: F.aggregate(F.slice("shape", 1, i), F.lit(0), lambda a, b: a + b))
    polygons = F.transform(F.arrays_zip(starts.alias("at"), F.col("shape").alias("n")), lambda s: F.slice(rings, s["at"] + 1, s["n"]))
    return (
        F.when(kind == "Point", F.to_json(rings[0][0]))
        .when(kind.isin("LineString", "MultiPoint"), F.to_json(rings[0]))
        .when(kind == "MultiPolygon", F.to_json(polygons))
        .otherwise(F.to_json(rings))
    )


def feature_text(df: DataFrame, properties: Sequence[str]) -> Column:
    """One feature as GeoJSON text."""
    attrs = F.to_json(F.struct(*properties), {"ignoreNullFields": "false"}) if properties else F.lit("{}")
    return F.format_string(
        '{"type":"Feature","properties":%s,"geometry":{"type":"%s","coordinates":%s}}',
        attrs, F.col("geom_type"), _coordinates(F.col("geom_type")),
    )


#: A GeoJSON document is read by one task, so written ones are to have about this many bytes.
FILE_BYTES = 32 << 20


def _as_collection(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    head = '{"type":"FeatureCollection","features":['
    for pdf in batches:
        if len(pdf):
            lines = "," + pdf["value"]
            lines.iloc[0] = head + lines.iloc[0][1:] if head != "," else lines.iloc[0]
            head = ","
            yield pd.DataFrame({"value": lines})
    yield pd.DataFrame({"value": [("]}" if head == "," else head + "]}")]})


def write_features(
    df: DataFrame, path: str, fmt: str = "geojson", properties: Sequence[str] | None = None, mode: str = "errorifexists"
) -> None:
    """``geojson``: part files that are each a FeatureCollection of about ``FILE_BYTES`` at most; ``geojsonl``: one feature per
    line; ``parquet``: the feature table itself.  Any other name is written as GeoJSON."""
    if fmt == "parquet":
        df.write.mode(mode).parquet(path)
        return
    if fmt not in ("geojson", "geojsonl"):
        warnings.warn(f"unknown vector format {fmt!r}, writing GeoJSON", stacklevel=2)
        fmt = "geojson"
    known = {"parts", "shape", "geom_type", "crs"}
    attrs = [c for c in df.columns if c not in known] if properties is None else list(properties)
    text = df.select(feature_text(df, attrs).alias("value"))
    if fmt == "geojsonl":
        text.write.mode(mode).text(path)
        return
    written = cut_lineage(text)
    size = written.agg(F.sum(F.octet_length("value") + 1)).first()[0] or 0
    files = -(-size // FILE_BYTES)
    spread = written.repartition(files) if files > 1 else written.coalesce(1)
    spread.mapInPandas(_as_collection, "value string").write.mode(mode).text(path)
    discard(written)


def read_buildings(
    spark: SparkSession,
    path: str | Sequence[str],
    names: Sequence[str] | None = None,
    partitions: int | None = None,
    rejected: str | None = None,
) -> DataFrame:
    """Headerless gzip CSV building files.

    gzip does not split, so a file is one task; ``partitions`` spreads the rows afterwards.  A
    line that does not fit the columns is an error; with ``rejected`` all rows are returned, and
    the column of that name holds the text of a line that does not fit (else NULL).
    """
    schema = BUILDINGS
    if names is not None:
        types = {f.name: f.dataType for f in BUILDINGS}
        schema = T.StructType([T.StructField(n, types.get(n, T.StringType())) for n in names])
    reader = spark.read.option("header", False)
    if rejected is None:
        reader = reader.schema(schema).option("mode", "FAILFAST")
    else:
        schema = T.StructType([*schema, T.StructField(rejected, T.StringType())])
        reader = reader.schema(schema).option("columnNameOfCorruptRecord", rejected)
    df = reader.csv([path] if isinstance(path, str) else list(path))
    return df.repartition(partitions) if partitions else df


def scan_by_cell_token(
    spark: SparkSession, path: str, tokens: DataFrame, token: str = "s2_token", schema: T.StructType | None = None
) -> DataFrame:
    """Buildings of the listed cells from a table partitioned by cell token.

    The token list prunes the partitions at run time; a token without files has no rows.
    """
    reader = spark.read if schema is None else spark.read.schema(schema)
    return sized_join(reader.parquet(path), tokens.select(token).distinct(), [token], "left_semi")


def write_buildings_by_token(df: DataFrame, path: str, token: str = "s2_token", mode: str = "errorifexists") -> None:
    """One folder per cell; rows of a cell are split over several tasks and files."""
    spread = F.pmod(F.xxhash64("latitude", "longitude"), F.lit(8))
    df.repartition(token, spread).write.mode(mode).partitionBy(token).parquet(path)


BUILDING_COLUMNS = ("latitude", "longitude", "area_in_meters", "confidence")


def write_csv(
    df: DataFrame, path: str, polygons: bool = True, plus_codes: bool = False, mode: str = "errorifexists"
) -> None:
    """Building table as gzip CSV with a header: four columns, then geometry and plus code if asked."""
    building_columns(df, polygons, plus_codes).write.mode(mode).option("header", True).option(
        "compression", "gzip"
    ).csv(path)


def building_columns(df: DataFrame, polygons: bool = True, plus_codes: bool = False) -> DataFrame:
    extra = (["geometry"] if polygons else []) + (["full_plus_code"] if plus_codes else [])
    return df.select(*BUILDING_COLUMNS, *extra)


def write_stats_csv(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    df.write.mode(mode).option("header", True).csv(path)
