"""Names, months, dates and file-type expressions."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# fixed values: file extensions per kind
RASTER_EXTENSIONS = (".tif", ".tiff", ".geotif", ".geotiff", ".nc", ".netcdf", ".hdf", ".h5")
VECTOR_EXTENSIONS = (".shp", ".geojson", ".gpkg", ".gml", ".kml", ".kmz")
ARCHIVE_EXTENSIONS = (".zip", ".tar", ".tar.gz", ".tgz", ".tar.bz2", ".tbz2")
SHAPEFILE_COMPANIONS = (".shx", ".dbf", ".prj", ".cpg", ".sbn", ".sbx")

# fixed values: file-name patterns that carry a month, tried in this order; group = month
MONTH_PATTERNS = (
    (r"(?i)\.(\d{4})(\d{2})-\d{6}\.tif$", 2),
    (r"(?i)_(\d{4})_(\d{2})[_.]tif$", 2),
    (r"(?i)_(\d{4})-(\d{2})[_.]tif$", 2),
    (r"(?i)_(\d{2})[_.]tif$", 1),
    (r"(?i)(jan|feb|mar|apr|may|jun|jul|aug|sep|oct|nov|dec)", 1),
)
MONTH_NAMES = ("jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec")

# fixed values: path keywords per dataset type, in order of precedence
DATASET_KEYWORDS = (
    ("copernicus", ("copernicus", "clms", "land_cover", "lc")),
    ("odiac", ("odiac", "emission", "co2")),
    ("pm25", ("pm25", "pm2.5")),
    ("temperature", ("lst", "temperature")),
)
CATEGORICAL_KEYWORDS = ("land_cover", "landcover", "lc", "class", "category")
RESAMPLING_METHODS = ("nearest", "bilinear", "cubic", "cubic_spline", "lanczos", "average", "mode")


def extension(path: Column) -> Column:
    return F.lower(F.regexp_extract(path, r"\.[^./]+$", 0))


def file_name(path: Column) -> Column:
    return F.regexp_extract(path, r"[^/]*$", 0)


def file_kind(path: Column) -> Column:
    """``raster``, ``vector``, ``archive`` or ``other``."""
    ext = extension(path)
    packed = F.lower(path).rlike("(" + "|".join(re.escape(e) for e in ARCHIVE_EXTENSIONS) + ")$")
    return (
        F.when(ext.isin(*RASTER_EXTENSIONS), "raster")
        .when(ext.isin(*VECTOR_EXTENSIONS), "vector")
        .when(packed, "archive")
        .otherwise("other")
    )


def glob_regex(pattern: str) -> str:
    """Shell pattern (``*``, ``?``) → anchored regular expression."""
    parts = {"*": ".*", "?": "."}
    return "^" + "".join(parts.get(ch, re.escape(ch)) for ch in pattern) + "$"


def clean_dataset_name(s: Column) -> Column:
    """File stem → column-name prefix."""
    out = F.lower(s)
    for ext in (".tif", ".tiff", ".geotif", ".geotiff"):
        out = F.replace(out, F.lit(ext), F.lit(""))
    out = F.regexp_replace(out, "[^a-z0-9]+", "_")
    out = F.regexp_replace(out, "^_|_$", "")
    return F.when(out.rlike("^[0-9]"), F.concat(F.lit("data_"), out)).otherwise(out)


def output_name(iso3: Column, name: Column, kind: str, period: Column | None = None) -> Column:
    """``ISO3_Place_kind[_period]`` with spaces and slashes of the place as ``_``."""
    place = F.regexp_replace(name, "[ /]", "_")
    parts = [iso3, place, F.lit(kind)]
    if period is not None:
        parts.append(F.replace(period, F.lit("-"), F.lit("_")))
    return F.concat_ws("_", *parts)


def safe_name(s: Column, max_length: int = 255) -> Column:
    """Only ``A-Za-z0-9-_.``, bounded length, no leading dot or dash."""
    out = F.substring(F.regexp_replace(s, "[^A-Za-z0-9_.-]", "_"), 1, max_length)
    return F.when(out.rlike("^[.-]"), F.concat(F.lit("file_"), out)).otherwise(out)


def _valid_month(m: Column) -> Column:
    return F.when(m.between(1, 12), m)


def month_from_filename(path: Column, patterns: Sequence[tuple[str, int]] | None = None) -> Column:
    """First pattern that yields a month 1-12; digits or a month name."""
    name = file_name(path)
    found = []
    for pattern, group in patterns or MONTH_PATTERNS:
        text = F.lower(F.regexp_extract(name, pattern, group))
        by_name = F.array_position(F.array(*[F.lit(m) for m in MONTH_NAMES]), F.substring(text, 1, 3)).cast("int")
        found.append(_valid_month(F.coalesce(F.expr("null").cast("int"), text.try_cast("int"), by_name)))
    return F.coalesce(*found)


def month_from_tag(tags: Column, key: str = "temporal_period") -> Column:
    """Month of a ``YYYY-MM`` tag."""
    return _valid_month(F.regexp_extract(tags[key], r"(\d{4})-(\d{2})", 2).try_cast("int"))


def dataset_type(path: Column) -> Column:
    text = F.lower(path)
    out = None
    for kind, words in DATASET_KEYWORDS:
        hit = text.rlike("|".join(re.escape(w) for w in words))
        out = F.when(hit, kind) if out is None else out.when(hit, kind)
    return out.otherwise("generic")


def pick_resampling(path: Column, method: str = "cubic") -> Column:
    """The default (cubic) gives way to nearest for categorical data."""
    if method not in RESAMPLING_METHODS:
        method = "cubic"
    if method != "cubic":
        return F.lit(method)
    categorical = F.lower(path).rlike("|".join(CATEGORICAL_KEYWORDS))
    return F.when(categorical, "nearest").otherwise(method)


def truncate_columns(df: DataFrame, n: int = 10) -> DataFrame:
    """Column names cut to ``n`` characters; a clash becomes two fewer plus a two-digit number."""
    taken = {c for c in df.columns if len(c) <= n}
    renames: dict[str, str] = {}
    for name in df.columns:
        if name == "geometry" or len(name) <= n:
            continue
        short, k = name[:n], 0
        while short in taken:
            k += 1
            short = f"{name[: n - 2]}{k:02d}"
        taken.add(short)
        renames[name] = short
    return df.withColumnsRenamed(renames)
