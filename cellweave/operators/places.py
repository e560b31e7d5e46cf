"""Places, regions and work lists: name filters, lookups, pending work, outcomes."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

col, lit = F.col, F.lit

# fixed values: ISO3 country code → download region
REGIONS = {
    "DZA": "algeria", "AGO": "angola", "BEN": "benin", "BWA": "botswana", "BFA": "burkina-faso",
    "BDI": "burundi", "CMR": "cameroon", "CPV": "cape-verde", "CAF": "central-african-republic",
    "TCD": "chad", "COM": "comoros", "COG": "congo-brazzaville", "COD": "congo-democratic-republic",
    "DJI": "djibouti", "EGY": "egypt", "GNQ": "equatorial-guinea", "ERI": "eritrea", "ETH": "ethiopia",
    "GAB": "gabon", "GHA": "ghana", "GIN": "guinea", "GNB": "guinea-bissau", "CIV": "ivory-coast",
    "KEN": "kenya", "LSO": "lesotho", "LBR": "liberia", "LBY": "libya", "MDG": "madagascar",
    "MWI": "malawi", "MLI": "mali", "MRT": "mauritania", "MUS": "mauritius", "MAR": "morocco",
    "MOZ": "mozambique", "NAM": "namibia", "NER": "niger", "NGA": "nigeria", "RWA": "rwanda",
    "SHN": "saint-helena-ascension-and-tristan-da-cunha", "STP": "sao-tome-and-principe",
    "SEN": "senegal", "SYC": "seychelles", "SLE": "sierra-leone", "SOM": "somalia",
    "ZAF": "south-africa", "SSD": "south-sudan", "SDN": "sudan", "TZA": "tanzania", "TGO": "togo",
    "TUN": "tunisia", "UGA": "uganda", "ZMB": "zambia", "ZWE": "zimbabwe",
}

# fixed values: region → (min lon, min lat, max lon, max lat)
REGION_BOXES = {
    "kenya": (33.908859, -4.678047, 41.899078, 5.506),
    "tanzania": (29.327, -11.745, 40.443, -0.984),
    "uganda": (29.573, -1.475, 35.000, 4.234),
    "rwanda": (28.861, -2.840, 30.899, -1.047),
    "ethiopia": (32.997, 3.397, 47.986, 14.880),
    "nigeria": (2.668, 4.240, 14.680, 13.892),
    "ghana": (-3.260, 4.710, 1.191, 11.174),
    "south-africa": (16.458, -34.819, 32.895, -22.126),
}


def filter_in(df: DataFrame, column: str, names: Sequence[str] | None, check: bool = True) -> DataFrame:
    """Rows with one of the names, or all rows for ``None``; nothing left is an error."""
    out = df if names is None else df.where(col(column).isin(list(names)))
    if check and out.isEmpty():
        raise ValueError(f"no rows remain after filtering {column}")
    return out


def missing_names(requested: DataFrame, features: DataFrame, column: str) -> DataFrame:
    """Requested names that the data lacks."""
    return requested.select(column).distinct().join(features.select(column), column, "left_anti")


def require_names(requested: DataFrame, features: DataFrame, column: str) -> DataFrame:
    """``features`` itself, or an error with the number of missing names.

    The names themselves may be many: :func:`missing_names` and :func:`list_names` give all of them.
    """
    absent, such = missing_names(requested, features, column).agg(F.count("*"), F.min(column)).first()
    if absent:
        known = list_names(features, column).count()
        raise ValueError(
            f"{absent} requested name(s) not found in {column}, such as {such!r}; missing_names gives all, "
            f"list_names the {known} there are"
        )
    return features


def list_names(df: DataFrame, column: str, prefix: str | None = None) -> DataFrame:
    """Distinct names in order, optionally by case-insensitive prefix."""
    out = df.select(column).where(col(column).isNotNull())
    if prefix:
        out = out.where(F.lower(column).startswith(prefix.lower()))
    return out.distinct().orderBy(column)


def filter_places(
    df: DataFrame,
    country: str | Sequence[str] = "all",
    city: Sequence[str] | None = None,
    iso3: str = "iso3",
    name: str = "name",
    check: bool = True,
) -> DataFrame:
    """Places of the listed countries and, if given, cities."""
    out = df
    if not (isinstance(country, str) and country.lower() == "all"):
        out = out.where(col(iso3).isin([country] if isinstance(country, str) else list(country)))
    if city:
        out = out.where(col(name).isin(list(city)))
    if check and out.isEmpty():
        raise ValueError("no places match the filters")
    return out


def country_label(iso3: Column, name: Column, index: Column) -> tuple[Column, Column]:
    """Display name and code of a country row: code, else name, else ``Country_i``; code ``UNK``."""
    return (
        F.coalesce(iso3, name, F.concat(lit("Country_"), index.cast("string"))),
        F.coalesce(iso3, lit("UNK")),
    )


def _lookup(table: dict[str, str]) -> Column:
    return F.create_map(*[lit(v) for pair in table.items() for v in pair])


def region_of(iso3: Column) -> Column:
    """Download region of a country code, else the lower-case code."""
    return F.coalesce(_lookup(REGIONS)[iso3], F.lower(iso3))


def iso3_of(region: Column) -> Column:
    """Country code of a region, else the upper-case region."""
    return F.coalesce(_lookup({v: k for k, v in REGIONS.items()})[region], F.upper(region))


def regions_for_boxes(boxes: DataFrame, regions: dict[str, tuple] | None = None) -> DataFrame:
    """One row per box ``min_x..max_y`` and region whose box meets it (closed).

    The region table is a small constant, so it is tested inline instead of joined.
    """
    hit = lambda b: (
        (col("min_x") <= lit(b[2])) & (col("max_x") >= lit(b[0])) & (col("min_y") <= lit(b[3])) & (col("max_y") >= lit(b[1]))
    )
    table = regions or REGION_BOXES
    found = F.array_compact(F.array(*[F.when(hit(b), lit(name)) for name, b in table.items()]))
    return boxes.withColumn("region", F.explode(found))


def require_regions(boxes: DataFrame) -> DataFrame:
    out = regions_for_boxes(boxes)
    if out.isEmpty():
        raise ValueError("no known region meets the area")
    return out


def validate_rows(df: DataFrame, checks: dict[str, Column]) -> DataFrame:
    """Rows that break a check, with the names of the broken checks."""
    broken = F.array_compact(F.array(*[F.when(~F.coalesce(ok, lit(False)), lit(name)) for name, ok in checks.items()]))
    return df.withColumn("broken", F.concat_ws(",", broken)).where(col("broken") != "")


def coordinate_checks(lat: str = "latitude", lon: str = "longitude") -> dict[str, Column]:
    return {
        "latitude": ~F.isnan(lat) & col(lat).between(-90, 90),
        "longitude": ~F.isnan(lon) & col(lon).between(-180, 180),
    }


def buffer_check(km: str) -> dict[str, Column]:
    return {"buffer": ~F.isnan(km) & col(km).between(0, 1000)}


def epsg_check(code: str) -> dict[str, Column]:
    return {"epsg": col(code).between(1000, 99999)}


def require_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    absent = [c for c in columns if c not in df.columns]
    if absent:
        raise ValueError(f"columns not found: {absent}; available: {df.columns}")
    return df


def pending(inputs: DataFrame, outputs: DataFrame, keys: Sequence[str], mode: str = "skip_existing") -> DataFrame:
    """Inputs still to do.  ``skip_existing`` drops finished ones, ``overwrite`` redoes all,
    ``error`` refuses when any exists."""
    keys = list(keys)
    if mode == "overwrite":
        return inputs
    if mode == "error":
        if not inputs.join(outputs.select(*keys), keys, "left_semi").isEmpty():
            raise ValueError("outputs exist already")
        return inputs
    if mode != "skip_existing":
        raise ValueError(f"unknown mode {mode!r}")
    return inputs.join(outputs.select(*keys), keys, "left_anti")


def stale(log: DataFrame, max_age_days: int, now: Column, at: str = "download_date") -> DataFrame:
    """Whole-day age and a flag for old entries, newest first; nothing is dropped."""
    age = F.floor((F.unix_timestamp(now) - F.unix_timestamp(at)) / 86400).cast("int")
    return log.withColumn("age_days", age).withColumn("stale", col("age_days") > max_age_days).orderBy(F.desc(at))


def union_parts(parts: Sequence[DataFrame]) -> DataFrame | None:
    """All parts one below the other; columns missing in a part are NULL."""
    if not parts:
        return None
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def batch_outcome(outcomes: DataFrame, keys: Sequence[str] = ("run",)) -> DataFrame:
    """Counts per run, success if any item succeeded.

    Full failure lists can be as long as the batch, so they stay rows: see :func:`failures`.
    """
    ok = col("status") == "success"
    return outcomes.groupBy(*keys).agg(
        F.count("*").alias("total"),
        F.count_if(ok).alias("succeeded"),
        F.count_if(~ok).alias("failed"),
        F.bool_or(ok).alias("success"),
    )


def failures(outcomes: DataFrame, keys: Sequence[str] = ("run",)) -> DataFrame:
    """Every failed item with its error."""
    return outcomes.where(col("status") != "success").select(*keys, "item", "error")
