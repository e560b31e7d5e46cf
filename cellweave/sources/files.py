"""Directory and archive listings as DataFrames."""

from __future__ import annotations

import io
import zipfile
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cellweave.functions.text import (
    RASTER_EXTENSIONS,
    SHAPEFILE_COMPANIONS,
    VECTOR_EXTENSIONS,
    extension,
    file_kind,
    file_name,
    glob_regex,
)


def scan_files(spark: SparkSession, path: str | Sequence[str], recursive: bool = False, glob: str | None = None) -> DataFrame:
    """``path, length, modified`` of the files of a folder; contents are not read."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", str(recursive).lower())
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.load(path if isinstance(path, str) else list(path)).select(
        "path", "length", F.col("modificationTime").alias("modified")
    )


def list_files(
    files: DataFrame, extensions: Sequence[str] | None = None, pattern: str | None = None, exclude: str | None = None
) -> DataFrame:
    """Files with one of the extensions (any case) or matching the pattern, each once, in order."""
    out = files
    if extensions:
        out = out.where(extension(F.col("path")).isin([e.lower() for e in extensions]))
    if pattern:
        out = out.where(file_name(F.col("path")).rlike("(?i)" + glob_regex(pattern)))
    if exclude:
        out = out.where(F.col("path") != exclude)
    return out.dropDuplicates(["path"]).orderBy("path")


def require_single(files: DataFrame, pattern: str) -> DataFrame:
    """The one file that matches, as a row; none or several is an error."""
    found = list_files(files, pattern=pattern)
    n = found.count()
    if n != 1:
        raise ValueError(f"{pattern} must match one file, found {n}; list_files with this pattern gives them")
    return found


def classify_files(files: DataFrame, raster_pattern: str = "*.tif") -> DataFrame:
    """Adds ``kind``; the pattern filters rasters only, and only when it is not ``*.tif``."""
    out = files.withColumn("kind", file_kind(F.col("path")))
    if raster_pattern and raster_pattern != "*.tif":
        out = out.where((F.col("kind") != "raster") | file_name(F.col("path")).rlike(glob_regex(raster_pattern)))
    return out


def read_zip_entries(spark: SparkSession, path: str | Sequence[str], recursive: bool = True) -> DataFrame:
    """``archive, entry`` of all zip files below a folder."""
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", str(recursive).lower())
        .option("pathGlobFilter", "*.{zip,ZIP}")
        .load(path if isinstance(path, str) else list(path))
        .select("path", "content")
    )

    def names(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for archive, content in zip(pdf["path"], pdf["content"]):
                with zipfile.ZipFile(io.BytesIO(content)) as z:
                    yield pd.DataFrame({"archive": archive, "entry": z.namelist()})

    return files.mapInPandas(names, "archive string, entry string")


def select_archive_entries(entries: DataFrame, pattern: str | None = None) -> DataFrame:
    """Geospatial entries, and the companions of every shapefile next to it.

    Folders are skipped.  Companions are found by a join on (archive, folder, stem).
    """
    e = F.col("entry")
    folder = F.regexp_extract(e, r"^(.*)/[^/]*$", 1)
    stem = F.regexp_replace(file_name(e), r"\.[^.]*$", "")
    named = entries.where(~e.endswith("/")).withColumns({"ext": extension(e), "folder": folder, "stem": stem})
    data = named.where(F.col("ext").isin(*RASTER_EXTENSIONS, *VECTOR_EXTENSIONS))
    if pattern:
        data = data.where(file_name(e).rlike("(?i)" + glob_regex(pattern)))
    keys = ["archive", "folder", "stem"]
    shapes = data.where(F.col("ext") == ".shp").select(*keys).distinct()
    companions = named.where(F.col("ext").isin(*SHAPEFILE_COMPANIONS)).join(shapes, keys, "left_semi")
    return data.unionByName(companions).select("archive", "entry", "ext").distinct()


def list_archive_entries(spark: SparkSession, path: str | Sequence[str], pattern: str | None = None) -> DataFrame:
    return select_archive_entries(read_zip_entries(spark, path), pattern)
