"""Cell tables on disk, gridded variables, and item catalogues."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cellweave.schema import Grid
from cellweave.session import sized_join

#: rows of the raster per output file
ROWS_PER_FILE = 4096


def write_cells(
    cells: DataFrame, path: str, grid: Grid, tags: dict[str, str] | None = None, mode: str = "errorifexists"
) -> None:
    """Cell table partitioned by raster and band, and one metadata row per raster beside it.

    NULL values become the nodata value.  A large raster is cut into row blocks, so that no
    task writes a whole raster; statistics of ``r`` then prune row groups on reading.
    """
    filled = cells
    if grid.nodata is not None:
        filled = cells.withColumn("value", F.coalesce("value", F.lit(float(grid.nodata))))
    block = F.floor(F.col("r") / ROWS_PER_FILE)
    (
        filled.select("raster_id", "band", "r", "c", "value")
        .repartition("raster_id", "band", block)
        .sortWithinPartitions("raster_id", "band", "r", "c")
        .write.mode(mode)
        .partitionBy("raster_id", "band")
        .parquet(f"{path}/cells")
    )
    rasters = spark_rasters(filled, grid, tags)
    rasters.write.mode("overwrite" if mode == "overwrite" else "append").parquet(f"{path}/rasters")


def spark_rasters(cells: DataFrame, grid: Grid, tags: dict[str, str] | None = None) -> DataFrame:
    """Metadata rows ``raster_id, band_count, width, ..., tags`` of a cell table on one grid."""
    pairs = [F.lit(v) for item in {**grid.tags, **(tags or {})}.items() for v in item]
    meta = {
        "width": grid.width, "height": grid.height, "crs": grid.crs, "px_w": grid.px_w, "px_h": grid.px_h,
        "left": grid.left, "top": grid.top,
    }
    tag_map = F.create_map(*pairs) if pairs else F.create_map()
    return (
        cells.groupBy("raster_id")
        .agg(F.max("band").alias("band_count"))
        .withColumns({k: F.lit(v) for k, v in meta.items()})
        .withColumn("nodata", F.lit(grid.nodata).cast("double"))
        .withColumn("tags", tag_map.cast("map<string,string>"))
    )


def read_cells(
    spark: SparkSession, path: str, raster_ids: Sequence[str] | None = None, bands: Sequence[int] | None = None
) -> DataFrame:
    """Cells of the wanted rasters and bands; both are partition filters.  Band numbers start
    at 1, numbers that do not exist select nothing."""
    df = spark.read.parquet(f"{path}/cells")
    if raster_ids is not None:
        df = df.where(F.col("raster_id").isin(list(raster_ids)))
    if bands is not None:
        df = df.where(F.col("band").isin([int(b) for b in bands]))
    return df


def read_rasters(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(f"{path}/rasters")


def gridded_to_cells(
    df: DataFrame, x: str, y: str, time: str | None, var: str | None = None, raster: str = "raster_id"
) -> DataFrame:
    """Long gridded variable → cells, one raster per time step.

    Row 0 is the largest ``y`` whatever the input order.  Indices come from the distinct
    coordinates, so only those are ranked, not the data.
    """
    if var is None:
        rest = [c for c in df.columns if c not in (x, y, time)]
        if not rest:
            raise ValueError("no data variable")
        var = rest[0]
    rank = lambda c, order: (F.row_number().over(Window.orderBy(order)) - 1).alias(c)
    rows = df.select(F.col(y).alias("__y")).distinct().select("__y", rank("r", F.desc("__y")))
    cols = df.select(F.col(x).alias("__x")).distinct().select("__x", rank("c", F.asc("__x")))
    if time is None:
        name = F.lit(var)
    else:
        name = F.concat(F.lit(f"{var}_"), F.date_format(F.to_date(time), "yyyyMMdd"))
    keyed = df.select(name.alias(raster), F.col(x).alias("__x"), F.col(y).alias("__y"), F.col(var).cast("double").alias("value"))
    return sized_join(sized_join(keyed, rows, ["__y"]), cols, ["__x"]).select(
        raster, F.lit(1).alias("band"), "r", "c", F.col("__x").alias("x"), F.col("__y").alias("y"), "value"
    )


def catalog_months(
    items: DataFrame, year: int, keys: Sequence[str] = (), at: str = "start_datetime", item: str = "item_id",
    href: str = "href", check: bool = True,
) -> DataFrame:
    """``month`` (``YYYY-MM``) → item of a year; the latest item of a month wins."""
    stamp = F.date_format(at, "yyyy-MM-dd'T'HH:mm:ss") if dict(items.dtypes)[at] != "string" else F.col(at)
    chosen = items.withColumn("__at", stamp).where(F.substring("__at", 1, 4) == str(year))
    out = (
        chosen.groupBy(*keys, F.substring("__at", 1, 7).alias("month"))
        .agg(F.max(F.struct("__at", item, href)).alias("m"))
        .select(*keys, "month", F.col(f"m.{item}").alias(item), F.col(f"m.{href}").alias(href))
    )
    if check and out.isEmpty():
        raise ValueError(f"no items for the year {year}")
    return out
