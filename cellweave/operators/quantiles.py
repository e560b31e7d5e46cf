"""Exact order statistics per group, also for groups too large for one task."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cellweave.session import cut_lineage, group_sizes, sized_join

col, lit = F.col, F.lit

#: Inputs counted to hold at most this many rows are ranked with the built-in aggregates.
SMALL_ROWS = 2_000_000


def value_counts(df: DataFrame, keys: Sequence[str], value: str = "value") -> DataFrame:
    """Histogram ``keys, value, n`` of the non-null, non-NaN values."""
    return (
        df.where(col(value).isNotNull() & ~F.isnan(value)).groupBy(*keys, value).agg(F.count("*").alias("n"))
    )


def ranked_values(
    hist: DataFrame,
    keys: Sequence[str],
    targets: dict[str, Callable[[Column], Column]],
    value: str = "value",
    small: bool | None = None,
    groups: int | None = None,
) -> DataFrame:
    """Values at given 0-based ranks: ``keys, total`` and one column per target.

    ``targets[name](total)`` gives the rank as a Column.  The histogram is sorted by range
    partitioning on (keys, value): a huge group spreads over many partitions, each of which
    only needs the counts of the partitions before it.  Only slices that hold a target rank
    are ranked row by row.
    """
    keys = list(keys)
    if small is None or groups is None:
        groups, rows = group_sizes(hist, keys)
        small = rows <= SMALL_ROWS if small is None else small
    if small:
        sliced = hist.withColumn("__pid", lit(0))
    else:
        # the partition number is only stable once it is written down
        sliced = cut_lineage(
            hist.repartitionByRange(*keys, value).withColumn("__pid", F.spark_partition_id())
        )
    per_slice = sliced.groupBy(*keys, "__pid").agg(F.sum("n").alias("__n"))
    before = Window.partitionBy(*keys).orderBy("__pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_slice.withColumns(
        {
            "__off": F.coalesce(F.sum("__n").over(before), lit(0)),
            "total": F.sum("__n").over(Window.partitionBy(*keys)),
        }
    )
    wanted = F.array(
        *[F.struct(lit(name).alias("name"), rank(col("total")).cast("long").alias("rank")) for name, rank in targets.items()]
    )
    asked = (
        offsets.withColumn("__t", F.explode(wanted))
        .select(*keys, "__pid", "__off", "__n", "total", "__t.name", "__t.rank")
        .where((col("rank") >= col("__off")) & (col("rank") < col("__off") + col("__n")))
        .groupBy(*keys, "__pid", "__off", "total")
        .agg(F.collect_list(F.struct("name", "rank")).alias("__asked"))  # at most one entry per target
    )
    w = Window.partitionBy(*keys, "__pid").orderBy(value).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    found = (
        sized_join(sliced, asked, [*keys, "__pid"], bound=groups * len(targets))
        .withColumn("__hi", col("__off") + F.sum("n").over(w))
        .withColumn(
            "__t", F.explode(F.filter("__asked", lambda t: (t["rank"] < col("__hi")) & (t["rank"] >= col("__hi") - col("n"))))
        )
    )
    return found.groupBy(*keys).agg(
        F.max("total").alias("total"),
        *[F.max(F.when(col("__t.name") == name, col(value))).alias(name) for name in targets],
    )


def group_percentiles(
    df: DataFrame,
    keys: Sequence[str],
    percents: dict[str, float],
    value: str = "value",
    small: bool | None = None,
    groups: int | None = None,
) -> DataFrame:
    """Exact percentiles with linear interpolation: ``keys`` and one column per entry."""
    targets: dict[str, Callable[[Column], Column]] = {}
    for name, p in percents.items():
        targets[f"__lo_{name}"] = lambda n, p=p: F.floor((n - 1) * lit(p / 100.0))
        targets[f"__hi_{name}"] = lambda n, p=p: F.ceil((n - 1) * lit(p / 100.0))
    ranked = ranked_values(value_counts(df, keys, value), keys, targets, value, small, groups)

    def between(name: str, p: float) -> Column:
        pos = (col("total") - 1) * lit(p / 100.0)
        lo, hi = col(f"__lo_{name}"), col(f"__hi_{name}")
        return lo + (hi - lo) * (pos - F.floor(pos))

    return ranked.select(*keys, *[between(name, p).alias(name) for name, p in percents.items()])
