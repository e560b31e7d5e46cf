"""Session helpers: size-checked broadcasts and lineage cuts."""

from __future__ import annotations

import tempfile
import uuid
import weakref
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A side is broadcast only when it is counted to hold at most this many rows; the driver holds several such sides at a time.
BROADCAST_ROWS = 100_000
#: Copies of the smaller side when a join has to shuffle; spreads a hot key over tasks.
SALTS = 8

#: Folders of the tables that ``cut_lineage`` wrote.
_FOLDERS: weakref.WeakKeyDictionary[DataFrame, str] = weakref.WeakKeyDictionary()


def is_small(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> bool:
    """True when ``df`` is counted to have at most ``max_rows`` rows."""
    return df.limit(max_rows + 1).count() <= max_rows


def sized_join(
    big: DataFrame,
    small: DataFrame,
    on: Sequence[str],
    how: str = "inner",
    where: Column | None = None,
    max_rows: int = BROADCAST_ROWS,
    bound: int | None = None,
    tasks: int | None = None,
) -> DataFrame:
    """Equi-join with an optional residual predicate.

    The small side is counted first, unless the caller knows an upper ``bound`` of its rows
    (such as from one cheap aggregate over its input).  Within ``max_rows`` it is broadcast and ``big`` is not
    moved at all; beyond it both sides shuffle on the key plus a salt, so that one hot key
    is worked on by ``SALTS`` tasks.  ``small`` must not share non-key column names with
    ``big``.  Spark itself may not broadcast it either: it goes by the size of the files, which say little of
    exploded rows.  Valid for inner, left, left_semi and left_anti joins.

    With ``tasks`` a join that shuffles has that many tasks, however few bytes they read; for joins whose rows are
    unrolled.  Keys are of one type on both sides then.
    """
    same = lambda a, b: (a <= b) & (a >= b)
    equal = Column.__eq__
    keys = {k: f"__k_{k}" for k in on}
    right = small.withColumnsRenamed(keys)
    if bound <= max_rows if bound is not None else is_small(small, max_rows):
        right = F.broadcast(right)
        left = big
        cond = F.lit(True)
    else:
        hashable = [c for c, kind in big.dtypes if "map<" not in kind]
        left = big.withColumn("__salt", F.pmod(F.xxhash64(*hashable), F.lit(SALTS)).cast("int"))
        right = right.withColumn("__rsalt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        cond = F.col("__salt") == F.col("__rsalt")
        if tasks is not None:
            left = left.withColumn("__hash", F.xxhash64("__salt", *on)).repartition(tasks, "__hash")
            right = right.withColumn("__rhash", F.xxhash64("__rsalt", *keys.values())).repartition(tasks, "__rhash")
            # the hash alone is the key that Spark deals by; what it stands for is compared as a range of one value
            cond = (F.col("__hash") == F.col("__rhash")) & same(F.col("__salt"), F.col("__rsalt"))
            equal = same
        right = right.hint("merge")
    for k, rk in keys.items():
        cond = cond & equal(F.col(k), F.col(rk))
    if where is not None:
        cond = cond & where
    return left.join(right, cond, how).drop("__salt", "__rsalt", "__hash", "__rhash", *keys.values())


def group_sizes(df: DataFrame, keys: Sequence[str]) -> tuple[int, int]:
    """``(groups, rows)`` in one pass over the key columns."""
    sizes = df.groupBy(*keys).agg(F.count("*").alias("__n"))
    row = sizes.agg(F.count("*"), F.sum("__n")).first()
    return row[0], row[1] or 0


def shared_folder(spark: SparkSession) -> str:
    """A fresh folder below the checkpoint folder, which all executors share."""
    ensure_checkpoint_dir(spark)
    return f"{spark.sparkContext.getCheckpointDir()}/{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write the rows to the shared checkpoint folder and read them back.

    Unlike an RDD checkpoint this takes one job, keeps the columns prunable, and gives the
    planner the true size.
    """
    path = shared_folder(df.sparkSession)
    df.write.parquet(path)
    table = df.sparkSession.read.schema(df.schema).parquet(path)
    _FOLDERS[table] = path
    return table


def delete_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder below the checkpoint folder, through the file system that holds it."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def discard(*tables: DataFrame) -> None:
    """Delete tables of ``cut_lineage`` that no unfinished plan reads any more: what followed from them is written."""
    for table in tables:
        path = _FOLDERS.pop(table, None)
        if path is not None:
            delete_folder(table.sparkSession, path)


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """``spark.checkpoint.dir`` is used as given.  Only a local session without it gets a
    temporary folder; anywhere else a missing folder is an error, because files in a
    machine-local folder die with the machine.
    """
    sc = spark.sparkContext
    if sc.getCheckpointDir() is not None:
        return
    configured = sc.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
    elif sc.master.startswith("local"):
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="spark-", dir="/tmp"))
    else:
        raise RuntimeError("set spark.checkpoint.dir to a shared folder")
