"""Row-wise operators on streams.

Masks, filters and name expressions hold no state, so they run unchanged on a streaming
DataFrame; these helpers only bind a file stream to a sink.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType


def read_stream(
    spark: SparkSession, path: str, schema: StructType, fmt: str = "parquet", max_files: int = 1000
) -> DataFrame:
    """Files as they arrive in a folder."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files).format(fmt).load(path)


def run_available(
    stream: DataFrame, transform: Callable[[DataFrame], DataFrame], path: str, checkpoint: str, fmt: str = "parquet"
) -> StreamingQuery:
    """Process everything that has arrived, append it to ``path``, and stop.

    The checkpoint folder makes a restart go on after the last finished batch.
    """
    return (
        stream.transform(transform)
        .writeStream.format(fmt)
        .option("checkpointLocation", checkpoint)
        .option("path", path)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
