"""Resumable processing of files that keep arriving.

A file stream with a checkpoint takes the files it has not seen, processes them with a batch function and remembers them once they
are written. Run with `available_now`, it is a batch job that resumes. A batch is written under its number and replaces what an earlier
attempt of it left, so a batch that is repeated adds nothing, and a later file is never skipped, whatever its keys.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming.query import StreamingQuery
from pyspark.sql.types import StructType


def resumable_ingest(
    spark: SparkSession, source: str, schema: StructType | str, target: str, checkpoint: str,
    process: Callable[[DataFrame], DataFrame], fmt: str = "parquet",
) -> StreamingQuery:
    """Process new files of `source` into `target`, each once, and stop. The target has a partition column `batch`."""

    def write(batch: DataFrame, number: int) -> None:
        process(batch).write.mode("overwrite").parquet(f"{target}/batch={number}")

    stream = spark.readStream.schema(schema).format(fmt).load(source)
    return (
        stream.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
