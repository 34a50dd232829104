"""Image operators on a stream of arriving files: row maps need no state and no watermark."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession


def transform_arrivals(
    spark: SparkSession, source: str, sink: str, state: str, transform: Callable[[DataFrame], DataFrame]
) -> None:
    """Apply a row map to the parquet files that are new since the last call, then stop."""
    arriving = spark.readStream.schema(spark.read.parquet(source).schema).parquet(source)
    query = (
        transform(arriving)
        .writeStream.format("parquet")
        .option("checkpointLocation", state)
        .trigger(availableNow=True)
        .start(sink)
    )
    query.awaitTermination()
