"""Session helpers: settings, reliable checkpoints and size-checked broadcasts."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# A side with more rows or bytes than this is joined by shuffle instead of being broadcast.
BROADCAST_ROWS = 200_000
BROADCAST_BYTES = 256 * 1024 * 1024


def build_session(cores: int | str = "*", app: str = "tessera", **extra: str) -> SparkSession:
    """Local session for tests and the benchmark; a cluster brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.driver.memory", os.environ.get("TESSERA_DRIVER_MEMORY", "8g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for key, value in extra.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder the cluster names; a private one only on a local master."""
    context = spark.sparkContext
    if context.getCheckpointDir():
        return context.getCheckpointDir()
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        named = tempfile.mkdtemp(prefix="tessera-checkpoint-")
    context.setCheckpointDir(named)
    return named


def settle(df: DataFrame) -> DataFrame:
    """Write the rows to the checkpoint folder and cut the lineage.

    Used for small derived tables (cut keys, rank states, templates) that later
    steps read more than once; survives the loss of executors.
    """
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def _width(value: Column, kind: T.DataType) -> Column:
    """Bytes a value takes up, roughly."""
    if isinstance(kind, (T.StringType, T.BinaryType)):
        return F.coalesce(F.octet_length(value), F.lit(0)).cast("bigint")
    if isinstance(kind, T.StructType):
        return sum((_width(value[f.name], f.dataType) for f in kind.fields), F.lit(8).cast("bigint"))
    if isinstance(kind, T.MapType) or (isinstance(kind, T.ArrayType) and not isinstance(kind.elementType, T.NumericType)):
        return F.coalesce(F.octet_length(F.to_json(value)), F.lit(0)).cast("bigint")
    if isinstance(kind, T.ArrayType):
        return F.greatest(F.size(value), F.lit(0)).cast("bigint") * 8
    return F.lit(8).cast("bigint")


def sized(df: DataFrame, rows: int = BROADCAST_ROWS, size: int = BROADCAST_BYTES) -> DataFrame:
    """Broadcast hint when the frame is small in rows and bytes, the frame itself otherwise."""
    if df.select(F.lit(1)).offset(rows).limit(1).collect():  # reads only as far as needed
        return df
    fixed = (T.NumericType, T.BooleanType, T.DateType, T.TimestampType)
    if all(isinstance(f.dataType, fixed) for f in df.schema.fields):
        return F.broadcast(df)  # so many rows of numbers are small
    widths = [_width(F.col(f"`{f.name}`"), f.dataType) for f in df.schema.fields]
    taken = df.agg(F.sum(sum(widths[1:], widths[0]))).first()[0]
    return F.broadcast(df) if (taken or 0) <= size else df
