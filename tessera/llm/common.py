"""Helpers the operators share: tables, written intermediate results, words."""

from __future__ import annotations

import ctypes
import gc
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.session import checkpoint_dir, sized

#: Words of all operators: runs of anything but ASCII white space.
GAP = r"[\x20\x09-\x0D]+"
#: Bytes of text that a Python task holds as arrays at a time.
CHUNK_BYTES = 2 * 1024 * 1024


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def pick(df: DataFrame, *names: str) -> DataFrame:
    """The named columns by exact spelling; all others are left behind, whatever they are called."""
    wide = df.toDF(*[f"c{i}" for i in range(len(df.columns))])
    return wide.select(*[F.col(f"c{df.columns.index(name)}").alias(name) for name in names])


def keep(df: DataFrame, label: str) -> DataFrame:
    """Write the rows as Parquet below spark.checkpoint.dir and read them back.

    Cuts the lineage and survives lost executors; the folder is new for each call.
    """
    spark = df.sparkSession
    checkpoint_dir(spark)
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    path = f"{root.rstrip('/')}/tessera-{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def least_hashes(df: DataFrame, k: int, by: tuple[str, ...] = ()) -> DataFrame:
    """At most k rows of each group, those of the least h (a 64-bit hash column), one for each hash.

    The number of hashes tells below which bound some 3 k of them lie, so that no task gets more than
    these, however many rows, partitions or copies there are.
    """
    n = df.groupBy(*by).agg(F.approx_count_distinct("h").alias("n"))
    if by:
        df = df.join(sized(n), list(by))
    else:
        df = df.withColumn("n", F.lit(n.first()[0]))
    below = F.col("h").cast("double") <= F.least(F.lit(1.0), F.lit(3.0 * k) / F.greatest("n", F.lit(1))) * 2.0**64 - 2.0**63
    near = df.where(below).drop("n").dropDuplicates([*by, "h"])
    place = F.row_number().over(Window.partitionBy(*by).orderBy("h"))
    return near.withColumn("place", place).where(F.col("place") <= k).drop("place")


def words(text: Column) -> Column:
    """The words of a text in order; none for null."""
    return F.coalesce(F.array_remove(F.split(text, GAP), ""), F.array().cast("array<string>"))


def n_words(text: Column) -> Column:
    return F.size(words(text)).cast("bigint")


def chunks(batch: pa.RecordBatch, column: str = "text", limit: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Cuts a batch into slices with about so many bytes of text, one row at least, so that Python holds few texts at a time."""
    start = held = 0
    for i, size in enumerate(pc.binary_length(batch.column(column)).to_pylist()):
        size = size or 0
        if held and held + size > limit:
            yield batch.slice(start, i - start)
            start, held = i, 0
        held += size
    if start < batch.num_rows:
        yield batch.slice(start)


_HELD: dict[str, object] = {}
_LIBC = ctypes.CDLL(None)


def held(name: str | None, make: Callable[[], object] = lambda: None):
    """What this Python worker keeps between tasks under a name; whatever it kept under others is let go.

    Workers outlive tasks and serve one operator after another; their memory is that of one. What
    has been freed goes back to the system, where that has a call for it.
    """
    if name not in _HELD:
        _HELD.clear()
        gc.collect()
        pa.default_memory_pool().release_unused()
        if hasattr(_LIBC, "malloc_trim"):
            _LIBC.malloc_trim(0)
        _HELD[name] = make()
    return _HELD[name]
