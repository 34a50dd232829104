"""Writers: parquet and CSV sinks, column refresh, compute-or-load."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def _path(spark: SparkSession, path: str):
    location = spark._jvm.org.apache.hadoop.fs.Path(path)
    return location.getFileSystem(spark._jsc.hadoopConfiguration()), location


def exists(spark: SparkSession, path: str) -> bool:
    fs, location = _path(spark, path)
    return fs.exists(location)


def write_table(
    df: DataFrame, path: str, level: int = 5, force: bool = False, by: list[str] | None = None
) -> None:
    """Parquet with zstd; an existing table is replaced only when forced."""
    writer = (
        df.write.mode("overwrite" if force else "errorifexists")
        .option("compression", "zstd")
        .option("parquet.compression.codec.zstd.level", str(level))
    )
    if by:
        writer = writer.partitionBy(*by)
    writer.parquet(path)


def write_bucketed(df: DataFrame, table: str, buckets: int, key: str = "image_id", force: bool = False) -> None:
    """Catalog table bucketed and sorted by a key.

    Images, features and embeddings written with the same number of buckets are joined
    by that key without a shuffle.
    """
    writer = df.write.mode("overwrite" if force else "errorifexists").option("compression", "zstd")
    writer.bucketBy(buckets, key).sortBy(key).saveAsTable(table)


def refresh_column(
    spark: SparkSession, path: str, name: str, value: Callable[[DataFrame], Column], by: list[str] | None = None
) -> None:
    """Recompute one column of a stored table.

    The new table is written next to the old one and swapped in when it is complete,
    because a table cannot be overwritten while it is read. A swap that was cut short
    is put back first.
    """
    staging, old = f"{path}.staging", f"{path}.old"
    fs, current = _path(spark, path)
    _, fresh = _path(spark, staging)
    _, kept = _path(spark, old)
    if fs.exists(kept):
        if fs.exists(current):
            fs.delete(kept, True)  # the swap was done, only the tidying was missing
        elif not fs.rename(kept, current):
            raise OSError(f"cannot put {old} back")
    rest = spark.read.parquet(path).drop(name)
    write_table(rest.withColumn(name, value(rest)), staging, force=True, by=by)
    if not fs.rename(current, kept):
        raise OSError(f"cannot move {path} aside")
    if not fs.rename(fresh, current):
        fs.rename(kept, current)
        raise OSError(f"cannot move the new table to {path}")
    fs.delete(kept, True)


def _folders(spark: SparkSession, path: str, depth: int) -> list[str]:
    """Partition folders below a table, as they are named on disk."""
    fs, location = _path(spark, path)
    found = [""]
    for _ in range(depth):
        listed = [(front, [s.getPath().getName() for s in fs.listStatus(_path(spark, f"{path}/{front}")[1]) if s.isDirectory()]) for front in found]
        found = [f"{front}/{name}".lstrip("/") for front, names in listed for name in sorted(names) if "=" in name]
    return found


def _moved(spark: SparkSession, source: str, target: str) -> None:
    fs, from_ = _path(spark, source)
    _, to = _path(spark, target)
    fs.mkdirs(to.getParent())
    if not fs.rename(from_, to):
        raise OSError(f"cannot move {source} to {target}")


def refresh_partitions(
    spark: SparkSession, path: str, name: str, value: Callable[[DataFrame], Column], by: list[str], run: str, at_a_time: int = 16, only: Callable[[str], bool] | None = None
) -> list[str]:
    """Recompute one column of a table partitioned by `by`, some partitions at a time; returns the folders written by this call.

    What is done is kept in `path`.refresh-`run`: new partitions are written there, each is swapped in
    when its job has ended, and its name is put on the list of finished ones. A call that was cut short is
    taken up by the next one with the same `run` and column, which computes only what is not on the list.
    Every partition is whole at any time, old or new. `only` chooses folders (such as "day=3"); all others
    stay untouched. The folder of the run goes when all chosen partitions are done.
    """
    work = f"{path}.refresh-{run}"
    there = {folder for top in (path, f"{work}/old") if exists(spark, top) for folder in _folders(spark, top, len(by))}
    chosen = sorted(folder for folder in there if only is None or only(folder))
    fs, root = _path(spark, work)

    def finish(folder: str) -> None:
        if exists(spark, f"{work}/old/{folder}") and not exists(spark, f"{path}/{folder}"):
            _moved(spark, f"{work}/old/{folder}", f"{path}/{folder}")  # a swap cut short is begun again
        if exists(spark, f"{work}/new/{folder}"):
            _moved(spark, f"{path}/{folder}", f"{work}/old/{folder}")
            _moved(spark, f"{work}/new/{folder}", f"{path}/{folder}")
        _, mark = _path(spark, f"{work}/done/{folder.replace('/', '|')}")
        fs.mkdirs(mark.getParent())
        fs.create(mark, True).close()
        fs.delete(_path(spark, f"{work}/old/{folder}")[1], True)

    def done(folder: str) -> bool:
        return exists(spark, f"{work}/done/{folder.replace('/', '|')}")

    open_ = []
    for folder in chosen:
        if done(folder):
            continue
        swapped = exists(spark, f"{work}/old/{folder}") and exists(spark, f"{path}/{folder}") and not exists(spark, f"{work}/new/{folder}")
        written = exists(spark, f"{work}/new/{folder}") and exists(spark, f"{work}/new/_jobs/{folder.replace('/', '|')}")
        if swapped or written:
            finish(folder)
        else:
            open_.append(folder)
    for a in range(0, len(open_), at_a_time):
        part = open_[a : a + at_a_time]
        for folder in part:
            fs.delete(_path(spark, f"{work}/new/{folder}")[1], True)
            if exists(spark, f"{work}/old/{folder}") and not exists(spark, f"{path}/{folder}"):
                _moved(spark, f"{work}/old/{folder}", f"{path}/{folder}")
        rest = spark.read.option("basePath", path).parquet(*[f"{path}/{folder}" for folder in part]).drop(name)
        fresh = rest.withColumn(name, value(rest))
        fresh.write.mode("append").option("compression", "zstd").partitionBy(*by).parquet(f"{work}/new")
        for folder in part:  # the job has ended: what it wrote is whole
            _, mark = _path(spark, f"{work}/new/_jobs/{folder.replace('/', '|')}")
            fs.mkdirs(mark.getParent())
            fs.create(mark, True).close()
        for folder in part:
            finish(folder)
    if all(done(folder) for folder in chosen):
        fs.delete(root, True)
    return open_


def write_csv(df: DataFrame, path: str, vectors: dict[str, int] | None = None, force: bool = False) -> None:
    """CSV with header; a vector of known width takes one column per component."""
    vectors = vectors or {}
    columns: list[Column] = []
    for name in df.columns:
        if name in vectors:
            columns += [F.get(name, F.lit(i)).alias(f"{name}_{i}") for i in range(vectors[name])]
        else:
            columns.append(F.col(name))
    df.select(*columns).write.mode("overwrite" if force else "errorifexists").option("header", True).csv(path)


def write_matrix(df: DataFrame, vector: str, path: str, force: bool = False) -> None:
    """One comma-separated line per vector, no header."""
    line = F.array_join(F.transform(vector, lambda x: x.cast("string")), ",")
    df.select(line.alias("value")).write.mode("overwrite" if force else "errorifexists").text(path)


def load_or_compute(spark: SparkSession, path: str, compute: Callable[[], DataFrame]) -> DataFrame:
    """The stored table, computed and stored first when it is not there or was not written to the end."""
    if not exists(spark, f"{path}/_SUCCESS"):
        write_table(compute(), path, force=True)
    return spark.read.parquet(path)


def load_or_fit(spark: SparkSession, path: str, fit: Callable, load: Callable):
    """The stored model, fitted and stored first when it is not there.

    It is saved beside its place and moved there when complete.
    """
    if not exists(spark, path):
        fit().write().overwrite().save(f"{path}.staging")
        fs, fresh = _path(spark, f"{path}.staging")
        if not fs.rename(fresh, _path(spark, path)[1]):
            raise OSError(f"cannot move the new model to {path}")
    return load(path)
