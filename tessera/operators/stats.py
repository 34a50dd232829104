"""Counts, sizes, histograms and class profiles."""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.operators.cuts import medians


def class_counts(df: DataFrame, classes: int, by: str = "class_id") -> DataFrame:
    """Rows per class and the share of the largest class: 0 .. classes - 1, with 0 for empty ones, and all others that occur."""
    counted = df.groupBy(by).agg(F.count("*").alias("n"))
    every = df.sparkSession.range(classes).select(F.col("id").cast("int").alias(by))
    filled = every.join(counted, by, "full").select(by, F.coalesce("n", F.lit(0)).alias("n"))
    return filled.withColumn("ratio", F.col("n") / F.nullif(F.max("n").over(Window.partitionBy()), F.lit(0)))


def split_distribution(df: DataFrame, splits: list[str], by: str = "class_id") -> DataFrame:
    """Rows per class, one column per split."""
    wide = df.groupBy(by).pivot("split", splits).agg(F.count(F.lit(1)))
    return wide.fillna(0, subset=splits)


def extremes(df: DataFrame, names: list[str]) -> DataFrame:
    return df.agg(
        *[f(name).alias(f"{label}_{name}") for name in names for label, f in (("min", F.min), ("max", F.max))]
    )


def mean_median(df: DataFrame, names: list[str]) -> DataFrame:
    """Mean and exact median of several columns, one line each."""
    long = df.select(*[F.col(n).cast("double") for n in names]).unpivot([], names, "name", "value")
    long = long.where(F.col("value").isNotNull())
    means = long.groupBy("name").agg(F.avg("value").alias("mean"))
    return means.join(medians(long, "value", ["name"]), "name")


#: Values that distinct_classes lists at most.
MOST_CLASSES = 1_000_000


def distinct_classes(df: DataFrame, by: str = "class_id") -> DataFrame:
    """One row: the distinct values, without null, and their number; an error where there are more than MOST_CLASSES."""
    found = df.select(by).where(F.col(by).isNotNull()).distinct().limit(MOST_CLASSES + 1)
    many = F.raise_error(F.lit(f"more than {MOST_CLASSES} distinct values of {by}")).cast("bigint")
    count = F.count("*")
    return found.agg(F.sort_array(F.collect_list(by)).alias("classes"), F.when(count > MOST_CLASSES, many).otherwise(count).alias("n_classes"))


def value_histogram(df: DataFrame, plane: str, by: list[str]) -> DataFrame:
    """Pixels per grey level; merged before the shuffle, so at most groups x levels rows move per task."""
    return (
        df.select(*by, F.explode(plane).alias("bin"))
        .groupBy(*by, "bin")
        .agg(F.count("*").alias("n"))
    )


def equal_width_histogram(df: DataFrame, channels: dict[str, Column], bins: int = 256) -> DataFrame:
    """Histogram over each channel's own smallest..largest value; the last bin is closed."""
    ends = [
        f(g(c)).alias(f"{name}_{label}")
        for name, c in channels.items()
        for label, f, g in (("lo", F.min, F.array_min), ("hi", F.max, F.array_max))
    ]
    limits = df.agg(F.struct(*ends).alias("limits")).scalar()

    def binned(name: str, values: Column, ends: Column) -> Column:
        lo, hi = ends[f"{name}_lo"].cast("double"), ends[f"{name}_hi"].cast("double")
        place = lambda x: F.when(hi == lo, F.lit(0)).otherwise(
            F.least(F.lit(bins - 1), F.floor((x.cast("double") - lo) / F.nullif(hi - lo, F.lit(0.0)) * bins))
        )
        return F.transform(
            values, lambda x: F.struct(F.lit(name).alias("channel"), place(x).cast("int").alias("bin"))
        )

    with_ends = df.withColumn("limits", limits)
    per_channel = F.concat(*[binned(n, c, F.col("limits")) for n, c in channels.items()])
    return (
        with_ends.select(F.explode(per_channel).alias("cell"))
        .groupBy("cell.channel", "cell.bin")
        .agg(F.count("*").alias("n"))
    )


def intensity_cdf(df: DataFrame, plane: str, by: list[str]) -> DataFrame:
    """Cumulative share of pixels at or below each grey level."""
    hist = value_histogram(df, plane, by)
    grouped = Window.partitionBy(*by)
    running = grouped.orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)
    return hist.withColumn("cdf", F.sum("n").over(running) / F.sum("n").over(grouped))


def mean_of(plane: Column) -> Column:
    return F.aggregate(plane, F.lit(0.0), lambda acc, x: acc + x.cast("double")) / F.size(plane)


def mean_colour(df: DataFrame, channels: dict[str, Column], identity: str) -> DataFrame:
    """Mean of each channel per image."""
    return df.select(identity, *[mean_of(c).alias(f"mean_{n}") for n, c in channels.items()])


def mean_colour_by_class(df: DataFrame, channels: dict[str, Column], by: str = "class_id") -> DataFrame:
    """Mean of each channel over all pixels of a class."""
    sums = [
        F.aggregate(c, F.lit(0.0), lambda acc, x: acc + x.cast("double")).alias(f"sum_{n}")
        for n, c in channels.items()
    ]
    sizes = [F.size(c).alias(f"size_{n}") for n, c in channels.items()]
    return (
        df.select(by, *sums, *sizes)
        .groupBy(by)
        .agg(*[(F.sum(f"sum_{n}") / F.sum(f"size_{n}")).alias(f"mean_{n}") for n in channels])
    )


def matrix_extremes(df: DataFrame, vector: str) -> DataFrame:
    return df.agg(
        F.min(F.array_min(vector)).alias("smallest"), F.max(F.array_max(vector)).alias("largest")
    )


def feature_widths(df: DataFrame, names: list[str]) -> DataFrame:
    """Length of each feature column, one line per feature."""
    wide = df.agg(*[F.max(F.size(n)).alias(n) for n in names])
    return wide.unpivot([], names, "feature", "width")


def vector_moments(df: DataFrame, vector: str) -> DataFrame:
    """One row: moments, an array with the mean and the spread (dividing by n) of every position.

    One pass of MLlib's summarizer over whole vectors; nothing is exploded. The spread of
    a constant position is null.
    """
    dense = df.select(array_to_vector(F.col(vector).cast("array<double>")).alias("v"))
    summary = dense.agg(Summarizer.metrics("mean", "variance", "count").summary(F.col("v")).alias("s"))
    shrink = (F.col("s.count") - 1) / F.col("s.count")
    pair = lambda m, v: F.struct(m.alias("mean"), F.nullif(F.sqrt(v * shrink), F.lit(0.0)).alias("spread"))
    return summary.select(
        F.zip_with(vector_to_array("s.mean"), vector_to_array("s.variance"), pair).alias("moments")
    )


def scale_by(df: DataFrame, vector: str, moments: DataFrame, out: str = "standardised") -> DataFrame:
    """Subtract the mean and divide by the spread; a constant position becomes 0."""
    scaled = lambda x, m: F.coalesce((x - m["mean"]) / m["spread"], F.lit(0.0))
    with_moments = df.withColumn("moments", moments.scalar())
    return with_moments.withColumn(
        out, F.zip_with(F.col(vector).cast("array<double>"), F.col("moments"), scaled)
    ).drop("moments")


def standardise(df: DataFrame, vector: str, out: str = "standardised") -> DataFrame:
    """Columns to mean 0 and spread 1."""
    return scale_by(df, vector, vector_moments(df, vector), out)
