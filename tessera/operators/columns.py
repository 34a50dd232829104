"""Computed columns, feature assembly and the feature-base schema."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.schema import FEATURE_ORDER


def resolution(width: str = "width", height: str = "height") -> Column:
    return F.col(width) * F.col(height)


def total_time(train: str = "train_time", predict: str = "predict_time") -> Column:
    return F.col(train) + F.col(predict)


def unnest(df: DataFrame, struct: str) -> DataFrame:
    """Replace a struct column by its fields."""
    return df.select("*", f"{struct}.*").drop(struct)


def feature_base(df: DataFrame, target: str = "scaled_image") -> DataFrame:
    """Make the chosen image the one features are computed from."""
    if target != "scaled_image":
        raise ValueError(f"unknown target image {target!r}")
    return df.select(
        "image_id",
        "class_id",
        F.col("scaled_width").alias("width"),
        F.col("scaled_height").alias("height"),
        F.col("scaled_resolution").alias("resolution"),
        F.col("scaled_image").alias("image"),
    )


def assemble(chosen: list[str], columns: dict[str, str] | None = None) -> Column:
    """Chosen feature arrays laid side by side, always in the same family order."""
    unknown = set(chosen) - set(FEATURE_ORDER)
    if unknown:
        raise ValueError(f"unknown features {sorted(unknown)}")
    names = [name for name in FEATURE_ORDER if name in chosen]
    columns = columns or {}
    parts = [F.col(columns.get(name, name)).cast("array<double>") for name in names]
    return F.concat(*parts)


def feature_matrix(df: DataFrame, names: list[str], identity: str = "image_id") -> DataFrame:
    """Feature columns by name; two-dimensional ones are flattened."""
    nested = {f.name for f in df.schema if f.dataType.simpleString().startswith("array<array")}
    return df.select(
        identity, *[F.flatten(n).alias(n) if n in nested else F.col(n) for n in names]
    )


def chunk_of(identity: Column, size: int) -> Column:
    return F.floor(identity / size).cast("bigint")


def union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), frames)
