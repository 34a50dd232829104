"""Joins to the small class tables and between image tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.session import sized


def join_meta(df: DataFrame, meta: DataFrame) -> DataFrame:
    """Class table joined on class_id; its path is renamed so that the image keeps its own."""
    clash = {c: f"meta_{c}" for c in meta.columns if c in df.columns and c != "class_id"}
    return df.join(sized(meta.withColumnsRenamed(clash)), "class_id")


def join_lookups(meta: DataFrame, shapes: DataFrame, colors: DataFrame) -> DataFrame:
    """Texts for the shape and colour numbers."""
    shapes = shapes.select(F.col("id").alias("shape_id"), F.col("description").alias("shape"))
    colors = colors.select(F.col("id").alias("color_id"), F.col("description").alias("color"))
    return meta.join(sized(shapes), "shape_id").join(sized(colors), "color_id")


def attach(df: DataFrame, side: DataFrame, identity: str = "image_id") -> DataFrame:
    """Columns of a side table (such as embeddings), joined on the image id.

    Ids are unique on both sides, so rows spread evenly; with both tables bucketed by
    the id the join needs no shuffle.
    """
    return df.join(side, identity)


def best_template(scores: Column) -> Column:
    """Class of the highest score; the lower class wins a tie."""
    best = F.array_max(F.transform(scores, lambda s: F.struct(s["score"], -s["class_id"])))
    return (-best["col2"]).cast("int")
