"""The two big jobs: files to image table, image table to feature table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.operators import images as ops
from tessera.sources import readers


def with_sizes(df: DataFrame, image: str, prefix: str) -> DataFrame:
    return df.select("*", *ops.image_size(image, prefix))


def image_table(
    spark: SparkSession, index_path: str, root: str, folder: str = "Train", size: int = 64, wide: bool = False
) -> DataFrame:
    """Index joined with its image files, cropped to the region of interest and rescaled.

    folder is the part of root that is read; the steps are chained column functions.
    """
    listed = readers.list_files(spark, root, folder=folder)
    joined = readers.with_images(readers.read_index(spark, index_path), readers.read_images(spark, root, folder), listed)
    region = [F.col(f"roi_{c}") for c in ("x1", "y1", "x2", "y2")]
    cropped = with_sizes(joined.withColumn("cropped_image", ops.crop("image", *region)), "cropped_image", "cropped_")
    scaled = with_sizes(
        cropped.withColumn("scaled_image", ops.rescale(size)("cropped_image")), "scaled_image", "scaled_"
    )
    if wide:
        scaled = scaled.withColumn("network_image", ops.rescale_wide()("cropped_image"))
        scaled = with_sizes(scaled, "network_image", "network_")
    return scaled


def meta_table(spark: SparkSession, meta_path: str, root: str, folder: str = "Meta", size: int = 64) -> DataFrame:
    """Class table with its template images, as read and rescaled."""
    meta = readers.read_meta(spark, meta_path)
    listed = readers.list_files(spark, root, folder=folder)
    joined = readers.with_images(meta, readers.read_images(spark, root, folder), listed).withColumnRenamed("image", "meta_image")
    named = with_sizes(joined, "meta_image", "meta_")
    scaled = named.withColumn("scaled_meta_image", ops.rescale(size)("meta_image"))
    return with_sizes(scaled, "scaled_meta_image", "scaled_meta_")


def feature_table(base: DataFrame, templates: DataFrame) -> DataFrame:
    """Colour histograms, binary patterns, oriented gradients and template match of every image.

    base has image_id, class_id, width, height, resolution, image; templates has
    class_id and image. Images stay in their own table: the result keeps only features.
    """
    base_columns = ["image_id", "class_id", "width", "height", "resolution"]
    return ops.all_features(base, templates).select(*base_columns, "features.*")
