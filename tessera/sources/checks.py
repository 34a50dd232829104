"""Checks on the input files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def expected_names(files: list[str], class_dir: str, classes: int, spark: SparkSession) -> DataFrame:
    """Required file names and one folder per class."""
    folders = spark.range(classes).select(F.concat(F.lit(f"{class_dir}/"), F.col("id").cast("string")).alias("name"))
    if not files:
        return folders
    return folders.unionByName(spark.createDataFrame([(f,) for f in files], "name string"))


def missing(found: DataFrame, expected: DataFrame) -> DataFrame:
    """Expected names that were not found; empty when the input is complete."""
    return expected.join(found.select("name").distinct(), "name", "left_anti")


def names_of(listing: DataFrame, class_dir: str) -> DataFrame:
    """File names and class folders that occur in a listing of relative paths."""
    folder = F.regexp_extract("path", f"^({class_dir}/[0-9]+)/", 1)
    return listing.select(
        F.when(folder != "", folder).otherwise(F.col("path")).alias("name")
    ).distinct()


def count_items(listing: DataFrame, path: str = "path", pattern: str = r"-([0-9]*)\.") -> DataFrame:
    """Sum of the row counts written into file names; a name without digits adds nothing."""
    digits = F.nullif(F.regexp_extract(path, pattern, 1), F.lit(""))
    return listing.agg(F.sum(digits.try_cast("bigint")).alias("items"))
