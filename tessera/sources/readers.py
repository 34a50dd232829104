"""Readers: index and class tables, images, listings, matrices."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera import schema
from tessera.session import sized


def absolute_path(path: Column, root: str) -> Column:
    """Tables keep paths relative; the root is put in front only where a file is opened."""
    return F.concat(F.lit(root.rstrip("/") + "/"), path)


def image_id(path: Column) -> Column:
    """Key of an image: hash of its relative path."""
    return F.md5(path)


def read_index(spark: SparkSession, path: str) -> DataFrame:
    """Image index; the header must match. Adds image_id and resolution."""
    on_disk = T.StructType(
        [T.StructField(old, schema.RAW_INDEX[new].dataType) for old, new in schema.INDEX_COLUMNS.items()]
    )
    raw = spark.read.schema(on_disk).option("header", True).option("enforceSchema", False).csv(path)
    renamed = raw.select(*[F.col(f"`{old}`").alias(new) for old, new in schema.INDEX_COLUMNS.items()])
    return renamed.select(
        image_id(F.col("path")).alias("image_id"), "*", (F.col("width") * F.col("height")).alias("resolution")
    )


def read_meta(spark: SparkSession, path: str) -> DataFrame:
    """Class table; the text None stands for no sign number."""
    return spark.read.schema(schema.META).option("header", True).option("nullValue", "None").csv(path)


def read_lookup(spark: SparkSession, path: str) -> DataFrame:
    """Number and text; further columns of the file are empty and left out."""
    filler = [T.StructField(f"empty_{i}", T.StringType()) for i in range(3)]
    wide = T.StructType([*schema.LOOKUP.fields, *filler])
    return spark.read.schema(wide).option("header", True).csv(path).select("id", "description")


_SCHEME = r"^([A-Za-z][A-Za-z0-9+.-]*):/+"


def _qualified(spark: SparkSession, root: str) -> str:
    """The folder as its file system names it, not escaped."""
    path = spark._jvm.org.apache.hadoop.fs.Path(root)
    full = path.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(path).toString()
    return re.sub(_SCHEME, r"\1:/", full).rstrip("/") + "/"


def unescaped(uri: Column) -> Column:
    """A file URI with its escapes undone; a plus sign is no escape."""
    return F.url_decode(F.replace(uri, F.lit("+"), F.lit("%2B")))


def relative_path(spark: SparkSession, path: Column, root: str) -> Column:
    """Part of a path (not escaped) after the root folder, which it must begin with."""
    front = _qualified(spark, root)
    plain = F.regexp_replace(path, _SCHEME, "$1:/")
    inside = F.substring(plain, len(front) + 1, 2**31 - 1)
    return F.when(plain.startswith(front), inside).otherwise(F.raise_error(F.concat(path, F.lit(f" is not below {root}"))).cast("string"))


def list_files(spark: SparkSession, root: str, glob: str = "*", folder: str = "") -> DataFrame:
    """Paths below root/folder, relative to root; file contents are not read."""
    listing = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", glob)
        .option("recursiveFileLookup", True)
        .load(f"{root.rstrip('/')}/{folder}")
        .select("path")
    )
    return listing.select(relative_path(spark, F.col("path"), root).alias("path"))  # this listing does not escape


def read_images(spark: SparkSession, root: str, folder: str = "", glob: str = "*") -> DataFrame:
    """Decoded images below root/folder as image_id, path, image; paths are relative to root.

    A file that does not decode has a null image.
    """
    from tessera.operators.images import to_rgb

    loaded = (
        spark.read.format("image")
        .option("dropInvalid", False)
        .option("pathGlobFilter", glob)
        .option("recursiveFileLookup", True)
        .load(f"{root.rstrip('/')}/{folder}")
    )
    path = relative_path(spark, unescaped(F.col("image.origin")), root)
    pixels = F.struct(
        F.col("image.height"),
        F.col("image.width"),
        F.col("image.nChannels").alias("channels"),
        F.lit("bgr").alias("dtype"),
        F.col("image.data"),
    )
    image = to_rgb(F.when(F.col("image.height") > 0, pixels))  # Python sees every row, so the rest is null before
    return loaded.select(image_id(path).alias("image_id"), path.alias("path"), image.alias("image"))


def rejects(index: DataFrame, images: DataFrame) -> DataFrame:
    """Index rows without a usable image, with the reason: absent or broken."""
    seen = images.select("path", F.col("image").isNull().alias("broken"))
    reason = F.when(F.col("broken").isNull(), "absent").when(F.col("broken"), "broken")
    return index.join(seen, "path", "left").withColumn("reason", reason).where("reason IS NOT NULL").drop("broken")


def with_images(index: DataFrame, images: DataFrame, listed: DataFrame | None = None) -> DataFrame:
    """Index rows with their image, joined on the relative path.

    A small index is broadcast, so the image bytes stay where they were read; otherwise
    both sides meet by path, which is unique. A broken image is an error when it is met. With the
    listing of the files, index rows without a file are an error at once; `rejects` reports both instead.
    """
    if listed is not None:
        absent = index.select("path").join(listed.select("path"), "path", "left_anti").limit(5).collect()
        if absent:
            raise FileNotFoundError(f"no image for {[r['path'] for r in absent]}")
    broken = F.raise_error(F.concat(F.col("path"), F.lit(" is not an image that can be read"))).cast(images.schema["image"].dataType)
    sound = images.select("path", F.when(F.col("image").isNotNull(), F.col("image")).otherwise(broken).alias("image"))
    return sound.join(sized(index), "path")


def labelled_images(index: DataFrame, images: DataFrame, side: int, labelled: bool = True, listed: DataFrame | None = None) -> DataFrame:
    """(image, class_id) or (image, image_id) pairs; an image that is not side x side is an error.

    So is an index row without a file. These are looked for in `listed`, the listing of the files, which needs
    no pixels, and without it in the paths of the images.
    """
    joined = with_images(index, images, images if listed is None else listed)
    fits = (F.col("image.height") == side) & (F.col("image.width") == side)
    wrong = F.raise_error(F.concat(F.col("path"), F.lit(f" is not {side} x {side}"))).cast("boolean")
    return joined.where(F.when(fits, True).otherwise(wrong)).select("image", "class_id" if labelled else "image_id")


def read_matrix(spark: SparkSession, path: str) -> DataFrame:
    """Comma-separated numbers, one vector per line."""
    cells = F.split(F.col("value"), ",")
    return spark.read.text(path).select(
        F.transform(cells, lambda x: F.trim(x).cast("double")).alias("vector")
    )


def read_table(spark: SparkSession, path: str, names: list[str] | None = None) -> DataFrame:
    df = spark.read.parquet(path)
    return df.select(*names) if names else df


def read_run_log(spark: SparkSession, path: str) -> DataFrame:
    """Training run log: bracketed lists, percentages and padded seconds.

    A sheet repeats its runs in other orders further down: of each file the first block of runs is
    read, up to the first line that is none. Runs that are equal are all kept.
    """
    raw_schema = T.StructType([T.StructField(n, T.StringType()) for n in schema.RUN_LOG.names])
    raw = spark.read.schema(raw_schema).option("header", True).option("mode", "PERMISSIVE").csv(path)
    run = F.coalesce(F.trim("epochs").rlike("^[0-9]+$") & F.trim("kernel_size").startswith("["), F.lit(False))
    lines = raw.select("*", F.input_file_name().alias("file"), F.monotonically_increasing_id().alias("line"), run.alias("run"))
    starts = lines.where("run").groupBy("file").agg(F.min("line").alias("first"))
    ends = lines.where("NOT run").join(starts, "file").where("line > first").groupBy("file").agg(F.min("line").alias("end"))
    kept = lines.where("run").join(ends, "file", "left").where("end IS NULL OR line < end")
    numbers = lambda c: F.transform(F.split(F.regexp_replace(c, r"[\[\] ]", ""), ","), lambda x: x.cast("int"))
    share = lambda c: F.round(F.regexp_replace(c, "[% ]", "").cast("double") / 100, 6)
    runs = kept.select(
        F.trim("model").alias("model"),
        F.trim("epochs").cast("int").alias("epochs"),
        *[numbers(c).alias(c) for c in ("filter_size", "kernel_size", "dense_layer")],
        F.trim("dropout").cast("double").alias("dropout"),
        *[share(c).alias(c) for c in ("train_accuracy", "val_accuracy", "test_accuracy")],
        F.trim("train_time").cast("double").alias("train_time"),
    )
    return runs
