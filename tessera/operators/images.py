"""Image operators on binary images: Arrow batches in, new columns out.

All are row maps: they run on any partitioning (and on a stream) without a shuffle.
One call handles a whole Arrow batch, images of equal size stacked together, so keep
batches short for big images (spark.sql.execution.arrow.maxRecordsPerBatch).
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import arrow_udf

from tessera import schema
from tessera.functions import kernels, planes
from tessera.operators.numbering import numbered
from tessera.session import settle

Kernel = Callable[[np.ndarray], np.ndarray]
#: Bytes that an image takes up inside a kernel.
Room = Callable[[np.ndarray], int]

# Bytes that the images handed to a kernel at once take up there.
STACK_BYTES = 2 * 1024 * 1024
# A template table above this size is not sent whole to every executor.
TEMPLATE_BYTES = 64 * 1024 * 1024

ELEMENTS = {
    "int": (T.IntegerType(), pa.int32()),
    "smallint": (T.ShortType(), pa.int16()),
    "float": (T.FloatType(), pa.float32()),
}


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields])


HSV_TYPE = _struct(*[(f"{n}_hist", T.ArrayType(T.IntegerType())) for n in ("hue", "saturation", "value")])
LBP_TYPE = _struct(("lbp_image", T.ArrayType(T.ShortType())), ("lbp_hist", T.ArrayType(T.IntegerType())))
SCORE_TYPE = T.ArrayType(_struct(("class_id", T.IntegerType()), ("score", T.DoubleType())))


# ---- between Arrow and NumPy -------------------------------------------------------------


def unpack(images: pa.Array) -> list[np.ndarray | None]:
    """Views on the pixel bytes, one (height, width, channels) array per image."""
    sizes = [images.field(n).to_pylist() for n in ("height", "width", "channels", "dtype")]
    out = []
    for valid, h, w, c, kind, data in zip(images.is_valid().to_pylist(), *sizes, images.field("data")):
        if not valid or not data.is_valid:
            out.append(None)
            continue
        numbers = np.dtype(np.float32 if kind == "f4" else np.uint8)
        out.append(np.frombuffer(data.as_buffer(), numbers, h * w * c).reshape(h, w, c))
    return out


def pack(images: list[np.ndarray | None]) -> pa.Array:
    """Image structs from arrays of bytes (0..255) or floats (0..1)."""

    def column(value: Callable, kind: pa.DataType) -> pa.Array:
        return pa.array([None if i is None else value(i) for i in images], kind)

    fields = [
        column(lambda i: i.shape[0], pa.int32()),
        column(lambda i: i.shape[1], pa.int32()),
        column(lambda i: i.shape[2], pa.int32()),
        column(lambda i: "f4" if i.dtype == np.float32 else "u1", pa.string()),
        column(lambda i: np.ascontiguousarray(i).tobytes(), pa.binary()),
    ]
    empty = pa.array([i is None for i in images])
    return pa.StructArray.from_arrays(fields, schema.IMAGE.names, mask=empty)


def vectors(rows: list[np.ndarray | None], kind: pa.DataType) -> pa.Array:
    """One list a row; the numbers are copied once, into one buffer."""
    flat = [r.ravel() for r in rows if r is not None]
    numbers = pa.array(np.concatenate(flat)).cast(kind) if flat else pa.array([], kind)
    ends = np.cumsum([0, *[0 if r is None else r.size for r in rows]]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends, mask=np.array([*[r is None for r in rows], False])), numbers)


def as_doubles(image: np.ndarray) -> int:
    """Room of a kernel that makes nothing larger than the image in doubles."""
    return 8 * image.size


def and_more(numbers: int) -> Room:
    """Room of a kernel that makes so many numbers besides, whatever the size of the image."""
    return lambda image: 8 * (image.size + numbers)


def by_shape(images: list[np.ndarray | None], kernel: Kernel, room: Room = as_doubles) -> list:
    """Run the kernel on stacks of images of one size; results in input order.

    Stacks are kept short by what a kernel builds up on the way, which for small images can be
    a thousand times the image.
    """
    places: dict[tuple, list[int]] = {}
    for i, image in enumerate(images):
        if image is not None:
            places.setdefault((image.shape, image.dtype.str), []).append(i)
    out: list = [None] * len(images)
    for where in places.values():
        step = max(1, STACK_BYTES // max(1, room(images[where[0]])))
        for start in range(0, len(where), step):
            part = where[start : start + step]
            for i, result in zip(part, kernel(np.stack([images[i] for i in part]))):
                out[i] = result
    return out


def image_map(kernel: Kernel, room: Room = as_doubles) -> Callable[[Column], Column]:
    """Column function image -> image."""

    @arrow_udf(schema.IMAGE)
    def run(images: pa.Array) -> pa.Array:
        return pack(by_shape(unpack(images), kernel, room))

    return run


def vector_map(kernel: Kernel, element: str, room: Room = as_doubles) -> Callable[[Column], Column]:
    """Column function image -> flat array of the element type."""
    spark_kind, kind = ELEMENTS[element]

    @arrow_udf(T.ArrayType(spark_kind))
    def run(images: pa.Array) -> pa.Array:
        return vectors(by_shape(unpack(images), kernel, room), kind)

    return run


def from_planes(r: Column, g: Column, b: Column, height: int, width: int) -> Column:
    """Image struct from three arrays of 0..255, built inside the JVM."""
    hexed = lambda x: F.lpad(F.hex(x.cast("bigint")), 2, "0")
    zipped = F.arrays_zip(r.alias("r"), g.alias("g"), b.alias("b"))
    text = F.array_join(F.transform(zipped, lambda p: F.concat(hexed(p["r"]), hexed(p["g"]), hexed(p["b"]))), "")
    return F.struct(
        F.lit(height).alias("height"),
        F.lit(width).alias("width"),
        F.lit(3).alias("channels"),
        F.lit("u1").alias("dtype"),
        F.unhex(text).alias("data"),
    )


def image_size(image: str = "image", prefix: str = "") -> list[Column]:
    """Width, height and resolution of an image column."""
    width, height = F.col(f"{image}.width"), F.col(f"{image}.height")
    named = [("width", width), ("height", height), ("resolution", width * height)]
    return [c.alias(f"{prefix}{n}") for n, c in named]


# ---- size ---------------------------------------------------------------------------------


def _rgb(image: np.ndarray) -> np.ndarray:
    """Decoder order (grey, BGR or BGRA) to RGB."""
    return np.repeat(image, 3, axis=-1) if image.shape[-1] == 1 else image[..., 2::-1]


to_rgb = image_map(_rgb)


@arrow_udf(schema.IMAGE)
def crop(images: pa.Array, x1: pa.Array, y1: pa.Array, x2: pa.Array, y2: pa.Array) -> pa.Array:
    """Region of interest, both ends included."""
    edges = zip(*[a.to_pylist() for a in (x1, y1, x2, y2)])
    return pack(
        [None if i is None else i[t : b + 1, l : r + 1] for i, (l, t, r, b) in zip(unpack(images), edges)]
    )


def centre_crop(height: int, width: int) -> Callable[[Column], Column]:
    return image_map(lambda s: kernels.centre_crop(s, height, width))


def _rescaled(size: int) -> Room:
    """Room of an image whose shorter side becomes size."""

    def room(image: np.ndarray) -> int:
        h, w, channels = image.shape
        return 8 * (image.size + size * size * channels * max(h, w) // max(1, min(h, w)))

    return room


def rescale(size: int = 64) -> Callable[[Column], Column]:
    """Shorter side to size, then the central square."""
    return image_map(lambda s: kernels.rescale(s, size), _rescaled(size))


def rescale_wide(size: int = 256, part: int = 224) -> Callable[[Column], Column]:
    """Input size of the usual pretrained networks: rescale, then the centre."""
    return image_map(lambda s: kernels.centre_crop(kernels.rescale(s, size), part, part), _rescaled(size))


def resize(height: int, width: int) -> Callable[[Column], Column]:
    return image_map(lambda s: kernels.resize_bilinear(kernels.to_unit(s), height, width).astype(np.float32), and_more(4 * height * width))


def shrink(percent: int = 30) -> Callable[[Column], Column]:
    """Both sides to a percentage, cut off to whole pixels."""

    def run(stack: np.ndarray) -> np.ndarray:
        h, w = (max(1, n * percent // 100) for n in stack.shape[1:3])
        return kernels.resize_bilinear(kernels.to_unit(stack), h, w).astype(np.float32)

    return image_map(run)


def fit(height: int, width: int) -> Callable[[Column], Column]:
    """Keep the shape and fill up with zeros."""
    return image_map(lambda s: kernels.fit(kernels.to_unit(s), height, width).astype(np.float32), and_more(4 * height * width))


# ---- colour and light ------------------------------------------------------------------------


flip_left_right = image_map(lambda s: s[:, :, ::-1])
transpose = image_map(lambda s: s.transpose(0, 2, 1, 3))


def random_flip(image: str, key: Column, seed: int = 42) -> Column:
    """Flip half of the images, the same ones on every run."""
    return F.when(planes.coin(key, seed), flip_left_right(image)).otherwise(F.col(image))


def brighten(delta: float = 0.3) -> Callable[[Column], Column]:
    return image_map(lambda s: (kernels.to_unit(s) + delta).astype(np.float32))


def contrast(factor: float = 3.0) -> Callable[[Column], Column]:
    """Spread each channel about its mean."""

    def run(stack: np.ndarray) -> np.ndarray:
        unit = kernels.to_unit(stack)
        mean = unit.mean(axis=(1, 2), keepdims=True)
        return ((unit - mean) * factor + mean).astype(np.float32)

    return image_map(run)


def _channel_of(to: Kernel, back: Kernel, channel: int, change: Kernel, room: Room = as_doubles) -> Callable[[Column], Column]:
    """Change one channel of another colour space and come back to RGB."""

    def run(stack: np.ndarray) -> np.ndarray:
        other = to(stack)
        other[..., channel] = change(np.ascontiguousarray(other[..., channel]))
        return back(other)

    return image_map(run, room)


hsv_image = image_map(kernels.to_hsv)
lab_image = image_map(kernels.to_lab)
grey_plane = vector_map(kernels.grey, "smallint")
stretched_plane = vector_map(lambda s: kernels.stretch(kernels.grey(s)), "smallint")
stretch_lightness = _channel_of(kernels.to_lab, kernels.from_lab, 0, lambda p: kernels.stretch(p, 100))
stretch_value = _channel_of(kernels.to_hsv, kernels.from_hsv, 2, kernels.stretch)
equalise_value = _channel_of(kernels.to_hsv, kernels.from_hsv, 2, kernels.equalise, and_more(256))
# a table of 256 levels for each of 8x8 tiles
LEVEL_TABLES = and_more(8 * 8 * 256)
clahe_plane = vector_map(lambda s: kernels.clahe(kernels.grey(s), 3.0), "smallint", LEVEL_TABLES)
clahe_value = _channel_of(kernels.to_hsv, kernels.from_hsv, 2, lambda p: kernels.clahe(p, 3.0), LEVEL_TABLES)
clahe_lightness = _channel_of(kernels.to_lab, kernels.from_lab, 0, lambda p: kernels.clahe(p, 255), LEVEL_TABLES)


def blur(sigma: float = 2.0) -> Callable[[Column], Column]:
    return image_map(lambda s: kernels.blur(kernels.to_unit(s), sigma).astype(np.float32))


# ---- features ----------------------------------------------------------------------------------


HSV_BINS, LBP_BINS = (180, 256, 256), 1024


def _hsv_counts(stack: np.ndarray) -> list[tuple]:
    hsv = kernels.to_hsv(stack)
    return list(zip(*[kernels.histograms(hsv[..., c], bins).astype(np.int32) for c, bins in enumerate(HSV_BINS)]))


@arrow_udf(HSV_TYPE)
def hsv_histograms(images: pa.Array) -> pa.Array:
    """Struct of hue (180), saturation (256) and value (256) counts."""
    counts = by_shape(unpack(images), _hsv_counts, and_more(sum(HSV_BINS)))
    fields = [vectors([None if c is None else c[i] for c in counts], pa.int32()) for i in range(3)]
    return pa.StructArray.from_arrays(fields, ["hue_hist", "saturation_hist", "value_hist"])


def _lbp_codes(stack: np.ndarray, legacy_uint8: bool = False) -> np.ndarray:
    codes = kernels.lbp(kernels.stretch(kernels.grey(stack)), 10, 1)
    return codes % 256 if legacy_uint8 else codes


def lbp(legacy_uint8: bool = False) -> Callable[[Column], Column]:
    """Struct of the code image (10 points, radius 1, stretched grey) and its 1024-bin histogram."""

    def both(stack: np.ndarray) -> list[tuple]:
        codes = _lbp_codes(stack, legacy_uint8)
        return list(zip(codes, kernels.histograms(codes, LBP_BINS).astype(np.int32)))

    @arrow_udf(LBP_TYPE)
    def run(images: pa.Array) -> pa.Array:
        found = by_shape(unpack(images), both, and_more(LBP_BINS))
        fields = [
            vectors([None if f is None else f[i] for f in found], kind)
            for i, kind in enumerate((pa.int16(), pa.int32()))
        ]
        return pa.StructArray.from_arrays(fields, ["lbp_image", "lbp_hist"])

    return run


lbp_uniform = vector_map(
    lambda s: kernels.lbp(kernels.to_lab(s)[..., 0], 8, 1, uniform=True), "smallint"
)


def hog(orientations: int = 9, cell: int = 6, block: int = 2) -> Callable[[Column], Column]:
    """Oriented gradients; 2916 numbers for 64x64 with the defaults."""
    return vector_map(lambda s: kernels.hog(s, orientations, cell, block), "float")


def edges(**settings) -> Callable[[Column], Column]:
    """Edge map of the grey image, 0 / 255 per pixel; settings as in kernels.edge_map."""
    return vector_map(lambda s: kernels.edge_map(kernels.grey(s), **settings), "smallint")


def lightness_edges(sigma: float = 3.0) -> Callable[[Column], Column]:
    """The same on the lightness channel with a wide blur."""
    size = 2 * int(4 * sigma + 0.5) + 1
    return vector_map(lambda s: kernels.edge_map(kernels.to_lab(s)[..., 0], sigma, size), "smallint")


def similarity(template: np.ndarray, threshold: int = -1) -> Callable[[Column], Column]:
    """Similarity map of the grey image with one small grey template."""
    return vector_map(lambda s: kernels.similarity_map(kernels.grey(s), template, threshold), "float")


def plane_similarity(
    height: int, width: int, t_height: int, t_width: int, threshold: int = -1
) -> Callable[[Column, Column], Column]:
    """Similarity map of a plane with the template in the same row; rows with one template go together."""

    @arrow_udf(T.ArrayType(T.DoubleType()))
    def run(planes: pa.Array, templates: pa.Array) -> pa.Array:
        stack = _as_matrix(planes).reshape(-1, height, width)
        known, which = np.unique(_as_matrix(templates), axis=0, return_inverse=True)
        out = np.empty(stack.shape)
        for i, template in enumerate(known):
            mine = which == i
            out[mine] = kernels.similarity_map(stack[mine], template.reshape(t_height, t_width), threshold)
        return pa.array(list(out.reshape(len(out), -1)), pa.list_(pa.float64()))

    return run


SOBEL_TYPE = _struct(("strength", T.ArrayType(T.DoubleType())), ("angle", T.ArrayType(T.DoubleType())))


@arrow_udf(SOBEL_TYPE)
def sobel(images: pa.Array) -> pa.Array:
    """Struct of gradient strength (largest = 255) and angle per pixel of the grey image."""
    found = by_shape(unpack(images), lambda s: list(zip(*kernels.sobel(kernels.grey(s)))))
    fields = [vectors([None if f is None else f[i] for f in found], pa.float64()) for i in range(2)]
    return pa.StructArray.from_arrays(fields, SOBEL_TYPE.names)


# ---- templates -------------------------------------------------------------------------------


def _as_matrix(planes: pa.Array) -> np.ndarray:
    """Equally long list rows as one matrix, without copying."""
    planes = planes.combine_chunks() if isinstance(planes, pa.ChunkedArray) else planes
    return planes.flatten().to_numpy(zero_copy_only=False).reshape(len(planes), -1)


def _banks(stored: DataFrame, max_bytes: int) -> Iterator[tuple[list, np.ndarray]]:
    """Templates (class_id, plane) in the order of class and pixels as stacks of at most max_bytes (one template at least), one at a time."""
    count, width = stored.agg(F.count("*"), F.max(F.size("plane"))).first()
    each = max(1, max_bytes // (8 * max(1, width or 0)))
    cuts = [stored]
    if count > each:
        placed = numbered(stored, ["class_id", "plane"], out="template_place")
        cuts = [placed.where(F.col("template_place").between(a, a + each - 1)) for a in range(0, count, each)]
    for rows in cuts if count else []:
        part = rows.orderBy("class_id", "plane").collect()
        yield [r["class_id"] for r in part], np.array([r["plane"] for r in part])


def _by_bank(df: DataFrame, banks: Iterable, column: Callable, name: str, source: str) -> DataFrame:
    """df with one array column, the parts of every bank end to end; `source` is the column they are made from.

    The images meet one bank after the other. A bank is broadcast for its pass alone; what it gives is
    written under a hash of the image (equal images share a line) and joined at the end, so
    no image is written or moved for a bank, and executors hold one bank at a time.
    """
    context = df.sparkSession.sparkContext
    banks = iter(banks)
    first, second = next(banks, None), next(banks, None)
    if first is None:
        raise ValueError("no templates")
    if second is None:
        return df.withColumn(name, column(first[0], context.broadcast(first[1])))
    keys = {"bank_hash": F.xxhash64(F.lit(1), F.col(source)), "bank_check": F.xxhash64(F.lit(2), F.col(source))}
    parts = None
    for number, (classes, stack) in enumerate(chain([first, second], banks)):
        held = context.broadcast(stack)
        lines = df.select(*[value.alias(k) for k, value in keys.items()], column(classes, held).alias("part"))
        lines = settle(lines.groupBy(*keys).agg(F.first("part").alias("part")).withColumn("bank", F.lit(number)))
        held.unpersist()
        parts = lines if parts is None else parts.unionByName(lines)
    ordered = F.sort_array(F.collect_list(F.struct("bank", "part")))
    merged = parts.groupBy(*keys).agg(F.flatten(F.transform(ordered, lambda x: x["part"])).alias(name))
    return df.withColumns(keys).join(merged, list(keys), "left").select(*[f"`{c}`" for c in df.columns if c != name], name)


def plane_scores(df: DataFrame, templates: DataFrame, plane: str = "plane", max_bytes: int = TEMPLATE_BYTES) -> DataFrame:
    """Column scores: array of (class_id, score) against every template, in class order; null for a null plane.

    A template table below max_bytes is sent to the executors and each batch is one matrix product.
    A larger one is cut into banks, where need be inside a class, that the images meet in turn, with the same result.
    """
    stored = settle(templates.select("class_id", "plane"))

    def column(classes: list, bank) -> Column:
        @arrow_udf(SCORE_TYPE)
        def score(planes: pa.Array) -> pa.Array:
            valid = np.asarray(planes.is_valid().to_pylist(), bool)
            ends = np.concatenate(([0], np.cumsum(np.where(valid, len(classes), 0)))).astype(np.int32)
            found = np.round(kernels.exact_correlation(_as_matrix(planes.drop_null()), bank.value), 9) if valid.any() else np.zeros((0, len(classes)))
            cells = pa.StructArray.from_arrays([pa.array(np.tile(np.array(classes, np.int32), len(found))), pa.array(found.ravel())], ["class_id", "score"])
            return pa.ListArray.from_arrays(pa.array(ends, mask=np.append(~valid, False)), cells)

        return score(plane)

    return _by_bank(df.drop("scores"), _banks(stored, max_bytes), column, "scores", plane)


def _stored_planes(templates: DataFrame, image: str) -> tuple[DataFrame, int, int]:
    """Grey templates, and the one size they have."""
    greys = templates.select(
        "class_id", grey_plane(image).alias("plane"), F.col(f"{image}.height").alias("h"), F.col(f"{image}.width").alias("w")
    )
    stored = settle(greys)
    count, shapes, h, w = stored.agg(F.count("*"), F.countDistinct("h", "w"), F.max("h"), F.max("w")).first()
    if shapes != 1:
        raise ValueError(f"templates must be there and have one size: found {count} in {shapes} sizes")
    return stored.select("class_id", "plane"), h, w


def _patterns(templates: int, h: int, w: int, margin: int) -> Room:
    """Room of an image that so many templates of a size are matched with."""
    reach = lambda side, own: max(0, side + 2 * margin - own + 1)
    return lambda image: 8 * (image.size + templates * reach(image.shape[0], h) * reach(image.shape[1], w))


def template_pattern(
    df: DataFrame, templates: DataFrame, image: str = "image", margin: int = 4, max_bytes: int = TEMPLATE_BYTES
) -> DataFrame:
    """Column template_pattern: grey correlation at all offsets, template by template in class order.

    templates has class_id and image. A large template table is taken in banks, whose patterns are
    laid end to end.
    """
    stored, h, w = _stored_planes(templates, image)

    def column(classes: list, bank) -> Column:
        match = lambda s: kernels.template_map(kernels.grey(s), bank.value.reshape(-1, h, w), margin)
        return vector_map(match, "float", _patterns(len(classes), h, w, margin))(image)

    return _by_bank(df.drop("template_pattern"), _banks(stored, max_bytes), column, "template_pattern", image)


def all_features(
    df: DataFrame, templates: DataFrame, image: str = "image", margin: int = 4, max_bytes: int = TEMPLATE_BYTES
) -> DataFrame:
    """Struct column features: colour histograms, binary patterns, gradients and template match.

    One function for all of them, so an image crosses to Python and is unpacked once; template banks
    beyond the first take a pass each.
    """
    stored, h, w = _stored_planes(templates, image)
    kinds = {
        **dict.fromkeys(HSV_TYPE.names, "int"),
        "lbp_image": "smallint",
        "lbp_hist": "int",
        "hog_features": "float",
        "template_pattern": "float",
    }
    banks = _banks(stored, max_bytes)
    _, stack = next(banks)
    matched, counted = _patterns(len(stack), h, w, margin), 8 * (sum(HSV_BINS) + LBP_BINS)
    bank = df.sparkSession.sparkContext.broadcast(stack)

    def compute(stack: np.ndarray) -> list[tuple]:
        plane, codes = kernels.grey(stack), _lbp_codes(stack)
        pattern = kernels.template_map(plane, bank.value.reshape(-1, h, w), margin)
        columns = [codes, kernels.histograms(codes, LBP_BINS).astype(np.int32), kernels.hog(stack, 9, 6, 2), pattern]
        return [(*hsv, *others) for hsv, others in zip(_hsv_counts(stack), zip(*columns))]

    @arrow_udf(_struct(*[(n, T.ArrayType(ELEMENTS[k][0])) for n, k in kinds.items()]))
    def run(images: pa.Array) -> pa.Array:
        found = by_shape(unpack(images), compute, lambda image: matched(image) + counted)
        fields = [vectors([None if f is None else f[i] for f in found], ELEMENTS[k][1]) for i, k in enumerate(kinds.values())]
        return pa.StructArray.from_arrays(fields, list(kinds))

    def column(classes: list, bank) -> Column:
        match = lambda s: kernels.template_map(kernels.grey(s), bank.value.reshape(-1, h, w), margin)
        return vector_map(match, "float", _patterns(len(classes), h, w, margin))(image)

    df = df.withColumn("features", run(image))
    more = next(banks, None)
    if more is None:
        return df
    df = _by_bank(df, chain([more], banks), column, "_more", image)
    whole = F.concat("features.template_pattern", "_more")
    return df.withColumn("features", F.col("features").withField("template_pattern", whole)).drop("_more")


_MODELS: dict[str, Callable] = {}


def embedder(predict, values: int, batch: int = 100) -> Callable[[Column], Column]:
    """Column function image -> embedding from any predict function.

    predict is called once per Python worker and returns a function from a float stack
    (n, values) to an (n, k) matrix; values is height * width * channels of every image. Images cross to
    Python once, and `batch` of them at most are predicted at a time; a null image has no embedding.
    """
    name = uuid.uuid4().hex

    def embed(stack: np.ndarray) -> list[np.ndarray]:
        model = _MODELS[name]
        flat = kernels.to_unit(stack).reshape(len(stack), -1).astype(np.float32, copy=False)
        if flat.shape[1] != values:
            raise ValueError(f"an image has not {values} but {flat.shape[1]} values")
        return [row for a in range(0, len(flat), batch) for row in np.asarray(model(flat[a : a + batch]), np.float32)]

    @arrow_udf(T.ArrayType(T.FloatType()))
    def run(images: pa.Array) -> pa.Array:
        if name not in _MODELS:
            _MODELS.clear()  # workers serve one model at a time
            _MODELS[name] = predict()
        return vectors(by_shape(unpack(images), embed, lambda image: image.nbytes), pa.float32())

    return run


def embed_images(df: DataFrame, predict, values: int, batch: int = 100, image: str = "image", name: str = "embedding") -> DataFrame:
    """The frame with an embedding column; an image that has not `values` numbers is an error."""
    size = F.col(f"{image}.height") * F.col(f"{image}.width") * F.col(f"{image}.channels")
    wrong = F.raise_error(F.concat(F.lit(f"an image has not {values} but "), size.cast("string"), F.lit(" values"))).cast(df.schema[image].dataType)
    checked = F.when(F.col(image).isNull() | (size == values), F.col(image)).otherwise(wrong)
    return df.withColumn(name, embedder(predict, values, batch)(checked))
