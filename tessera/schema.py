"""Explicit schemas of the tables; column names are snake case."""

from __future__ import annotations

from pyspark.sql import types as T


def _fields(*pairs) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in pairs])


# Pixels are row-major RGB bytes. dtype is "u1" (0..255, as decoded) or "f4" (0..1, after rescaling).
IMAGE = _fields(
    ("height", T.IntegerType()),
    ("width", T.IntegerType()),
    ("channels", T.IntegerType()),
    ("dtype", T.StringType()),
    ("data", T.BinaryType()),
)

# Header names of the index file, in file order, with the names used here.
INDEX_COLUMNS = {
    "Width": "width",
    "Height": "height",
    "Roi.X1": "roi_x1",
    "Roi.Y1": "roi_y1",
    "Roi.X2": "roi_x2",
    "Roi.Y2": "roi_y2",
    "ClassId": "class_id",
    "Path": "path",
}
RAW_INDEX = T.StructType(
    [
        T.StructField(name, T.StringType() if name == "path" else T.IntegerType(), True)
        for name in INDEX_COLUMNS.values()
    ]
)

META = _fields(
    ("path", T.StringType()),
    ("class_id", T.IntegerType()),
    ("shape_id", T.IntegerType()),
    ("color_id", T.IntegerType()),
    ("sign_id", T.StringType()),
    ("description", T.StringType()),
)

LOOKUP = _fields(("id", T.IntegerType()), ("description", T.StringType()))

RESULTS = _fields(
    ("features", T.ArrayType(T.StringType())),
    ("num_features", T.IntegerType()),
    ("train_time", T.DoubleType()),
    ("predict_time", T.DoubleType()),
    ("accuracy", T.DoubleType()),
)

RUN_LOG = _fields(
    ("model", T.StringType()),
    ("epochs", T.IntegerType()),
    ("filter_size", T.ArrayType(T.IntegerType())),
    ("kernel_size", T.ArrayType(T.IntegerType())),
    ("dense_layer", T.ArrayType(T.IntegerType())),
    ("dropout", T.DoubleType()),
    ("train_accuracy", T.DoubleType()),
    ("val_accuracy", T.DoubleType()),
    ("test_accuracy", T.DoubleType()),
    ("train_time", T.DoubleType()),
)

# Feature families in the order in which they are laid side by side, number of classes.
FEATURE_ORDER = ["lbp", "hue", "sat", "value", "template", "hog", "vgg16", "resnet101"]
CLASS_COUNT = 43
