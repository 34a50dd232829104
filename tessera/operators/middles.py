"""Medians of whole vectors by narrowing, without taking the vectors apart.

For every class and position the range that holds the middle rank is cut into steps; the tasks count the values of each
step as arrays, and the step with the rank becomes the next range, with its own least and largest value. A range of
one value is done. Nothing is exploded or sorted, and a hot class is counted in all tasks.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from tessera.operators.blocks import sums

#: Steps of a range in a pass, at least and at most, and bytes of the arrays that a task counts in.
STEPS = 32
MOST_STEPS = 128
ARRAY_BYTES = 64 * 1024 * 1024


def _values(column: pa.Array, cut: slice) -> np.ndarray:
    """The chosen positions of a batch's vectors; null values are NaN."""
    lengths = set(column.value_lengths().to_pylist())
    if len(lengths) != 1 or column.null_count:
        raise ValueError("vectors are null or not of one length")
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64, copy=False)
    return flat.reshape(len(column), -1)[:, cut]


def _number(column: pa.Array, groups: pa.Array) -> np.ndarray:
    return pc.index_in(column, value_set=groups).to_numpy(zero_copy_only=False)


def _ends(rows: DataFrame, groups: pa.Array, cut: slice, width: int, parts: int):
    shape = (len(groups), width)

    def add(arrays, batch):
        x, g = _values(batch.column("x"), cut), _number(batch.column("g"), groups)
        for k in np.unique(g):
            own = x[g == k]
            known = ~np.isnan(own)
            arrays["n"][k] += known.sum(axis=0)
            arrays["min"][k] = np.minimum(arrays["min"][k], np.where(known, own, np.inf).min(axis=0))
            arrays["max"][k] = np.maximum(arrays["max"][k], np.where(known, own, -np.inf).max(axis=0))

    found = sums(rows, {"n": shape, "min": shape, "max": shape}, add, parts)
    return found["n"], found["min"], found["max"]


def _place(x: np.ndarray, low: np.ndarray, high: np.ndarray, steps: int) -> np.ndarray:
    """Step of each value in its range; the ends always lie in the first and the last step, so ranges shrink."""
    with np.errstate(all="ignore"):
        share = (x / 2 - low / 2) / (high / 2 - low / 2)
    step = np.clip(np.nan_to_num(share * steps), 0, steps - 1).astype(np.int64)
    return np.where(x == low, 0, np.where(x == high, steps - 1, step))


def _narrow(rows: DataFrame, groups: pa.Array, cut: slice, rank: np.ndarray, low: np.ndarray, high: np.ndarray, parts: int) -> np.ndarray:
    """Values at the ranks (0-based, by group and position) between low and high."""
    rank, low, high = rank.copy(), low.copy(), high.copy()
    context = rows.sparkSession.sparkContext
    while True:
        open_ = low < high
        if not open_.any():
            return low
        cells = np.full(open_.shape, -1)
        cells[open_] = np.arange(open_.sum())  # done ranges take no arrays
        size = int(open_.sum())
        steps = max(STEPS, min(MOST_STEPS, ARRAY_BYTES // (24 * size)))
        sent = context.broadcast((low, high, cells))

        def add(arrays, batch, sent=sent, steps=steps):
            low, high, cells = sent.value
            x, g = _values(batch.column("x"), cut), _number(batch.column("g"), groups)
            cell = cells[g]
            inside = (cell >= 0) & (x >= low[g]) & (x <= high[g])
            at = cell[inside] * steps + _place(x, low[g], high[g], steps)[inside]
            held = x[inside]
            arrays["n"] += np.bincount(at, minlength=len(arrays["n"]))
            np.minimum.at(arrays["min"], at, held)
            np.maximum.at(arrays["max"], at, held)

        found = {name: array.reshape(size, steps) for name, array in sums(rows, {name: (size * steps,) for name in ("n", "min", "max")}, add, parts).items()}
        up_to = np.cumsum(found["n"], axis=1)
        step = (up_to <= rank[open_][:, None]).sum(axis=1)
        line = np.arange(size)
        rank[open_] -= up_to[line, step] - found["n"][line, step]
        low[open_], high[open_] = found["min"][line, step], found["max"][line, step]


def median_vectors(df: DataFrame, vector: str, by: str = "class_id") -> DataFrame:
    """Element-wise exact median of the vectors of each class, as (by, pos, median).

    Null values are left out, and so are NaN; a position without values has no line. A null class is a class. Null
    vectors, and vectors of unequal length, are errors. An empty frame gives no rows. The driver holds a
    few numbers for each class and position; arrays of a task stay below ARRAY_BYTES, beyond which
    positions are taken in turns.
    """
    spark, kind = df.sparkSession, df.schema[by].dataType
    names = sorted((r[by] for r in df.select(by).distinct().collect()), key=lambda x: (x is not None, x))
    rows = df.select(F.col(vector).alias("x"), F.col(by).alias("g"))
    first = rows.select("x").first()
    lines = []
    if first is not None:
        groups, parts, width = pa.array(names, to_arrow_type(kind)), rows.rdd.getNumPartitions(), len(first[0])
        turn = max(1, ARRAY_BYTES // (24 * STEPS * len(names)))
        for a in range(0, width, turn):
            cut = slice(a, min(a + turn, width))
            n, low, high = _ends(rows, groups, cut, cut.stop - a, parts)
            some = n > 0
            low, high = np.where(some, low, 0.0), np.where(some, high, 0.0)
            lower = _narrow(rows, groups, cut, np.maximum(n - 1, 0) // 2, low, high, parts)
            upper = _narrow(rows, groups, cut, n // 2, low, high, parts) if (n % 2 == 0).any() else lower
            middle = np.where(n % 2 == 0, lower + (upper - lower) / 2, lower)
            middle = np.where((n % 2 == 0) & np.isfinite(lower + upper), (lower + upper) / 2, middle)
            lines += [(names[g], a + int(p), float(middle[g, p])) for g, p in zip(*np.nonzero(some))]
    return spark.createDataFrame(lines, f"{by} {kind.simpleString()}, pos int, median double")
