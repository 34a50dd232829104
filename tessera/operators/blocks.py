"""Arrays summed over all rows of a frame.

Each task adds its batches to arrays of its own; the arrays are cut into cells and merged level by level, so that
neither a task nor the driver holds more than FAN tasks' worth of a cell at a time. Cells are merged in the order
of the tasks, so that the same partitions give the same sums. Names that begin with `min` or `max` hold least or
largest values instead of sums.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from math import prod

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Numbers of a cell, and tasks whose cells are added at a time.
CELL = 65_536
FAN = 32
#: Arrays of all tasks together that the driver adds itself. Fits ask for sums up to a hundred times, so what is
#: sent each time is little more than the result, however many tasks there are.
DRIVER_BYTES = 2 * 1024 * 1024

_ROWS = "name string, cell int, part int, numbers binary"

Arrays = dict[str, np.ndarray]


def _how(name: str) -> tuple[np.ufunc, float]:
    """How two arrays of that name are merged, and what an empty one holds."""
    kinds = {"min": (np.minimum, np.inf), "max": (np.maximum, -np.inf)}
    return kinds.get(name[:3], (np.add, 0.0))


def matrix(column: pa.Array) -> np.ndarray:
    """The vectors of a batch as rows of a matrix; null vectors, null values and vectors of unequal length are errors."""
    if column.null_count:
        raise ValueError("a vector is null")
    flat = column.flatten()
    if flat.null_count or len(flat) % max(1, len(column)) or len(set(column.value_lengths().to_pylist())) > 1:
        raise ValueError("vectors hold nulls or are not of one length")
    return flat.to_numpy(zero_copy_only=False).astype(np.float64, copy=False).reshape(len(column), -1)


def _cells(arrays: Arrays, part: int) -> Iterator[pa.RecordBatch]:
    for name, array in arrays.items():
        flat = np.ascontiguousarray(array, np.float64).ravel()
        for k in range(0, len(flat), CELL):
            yield pa.record_batch([pa.array([name]), pa.array([k // CELL], pa.int32()), pa.array([part], pa.int32()), pa.array([flat[k : k + CELL].tobytes()])], ["name", "cell", "part", "numbers"])


def _add_sorted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds cells that stand next to each other under one key."""
    now, total = None, None

    def done() -> pa.RecordBatch:
        return pa.record_batch([pa.array([now[0]]), pa.array([now[1]], pa.int32()), pa.array([now[2]], pa.int32()), pa.array([total.tobytes()])], ["name", "cell", "part", "numbers"])

    for batch in batches:
        for name, cell, to, numbers in zip(*(batch.column(c).to_pylist() for c in ("name", "cell", "to", "numbers"))):
            given = np.frombuffer(numbers)
            if now == (name, cell, to):
                total = _how(name)[0](total, given)
                continue
            if now:
                yield done()
            now, total = (name, cell, to), given
    if now:
        yield done()


def gathered(df: DataFrame, shapes: dict[str, tuple[int, ...]], task: Callable[[Iterator[pa.RecordBatch]], Arrays | None], parts: int | None = None) -> Arrays:
    """Arrays of the given shapes, merged from those that `task` gives for each partition (None: nothing).

    `parts` is the number of the frame's partitions, asked for where it is not known.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        arrays = task(batch for batch in batches if batch.num_rows)
        if arrays is not None:
            yield from _cells(arrays, TaskContext.get().partitionId())

    parts = parts or df.rdd.getNumPartitions()
    cells = df.mapInArrow(run, _ROWS)
    while parts > 1 and 8 * parts * sum(map(prod, shapes.values())) > DRIVER_BYTES:
        keys = ["name", "cell", "to"]
        dealt = cells.withColumn("to", F.floor(F.col("part") / FAN).cast("int")).repartition(*keys).sortWithinPartitions(*keys, "part")
        cells, parts = dealt.mapInArrow(_add_sorted, _ROWS), -(-parts // FAN)
    found = {name: np.full(prod(shape), _how(name)[1]) for name, shape in shapes.items()}
    for row in sorted(cells.collect(), key=lambda r: (r["name"], r["cell"], r["part"])):
        given, start = np.frombuffer(row["numbers"]), row["cell"] * CELL
        held = found[row["name"]][start : start + len(given)]
        _how(row["name"])[0](held, given, out=held)
    return {name: found[name].reshape(shape) for name, shape in shapes.items()}


def summing(shapes: dict[str, tuple[int, ...]], add: Callable[[Arrays, pa.RecordBatch], None]) -> Callable[[Iterator[pa.RecordBatch]], Arrays | None]:
    """What a task does to add up its batches; without rows it gives nothing."""

    def task(batches: Iterator[pa.RecordBatch]) -> Arrays | None:
        arrays = None
        for batch in batches:
            arrays = arrays or {name: np.full(shape, _how(name)[1]) for name, shape in shapes.items()}
            add(arrays, batch)
        return arrays

    return task


def sums(df: DataFrame, shapes: dict[str, tuple[int, ...]], add: Callable[[Arrays, pa.RecordBatch], None], parts: int | None = None) -> Arrays:
    """Arrays of the given shapes to which `add` has added every batch of the frame; an empty frame leaves them as they begin."""

    return gathered(df, shapes, summing(shapes, add), parts)
