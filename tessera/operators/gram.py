"""Least squares on every subset of the feature families from one pass.

The inner products of all columns and their sums by class are enough to fit regularised least squares to the class
marks on any subset of the columns: the subset's block is solved, in a task of its own. One more
pass over the other rows predicts with all subsets and counts their confusions.
"""

from __future__ import annotations

import time
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.operators.blocks import matrix, sums
from tessera.schema import RESULTS

RIDGE = 1e-3
#: Columns whose inner products are held at most, and weights that a pass predicts with.
MOST_WIDTH = 4096
WEIGHT_BYTES = 64 * 1024 * 1024

COUNTS = "subset string, actual int, predicted int, n bigint"


@dataclass(frozen=True)
class Gram:
    """Classes, their rows and sums, and the inner products of the columns, all of differences to `start`."""

    classes: np.ndarray
    rows: np.ndarray
    totals: np.ndarray
    products: np.ndarray
    start: np.ndarray

    def solve(self, columns: np.ndarray, ridge: float = RIDGE) -> tuple[np.ndarray, np.ndarray]:
        """Weights (columns x classes) and shifts of the class marks on scaled columns; constant columns count nothing."""
        n = self.rows.sum()
        mean = self.totals[:, columns].sum(axis=0) / n
        inner = self.products[np.ix_(columns, columns)] / n - np.outer(mean, mean)
        spread = np.sqrt(np.maximum(np.diag(inner), 0.0))
        scale = np.divide(1.0, spread, out=np.zeros_like(spread), where=spread > 1e-9 * (1 + np.abs(mean)))
        marks = (self.totals[:, columns] - self.rows[:, None] * mean) / n * scale
        scaled = inner * np.outer(scale, scale)
        scaled[np.diag_indices_from(scaled)] = np.where(scale > 0, 1.0 + ridge, 1.0)
        weights = np.linalg.solve(scaled, marks.T) * scale[:, None]
        return weights, self.rows / n - (mean + self.start[columns]) @ weights


def gram(df: DataFrame, vector: str = "vector", label: str = "class_id") -> Gram:
    """Reads the rows once; rows without a class are left out. More than MOST_WIDTH columns are an error."""
    rows = df.select(F.col(vector).alias("x"), F.col(label).cast("int").alias("c")).where("c IS NOT NULL")
    first = rows.select("x").first()
    if first is None:
        raise ValueError("no rows to fit on")
    start = np.array(first[0], float)
    width = len(start)
    if width > MOST_WIDTH:
        raise ValueError(f"{width} columns; inner products are held for up to {MOST_WIDTH}")
    classes = np.array(sorted(r["c"] for r in rows.select("c").distinct().collect()))

    def add(arrays, batch):
        x, c = matrix(batch.column("x")) - start, np.searchsorted(classes, batch.column("c").to_numpy(zero_copy_only=False))
        arrays["products"] += x.T @ x
        mark = np.zeros((len(classes), len(x)))
        mark[c, np.arange(len(x))] = 1.0
        arrays["totals"] += mark @ x
        arrays["rows"] += mark.sum(axis=1)

    found = sums(rows, {"products": (width, width), "totals": (len(classes), width), "rows": (len(classes),)}, add)
    return Gram(classes, found["rows"], found["totals"], found["products"], start)


def subsets_of(names: list[str]) -> list[list[str]]:
    """All subsets but the empty one, small ones first."""
    return [list(chosen) for size in range(1, len(names) + 1) for chosen in combinations(names, size)]


def _solved(spark, found: Gram, columns: list[np.ndarray], ridge: float, from_: int, to: int) -> list:
    sent = spark.sparkContext.broadcast((found, columns, ridge))  # at most MOST_WIDTH squared numbers

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, columns, ridge = sent.value
        for batch in batches:
            for i in batch.column(0).to_pylist():
                began = time.perf_counter()
                weights, shifts = found.solve(columns[i], ridge)
                taken = time.perf_counter() - began
                yield pa.record_batch([pa.array([i]), pa.array([weights.tobytes()]), pa.array([shifts.tobytes()]), pa.array([taken])], ["i", "weights", "shifts", "taken"])

    rows = spark.range(from_, to, 1, max(1, (to - from_) // 32)).mapInArrow(run, "i bigint, weights binary, shifts binary, taken double").collect()
    return sorted(rows, key=lambda r: r["i"])


def ablation(
    train: DataFrame, test: DataFrame, parts: dict[str, tuple[int, int]], vector: str = "vector", label: str = "class_id", ridge: float = RIDGE
) -> tuple[DataFrame, DataFrame]:
    """Every subset of the parts (name: from, to): a line of results each, and confusion counts (subset, actual, predicted, n).

    features names the parts of a line; its train_time is that of the solution in its task, its predict_time that
    of its products in all tasks, so neither holds what other subsets take. The inner products, one pass, are
    not in them. Equal scores go to the lower class. Rows without a class are left out.
    """
    spark = train.sparkSession
    found = gram(train, vector, label)
    subsets = subsets_of(list(parts))
    columns = [np.concatenate([np.arange(*parts[name]) for name in chosen]) for chosen in subsets]
    rows = test.select(F.col(vector).alias("x"), F.col(label).cast("int").alias("c")).where("c IS NOT NULL")
    actual = np.array(sorted(r["c"] for r in rows.select("c").distinct().collect()), int)
    step = max(1, WEIGHT_BYTES // (8 * len(found.start) * len(found.classes)))
    lines, counts = [], []
    for a in range(0, len(subsets), step):
        solved = _solved(spark, found, columns, ridge, a, min(a + step, len(subsets)))
        sent = spark.sparkContext.broadcast([(columns[r["i"]], np.frombuffer(r["weights"]).reshape(-1, len(found.classes)), np.frombuffer(r["shifts"])) for r in solved])

        def add(arrays, batch, sent=sent):
            x, c = matrix(batch.column("x")), np.searchsorted(actual, batch.column("c").to_numpy(zero_copy_only=False))
            for k, (own, weights, shifts) in enumerate(sent.value):
                began = time.perf_counter()
                best = (x[:, own] @ weights + shifts).argmax(axis=1)
                arrays["seconds"][k] += time.perf_counter() - began
                np.add.at(arrays["counts"][k], (c, best), 1)

        scored = sums(rows, {"counts": (len(solved), len(actual), len(found.classes)), "seconds": (len(solved),)}, add)
        for r, table, seconds in zip(solved, scored["counts"], scored["seconds"]):
            names = subsets[r["i"]]
            hits = sum(table[i, j] for i, x in enumerate(actual) for j, y in enumerate(found.classes) if x == y)
            lines.append((names, len(columns[r["i"]]), r["taken"], float(seconds), float(hits / table.sum()) if table.sum() else None))
            counts += [("+".join(names), int(actual[i]), int(found.classes[j]), int(table[i, j])) for i, j in zip(*np.nonzero(table))]
    return spark.createDataFrame(lines, RESULTS), spark.createDataFrame(counts, COUNTS)
