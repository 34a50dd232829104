"""Many linear support vector machines at once.

All two-class problems of a fit (pairs of classes or one class against the rest, folds left out, penalties,
subsets of the columns) are rows of one matrix of weights. One pass over the vectors gives loss and gradient of all
of them, and L-BFGS takes a step of each on the driver, so the number of Spark jobs does not grow with
the number of problems. Columns are scaled by the moments of the rows that a problem is fitted on; the scaling
is folded into the weights, so the vectors are read as they are.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, replace
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import arrow_udf

from tessera.operators.blocks import gathered, matrix, summing, sums

#: Width of the quadratic bend that makes the hinge smooth.
BEND = 0.05
HISTORY = 8
#: Least relative gain of a step.
TOLERANCE = 1e-6
#: Weights of the problems that are fitted at a time.
WEIGHT_BYTES = 64 * 1024 * 1024


@dataclass(frozen=True)
class Problems:
    """Two-class problems, one an entry: class counted as 1, class counted as -1 (None: all others), fold left out (None: none), penalty, columns (None: all)."""

    positive: list[int]
    negative: list[int | None]
    fold: list[int | None]
    penalty: list[float]
    columns: list[np.ndarray | None]

    def __len__(self) -> int:
        return len(self.positive)

    def __add__(self, other: Problems) -> Problems:
        return Problems(*[getattr(self, f) + getattr(other, f) for f in self.__dataclass_fields__])

    def part(self, chosen: range) -> Problems:
        return Problems(*[[getattr(self, f)[i] for i in chosen] for f in self.__dataclass_fields__])


def one_vs_rest(classes: list[int], penalty: float, fold: int | None = None, columns: np.ndarray | None = None) -> Problems:
    n = len(classes)
    return Problems(list(classes), [None] * n, [fold] * n, [penalty] * n, [columns] * n)


def one_vs_one(classes: list[int], penalty: float, fold: int | None = None, columns: np.ndarray | None = None) -> Problems:
    """Pairs of classes; the later class counts as 1."""
    pairs = list(combinations(classes, 2))
    n = len(pairs)
    return Problems([b for _, b in pairs], [a for a, _ in pairs], [fold] * n, [penalty] * n, [columns] * n)


def nearest_sides(far: np.ndarray, classes: np.ndarray) -> np.ndarray:
    """The class that lies farthest inside, the lower one on a tie."""
    return classes[far.argmax(axis=1)]


def most_votes(far: np.ndarray, classes: np.ndarray) -> np.ndarray:
    """The class with most votes of the pairs, the lower one on a tie."""
    if len(classes) < 2:
        return np.repeat(classes[:1], len(far))
    ends = np.array(list(combinations(range(len(classes)), 2)))
    winner = np.where(far > 0, ends[:, 1], ends[:, 0]) + np.arange(len(far))[:, None] * len(classes)
    votes = np.bincount(winner.ravel(), minlength=far.shape[0] * len(classes)).reshape(len(far), -1)
    return classes[votes.argmax(axis=1)]


def _smooth_hinge(short: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Loss and slope for what a margin falls short of 1."""
    slope = np.clip(short / BEND, 0.0, 1.0)
    return np.where(short < BEND, slope * short / 2, short - BEND / 2), slope


@dataclass
class _Table:
    """The rows of a fit: class and fold as numbers, and the moments of the rows outside each fold."""

    rows: DataFrame
    parts: int
    classes: list[int]
    folds: list[int]
    moments: dict[int | None, tuple[np.ndarray, np.ndarray]]


def _table(df: DataFrame, vector: str, label: str, fold: str | None) -> _Table:
    rows = df.select(F.col(vector).alias("x"), F.col(label).cast("int").alias("c"), (F.col(fold) if fold else F.lit(0)).cast("int").alias("f")).where("c IS NOT NULL")
    parts = rows.rdd.getNumPartitions()
    kinds = rows.groupBy("c", "f").agg(F.count("*").alias("n"), F.first("x").alias("x")).orderBy("c", "f").collect()  # a line for each class and fold
    if not kinds:
        raise ValueError("no rows to fit on")
    classes, folds = sorted({r["c"] for r in kinds}), sorted({r["f"] for r in kinds})
    start = np.array(kinds[0]["x"], float)

    def add(arrays, batch):
        x, f = matrix(batch.column("x")) - start, np.searchsorted(folds, batch.column("f").to_numpy(zero_copy_only=False))
        for k in np.unique(f):
            own = x[f == k]
            arrays["n"][k] += len(own)
            arrays["sum"][k] += own.sum(axis=0)
            arrays["square"][k] += (own * own).sum(axis=0)

    shape = (len(folds), len(start))
    found = sums(rows, {"n": (len(folds),), "sum": shape, "square": shape}, add, parts)

    def outside(k: int | None) -> tuple[np.ndarray, np.ndarray]:
        n, total, square = (found[name].sum(axis=0) - (0 if k is None else found[name][k]) for name in ("n", "sum", "square"))
        mean = total / max(n, 1)
        spread = np.sqrt(np.maximum(square / max(n, 1) - mean**2, 0.0))
        return start + mean, np.where(spread > 1e-12 * (1 + np.abs(start + mean)), spread, np.inf)

    return _Table(rows, parts, classes, folds, {None: outside(None)} | {f: outside(k) for k, f in enumerate(folds)})


@dataclass(frozen=True)
class Machines:
    """Fitted problems: distance of a vector from each plane is vector @ weights.T + shifts."""

    classes: np.ndarray
    weights: np.ndarray
    shifts: np.ndarray
    losses: np.ndarray
    passes: int


def _fit(table: _Table, problems: Problems, max_iter: int, tolerance: float) -> Machines:
    m, width = len(problems), len(table.moments[None][0])
    mean, spread = (np.array([table.moments[f][k] for f in problems.fold]) for k in (0, 1))
    scale = 1.0 / spread
    for i, columns in enumerate(problems.columns):
        if columns is not None:
            scale[i] = np.where(np.isin(np.arange(width), columns), scale[i], 0.0)
    penalty = np.array(problems.penalty)
    context = table.rows.sparkSession.sparkContext
    sides: dict[tuple[int, int], tuple[np.ndarray, np.ndarray]] = {}
    for c in table.classes:
        for f in table.folds:
            own = [i for i in range(m) if problems.fold[i] != f and (problems.negative[i] is None or c in (problems.positive[i], problems.negative[i]))]
            sides[c, f] = np.array(own, int), np.array([1.0 if problems.positive[i] == c else -1.0 for i in own])

    def at(point: np.ndarray, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Loss and gradient of the chosen problems at their rows of point (weights of scaled columns, then the shift)."""
        weights = point[chosen, :-1] * scale[chosen]
        shifts = point[chosen, -1] - (weights * mean[chosen]).sum(axis=1)
        place = np.full(m, -1)
        place[chosen] = np.arange(len(chosen))
        kinds = {kind: (place[own][place[own] >= 0], y[place[own] >= 0]) for kind, (own, y) in sides.items()}
        used = scale[chosen] != 0
        sent = context.broadcast((weights, shifts, kinds, used))

        def add(arrays, batch):
            weights, shifts, kinds, _ = sent.value
            x, c, f = matrix(batch.column("x")), batch.column("c").to_numpy(zero_copy_only=False), batch.column("f").to_numpy(zero_copy_only=False)
            for kind, (own, y) in kinds.items():
                rows = x[(c == kind[0]) & (f == kind[1])]
                if not len(rows) or not len(own):
                    continue
                loss, slope = _smooth_hinge(1.0 - y * (rows @ weights[own].T + shifts[own]))
                pull = -y * slope
                arrays["loss"][own] += loss.sum(axis=0)
                arrays["pull"][own] += pull.T @ rows
                arrays["shift"][own] += pull.sum(axis=0)

        n = len(chosen)
        added = summing({"loss": (n,), "pull": (n, width), "shift": (n,)}, add)

        def task(batches):
            arrays = added(batches)  # columns that a problem leaves out stay in the task
            return arrays and arrays | {"pull": arrays["pull"][sent.value[3]]}

        found = gathered(table.rows, {"loss": (n,), "pull": (int(used.sum()),), "shift": (n,)}, task, table.parts)
        sent.unpersist()
        pull = np.zeros((n, width))
        pull[used] = found["pull"]
        w, c = point[chosen, :-1], penalty[chosen]
        slope = w + c[:, None] * (pull - found["shift"][:, None] * mean[chosen]) * scale[chosen]
        return c * found["loss"] + (w * w).sum(axis=1) / 2, np.column_stack([slope, c * found["shift"]])

    point = np.zeros((m, width + 1))
    value, slope = at(point, np.arange(m))
    passes, open_, step = 1, np.ones(m, bool), np.minimum(1.0, 1.0 / np.maximum(np.linalg.norm(slope, axis=1), 1e-12))
    way = -slope
    history: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    while passes < max_iter and open_.any():
        chosen = np.flatnonzero(open_)
        trial = point.copy()
        trial[chosen] += step[chosen, None] * way[chosen]
        new_value, new_slope = at(trial, chosen)
        passes += 1
        falls = new_value <= value[chosen] + 1e-4 * step[chosen] * (way[chosen] * slope[chosen]).sum(axis=1)
        good, bad = chosen[falls], chosen[~falls]
        moved, turned = np.zeros_like(point), np.zeros_like(point)
        moved[good], turned[good] = trial[good] - point[good], new_slope[falls] - slope[good]
        inner = (moved * turned).sum(axis=1)
        history = [*history, (moved, turned, np.where(inner > 1e-12, 1.0 / np.maximum(inner, 1e-300), 0.0))][-HISTORY:]
        gain = (value[good] - new_value[falls]) / np.maximum(1e-12, np.maximum(np.abs(value[good]), np.abs(new_value[falls])))
        point[good], value[good], slope[good] = trial[good], new_value[falls], new_slope[falls]
        open_[good[gain < tolerance]] = False
        step[good] = 1.0
        step[bad] *= 0.4
        open_[bad[step[bad] < 1e-6]] = False
        way[good] = _downhill(slope[good], [(s[good], y[good], r[good]) for s, y, r in history])
    weights = point[:, :-1] * scale
    return Machines(np.array(table.classes), weights, point[:, -1] - (weights * mean).sum(axis=1), value, passes)


def _downhill(slope: np.ndarray, history: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> np.ndarray:
    """The two-loop recursion of L-BFGS for every row; steps that a row did not take have r = 0."""
    q, factors = slope.copy(), []
    for s, y, r in reversed(history):
        factors.append(r * (s * q).sum(axis=1))
        q -= factors[-1][:, None] * y
    size = np.ones(len(slope))
    for s, y, r in history:
        size = np.where(r > 0, 1.0 / np.maximum(r * (y * y).sum(axis=1), 1e-300), size)
    q *= size[:, None]
    for (s, y, r), a in zip(history, reversed(factors)):
        q += (a - r * (y * q).sum(axis=1))[:, None] * s
    steep = (q * slope).sum(axis=1) > 0
    return -np.where(steep[:, None], q, slope)


def fit_machines(
    df: DataFrame, problems: Callable[[list[int]], Problems], vector: str = "vector", label: str = "class_id", fold: str | None = None, max_iter: int = 100, tolerance: float = TOLERANCE
) -> Machines:
    """Fits all problems that `problems` makes of the sorted classes; max_iter bounds the passes over the rows.

    Minimises penalty * summed hinge + |weights|^2 / 2 of scaled columns, the shift free; a constant column
    counts nothing. The frame should be stored or cached. Rows without a class are left out. Where
    the weights of all problems are more than WEIGHT_BYTES, they are fitted in blocks.
    """
    table = _table(df, vector, label, fold)
    every = problems(table.classes)
    size = max(1, WEIGHT_BYTES // (8 * (len(table.moments[None][0]) + 1)))
    parts = [_fit(table, every.part(range(a, min(a + size, len(every)))), max_iter, tolerance) for a in range(0, max(len(every), 1), size)]
    joined = {f: np.concatenate([getattr(p, f) for p in parts]) for f in ("weights", "shifts", "losses")}
    return replace(parts[0], **joined, passes=sum(p.passes for p in parts))


def predictor(machines: Machines, decide: Callable[[np.ndarray, np.ndarray], np.ndarray], spark, vector: str = "vector") -> Callable[[DataFrame], DataFrame]:
    """Adds `prediction`; decide turns the distances (rows x problems) into classes."""
    sent = spark.sparkContext.broadcast((machines.weights, machines.shifts, machines.classes))  # at most WEIGHT_BYTES a block of problems

    @arrow_udf(T.DoubleType())
    def predict(vectors: pa.Array) -> pa.Array:
        weights, shifts, classes = sent.value
        return pa.array(decide(matrix(vectors) @ weights.T + shifts, classes).astype(float))

    return lambda df: df.withColumn("prediction", predict(F.col(vector)))


def grid_scores(
    df: DataFrame, penalties: list[float], fold: str, folds: int, schemes: tuple[str, ...] = ("ovo", "ovr"), vector: str = "vector", label: str = "class_id", max_iter: int = 100
) -> DataFrame:
    """candidate, fold, accuracy, mean_accuracy of every penalty and scheme, fitted without each fold and scored on it.

    One fit serves all candidates and folds, one more pass scores them. fold is a column 0..folds-1.
    """
    cells = [(scheme, c, f) for scheme in schemes for c in penalties for f in range(folds)]
    made = {"ovo": one_vs_one, "ovr": one_vs_rest}
    decide = {"ovo": most_votes, "ovr": nearest_sides}

    def problems(classes: list[int]) -> Problems:
        return sum((made[scheme](classes, c, f) for scheme, c, f in cells), Problems([], [], [], [], []))

    found = fit_machines(df, problems, vector, label, fold, max_iter)
    sizes = [len(made[scheme](list(found.classes), c, f)) for scheme, c, f in cells]
    bounds = np.cumsum([0, *sizes])
    sent = df.sparkSession.sparkContext.broadcast((found.weights, found.shifts, found.classes))

    def add(arrays, batch):
        weights, shifts, classes = sent.value
        x, c, f = matrix(batch.column("x")), batch.column("c").to_numpy(zero_copy_only=False), batch.column("f").to_numpy(zero_copy_only=False)
        for i, (scheme, _, k) in enumerate(cells):
            own, part = f == k, slice(bounds[i], bounds[i + 1])
            if own.any():
                arrays["hits"][i] += (decide[scheme](x[own] @ weights[part].T + shifts[part], classes) == c[own]).sum()
                arrays["rows"][i] += own.sum()

    rows = df.select(F.col(vector).alias("x"), F.col(label).cast("int").alias("c"), F.col(fold).cast("int").alias("f")).where("c IS NOT NULL")
    scored = sums(rows, {"hits": (len(cells),), "rows": (len(cells),)}, add)
    accuracy = scored["hits"] / np.maximum(scored["rows"], 1)
    mean = accuracy.reshape(-1, folds).mean(axis=1).repeat(folds)
    lines = [(f"{scheme} C={c}", f, float(a), float(b)) for (scheme, c, f), a, b in zip(cells, accuracy, mean)]
    return df.sparkSession.createDataFrame(lines, "candidate string, fold int, accuracy double, mean_accuracy double")


def subset_scores(
    train: DataFrame, test: DataFrame, parts: dict[str, tuple[int, int]], penalty: float = 0.005, vector: str = "vector", label: str = "class_id", max_iter: int = 100
) -> DataFrame:
    """features, num_features, accuracy of the pairwise machines on every subset of the parts (name: from, to), all fitted together."""
    names = list(parts)
    subsets = [list(chosen) for size in range(1, len(names) + 1) for chosen in combinations(names, size)]
    columns = [np.concatenate([np.arange(*parts[name]) for name in chosen]) for chosen in subsets]
    found = fit_machines(train, lambda classes: sum((one_vs_one(classes, penalty, columns=own) for own in columns), Problems([], [], [], [], [])), vector, label, max_iter=max_iter)
    each = len(found.weights) // len(subsets)
    sent = train.sparkSession.sparkContext.broadcast((found.weights, found.shifts, found.classes))

    def add(arrays, batch):
        weights, shifts, classes = sent.value
        x, c = matrix(batch.column("x")), batch.column("c").to_numpy(zero_copy_only=False)
        arrays["rows"] += len(c)
        for i, own in enumerate(columns):
            part = slice(i * each, (i + 1) * each)
            arrays["hits"][i] += (most_votes(x[:, own] @ weights[part][:, own].T + shifts[part], classes) == c).sum()

    rows = test.select(F.col(vector).alias("x"), F.col(label).cast("int").alias("c")).where("c IS NOT NULL")
    scored = sums(rows, {"hits": (len(subsets),), "rows": (1,)}, add)
    lines = [(chosen, len(own), float(h / max(scored["rows"][0], 1))) for chosen, own, h in zip(subsets, columns, scored["hits"])]
    return train.sparkSession.createDataFrame(lines, "features array<string>, num_features int, accuracy double")
