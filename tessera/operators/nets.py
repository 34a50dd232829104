"""Dense nets trained by minibatch gradient steps inside the tasks.

In an epoch every task starts from the same weights, takes one step for each batch of its rows, and the tasks' weights
are averaged, each by its rows. So an epoch is one pass over the rows and one sum in a tree, whatever the number of
steps. Units are dropped by a hash of row, unit and epoch, so the result depends on how the rows are
partitioned, but on nothing else. Softmax regression is the net without other layers.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import arrow_udf

from tessera.operators.blocks import Arrays, gathered, matrix

Layer = tuple[np.ndarray, np.ndarray]

#: Epochs, step and batch of the softmax regression, and of the net with dropout.
SOFTMAX_STEP, SOFTMAX_BATCH = 0.1, 50
NET_STEP, NET_BATCH, DROPPED = 0.01, 32, 0.1


@dataclass
class Net:
    """Layers (weights, shifts): `plain` ones without activation first, then rectified ones, and a softmax at the end."""

    classes: np.ndarray
    layers: list[Layer]
    plain: int = 0
    dropout: float = 0.0
    history: list[tuple[int, float, float]] = field(default_factory=list)

    def forward(self, x: np.ndarray, mask: np.ndarray | None = None) -> tuple[list[np.ndarray], np.ndarray]:
        """Input of every layer, and the probabilities. The mask (0 or 1 / (1 - dropout)) is laid on the last input."""
        inputs = [x]
        for i, (weights, shifts) in enumerate(self.layers[:-1]):
            out = inputs[-1] @ weights + shifts
            inputs.append(out if i < self.plain else np.maximum(out, 0.0))
        if mask is not None:
            inputs[-1] = inputs[-1] * mask
        scores = inputs[-1] @ self.layers[-1][0] + self.layers[-1][1]
        odds = np.exp(scores - scores.max(axis=1, keepdims=True))
        return inputs, odds / odds.sum(axis=1, keepdims=True)

    def slopes(self, x: np.ndarray, label: np.ndarray, mask: np.ndarray | None = None) -> tuple[float, np.ndarray, list[Layer]]:
        """Summed loss, predicted places, and the mean gradient of every layer."""
        inputs, chance = self.forward(x, mask)
        line = np.arange(len(x))
        loss = -np.log(np.maximum(chance[line, label], 1e-300)).sum()
        pull = chance.copy()
        pull[line, label] -= 1.0
        pull /= len(x)
        found: list[Layer] = []
        for i in range(len(self.layers) - 1, -1, -1):
            found.append((inputs[i].T @ pull, pull.sum(axis=0)))
            if i:
                pull = pull @ self.layers[i][0].T
                if i == len(self.layers) - 1 and mask is not None:
                    pull = pull * mask
                if i - 1 >= self.plain:
                    pull = pull * (inputs[i] > 0)
        return float(loss), chance.argmax(axis=1), found[::-1]


def keep_mask(keys: np.ndarray, units: int, dropout: float, epoch: int, seed: int) -> np.ndarray:
    """1 / (1 - dropout) where a unit stays, else 0, by a hash of row key, unit, epoch and seed."""
    with np.errstate(over="ignore"):
        x = keys.astype(np.int64).view(np.uint64)[:, None] + np.uint64(0x9E3779B97F4A7C15) * (np.arange(1, units + 1, dtype=np.uint64) + np.uint64(seed * 1_000_003 + epoch * 65_537))
        for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
            x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
        x ^= x >> np.uint64(31)
    return ((x >> np.uint64(11)).astype(float) / 2.0**53 >= dropout) / (1.0 - dropout)


def start_layers(sizes: list[int], ones: int, seed: int) -> list[Layer]:
    """Layers between the sizes: the first `ones` of them all ones, the others evenly random within the usual bound, with shifts of 0."""
    rng = np.random.default_rng(seed)
    layers = []
    for i, (a, b) in enumerate(zip(sizes, sizes[1:])):
        bound = np.sqrt(6.0 / (a + b))
        layers.append((np.ones((a, b)), np.ones(b)) if i < ones else (rng.uniform(-bound, bound, (a, b)), np.zeros(b)))
    return layers


def train_epoch(net: Net, batches: Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]], step: float, batch: int | None, epoch: int, seed: int) -> tuple[list[Layer], int, float, int]:
    """Layers after one step for each `batch` rows (None: one for all rows given at once), rows, summed loss before each step, hits."""
    net = Net(net.classes, [(w.copy(), b.copy()) for w, b in net.layers], net.plain, net.dropout)
    rows, loss, hits = 0, 0.0, 0
    for x, label, keys in _in_batches(batches, batch):
        mask = keep_mask(keys, net.layers[-1][0].shape[0], net.dropout, epoch, seed) if net.dropout else None
        own_loss, best, slopes = net.slopes(x, label, mask)
        rows, loss, hits = rows + len(x), loss + own_loss, hits + int((best == label).sum())
        for (weights, shifts), (a, b) in zip(net.layers, slopes):
            weights -= step * a
            shifts -= step * b
    return net.layers, rows, loss, hits


def _in_batches(batches: Iterator[tuple[np.ndarray, ...]], size: int | None) -> Iterator[tuple[np.ndarray, ...]]:
    held: list[tuple[np.ndarray, ...]] = []
    n = 0
    for part in batches:
        held.append(part)
        n += len(part[0])
        if size and n >= size:
            whole = [np.concatenate(x) for x in zip(*held)]
            for a in range(0, n - n % size, size):
                yield tuple(x[a : a + size] for x in whole)
            held, n = [tuple(x[n - n % size :] for x in whole)], n % size
    if n:
        yield tuple(np.concatenate(x) for x in zip(*held))


def fit_net(
    train: DataFrame,
    hidden: list[int],
    epochs: int,
    step: float,
    batch: int | None,
    first: int | None = None,
    ones: int = 0,
    dropout: float = 0.0,
    identity: str | None = None,
    seed: int = 0,
    vector: str = "vector",
    label: str = "class_id",
) -> Net:
    """A net first (no activation), hidden layers (rectified), dropout, softmax over the classes of the rows.

    history has epoch, mean loss and accuracy, each row's taken before the step that it is part of. `identity` is the
    column whose hash drops units; without it the vector's. batch None takes one step for a whole
    partition, which must then fit in a task. The frame should be stored or cached, so that its partitions
    are the same in each epoch. Rows without a class are left out; no rows are an error.
    """
    key = F.xxhash64(F.col(identity or vector))
    rows = train.select(F.col(vector).alias("x"), F.col(label).cast("int").alias("c"), key.alias("k")).where("c IS NOT NULL")
    classes = np.array(sorted(r["c"] for r in rows.select("c").distinct().collect()))
    if not len(classes):
        raise ValueError("no rows to fit on")
    parts, width = rows.rdd.getNumPartitions(), len(rows.select("x").first()[0])
    sizes = [width, *([first] if first else []), *hidden, len(classes)]
    net = Net(classes, start_layers(sizes, ones, seed), 1 if first else 0, dropout)
    shapes = {"rows": (1,), "loss": (1,), "hits": (1,)} | {f"w{i}": w.shape for i, (w, _) in enumerate(net.layers)} | {f"b{i}": b.shape for i, (_, b) in enumerate(net.layers)}
    context = train.sparkSession.sparkContext
    for epoch in range(epochs):
        sent = context.broadcast(net)

        def task(batches: Iterator[pa.RecordBatch], sent=sent, epoch=epoch) -> Arrays | None:
            net = sent.value
            given = ((matrix(b.column("x")), np.searchsorted(net.classes, b.column("c").to_numpy(zero_copy_only=False)), b.column("k").to_numpy()) for b in batches)
            layers, n, loss, hits = train_epoch(net, given, step, batch, epoch, seed)
            if not n:
                return None
            arrays = {"rows": np.array([float(n)]), "loss": np.array([loss]), "hits": np.array([float(hits)])}
            return arrays | {f"w{i}": n * w for i, (w, _) in enumerate(layers)} | {f"b{i}": n * b for i, (_, b) in enumerate(layers)}

        found = gathered(rows, shapes, task, parts)
        n = found["rows"][0]
        net.layers = [(found[f"w{i}"] / n, found[f"b{i}"] / n) for i in range(len(net.layers))]
        net.history.append((epoch, float(found["loss"][0] / n), float(found["hits"][0] / n)))
        sent.unpersist()
    return net


def predictor(net: Net, spark, vector: str = "vector") -> Callable[[DataFrame], DataFrame]:
    """Adds `probability`, in the order of net.classes, and `prediction`, the lowest of the most probable classes."""
    sent = spark.sparkContext.broadcast(net)

    @arrow_udf(T.ArrayType(T.DoubleType()))
    def chances(vectors: pa.Array) -> pa.Array:
        return pa.array(list(sent.value.forward(matrix(vectors))[1]), pa.list_(pa.float64()))

    classes = F.array(*[F.lit(float(c)) for c in net.classes])
    best = F.get(classes, (F.array_position("chances", F.array_max("chances")) - 1).cast("int"))
    return lambda df: df.withColumn("chances", chances(F.col(vector))).withColumn("prediction", best).withColumn("probability", array_to_vector("chances")).drop("chances")


def softmax(epochs: int, step: float = SOFTMAX_STEP, batch: int | None = SOFTMAX_BATCH) -> Callable[[DataFrame], Callable[[DataFrame], DataFrame]]:
    """Softmax regression from weights of 1, as a fit for grid_search, ablation and the like."""

    def fit(train: DataFrame):
        return predictor(fit_net(train, [], epochs, step, batch, ones=1), train.sparkSession)

    return fit


def dense_net(hidden: list[int], epochs: int, first: int | None = None, step: float = NET_STEP, batch: int = NET_BATCH, dropout: float = DROPPED, seed: int = 0):
    """A dense net with dropout before its softmax; the layer without activation starts from ones."""

    def fit(train: DataFrame):
        return predictor(fit_net(train, hidden, epochs, step, batch, first, 1 if first else 0, dropout, seed=seed), train.sparkSession)

    return fit
