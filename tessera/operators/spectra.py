"""Components of very wide vectors by a randomised range finder.

The covariance is never formed. A random block of directions is multiplied by it a few times, each time as two
thin products inside the tasks, summed in a tree and made orthonormal on the driver; the small
matrix of the rows seen along these directions gives the components. The driver holds width x rank numbers.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import arrow_udf

from tessera.operators.blocks import matrix, sums

#: Components that are looked for at most, directions looked at besides, and multiplications by the covariance at most.
MOST = 512
EXTRA = 10
POWER = 12
#: The multiplications end when no variance changes by more than this share.
SETTLED = 1e-3
SEED = 42


@dataclass(frozen=True)
class Spectrum:
    """Rows, mean, summed variance of all positions, variances along the components and their directions (one a row)."""

    rows: int
    mean: np.ndarray
    trace: float
    variances: np.ndarray
    directions: np.ndarray

    def running_shares(self) -> np.ndarray:
        return np.cumsum(self.variances) / self.trace if self.trace > 0 else np.ones(len(self.variances))


def _moments(df: DataFrame, vector: str, parts: int) -> tuple[int, np.ndarray, float]:
    """Rows, mean and summed variance, from sums of differences to one of the rows."""
    first = df.select(vector).first()
    if first is None:
        raise ValueError("no rows to find components of")
    start = np.array(first[0], float)

    def add(arrays, batch):
        x = matrix(batch.column(0)) - start
        arrays["n"] += len(x)
        arrays["sum"] += x.sum(axis=0)
        arrays["square"] += (x * x).sum(axis=0)

    found = sums(df.select(vector), {"n": (1,), "sum": start.shape, "square": start.shape}, add, parts)
    n = int(found["n"][0])
    shift = found["sum"] / n
    return n, start + shift, float((found["square"] - n * shift**2).sum() / max(n - 1, 1))


def spectrum(df: DataFrame, vector: str, rank: int, extra: int = EXTRA, power: int = POWER, seed: int = SEED) -> Spectrum:
    """The first `rank` components, all of them exactly where rank + extra reaches the width.

    Reads the rows up to power + 3 times, so the frame should be stored or cached. Null vectors, and vectors of
    unequal length, are errors; so is an empty frame.
    """
    rows = df.select(vector)
    parts = rows.rdd.getNumPartitions()
    n, mean, trace = _moments(rows, vector, parts)
    width, block = len(mean), min(len(mean), rank + extra)
    context = df.sparkSession.sparkContext

    def product(basis: np.ndarray) -> np.ndarray:
        sent = context.broadcast((basis, mean))

        def add(arrays, batch):
            basis, mean = sent.value
            x = matrix(batch.column(0)) - mean
            arrays["z"] += x.T @ (x @ basis)

        return sums(rows, {"z": basis.shape}, add, parts)["z"]

    if block == width:
        basis = np.eye(width)
    else:
        basis = np.linalg.qr(np.random.default_rng(seed).standard_normal((width, block)))[0]
        before = np.zeros(rank)
        for _ in range(power + 1):
            turned = product(basis)
            seen = basis.T @ turned
            basis = np.linalg.qr(turned)[0]
            now = np.linalg.eigvalsh((seen + seen.T) / 2)[::-1][:rank]
            if (np.abs(now - before) <= SETTLED * np.abs(now)).all():
                break
            before = now
    sent = context.broadcast((basis, mean))

    def add(arrays, batch):
        basis, mean = sent.value
        seen = (matrix(batch.column(0)) - mean) @ basis
        arrays["t"] += seen.T @ seen

    inner = sums(rows, {"t": (block, block)}, add, parts)["t"] / max(n - 1, 1)
    values, turns = np.linalg.eigh((inner + inner.T) / 2)
    order = np.argsort(values)[::-1][:rank]
    return Spectrum(n, mean, trace, np.maximum(values[order], 0.0), (basis @ turns[:, order]).T)


def explained_variance(df: DataFrame, vector: str = "vector", most: int = MOST) -> DataFrame:
    """component, variance (its share of the whole) and cumulative, for the first `most` components."""
    found = spectrum(df, vector, most)
    running = found.running_shares()
    shares = np.diff(running, prepend=0.0)
    lines = [(i, float(v), float(c)) for i, (v, c) in enumerate(zip(shares, running))]
    return df.sparkSession.createDataFrame(lines, "component int, variance double, cumulative double")


def components(df: DataFrame, vector: str = "vector", keep: float = 0.95, most: int = MOST) -> DataFrame:
    """Adds `components`: the centred rows along the first components that hold more than `keep` of the variance.

    The number of components looked for is doubled until they hold it, up to `most`, which then all stay.
    """
    rank = min(32, most)
    while True:
        found = spectrum(df, vector, rank)
        running = found.running_shares()
        if running[-1] > keep or rank >= min(most, len(found.mean)):
            break
        rank = min(2 * rank, most)
    chosen = min(len(running), int(np.searchsorted(running, keep, side="right")) + 1)
    sent = df.sparkSession.sparkContext.broadcast((found.directions[:chosen].T, found.mean))  # at most width x most numbers

    @arrow_udf(T.ArrayType(T.DoubleType()))
    def project(vectors: pa.Array) -> pa.Array:
        turn, mean = sent.value
        return pa.array(list((matrix(vectors) - mean) @ turn), pa.list_(pa.float64()))

    return df.withColumn("components", project(F.col(vector)))
