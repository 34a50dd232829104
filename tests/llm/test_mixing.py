"""Mixing: targets against repeated resharing, quotas against all quotients, the words taken, odd rows."""

import random

import pytest
from pyspark.sql import functions as F

from tessera.llm import mixing
from tessera.llm.mixing import apportion, mix, targets

SF = "/root/testdata/sf0.01"


def reshare(sizes, weights=mixing.WEIGHTS, share=mixing.SHARE, most=mixing.MOST):
    """Targets by resharing the excess until none is above."""
    w = [weights[i % len(weights)] for i in range(len(sizes))]
    full, target = set(), []
    while True:
        rest = share * sum(sizes) - sum(most * sizes[i] for i in full)
        open_w = sum(w[i] for i in range(len(sizes)) if i not in full)
        target = [most * s if i in full else rest * w[i] / open_w for i, s in enumerate(sizes)]
        over = {i for i in range(len(sizes)) if i not in full and target[i] > most * sizes[i]}
        if not over:
            return target
        full |= over


def test_targets(spark):
    rng = random.Random(4)
    for n in (1, 2, 5, 30):
        sizes = [int(rng.lognormvariate(6, 1.5)) for _ in range(n)]
        names = [f"s{i:03d}" for i in range(n - 1)] + [None]
        rows = targets(spark.createDataFrame(list(zip(names, sizes)), "source string, source_size long")).collect()
        got = {r.source: r.target for r in rows}
        for name, want in zip(names, reshare(sizes)):
            assert got[name] == pytest.approx(want, rel=1e-9)


def test_quotas(spark):
    rng = random.Random(8)
    rows, want = [], {}
    for group in range(12):
        seats, m = rng.choice([0, 1, 3, 10, 57, 400]), rng.randint(1, 15)
        weights = [rng.choice([0, 1, 2, 7, rng.randint(1, 1000)]) for _ in range(m)]
        rows += [(group, k, float(w), seats) for k, w in enumerate(weights)]
        quotients = sorted(((-w / (2 * j + 1), k, j) for k, w in enumerate(weights) if w for j in range(seats)))[:seats]
        for k in range(m):
            want[group, k] = sum(q[1] == k for q in quotients)
    parties = spark.createDataFrame(rows, "g int, k int, w double, seats int")
    got = {(r.g, r.k): r.quota for r in apportion(parties, F.col("seats"), F.col("w"), ["g"], [F.col("k")]).collect()}
    assert got == want


def test_words_taken(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = mix(docs).collect()
    by_source = {r.doc_id: r.source for r in docs.collect()}
    sizes, taken, goal = {}, {}, {}
    for r in rows:
        s = by_source[r.doc_id]
        sizes[s] = sizes.get(s, 0) + r.size
        taken[s] = taken.get(s, 0) + r.taken
        goal[s] = r.target
        assert 0 <= r.taken <= 2 * r.size
        assert sum(x["to"] - x["from"] for x in r.spans) == r.size
    names = sorted(sizes)
    for name, want in zip(names, reshare([sizes[n] for n in names])):
        assert goal[name] == pytest.approx(want)
        assert abs(taken[name] - want) <= 0.01 * want + 2
    assert sorted(map(tuple, mix(docs).drop("spans").collect())) == sorted(tuple(r)[:-1] for r in rows)


def test_odd_rows(spark):
    schema = "size string, doc_id long, source string, text string, Shard int, target int"
    rows = [("x", i, ["a", None, "b"][i % 3], "w " * (i % 7) if i % 5 else None, 1, 2) for i in range(60)] + [("x", None, "a", "q " * 3000, 1, 2)] * 2
    found = mix(spark.createDataFrame(rows, schema)).collect()
    assert len(found) == 62
    assert all(r.taken <= 2 * r.size for r in found)
    assert [r.size for r in found if r.doc_id is None] == [3000, 3000]
    assert mix(spark.createDataFrame([], schema)).count() == 0
    empty = mix(spark.createDataFrame([("x", 1, "a", None, 1, 2)], schema)).first()
    assert (empty.size, empty.taken, empty.target) == (0, 0, 0.0)
