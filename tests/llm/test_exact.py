"""Exact duplicates: both plans against brute force, odd rows."""

import hashlib
import random

import pytest

from tessera.llm import exact
from tessera.llm.exact import exact_dedup

LOWER = str.maketrans(exact.UPPER, exact.UPPER.lower())
SCHEMA = "doc_id long, text string, full string, LEN int, group_size int"


def brute(rows):
    norm = [(i, (t or "").translate(LOWER)) for i, t in rows]
    groups = {}
    for i, x in norm:
        groups.setdefault(x, []).append(i)
    out = []
    for i, x in norm:
        ids = [k for k in groups[x] if k is not None]
        top = max(ids) if ids else None
        out.append((i, top, len(groups[x]), i == top, hashlib.sha256(x.encode()).hexdigest()))
    return sorted(out, key=repr)


def rows_of(seed=2):
    rng = random.Random(seed)
    long = "Äb " * 200
    texts = [None, "", "A", "a", "É", "é", long + "x", long + "X", long + "y", "K", "z" * 300 + "1", "z" * 300 + "2"]
    rows = [(i, rng.choice(texts)) for i in range(300)] + [(1000 + i, f"only {i}") for i in range(50)]
    return rows + [(7, rows[7][1]), (None, "a"), (None, "alone"), (None, "alone")] + [(2000 + i, "hot copy") for i in range(200)]


@pytest.mark.parametrize("broadcast", [True, False])
def test_against_brute_force(spark, monkeypatch, broadcast):
    if not broadcast:
        monkeypatch.setattr(exact, "sized", lambda df: df)
    rows = rows_of()
    docs = spark.createDataFrame([(i, t, "f", 1, 2) for i, t in rows], SCHEMA)
    assert sorted(map(tuple, exact_dedup(docs).collect()), key=repr) == brute(rows)


def test_empty_table(spark):
    assert exact_dedup(spark.createDataFrame([], SCHEMA)).count() == 0
