"""Similarity join: against all pairs, in one block and cut into chunks; odd rows; components."""

import random

import numpy as np
import pytest

from tessera.llm import jaccard
from tessera.llm.components import components
from tessera.llm.jaccard import shingle_sets, similarity_classes

SCHEMA = "doc_id long, text string, n int, KEY string, tag string"


def shingles(text):
    w = (text or "").encode().lower().split()
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def brute(rows):
    sets = [shingles(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            common = len(sets[a] & sets[b])
            if common and 100 * common >= 75 * len(sets[a] | sets[b]):
                root[find(a)] = find(b)
    groups = {}
    for k in range(len(rows)):
        groups.setdefault(find(k), []).append(rows[k][0])
    out = []
    for k, (i, _) in enumerate(rows):
        ids = [x for x in groups[find(k)] if x is not None]
        out.append((i, len(sets[k]), min(ids) if ids else None))
    return sorted(out, key=repr)


def near_copies(seed, n=160, passage=True):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(400)]
    shared = [rng.choice(words) for _ in range(30)]
    bases = [[rng.choice(words) for _ in range(rng.randint(4, 150))] for _ in range(12)]
    rows = []
    for i in range(n):
        w = list(rng.choice(bases))
        for _ in range(rng.choice([0, 0, 1, 2, 4, 8])):
            w[rng.randrange(len(w))] = rng.choice(words)
        if passage and rng.random() < 0.4:
            at = rng.randrange(len(w) + 1)
            w[at:at] = shared
        text = rng.choice([" ", "\n", "\t "]).join(w)
        rows.append((i * 7 % 1009, text.upper() if rng.random() < 0.2 else text))
    return rows


@pytest.mark.parametrize("chunk", [1024, 5])
def test_against_all_pairs(spark, monkeypatch, chunk):
    monkeypatch.setattr(jaccard, "CHUNK_DOCS", chunk)
    rows = near_copies(1) + [(5000, None), (5001, ""), (5002, " \n"), (5003, "one"), (5004, "ONE"), (5005, "a b c d e"), (5006, "a\x0bb c d e f")]
    rows += [(None, rows[3][1]), (None, "nobody else has these words here"), (rows[4][0], rows[4][1])]
    docs = spark.createDataFrame([(i, t, 0, "k", "t") for i, t in rows], SCHEMA)
    assert sorted(map(tuple, similarity_classes(docs).drop("h").collect()), key=repr) == brute(rows)


def test_long_texts_and_words_in_pieces(monkeypatch):
    monkeypatch.setattr(jaccard, "CHUNK_BYTES", 50)
    texts = ["x" * 500, "é " * 300, "a bb ccc " * 40, None, " ", "A b c d e f"] + [t for _, t in near_copies(3, 20)]
    found = shingle_sets(texts)
    assert [len(s) for s in found] == [len(shingles(t)) for t in texts]
    monkeypatch.undo()
    assert all(np.array_equal(a, b) for a, b in zip(found, shingle_sets(texts)))


def test_empty_table(spark):
    assert similarity_classes(spark.createDataFrame([], SCHEMA)).count() == 0


def test_components_of_a_long_path_and_a_star(spark):
    rng = random.Random(6)
    names = list(range(300))
    rng.shuffle(names)
    path = list(zip(names[:200], names[1:200])) + [(names[250], names[k]) for k in range(251, 300)] + [(3, 3)]
    edges = spark.createDataFrame(path, "a long, b long")
    got = {r.node: r.root for r in components(edges).collect()}
    assert got == {**{k: min(names[:200]) for k in names[:200]}, **{k: min(names[250:]) for k in names[250:]}}
    assert components(edges.limit(0)).count() == 0
