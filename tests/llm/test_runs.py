"""Periodic runs against a search of all periods and places."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from tessera.llm.runs import find_runs, op12_periodic_runs, periodic_runs

SF = "/root/testdata/sf0.001"


def plain_runs(words, least=6, times=4):
    """Every period: maximal stretches of equal words q apart, without those of a smaller period."""
    n, found = len(words), []
    for q in range(1, n // times + 1):
        i = 0
        while i < n - q:
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j < n - q and words[j] == words[j + q]:
                j += 1
            length = j + q - i
            smaller = any(all(words[x] == words[x + p] for x in range(i, i + length - p)) for p in range(1, q))
            if length >= max(least, times * q) and not smaller:
                found.append((i, length, q))
            i = j
    return sorted(found, key=lambda r: (r[0], r[2]))


def plain_digests(doc_id, text):
    """The columns of the query by the contract."""
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n, h = len(w), zlib.crc32(str(doc_id).encode())
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = w[:a] + [w[a + (i - a) % p] for i in range(a, n)]
    runs = plain_runs(w)
    gone = {i for s, length, q in runs for i in range(s + q, s + length)}
    best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=None)
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    listed = "".join(f"{s},{length},{q}\n" for s, length, q in runs)
    return (doc_id, len(runs), *(best or (None,) * 3), best and 1000 * best[1] // best[2], sha(listed), sha(" ".join(x for i, x in enumerate(w) if i not in gone)))


@pytest.mark.parametrize("letters", [1, 2, 3, 6])
def test_all_runs_are_found(letters):
    rng = random.Random(letters)
    for turn in range(120):
        words = [rng.randrange(letters) for _ in range(rng.randint(0, 60))]
        for _ in range(rng.randint(0, 3)):
            unit = [rng.randrange(letters) for _ in range(rng.randint(1, 12))]
            words += (unit * 9)[: rng.randint(1, 9 * len(unit))] + [rng.randrange(letters + 1)]
        got = sorted(find_runs(np.array(words, np.int64)), key=lambda r: (r[0], r[2]))
        assert got == plain_runs(words)
        assert sorted(find_runs(np.array(words, np.int64), 20, 3)) == sorted(plain_runs(words, 20, 3))
    with pytest.raises(ValueError):
        find_runs(np.zeros(9, np.int64), 6, 2)


def test_long_texts_take_little_more_than_linear_time():
    n = 1_000_000
    assert find_runs(np.zeros(n, np.int64)) == [(0, n, 1)]
    unit = np.random.default_rng(1).integers(0, 50, 7001)
    assert (0, 700_100, 7001) in find_runs(np.tile(unit, 100))


def test_query_against_the_contract(spark):
    texts = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    want = {d: plain_digests(d, t) for d, t in texts if len((t or "").split()) < 700}
    got = {r.doc_id: tuple(r) for r in op12_periodic_runs(spark, SF).collect()}
    assert len(got) == len(texts) and len(want) > 150
    assert {d: got[d] for d in want} == want
    assert sum(r[1] > 0 for r in got.values()) > 5


def test_odd_rows_on_a_table(spark, tmp_path):
    long = " ".join(["x y z"] * 3000)
    texts = [None, "", " \t\n", "one", "a a a a a a b", "ab\x1cab ab\x1cab " * 3, "é é " * 8, long, long]
    rows = [(i, t, "s", "z", 1) for i, t in enumerate(texts)] + [(None, "a b " * 9, "s", "z", 1), (7, "q " * 7, "s", "z", 1)]
    spark.createDataFrame(rows, "doc_id long, text string, runs string, TEXT2 string, start int").write.parquet(str(tmp_path / "documents.parquet"))
    got = [tuple(r) for r in op12_periodic_runs(spark, str(tmp_path)).collect()]
    want = [plain_digests(d, t) for d, t, *_ in rows[:7]] + [plain_digests(7, "q " * 7)]
    assert all(w in got for w in want) and len(got) == len(rows)
    none = next(r for r in got if r[0] is None)
    assert none[1:6] == (1, 0, 18, 2, 9000)
    found = periodic_runs(spark.read.parquet(str(tmp_path / "documents.parquet"))).where("n_words = 9000").collect()
    assert len(found) == 2 and all(r.collapsed == "x y z" and [tuple(x) for x in r.runs] == [(0, 9000, 3)] for r in found)
    assert periodic_runs(spark.createDataFrame([], "doc_id long, text string")).count() == 0
