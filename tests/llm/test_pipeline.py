"""The pipeline stage by stage, each on what the one before kept, against brute force on whole small tables."""

import re

import pytest

import corpus_pipeline
from tessera.llm.common import keep
from tessera.llm.mixing import mix

SF = "/root/testdata/sf0.001"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


@pytest.fixture(scope="module")
def kept(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    odd = [(900001, None, "en", "src0", 0), (900002, "", "en", None, 0), (900003, "12 34 !!", None, "src0", 8), (None, "the thing and the other " * 9, None, "src1", 216)]
    docs = keep(docs.union(spark.createDataFrame(odd, docs.schema)).union(docs.limit(3)), "docs")
    found = [docs]
    for name, stage in corpus_pipeline.STAGES:
        found.append(keep(stage(spark, found[-1], SF), name))
    return found


def rows(df):
    return [tuple(r) for r in df.collect()]


def test_stages_are_the_five_in_order():
    assert [name for name, _ in corpus_pipeline.STAGES] == ["language_id", "exact_dedup", "ngram_jaccard", "mix_sources", "pack"]
    assert corpus_pipeline.ORACLE_SQL is None


def test_columns(kept):
    for df in kept[1:-1]:
        assert df.dtypes == kept[0].dtypes


def test_language_drops_texts_without_letters_alone(kept):
    assert sorted(rows(kept[1]), key=repr) == sorted((r for r in rows(kept[0]) if r[1] and re.search(r"[^\W\d_]", r[1])), key=repr)


def test_exact_copies(kept):
    best = {}
    for r in rows(kept[1]):
        key = r[1].translate(LOWER)
        best[key] = max(best.get(key, -1), -1 if r[0] is None else r[0])
    want = [r for r in rows(kept[1]) if best[r[1].translate(LOWER)] == (-1 if r[0] is None else r[0])]
    assert sorted(rows(kept[2]), key=repr) == sorted(want, key=repr)


def test_near_copies(kept):
    docs = rows(kept[2])
    sets = []
    for r in docs:
        w = (r[1] or "").encode().lower().split()
        sets.append({tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set())
    root = list(range(len(docs)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(docs)):
        for b in range(a):
            common = len(sets[a] & sets[b])
            if common and 100 * common >= 75 * len(sets[a] | sets[b]):
                root[find(a)] = find(b)
    least = {}
    for k, r in enumerate(docs):
        if r[0] is not None:
            least[find(k)] = min(least.get(find(k), r[0]), r[0])
    want = [r for k, r in enumerate(docs) if least.get(find(k)) == r[0] or least.get(find(k)) is None]
    assert sorted(rows(kept[3]), key=repr) == sorted(want, key=repr)


def test_mixing_returns_the_words_taken(kept):
    before = {}
    for r in rows(kept[3]):
        before.setdefault((r[0], r[3]), []).append(r)
    taken, words = {}, {}
    for r in rows(kept[4]):
        assert r[4] == len(r[1])
        taken[r[0], r[3]] = taken.get((r[0], r[3]), 0) + len(re.findall(r"[^\x20\x09-\x0D]+", r[1]))
        words.setdefault((r[0], r[3]), []).append(r[1])
    want = {}
    for r in mix(kept[3], carried=("source",)).collect():
        if r.taken:
            want[r.doc_id, r.source] = want.get((r.doc_id, r.source), 0) + r.taken
    assert taken == want
    for key, texts in words.items():
        assert len(texts) <= 2 * len(before[key])
        whole = {w for r in before[key] for w in r[1].split()}
        assert all(w in whole for t in texts for w in t.split())


def test_packing_holds_every_row(kept):
    starts = kept[5].where("piece = 0").groupBy("doc_id").count().collect()
    assert {r.doc_id: r["count"] for r in starts} == {r.doc_id: r["count"] for r in kept[4].groupBy("doc_id").count().collect()}
    fill = {r.sequence_id: r["sum(length)"] for r in kept[5].groupBy("sequence_id").sum("length").collect()}
    assert max(fill.values()) <= 4096 and len(fill) <= -(-sum(fill.values()) // 4096) + 2


def test_run(spark):
    found = corpus_pipeline.run(spark, SF)
    assert found.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    assert found.count() > 0
