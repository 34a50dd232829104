"""Merkle manifest against a plain recursive tree."""

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from tessera.llm.merkle import Block, levels_of, manifest, op13_merkle_manifest, tampered_leaf, version

SCHEMA = "doc_id long, source string, lang string, n_chars int, text string"


def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def plain_leaf(*values):
    return H(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in values])


def plain_tree(nodes):
    """Top, and the siblings of every leaf by level."""
    owner, paths = list(range(len(nodes))), [[] for _ in nodes]
    while len(nodes) > 1:
        for i, at in enumerate(owner):
            start = at - at % 16
            paths[i].append(("".join(nodes[start:at]), "".join(nodes[at + 1 : start + 16])))
        nodes = [H(*nodes[i : i + 16]) for i in range(0, len(nodes), 16)]
        owner = [at // 16 for at in owner]
    return nodes[0], paths


def plain(rows):
    """Digest columns of the query, sorted, by the contract."""
    by = {}
    for row in rows:
        by.setdefault(row[1], []).append(row)
    order = sorted(by, key=lambda s: (s is not None, (s or "").encode()))
    trees = []
    for source in order:
        own = sorted(by[source], key=lambda r: (r[0] is not None, r[0] or 0, plain_leaf(*r)))
        trees.append((own, *plain_tree([plain_leaf(*r) for r in own])))
    root, over = plain_tree([t[1] for t in trees])
    out = []
    for (own, subroot, paths), up in zip(trees, over):
        for row, path in zip(own, paths):
            leaf = given = plain_leaf(*row)
            if row[0] is not None and zlib.crc32(str(row[0]).encode()) % 5 == 0 and row[4] is not None:
                given = plain_leaf(*row[:4], "".join(c.lower() if "A" <= c <= "Z" else c for c in row[4]))
            for left, right in path + up:
                given = H(left, given, right)
            out.append((row[0], leaf, subroot, root, H(*[a + b for a, b in path + up]), given, given == root))
    return sorted(out, key=repr)


def result(spark, rows, tmp_path):
    spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA + ", Leaf string, place int").write.parquet(str(tmp_path / "documents.parquet"))
    return sorted((tuple(r) for r in op13_merkle_manifest(spark, str(tmp_path)).collect()), key=repr)


def test_blocks_and_versions():
    rng = random.Random(3)
    for n in (1, 2, 16, 17, 255, 257, 600):
        leaves = [H(str(rng.random())) for _ in range(n)]
        top, paths = plain_tree(leaves)
        block = Block(leaves, levels_of(n))
        assert block.root == top and [block.beside(i) for i in range(n)] == paths
        i = rng.randrange(n)
        assert version(leaves[i], block.beside(i))[-1] == top
        changed = leaves[:i] + [H("other")] + leaves[i + 1 :]
        assert version(H("other"), block.beside(i))[-1] == plain_tree(changed)[0]


def test_hot_source_over_several_blocks(spark):
    rng = random.Random(1)
    rows = [(i * 3 - 50, rng.choice(["hot", "hot", "b", "é", None]), rng.choice([None, "en"]), i, rng.choice(["Abc dEf", "abc", "ÄÖ X", ""])) for i in range(700)]
    found = manifest(spark.createDataFrame(rows, SCHEMA), tampered_leaf(), block_levels=1).collect()  # blocks of 16 leaves
    digests = [(*r[:4], H(r.proof), r.folded_root, r.verified) for r in found]
    assert sorted(digests, key=repr) == plain(rows)


def test_many_sources(spark, tmp_path):
    rows = [(i, f"s{i % 41}", "en", 3, f"Text {i}") for i in range(300)]
    found = result(spark, rows, tmp_path)
    assert found == plain(rows) and {r[6] for r in found} == {True, False}


def test_nulls_repeats_and_single_rows(spark, tmp_path):
    rows = [(None, None, None, None, None), (None, "a", "x", 1, "T"), (5, "a", None, 1, None), (5, "a", None, 1, None), (5, "a", None, 1, "Z"), (5, "b", "", -1, "x" * 100_000)]
    assert result(spark, rows, tmp_path) == plain(rows)
    one = manifest(spark.createDataFrame([(1, "a", "b", 2, "C")], SCHEMA), F.lit("0" * 64)).first()
    assert one.proof == "" and one.root == one.subroot == one.leaf and one.folded_root == "0" * 64 and not one.verified
    assert manifest(spark.createDataFrame([], SCHEMA)).count() == 0


def test_an_untampered_table_is_verified(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    found = manifest(docs)
    assert found.count() == docs.count() and found.where("verified AND folded_root = root").count() == docs.count()
    changed = manifest(docs.withColumn("n_chars", F.col("n_chars") + 1))
    assert changed.first().root != found.first().root


@pytest.mark.parametrize("n, levels", [(0, 0), (1, 0), (2, 1), (16, 1), (17, 2), (257, 3), (4096, 3), (4097, 4)])
def test_levels(n, levels):
    assert levels_of(n) == levels
