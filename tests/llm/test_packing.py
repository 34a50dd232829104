"""Best-fit packing: exact round trip against the tokenizer, bounds, several rounds."""

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tessera.llm import packing
from tessera.llm.packing import Encoder, best_fit, best_fit_packing, pack

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(public_tokenizers.path(packing.VOCABULARY))


def test_encoder_agrees_with_the_tokenizer(tokenizer):
    texts = ["a\x1cb c", "<|endoftext|> x", "Straße ΣΑΣ é é ﬁ　İ", "don't we'LL 's 123 ½ x²", "﻿ab​cd\x85ef", "a ́b", "", " \n\t", "日本語 한국어 🙂!", "öx"]
    found = Encoder(public_tokenizers.path(packing.VOCABULARY))(texts)
    for text, ids in zip(texts, found):
        assert np.frombuffer(ids, "<u4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids


def check_sequences(rows, capacity):
    held = {}
    for r in rows:
        held.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in held.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    return len(held)


def test_round_trip(spark, tokenizer):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = best_fit_packing(docs).collect()
    by_doc = {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
    for d in docs.collect():
        ids = np.array(tokenizer.encode(d.text or "", add_special_tokens=False).ids + [packing.END], "<u4")
        parts = sorted(by_doc[d.doc_id], key=lambda r: r.piece)
        assert [p.piece for p in parts] == list(range(len(parts)))
        for p in parts:
            assert p.start == p.piece * packing.CAPACITY
            assert p.length == len(ids[p.start : p.start + packing.CAPACITY])
            assert p.ids_crc32 == zlib.crc32(ids[p.start : p.start + packing.CAPACITY].tobytes())
        assert sum(p.length for p in parts) == len(ids)
    least = -(-sum(r.length for r in rows) // packing.CAPACITY)
    assert check_sequences(rows, packing.CAPACITY) <= least + 2


def test_rounds_merge_what_is_left(spark):
    rng = random.Random(5)
    sizes = [rng.choice([30, 45, 52, 61, 70, 99, rng.randint(1, 100)]) for _ in range(3000)]
    found = spark.createDataFrame([(i, s) for i, s in enumerate(sizes)], "id long, length long")
    rows = pack(found, capacity=100, part_items=100, fan_in=3, slack=1).collect()
    assert sorted((r.id, r.length) for r in rows) == sorted(enumerate(sizes))
    n = check_sequences(rows, 100)
    alone = max(best_fit(sizes, 100)[0]) + 1
    assert n <= alone * 1.03 + 1


def test_sizes_that_do_not_combine(spark):
    found = spark.createDataFrame([(i, 3000) for i in range(500)], "id long, length long")
    rows = pack(found, part_items=50).collect()
    assert check_sequences(rows, 4096) == 500


def test_nulls_empty_ties_and_clashing_names(spark):
    schema = "sequence_id int, doc_id long, text string, TEXT2 string, piece string, offset string"
    rows = [(1, 1, None, "x", "a", "b"), (2, None, "", "x", "a", "b"), (3, 2, "w " * 9000, "x", "a", "b"), (3, 2, "w " * 9000, "x", "a", "b")]
    found = best_fit_packing(spark.createDataFrame(rows, schema))
    got = found.collect()
    assert sorted((r.doc_id or 0, r.piece, r.length) for r in got) == [(0, 0, 1), (1, 0, 1)] + [(2, 0, 4096)] * 2 + [(2, 1, 4096)] * 2 + [(2, 2, 809)] * 2
    check_sequences(got, 4096)
    assert best_fit_packing(spark.createDataFrame([], schema)).count() == 0
