"""Window packing: segment tree against a plain search, no padding, exact round trip against the tokenizer."""

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tessera.llm import windows
from tessera.llm.packing import Encoder
from tessera.llm.windows import best_fit_decreasing, close, pack_windows

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(public_tokenizers.path(windows.VOCABULARY))


def plain_rooms(sizes, capacity):
    """Rooms left by best-fit decreasing with a search through all windows."""
    rooms = []
    for size in sorted(sizes, reverse=True):
        fits = [i for i, room in enumerate(rooms) if room >= size]
        if fits:
            rooms[min(fits, key=lambda i: rooms[i])] -= size
        else:
            rooms.append(capacity - size)
    return sorted(rooms)


@pytest.mark.parametrize("capacity", [1, 7, 64, 100])
def test_tightest_window_is_found(capacity):
    rng = random.Random(capacity)
    for n in (0, 1, 5, 300):
        sizes = [rng.randint(1, capacity) for _ in range(n)]
        packed = best_fit_decreasing(sizes, capacity)
        assert sorted(i for w in packed for i in w) == list(range(n))
        assert sorted(capacity - sum(sizes[i] for i in w) for w in packed) == plain_rooms(sizes, capacity)


@pytest.mark.parametrize("sizes", [[], [1], [3], [64], [40] * 50, [33] * 3 + [1], [63, 62, 61, 60, 5], list(range(1, 64))])
def test_closed_windows_are_full_or_powers_of_two(sizes):
    closed = close(best_fit_decreasing(sizes, 64), sizes, 64)
    seen = [[] for _ in sizes]
    for window in closed:
        length = sum(part[2] for part in window)
        assert length == 64 or length & (length - 1) == 0
        for piece, start, n in window:
            assert n > 0
            seen[piece].append((start, n))
    for size, parts in zip(sizes, seen):
        at = 0
        for start, n in sorted(parts):
            assert start == at
            at += n
        assert at == size


def check(rows, texts, tokenizer, capacity):
    """Every document's ids once, checksums, gapless sequences without padding."""
    by_doc, by_sequence = {}, {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
        by_sequence.setdefault(r.sequence_id, []).append(r)
    assert set(by_doc) == set(texts)
    for doc_id, text in texts.items():
        ids = np.array(tokenizer.encode(text or "", add_special_tokens=False).ids + [windows.END], "<u4")
        at = 0
        for r in sorted(by_doc[doc_id], key=lambda r: r.start):
            assert r.start == at and r.doc_tokens == len(ids)
            assert r.ids_crc32 == zlib.crc32(ids[at : at + r.length].tobytes())
            at += r.length
        assert at == len(ids)
    for parts in by_sequence.values():
        at = 0
        for r in sorted(parts, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at == capacity or at & (at - 1) == 0


def test_query_round_trip(spark, tokenizer):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = windows.op11_window_packing(spark, SF).collect()
    check(rows, texts, tokenizer, 2048)
    assert len(rows) < len(texts) + sum(r.length for r in rows) / 1000


def test_many_partitions_and_sizes_that_do_not_combine(spark, tokenizer):
    texts = {i: "word " * (40 if i % 3 else 21) for i in range(300)}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    check(pack_windows(docs, capacity=64, part_items=40).collect(), texts, tokenizer, 64)


def test_nulls_empty_long_ties_and_clashing_names(spark, tokenizer):
    schema = "sequence_id int, doc_id long, text string, TEXT2 string, start string, text_hash string, cut int"
    long = "a b c " * 3000
    rows = [(1, 1, None, "x", "a", "b", 1), (2, None, "", "x", "a", "b", 1), (3, 2, long, "x", "a", "b", 1), (3, 2, long, "x", "a", "b", 1), (3, 2, "other", "x", "a", "b", 1)]
    docs = spark.createDataFrame(rows, schema)
    got = pack_windows(docs, capacity=100).collect()
    assert sum(r.length for r in got if r.doc_id == 2) == 2 * 9001 + 2
    assert [(r.start, r.length) for r in got if r.doc_id in (1, None)] == [(0, 1)] * 2
    lengths = {}
    for r in got:
        lengths[r.sequence_id] = lengths.get(r.sequence_id, 0) + r.length
    assert all(n == 100 or n & (n - 1) == 0 for n in lengths.values())
    ids = np.array(tokenizer.encode(long, add_special_tokens=False).ids + [1], "<u4")
    assert all(r.ids_crc32 == zlib.crc32(ids[r.start : r.start + r.length].tobytes()) for r in got if r.doc_id == 2 and r.doc_tokens == 9001)
    assert pack_windows(spark.createDataFrame([], schema)).count() == 0


def test_long_unspaced_texts_in_little_memory(tokenizer):
    encode = Encoder(public_tokenizers.path(windows.VOCABULARY))
    rng = random.Random(7)
    for letters in ("a", "etaoinshr", "abc1!", "漢字仮名交じり文", "éàüöß", "αβγΔΣσς", "가나다각"):
        for n in (2048, 2049, 9000):
            text = "".join(rng.choice(letters) for _ in range(n))
            assert np.frombuffer(encode([text])[0], "<u4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids
    resident = lambda: int(next(x for x in open("/proc/self/status") if x.startswith("VmHWM")).split()[1]) // 1024
    for text in ("abcdefghij" * 2_000_000, "ab\x1c cd" * 3_300_000):
        before = resident()
        assert len(encode([text])[0]) > 4_000_000
        assert resident() - before < 300
