"""Personal data: base spans against the patterns, the field against all cuts, what it adds, odd rows."""

import itertools
import random
import re
import time
import tracemalloc

import numpy as np
import pytest

from tessera.llm import pii
from tessera.llm.pii import KINDS, base_spans, candidates, decode, find, find_personal, luhn, marginals

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def brute(text):
    out = []
    for kind, pattern in PATTERNS.items():
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            if kind == "ip" and any(int(p) > 255 for p in m[0].split(".")):
                continue
            if kind == "card" and not (16 <= len(digits) <= 19 and luhn(digits)):
                continue
            if kind == "phone" and not 8 <= len(digits) <= 15:
                continue
            out.append((kind, m.start(), m.end()))
    return out


def test_base_spans_on_random_texts():
    rng = random.Random(3)
    cards = ["4532015112830366", "4532 0151 1283 0366", "4532-0151-1283-0366"]
    for _ in range(4000):
        text = "".join(rng.choice(["a", "1", "@", ".", "+", "-", " ", "(2)", "12.3", "1.2.3.4", "é", "0", "x.y", "4111 ", *cards]) for _ in range(rng.randint(0, 40)))
        assert base_spans(text) == brute(text)


def test_base_spans_take_linear_time():
    for make in (lambda n: "a" * n + "@", lambda n: "1" * n, lambda n: "1." * n, lambda n: "+1" + " " * n, lambda n: "a@" * n, lambda n: "1 " * n):
        assert base_spans(make(300)) == brute(make(300))
        began = time.process_time()
        base_spans(make(200_000))
        assert time.process_time() - began < 5


def cuts(n, segments):
    """All sets of segments that do not overlap."""
    for size in range(len(segments) + 1):
        for chosen in itertools.combinations(range(len(segments)), size):
            parts = sorted(segments[k][:2] for k in chosen)
            if all(a[1] <= b[0] for a, b in zip(parts, parts[1:])):
                yield chosen


def test_marginals_and_decoding_against_all_cuts():
    rng = np.random.default_rng(5)
    for _ in range(20):
        n = int(rng.integers(2, 7))
        spans = [(i, j, 0, 0) for i in range(n) for j in range(i + 1, n + 1) if rng.random() < 0.4][:7]
        scores = rng.normal(0, 2, (len(spans), len(KINDS)))
        total, mass, best = 0.0, np.zeros(scores.shape), (-1.0, None)
        for chosen in cuts(n, spans):
            for kinds in itertools.product(range(len(KINDS)), repeat=len(chosen)):
                score = sum(scores[k, t] for k, t in zip(chosen, kinds))
                total += np.exp(score)
                for k, t in zip(chosen, kinds):
                    mass[k, t] += np.exp(score)
                if score > best[0] or (best[1] is None and score >= 0):
                    best = (score, set(zip(chosen, kinds)))
        if spans:
            assert np.allclose(marginals(n, spans, scores), mass / total)
            assert set(decode(n, spans, scores)) == (best[1] or set())


def windows_of(texts):
    out = []
    for text in texts:
        for a, b in pii.windows(text):
            out.append((text[a:b], [(k, x - a, y - a) for k, x, y in base_spans(text) if a <= x and y <= b]))
    return out


@pytest.fixture(scope="module")
def texts(spark):
    return [r.text for r in spark.read.parquet("/root/testdata/sf0.1/documents.parquet").select("text").where("text rlike '[0-9@]'").limit(700).collect()]


def test_field_finds_other_forms_and_leaves_clean_texts(texts):
    field = pii.fit(windows_of(texts[:500]))
    assert ("email", 6, 32) in find("mail: bob.42 @ mail8.example.com yes", field)[1]
    assert ("card", 3, 22) in find("my 4041.8949.7460.8795 card", field)[1]
    for clean in ("version 2.0 of 2024-05-17 at 12:30 and 3.5%", "Licensed under CC BY-NC 4.0.", "in 1999 and 2004 there were 12 of 30", "no digits at all"):
        assert find(clean, field) == ([], [])
    stray = sum(len(find(t, field)[1]) for t in texts[500:])
    assert stray <= 0.02 * len(texts[500:])


def test_odd_rows(spark, texts):
    schema = "doc_id long, text string, SPANS string, n_email string, base int"
    rows = [(i, t, "x", "y", 1) for i, t in enumerate(texts[:60])]
    rows += [(900, None, "x", "y", 1), (901, "", "x", "y", 1), (902, "é a.b@c.de 10.0.0.1", "x", "y", 1), (None, "+1 (555) 010-9999", "x", "y", 1), (902, "é a.b@c.de 10.0.0.1", "x", "y", 1), (903, "9" * 3_000 + " a@b.cd " + "12 345,6\t" * 3000, "x", "y", 1)]
    found = find_personal(spark.createDataFrame(rows, schema)).collect()
    assert len(found) == len(rows)
    by_id = {r.doc_id: r for r in found}
    for i, text, *_ in rows:
        r = by_id[i]
        assert r.base == pii._said(brute(text or ""))
        assert set(r.base.split(",")) <= set(r.spans.split(",")) | {""}
    assert by_id[902].base == "email:2:10,ip:11:19" and by_id[900].spans == "" and by_id[903].n_email == 1 and by_id[None].n_phone == 1
    assert find_personal(spark.createDataFrame([], schema)).count() == 0


def test_segments_are_bounded():
    n, segments = candidates("1 " * 60, 0, 120)
    assert n == 120 and all(j - i <= pii.LONGEST for i, j, _, _ in segments)


def test_long_lines_are_cut_in_blocks(texts, monkeypatch):
    field = pii.fit(windows_of(texts[:300]))
    rng = random.Random(8)
    parts = ["card 4041.8949.7460.8795", "mail bob.42 @ mail8.example.com", "12.5", "in 1999", "4532 0151 1283 0366", "10.0.0.1", "77 of 90", "+1 555 010 9999", "2024-05-17"]
    text = " ".join(rng.choice(parts) for _ in range(900))
    assert len(pii.windows(text)) == 1 and sum(1 for _ in pii.stretches(text, 0, len(text))) > 5
    blocks = find(text, field)
    monkeypatch.setattr(pii, "WHOLE", 10**9)
    assert find(text, field) == blocks and len(blocks[1]) > 50
    covered = [0] * len(text)
    monkeypatch.setattr(pii, "WHOLE", 100)
    lines = text.replace("in 1999", "in\n1999")
    for a, b, first, last in pii.stretches(lines, 0, len(lines)):
        assert a <= first <= last <= b
        for i in range(first, last):
            covered[i] += 1
    assert set(covered) == {1}
    numbers = "12345 67.8 " * 3_000
    began = time.process_time()
    monkeypatch.setattr(pii, "WHOLE", 2000)
    tracemalloc.start()
    find(numbers, field)
    assert tracemalloc.get_traced_memory()[1] < 40_000_000 and time.process_time() - began < 300
    tracemalloc.stop()
