"""Language ID: sums over segmentations against all of them, held-out accuracy, odd rows."""

import zlib

import numpy as np
import pytest

from tessera.llm import language
from tessera.llm.language import Pieces, expected, fit, forward, predict

SCHEMA = "doc_id long, lang string, text string, LANG_PRED string, score int"


def segmentations(word, known):
    if not word:
        yield []
    for k in range(1, len(word) + 1):
        if word[:k] in known:
            for rest in segmentations(word[k:], known):
                yield [known[word[:k]], *rest]


def test_forward_and_expected_counts_against_all_segmentations():
    pieces = Pieces(language.VOCABULARY)
    known = {p: i for i, p in enumerate(pieces.pieces)}
    rng = np.random.default_rng(1)
    table = np.vstack([rng.random((pieces.size, 2)) / 50, np.zeros((1, 2))])
    units = [b" thing", b"\xc3\xa9tion", b" aaaaa"]
    for unit in units:
        rows = np.frombuffer(unit, np.uint8)[None]
        places = pieces.places(rows)
        ways = list(segmentations(unit, known))
        assert len(ways) > 3
        for lang in range(2):
            mass = [np.prod(table[way, lang]) for way in ways]
            assert forward(places, table)[-1, 0, lang] == pytest.approx(sum(mass))
            want = np.zeros(pieces.size + 1)
            for way, m in zip(ways, mass):
                np.add.at(want, way, 3 * m / sum(mass))
            assert np.allclose(expected(places, table[:, lang : lang + 1], np.array([3.0])), want)


def test_long_words_sum_over_all_segmentations(monkeypatch):
    pieces = Pieces(language.VOCABULARY)
    known = {p: i for i, p in enumerate(pieces.pieces)}
    rng = np.random.default_rng(1)
    table = np.vstack([rng.random((pieces.size, 2)) / 5000, np.zeros((1, 2))])
    lifted = table * np.exp(language.LIFT * pieces.lengths)[:, None]
    units = [b" " + "".join(rng.choice(list("etaoinsréü漢字"), n)).encode() for n in (1, 5, 60, 300, 1500)]
    for limit in (language.PLACE_BYTES, 20_000):  # in one block of bytes, and in several
        monkeypatch.setattr(language, "PLACE_BYTES", limit)
        found = language.log_totals(pieces, lifted, units)
        for unit, got in zip(units, found):
            for lang in range(2):
                ahead = [0.0] + [-np.inf] * len(unit)
                for j in range(1, len(unit) + 1):
                    ways = [ahead[i] + np.log(table[known[unit[i:j]], lang]) for i in range(max(0, j - pieces.longest), j) if unit[i:j] in known]
                    ahead[j] = np.logaddexp.reduce(ways)
                assert got[lang] == pytest.approx(ahead[-1], rel=1e-9)


def test_rounds_raise_the_likelihood():
    counts = {"x": {"thing": 5, "other": 3, "nothing": 2, "éclair": 1}}
    pieces = Pieces(language.VOCABULARY)

    def total(table):
        return sum(n * np.log(forward(pieces.places(np.frombuffer((" " + w).encode(), np.uint8)[None]), table)[-1, 0, 0]) for w, n in counts["x"].items())

    found = [total(fit(counts, rounds=r)[1]) for r in (0, 1, 2, 4)]
    assert found[0] < found[1] <= found[3]


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    langs = {r.doc_id: r.lang for r in docs.select("doc_id", "lang").collect()}
    rows = predict(docs, fit_docs=100).collect()
    assert len(rows) == len(langs)
    held = [r for r in rows if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)
    assert sum(r.lang_pred == langs[r.doc_id] for r in held) >= 0.98 * len(held)
    assert all(0 <= r.score <= 1 for r in rows)


def test_odd_rows(spark):
    learn = [i for i in range(100) if zlib.crc32(str(i).encode()) % 3 != 1][:12]
    rows = [(i, ["en", "de"][k % 2], ["the thing and the other", "der Hund und die Katze"][k % 2], "x", 1) for k, i in enumerate(learn)]
    odd = [(900, None, "the thing and"), (901, "en", None), (902, None, ""), (903, None, "12 34 !!"), (None, None, "der Hund"), (904, None, "und " * 5000), (905, None, "x" * 3000), (904, None, "und " * 5000)]
    found = predict(spark.createDataFrame(rows + [(*r, "x", 1) for r in odd], SCHEMA)).collect()
    got = {r.doc_id: (r.lang_pred, r.score) for r in found}
    assert len(found) == 20
    assert got[901] == got[902] == got[903] == ("und", 0.0)
    assert got[900][0] == "en" and got[None][0] == got[904][0] == "de" and got[905][0] in ("en", "de")
    assert predict(spark.createDataFrame([], SCHEMA)).count() == 0
    blind = predict(spark.createDataFrame([(1, None, "some text", "x", 1)], SCHEMA)).first()
    assert (blind.lang_pred, blind.score) == ("und", 0.0)
