"""Masked pseudo-likelihood: marks, weights and sums against a plain reading, gradients, training, odd rows."""

import sys
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from tessera.llm import likelihood as ll
from tessera.llm.likelihood import Reader, Tokens, Trainer, flat, log_probs, pseudo_likelihood, shaped, start, vocabulary, windows, word_counts

SCHEMA = "doc_id long, text string, N_TOKENS int, mean_log_prob string"


def plain_marks(words):
    own = [zlib.crc32(w.encode()) % ll.UNMARKED if len(w) <= ll.SHORT else None for w in words]
    near = lambda i: [own[i + d] for d in (-1, 1, -2, 2) if 0 <= i + d < len(own) and own[i + d] is not None]
    return [(near(i) or [ll.UNMARKED])[0] for i in range(len(own))]


def brute(net, sides, targets):
    """Sum over all tokens, one after the other."""
    line = [ll.BORDER] * ll.SIDE + list(sides) + [ll.BORDER] * ll.SIDE
    total = 0.0
    for i, target in enumerate(targets):
        around = [line[i + ll.SIDE + d] for d in (-2, -1, 1, 2)]
        layer = np.tanh(sum(net["near"][int(s) + k * ll.SIDES].astype(float) for k, s in enumerate(around)))
        logits = layer @ net["out"] + net["bias"]
        total += logits[target] - np.log(np.exp(logits).sum())
    return total


def test_sums_over_every_token_and_both_sides(monkeypatch):
    net = start(seed=5)
    rng = np.random.default_rng(2)
    sides = [rng.integers(0, ll.BORDER, n).astype(np.uint8) for n in (1, 2, 7, 40)]
    targets = [rng.integers(0, ll.TARGETS, len(s)).astype(np.uint8) for s in sides]
    seen, at = windows(sides), 0
    for s, t in zip(sides, targets):
        want = brute(net, s, t)
        assert log_probs(net, seen[at : at + len(t)], t).sum() == pytest.approx(want, rel=1e-4)
        at += len(t)
        monkeypatch.setattr(ll, "FLUSH", 3)  # a long text is read in parts
        assert sum(log_probs(net, *part).sum() for part in ll._parts(s, t)) == pytest.approx(want, rel=1e-4)
    assert np.array_equal(flat(shaped(flat(net))), flat(net))


def test_steps_follow_the_gradient():
    rng = np.random.default_rng(3)
    sides, targets = rng.integers(0, ll.BORDER, 60).astype(np.uint8), rng.integers(0, ll.TARGETS, 60).astype(np.uint8)
    seen, net = windows([sides]), start(seed=1)
    trainer = Trainer({k: v.copy() for k, v in net.items()}, rate=1.0)
    trainer.scale = {k: np.full(v.shape, 1e12, np.float32) for k, v in net.items()}  # a step is the gradient / 1e6
    trainer.step(seen, targets)
    for name in net:
        slope = (net[name].astype(float) - trainer.net[name]) * 1e6
        for at in [np.unravel_index(i, net[name].shape) for i in rng.integers(0, net[name].size, 12)]:
            sums = []
            for step in (1e-2, -1e-2):
                moved = {k: v.astype(np.float64) for k, v in net.items()}
                moved[name][at] += step
                sums.append(-log_probs(moved, seen, targets).mean())
            assert slope[at] == pytest.approx((sums[0] - sums[1]) / 2e-2, abs=0.05)


def test_training_raises_the_likelihood():
    rng = np.random.default_rng(3)
    line = np.tile(rng.integers(0, 30, 10), 40).astype(np.uint8)
    seen, net = windows([line]), start(seed=1)
    before = log_probs(net, seen, line).mean()
    trainer = Trainer(net)
    for _ in range(30):
        trainer.add(seen, line)
        trainer.flush()
    assert log_probs(net, seen, line).mean() > before + 1.5 and trainer.seen == 30 * 400


def test_marks_of_words_also_in_long_texts(monkeypatch):
    text = "The house of X stands beside a lake\nand another HOUSE stands éa " * 30
    words = text.lower().split()
    want = plain_marks(words)
    assert [m for _, marks in Reader()(text) for m in marks] == want
    monkeypatch.setattr(ll, "SLICE", 40)
    parts = list(Reader()(text))
    assert len(parts) > 5 and [w for p in parts for w in p[0]] == words and [m for p in parts for m in p[1]] == want
    assert list(Reader()(None)) == [] and [len(w) for w, _ in Reader()(" ")] in ([], [0])


def test_scores_tell_text_from_shuffled_words(spark):
    rows = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text").collect()
    rng = np.random.default_rng(4)
    extra = []
    for r in rows[:80]:
        w = r.text.split()
        if len(w) > 100:
            rng.shuffle(w)
            extra.append((10_000 + r.doc_id, " ".join(w)))
    given = [(r.doc_id, r.text) for r in rows] + extra
    found = {r.doc_id: r for r in pseudo_likelihood(spark.createDataFrame(given, "doc_id long, text string")).collect()}
    assert len(found) == len(rows) + len(extra)
    assert all(found[r.doc_id].n_tokens == len(r.text.split()) for r in rows)
    seen = Counter(w for _, text in given for w in text.lower().split())
    total = sum(seen.values())
    shares = {r.doc_id: np.mean([np.log(seen[w] / total) for w in r.text.lower().split()]) for r in rows if found[r.doc_id].n_tokens}
    assert np.mean([found[i].mean_log_prob for i in shares]) > np.mean(list(shares.values())) + 0.5  # what the sides are worth
    better = [found[i - 10_000].mean_log_prob > found[i].mean_log_prob for i, _ in extra]
    assert np.mean(better) > 0.8


def test_odd_rows(spark):
    rows = [(1, None), (2, ""), (3, " \n"), (None, "a b"), (4, "a b"), (4, "a b"), (5, "word " * 3000)]
    found = pseudo_likelihood(spark.createDataFrame([(*r, 1, "x") for r in rows], SCHEMA)).collect()
    got = sorted(((r.doc_id or 0), r.n_tokens, r.mean_log_prob is None) for r in found)
    assert got == [(0, 2, False), (1, 0, True), (2, 0, True), (3, 0, True), (4, 2, False), (4, 2, False), (5, 3000, False)]
    assert pseudo_likelihood(spark.createDataFrame([], SCHEMA)).count() == 0


def test_every_word_has_its_own_probability(spark, monkeypatch):
    rng = np.random.default_rng(6)
    ending = ["ing", "éa", "日本語", "z", "xy"]
    words = [f"w{i}{ending[i % 5]}" for i in range(600)] + ["日本語", "z", "xy", "é"]
    texts = [" ".join(rng.choice(words, rng.integers(1, 60))) for _ in range(80)] + [None, " "]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    seen, marked = Counter(), Counter()
    for t in texts:
        own = (t or "").split()
        seen.update(own)
        marked.update(zip(own, plain_marks(own)))
    counted = word_counts(docs)
    values = flat(start())
    monkeypatch.setattr(ll, "train", lambda *_: values)
    for hot, least in ((10**9, 1), (700, 1), (10**9, 5), (1, 1)):  # every word is hot, some are, none is
        monkeypatch.setattr(ll, "HOT", hot)
        monkeypatch.setattr(ll, "LEAST", least)
        known, rare = vocabulary(counted)
        frequent = sorted(seen, key=lambda w: (-seen[w], w))[: ll.FREQUENT]
        assert list(known.ids)[: ll.FREQUENT] == frequent
        hot_words = {w for w in seen if w not in frequent and seen[w] * hot >= sum(seen.values()) and seen[w] >= least}
        assert set(known.ids) == set(frequent) | hot_words
        own_class = {w: min((m for v, m in marked if v == w), key=lambda m: (-marked[w, m], m)) for w in hot_words}
        sizes = Counter()
        for w in hot_words:
            sizes[own_class[w]] += seen[w]
        pairs = {p: n for p, n in marked.items() if p[0] not in known.ids}
        for (_, m), n in pairs.items():
            sizes[m] += n
        assert {(r.word, r.mark): r.weight for r in rare.collect()} == pytest.approx({p: np.log(n / sizes[p[1]]) for p, n in pairs.items()}, abs=1e-6)
        shares = np.array([*[seen[w] for w in frequent], *[sizes[c] for c in range(ll.CLASSES)]]) + 1.0
        assert known.shares == pytest.approx(shares / shares.sum())
        for r in pseudo_likelihood(docs).collect():
            own = (texts[r.doc_id] or "").split()
            marks, sides, targets, more = plain_marks(own), [], [], 0.0
            for w, m in zip(own, marks):
                if w in frequent:
                    sides.append(frequent.index(w))
                    targets.append(frequent.index(w))
                elif w in hot_words:
                    sides.append(ll.FREQUENT + own_class[w])
                    targets.append(ll.FREQUENT + own_class[w])
                    more += np.log(seen[w] / sizes[own_class[w]])
                else:
                    sides.append(ll.TARGETS + zlib.crc32(w[-3:].encode()) % ll.ENDINGS)
                    targets.append(ll.FREQUENT + m)
                    more += np.log(marked[w, m] / sizes[m])
            assert r.n_tokens == len(own) and r.log_likelihood == pytest.approx(brute(shaped(values), sides, targets) + more, rel=1e-4, abs=1e-5)


def test_what_is_seen_does_not_depend_on_the_target():
    tokens = Tokens(ll.Vocabulary(["the"], [], np.ones(ll.CLASSES), np.ones(ll.TARGETS)))
    a, b = tokens("the big house of one man")[0], tokens("the big house zebra one man")[0]
    assert [x for i, x in enumerate(a) if i != 3] == [x for i, x in enumerate(b) if i != 3]


def test_every_position_is_a_target_once(spark, monkeypatch):
    tokens = Tokens(ll.Vocabulary([], [], np.ones(ll.CLASSES), np.ones(ll.TARGETS)))
    texts = ["one", "a b c " * 9000, None, "x y"]
    found = [tokens(t) for t in texts]
    batch = pa.record_batch({"sides": pa.array([f[0].tobytes() for f in found], pa.binary()), "targets": pa.array([f[1].tobytes() for f in found], pa.binary())})
    taken = []
    monkeypatch.setattr(Trainer, "step", lambda self, seen, targets: taken.append(len(targets)) or setattr(self, "seen", self.seen + len(targets)))
    monkeypatch.setattr(ll, "FLUSH", 1000)
    (row,) = ll._train(flat(start()))(iter([batch]))
    assert row.column("n")[0].as_py() == sum(taken) == sum(len((t or "").split()) for t in texts) and max(taken) <= ll.STEP
    rows = spark.range(1000)
    from pyspark.sql import functions as F

    parts = rows.groupBy(F.pmod(F.xxhash64("id"), F.lit(ll.ROUNDS)).alias("p")).count().collect()
    assert sum(r["count"] for r in parts) == 1000 and len(parts) == ll.ROUNDS


def _batch(texts):
    numbers = pa.array(range(len(texts)), pa.int64())
    return pa.record_batch({"row": numbers, "doc_id": numbers, "text": pa.array(texts, pa.string())})


def _python_calls(run):
    """How many functions Python calls."""
    calls = 0

    def count(frame, event, arg):
        nonlocal calls
        calls += event in ("call", "c_call")

    sys.setprofile(count)
    try:
        run()
    finally:
        sys.setprofile(None)
    return calls


def test_words_are_not_handled_one_by_one():
    text = "The house of one man stands beside another lake " * 10
    known = ll.Vocabulary(["the"], [("house", 5, 1)], np.ones(ll.CLASSES), np.ones(ll.TARGETS))

    class Sent:
        value = known

    def steps(texts):
        return _python_calls(lambda: list(ll._word_counts(iter([_batch(texts)])))), _python_calls(lambda: list(ll._tokens(Sent, "calls")(iter([_batch(texts)]))))

    steps([text])
    for few, many in zip(steps([text] * 4), steps([text * 50] * 4)):
        assert many < few + 100  # 17,640 words more


def test_words_are_counted_with_one_shuffle(spark):
    counted = []
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(ll, "keep", lambda df, _: counted.append(df) or df)
        word_counts(spark.createDataFrame([(1, "a b")], "doc_id long, text string"))
    (df,) = counted
    df.collect()
    assert df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0].count("Exchange hashpartitioning") == 1


def test_texts_together_and_in_parts(monkeypatch):
    rng = np.random.default_rng(8)
    lines = [rng.integers(0, ll.TARGETS, n).astype(np.uint8) for n in (3, 0, 40, 7, 95, 1, 0, 30, 31, 0)]
    data = pa.array([x.tobytes() for x in lines], pa.binary())
    numbers = pa.array(range(len(lines)), pa.int64())
    batch = pa.record_batch({"row": numbers, "doc_id": numbers, "n_tokens": numbers, "sides": data, "targets": data, "weight": pa.array([0.5] * len(lines))})
    monkeypatch.setattr(ll, "FLUSH", 30)

    class Sent:
        value = flat(start(seed=5))

    (found,) = ll._score(Sent, "parts")(iter([batch]))
    net = start(seed=5)
    assert found.column("log_likelihood").to_pylist() == pytest.approx([brute(net, x, x) + 0.5 for x in lines], rel=1e-4)
    taken = []
    monkeypatch.setattr(Trainer, "add", lambda self, seen, targets: taken.append((seen, targets)))
    list(ll._train(flat(net))(iter([batch])))
    assert np.array_equal(np.concatenate([s for s, _ in taken]), windows(lines)) and np.array_equal(np.concatenate([t for _, t in taken]), np.concatenate(lines))


def test_words_are_those_of_python(monkeypatch):
    rng = np.random.default_rng(7)
    signs = [*"aB.x1", *"éÉΣσİßẞ日Ω", "K", "́", "ǅ", "\U00010400", "​", "\0", *" \n\t\v\x1c\x1f\x85\xa0 　"]
    known = ll.Vocabulary(["a", "é"], [("b", 3, 2), ("σ", 5, 7)], np.full(ll.CLASSES, 50.0), np.ones(ll.TARGETS))
    for turn in range(200):
        texts = [None, "", " ", *["".join(rng.choice(signs, rng.integers(1, 120))) for _ in range(5)], "a \x1f\x85"]
        if turn % 2:
            monkeypatch.setattr(ll, "SLICE", 7)  # a text alone is long
            texts = texts[-1 - turn % 3 :][:1]
        want, others = Counter(), []
        for t in texts:
            own = (t or "").lower().split()
            pairs = list(zip(own, plain_marks(own)))
            want.update(pairs)
            others.append(Counter(p for p in pairs if p[0] not in known.ids))
        got = Counter()
        for part in ll._word_counts(iter([_batch(texts)])):
            for r in part.to_pylist():
                got[r["word"], r["mark"]] += r["n"]
        assert got == want

        class Sent:
            value = known

        rows = [r for part in ll._tokens(Sent, f"odd {turn}")(iter([_batch(texts)])) for r in part.to_pylist()]
        for t, r, rare in zip(texts, rows, others, strict=True):
            own = (t or "").lower().split()
            found = Counter()
            for x in r["others"]:
                found[x["word"], x["mark"]] += x["times"]
            assert found == rare and r["n_tokens"] == len(own)
            assert list(r["sides"]) == [known.target[known.ids[w]] if w in known.ids else ll.TARGETS + zlib.crc32(w[-3:].encode()) % ll.ENDINGS for w in own]
            assert list(r["targets"]) == [known.target[known.ids[w]] if w in known.ids else ll.FREQUENT + m for w, m in zip(own, plain_marks(own))]
            assert r["weight"] == sum(known.weight[known.ids[w]] for w in own if w in known.ids)
            assert Tokens(known)(t)[3] == rare
        monkeypatch.undo()


def test_large_weights_stay_in_range():
    rng = np.random.default_rng(9)
    line = rng.integers(0, ll.TARGETS, 50).astype(np.uint8)
    net = {k: v * np.float32(400) for k, v in start(seed=2).items()}
    net["bias"] += np.float32(300)
    found = log_probs(net, windows([line]), line)
    layer = np.tanh(net["near"].astype(float)[windows([line])].sum(axis=1))
    logits = layer @ net["out"] + net["bias"]
    logits -= logits.max(axis=1, keepdims=True)
    assert found == pytest.approx(logits[np.arange(50), line] - np.log(np.exp(logits).sum(axis=1)), rel=1e-3, abs=1e-2)
    trainer = Trainer(net)
    trainer.step(windows([line]), line)
    assert all(np.isfinite(v).all() for v in trainer.net.values())
