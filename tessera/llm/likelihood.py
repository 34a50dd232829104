"""Masked pseudo-likelihood: a window network over both sides predicts every token; sums of log-probabilities score texts."""

from __future__ import annotations

import re
import uuid
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import chunks, held, keep, pick

#: What the network predicts: the most frequent words of the corpus each for itself, and classes of all other words by
#: the words they stand near. What it sees at the sides: these, words that are not hot by a hash of their ending, and the border.
FREQUENT = 63
CLASSES = 48
ENDINGS = 16
TARGETS = FREQUENT + CLASSES
BORDER = TARGETS + ENDINGS
SIDES = BORDER + 1
#: Letters of the short words that mark the words near them, the places where a word's mark is looked for, in order, and the mark of a word near none.
SHORT = 4
NEAR = (-1, 1, -2, 2)
UNMARKED = CLASSES - 1
#: Words that are at least one of so many in the corpus, so at most that many, are sent to all tasks with their counts, if they
#: occur so often that their marks say little of a single place, and have no more letters than this.
HOT = 500_000
LEAST = 8
LETTERS = 64
#: Log-probabilities within a class are whole multiples of 1 / GRAIN, so that their sums do not depend on the order.
GRAIN = 2.0**24
#: Tokens to either side that the network sees, and the size of its layer.
SIDE = 2
WIDTH = 16
#: Tokens that are scored at a time, and targets of a gradient step.
BATCH = 2048
STEP = 512
RATE = 0.6
ROUNDS = 4
#: Models that are merged by one task of a round.
MERGE = 64
#: Short words and endings that a Python worker remembers, bytes of texts and characters of a long text that are split at a
#: time, and tokens whose windows are held.
MEMORY = 200_000
PART = 8 * 1024 * 1024
SLICE = 1_000_000
FLUSH = 300_000
#: Exponentials of numbers less than this and their sums are well within the range of 32 bits.
LARGE = 60.0

_GAP = re.compile(r"\s")


def slices(text: str, size: int = SLICE) -> Iterator[str]:
    """The text in parts of about so many characters, cut at white space."""
    at = 0
    while at < len(text):
        cut = _GAP.search(text, at + size) if len(text) - at > size else None
        end = cut.start() if cut else len(text)
        yield text[at:end]
        at = end


class _Hashes(dict):
    """Hash of a text modulo `size`; remembers MEMORY texts."""

    def __init__(self, size: int) -> None:
        self.of = size

    def __missing__(self, text: str) -> int:
        found = zlib.crc32(text.encode("utf-8", "surrogatepass")) % self.of
        if len(self) < MEMORY:
            self[text] = found
        return found


def _words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """Where the words of each text end and begin, the number of each word, and the numbered words in lower case.

    Words are those of `str.lower` and `str.split`. A word can have several numbers, one for each spelling with capitals beyond ASCII.
    """
    # white space at the end of the last text could be taken for a word
    lists = pc.utf8_split_whitespace(pc.utf8_trim_whitespace(pc.ascii_lower(pc.fill_null(texts.cast(pa.string()), ""))))
    coded = lists.flatten().dictionary_encode()
    words, codes = coded.dictionary, coded.indices.to_numpy()
    bounds = lists.offsets.to_numpy()
    bounds = bounds - bounds[0]
    empty = pc.index(words, "").as_py()  # that of a text without words
    if empty >= 0:
        there = codes != empty
        bounds = np.concatenate(([0], np.cumsum(there)))[bounds]
        codes = codes[there]
    wide = pc.invert(pc.string_is_ascii(words))
    if pc.any(wide).as_py():
        words = pc.replace_with_mask(words, wide, pa.array([w.lower() for w in words.filter(wide).to_pylist()], pa.string()))
    return bounds, codes, words


class Reader:
    """Words of texts in lower case, with the mark of each: a hash of the first short word among those at the places NEAR it."""

    def __init__(self) -> None:
        self.short = _Hashes(UNMARKED)

    def _own(self, words: pa.Array) -> np.ndarray:
        own = np.full(len(words), -1, np.int8)
        at = np.flatnonzero(pc.less_equal(pc.utf8_length(words), SHORT).to_numpy(zero_copy_only=False))
        own[at] = [self.short[x] for x in words.take(pa.array(at)).to_pylist()]
        return own

    @staticmethod
    def _marks(line: np.ndarray) -> np.ndarray:
        """Marks of the words of a line but the two at either end, by the hashes of the short ones; -1 is no short word."""
        n = len(line) - 4
        marks = np.full(n, UNMARKED, np.int8)
        for d in reversed(NEAR):
            there = line[2 + d : 2 + d + n]
            marks = np.where(there >= 0, there, marks)
        return marks

    def read(self, texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray, pa.Array, np.ndarray]]:
        """Bounds of the texts, numbers of their words, the numbered words, and marks; a long text, alone, comes in parts.

        A part's marks know the words of its neighbours.
        """
        if len(texts) == 1 and len(text := texts[0].as_py() or "") > SLICE:
            yield from self._long(text)
            return
        bounds, codes, words = _words(texts)
        at = np.arange(len(codes)) + 2 * np.repeat(np.arange(1, len(texts) + 1), np.diff(bounds))
        line = np.full(len(codes) + 2 * len(texts) + 2, -1, np.int8)
        line[at] = self._own(words)[codes]
        yield bounds, codes, words, self._marks(line)[at - 2]

    def _long(self, text: str) -> Iterator[tuple[np.ndarray, np.ndarray, pa.Array, np.ndarray]]:
        def split():  # twice, so that only its marks are held
            return (_words(pa.array([part], pa.string())) for part in slices(text, SLICE))

        gap = np.full(2, -1, np.int8)
        marks = self._marks(np.concatenate((gap, *[self._own(words)[codes] for _, codes, words in split()], gap)))
        at = 0
        for bounds, codes, words in split():
            yield bounds, codes, words, marks[at : at + len(codes)]
            at += len(codes)

    def __call__(self, text: str | None) -> Iterator[tuple[list[str], np.ndarray]]:
        """The parts of one text."""
        for _, codes, words, marks in self.read(pa.array([text], pa.string())):
            if len(codes):
                yield words.take(pa.array(codes)).to_pylist(), marks


def _word_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held(None)
    read = Reader().read
    for batch in (part for whole in batches for part in chunks(whole, limit=PART)):
        for _, codes, words, marks in read(batch.column("text")):
            pairs, n = np.unique(codes * np.int64(CLASSES) + marks, return_counts=True)
            yield pa.record_batch({"word": words.take(pa.array(pairs // CLASSES)), "mark": pa.array((pairs % CLASSES).astype(np.int32)), "n": pa.array(n.astype(np.int64))})


def word_counts(docs: DataFrame) -> DataFrame:
    """word, mark, n, of, class: how often each word of all texts in lower case has each mark, how often it is there at all, and the mark it has most often.

    Counts are merged in parts of texts before the one shuffle, by the word; a word has CLASSES marks at most.
    """
    parts = pick(docs, "text").mapInArrow(_word_counts, "word string, mark int, n bigint").repartition("word")
    pairs = parts.groupBy("word", "mark").agg(F.sum("n").alias("n"))
    word = Window.partitionBy("word")
    most = F.max(F.col("n") * CLASSES + (CLASSES - 1 - F.col("mark"))).over(word)  # of marks as frequent the least
    return keep(pairs.select("word", "mark", "n", F.sum("n").over(word).alias("of"), (CLASSES - 1 - most % CLASSES).cast("int").alias("class")), "words")


class Vocabulary:
    """The frequent words, the hot ones with their classes and weights, and the share of each target in the corpus.

    The weight of a word is log P(word | class). A word that is neither frequent nor hot belongs to the
    class of its mark where it stands.
    """

    def __init__(self, frequent: list[str], hot: list[tuple[str, int, int]], sizes: np.ndarray, shares: np.ndarray) -> None:
        self.ids = {word: i for i, word in enumerate([*frequent, *[word for word, _, _ in hot]])}
        self.words = pa.array(list(self.ids), pa.string())
        self.target = np.array([*range(len(frequent)), *[FREQUENT + c for _, _, c in hot]], np.uint8)
        self.weight = np.array([0.0] * len(frequent) + [np.rint(np.log(n / sizes[c]) * GRAIN) / GRAIN for _, n, c in hot])
        self.sizes, self.shares = sizes, shares


def vocabulary(counts: DataFrame) -> tuple[Vocabulary, DataFrame]:
    """The vocabulary that goes to all tasks, and the weights of all other words as a table (word, mark, weight).

    Ties among frequent words go by the word. A word that is not hot is under 1 in HOT of all words, or very long, so no
    task of a join by the word gets many rows of one.
    """
    total = counts.agg(F.sum("n")).first()[0] or 0
    words = counts.where(F.col("mark") == F.col("class"))  # one row for each
    frequent = [(r["word"], r["of"]) for r in words.orderBy(F.desc("of"), "word").limit(FREQUENT).collect()]
    names = [word for word, _ in frequent]
    other = ~F.col("word").isin(names) if names else F.lit(True)
    hot = (F.col("of") * HOT >= total) & (F.col("of") >= LEAST) & (F.char_length("word") <= LETTERS)
    chosen = [(r["word"], r["of"], r["class"]) for r in words.where(other & hot).select("word", "of", "class").orderBy("word").collect()]
    rare = counts.where(other & ~hot).select("word", "mark", "n")
    sizes = np.zeros(CLASSES)
    for _, n, c in chosen:
        sizes[c] += n
    for r in rare.groupBy("mark").agg(F.sum("n").alias("n")).collect():
        sizes[r["mark"]] += r["n"]
    share = np.concatenate([[float(n) for _, n in frequent], np.zeros(FREQUENT - len(names)), sizes]) + 1
    size = F.get(F.array(*[F.lit(float(max(x, 1))) for x in sizes]), F.col("mark"))
    return Vocabulary(names, chosen, sizes, share / share.sum()), rare.select("word", "mark", (F.rint(F.log(F.col("n") / size) * GRAIN) / GRAIN).alias("weight"))


class Tokens:
    """What the network sees and predicts of texts."""

    def __init__(self, vocabulary: Vocabulary) -> None:
        self.vocabulary, self.reader, self.endings = vocabulary, Reader(), _Hashes(ENDINGS)
        self.target, self.weight = np.append(vocabulary.target, np.uint8(0)), np.append(vocabulary.weight, 0.0)  # the last is that of other words

    def _seen(self, words: pa.Array, ids: np.ndarray) -> np.ndarray:
        """What the network sees of each word: its target, or the hash of its ending."""
        seen = self.target[ids]
        rare = np.flatnonzero(ids < 0)
        endings = pc.utf8_slice_codeunits(words.take(pa.array(rare)), -3).dictionary_encode()
        hashes = np.array([TARGETS + self.endings[x] for x in endings.dictionary.to_pylist()], np.uint8)
        seen[rare] = hashes[endings.indices.to_numpy()]
        return seen

    def read(self, texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, tuple[np.ndarray, pa.RecordBatch]]]:
        """Bounds of the texts, their side and target tokens, the summed weights of each one's hot words, and its other words with their marks.

        The last are rows (word, mark, times) with the bounds of each text's. A long text, alone, comes in parts.
        """
        for bounds, codes, words, marks in self.reader.read(texts):
            ids = pc.fill_null(pc.index_in(words, value_set=self.vocabulary.words), -1).to_numpy()
            targets = self.target[ids][codes]
            rare = np.flatnonzero((ids < 0)[codes])
            targets[rare] = FREQUENT + marks[rare]
            weights = np.concatenate(([0.0], np.cumsum(self.weight[ids][codes])))[bounds]  # exact, as sums of multiples of 1 / GRAIN
            size = max(len(words), 1) * CLASSES
            text = np.searchsorted(bounds, rare, side="right") - 1
            pairs, times = np.unique((text * size + codes[rare] * np.int64(CLASSES)) + marks[rare], return_counts=True)
            ends = np.searchsorted(pairs, np.arange(len(bounds)) * size)
            pairs %= size
            others = {"word": words.take(pa.array(pairs // CLASSES)), "mark": pa.array((pairs % CLASSES).astype(np.int32)), "times": pa.array(times.astype(np.int64))}
            yield bounds, self._seen(words, ids)[codes], targets, np.diff(weights), (ends, pa.record_batch(others))

    def whole(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, tuple[np.ndarray, pa.RecordBatch]]:
        """The same of whole texts."""
        parts = list(self.read(texts))
        if len(parts) == 1:
            return parts[0]
        sides, targets, weights = (np.concatenate([p[k] for p in parts]) for k in (1, 2, 3))
        others = pa.Table.from_batches([p[4][1] for p in parts]).group_by(["word", "mark"]).aggregate([("times", "sum")])
        others = pa.RecordBatch.from_arrays([pc.cast(others[c], t).combine_chunks() for c, t in (("word", pa.string()), ("mark", pa.int32()), ("times_sum", pa.int64()))], ["word", "mark", "times"])
        return np.array([0, len(sides)]), sides, targets, weights.sum(keepdims=True), (np.array([0, others.num_rows]), others)

    def __call__(self, text: str | None) -> tuple[np.ndarray, np.ndarray, float, Counter]:
        """Side and target tokens of one text, the summed weights of its hot words, and its other words with their marks."""
        _, sides, targets, weight, (_, rows) = self.whole(pa.array([text], pa.string()))
        others = Counter()
        for r in rows.to_pylist():
            others[r["word"], r["mark"]] += r["times"]
        return sides, targets, float(weight[0]), others


def _binary(bounds: np.ndarray, values: np.ndarray) -> pa.Array:
    """Bytes of each text."""
    return pa.Array.from_buffers(pa.binary(), len(bounds) - 1, [None, pa.py_buffer(bounds.astype(np.int32)), pa.py_buffer(np.ascontiguousarray(values))])


def _tokens(model, name: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = held(name, lambda: Tokens(model.value))
        for batch in (part for whole in batches for part in chunks(whole, limit=PART)):
            bounds, sides, targets, weights, (ends, others) = tokens.whole(batch.column("text"))
            columns = {c: batch.column(c) for c in ("row", "doc_id")} | {
                "n_tokens": pa.array(np.diff(bounds).astype(np.int64)),
                "sides": _binary(bounds, sides),
                "targets": _binary(bounds, targets),
                "weight": pa.array(weights),
                "others": pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), others.to_struct_array()),
            }
            yield pa.record_batch(columns)

    return run


TOKENS = "n_tokens bigint, sides binary, targets binary, weight double, others array<struct<word: string, mark: int, times: bigint>>"

Network = dict[str, np.ndarray]


def start(shares: np.ndarray | None = None, seed: int = 3) -> Network:
    """Small random weights; without the sides the network predicts the targets' shares in the corpus."""
    rng = np.random.default_rng(seed)
    return {
        "near": rng.normal(0, 0.2, (2 * SIDE * SIDES, WIDTH)).astype(np.float32),
        "out": rng.normal(0, 0.1, (WIDTH, TARGETS)).astype(np.float32),
        "bias": (np.zeros(TARGETS) if shares is None else np.log(shares)).astype(np.float32),
    }


def flat(net: Network) -> np.ndarray:
    return np.concatenate([net[k].ravel() for k in ("near", "out", "bias")])


def shaped(values: np.ndarray) -> Network:
    net, at = start(), 0
    for k in ("near", "out", "bias"):
        net[k] = values[at : at + net[k].size].reshape(net[k].shape).astype(np.float32)
        at += net[k].size
    return net


def windows(sides: list[np.ndarray]) -> np.ndarray:
    """For every token of texts, the places in `near` of the 2 * SIDE tokens around it; beyond a text's ends is the border."""
    gap = np.full(SIDE, BORDER, np.uint8)
    line = np.concatenate([gap, *[x for t in sides for x in (t, gap)]])
    at = np.flatnonzero(line != BORDER)
    steps = [*range(-SIDE, 0), *range(1, SIDE + 1)]
    return np.stack([line[at + d].astype(np.int16) + k * SIDES for k, d in enumerate(steps)]).T


def _layer(near: np.ndarray, seen: np.ndarray) -> np.ndarray:
    """The layer, and a column of ones that takes the bias."""
    total = near.take(seen[:, 0], axis=0)
    for k in range(1, seen.shape[1]):
        total += near.take(seen[:, k], axis=0)
    layer = np.ones((len(seen), WIDTH + 1), near.dtype)
    np.tanh(total, out=layer[:, :WIDTH])
    return layer


def _logits(layer: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Logits by the rows of `out` and the bias, less the largest where their exponentials could leave the range; the layer is in -1 to 1."""
    logits = layer @ rows
    if not np.abs(rows).sum(axis=0).max() < LARGE:
        logits -= logits.max(axis=1, keepdims=True)
    return logits


def log_probs(net: Network, seen: np.ndarray, targets: np.ndarray) -> np.ndarray:
    """Log-probability of the targets, given what is seen around each."""
    found = np.empty(len(seen), np.float64)
    rows = np.vstack((net["out"], net["bias"]))
    ones = np.ones(rows.shape[1], rows.dtype)
    for a in range(0, len(seen), BATCH):
        logits = _logits(_layer(net["near"], seen[a : a + BATCH]), rows)
        target = logits[np.arange(len(logits)), targets[a : a + BATCH]]
        np.exp(logits, out=logits)
        found[a : a + BATCH] = target - np.log(logits @ ones)
    return found


class Trainer:
    """Gradient steps with a running scale for each weight."""

    def __init__(self, net: Network, rate: float = RATE) -> None:
        self.net, self.rate, self.seen = net, rate, 0
        self.rows = np.vstack((net["out"], net["bias"]))
        net["out"], net["bias"] = self.rows[:-1], self.rows[-1]  # the same memory, so that both are one product
        self.ones = np.ones(self.rows.shape[1], self.rows.dtype)
        self.scale = {k: np.full(v.shape, 1e-3, np.float32) for k, v in net.items()}
        self.held: list[tuple[np.ndarray, np.ndarray]] = []
        self.waiting = 0

    def add(self, seen: np.ndarray, targets: np.ndarray) -> None:
        """Takes targets with what is seen around them; makes steps when a batch is full."""
        self.held.append((seen, targets))
        self.waiting += len(targets)
        if self.waiting >= BATCH:
            self.flush()

    def flush(self) -> None:
        if self.held:
            seen, targets = (np.concatenate(x) for x in zip(*self.held))
            self.held, self.waiting = [], 0
            for a in range(0, len(seen), STEP):
                self.step(seen[a : a + STEP], targets[a : a + STEP])

    def step(self, seen: np.ndarray, targets: np.ndarray) -> None:
        net, n = self.net, len(seen)
        layer = _layer(net["near"], seen)
        p = _logits(layer, self.rows)
        np.exp(p, out=p)
        sums = p @ self.ones
        p[np.arange(n), targets] -= sums  # the gradient but for a factor of each row, which the narrow side of the products takes
        share = (1 / (sums * np.float32(n)))[:, None]
        back = (p @ net["out"].T) * (1 - layer[:, :WIDTH] ** 2) * share
        order = seen.T.ravel().astype(np.int32) * np.int32(seen.size) + np.arange(seen.size, dtype=np.int32)  # sorts faster than argsort
        order.sort()
        places, order = np.divmod(order, np.int32(seen.size))
        first = np.flatnonzero(np.concatenate(([True], places[1:] != places[:-1])))
        near = np.add.reduceat(back.take(order % n, axis=0), first, axis=0)
        used = places[first]
        scale = self.scale["near"].take(used, axis=0) + near * near
        self.scale["near"][used] = scale
        net["near"][used] -= self.rate * near / np.sqrt(scale)
        rows = (layer * share).T @ p
        for name, grad in (("out", rows[:-1]), ("bias", rows[-1])):
            self.scale[name] += grad * grad
            net[name] -= self.rate * grad / np.sqrt(self.scale[name])
        self.seen += n


def _parts(sides: np.ndarray, targets: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Windows and targets of a text, so many at a time; the windows know the tokens beyond."""
    for a in range(0, len(sides), FLUSH):
        b = min(a + FLUSH, len(sides))
        around = windows([sides[max(0, a - SIDE) : b + SIDE]])
        yield around[min(a, SIDE) :][: b - a], targets[a:b]


def _texts(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, bool]]:
    """Windows and targets of texts, FLUSH tokens at most, the bounds of the texts, and whether the last goes on in the next part."""
    sides, targets, n = [], [], 0

    def together():
        return windows(sides), np.concatenate(targets), np.concatenate(([0], np.cumsum([len(s) for s in sides]))), False

    for s, t in zip(batch.column("sides"), batch.column("targets")):
        s, t = np.frombuffer(s.as_buffer(), np.uint8), np.frombuffer(t.as_buffer(), np.uint8)
        if sides and n + len(s) > FLUSH:
            yield together()
            sides, targets, n = [], [], 0
        if len(s) > FLUSH:
            left = len(s)
            for seen, part in _parts(s, t):
                left -= len(part)
                yield seen, part, np.array([0, len(part)]), left > 0
        else:
            sides.append(s)
            targets.append(t)
            n += len(s)
    if sides:
        yield together()


def _train(values: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held(None)
        trainer = Trainer(shaped(values))
        for seen, targets, bounds, _ in (group for batch in batches for group in _texts(batch)):
            for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
                trainer.add(seen[a:b], targets[a:b])
        trainer.flush()
        yield _row(trainer.seen, flat(trainer.net))

    return run


def _row(n: int, values: np.ndarray) -> pa.RecordBatch:
    return pa.record_batch({"n": pa.array([n], pa.int64()), "net": pa.array([values.astype(np.float32).tobytes()], pa.binary())})


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Mean of the models, weighed by the targets they have seen."""
    total, n = 0.0, 0
    for batch in batches:
        for seen, data in zip(batch.column("n").to_pylist(), batch.column("net").to_pylist()):
            if seen:
                total, n = total + seen * np.frombuffer(data, np.float32).astype(np.float64), n + seen
    if n:
        yield _row(n, total / n)


MODEL = "n bigint, net binary"


def train(tokens: DataFrame, shares: np.ndarray, rounds: int = ROUNDS) -> np.ndarray:
    """Weights after rounds over disjoint parts of all documents, by a hash of the row; so each position is a target once.

    In a round each task starts from the same weights and trains on its rows; the models are averaged in a tree,
    a task merging MERGE of them, so the driver gets one.
    """
    values = flat(start(shares))
    rows = tokens.select("sides", "targets", F.pmod(F.xxhash64("row"), F.lit(rounds)).alias("part"))
    for turn in range(rounds):
        models = keep(rows.where(F.col("part") == turn).select("sides", "targets").mapInArrow(_train(values), MODEL), "models")
        tasks = models.count()
        while tasks > 1:
            tasks = -(-tasks // MERGE)
            models = keep(models.repartition(tasks).mapInArrow(_merge, MODEL), "models")
        row = models.first()
        if row and row.n:
            values = np.frombuffer(row.net, np.float32)
    return values


def _score(model, name: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net = held(name, lambda: shaped(model.value))
        for batch in batches:
            sums: list[float] = []
            begun = 0.0
            for seen, targets, bounds, more in _texts(batch):
                found = log_probs(net, seen, targets)
                sums.extend(float(found[a:b].sum()) for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist()))
                sums[-1] += begun
                begun = sums.pop() if more else 0.0
            values = np.array(sums) + batch.column("weight").to_numpy()
            yield pa.record_batch({**{c: batch.column(c) for c in ("row", "doc_id", "n_tokens")}, "log_likelihood": pa.array(values)})

    return run


def pseudo_likelihood(docs: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """One row per row of docs: doc_id, n_tokens, log_likelihood, mean_log_prob.

    The vocabulary is every word of the corpus in lower case, counted over all documents, and the network is trained
    on every position of all documents. log_likelihood sums, over every token of the whole text, the
    log-probability given the SIDE tokens before and after it; mean_log_prob is that by token. The FREQUENT most
    frequent words are predicted each for itself. Any other word is predicted in two levels: its class by the
    network, then the word within the class by its share there. The class of a hot word (at least one in HOT of
    all words, LEAST times) is the mark it has most often in the corpus, a mark being a hash of the short word next to it, before or
    after, or else two words away; any other word belongs, where it stands, to the class of its mark there, and its share is
    counted for word and mark. At the sides the network sees frequent words, classes of hot words, and others by
    their ending, none of which depends on the target. Texts are encoded once, as two bytes a token. Texts without words (null, empty,
    blank) have 0 tokens, 0.0 and a null mean. Null ids stay null, repeated rows come back alike, an empty table
    gives no rows; other columns are ignored.
    """
    docs = pick(docs, "doc_id", "text")
    known, rare = vocabulary(word_counts(docs))
    context = docs.sparkSession.sparkContext
    kind = docs.schema["doc_id"].dataType.simpleString()
    sent = context.broadcast(known)  # at most HOT words
    tokens = docs.withColumn("row", F.monotonically_increasing_id()).mapInArrow(_tokens(sent, uuid.uuid4().hex), f"row bigint, doc_id {kind}, {TOKENS}")
    # written, so that the numbers of the rows stay; words that are not hot go on as 64-bit hashes of word and mark
    hashed = F.transform("others", lambda x: F.struct(F.xxhash64(x["word"], x["mark"]).alias("pair"), x["times"].cast("int").alias("times")))
    tokens = keep(tokens.withColumn("others", hashed), "tokens")
    model = context.broadcast(train(tokens, known.shares, rounds))
    found = tokens.drop("others").mapInArrow(_score(model, uuid.uuid4().hex), f"row bigint, doc_id {kind}, n_tokens bigint, log_likelihood double")
    pairs = tokens.select("row", F.inline("others")).join(rare.select(F.xxhash64("word", "mark").alias("pair"), "weight"), "pair")
    sums = pairs.groupBy("row").agg(F.sum(F.col("times") * F.col("weight")).alias("more"))
    found = found.join(sums, "row", "left").select("doc_id", "n_tokens", (F.col("log_likelihood") + F.coalesce("more", F.lit(0.0))).alias("log_likelihood"))
    return found.withColumn("mean_log_prob", F.when(F.col("n_tokens") > 0, F.col("log_likelihood") / F.col("n_tokens")))


def op9_pseudo_likelihood(spark, sf_dir):
    return pseudo_likelihood(spark.read.parquet(f"{sf_dir}/documents.parquet"))
