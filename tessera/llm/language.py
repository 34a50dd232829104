"""Language ID by unigram pieces, summed over all segmentations of each word."""

from __future__ import annotations

import base64
import re
import uuid
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import chunks, held, least_hashes, pick

VOCABULARY = "byte_bpe_multi_50k.tiktoken"
#: Documents of each language that the model is fitted on, those of the least hashes.
FIT_DOCS = 1000
ROUNDS = 4
#: Bytes of the words that are learned from; longer ones are only scored.
FIT_BYTES = 40
#: A piece's probability counts e to the power of LIFT for each of its bytes while it is summed, so that sums stay numbers;
#: they are brought back to 1 every SCALED bytes.
LIFT = 4.0
SCALED = 16
#: Bytes of places of pieces held at a time.
PLACE_BYTES = 8 * 1024 * 1024
SMOOTH = 0.05
#: Words whose scores a Python worker remembers.
MEMORY = 300_000
UNKNOWN = "und"

_LETTERS = re.compile(r"[^\W\d_]+")
_BASE = np.uint64(0x9E3779B97F4A7C15)


class Pieces:
    """The pieces of a vocabulary that words in lower case can be made of; every byte is one."""

    def __init__(self, vocabulary: str) -> None:
        with open(public_tokenizers.path(vocabulary), "rb") as lines:
            found = {base64.b64decode(line.split()[0]) for line in lines}
        spelt = re.compile(rb" ?[a-z\x80-\xff]+| ")
        self.pieces = sorted({p for p in found if spelt.fullmatch(p)} | {bytes([b]) for b in range(256)}, key=lambda p: (len(p), p))
        self.size, self.longest = len(self.pieces), len(self.pieces[-1])
        self.lengths = np.array([*map(len, self.pieces), 0])
        self.tables = []
        for length in range(1, self.longest + 1):
            ids = np.array([i for i, p in enumerate(self.pieces) if len(p) == length], np.int32)
            rows = np.frombuffer(b"".join(self.pieces[i] for i in ids), np.uint8).reshape(len(ids), length)
            hashes = np.zeros(len(ids), np.uint64)
            for k in range(length):
                hashes = (hashes + rows[:, k] + np.uint64(1)) * _BASE
            order = np.argsort(hashes)
            self.tables.append((hashes[order], ids[order]))

    def places(self, units: np.ndarray) -> list[np.ndarray]:
        """For units of one length (rows of bytes): by piece length, the piece that starts at each byte, or `size` for none."""
        n, length = units.shape
        hashes, found = np.zeros((n, length), np.uint64), []
        for k in range(1, min(self.longest, length) + 1):
            hashes = (hashes[:, : length - k + 1] + units[:, k - 1 :] + np.uint64(1)) * _BASE
            known, ids = self.tables[k - 1]
            if not len(known):
                found.append(np.full(hashes.shape, self.size, np.int32))
                continue
            at = np.minimum(np.searchsorted(known, hashes), len(known) - 1)
            found.append(np.where(known[at] == hashes, ids[at], np.int32(self.size)))
        return found


def forward(places: list[np.ndarray], table: np.ndarray) -> np.ndarray:
    """Sum over all segmentations of the product of piece probabilities, up to each byte: [byte, unit, language]."""
    n, length = places[0].shape
    sums = np.zeros((length + 1, n, table.shape[1]))
    sums[0] = 1
    for j in range(1, length + 1):
        for k in range(1, min(len(places), j) + 1):
            sums[j] += sums[j - k] * table[places[k - 1][:, j - k]]
    return sums


def expected(places: list[np.ndarray], table: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Expected counts of the pieces in weighted units, over all segmentations (one language)."""
    n, length = places[0].shape
    ahead = forward(places, table)[..., 0]
    back = np.zeros((length + 1, n))
    back[length] = 1
    counts = np.zeros(len(table))
    scale = weights / ahead[length]
    for i in range(length - 1, -1, -1):
        for k in range(1, min(len(places), length - i) + 1):
            part = table[places[k - 1][:, i], 0] * back[i + k]
            back[i] += part
            counts += np.bincount(places[k - 1][:, i], part * ahead[i] * scale, len(table))
    return counts


def units_of(text: str) -> list[str]:
    return _LETTERS.findall(text.lower())


def _as_bytes(word: str) -> bytes:
    return b" " + word.encode("utf-8", "surrogatepass")


def log_totals(pieces: Pieces, lifted: np.ndarray, units: list[bytes]) -> np.ndarray:
    """Log of the sum over all segmentations of each unit, of any length: [unit, language].

    lifted holds the piece probabilities, lifted by their bytes. Short units are summed by length. In longer ones sums go
    from byte to byte to the ends of the pieces that start there, so that as many states are held as the
    longest piece has bytes; the bytes are looked up some at a time.
    """
    found = np.zeros((len(units), lifted.shape[1]))
    short = [i for i, unit in enumerate(units) if len(unit) <= FIT_BYTES]
    for part, rows in _by_length([units[i] for i in short]):
        found[np.array(short)[part]] = np.log(forward(pieces.places(rows), lifted)[-1]) - LIFT * rows.shape[1]
    order = sorted((i for i, unit in enumerate(units) if len(unit) > FIT_BYTES), key=lambda i: len(units[i]))
    at = 0
    while at < len(order):
        n = 1
        while at + n < len(order) and (n + 1) * (len(units[order[at + n]]) + pieces.longest) * 4 * pieces.longest <= PLACE_BYTES:
            n += 1
        part = order[at : at + n]
        found[part] = _batch_totals(pieces, lifted, [units[i] for i in part])
        at += n
    return found


def _batch_totals(pieces: Pieces, lifted: np.ndarray, units: list[bytes]) -> np.ndarray:
    n, languages, ring = len(units), lifted.shape[1], pieces.longest + 1
    lengths = np.array([len(u) for u in units])
    longest = int(lengths[-1])
    width = max(1, min(longest, PLACE_BYTES // (4 * pieces.longest * n)))
    states, scale, out = np.zeros((ring, n, languages)), np.zeros(n), np.zeros((n, languages))
    states[0] = 1.0
    for a in range(0, longest, width):
        rows = np.frombuffer(b"".join(u[a : a + width + pieces.longest].ljust(width + pieces.longest, b"\xff") for u in units), np.uint8).reshape(n, -1)
        places = [(k, found) for k, found in enumerate(pieces.places(rows), 1) if (found != pieces.size).any()]
        for i in range(a, min(a + width, longest)):
            here = states[i % ring].copy()
            states[i % ring] = 0.0
            for k, found in places:
                states[(i + k) % ring] += here * lifted[found[:, i - a]]
            end = i + 1
            if end % SCALED == 0:
                top = states.max(axis=(0, 2))
                top = np.where(top > 0, top, 1.0)
                states /= top[:, None]
                scale += np.log(top)
            done = slice(np.searchsorted(lengths, end, "left"), np.searchsorted(lengths, end, "right"))
            if done.start < done.stop:
                out[done] = np.log(states[end % ring, done]) + (scale[done] - LIFT * end)[:, None]
    return out


def _by_length(units: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    lengths = np.array([len(u) for u in units])
    for length in np.unique(lengths):
        rows = np.flatnonzero(lengths == length)
        for a in range(0, len(rows), 8192):
            part = rows[a : a + 8192]
            yield part, np.frombuffer(b"".join(units[i] for i in part), np.uint8).reshape(len(part), length)


def fit(counts: dict[str, dict[str, int]], vocabulary: str = VOCABULARY, rounds: int = ROUNDS) -> tuple[list[str], np.ndarray]:
    """Languages and piece probabilities [piece, language] from word counts, by expectation and maximisation.

    Words of more than FIT_BYTES bytes are left out.
    """
    pieces, languages = Pieces(vocabulary), sorted(counts)
    table = np.zeros((pieces.size + 1, len(languages)))
    for column, lang in enumerate(languages):
        weight = {unit: n for word, n in counts[lang].items() if len(unit := _as_bytes(word)) <= FIT_BYTES}
        units = list(weight)
        amount = np.array([weight[u] for u in units], float)
        groups = [(pieces.places(rows), amount[part]) for part, rows in _by_length(units)]
        start = np.zeros(pieces.size + 1)  # how often a piece stands anywhere in the words
        for places, w in groups:
            for found in places:
                start += np.bincount(found.ravel(), np.repeat(w, found.shape[1]), pieces.size + 1)
        p = start
        for turn in range(rounds + 1):
            if turn:
                p = sum((expected(places, current, w) for places, w in groups), np.zeros(pieces.size + 1))
            p = p + SMOOTH
            p[-1] = 0
            current = (p / p.sum())[:, None]
        table[:, column] = current[:, 0]
    return languages, table


class Scorer:
    """Log-likelihood of texts by language; remembers words."""

    def __init__(self, languages: list[str], table: np.ndarray, vocabulary: str) -> None:
        self.languages, self.pieces = languages, Pieces(vocabulary)
        self.lifted = table * np.exp(LIFT * self.pieces.lengths)[:, None]
        self.known: dict[str, int] = {}
        self.scores = np.zeros((0, len(languages)))

    def _learn(self, new: list[str]) -> None:
        found = log_totals(self.pieces, self.lifted, [_as_bytes(word) for word in new])
        self.known.update(zip(new, range(len(self.scores), len(self.scores) + len(new))))
        self.scores = np.concatenate((self.scores, found))

    def __call__(self, texts: list[str]) -> list[tuple[str, float]]:
        if len(self.known) > MEMORY:
            self.known, self.scores = {}, self.scores[:0]
        split = [units_of(text) for text in texts]
        new = set().union(*split).difference(self.known)
        if new:
            self._learn(list(new))
        out = []
        for words in split:
            if not words or not self.languages:
                out.append((UNKNOWN, 0.0))
                continue
            total = self.scores[list(map(self.known.__getitem__, words))].sum(axis=0)
            odds = np.exp(total - total.max())
            best = int(odds.argmax())
            out.append((self.languages[best], float(odds[best] / odds.sum())))
        return out


def held_out(doc_id):
    """True where crc32 of the id as text leaves 1 divided by 3; false for null ids."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def _word_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in (part for whole in batches for part in chunks(whole)):
        counts: dict[tuple[str, str], int] = {}
        for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist()):
            for word in units_of(text):
                counts[lang, word] = counts.get((lang, word), 0) + 1
        yield pa.record_batch(
            {"lang": pa.array([k[0] for k in counts], pa.string()), "word": pa.array([k[1] for k in counts], pa.string()), "n": pa.array(list(counts.values()), pa.int64())}
        )


def fit_sample(docs: DataFrame, fit_docs: int = FIT_DOCS) -> dict[str, dict[str, int]]:
    """Word counts by language over at most fit_docs whole texts of each, those of the least hashes, none held out."""
    usable = docs.where(F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}") & ~held_out(F.col("doc_id")))
    hashed = usable.select("lang", "text", F.xxhash64("doc_id", "text").alias("h"))
    chosen = least_hashes(hashed, fit_docs, ("lang",))
    counts: dict[str, dict[str, int]] = {}
    found = chosen.select("lang", "text").mapInArrow(_word_counts, "lang string, word string, n bigint").groupBy("lang", "word").agg(F.sum("n").alias("n"))
    table = found.toArrow()
    for lang, word, n in zip(table["lang"].to_pylist(), table["word"].to_pylist(), table["n"].to_pylist()):
        counts.setdefault(lang, {})[word] = n
    return counts


def _predict(model, name: str, vocabulary: str, carried: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = held(name, lambda: Scorer(*model.value, vocabulary))
        for batch in (part for whole in batches for part in chunks(whole)):
            found = scorer([x or "" for x in batch.column("text").to_pylist()])
            columns = {c: batch.column(c) for c in carried}
            columns["lang_pred"] = pa.array([x[0] for x in found], pa.string())
            columns["score"] = pa.array([x[1] for x in found], pa.float64())
            yield pa.record_batch(columns)

    return run


def predict(docs: DataFrame, vocabulary: str = VOCABULARY, fit_docs: int = FIT_DOCS, carried: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """One row per row of docs: the carried columns, held_out, lang_pred, score.

    Learns from text and lang of documents that are not held out (at most fit_docs of a language),
    and predicts the language of every whole text. Each word's probability sums over all its
    segmentations into pieces; score is the posterior of the language predicted with equal
    priors. A null text and one without letters are `und` with score 0; so is every text where nothing
    can be learned. Null langs are not learned from; null ids are not held out. Ties go to the
    first language by name. Repeated rows come back alike. An empty table gives no rows; columns
    that are not named are ignored.
    """
    rows = pick(docs, *dict.fromkeys(["doc_id", "lang", "text", *carried]))
    model = docs.sparkSession.sparkContext.broadcast(fit(fit_sample(rows, fit_docs), vocabulary))
    kinds = ", ".join(f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in carried)
    columns = [*carried, "held_out"]
    found = rows.withColumn("held_out", held_out(F.col("doc_id"))).select(*dict.fromkeys([*columns, "text"]))
    return found.mapInArrow(_predict(model, uuid.uuid4().hex, vocabulary, columns), f"{kinds}, held_out boolean, lang_pred string, score double")


def op4_language_id(spark, sf_dir):
    return predict(spark.read.parquet(f"{sf_dir}/documents.parquet"))
