"""Best-fit packing of token sequences by hierarchical residual packing."""

from __future__ import annotations

import json
import os
import re
import struct
import zlib
from array import array
from collections.abc import Iterator
from itertools import accumulate

import public_tokenizers
import pyarrow as pa
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import chunks, held, keep, pick
from tessera.session import sized

VOCABULARY = "word_bpe_49k.json"
END = 1
CAPACITY = 4096
#: Items of a task, and partitions that are merged in a round.
PART_ITEMS = 200_000
FAN_IN = 8
#: Bins with less room than this leave at once.
SLACK = 32
#: Characters of a text that are encoded at a time; longer words are read in windows.
PART = 256 * 1024
LONG = 2048
#: The tokenizer's white space: unlike Python's, without the four separators from 1c to 1f.
_SPACE = re.compile(r"[^\S\x1c-\x1f]+")
_ODD = re.compile("[\x1c-\x1f]")
#: Letters that compose and change case alike everywhere; the runs are those the vocabulary file names.
_LATIN = re.compile("[\x01-\u024f]*")
_ASCII_RUNS = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^a-z0-9]+")
_RUNS = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")
#: A character that never composes with the one before it.
_APART = regex.compile(r"[^\p{M}\u1160-\u11ff]")
#: Ends a run; a run's last byte and this one are the vocabulary's letter with a word end.
_MARK = "\0"


def _split(text: str) -> list[str]:
    return list(filter(None, _SPACE.split(text))) if _ODD.search(text) else text.split()


def _parts(text: str) -> Iterator[str]:
    """A text cut at white space, each part not much longer than PART unless a word is."""
    at = 0
    while at < len(text):
        cut = _SPACE.search(text, at + PART) if len(text) - at > PART else None
        end = cut.end() if cut else len(text)
        yield text[at:end]
        at = end


def _marked(words: list[str]) -> list[str]:
    """The words with a mark behind each of their runs but the last."""
    ascii_runs, runs = _ASCII_RUNS.findall, _RUNS.findall
    return [word if word.isalpha() else _MARK.join(ascii_runs(word) if word.isascii() else runs(word)) for word in words]


class Encoder:
    """Ids of texts as little-endian unsigned 32-bit bytes.

    The tokenizer never joins characters across white space, so a text's ids are those of its words in
    order. Words of Latin letters are cut into the vocabulary's runs (letters, digits, signs), each with
    a mark at its end, and merged by rank; the vocabulary's ids are its ranks. Short words in other
    letters go through the tokenizer as they are. Nothing is remembered, and texts of any length are
    read part by part.
    """

    def __init__(self, path: str) -> None:
        import tiktoken
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel

        self.tokenizer, self.as_bytes = Tokenizer.from_file(path), ByteLevel(add_prefix_space=False, use_regex=False)
        self.model = self.tokenizer.model
        self.special = {t.content: t_id for t_id, t in self.tokenizer.get_added_tokens_decoder().items()}
        self.any_special = re.compile("(" + "|".join(map(re.escape, self.special)) + ")")
        with open(path, encoding="utf-8") as file:
            model = json.load(file)["model"]
        end = model["end_of_word_suffix"]
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]  # bytes written as themselves; the others follow from 256 on
        letters = {chr(c): bytes([b]) for b, c in [*zip(shown, shown), *zip(sorted({*range(256)} - {*shown}), range(256, 512))]}
        ranks = {b"".join(letters[c] for c in t.removesuffix(end)) + _MARK.encode() * t.endswith(end): i for t, i in model["vocab"].items() if t not in self.special}
        self.by_rank = tiktoken.Encoding(os.path.basename(path), pat_str="[^\0 ]+\0", mergeable_ranks=ranks, special_tokens={})

    def _shown(self, run: str) -> str:
        """The run in the letters that the vocabulary writes bytes with."""
        return run if run.isascii() and run.isprintable() else self.as_bytes.pre_tokenize_str(run)[0][0]

    def _long_run(self, run: str) -> bytes:
        """A run in windows. Ids are right when each two neighbours are right on their own, so a window
        that begins with a token of the one before it goes on from there."""
        out, rest, at, width = bytearray(), "", 0, LONG
        while True:
            while len(rest) < width and at < len(run):
                rest += self._shown(run[at : at + LONG])
                at += LONG
            tokens = self.model.tokenize(rest)
            if at >= len(run):
                return bytes(out + struct.pack(f"<{len(tokens)}I", *[t.id for t in tokens]))
            ends = list(accumulate(len(t.value) for t in tokens))
            for n in range(len(tokens) - 9, 0, -8):  # what the end of the window changes lies behind this
                if self.model.tokenize(rest[ends[n - 1] :])[0].id == tokens[n].id:
                    out += struct.pack(f"<{n}I", *[t.id for t in tokens[:n]])
                    rest, width = rest[ends[n - 1] :], LONG
                    break
            else:
                width += LONG

    def _long_word(self, word: str) -> bytes:
        out = bytearray()
        for part in self.any_special.split(word):
            if part in self.special:
                out += struct.pack("<I", self.special[part])
                continue
            plain, at = [], 0
            while at < len(part):
                cut = _APART.search(part, at + PART)
                end = cut.start() if cut else len(part)
                plain.append(self.tokenizer.normalizer.normalize_str(part[at:end]))
                at = end
            runs = []
            for m in _RUNS.finditer("".join(plain)):
                runs.append(m.group())
                if len(runs[-1]) > LONG:
                    out += self._merged(runs[:-1]) + self._long_run(runs.pop())
                    runs = []
                elif len(runs) > LONG:
                    out += self._merged(runs)
                    runs = []
            out += self._merged(runs)
        return bytes(out)

    def _merged(self, marked: list[str]) -> bytes:
        """Ids of words in lower case with marks behind their runs but the last."""
        return array("I", self.by_rank.encode_ordinary(f"{_MARK} ".join(marked) + _MARK)).tobytes() if marked else b""

    def _tokenizer_ids(self, word: str) -> bytes:
        return array("I", self.tokenizer.encode(word, add_special_tokens=False).ids).tobytes()

    def _ids(self, text: str) -> bytes:
        if "<|" not in text and _LATIN.fullmatch(text):
            words = _split(text.lower())
            if len(text) <= LONG or max(map(len, words), default=0) <= LONG:
                return self._merged(_marked(words))
        out, plain = bytearray(), []
        for word in _split(text):
            if len(word) <= LONG and "<|" not in word and _LATIN.fullmatch(word):
                plain.extend(_marked([word.lower()]))
                continue
            out += self._merged(plain) + (self._long_word(word) if len(word) > LONG else self._tokenizer_ids(word))
            plain = []
        return bytes(out + self._merged(plain))

    def __call__(self, texts: list[str]) -> list[bytes]:
        return [self._ids(text) if len(text) <= PART else b"".join(map(self._ids, _parts(text))) for text in texts]


def _pieces(vocabulary: str, end: int, capacity: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        path = public_tokenizers.path(vocabulary)
        encode = held(path, lambda: Encoder(path))
        last = end.to_bytes(4, "little")
        for batch in (part for whole in batches for part in chunks(whole)):
            rows = []
            for doc_id, found in zip(batch.column("doc_id").to_pylist(), encode([x or "" for x in batch.column("text").to_pylist()])):
                found += last
                for piece, at in enumerate(range(0, len(found), 4 * capacity)):
                    part = found[at : at + 4 * capacity]
                    rows.append((doc_id, piece, at // 4, len(part) // 4, zlib.crc32(part)))
            columns = list(zip(*rows))
            yield pa.record_batch(
                {
                    "doc_id": pa.array(columns[0], batch.schema.field("doc_id").type),
                    "piece": pa.array(columns[1], pa.int32()),
                    "start": pa.array(columns[2], pa.int64()),
                    "length": pa.array(columns[3], pa.int64()),
                    "ids_crc32": pa.array(columns[4], pa.int64()),
                }
            )

    return run


def pieces(docs: DataFrame, vocabulary: str = VOCABULARY, end: int = END, capacity: int = CAPACITY) -> DataFrame:
    """One row per piece of a document: doc_id, piece, start, length, ids_crc32.

    The ids of the whole text, then the id `end`; null counts as empty, so it is one piece of length 1.
    """
    docs = pick(docs, "doc_id", "text")
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.mapInArrow(_pieces(vocabulary, end, capacity), f"doc_id {kind}, piece int, start bigint, length bigint, ids_crc32 bigint")


def best_fit(sizes: list[int], capacity: int) -> tuple[list[int], list[int], list[int]]:
    """Bin and offset of each item, and the room left in each bin. Largest items first, each into the fullest bin it fits."""
    order = sorted(range(len(sizes)), key=lambda i: -sizes[i])
    bins, offsets, room = [0] * len(sizes), [0] * len(sizes), []
    by_room: list[list[int]] = [[] for _ in range(capacity + 1)]
    open_ = 0  # bit r: a bin with room r
    for i in order:
        size = sizes[i]
        fits = open_ >> size
        if fits:
            r = size + (fits & -fits).bit_length() - 1
            b = by_room[r].pop()
            if not by_room[r]:
                open_ ^= 1 << r
        else:
            r, b = capacity, len(room)
            room.append(capacity)
        bins[i], offsets[i] = b, capacity - r
        left = r - size
        room[b] = left
        if left:
            by_room[left].append(b)
            open_ |= 1 << left
    return bins, offsets, room


def _round(level: int, capacity: int, slack: int, fan_in: int, last: bool):
    """Packs the items of a partition; says of each bin whether it goes on to the next round.

    Two bins filled to half or less would be one, so a partition leaves at most one such bin, and
    a merge of fan_in partitions has at most fan_in of them to place. Fuller bins can only take
    these, so fan_in bins of each filling are enough to carry; this bounds what goes on.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items = sorted((i, size) for batch in batches for i, size in zip(batch.column("item").to_pylist(), batch.column("size").to_pylist()))
        if not items:
            return
        bins, offsets, room = best_fit([size for _, size in items], capacity)
        mark = (level << 56) | (TaskContext.get().partitionId() << 30)
        kept: dict[int, int] = {}
        goes = []
        for r in room:
            kept[r] = kept.get(r, 0) + 1
            goes.append(not last and r >= slack and (kept[r] <= fan_in or 2 * r >= capacity))
        for a in range(0, len(items), 100_000):
            cut = range(a, min(a + 100_000, len(items)))
            yield pa.record_batch(
                {
                    "item": pa.array([items[k][0] for k in cut], pa.int64()),
                    "bin": pa.array([mark | bins[k] for k in cut], pa.int64()),
                    "offset": pa.array([offsets[k] for k in cut], pa.int64()),
                    "size": pa.array([capacity - room[bins[k]] for k in cut], pa.int64()),
                    "goes": pa.array([goes[bins[k]] for k in cut], pa.bool_()),
                }
            )

    return run


def pack(found: DataFrame, capacity: int = CAPACITY, part_items: int = PART_ITEMS, fan_in: int = FAN_IN, slack: int = SLACK) -> DataFrame:
    """Adds sequence_id and offset to rows with a length from 1 to capacity.

    Round 0 deals the pieces evenly into partitions of about part_items and packs each by best
    fit. Nearly full bins are done; the others are the items of the next round, with a fan_in-th
    of the partitions, until one partition is left. Each round is written to the shared folder, so bins
    keep their numbers when an executor is lost. No row is dropped; an empty table gives no rows.
    """
    rows = keep(found.withColumn("item", F.monotonically_increasing_id()), "pieces")
    n = rows.count()
    parts = max(1, -(-n // part_items))
    items, level, rounds = rows.select("item", F.col("length").alias("size")), 0, []
    while True:
        last = parts == 1
        packed = keep(
            items.repartition(parts).mapInArrow(_round(level, capacity, slack, fan_in, last), "item bigint, bin bigint, offset bigint, size bigint, goes boolean"),
            f"round{level}",
        )
        rounds.append(packed)
        if last:
            break
        items = packed.where("goes").select(F.col("bin").alias("item"), "size").distinct()
        parts, level = max(1, -(-parts // fan_in)), level + 1
    placed = None
    for packed in reversed(rounds):
        here = packed.select("item", "bin", "offset")
        if placed is None:
            placed = here.toDF("item", "sequence_id", "offset")
            continue
        outer = sized(placed.toDF("of", "outer_id", "outer_offset"))
        placed = here.join(outer, F.col("bin") == F.col("of"), "left").select(
            "item", F.coalesce("outer_id", "bin").alias("sequence_id"), (F.col("offset") + F.coalesce("outer_offset", F.lit(0))).alias("offset")
        )
    return rows.join(placed, "item").drop("item")


def best_fit_packing(docs: DataFrame, vocabulary: str = VOCABULARY, capacity: int = CAPACITY) -> DataFrame:
    """One row per piece of every document: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    Documents longer than capacity are cut into pieces of that length, the last may be shorter; no others
    are cut. Sequences hold at most capacity ids, gapless from offset 0. Null and empty texts are the
    end id alone. Rows that repeat an id are packed each for itself. Null ids stay null. An empty table
    gives no rows; other columns are ignored.
    """
    return pack(pieces(docs, vocabulary, END, capacity), capacity)


def op3_best_fit_packing(spark, sf_dir):
    return best_fit_packing(spark.read.parquet(f"{sf_dir}/documents.parquet"))
