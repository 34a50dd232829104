"""Packing into windows by best-fit decreasing, the tightest open window found in a segment tree."""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import chunks, held, keep, pick
from tessera.llm.packing import END, VOCABULARY, Encoder
from tessera.session import sized

WINDOW = 2048
#: Pieces that a task packs.
PART_ITEMS = 200_000

PIECES = "start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint"


class OpenWindows:
    """Open windows by the room they have left: a segment tree over the rooms 1 to capacity.

    A node tells whether any window below it has room; windows of one room lie on a stack.
    """

    def __init__(self, capacity: int) -> None:
        self.leaves = 1 << capacity.bit_length()
        self.held = [0] * (2 * self.leaves)
        self.windows: list[list[int]] = [[] for _ in range(capacity + 1)]

    def add(self, room: int, window: int) -> None:
        self.windows[room].append(window)
        node = room + self.leaves
        while node:
            self.held[node] += 1
            node >>= 1

    def tightest(self, size: int) -> tuple[int, int] | None:
        """Takes out the window with the least room of at least `size`: (room, window)."""
        node, held = size + self.leaves, self.held
        if not held[node]:
            while node > 1 and (node & 1 or not held[node + 1]):  # up until the right neighbour holds one
                node >>= 1
            if node <= 1:
                return None
            node += 1
            while node < self.leaves:
                node = 2 * node if held[2 * node] else 2 * node + 1
        room = node - self.leaves
        while node:
            held[node] -= 1
            node >>= 1
        return room, self.windows[room].pop()


def best_fit_decreasing(sizes: list[int], capacity: int) -> list[list[int]]:
    """The pieces of each window: longest first, each into the open window it fits tightest, else into a new one."""
    windows: list[list[int]] = []
    opened = OpenWindows(capacity)
    for i in sorted(range(len(sizes)), key=lambda i: -sizes[i]):
        found = opened.tightest(sizes[i])
        if found is None:
            found = capacity, len(windows)
            windows.append([])
        room, window = found
        windows[window].append(i)
        if room > sizes[i]:
            opened.add(room - sizes[i], window)
    return windows


def close(windows: list[list[int]], sizes: list[int], capacity: int) -> list[list[tuple[int, int, int]]]:
    """Windows as parts (piece, from, length) without padding.

    Windows that are neither full nor as long as a power of two are closed: the fullest take what
    they lack from the emptiest, whose pieces are cut where they must be, and what is left of the last
    one is cut into lengths that are powers of two.
    """
    parts = [[(i, 0, sizes[i]) for i in window] for window in windows]
    held = [sum(sizes[i] for i in window) for window in windows]
    loose = sorted((w for w in range(len(windows)) if held[w] < capacity and held[w] & (held[w] - 1)), key=lambda w: (-held[w], w))
    first, last = 0, len(loose) - 1
    while first < last:
        taker, giver = loose[first], loose[last]
        while held[taker] < capacity and parts[giver]:
            piece, at, length = parts[giver].pop()
            moved = min(length, capacity - held[taker])
            parts[taker].append((piece, at, moved))
            held[taker] += moved
            held[giver] -= moved
            if moved < length:
                parts[giver].append((piece, at + moved, length - moved))
        first += held[taker] == capacity
        last -= not parts[giver]
    closed = [parts[w] for w in range(len(windows)) if parts[w] and not (first == last and loose and w == loose[first])]
    if first == last:
        rest, left = parts[loose[first]], held[loose[first]]
        while left:
            room, window = 1 << (left.bit_length() - 1), []
            left -= room
            while room:
                piece, at, length = rest.pop()
                moved = min(length, room)
                window.append((piece, at, moved))
                room -= moved
                if moved < length:
                    rest.append((piece, at + moved, length - moved))
            closed.append(window)
    return closed


def _encoder(vocabulary: str) -> Encoder:
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    path = public_tokenizers.path(vocabulary)
    return held(path, lambda: Encoder(path))


def _cut(vocabulary: str, end: int, capacity: int):
    last = end.to_bytes(4, "little")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = _encoder(vocabulary)
        for batch in (part for whole in batches for part in chunks(whole)):
            rows, owners = [], []
            for i, found in enumerate(encode([x or "" for x in batch.column("text").to_pylist()])):
                found += last
                for at in range(0, len(found), 4 * capacity):
                    part = found[at : at + 4 * capacity]
                    rows.append((at // 4, len(part) // 4, zlib.crc32(part), len(found) // 4))
                    owners.append(i)
            whole = batch.select(["doc_id", "text_hash"]).take(pa.array(owners, pa.int64()))
            numbers = [pa.array(x, pa.int64()) for x in zip(*rows)]
            yield pa.record_batch(dict(zip(["doc_id", "text_hash", "start", "length", "ids_crc32", "doc_tokens"], [*whole.columns, *numbers])))

    return run


def _deal(capacity: int):
    """Packs the pieces of a partition; `cut` tells which rows are parts of a piece, whose checksum is not known yet."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held_rows = [batch for batch in batches if batch.num_rows]
        if not held_rows:
            return
        table = pa.Table.from_batches(held_rows).combine_chunks()
        table = table.sort_by([(c, "ascending") for c in ("length", "doc_id", "text_hash", "start")])
        sizes = table["length"].to_pylist()
        mark, rows = (TaskContext.get().partitionId() << 32) | 1 << 62, []
        for window, parts in enumerate(close(best_fit_decreasing(sizes, capacity), sizes, capacity)):
            at = 0
            for piece, start, length in parts:
                rows.append((piece, start, length, mark | window, at))
                at += length
        for a in range(0, len(rows), 50_000):
            piece, start, length, window, at = (np.array(x, np.int64) for x in zip(*rows[a : a + 50_000]))
            found = table.take(pa.array(piece))
            cut = length < found["length"].to_numpy()
            values = [found["doc_id"].combine_chunks(), found["text_hash"].combine_chunks(), pa.array(start + found["start"].to_numpy()), pa.array(length)]
            values += [found["ids_crc32"].combine_chunks(), found["doc_tokens"].combine_chunks(), pa.array(window), pa.array(at), pa.array(cut)]
            yield pa.record_batch(values, ["doc_id", "text_hash", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "cut"])

    return run


def _checksums(vocabulary: str, end: int):
    last = end.to_bytes(4, "little")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = _encoder(vocabulary)
        for batch in (part for whole in batches for part in chunks(whole)):
            rows, owners = [], []
            asked = batch.column("parts").to_pylist()
            for i, found in enumerate(encode([x or "" for x in batch.column("text").to_pylist()])):
                found += last
                for part in asked[i]:
                    start, length = part["start"], part["length"]
                    rows.append((start, length, zlib.crc32(found[4 * start : 4 * (start + length)])))
                    owners.append(i)
            whole = batch.select(["doc_id", "text_hash"]).take(pa.array(owners, pa.int64()))
            yield pa.record_batch([*whole.columns, *[pa.array(x, pa.int64()) for x in zip(*rows)]], ["doc_id", "text_hash", "start", "length", "crc"])

    return run


def pack_windows(docs: DataFrame, vocabulary: str = VOCABULARY, capacity: int = WINDOW, part_items: int = PART_ITEMS) -> DataFrame:
    """One row per piece of every document: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    The ids of each whole text, then the id END, are first cut into full windows of `capacity` ids; what
    is left of each document is packed by best-fit decreasing, about part_items pieces to a task, and
    windows that end neither full nor at a power of two are closed by cutting the pieces of the
    emptiest, so nothing is padded. Documents cut there are encoded a second time for the checksums of
    their parts. Each id lies in one piece; sequences hold pieces without gaps from offset 0. A null or
    empty text is the end id alone. Rows that repeat an id are packed each for itself; null ids stay
    null. An empty table gives no rows; other columns are ignored. Written tables are read back from the
    shared folder, so sequences keep their numbers when an executor is lost.
    """
    docs = pick(docs, "doc_id", "text").withColumn("text_hash", F.xxhash64(F.coalesce("text", F.lit(""))))
    kind = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, text_hash bigint"
    pieces = keep(docs.mapInArrow(_cut(vocabulary, END, capacity), f"{kind}, {PIECES}"), "window-pieces")
    full = F.col("length") == capacity
    rest = pieces.where(~full)
    parts = max(1, -(-rest.count() // part_items))
    dealt = rest.repartition(parts).mapInArrow(_deal(capacity), f"{kind}, {PIECES}, sequence_id bigint, offset bigint, cut boolean")
    dealt = keep(dealt, "windows")
    columns = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    same = [F.col("text_hash") == F.col("h"), F.col("doc_id").eqNullSafe(F.col("of"))]
    asked = dealt.where("cut").groupBy("doc_id", "text_hash").agg(F.collect_set(F.struct("start", "length")).alias("parts"))
    asked = sized(asked.toDF("of", "h", "parts"))
    again = docs.join(asked, same[0] & same[1]).select("doc_id", "text_hash", "text", "parts")
    crc = again.mapInArrow(_checksums(vocabulary, END), f"{kind}, start bigint, length bigint, crc bigint")
    crc = crc.groupBy(F.col("doc_id").alias("of"), F.col("text_hash").alias("h"), F.col("start").alias("s"), F.col("length").alias("l")).agg(F.min("crc").alias("crc"))
    cut = dealt.where("cut").join(sized(keep(crc, "checksums")), same[0] & same[1] & (F.col("start") == F.col("s")) & (F.col("length") == F.col("l")))
    alone = pieces.where(full).withColumns({"sequence_id": F.monotonically_increasing_id(), "offset": F.lit(0).cast("bigint")})
    return alone.select(columns).union(dealt.where(~F.col("cut")).select(columns)).union(cut.withColumn("ids_crc32", F.col("crc")).select(columns))


def op11_window_packing(spark, sf_dir):
    return pack_windows(spark.read.parquet(f"{sf_dir}/documents.parquet"))
