"""Similarity join on word shingles: prefix filters under several global orders, intersected before verification."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import chunks, held, keep, pick
from tessera.llm.components import components
from tessera.session import sized

WORDS = 5
PERCENT = 75
#: The first filter's prefix is this share of a set longer than 1 - threshold, so that several tokens must be shared.
EXTRA = 0.15
#: Tokens that a task of the filters handles, and that are gathered before rows are made of them.
BUCKET_TOKENS = 500_000
#: Bytes of text that are hashed at a time; each takes some 40 bytes of arrays.
CHUNK_BYTES = 512 * 1024
#: Documents and tokens of a chunk of a candidate group; a task compares two chunks at most.
CHUNK_DOCS = 256
CHUNK_TOKENS = 500_000

_GAP = re.compile(rb"[\x20\x09-\x0D]")
_IS_GAP = np.zeros(256, bool)
_IS_GAP[[9, 10, 11, 12, 13, 32]] = True
_BYTES = np.random.default_rng(11).integers(1, 2**63, 256, dtype=np.uint64) | np.uint64(1)
_BASE = 0x9E3779B97F4A7C15
_ROUND = np.uint64(0xBF58476D1CE4E5B9)
_LAST = np.uint64(0x94D049BB133111EB)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _ROUND
    x = (x ^ (x >> np.uint64(27))) * _LAST
    return x ^ (x >> np.uint64(31))


def _powers(n: int) -> list[np.ndarray]:
    """Powers of the base and of its inverse, modulo 2^64."""
    powers: list[np.ndarray] = held("powers", list)
    if not powers or len(powers[0]) < n:
        n = max(n, CHUNK_BYTES + CHUNK_BYTES // 4)
        powers.clear()
        for base in (_BASE, pow(_BASE, -1, 2**64)):
            factors = np.full(n, base, np.uint64)
            factors[0] = 1
            powers.append(np.cumprod(factors))
    return powers


def _word_hashes(blob: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Hash and first byte of each word, from running sums over the bytes."""
    data = np.frombuffer(blob, np.uint8)
    gap = np.concatenate(([True], _IS_GAP[data], [True]))
    edges = np.flatnonzero(gap[1:] != gap[:-1])
    starts, ends = edges[::2], edges[1::2]
    up, down = _powers(len(data))
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(_BYTES[data] * up[: len(data)])))
    return _mixed((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64)), starts


def _pieces(texts: list) -> Iterator[tuple[list[int], list[bytes]]]:
    """The texts as bytes with A-Z in lower case, some at a time; long ones in pieces cut at white space."""
    owners, held, size = [], [], 0
    for i, text in enumerate(texts):
        data = text.encode("utf-8", "surrogatepass").lower() if text else b""
        at = 0
        while at < len(data):
            cut = _GAP.search(data, at + CHUNK_BYTES) if len(data) - at > CHUNK_BYTES else None
            end = cut.start() if cut else len(data)
            if held and size + end - at > CHUNK_BYTES:
                yield owners, held
                owners, held, size = [], [], 0
            owners.append(i)
            held.append(data[at:end])
            size += end - at + 1
            at = end
    if held:
        yield owners, held


def shingle_sets(texts: list, words: int = WORDS) -> list[np.ndarray]:
    """The set of each text's shingles as sorted 64-bit hashes; empty without words."""
    found: list[list[np.ndarray]] = [[] for _ in texts]
    for owners, held in _pieces(texts):
        hashes, starts = _word_hashes(b" ".join(held))
        bounds = np.cumsum([0] + [len(x) + 1 for x in held])
        cuts = np.searchsorted(starts, bounds)
        for k, i in enumerate(owners):
            found[i].append(hashes[cuts[k] : cuts[k + 1]])
    sets = []
    for parts in found:
        h = parts[0] if len(parts) == 1 else np.concatenate(parts) if parts else np.zeros(0, np.uint64)
        if not len(h):
            sets.append(h)
            continue
        width = min(words, len(h))
        n = len(h) - width + 1
        acc = h[:n] + np.uint64(width)
        for j in range(1, width):
            acc = _mixed(acc) + h[j : j + n]
        sets.append(np.unique(_mixed(acc)))
    return sets


def _key(tokens: np.ndarray) -> bytes:
    return hashlib.blake2b(tokens.tobytes(), digest_size=16).digest()


def _tag(key: bytes) -> int:
    return int.from_bytes(key[:8], "little", signed=True)


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held(None)
    for batch in batches:
        yield from chunks(batch)


def _signatures(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in _slices(batches):
        sets = shingle_sets(batch.column("text").to_pylist())
        keys = [_key(s) if len(s) else None for s in sets]
        yield pa.record_batch(
            {
                "doc_id": batch.column("doc_id"),
                "h": batch.column("h"),
                "n": pa.array([len(s) for s in sets], pa.int64()),
                "key": pa.array(keys, pa.binary()),
                "tag": pa.array([k and _tag(k) for k in keys], pa.int64()),
            }
        )


class _Blobs:
    """Gathers tokens with their document's tag and size; gives them as one row per bucket of tokens."""

    def __init__(self, buckets: int) -> None:
        self.buckets, self.held, self.n = buckets, [], 0

    def add(self, tokens: np.ndarray, tag: int, size: int) -> None:
        self.held.append((tokens, tag, size))
        self.n += len(tokens)

    def rows(self) -> pa.RecordBatch:
        lengths = [len(x[0]) for x in self.held]
        tokens = np.concatenate([x[0] for x in self.held]) if self.held else np.zeros(0, np.uint64)
        tags = np.repeat(np.array([x[1] for x in self.held], np.int64), lengths)
        sizes = np.repeat(np.array([x[2] for x in self.held], np.int32), lengths)
        bucket = (_mixed(tokens + np.uint64(7)) % np.uint64(self.buckets)).astype(np.int32)
        order = np.argsort(bucket, kind="stable")
        tokens, tags, sizes = tokens[order], tags[order], sizes[order]
        bounds = np.searchsorted(bucket[order], np.arange(self.buckets + 1))
        full = [b for b in range(self.buckets) if bounds[b] < bounds[b + 1]]
        self.held, self.n = [], 0
        cut = lambda x: pa.array([x[bounds[b] : bounds[b + 1]].tobytes() for b in full], pa.binary())
        return pa.record_batch({"bucket": pa.array(full, pa.int32()), "tokens": cut(tokens), "tags": cut(tags), "sizes": cut(sizes)})


BLOBS = "bucket int, tokens binary, tags binary, sizes binary"


def _joined(column: pa.ChunkedArray, kind: type) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), kind)


def _shared(table: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Tokens that two or more documents have: token, tag, size, number of documents; each pair once."""
    tokens, tags, sizes = _joined(table["tokens"], np.uint64), _joined(table["tags"], np.int64), _joined(table["sizes"], np.int32)
    order = np.lexsort((tags, tokens))
    tokens, tags, sizes = tokens[order], tags[order], sizes[order]
    new = np.ones(len(tokens), bool)
    new[1:] = (tokens[1:] != tokens[:-1]) | (tags[1:] != tags[:-1])
    tokens, tags, sizes = tokens[new], tags[new], sizes[new]
    first = np.flatnonzero(np.concatenate(([True], tokens[1:] != tokens[:-1]))) if len(tokens) else np.zeros(0, np.int64)
    held = np.diff(np.append(first, len(tokens)))
    df = np.repeat(held, held)
    several = df > 1
    return tokens[several], tags[several], sizes[several], df[several]


def _prefix_blobs(buckets: int, share: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blobs, seen = _Blobs(buckets), set()
        for batch in _slices(batches):
            for tokens in shingle_sets(batch.column("text").to_pylist()):
                if not len(tokens):
                    continue
                tag = _tag(_key(tokens))
                if tag in seen:  # a copy within these rows says nothing new
                    continue
                seen.add(tag)
                blobs.add(tokens[: min(len(tokens), int(share * len(tokens)) + 1)], tag, len(tokens))
                if blobs.n >= BUCKET_TOKENS:
                    yield blobs.rows()
                    seen.clear()
        yield blobs.rows()

    return run


def _shared_counts(table: pa.Table) -> pa.Table:
    tags, counts = np.unique(_shared(table)[1], return_counts=True)
    return pa.table({"tag": pa.array(tags, pa.int64()), "c": pa.array(counts, pa.int64())})


def _whole_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    seen = set()
    for batch in _slices(batches):
        rows = []
        for tokens in shingle_sets(batch.column("text").to_pylist()):
            key = _key(tokens) if len(tokens) else None
            if key and key not in seen:
                seen.add(key)
                rows.append((key, _tag(key), tokens.tobytes()))
        yield pa.record_batch(
            {
                "key": pa.array([r[0] for r in rows], pa.binary()),
                "tag": pa.array([r[1] for r in rows], pa.int64()),
                "tokens": pa.array([r[2] for r in rows], pa.binary()),
            }
        )


def _set_blobs(buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blobs = _Blobs(buckets)
        for batch in batches:
            for tag, data in zip(batch.column("tag").to_pylist(), batch.column("tokens").to_pylist()):
                tokens = np.frombuffer(data, np.uint64)
                blobs.add(tokens, tag, len(tokens))
                if blobs.n >= BUCKET_TOKENS:
                    yield blobs.rows()
        yield blobs.rows()

    return run


def _by_document(buckets: int):
    def run(table: pa.Table) -> pa.Table:
        """The shared tokens of a bucket and their frequencies, one row per bucket of documents."""
        tokens, tags, sizes, df = _shared(table)
        part = (_mixed(tags.view(np.uint64)) % np.uint64(buckets)).astype(np.int32)
        order = np.argsort(part, kind="stable")
        bounds = np.searchsorted(part[order], np.arange(buckets + 1))
        full = [b for b in range(buckets) if bounds[b] < bounds[b + 1]]
        cut = lambda x: pa.array([x[order[bounds[b] : bounds[b + 1]]].tobytes() for b in full], pa.binary())
        return pa.table({"part": pa.array(full, pa.int32()), "tokens": cut(tokens), "tags": cut(tags), "sizes": cut(sizes), "dfs": cut(df.astype(np.int32))})

    return run


def _rarity_prefixes(percent: int):
    def run(table: pa.Table) -> pa.Table:
        """Of each document the shared tokens within its prefix by rarity. Tokens of its own come first in that order."""
        tokens, tags = _joined(table["tokens"], np.uint64), _joined(table["tags"], np.int64)
        sizes, df = _joined(table["sizes"], np.int32), _joined(table["dfs"], np.int32)
        order = np.lexsort((tokens, df, tags))
        tokens, tags, sizes = tokens[order], tags[order], sizes[order].astype(np.int64)
        first = np.flatnonzero(np.concatenate(([True], tags[1:] != tags[:-1]))) if len(tags) else np.zeros(0, np.int64)
        held = np.diff(np.append(first, len(tags)))
        place = np.arange(len(tags)) - np.repeat(first, held) + (sizes - np.repeat(held, held))
        within = place < _prefix(sizes, percent)
        return pa.table({"tag": pa.array(tags[within], pa.int64()), "token": pa.array(tokens[within].view(np.int64), pa.int64())})

    return run


def _prefix(n, percent: int):
    """Tokens of a set of n of which one at least is in any set that it links with, under any one order."""
    return n - (percent * n + 99) // 100 + 1


def _groups_of(doc: np.ndarray, token: np.ndarray) -> Iterator[np.ndarray]:
    """The documents of each token that two or more have; equal lists once."""
    order = np.lexsort((doc, token))
    doc, token = doc[order], token[order]
    first = np.flatnonzero(np.concatenate(([True], token[1:] != token[:-1])))
    seen = set()
    for a, b in zip(first, np.append(first[1:], len(token))):
        if b - a > 1 and (mark := doc[a:b].tobytes()) not in seen:
            seen.add(mark)
            yield doc[a:b]


def linked(sets: list[np.ndarray], percent: int = PERCENT, chunk: np.ndarray | None = None) -> np.ndarray:
    """For each set the least place of a set reachable by links. With chunk 0/1, only pairs of different chunks count.

    Candidates share a token of their prefixes by rarity here, by hash, and by a second hash, and
    fit in size. They are compared one document with all others at a time, and pairs that
    are joined already are passed over.
    """
    g = len(sets)
    n = np.array([len(s) for s in sets])
    every, token = np.unique(np.concatenate(sets), return_inverse=True)
    doc = np.repeat(np.arange(g), n)
    starts = np.concatenate(([0], np.cumsum(n)[:-1]))
    df = np.bincount(token)
    cand = np.ones((g, g), bool)
    for rank in (df.astype(np.uint64) << np.uint64(32), every >> np.uint64(1), _mixed(every) >> np.uint64(1)):
        order = np.lexsort((token, rank[token], doc))
        place = np.arange(len(order)) - np.repeat(starts, n)
        within = order[place < np.repeat(_prefix(n, percent), n)]
        within = within[df[token[within]] > 1]
        pairs = np.zeros((g, g), bool)
        for group in _groups_of(doc[within], token[within]) if len(within) else ():
            pairs[np.ix_(group, group)] = True
        cand &= pairs
    cand &= (100 * n[:, None] >= percent * n[None, :]) & (100 * n[None, :] >= percent * n[:, None])
    if chunk is not None:
        cand &= chunk[:, None] != chunk[None, :]
    root = np.arange(g)
    flag = np.zeros(len(every), np.int32)
    for i in range(g):
        others = np.flatnonzero(cand[i, i + 1 :] & (root[i + 1 :] != root[i])) + i + 1
        if not len(others):
            continue
        mine = token[starts[i] : starts[i] + n[i]]
        flag[mine] = 1
        if len(others) * 4 > g:
            common = np.add.reduceat(flag[token], starts)[others]
        else:
            common = np.array([flag[token[starts[j] : starts[j] + n[j]]].sum() for j in others])
        flag[mine] = 0
        for j in others[100 * common >= percent * (n[i] + n[others] - common)]:
            a, b = root[i], root[j]
            if a != b:
                root[root == max(a, b)] = min(a, b)
    return root


def _compare(percent: int):
    def run(table: pa.Table) -> pa.Table:
        keys = table["key"].to_pylist()
        order = sorted(range(len(keys)), key=keys.__getitem__)
        data, sides = table["tokens"].to_pylist(), table["side"].to_pylist()
        sets = [np.frombuffer(data[i], np.uint64) for i in order]
        side = np.array([sides[i] for i in order])
        # chunk with itself: side is 0 for all and all pairs count; two chunks: the pairs between them
        root = linked(sets, percent, side if len(set(sides)) > 1 else None) if side.max() == 0 or len(set(sides)) > 1 else np.arange(len(sets))
        joined = [k for k in range(len(order)) if root[k] != k]
        return pa.table({"a": pa.array([keys[order[k]] for k in joined], pa.binary()), "b": pa.array([keys[order[root[k]]] for k in joined], pa.binary())})

    return run


def _buckets(tokens: int) -> int:
    return max(1, -(-int(tokens) // BUCKET_TOKENS))


def similarity_classes(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """One row per row of docs: doc_id, n_shingles, component_id, h (xxhash64 of the text).

    Two documents link when 100 * intersection >= percent * union of their sets of 5-word shingles;
    component_id is the least doc_id reachable. Equal sets are one class from the start, so copies
    are a count, not pairs. Then, each step on what the one before left:

    1. Order by hash. Prefixes longer than needed, so that a linked pair shares several tokens
       of them: documents with fewer shared ones (merged counts per token bucket) are done.
    2. Order by rarity over the whole sets of the rest. Tokens in one document only stand
       first, so a set with over 1 - threshold of them has an empty prefix and is done.
       Documents that share a prefix token are one candidate group.
    3. In a group, pairs must share prefix tokens by rarity, by hash and by a second hash, before
       they are verified on their whole sets. Large groups are cut into chunks; each two chunks are
       a task of bounded size, and pairs that are joined already are not compared.

    All links between different sets are found or implied by others; nothing is capped. Texts
    without words (null, empty, blank) have no shingles and are their own component. Null ids
    take part, but never name a component; a component of null ids alone is null. Rows that
    repeat an id come back alike. An empty table gives no rows; other columns are ignored.
    """
    docs = pick(docs, "doc_id", "text")
    texts = docs.select("text")
    with_hash = docs.select("doc_id", "text", F.xxhash64("text").alias("h"))
    kinds = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, h bigint, n bigint, key binary, tag bigint"
    rows = keep(with_hash.mapInArrow(_signatures, kinds), "signatures")
    classes = keep(
        rows.where("key IS NOT NULL").groupBy("key").agg(F.first("tag").alias("tag"), F.first("n").alias("n"), F.min("h").alias("h"), F.min("doc_id").alias("least"), F.count("*").alias("copies")),
        "classes",
    )
    total = classes.agg(F.sum("n")).first()[0] or 0

    loose = 1 - percent / 100
    share = loose + EXTRA
    blobs = texts.mapInArrow(_prefix_blobs(_buckets(total * share), share), BLOBS)
    counts = blobs.groupBy("bucket").applyInArrow(_shared_counts, "tag bigint, c bigint").groupBy("tag").agg(F.sum("c").alias("c"))
    needed = F.floor(F.col("n") * (EXTRA * percent / 100 - 1e-9)) + 1
    alive = keep(classes.join(counts, "tag").where(F.col("c") >= needed).select("key", "tag", "n", "h"), "alive")
    left = alive.agg(F.sum("n"), F.count("*")).first()
    tokens, n_alive = left[0] or 0, left[1]

    source = with_hash.select("text", "h").join(sized(alive.select("h").distinct()), "h", "left_semi").select("text")
    sets = source.mapInArrow(_whole_sets, "key binary, tag bigint, tokens binary")
    sets = sets.join(alive.select("key"), "key", "left_semi").dropDuplicates(["key"])
    sets = keep(sets, "sets")
    parts = _buckets(tokens)
    by_doc = sets.select("tag", "tokens").mapInArrow(_set_blobs(parts), BLOBS).groupBy("bucket").applyInArrow(_by_document(parts), "part int, tokens binary, tags binary, sizes binary, dfs binary")
    prefixes = keep(by_doc.groupBy("part").applyInArrow(_rarity_prefixes(percent), "tag bigint, token bigint"), "prefixes")
    heads = prefixes.groupBy("token").agg(F.min("tag").alias("head"), F.count("*").alias("held")).where("held > 1")
    coarse = components(prefixes.join(heads, "token").select("tag", "head").distinct())

    members = sets.join(coarse.withColumnsRenamed({"node": "tag", "root": "at"}), "tag").withColumn("n", F.octet_length("tokens") / 8)
    sizes = members.groupBy("at").agg(F.ceil(F.greatest(F.count("*") / CHUNK_DOCS, F.sum("n") / CHUNK_TOKENS)).alias("chunks"))
    members = members.join(sized(sizes), "at").withColumn("mine", F.pmod(F.xxhash64("key"), F.col("chunks")))
    members = members.withColumn("other", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("chunks") - 1)))
    members = members.select("at", F.least("mine", "other").alias("i"), F.greatest("mine", "other").alias("j"), (F.col("mine") > F.col("other")).cast("int").alias("side"), "key", "tokens")
    links = members.groupBy("at", "i", "j").applyInArrow(_compare(percent), "a binary, b binary")
    joined = keep(components(links), "components")

    named = classes.join(joined.withColumnRenamed("node", "key"), "key", "left").withColumn("root", F.coalesce("root", "key"))
    least = named.groupBy("root").agg(F.min("least").alias("component"), F.sum("copies").alias("members")).where("members > 1")
    names = keep(named.select("key", "root").join(least, "root").select("key", "component"), "names")
    found = rows.join(sized(names.withColumnRenamed("key", "of")), F.col("key") == F.col("of"), "left")
    # a class of one row is its own component; a component of null ids alone has no name
    return found.select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("of").isNull(), F.col("doc_id")).otherwise(F.col("component")).alias("component_id"), "h")


def one_of_each(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """The rows of docs that name their component; of a component without any id, all rows."""
    found = similarity_classes(docs, percent)
    gone = found.where(F.col("component_id").isNotNull() & ~F.col("doc_id").eqNullSafe(F.col("component_id"))).select(F.col("doc_id").alias("_id"), F.col("h").alias("_h")).distinct()
    gone = keep(gone, "gone")
    return docs.join(sized(gone), docs["doc_id"].eqNullSafe(gone["_id"]) & (F.xxhash64(docs["text"]) == gone["_h"]), "left_anti")


def op10_ngram_jaccard(spark, sf_dir):
    return similarity_classes(spark.read.parquet(f"{sf_dir}/documents.parquet")).drop("h")


OP10_SQL = f"""
WITH RECURSIVE d AS (
    SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS w FROM documents
), sh AS (
    SELECT DISTINCT r, array_to_string(w[i:i + {WORDS - 1}], ' ') AS s
    FROM (SELECT r, w, unnest(range(1, greatest(len(w) - {WORDS - 2}, 2))) AS i FROM d WHERE len(w) > 0)
), n AS (
    SELECT r, count(*) AS n FROM sh GROUP BY r
), pairs AS (
    SELECT a.r AS a, b.r AS b, count(*) AS c FROM sh a JOIN sh b ON a.s = b.s AND a.r <> b.r GROUP BY a.r, b.r
), links AS (
    SELECT p.a, p.b FROM pairs p JOIN n na ON p.a = na.r JOIN n nb ON p.b = nb.r WHERE 100 * p.c >= {PERCENT} * (na.n + nb.n - p.c)
), reach(a, b) AS (
    SELECT r, r FROM d UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a
)
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, min(o.doc_id) AS component_id
FROM d LEFT JOIN n USING (r) JOIN reach ON reach.a = d.r JOIN d o ON o.r = reach.b GROUP BY d.r, d.doc_id, n.n
"""
