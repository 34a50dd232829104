"""Merkle manifest of a dataset, with versions of tampered leaves by path copying."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import groupby

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from tessera.llm.common import keep, pick
from tessera.llm.exact import UPPER
from tessera.operators.numbering import numbered
from tessera.session import sized

#: Children of a node.
FAN = 16
#: Levels of an aligned block, which one task builds: 16^3 leaves.
BLOCK_LEVELS = 3
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def _field(value: Column) -> Column:
    """A field as a leaf's hash takes it: `-` for null, else the number of its UTF-8 bytes, a colon, and the value."""
    shown = value.cast("string")
    return F.when(shown.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(shown).cast("string"), F.lit(":"), shown))


def leaf_hash(*values: Column) -> Column:
    return F.sha2(F.concat(*[_field(v) for v in values]).cast("binary"), 256)


def _hash(*parts: str) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


class Block:
    """The tree over the leaves of an aligned block: levels of nodes, each the hash of up to FAN below it.

    Nodes are never changed. A version of the tree for another leaf copies the nodes above it and shares all others.
    """

    def __init__(self, leaves: list[str], levels: int) -> None:
        self.levels = [leaves]
        for _ in range(levels):
            below = self.levels[-1]
            self.levels.append([_hash(*below[i : i + FAN]) for i in range(0, len(below), FAN)])
        self.root = self.levels[-1][0]

    def beside(self, leaf: int) -> list[tuple[str, str]]:
        """By level, the siblings left and right of the node above a leaf."""
        found = []
        for nodes in self.levels[:-1]:
            start = leaf - leaf % FAN
            found.append(("".join(nodes[start:leaf]), "".join(nodes[leaf + 1 : start + FAN])))
            leaf //= FAN
        return found


def version(leaf: str, path: list[tuple[str, str]]) -> list[str]:
    """The copied nodes from a leaf up: its own hash, then each ancestor's from the copy below and the shared siblings."""
    copies = [leaf]
    for left, right in path:
        copies.append(_hash(left, copies[-1], right))
    return copies


def levels_of(leaves: int) -> int:
    """Levels above so many leaves; none above one."""
    levels = 0
    while leaves > 1:
        leaves, levels = -(-leaves // FAN), levels + 1
    return levels


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple, list[dict]]]:
    """The rows of each block, which lie next to each other; at most FAN ** BLOCK_LEVELS are held."""
    rows = (row for batch in batches for part in range(0, batch.num_rows, 512) for row in batch.slice(part, 512).to_pylist())
    for key, block in groupby(rows, key=lambda r: (r["tree"], r["block"])):
        yield key, list(block)


def _built(rows: list[dict], levels: int) -> Block:
    return Block([r["leaf"] for r in rows], min(levels, levels_of(rows[0]["leaves"])))


def _block_roots(levels: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (tree, block), rows in _blocks(batches):
            numbers = [pa.array([x], pa.int64()) for x in (tree, block, rows[0]["leaves"])]
            yield pa.record_batch([*numbers, pa.array([_built(rows, levels).root])], ["tree", "place", "leaves", "hash"])

    return run


def _versions(root: str, levels: int, kind: pa.DataType):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, rows in _blocks(batches):
            block = _built(rows, levels)
            above = [(step["left"], step["right"]) for step in rows[0]["above"]]
            for a in range(0, len(rows), 512):
                part, proofs, folded = rows[a : a + 512], [], []
                for i, row in enumerate(part, a):
                    path = block.beside(i) + above
                    proofs.append("".join([left + right for left, right in path]))
                    folded.append(version(row["tampered"] or row["leaf"], path)[-1])
                yield pa.record_batch(
                    {
                        "doc_id": pa.array([r["doc_id"] for r in part], kind),
                        "leaf": pa.array([r["leaf"] for r in part]),
                        "subroot": pa.array([rows[0]["subroot"]] * len(part)),
                        "proof": pa.array(proofs),
                        "folded_root": pa.array(folded),
                        "verified": pa.array([f == root for f in folded]),
                    }
                )

    return run


def climb(nodes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Upper levels over rows (tree, place, hash, n: nodes of the tree): paths of the nodes, and the tops of the trees.

    paths has (tree, place, above): by level, the siblings left and right. tops has (tree, hash). Each
    level is one grouping by parent, at most FAN rows each, written to the shared folder.
    """
    paths = nodes.select("tree", "place", F.col("place").alias("now"), F.array().cast("array<struct<left:string,right:string>>").alias("above"))
    level, tops = nodes.select("tree", "place", "hash", "n"), nodes.where("n = 1").select("tree", "hash")
    while True:
        level = level.where("n > 1")
        if level.isEmpty():
            return paths.select("tree", "place", "above"), tops
        parents = level.groupBy("tree", "n", F.floor(F.col("place") / FAN).cast("bigint").alias("up")).agg(F.sort_array(F.collect_list(F.struct("place", "hash"))).alias("kids"))
        parents = keep(parents, "merkle-level")
        hashes = F.transform("kids", lambda k: k["hash"])
        of = parents.select("tree", F.posexplode("kids").alias("at", "kid"), hashes.alias("hashes"))
        cut = lambda start, length: F.array_join(F.slice("hashes", start, length), "")
        step = F.struct(cut(F.lit(1), F.col("at")).alias("left"), cut(F.col("at") + 2, F.lit(FAN)).alias("right"))
        sides = sized(of.select(F.col("tree").alias("t"), F.col("kid.place").alias("p"), step.alias("step")))
        joined = paths.join(sides, (F.col("tree") == F.col("t")) & (F.col("now") == F.col("p")), "left")
        added = F.when(F.col("step").isNull(), F.col("above")).otherwise(F.concat("above", F.array("step")))
        paths = keep(joined.select("tree", "place", F.floor(F.col("now") / FAN).cast("bigint").alias("now"), added.alias("above")), "merkle-paths")
        level = parents.select("tree", F.col("up").alias("place"), F.sha2(F.array_join(hashes, "").cast("binary"), 256).alias("hash"), F.ceil(F.col("n") / FAN).cast("bigint").alias("n"))
        tops = tops.union(level.where("n = 1").select("tree", "hash"))


def manifest(docs: DataFrame, tampered: Column | None = None, block_levels: int = BLOCK_LEVELS) -> DataFrame:
    """One row per row of docs: doc_id, leaf, subroot, root, proof, folded_root, verified.

    A leaf is the hash of the row's fields. The leaves of a source, by doc_id, are the lowest level of its
    tree; every FAN consecutive nodes have a parent, the last ones too, until one is left, the subroot. The
    subroots by source (null first, bytes) are the leaves of the tree whose top is root. proof holds
    the siblings of all levels up to root, left to right. `tampered` is the hash of the leaf as somebody
    changed it, null where nobody did; folded_root is the root of the version with that leaf,
    and verified tells whether it is the root.

    Leaves are numbered in range partitions (a hot source lies in many), and a task builds the lowest three
    levels (block_levels) over aligned blocks of FAN^3 leaves; upper levels, a 4096th of the size, are grouped
    by parent, and the siblings found there come back to the blocks, where each version goes on up to root.
    Rows that repeat a doc_id in a source stand by leaf, equal rows in any order; null ids stand first. All
    fields may be null. A single document is its own subroot and root, with an empty proof. An empty table
    gives no rows; other columns are ignored.
    """
    spark = docs.sparkSession
    rows = pick(docs, *FIELDS)
    tampered = F.lit(None).cast("string") if tampered is None else tampered
    leaves = keep(rows.select("doc_id", "source", leaf_hash(*[F.col(c) for c in FIELDS]).alias("leaf"), tampered.alias("tampered")), "merkle-leaves")
    store = lambda df: keep(df, "merkle-order")
    sources = leaves.groupBy("source").agg(F.count("*").alias("leaves"))
    sources = keep(numbered(sources, [F.asc_nulls_first("source")], out="tree", store=store), "merkle-sources")
    placed = numbered(leaves, ["doc_id", "leaf"], ["source"], "place", store)
    named = sized(sources.select(F.col("source").alias("of"), "tree", "leaves"))
    size = FAN**block_levels
    placed = placed.join(named, F.col("source").eqNullSafe(F.col("of"))).withColumn("block", F.floor(F.col("place") / size).cast("bigint"))
    placed = keep(placed.select("tree", "block", "place", "doc_id", "leaf", "tampered", "leaves"), "merkle-places")

    dealt = placed.select("tree", "block", "place", "leaf", "leaves").repartition("tree", "block").sortWithinPartitions("tree", "place")
    roots = keep(dealt.mapInArrow(_block_roots(block_levels), "tree bigint, place bigint, leaves bigint, hash string"), "merkle-blocks")
    above, tops = climb(roots.withColumn("n", F.ceil(F.col("leaves") / size).cast("bigint")))
    tops = keep(tops, "merkle-subroots")
    of_all, last = climb(tops.select(F.lit(0).cast("bigint").alias("tree"), F.col("tree").alias("place"), "hash", F.lit(sources.count()).cast("bigint").alias("n")))
    root = last.first()
    root = root["hash"] if root else ""

    over = tops.join(sized(of_all.select(F.col("place").alias("t"), F.col("above").alias("over"))), F.col("tree") == F.col("t")).select("t", F.col("hash").alias("subroot"), "over")
    paths = above.join(sized(over), F.col("tree") == F.col("t")).select(F.col("tree").alias("t"), (F.col("place") * size).alias("p"), F.concat("above", "over").alias("above"), "subroot")
    joined = placed.join(sized(paths), (F.col("tree") == F.col("t")) & (F.col("place") == F.col("p")), "left")  # only the first leaf of a block carries its path
    dealt = joined.select("tree", "block", "place", "doc_id", "leaf", "tampered", "leaves", "above", "subroot").repartition("tree", "block").sortWithinPartitions("tree", "place")
    kind = rows.schema["doc_id"].dataType
    found = dealt.mapInArrow(_versions(root, block_levels, to_arrow_type(kind)), f"doc_id {kind.simpleString()}, leaf string, subroot string, proof string, folded_root string, verified boolean")
    return found.select("doc_id", "leaf", "subroot", F.lit(root).alias("root"), "proof", "folded_root", "verified")


def tampered_leaf() -> Column:
    """The leaf's hash with the text's A-Z in lower case, for ids whose crc32 5 divides."""
    changed = leaf_hash(*[F.col(c) for c in FIELDS[:-1]], F.translate("text", UPPER, UPPER.lower()))
    return F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, changed)


def op13_merkle_manifest(spark, sf_dir):
    found = manifest(spark.read.parquet(f"{sf_dir}/documents.parquet"), tampered_leaf())
    return found.select("doc_id", "leaf", "subroot", "root", F.sha2(F.col("proof").cast("binary"), 256).alias("proof_sha256"), "folded_root", "verified")


def _sql(levels: int = 8) -> str:
    """The tree by levels: l0 the leaves, l1 their parents, up to FAN ** levels leaves a tree; then the same over the subroots."""
    field = lambda c: f"CASE WHEN {c} IS NULL THEN '-' ELSE strlen(CAST({c} AS VARCHAR)) || ':' || CAST({c} AS VARCHAR) END"
    lower = f"translate(text, '{UPPER}', '{UPPER.lower()}')"
    leaf = lambda text: "sha256(" + " || ".join([field(c) for c in FIELDS[:-1]] + [field(text)]) + ")"
    bits = "list_reduce(list_prepend(xor(c, b), range(8)), lambda x, i: xor(x >> 1, 3988292384 * (x & 1)))"
    crc = f"xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda d: ord(d)::BIGINT)), lambda c, b: {bits}), 4294967295)"

    def tree(name: str, first: str) -> str:
        out = [f"{name}0 AS ({first})"]
        for k in range(levels):
            beside = lambda rows: f"coalesce(string_agg(hash, '') OVER (PARTITION BY g, place // {FAN} ORDER BY place ROWS BETWEEN {rows}), '')"  # noqa: E731, B023
            out.append(f"{name}s{k} AS (SELECT g, place, n, {beside('UNBOUNDED PRECEDING AND 1 PRECEDING')} AS lft, {beside('1 FOLLOWING AND UNBOUNDED FOLLOWING')} AS rgt FROM {name}{k})")
            up = "CASE WHEN max(n) = 1 THEN min(hash) ELSE sha256(string_agg(hash, '' ORDER BY place)) END"
            out.append(f"{name}{k + 1} AS (SELECT g, place // {FAN} AS place, (max(n) + {FAN - 1}) // {FAN} AS n, {up} AS hash FROM {name}{k} GROUP BY g, place // {FAN})")
        return ", ".join(out)

    def fold(name: str, given: str, key: str) -> str:
        """Steps that carry `folded` and `proof` of each document up a tree."""
        out, before = [], given
        for k in range(levels):
            at = f"{FAN**k}"
            out.append(
                f"{name}f{k} AS (SELECT d.* REPLACE (CASE WHEN s.n = 1 THEN folded ELSE sha256(lft || folded || rgt) END AS folded, proof || lft || rgt AS proof) "
                f"FROM {before} d JOIN {name}s{k} s ON s.g = {key.split(',')[0]} AND s.place = {key.split(',')[1]} // {at})"
            )
            before = f"{name}f{k}"
        return ", ".join(out)

    return f"""
WITH srcs AS (SELECT source AS named, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS src FROM (SELECT DISTINCT source FROM documents)),
d AS (SELECT doc_id, src, {leaf('text')} AS leaf, CASE WHEN {crc} % 5 = 0 THEN {leaf(lower)} END AS changed FROM documents JOIN srcs ON source IS NOT DISTINCT FROM named),
p AS (SELECT *, row_number() OVER (PARTITION BY src ORDER BY doc_id, leaf) - 1 AS place, count(*) OVER (PARTITION BY src) AS n FROM d),
{tree('l', 'SELECT src AS g, place, n, leaf AS hash FROM p')},
{tree('r', f'SELECT 0 AS g, g AS place, count(*) OVER () AS n, hash FROM l{levels}')},
v AS (SELECT doc_id, leaf, src, place, coalesce(changed, leaf) AS folded, '' AS proof FROM p),
{fold('l', 'v', 'd.src,d.place')},
{fold('r', f'lf{levels - 1}', '0,d.src')}
SELECT doc_id, leaf, l{levels}.hash AS subroot, r{levels}.hash AS root, sha256(proof) AS proof_sha256, folded AS folded_root, folded = r{levels}.hash AS verified
FROM rf{levels - 1} f JOIN l{levels} ON l{levels}.g = f.src CROSS JOIN r{levels}
"""


OP13_SQL = _sql()
