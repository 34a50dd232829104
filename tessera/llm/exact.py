"""Exact duplicates by progressive refinement: length, then prefix hash, then hash of the whole text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import keep, pick
from tessera.session import sized

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: Code points of the start of a text that the second step hashes.
PREFIX = 128


def folded(text: Column) -> Column:
    """The text with A-Z alone in lower case; null counts as empty."""
    text = F.coalesce(text, F.lit(""))
    plain = F.octet_length(text) == F.char_length(text)  # ASCII only: lower() does the same at less cost
    return F.when(plain, F.lower(text)).otherwise(F.translate(text, UPPER, UPPER.lower()))


def text_hash(text: Column) -> Column:
    """SHA-256 of the folded text in UTF-8, lower-case hex."""
    return F.sha2(folded(text).cast("binary"), 256)


def duplicate_groups(docs: DataFrame) -> DataFrame:
    """One row per group of two or more equal texts: len, prefix, full, keep_id, group_size.

    Three rounds, each on what the last one left. Lengths that occur once are done;
    of the others the hash of the first code points is compared, and only groups that
    share it have their whole text read and hashed. Counts are merged before each
    shuffle, so a group of any size is a few rows per task.

    The surviving (length, prefix) pairs select the texts to read by a broadcast whose
    size is checked. Beyond that size each row's hash is taken in the scan instead,
    since moving texts through a shuffle costs more than hashing them.
    """
    docs = pick(docs, "doc_id", "text")
    text = F.coalesce(F.col("text"), F.lit(""))
    keys = keep(
        docs.select(F.octet_length(text).alias("len"), F.xxhash64(folded(F.substring(text, 1, PREFIX))).alias("prefix"))
        .groupBy("len", "prefix")
        .agg(F.count("*").alias("n")),
        "prefixes",
    )
    lengths = keys.groupBy("len").agg(F.sum("n").alias("n")).where("n > 1").select("len")
    pairs = keys.join(lengths, "len", "left_semi").where("n > 1").select("len", "prefix")
    chosen = sized(pairs)
    rows = docs.select("doc_id", "text", F.octet_length(text).alias("len"), F.xxhash64(folded(F.substring(text, 1, PREFIX))).alias("prefix"))
    hashed = ["doc_id", "len", "prefix", text_hash(F.col("text")).alias("full")]
    if chosen is pairs:
        rows = rows.select(*hashed).join(pairs, ["len", "prefix"], "left_semi")
    else:
        rows = rows.join(chosen, ["len", "prefix"], "left_semi").select(*hashed)
    return rows.groupBy("len", "prefix", "full").agg(F.max("doc_id").alias("keep_id"), F.count("*").alias("group_size")).where("group_size > 1")


def exact_dedup(docs: DataFrame, carried: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """One row per row of docs: the carried columns, keep_id, group_size, kept, text_sha256.

    Texts are equal when identical after lower-casing A-Z; null counts as empty, so all
    null and empty texts are one group. Of a group the largest doc_id stays. A null
    doc_id never wins over another; in a group of null ids alone keep_id is null and
    all rows stay. Rows that repeat an id with its text are one document: each comes back
    and all are marked alike. An empty table gives no rows; other columns are ignored.
    """
    groups = keep(duplicate_groups(docs), "groups")
    rows = pick(docs, *dict.fromkeys(["doc_id", "text", *carried])).select(*dict.fromkeys(["doc_id", *carried]), text_hash(F.col("text")).alias("full"))
    joined = rows.join(sized(groups.select("full", F.col("keep_id").alias("of"), "group_size")), "full", "left")
    alone = F.col("group_size").isNull()
    keep_id = F.when(alone, F.col("doc_id")).otherwise(F.col("of"))
    return joined.select(
        *carried,
        keep_id.alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("bigint").alias("group_size"),
        F.col("doc_id").eqNullSafe(keep_id).alias("kept"),
        F.col("full").alias("text_sha256"),
    )


def op7_exact_dedup(spark, sf_dir):
    return exact_dedup(spark.read.parquet(f"{sf_dir}/documents.parquet"))


OP7_SQL = f"""
WITH t AS (
    SELECT doc_id, translate(coalesce(text, ''), '{UPPER}', '{UPPER.lower()}') AS x FROM documents
), g AS (
    SELECT doc_id, x, max(doc_id) OVER (PARTITION BY x) AS keep_id, count(*) OVER (PARTITION BY x) AS group_size FROM t
)
SELECT doc_id, keep_id, group_size, doc_id IS NOT DISTINCT FROM keep_id AS kept, sha256(x) AS text_sha256 FROM g
"""
