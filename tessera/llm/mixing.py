"""Mixes sources to target weights: Sainte-Laguë quotas of equal blocks per source and shard, seeded blocks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import keep, n_words, pick
from tessera.session import sized

#: Words of a block, and blocks of a shard at most (but for the document that ends it).
BLOCK = 256
SHARD_BLOCKS = 512
SEED = 20
WEIGHTS = (5, 2, 1)
SHARE = 1.5
MOST = 2


def targets(sources: DataFrame, weights=WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """Adds target to one row per source (source, source_size).

    Sources by code point, null last, weigh by turns. What a source can't take beyond
    `most` times its size goes to the others by weight. That fixed point is the level at
    which target = min(most * size, weight * level): sources by most * size / weight fill up
    in that order, and the level follows from the sums before each.
    """
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    turns = F.array(*[F.lit(float(w)) for w in weights])
    rows = sources.withColumn("w", F.get(turns, (rank % len(weights)).cast("int"))).withColumn("cap", F.lit(float(most)) * F.col("source_size"))
    filled = Window.orderBy(F.col("cap") / F.col("w"), F.col("source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    whole = F.lit(float(share)) * F.sum("source_size").over(everything)
    rows = rows.withColumn("level", (whole - F.coalesce(F.sum("cap").over(filled), F.lit(0.0))) / (F.sum("w").over(everything) - F.coalesce(F.sum("w").over(filled), F.lit(0.0))))
    # the first source in that order that does not fill up, and with it all after it, stand at its level
    open_ = F.when(F.col("w") * F.col("level") < F.col("cap"), F.struct((F.col("cap") / F.col("w")).alias("at"), rank.alias("rank"), "level"))
    level = F.min(open_).over(everything)["level"]
    target = F.coalesce(F.least(F.col("cap"), F.col("w") * level), F.col("cap"))
    return rows.withColumn("target", target).select("source", "source_size", "target")


def apportion(parties: DataFrame, seats: Column, weight: Column, within: list[str], order: list[Column]) -> DataFrame:
    """Adds quota: whole seats by the highest quotients weight / (2k + 1), within each group.

    All quotients above half of W / (seats - m / 2) win and none below half of
    W / (seats + m / 2) does (W: sum of weights, m: parties), so at most two quotients a party
    are ranked instead of all seats. Equal quotients go by `order`. Weights of 0 get none.
    """
    group = Window.partitionBy(*within)
    rows = parties.withColumn("_w", weight.cast("double")).withColumn("_seats", seats.cast("double"))
    rows = rows.withColumn("_sum", F.sum("_w").over(group)).withColumn("_m", F.count("*").over(group))
    high, low = F.col("_seats") - F.col("_m") / 2, F.col("_seats") + F.col("_m") / 2
    sure = F.when((high > 0) & (F.col("_sum") > 0), F.floor(F.col("_w") * high / F.nullif("_sum", F.lit(0.0)) + 0.5 - 1e-9)).otherwise(F.lit(0))
    upper = F.when(F.col("_sum") > 0, F.floor(F.col("_w") * low / F.nullif("_sum", F.lit(0.0)) + 0.5 + 1e-9)).otherwise(F.lit(0))
    rows = rows.withColumn("_sure", F.greatest(sure, F.lit(0)).cast("bigint")).withColumn("_upper", F.greatest(upper, F.col("_sure")).cast("bigint"))
    rows = rows.withColumn("_rest", F.col("_seats") - F.sum("_sure").over(group))
    open_ = F.when((F.col("_upper") > F.col("_sure")) & (F.col("_w") > 0), F.sequence(F.col("_sure"), F.col("_upper") - 1))
    names = parties.columns
    rows = rows.withColumn("_k", F.explode_outer(open_))
    rows = rows.withColumn("_q", F.col("_w") / (2 * F.col("_k") + 1))
    place = F.row_number().over(Window.partitionBy(*within).orderBy(F.col("_q").desc_nulls_last(), *order, F.col("_k")))
    rows = rows.withColumn("_won", F.when(F.col("_k").isNotNull() & (place <= F.col("_rest")), 1).otherwise(0))
    return rows.groupBy(*names, "_sure").agg(F.sum("_won").alias("_won")).select(*names, (F.col("_sure") + F.col("_won")).alias("quota"))


def block_words(total: Column, sources: Column, block: int = BLOCK) -> Column:
    """Words of a block: `block`, or less where that is over half a percent of a source's mean share."""
    return F.greatest(F.least(F.floor(total / (sources * 200)), F.lit(block)), F.lit(1)).cast("bigint")


def mix(docs: DataFrame, weights=WEIGHTS, share: float = SHARE, most: int = MOST, block: int = BLOCK, shard_blocks: int = SHARD_BLOCKS, seed: int = SEED, carried: tuple[str, ...] = ()) -> DataFrame:
    """One row per row of docs: doc_id, size, source_size, target, taken, spans, and the carried columns.

    A source is dealt by a hash of the id into shards of about shard_blocks blocks, so a
    source with a third of all rows is many shards. In a shard, documents stand end to end in
    seeded order and are cut into blocks of equal words (one more or less). Sainte-Laguë gives
    the sources their quota of blocks by target, and a source's shards theirs by words. A shard
    takes every block quota // blocks times and the rest once more by seeded rank. taken counts
    the words of a document in blocks taken, repeats included; spans holds its parts by block
    (from, to in words, copies). No block is taken more than `most` times.

    Null texts have size 0, take 0 and have no spans. Null sources are a source of their own,
    the last. Rows that repeat an id stand side by side and each is taken for itself. An empty
    table gives no rows. Other columns are ignored. Reruns agree, as all orders are those of hashes.
    """
    whole_rows = pick(docs, *dict.fromkeys(["doc_id", "source", "text", *carried])).withColumn("size", n_words(F.col("text")))
    rows = keep(whole_rows.select("doc_id", "source", "size"), "sizes")
    whole = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    sources = targets(rows.groupBy("source").agg(F.sum("size").alias("source_size")), weights, share, most)
    sources = sources.withColumn("block", block_words(F.sum("target").over(whole), F.count("*").over(whole), block))
    sources = sources.withColumn("n_shards", F.greatest(F.ceil(F.col("source_size") / (F.col("block") * shard_blocks)), F.lit(1)))
    sources = sources.withColumn("sid", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())))
    sources = sources.withColumn("seats", F.round(F.sum("target").over(whole) / F.col("block"))).withColumn("one", F.lit(1))
    sources = keep(apportion(sources, F.col("seats"), F.col("target"), ["one"], [F.col("sid")]), "sources")

    key = F.md5(F.concat_ws(":", F.lit(str(seed)), F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))).cast("binary"))
    narrow = sources.select(F.col("source").alias("of"), "sid", "n_shards", "source_size", "target")
    dealt = whole_rows.select(*dict.fromkeys(["doc_id", "source", "size", *carried])) if carried else rows
    placed = dealt.join(sized(narrow), F.col("source").eqNullSafe(F.col("of"))).withColumn("key", key)
    shard = F.pmod(F.conv(F.substring("key", 1, 8), 16, 10).cast("bigint"), F.col("n_shards"))
    placed = placed.withColumn("shard", shard)

    sizes = rows.join(sized(narrow), F.col("source").eqNullSafe(F.col("of"))).withColumn("key", key) if carried else placed
    shards = sizes.withColumn("shard", shard).groupBy("sid", "shard").agg(F.sum("size").alias("shard_size"))
    shards = shards.join(sized(sources.select("sid", "block", F.col("quota").alias("source_quota"))), "sid")
    shards = apportion(shards, F.col("source_quota"), F.col("shard_size"), ["sid"], [F.col("shard")])
    blocks = F.greatest(F.round(F.col("shard_size") / F.col("block")), F.lit(1)).cast("int")
    shards = shards.withColumn("blocks", blocks).withColumn("quota", F.least("quota", most * F.col("blocks")))
    rank = F.array_sort(
        F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda k: F.struct(F.md5(F.concat_ws(":", F.lit(str(seed)), "sid", "shard", k.cast("string")).cast("binary")).alias("key"), k.alias("k")))
    )
    copies = F.transform(rank, lambda x, place: F.struct(x["k"].alias("k"), (F.floor(F.col("quota") / F.col("blocks")) + F.when(place < F.col("quota") % F.col("blocks"), 1).otherwise(0)).cast("int").alias("c")))
    shards = shards.select("sid", "shard", "shard_size", "blocks", F.transform(F.array_sort(copies), lambda x: x["c"]).alias("copies"))

    before = Window.partitionBy("sid", "shard").orderBy("key", "size").rowsBetween(Window.unboundedPreceding, -1)
    placed = placed.withColumn("start", F.coalesce(F.sum("size").over(before), F.lit(0)))
    placed = placed.join(keep(shards, "shards"), ["sid", "shard"]).withColumn("end", F.col("start") + F.col("size"))

    def edge(k: Column) -> Column:  # the first word of block k
        return F.floor((k.cast("bigint") * F.col("shard_size") + F.col("blocks") - 1) / F.col("blocks"))

    first = F.floor(F.col("start") * F.col("blocks") / F.col("shard_size")).cast("int")
    last = F.floor((F.col("end") - 1) * F.col("blocks") / F.col("shard_size")).cast("int")
    spans = F.when(
        F.col("size") > 0,
        F.transform(
            F.sequence(first, last),
            lambda k: F.struct(
                (F.greatest(edge(k), "start") - F.col("start")).alias("from"),
                (F.least(edge(k + 1), "end") - F.col("start")).alias("to"),
                F.get("copies", k).alias("copies"),
            ),
        ),
    ).otherwise(F.array().cast("array<struct<from:bigint,to:bigint,copies:int>>"))
    placed = placed.withColumn("spans", spans)
    taken = F.aggregate("spans", F.lit(0).cast("bigint"), lambda total, x: total + (x["to"] - x["from"]) * x["copies"])
    return placed.select("doc_id", "size", "source_size", "target", taken.alias("taken"), "spans", *[c for c in carried if c != "doc_id"])


def op2_mix_sources(spark, sf_dir):
    return mix(spark.read.parquet(f"{sf_dir}/documents.parquet")).drop("spans")


OP2_SQL = f"""
WITH d AS (
    SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0)::BIGINT AS size FROM documents
), s0 AS (
    SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) AS sid FROM d GROUP BY source
), s1 AS (
    SELECT *, [{", ".join(f"{float(w)}::DOUBLE" for w in WEIGHTS)}][((sid - 1) % {len(WEIGHTS)} + 1)::INT] AS w, {float(MOST)}::DOUBLE * source_size AS cap FROM s0
), s2 AS (
    SELECT *, ({SHARE}::DOUBLE * sum(source_size) OVER () - coalesce(sum(cap) OVER f, 0)) / (sum(w) OVER () - coalesce(sum(w) OVER f, 0)) AS own
    FROM s1 WINDOW f AS (ORDER BY cap / w, sid ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), s3 AS (
    SELECT s2.*, coalesce(least(cap, w * (SELECT own FROM s2 WHERE w * own < cap ORDER BY cap / w, sid LIMIT 1)), cap) AS target FROM s2
), s4 AS (
    SELECT *, greatest(least(floor(sum(target) OVER () / (count(*) OVER () * 200)), {BLOCK}), 1)::BIGINT AS block FROM s3
), s5 AS (
    SELECT *, greatest(ceil(source_size / (block * {SHARD_BLOCKS})), 1)::BIGINT AS n_shards, round(sum(target) OVER () / block)::BIGINT AS seats FROM s4
), q1 AS (
    SELECT sid, row_number() OVER (ORDER BY target / (2 * k + 1) DESC, sid, k) <= seats AS won
    FROM (SELECT sid, target, seats, unnest(range(seats)) AS k FROM s5 WHERE target > 0)
), s AS (
    SELECT s5.*, coalesce(n, 0) AS quota FROM s5 LEFT JOIN (SELECT sid, count(*) AS n FROM q1 WHERE won GROUP BY sid) USING (sid)
), p AS (
    SELECT d.doc_id, d.size, s.sid, s.source_size, s.target, s.n_shards, md5('{SEED}:' || coalesce(doc_id::VARCHAR, 'null')) AS key
    FROM d JOIN s ON d.source IS NOT DISTINCT FROM s.source
), p2 AS (
    SELECT *, ('0x' || substr(key, 1, 8))::BIGINT % n_shards AS shard FROM p
), p3 AS (
    SELECT *, coalesce(sum(size) OVER (PARTITION BY sid, shard ORDER BY key, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS start FROM p2
), h AS (
    SELECT sid, shard, sum(size)::BIGINT AS shard_size FROM p2 GROUP BY sid, shard
), q2 AS (
    SELECT sid, shard, row_number() OVER (PARTITION BY sid ORDER BY shard_size::DOUBLE / (2 * k + 1) DESC, shard, k) <= quota AS won
    FROM (SELECT h.*, s.quota, unnest(range(s.quota)) AS k FROM h JOIN s USING (sid) WHERE shard_size > 0)
), h2 AS (
    SELECT h.*, greatest(round(shard_size / block), 1)::BIGINT AS blocks, coalesce(n, 0) AS won
    FROM h JOIN s USING (sid) LEFT JOIN (SELECT sid, shard, count(*) AS n FROM q2 WHERE won GROUP BY sid, shard) USING (sid, shard)
), b AS (
    SELECT sid, shard, k, (k * shard_size + blocks - 1) // blocks AS lo, ((k + 1) * shard_size + blocks - 1) // blocks AS hi,
        least(won, {MOST} * blocks) AS quota, blocks,
        row_number() OVER (PARTITION BY sid, shard ORDER BY md5('{SEED}:' || sid || ':' || shard || ':' || k)) AS place
    FROM (SELECT *, unnest(range(blocks)) AS k FROM h2)
), t AS (
    SELECT p3.*, b.quota // b.blocks + (b.place <= b.quota % b.blocks)::INT AS copies, least(b.hi, start + size) - greatest(b.lo, start) AS part
    FROM p3 LEFT JOIN b ON p3.sid = b.sid AND p3.shard = b.shard AND b.lo < start + size AND b.hi > start AND size > 0
)
SELECT doc_id, any_value(size) AS size, any_value(source_size) AS source_size, any_value(target) AS target,
    coalesce(sum(copies * part), 0)::BIGINT AS taken
FROM t GROUP BY sid, shard, key, start, doc_id, size
"""
