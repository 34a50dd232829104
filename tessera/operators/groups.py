"""Duplicates and one-row-per-key picks that survive a very common key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.session import settle, sized

# A key shared by at least this many rows is handled apart, by broadcast.
HOT_ROWS = 100_000


def fingerprint(text: Column) -> Column:
    """Short stand-in for a long key; takes in the whole text."""
    return F.sha2(text, 256)


def duplicate_rows(df: DataFrame, key: Column) -> DataFrame:
    """Number of rows that share their key with another row; all of them count."""
    counts = df.groupBy(key.alias("key")).agg(F.count("*").alias("n"))
    return counts.agg(F.coalesce(F.sum(F.when(F.col("n") > 1, F.col("n"))), F.lit(0)).alias("duplicates"))


def flag_duplicates(df: DataFrame, key: Column, hot_rows: int = HOT_ROWS) -> DataFrame:
    """The frame with is_duplicate per row.

    Rows of a hot key would all meet in one task of a shuffle join. Such keys are at
    most rows / hot_rows many, so they are broadcast; the other rows are joined by key.
    Null keys equal each other, as they do in duplicate_rows.
    """
    keyed = df.withColumn("dup_key", F.struct(key.alias("k")))
    repeated = settle(keyed.groupBy("dup_key").agg(F.count("*").alias("n")).where("n > 1"))
    hot = repeated.where(F.col("n") >= hot_rows).select("dup_key")
    cold = repeated.where(F.col("n") < hot_rows).select("dup_key", F.lit(True).alias("cold"))
    if hot.limit(1).count() == 0:
        return _flag(keyed, cold)
    hot = sized(hot)
    common = keyed.join(hot, "dup_key", "left_semi").withColumn("is_duplicate", F.lit(True)).drop("dup_key")
    others = keyed.join(hot, "dup_key", "left_anti")
    return common.unionByName(_flag(others, cold))


def _flag(keyed: DataFrame, cold: DataFrame) -> DataFrame:
    return (
        keyed.join(sized(cold), "dup_key", "left")
        .withColumn("is_duplicate", F.coalesce("cold", F.lit(False)))
        .drop("dup_key", "cold")
    )


def distinct_by(df: DataFrame, key: Column, identity: str) -> DataFrame:
    """One row per key: the one with the lowest id.

    Keys and ids alone are aggregated, merged before the shuffle. The ids to leave out
    are unique, so nothing is skewed, and while they are few the rows stay in place.
    """
    chosen = df.groupBy(key.alias("dup_key")).agg(F.min(identity).alias(identity)).select(identity)
    spare = settle(df.select(identity).join(chosen, identity, "left_anti"))
    return df.join(sized(spare), identity, "left_anti")


def first_per_class(df: DataFrame, by: str, identity: str) -> DataFrame:
    """The row with the lowest id of each class."""
    chosen = settle(df.groupBy(by).agg(F.min(identity).alias(identity)).select(identity))
    return df.join(sized(chosen), identity, "left_semi")


def random_per_class(df: DataFrame, by: str, key: Column) -> DataFrame:
    """One random row of each class: the one with the lowest hashed key."""
    chosen = settle(df.groupBy(by).agg(F.min(key).alias("pick_key")).select("pick_key"))
    keyed = df.withColumn("pick_key", key)
    return keyed.join(sized(chosen), "pick_key", "left_semi").drop("pick_key")
