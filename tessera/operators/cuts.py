"""Exact samples, splits and medians without a global sort.

Random order is the order of a hashed key, so a sample does not depend on the
partitioning and the same rows come back on every run. To take the n first rows of
a group, the rows are counted per leading hex digits of the key, a running sum over
these counts finds the digits that hold rank n, and only that bucket is looked at
more closely. No group is sorted whole, however many rows one class holds; the
rows themselves (images, features) are only filtered, never shuffled.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.session import BROADCAST_ROWS, settle

SEED = 42
# Hex digits looked at per step: at most 4096 counts per group.
DIGITS = 3
# A bucket this small is ranked directly.
BUCKET_ROWS = 100_000
# Value ranges per step when a rank is looked for among numbers.
RANGES = 1024
# A range with no more rows than this is ranked directly.
RANGE_ROWS = 10_000


def sample_key(identity: Column, seed: int = SEED) -> Column:
    """Hash of a unique id; the order of these keys is the random order."""
    return F.md5(F.concat(identity.cast("string"), F.lit(f"-{seed}")))


def _known(key: Column) -> Column:
    """The key; an error for a null one, which has no place in any order."""
    return F.when(key.isNotNull(), key).otherwise(F.raise_error(F.lit("a sample needs ids that are not null")).cast("string"))


def _single(key: Column, following: Column) -> Column:
    """The key of the last row taken; an error when the first row not taken has the same."""
    return F.when(following.isNull() | (following != key), key).otherwise(
        F.raise_error(F.lit("rows with one id lie on both sides of the cut; a sample needs unique ids")).cast("string")
    )


def _same(by: list[str], left: str, right: str) -> Column:
    same = F.lit(True)
    for name in by:
        same = same & F.col(f"{left}.{name}").eqNullSafe(F.col(f"{right}.{name}"))
    return same


def _held_at(rank: str, order: str, by: list[str]) -> tuple[Column, Column]:
    """Condition that a line of counts (held) covers the rank, and the rank inside that line."""
    window = Window.partitionBy(*by).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    up_to = F.sum("held").over(window)
    inside = F.col(rank) - up_to + F.col("held")
    return (inside > 0) & (up_to >= F.col(rank)), inside


def cut_key(df: DataFrame, key: Column, rows: int | Column) -> str | None:
    """Key of the row at rank `rows` in the whole frame; rows may use the column `total`.

    None when the frame has fewer rows or rows is 0. Null ids, and an id that repeats across the
    cut, are errors.
    """
    keys = df.select(_known(key).alias("sample_key"))
    rank = F.lit(rows) if isinstance(rows, int) else rows
    prefix, held = "", BUCKET_ROWS + 1
    while held > BUCKET_ROWS and len(prefix) < 32:
        buckets = (
            keys.where(F.col("sample_key").startswith(prefix))
            .groupBy(F.substring("sample_key", 1, len(prefix) + DIGITS).alias("bucket"))
            .agg(F.count("*").alias("held"))
            .withColumn("total", F.sum("held").over(Window.partitionBy()))
            .withColumn("rank", rank.cast("bigint"))
        )
        covers, inside = _held_at("rank", "bucket", [])
        line = buckets.withColumn("covers", covers).withColumn("inside", inside).where("covers").first()
        if line is None:
            return None
        prefix, held, rank = line["bucket"], line["held"], F.lit(line["inside"])
    order = Window.partitionBy().orderBy("sample_key")
    bucket = keys.where(F.col("sample_key").startswith(prefix)).withColumn("place", F.row_number().over(order))
    bucket = bucket.withColumn("next", F.lead("sample_key").over(order)).where(F.col("place") == rank)
    return bucket.select(_single(F.col("sample_key"), F.col("next")).alias("sample_key")).first()["sample_key"]


def cut_keys(df: DataFrame, key: Column, rows: int, by: list[str]) -> DataFrame:
    """Per group, the key of the row at rank `rows`; a group with fewer rows gets no line.

    Null ids, and an id that repeats across a cut, are errors.
    """
    keyed = df.select(*by, _known(key).alias("sample_key"))
    cuts, digits, largest = None, 0, BUCKET_ROWS + 1
    bucket_of = lambda n: F.substring(F.col("p.sample_key"), 1, n)
    while largest > BUCKET_ROWS and digits < 32:
        pool = keyed.withColumn("rank", F.lit(rows).cast("bigint"))
        if cuts is not None:
            same = _same(by, "p", "c") & (bucket_of(digits) == F.col("c.bucket"))
            pool = keyed.alias("p").join(cuts.alias("c"), same).select("p.*", F.col("c.inside").alias("rank"))
        digits += DIGITS
        buckets = pool.groupBy(*by, F.substring("sample_key", 1, digits).alias("bucket")).agg(
            F.count("*").alias("held"), F.max("rank").alias("rank")
        )
        covers, inside = _held_at("rank", "bucket", by)
        found = buckets.withColumn("covers", covers).withColumn("inside", inside).where("covers")
        cuts = settle(found.select(*by, "bucket", "held", "inside"))
        largest, groups = cuts.agg(F.coalesce(F.max("held"), F.lit(0)), F.count("*")).first()
        cuts = F.broadcast(cuts) if groups <= BROADCAST_ROWS else cuts
    same = _same(by, "p", "c") & (bucket_of(digits) == F.col("c.bucket"))
    order = Window.partitionBy(*by).orderBy("sample_key")
    ends = (
        keyed.alias("p")
        .join(cuts.alias("c"), same)
        .select("p.*", "c.inside")
        .withColumn("place", F.row_number().over(order))
        .withColumn("next", F.lead("sample_key").over(order))
        .where(F.col("place") == F.col("inside"))
        .select(*by, _single(F.col("sample_key"), F.col("next")).alias("cut_key"))
    )
    return F.broadcast(ends) if groups <= BROADCAST_ROWS else ends


def sample_per_class(df: DataFrame, n: int, by: list[str], key: Column) -> DataFrame:
    """Up to n random rows per class; a smaller class is kept whole."""
    if n < 1:
        raise ValueError("n must be at least 1")
    keyed = df.withColumn("sample_key", key).alias("d")
    marked = keyed.join(cut_keys(df, key, n, by).alias("c"), _same(by, "d", "c"), "left")
    kept = F.col("c.cut_key").isNull() | (F.col("d.sample_key") <= F.col("c.cut_key"))
    return marked.where(kept).select("d.*").drop("sample_key")


def balanced_sample(df: DataFrame, n: int, by: list[str], key: Column) -> DataFrame:
    """Exactly n random rows per class; an error when a class has fewer."""
    smallest = df.groupBy(*by).count().agg(F.min("count")).first()[0]
    if smallest is None or smallest < n:
        raise ValueError(f"cannot draw {n} rows per class: the smallest class has {smallest}")
    return sample_per_class(df, n, by, key)


def sample_rows(df: DataFrame, n: int, key: Column) -> DataFrame:
    """n random rows of the whole frame, all rows when it has fewer."""
    cut = cut_key(df, key, n)
    return df.where(key <= cut) if cut else df.where(F.lit(n > 0))


def shuffle_rows(df: DataFrame, key: Column) -> DataFrame:
    """Random order by a range-partitioned sort on the key."""
    return df.withColumn("sample_key", key).orderBy("sample_key").drop("sample_key")


def split_exact(df: DataFrame, share: float, key: Column) -> DataFrame:
    """First floor(share * rows) rows in key order get part 'train', the rest 'validation'."""
    cut = cut_key(df, key, F.floor(F.col("total") * share))
    train = key <= cut if cut else F.lit(False)
    return df.withColumn("part", F.when(train, "train").otherwise("validation"))


def split_tail(df: DataFrame, share: float, order: str) -> DataFrame:
    """The same in the order of a unique number: the last rows become 'validation'. Nulls and repeats across the cut are errors."""
    found = values_at(df, order, [], lambda total: [F.floor(total * share)])
    line = found.first()
    train = F.col(order) <= line["value"] if line else F.lit(False)
    total, known, first = df.agg(F.count("*"), F.count(order), F.count(F.when(train, 1))).first()
    if known < total or first != int(total * share):
        raise ValueError(f"a split by {order} needs numbers that are unique and not null")
    return df.withColumn("part", F.when(train, "train").otherwise("validation"))


def split_hashed(key: Column, share: float) -> Column:
    """'train' or 'test' by the size of the hash: near the share, stable for every single row."""
    limit = format(min(int(share * 2**32), 2**32 - 1), "08x")
    return F.when(F.substring(key, 1, 8) < limit, "train").otherwise("test")


def fold_of(key: Column, folds: int) -> Column:
    """Fold number 0..folds-1 from the hash."""
    return F.pmod(F.conv(F.substring(key, 1, 8), 16, 10).cast("bigint"), F.lit(folds)).cast("int")


def rows_between(df: DataFrame, key: Column, offset: int, length: int) -> DataFrame:
    """Rows offset .. offset + length - 1 in key order."""
    upper = cut_key(df, key, offset + length)
    lower = cut_key(df, key, offset) if offset else None
    if offset and lower is None:
        return df.where(F.lit(False))
    kept = df.where(key <= upper) if upper else df
    return kept.where(key > lower) if lower else kept


def _step(kind: T.DataType) -> Column:
    """Place of v in its range lo..hi, 0..RANGES-1.

    The ends always fall into the first and the last step, so a range shrinks with every
    pass also where differences overflow or are not numbers.
    """
    v, lo, hi = F.col("v"), F.col("lo"), F.col("hi")
    if isinstance(kind, T.IntegralType):
        gap = lambda x: F.try_subtract(x, lo).cast("double")
    else:
        gap = lambda x: x.cast("double") / 2 - lo.cast("double") / 2
    share = F.coalesce(F.nanvl(F.try_divide(gap(v), gap(hi)), F.lit(0.5)), F.lit(0.5))
    between = F.least(F.lit(RANGES - 1), F.greatest(F.lit(0), F.floor(share * RANGES)))
    return F.when(v == lo, 0).when(v == hi, RANGES - 1).otherwise(between)


def values_at(df: DataFrame, value: str, by: list[str], ranks: Callable[[Column], list[Column]]) -> DataFrame:
    """Values at the given ranks of each group (by, rank, value), exact.

    ranks turns the number of rows of a group into 1-based ranks. While a range holds many
    rows it is cut into equal steps, and the step that holds the rank becomes the new
    range, with its own smallest and largest value. Every pass reads the column and
    merges it into counts per step before the shuffle; the values themselves are only
    moved when few are left.
    """
    rows = df.where(F.col(value).isNotNull()).select(*by, F.col(value).alias("v"))
    asked = F.explode(F.array_distinct(F.array(*[r.cast("bigint") for r in ranks(F.col("held"))])))
    state = settle(
        rows.groupBy(*by)
        .agg(F.min("v").alias("lo"), F.max("v").alias("hi"), F.count("*").alias("held"))
        .select(*by, "lo", "hi", "held", asked.alias("rank"))
        .where("rank > 0")
        .withColumn("ask", F.col("rank"))
    )
    single = F.col("lo") == F.col("hi")
    wide = ~single & (F.col("held") > RANGE_ROWS)

    def pool(state: DataFrame, lines: int) -> DataFrame:
        """Rows inside the ranges; a range that several ranks share is taken once."""
        ranges = state.select(*by, "lo", "hi").distinct()
        side = F.broadcast(ranges) if lines <= BROADCAST_ROWS else ranges
        inside = _same(by, "p", "c") & F.col("p.v").between(F.col("c.lo"), F.col("c.hi"))
        return rows.alias("p").join(side.alias("c"), inside).select("p.*", "c.lo", "c.hi")

    def ranked(lines: DataFrame, state: DataFrame) -> DataFrame:
        """Lines of ranges beside the ranks asked of them."""
        match = _same(by, "l", "s") & F.col("l.lo").eqNullSafe(F.col("s.lo"))
        return lines.alias("l").join(state.alias("s"), match).select("l.*", "s.rank", "s.ask")

    while True:
        lines, open_lines = state.agg(F.count("*"), F.count(F.when(wide, 1))).first()
        if not open_lines:
            break
        steps = (
            pool(state.where(wide), open_lines)
            .withColumn("step", _step(rows.schema["v"].dataType))
            .groupBy(*by, "lo", "step")
            .agg(F.count("*").alias("held"), F.min("v").alias("first"), F.max("v").alias("hi"))
        )
        covers, inside = _held_at("rank", "step", [*by, "ask"])
        found = ranked(steps, state.where(wide)).withColumn("covers", covers).withColumn("inside", inside)
        narrowed = found.where("covers").select(
            *by, F.col("first").alias("lo"), "hi", "held", F.col("inside").alias("rank"), "ask"
        )
        state = settle(state.where(~wide).unionByName(narrowed))
    place = F.row_number().over(Window.partitionBy(*by, "lo").orderBy("v"))
    numbered = pool(state.where(~single), lines).withColumn("place", place)
    last = ranked(numbered, state.where(~single)).where(F.col("place") == F.col("rank"))
    done = state.where(single).select(*by, F.col("ask").alias("rank"), F.col("lo").alias("value"))
    return done.unionByName(last.select(*by, F.col("ask").alias("rank"), F.col("v").alias("value")))


def medians(df: DataFrame, value: str, by: list[str]) -> DataFrame:
    """Exact median per group."""
    middle = lambda total: [F.floor((total + 1) / 2), F.floor(total / 2) + 1]
    found = values_at(df, value, by, middle)
    return found.groupBy(*by).agg(F.avg(F.col("value").cast("double")).alias("median"))
