"""Places and running sums over whole frames and hot groups by two-pass prefix sums.

Rows are dealt into ranges of the order and sorted there, with the partition and the place in it written
beside them. One line per partition and group (its rows, or its sum) is enough to say what comes
before it, so neither a frame nor a group is ever gathered in one task. The written rows fix the partitions,
so numbers stay the same when a task is run again.
"""

from __future__ import annotations

from collections.abc import Callable
from itertools import accumulate

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.session import settle, sized

PART, LOCAL, BEFORE, FIRST = "numbering_part", "numbering_local", "numbering_before", "numbering_first"


def _in_ranges(df: DataFrame, order: list[str | Column], by: list[str], store: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """The rows with their partition and place in it, written. Equal rows are told apart by where they lie, so that none of them gather."""
    if order or by:
        keys = [*[F.col(name) for name in by], *[F.col(o) if isinstance(o, str) else o for o in order], F.col(LOCAL)]
        df = df.withColumn(LOCAL, F.monotonically_increasing_id()).repartitionByRange(*keys).sortWithinPartitions(*keys)
    part = F.spark_partition_id()
    return store(df.withColumn(PART, part).withColumn(LOCAL, F.monotonically_increasing_id().bitwiseAND(F.lit(2**33 - 1))))


def _before(rows: DataFrame, by: list[str], amount: Column) -> DataFrame:
    """What the earlier partitions of a group hold, a line for each partition and group, and the group's first place in the partition."""
    lines = rows.groupBy(PART, *by).agg(amount.alias("amount"), F.min(LOCAL).alias(FIRST))
    if by:
        earlier = Window.partitionBy(*by).orderBy(PART).rowsBetween(Window.unboundedPreceding, -1)
        return lines.withColumn(BEFORE, F.sum("amount").over(earlier)).drop("amount")
    kind = lines.schema["amount"].dataType.simpleString()
    found = lines.orderBy(PART).collect()  # one line a partition
    sums = accumulate((r["amount"] for r in found), lambda a, b: b if a is None else a if b is None else a + b)
    so_far = [None, *sums][: len(found)]
    return rows.sparkSession.createDataFrame([(r[PART], r[FIRST], s) for r, s in zip(found, so_far)], f"{PART} int, {FIRST} bigint, {BEFORE} {kind}")


def _beside(rows: DataFrame, lines: DataFrame, by: list[str]) -> DataFrame:
    same = F.col(f"r.{PART}") == F.col(f"l.{PART}")
    for name in by:
        same = same & F.col(f"r.`{name}`").eqNullSafe(F.col(f"l.`{name}`"))
    return rows.alias("r").join(sized(lines).alias("l"), same).select("r.*", f"l.{BEFORE}", f"l.{FIRST}")


def numbered(
    df: DataFrame, order: list[str | Column] | None = None, by: list[str] | None = None, out: str = "row_id", store: Callable[[DataFrame], DataFrame] = settle
) -> DataFrame:
    """Adds the place of each row, counted from 0 without gaps, in its group or the whole frame.

    Without an order the rows are numbered as they lie and nothing is shuffled. Rows that are equal in
    the order get places in any order. `store` writes the rows once; an empty frame gives no rows.
    """
    by = by or []
    rows = _in_ranges(df, order or [], by, store)
    placed = _beside(rows, _before(rows, by, F.count("*")), by)
    return placed.select(*[f"`{c}`" for c in df.columns], (F.coalesce(BEFORE, F.lit(0)) + F.col(LOCAL) - F.col(FIRST)).alias(out))


def running_sum(
    df: DataFrame, value: str, order: list[str | Column], by: list[str] | None = None, out: str = "running", store: Callable[[DataFrame], DataFrame] = settle
) -> DataFrame:
    """Adds the sum of a column over the rows up to each one, in its group or the whole frame.

    Nulls count as nothing; the sum is null until there is a value. Rows that are equal in the order are
    summed one after the other in any order.
    """
    by = by or []
    rows = _in_ranges(df, order, by, store)
    inside = Window.partitionBy(PART, *by).orderBy(LOCAL).rowsBetween(Window.unboundedPreceding, 0)
    lines = _before(rows, by, F.sum(value))
    summed = _beside(rows.withColumn("numbering_inside", F.sum(value).over(inside)), lines, by)
    inner, before = F.col("numbering_inside"), F.col(BEFORE)
    total = F.when(before.isNull(), inner).when(inner.isNull(), before).otherwise(inner + before)
    return summed.select(*[f"`{c}`" for c in df.columns], total.alias(out))


def row_chunks(df: DataFrame, size: int, order: list[str | Column] | None = None) -> DataFrame:
    """Adds consecutive row_id and chunk, row_id divided by size."""
    return numbered(df, order).withColumn("chunk", F.floor(F.col("row_id") / size).cast("bigint"))


def zip_rows(left: DataFrame, right: DataFrame, left_order: list[str | Column] | None = None, right_order: list[str | Column] | None = None) -> DataFrame:
    """Columns of two frames side by side by place; an error when one is longer than the other."""
    a, b = numbered(left, left_order, out="zip_place"), numbered(right, right_order, out="zip_at")
    n, m = a.count(), b.count()
    if n != m:
        raise ValueError(f"cannot zip {n} rows with {m}")
    return a.join(b, F.col("zip_place") == F.col("zip_at")).drop("zip_place", "zip_at")
