"""Scores of predictions: confusion counts, reports, most confused pairs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.session import settle, sized


# A confusion table has the square of so many cells at most.
MOST_CLASSES = 10_000


def _labels(counted: DataFrame, classes: int) -> list[int]:
    """0 .. classes - 1 and every other label that occurs."""
    both = counted.select(F.explode(F.array("actual", "predicted")).alias("label")).where("label IS NOT NULL")
    others = [r[0] for r in both.where(~F.col("label").between(0, classes - 1)).distinct().limit(MOST_CLASSES + 1).collect()]
    if classes + len(others) > MOST_CLASSES:
        raise ValueError(f"more than {MOST_CLASSES} classes")
    return sorted([*range(classes), *others])


def confusion(df: DataFrame, classes: int, by: list[str] | None = None) -> DataFrame:
    """Dense class x class counts in long form; df has actual and predicted.

    The classes are 0 .. classes - 1 and all others that occur; more than MOST_CLASSES are an error. Pairs with a null
    label keep their own line.
    """
    by = by or []
    counted = settle(df.groupBy(*by, "actual", "predicted").agg(F.count("*").alias("n")))  # read twice below
    labels = F.array(*[F.lit(i).cast("int") for i in _labels(counted, classes)])
    groups = counted.select(*by).distinct() if by else df.sparkSession.range(1)
    grid = groups.select(*by, F.explode(labels).alias("actual")).select("*", F.explode(labels).alias("predicted"))
    cells = grid.join(counted, [*by, "actual", "predicted"], "left").fillna(0, subset=["n"])
    return cells.select(*by, "actual", "predicted", "n").union(
        counted.where("actual IS NULL OR predicted IS NULL").select(*by, "actual", "predicted", "n")
    )


def confusion_counts(df: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Only the pairs that occur."""
    return df.groupBy(*(by or []), "actual", "predicted").agg(F.count("*").alias("n"))


def confusion_wide(counts: DataFrame, classes: int) -> DataFrame:
    """One column per predicted class: 0 .. classes - 1 and all others that occur; more than MOST_CLASSES are an error."""
    return counts.groupBy("actual").pivot("predicted", _labels(counts, classes)).agg(F.sum("n")).fillna(0)


def confusion_percent(counts: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Share of each cell in its row, in percent; null for a class without rows."""
    in_row = F.sum("n").over(Window.partitionBy(*(by or []), "actual"))
    return counts.withColumn("percent", 100 * F.col("n") / F.nullif(in_row, F.lit(0)))


def accuracy(df: DataFrame, by: list[str] | None = None) -> DataFrame:
    hit = (F.col("actual") == F.col("predicted")).cast("double")
    return df.groupBy(*(by or [])).agg(F.avg(hit).alias("accuracy"))


def _ratio(top: Column, bottom: Column) -> Column:
    return F.coalesce(top / F.nullif(bottom.cast("double"), F.lit(0.0)), F.lit(0.0))


def per_class(counts: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Precision, recall, F1 and support of each class; 0 where there is nothing to divide by."""
    by = by or []
    hit = F.when(F.col("actual") == F.col("predicted"), F.col("n")).otherwise(0)
    zero = F.lit(0).cast("bigint")
    sides = F.array(
        F.struct(F.col("actual").alias("class_id"), F.col("n").alias("support"), zero.alias("claimed"), hit.alias("hits")),
        F.struct(F.col("predicted").alias("class_id"), zero.alias("support"), F.col("n").alias("claimed"), zero.alias("hits")),
    )
    sums = (
        counts.select(*by, F.explode(sides).alias("s"))
        .groupBy(*by, "s.class_id")
        .agg(*[F.sum(f"s.{c}").alias(c) for c in ("support", "claimed", "hits")])
    )
    precision, recall = _ratio(F.col("hits"), F.col("claimed")), _ratio(F.col("hits"), F.col("support"))
    f1 = _ratio(F.col("hits") * 2, F.col("claimed") + F.col("support"))
    return sums.select(
        *by, "class_id", precision.alias("precision"), recall.alias("recall"), f1.alias("f1"), "support", "claimed", "hits"
    )


def weighted_scores(counts: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Precision, recall and F1 averaged with the class supports as weights."""
    weigh = lambda c: _ratio(F.sum(F.col(c) * F.col("support")), F.sum("support")).alias(c)
    return (
        per_class(counts, by).groupBy(*(by or [])).agg(weigh("precision"), weigh("recall"), weigh("f1"))
    )


def class_report(counts: DataFrame) -> DataFrame:
    """One line per class, then accuracy, macro and weighted averages (label, precision, recall, f1, support).

    Classes that are neither true nor predicted anywhere have no line and no part in the averages; what
    divides by nothing is 0. A null class is a class with the label null.
    """
    names = ("precision", "recall", "f1")
    macro = [F.avg(c).alias(f"macro_{c}") for c in names]
    weighted = [_ratio(F.sum(F.col(c) * F.col("support")), F.sum("support")).alias(f"weighted_{c}") for c in names]
    rolled = per_class(counts).where("support + claimed > 0").rollup("class_id").agg(
        *macro,
        *weighted,
        F.sum("support").alias("support"),
        _ratio(F.sum("hits"), F.sum("support")).alias("accuracy"),
        F.grouping("class_id").alias("total"),
    )

    def line(label: Column, kind: str) -> Column:
        values = [F.col("accuracy") if kind == "accuracy" else F.col(f"{kind}_{c}") for c in names]
        return F.struct(
            label.alias("label"), *[v.alias(c) for v, c in zip(values, names)], F.col("support").alias("support")
        )

    summary = F.array(
        line(F.lit("accuracy"), "accuracy"),
        line(F.lit("macro avg"), "macro"),
        line(F.lit("weighted avg"), "weighted"),
    )
    single = F.array(line(F.coalesce(F.col("class_id").cast("string"), F.lit("null")), "macro"))
    lines = F.when(F.col("total") == 1, summary).otherwise(single)
    return rolled.select(F.explode(lines).alias("line")).select("line.*")


def top_confused(counts: DataFrame, k: int = 10) -> DataFrame:
    """The k off-diagonal pairs with the highest share of their true class."""
    return (
        confusion_percent(counts)
        .where(F.col("actual") != F.col("predicted"))
        .orderBy(F.desc("percent"), "actual", "predicted")
        .limit(k)
        .select("actual", "predicted", "percent")
    )


def misclassified(df: DataFrame, class_id: int) -> DataFrame:
    return df.where((F.col("actual") != F.col("predicted")) & (F.col("actual") == class_id))


def confused_examples(top: DataFrame, meta: DataFrame, first_images: DataFrame) -> DataFrame:
    """For each confused pair, the template of the predicted class and an image of the true class."""
    shown = meta.select(F.col("class_id").alias("predicted"), F.col("template_id"))
    seen = first_images.select(F.col("class_id").alias("actual"), F.col("image_id"))
    return top.join(sized(shown), "predicted").join(sized(seen), "actual")
