"""Run tables: ranking, run grids, model comparison and feature ablation."""

from __future__ import annotations

import time
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from itertools import combinations

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from tessera.operators import evaluate, models
from tessera.operators.columns import assemble, union_all
from tessera.schema import FEATURE_ORDER, RESULTS


def most_accurate(results: DataFrame, k: int = 5, ties: list[str] | None = None) -> DataFrame:
    return results.orderBy(F.desc("accuracy"), F.desc("total_time"), *(ties or [])).limit(k)


def most_efficient(
    results: DataFrame, min_accuracy: float, k: int = 5, ties: list[str] | None = None
) -> DataFrame:
    """Fewest features first, then least time, among the runs that are accurate enough."""
    good = results.where(F.col("accuracy") > min_accuracy)
    return good.orderBy("num_features", "total_time", *(ties or [])).limit(k)


def label_extremes(
    runs: DataFrame, score: str = "test_accuracy", cost: str = "train_time", identity: str | None = None
) -> DataFrame:
    """The cheapest and the best run of each model, labelled; identity settles ties."""
    ties = [F.col(identity)] if identity else []
    row = F.struct(*runs.columns)
    picked = runs.groupBy("model").agg(
        F.min_by(row, F.struct(F.col(cost), -F.col(score), *ties)).alias("cheapest"),
        F.min_by(row, F.struct(-F.col(score), F.col(cost), *ties)).alias("best"),
    )
    both = F.array(
        F.struct(F.col("cheapest").alias("run"), F.lit("most efficient").alias("label")),
        F.struct(F.col("best").alias("run"), F.lit("most accurate").alias("label")),
    )
    return picked.select(F.explode(both).alias("r")).select("r.run.*", "r.label")


def best_and_last(history: DataFrame, by: list[str]) -> DataFrame:
    """Highest accuracy of a training run and the one of its last epoch."""
    return history.groupBy(*by).agg(
        F.max("accuracy").alias("best_accuracy"), F.max_by("accuracy", "epoch").alias("last_accuracy")
    )


def run_grid(spark: SparkSession, parameters: dict[str, list]) -> DataFrame:
    """One row per combination of the parameter values."""
    grid = spark.range(1).select()
    for name, values in parameters.items():
        nested = isinstance(values[0], list)
        options = F.array(*[F.array(*map(F.lit, v)) if nested else F.lit(v) for v in values])
        grid = grid.select("*", F.explode(options).alias(name))
    return grid


def record_runs(grid: DataFrame, results: DataFrame, names: list[str]) -> DataFrame:
    """The grid with the results of the runs made so far."""
    return grid.join(results, names, "left")


def run_missing(
    plan: DataFrame, ledger: str, names: list[str], execute: Callable[[Row], dict], results: str, most: int = 100_000
) -> DataFrame:
    """The plan with the results of its runs, after those that the ledger lacks have been made.

    The ledger is an append-only table of finished runs: the parameters `names`, the columns of `results` (a
    schema) and seconds. Each line is written when its run ends, so a call that is cut short loses one run at
    most and the next call goes on from there. Runs are made one after the other, so seconds is the time of a
    run that has the cluster to itself. execute takes a line of the plan and returns its results by
    name. A plan with more than `most` open runs is an error.
    """
    spark = plan.sparkSession
    kinds = [f"`{n}` {plan.schema[n].dataType.simpleString()}" for n in names]
    schema = ", ".join([*kinds, results, "seconds double"])
    spark.createDataFrame([], schema).write.mode("append").parquet(ledger)
    known = spark.read.schema(schema).parquet(ledger)
    same = [F.col(f"p.`{n}`").eqNullSafe(F.col(f"k.`{n}`")) for n in names]
    open_ = plan.select(*names).distinct().alias("p").join(known.alias("k"), same, "left_anti").orderBy(*names).limit(most + 1).collect()
    if len(open_) > most:
        raise ValueError(f"more than {most} runs to make")
    for line in open_:
        began = time.perf_counter()
        found = execute(line)
        row = {**line.asDict(), **found, "seconds": time.perf_counter() - began}
        frame = spark.createDataFrame([], schema)
        frame = spark.createDataFrame([tuple(row[c] for c in frame.columns)], frame.schema)
        frame.coalesce(1).write.mode("append").parquet(ledger)
    known = spark.read.schema(schema).parquet(ledger).dropDuplicates(names)
    joined = plan.alias("p").join(known.alias("k"), same, "left")
    return joined.select("p.*", *[f"k.`{c}`" for c in known.columns if c not in names])


def compare_models(df: DataFrame, by: str = "feature") -> DataFrame:
    """Weighted precision, recall and F1 of several models from their predictions."""
    return evaluate.weighted_scores(evaluate.confusion_counts(df, [by]), [by])


def feature_subsets(names: list[str]) -> list[list[str]]:
    """All non-empty subsets, in family order, small ones first."""
    ordered = [n for n in FEATURE_ORDER if n in names]
    return [list(c) for size in range(1, len(ordered) + 1) for c in combinations(ordered, size)]


def ablation(
    train: DataFrame,
    test: DataFrame,
    names: list[str],
    fit: Callable[[DataFrame], Callable[[DataFrame], DataFrame]],
    threads: int = 1,
) -> DataFrame:
    """Fit, predict, time and score every subset of the feature families.

    fit takes a frame with `vector` and `class_id` and returns a function that adds
    `prediction`. Both input frames should be stored or cached: every subset reads them.
    Subsets are fitted one after the other, so that each has the cluster to itself while it is
    timed; with more threads the times hold what the others take. Only the result line
    of each subset (one accuracy, one width) comes back to the driver.
    """
    spark = train.sparkSession

    def run(chosen: list[str]):
        side = assemble(chosen)
        started = time.perf_counter()
        predict = fit(train.select("class_id", side.alias("vector")))
        trained = time.perf_counter()
        scored = predict(test.select("class_id", side.alias("vector")))
        line = scored.agg(
            F.avg((F.col("prediction").cast("int") == F.col("class_id")).cast("double")).alias("accuracy"),
            F.max(F.size("vector")).alias("width"),
        ).first()
        done = time.perf_counter()
        return chosen, line["width"], trained - started, done - trained, line["accuracy"]

    with ThreadPoolExecutor(threads) as pool:
        lines = list(pool.map(run, feature_subsets(names)))
    return spark.createDataFrame(lines, RESULTS)


def ablation_counts(
    train: DataFrame, test: DataFrame, width: int, parts: dict[str, tuple[int, int]], vector: str = "vector"
) -> DataFrame:
    """Confusion counts (subset, actual, predicted, n) of the nearest class mean for every subset of the parts.

    From these follow accuracy, reports and weighted scores of each subset. One job serves all subsets.
    """
    names = list(parts)
    subsets = [list(c) for size in range(1, len(names) + 1) for c in combinations(range(len(names)), size)]
    predict = models.subset_means(train, width, list(parts.values()), subsets, vector)
    labels = F.array(*[F.lit("+".join(names[i] for i in s)) for s in subsets])
    found = predict(test).select(F.col("class_id").alias("actual"), F.explode(F.arrays_zip(labels.alias("subset"), F.col("predictions").alias("predicted"))).alias("p"))
    return evaluate.confusion_counts(found.select("p.subset", "actual", "p.predicted"), ["subset"])


def collect_runs(frames: list[DataFrame]) -> DataFrame:
    """Result tables of several experiments as one."""
    return union_all(frames)
