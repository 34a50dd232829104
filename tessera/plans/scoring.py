"""Queries on predictions: confusion counts, reports, comparisons, run tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.functions import scalars
from tessera.operators import cuts, evaluate, experiments
from tessera.operators import images as image_ops
from tessera.plans.base import (
    CLASSES,
    CONFUSION_SQL,
    FAMILIES,
    FAMILY_SQL,
    KEY_SQL,
    PER_CLASS_SQL,
    PREDICTIONS_SQL,
    family_predictions,
    images,
    key,
    predictions,
    query,
    table,
    templates,
    tiles,
)

PRF = ("precision", "recall", "f1")


def _six(df, names):
    return df.select(*[F.round(c, 6).alias(c) if c in names else F.col(c) for c in df.columns])


@query("cross_templates", f"WITH {PREDICTIONS_SQL} SELECT image_id, template_class, round(score, 6) AS score FROM scores")
def cross_templates(spark, d):
    scored = image_ops.plane_scores(tiles(spark, d), templates(spark, d))
    return scored.select("image_id", F.explode("scores").alias("s")).select(
        "image_id", F.col("s.class_id").alias("template_class"), F.round("s.score", 6).alias("score")
    )


@query("predicted_class", f"WITH {PREDICTIONS_SQL} SELECT image_id, actual, predicted FROM preds")
def predicted_class(spark, d):
    return predictions(spark, d)


@query(
    "argmax_vector",
    """SELECT vec_id AS image_id, CAST(list_position(embedding, list_max(embedding)) - 1 AS INTEGER) AS best FROM embeddings""",
)
def argmax_vector(spark, d):
    return images(spark, d).select("image_id", scalars.argmax(F.col("embedding")).alias("best"))


@query("misclassified", f"WITH {PREDICTIONS_SQL} SELECT image_id, actual, predicted FROM preds WHERE actual <> predicted AND actual = 6")
def misclassified(spark, d):
    return evaluate.misclassified(predictions(spark, d), 6)


@query("confusion_matrix", f"WITH {PREDICTIONS_SQL}, {CONFUSION_SQL} SELECT actual, predicted, n FROM cm")
def confusion_matrix(spark, d):
    return evaluate.confusion(predictions(spark, d), CLASSES)


@query(
    "confusion_wide",
    f"""WITH {PREDICTIONS_SQL}, {CONFUSION_SQL} SELECT actual, """
    + ", ".join(f'CAST(sum(n) FILTER (predicted = {i}) AS BIGINT) AS "{i}"' for i in range(10))
    + " FROM cm GROUP BY actual",
)
def confusion_wide(spark, d):
    return evaluate.confusion_wide(evaluate.confusion(predictions(spark, d), CLASSES), CLASSES)


@query(
    "confusion_percent",
    f"""WITH {PREDICTIONS_SQL}, {CONFUSION_SQL} SELECT actual, predicted, n,
    CAST(100 * n AS DOUBLE) / CAST(sum(n) OVER (PARTITION BY actual) AS DOUBLE) AS percent FROM cm""",
)
def confusion_percent(spark, d):
    return evaluate.confusion_percent(evaluate.confusion(predictions(spark, d), CLASSES))


@query(
    "accuracy",
    f"""WITH {PREDICTIONS_SQL} SELECT CAST(count(*) FILTER (actual = predicted) AS DOUBLE) / count(*) AS accuracy FROM preds""",
)
def accuracy(spark, d):
    return evaluate.accuracy(predictions(spark, d))


@query(
    "class_report",
    f"""WITH {PREDICTIONS_SQL}, {CONFUSION_SQL}, {PER_CLASS_SQL}, lines AS (
      SELECT CAST(class_id AS VARCHAR) AS label, p, r, f, support FROM per_class
      UNION ALL SELECT 'accuracy', sum(hits) / sum(support), sum(hits) / sum(support), sum(hits) / sum(support), sum(support) FROM per_class
      UNION ALL SELECT 'macro avg', avg(p), avg(r), avg(f), sum(support) FROM per_class
      UNION ALL SELECT 'weighted avg', sum(p * support) / sum(support), sum(r * support) / sum(support),
        sum(f * support) / sum(support), sum(support) FROM per_class)
    SELECT label, round(p, 6) AS precision, round(r, 6) AS recall, round(f, 6) AS f1, CAST(support AS BIGINT) AS support FROM lines""",
)
def class_report(spark, d):
    return _six(evaluate.class_report(evaluate.confusion(predictions(spark, d), CLASSES)), PRF)


@query(
    "class_report_gaps",
    f"""WITH {PREDICTIONS_SQL.replace("preds AS (", "every AS (")}, preds AS (
      SELECT image_id, actual, CAST(CASE WHEN predicted IN (3, 7) THEN 11 ELSE predicted END AS INTEGER) AS predicted FROM every WHERE actual <> 3),
    {CONFUSION_SQL}, {PER_CLASS_SQL}, lines AS (
      SELECT CAST(class_id AS VARCHAR) AS label, p, r, f, support FROM per_class
      UNION ALL SELECT 'accuracy', sum(hits) / sum(support), sum(hits) / sum(support), sum(hits) / sum(support), sum(support) FROM per_class
      UNION ALL SELECT 'macro avg', avg(p), avg(r), avg(f), sum(support) FROM per_class
      UNION ALL SELECT 'weighted avg', sum(p * support) / sum(support), sum(r * support) / sum(support),
        sum(f * support) / sum(support), sum(support) FROM per_class)
    SELECT label, round(p, 6) AS precision, round(r, 6) AS recall, round(f, 6) AS f1, CAST(support AS BIGINT) AS support FROM lines""",
)
def class_report_gaps(spark, d):
    """A class that is on neither side, one that is never predicted, and one that is never true."""
    found = predictions(spark, d).where("actual <> 3")
    moved = F.when(F.col("predicted").isin(3, 7), 11).otherwise(F.col("predicted")).cast("int")
    return _six(evaluate.class_report(evaluate.confusion(found.withColumn("predicted", moved), CLASSES)), PRF)


@query(
    "weighted_prf",
    f"""WITH {PREDICTIONS_SQL}, {CONFUSION_SQL}, {PER_CLASS_SQL}
    SELECT round(sum(p * support) / sum(support), 6) AS precision, round(sum(r * support) / sum(support), 6) AS recall,
           round(sum(f * support) / sum(support), 6) AS f1 FROM per_class""",
)
def weighted_prf(spark, d):
    return _six(evaluate.weighted_scores(evaluate.confusion_counts(predictions(spark, d))), PRF)


TOP_SQL = f"""{PREDICTIONS_SQL}, {CONFUSION_SQL},
pct AS (SELECT actual, predicted, CAST(100 * n AS DOUBLE) / CAST(sum(n) OVER (PARTITION BY actual) AS DOUBLE) AS percent FROM cm),
top AS (SELECT * FROM pct WHERE actual <> predicted ORDER BY percent DESC, actual, predicted LIMIT 10)"""


@query("top_confused", f"WITH {TOP_SQL} SELECT actual, predicted, percent FROM top")
def top_confused(spark, d):
    return evaluate.top_confused(evaluate.confusion(predictions(spark, d), CLASSES))


@query(
    "confused_examples",
    f"""WITH {TOP_SQL}, one AS (SELECT label, min(vec_id) AS id FROM embeddings GROUP BY label),
    lots AS (SELECT label, max(vec_id) AS id FROM embeddings GROUP BY label)
    SELECT actual, predicted, percent, one.id AS template_id, lots.id AS image_id
    FROM top JOIN one ON one.label = predicted JOIN lots ON lots.label = actual""",
)
def confused_examples(spark, d):
    top = evaluate.top_confused(evaluate.confusion(predictions(spark, d), CLASSES))
    meta = templates(spark, d).select("class_id", F.col("image_id").alias("template_id"))
    shown = images(spark, d).groupBy("class_id").agg(F.max("image_id").alias("image_id"))
    return evaluate.confused_examples(top, meta, shown)


@query(
    "model_comparison",
    f"""WITH {FAMILY_SQL}, cm AS (SELECT family, actual, predicted, count(*) AS n FROM fpreds GROUP BY ALL),
    c AS (SELECT DISTINCT family, actual AS class_id FROM cm UNION SELECT family, predicted FROM cm),
    s AS (SELECT family, class_id,
      coalesce((SELECT CAST(sum(n) AS DOUBLE) FROM cm WHERE cm.family = c.family AND actual = class_id), 0) AS support,
      coalesce((SELECT CAST(sum(n) AS DOUBLE) FROM cm WHERE cm.family = c.family AND predicted = class_id), 0) AS claimed,
      coalesce((SELECT CAST(sum(n) AS DOUBLE) FROM cm WHERE cm.family = c.family AND predicted = class_id AND actual = class_id), 0) AS hits
      FROM c)
    SELECT family, round(sum(CASE WHEN claimed > 0 THEN hits / claimed ELSE 0 END * support) / sum(support), 6) AS precision,
      round(sum(CASE WHEN support > 0 THEN hits / support ELSE 0 END * support) / sum(support), 6) AS recall,
      round(sum(CASE WHEN claimed + support > 0 THEN 2 * hits / (claimed + support) ELSE 0 END * support) / sum(support), 6) AS f1
    FROM s GROUP BY family""",
)
def model_comparison(spark, d):
    return _six(experiments.compare_models(family_predictions(spark, d), "family"), PRF)


@query(
    "run_grid",
    f"""WITH {FAMILY_SQL}, p AS (
      SELECT family, CAST(CAST('0x' || substr({KEY_SQL}, 1, 8) AS BIGINT) % 5 AS INTEGER) AS fold, actual, predicted FROM fpreds),
    r AS (SELECT family, fold, CAST(count(*) FILTER (actual = predicted) AS DOUBLE) / count(*) AS accuracy FROM p GROUP BY ALL),
    g AS (SELECT f.family, CAST(k.fold AS INTEGER) AS fold FROM (SELECT unnest(['lbp', 'hue', 'template', 'hog']) AS family) f, range(5) k(fold))
    SELECT family, fold, accuracy FROM g LEFT JOIN r USING (family, fold)""",
)
def run_grid(spark, d):
    """Plan of all runs (family x fold) with the accuracy measured in each."""
    grid = experiments.run_grid(spark, {"family": FAMILIES, "fold": [0, 1, 2, 3, 4]})
    folded = family_predictions(spark, d).withColumn("fold", cuts.fold_of(key(), 5))
    return experiments.record_runs(grid, evaluate.accuracy(folded, ["family", "fold"]), ["family", "fold"])


@query(
    "label_runs",
    """WITH runs AS (SELECT user_id AS model, event_id AS run, value AS score, extract('minute' FROM ts) AS cost FROM events),
    e AS (SELECT model, run, 'most efficient' AS label FROM runs QUALIFY row_number() OVER (PARTITION BY model ORDER BY cost, -score, run) = 1),
    a AS (SELECT model, run, 'most accurate' AS label FROM runs QUALIFY row_number() OVER (PARTITION BY model ORDER BY -score, cost, run) = 1)
    SELECT model, run, label FROM e UNION ALL SELECT model, run, label FROM a""",
)
def label_runs(spark, d):
    runs = table(spark, d, "events").select(
        F.col("user_id").alias("model"),
        F.col("event_id").alias("run"),
        F.col("value").alias("score"),
        F.minute("ts").alias("cost"),
    )
    return experiments.label_extremes(runs, "score", "cost", "run").select("model", "run", "label")
