"""Queries that fit models. Those with a rule that SQL can repeat have a twin."""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from tessera.operators import cuts, experiments, gram, machines, models, nets, spectra
from tessera.operators import images as image_ops
from tessera.plans.base import CLASSES, KEY_SQL, PIXELS_SQL, PREDICTIONS_SQL, TILES_SQL, images, key, query, templates, tiles


#: Eight families of eight pixel levels each.
PARTS = {f"f{i}": (8 * i, 8 * i + 8) for i in range(8)}
#: Three families of one level each, whose least squares SQL can solve.
SINGLES = {"a": (9, 10), "b": (30, 31), "c": (52, 53)}


def _split(spark, d):
    rows = images(spark, d).select(
        "image_id", "class_id", F.col("embedding").cast("array<double>").alias("vector"), cuts.split_hashed(key(), 0.8).alias("split")
    )
    stored = rows.persist()
    return [stored.where(F.col("split") == part).drop("split") for part in ("train", "test")]


def _predicted(spark, d, fit):
    train, test = _split(spark, d)
    return fit(train)(test).select("image_id", "class_id", F.col("prediction").cast("int").alias("prediction"))


@query("logistic")
def logistic(spark, d):
    return _predicted(spark, d, models.logistic(max_iter=100))


@query("model_loss")
def model_loss(spark, d):
    train, test = _split(spark, d)
    return models.model_loss(models.logistic(max_iter=100)(train)(test))


@query("linear_svc_ovr")
def linear_svc_ovr(spark, d):
    return _predicted(spark, d, models.svc_one_vs_rest(max_iter=100))


@query("linear_svc_ovo")
def linear_svc_ovo(spark, d):
    return _predicted(spark, d, models.svc_one_vs_one(max_iter=100))


@query("perceptron")
def perceptron(spark, d):
    return _predicted(spark, d, models.perceptron([32], CLASSES, max_iter=100))


@query("softmax_sgd")
def softmax_sgd(spark, d):
    return _predicted(spark, d, nets.softmax(20))


@query("dense_net")
def dense_net(spark, d):
    return _predicted(spark, d, nets.dense_net([32], 20, first=CLASSES))


@query("grid_cv")
def grid_cv(spark, d):
    train, _ = _split(spark, d)
    return machines.grid_scores(train.withColumn("fold", cuts.fold_of(key(), 5)), [0.005, 0.01, 0.05, 0.1], "fold", 5)


@query("explained_variance")
def explained_variance(spark, d):
    return spectra.explained_variance(images(spark, d), "embedding")


@query("components")
def components(spark, d):
    return spectra.components(images(spark, d), "embedding").select(
        "image_id", F.size("components").alias("kept"), F.posexplode("components").alias("pos", "v")
    )


@query(
    "variance_trace",
    """WITH x AS (SELECT vec_id, CAST(unnest(embedding) AS DOUBLE) AS v, generate_subscripts(embedding, 1) AS pos FROM embeddings)
       SELECT CAST(count(*) AS INTEGER) AS components, round(sum(s), 6) AS trace, round(sum(s), 6) AS along_components FROM (SELECT pos, var_samp(v) AS s FROM x GROUP BY pos)""",
)
def variance_trace(spark, d):
    """The summed variance of all positions, and of all components."""
    found = spectra.spectrum(images(spark, d), "embedding", spectra.MOST)
    line = (len(found.variances), round(found.trace, 6), round(float(found.variances.sum()), 6))
    return spark.createDataFrame([line], "components int, trace double, along_components double")


def _halves(spark, d):
    rows = tiles(spark, d).withColumn("split", cuts.split_hashed(key(), 0.8)).withColumnRenamed("plane", "vector").persist()
    return [rows.where(F.col("split") == part) for part in ("train", "test")]


@query("ablation")
def ablation(spark, d):
    """All 255 subsets of eight feature families by least squares from one matrix of inner products."""
    return gram.ablation(*_halves(spark, d), PARTS)[0]


@query("ablation_svc")
def ablation_svc(spark, d):
    """Accuracy of linear machines, one for each pair of classes, on all 255 subsets, fitted together."""
    train, test = _halves(spark, d)
    return machines.subset_scores(train, test, PARTS)


SPLIT_SQL = f"""{PIXELS_SQL}, split AS (
  SELECT image_id, class_id, pos, v, {KEY_SQL} AS k FROM px)"""


@query(
    "ablation_counts",
    f"""WITH {SPLIT_SQL}, train AS (SELECT * FROM split WHERE substr(k, 1, 8) < '{int(0.8 * 2**32):08x}'), test AS (SELECT * FROM split WHERE substr(k, 1, 8) >= '{int(0.8 * 2**32):08x}'),
    m AS (SELECT class_id AS c, pos, count(*) AS n, sum(v) AS s FROM train GROUP BY 1, 2),
    fam AS (SELECT image_id, class_id AS actual, c, test.pos // 8 AS f, max(n) AS n, sum((n * v - s) * (n * v - s)) AS far FROM test JOIN m USING (pos) GROUP BY ALL),
    sub AS (SELECT b, string_agg('f' || f, '+' ORDER BY f) AS subset, list(f) AS fs FROM (SELECT b, f FROM range(1, 256) r(b), range(8) q(f) WHERE (b >> f) & 1 = 1) GROUP BY b),
    d AS (SELECT subset, image_id, actual, c, CAST(sum(far) AS DOUBLE) / CAST(max(n) * max(n) AS DOUBLE) AS far FROM fam JOIN (SELECT subset, unnest(fs) AS f FROM sub) USING (f) GROUP BY 1, 2, 3, 4),
    p AS (SELECT subset, actual, c AS predicted FROM d QUALIFY row_number() OVER (PARTITION BY subset, image_id ORDER BY far, c) = 1)
    SELECT subset, actual, predicted, CAST(count(*) AS BIGINT) AS n FROM p GROUP BY ALL""",
)
def ablation_counts(spark, d):
    """Confusion counts of all 255 subsets of eight families."""
    rows = tiles(spark, d).withColumn("split", cuts.split_hashed(key(), 0.8)).withColumnRenamed("plane", "vector")
    train, test = (rows.where(F.col("split") == part) for part in ("train", "test"))
    return experiments.ablation_counts(train, test, 64, PARTS)


@query(
    "softmax_step",
    f"""WITH {SPLIT_SQL}, train AS (SELECT * FROM split WHERE substr(k, 1, 8) < '{int(0.8 * 2**32):08x}'), test AS (SELECT * FROM split WHERE substr(k, 1, 8) >= '{int(0.8 * 2**32):08x}'),
    m AS (SELECT class_id AS c, pos, count(*) AS n, sum(v) AS s FROM train GROUP BY 1, 2),
    f AS (SELECT image_id, class_id AS actual, c, sum(s * v) + max(n) AS score FROM test JOIN m USING (pos) GROUP BY 1, 2, 3)
    SELECT image_id, actual, c AS prediction FROM f QUALIFY row_number() OVER (PARTITION BY image_id ORDER BY score DESC, c) = 1""",
)
def softmax_step(spark, d):
    """Classes after the first step of the softmax regression over all rows, averaged over the tasks.

    From equal weights the first step leads along the classes' sums, which SQL can add up.
    """
    train, test = _halves(spark, d)
    net = nets.fit_net(train, [], 1, 0.1, None, ones=1)
    found = nets.predictor(net, spark)(test)
    return found.select("image_id", F.col("class_id").alias("actual"), F.col("prediction").cast("int").alias("prediction"))


def _squares_sql() -> str:
    """Least squares of the class marks on up to three scaled columns by Cramer's rule; a column left out is a row of the unit matrix."""
    place = {name: cut[0] for name, cut in SINGLES.items()}
    wide = ", ".join(f"CAST(plane[{p + 1}] AS DOUBLE) AS {n}" for n, p in place.items())
    pairs = [("a", "a"), ("b", "b"), ("c", "c"), ("a", "b"), ("a", "c"), ("b", "c")]
    entry = {(x, y): f"CASE WHEN i{x} AND i{y} THEN {'1 + ' + str(gram.RIDGE) if x == y else f'r{x}{y}'} ELSE {1.0 if x == y else 0.0} END AS {x}{y}" for x, y in pairs}
    det = lambda u, v, w: f"({u[0]} * ({v[1]} * {w[2]} - {w[1]} * {v[2]}) - {v[0]} * ({u[1]} * {w[2]} - {w[1]} * {u[2]}) + {w[0]} * ({u[1]} * {v[2]} - {v[1]} * {u[2]}))"
    cols, marks = [("aa", "ab", "ac"), ("ab", "bb", "bc"), ("ac", "bc", "cc")], ("ma", "mb", "mc")
    solved = ", ".join(f"{det(*[marks if k == j else cols[k] for k in range(3)])} / {det(*cols)} AS w{n}" for j, n in enumerate("abc"))
    return f"""WITH {TILES_SQL}, rows AS (SELECT image_id, class_id, {wide}, substr({KEY_SQL}, 1, 8) < '{int(0.8 * 2**32):08x}' AS train FROM tiles),
    n AS (SELECT count(*) AS n, {", ".join(f"sum({x}) / count(*) AS u{x}" for x in "abc")}, {", ".join(f"sum({x} * {y}) / count(*) AS p{x}{y}" for x, y in pairs)} FROM rows WHERE train),
    z AS (SELECT *, {", ".join(f"sqrt(p{x}{x} - u{x} * u{x}) AS s{x}" for x in "abc")} FROM n),
    r AS (SELECT *, {", ".join(f"(p{x}{y} - u{x} * u{y}) / (s{x} * s{y}) AS r{x}{y}" for x, y in pairs if x != y)} FROM z),
    m AS (SELECT class_id AS k, count(*) AS nk, {", ".join(f"sum({x}) AS t{x}" for x in "abc")} FROM rows WHERE train GROUP BY 1),
    sub(subset, ia, ib, ic) AS (VALUES ('a', true, false, false), ('b', false, true, false), ('c', false, false, true), ('a+b', true, true, false), ('a+c', true, false, true), ('b+c', false, true, true), ('a+b+c', true, true, true)),
    e AS (SELECT subset, k, nk, n, ua, ub, uc, sa, sb, sc, {", ".join(entry.values())},
            {", ".join(f"CASE WHEN i{x} THEN (t{x} - nk * u{x}) / n / s{x} ELSE 0.0 END AS m{x}" for x in "abc")} FROM sub, r, m),
    w AS (SELECT subset, k, CAST(nk AS DOUBLE) / n AS base, ua, ub, uc, sa, sb, sc, {solved} FROM e),
    f AS (SELECT subset, image_id, class_id AS actual, k, base + wa * (a - ua) / sa + wb * (b - ub) / sb + wc * (c - uc) / sc AS score FROM rows, w WHERE NOT train),
    p AS (SELECT subset, actual, k AS predicted FROM f QUALIFY row_number() OVER (PARTITION BY subset, image_id ORDER BY round(score, 9) DESC, k) = 1)
    SELECT subset, actual, predicted, CAST(count(*) AS BIGINT) AS n FROM p GROUP BY ALL"""


@query("ablation_squares", _squares_sql())
def ablation_squares(spark, d):
    """Confusion counts of the least squares on all subsets of three single levels."""
    return gram.ablation(*_halves(spark, d), SINGLES)[1]


@query(
    "grid_cv_means",
    f"""WITH {PIXELS_SQL}, rows AS (SELECT *, CAST(CAST('0x' || substr({KEY_SQL}, 1, 8) AS BIGINT) % 5 AS INTEGER) AS fold FROM px),
    cand(candidate, upto) AS (VALUES ('16', 16), ('32', 32), ('64', 64)), folds AS (SELECT CAST(i AS INTEGER) AS fold FROM range(5) r(i)),
    m AS (SELECT folds.fold, class_id AS c, pos, count(*) AS n, sum(v) AS s FROM folds JOIN rows ON rows.fold <> folds.fold GROUP BY 1, 2, 3),
    d AS (SELECT candidate, rows.fold, image_id, class_id AS actual, c, CAST(sum((n * v - s) * (n * v - s)) AS DOUBLE) / CAST(max(n) * max(n) AS DOUBLE) AS far
      FROM cand JOIN rows ON pos < upto JOIN m ON m.fold = rows.fold AND m.pos = rows.pos GROUP BY ALL),
    p AS (SELECT candidate, fold, actual, c AS predicted FROM d QUALIFY row_number() OVER (PARTITION BY candidate, fold, image_id ORDER BY far, c) = 1),
    a AS (SELECT candidate, fold, CAST(count(*) FILTER (actual = predicted) AS DOUBLE) / count(*) AS accuracy FROM p GROUP BY 1, 2)
    SELECT candidate, fold, accuracy, round(avg(accuracy) OVER (PARTITION BY candidate), 9) AS mean_accuracy FROM a""",
)
def grid_cv_means(spark, d):
    """Five folds for the nearest class mean over the first 16, 32 and all 64 values."""
    folded = tiles(spark, d).withColumn("fold", cuts.fold_of(key(), 5)).withColumnRenamed("plane", "vector")
    candidates = {str(n): models.nearest_mean(64, [(0, n)]) for n in (16, 32, 64)}
    return models.grid_search(folded, candidates, "fold", 5).withColumn("mean_accuracy", F.round("mean_accuracy", 9))


@query(
    "template_loss",
    f"""WITH {PREDICTIONS_SQL}, e AS (SELECT image_id, actual, template_class, exp(score) / sum(exp(score)) OVER (PARTITION BY image_id) AS p FROM scores),
    l AS (SELECT avg(-ln(greatest(p, 1e-7))) AS loss FROM e WHERE actual = template_class),
    a AS (SELECT CAST(count(*) FILTER (actual = predicted) AS DOUBLE) / count(*) AS accuracy FROM preds)
    SELECT round(loss, 9) AS loss, round(accuracy, 9) AS accuracy, round(sqrt(loss), 9) AS root_loss, round(sqrt(accuracy), 9) AS root_accuracy FROM l, a""",
)
def template_loss(spark, d):
    """Loss of the softmax of the template scores."""
    scored = image_ops.plane_scores(tiles(spark, d), templates(spark, d))
    odds = F.transform("scores", lambda s: F.exp(s["score"]))
    total = F.aggregate("odds", F.lit(0.0), lambda t, x: t + x)
    best = F.array_position(F.transform("scores", lambda s: s["score"]), F.array_max(F.transform("scores", lambda s: s["score"])))
    classes = F.transform("scores", lambda s: s["class_id"])
    given = scored.withColumn("odds", odds).withColumn("probability", F.transform("odds", lambda x: x / total))
    given = given.withColumn("prediction", F.get(classes, (best - 1).cast("int")))
    ready = given.withColumn("probability", array_to_vector("probability"))
    return models.model_loss(ready).select(*[F.round(c, 9).alias(c) for c in ("loss", "accuracy", "root_loss", "root_accuracy")])
