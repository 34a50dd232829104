"""Models on small separable data, machines and least squares against plain sums, components and medians against NumPy."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.operators import blocks, cuts, experiments, gram, machines, middles, models, spectra
from tessera.sources import writers


@pytest.fixture(scope="module")
def blobs(spark):
    rng = np.random.default_rng(4)
    centres = np.array([[0, 0, 0, 0], [6, 0, 1, 0], [0, 6, 0, 1]])
    rows = [(i, i % 3, (centres[i % 3] + rng.normal(size=4)).tolist()) for i in range(240)]
    df = spark.createDataFrame(rows, "image_id long, class_id int, vector array<double>").repartition(3).cache()
    return df.where("image_id < 180"), df.where("image_id >= 180")


def hits(predicted):
    return predicted.agg(F.avg((F.col("prediction") == F.col("class_id")).cast("double"))).first()[0]


@pytest.mark.parametrize(
    "fit",
    [
        models.logistic(20),
        models.perceptron([8], 3, 40),
        models.svc_one_vs_rest(penalty=1.0),
        models.svc_one_vs_one(penalty=1.0),
    ],
    ids=["logistic", "perceptron", "one_vs_rest", "one_vs_one"],
)
def test_classifiers_separate_the_blobs(blobs, fit):
    train, test = blobs
    predicted = fit(train)(test)
    assert set(predicted.columns) >= {"image_id", "class_id", "vector", "prediction"}
    assert hits(predicted) > 0.95


def test_loss_and_its_root(blobs):
    train, test = blobs
    line = models.model_loss(models.logistic(20)(train)(test)).first()
    assert line["accuracy"] > 0.95 and line["root_loss"] == pytest.approx(line["loss"] ** 0.5)


def test_scaling_uses_the_training_rows_alone(blobs):
    train, test = blobs
    scaled = models.scaled_pair(train, test)
    a, b = (np.array([r["vector"] for r in df.orderBy("image_id").collect()]) for df in scaled)
    raw_a, raw_b = (np.array([r["vector"] for r in df.orderBy("image_id").collect()]) for df in blobs)
    assert np.allclose(a, (raw_a - raw_a.mean(0)) / raw_a.std(0))
    assert np.allclose(b, (raw_b - raw_a.mean(0)) / raw_a.std(0))


def test_components_match_numpy(blobs):
    train, _ = blobs
    raw = np.array([r["vector"] for r in train.orderBy("image_id").collect()])
    centred = raw - raw.mean(0)
    _, s, vt = np.linalg.svd(centred, full_matrices=False)
    shares = s**2 / (s**2).sum()
    found = spectra.explained_variance(train).orderBy("component").collect()
    assert np.allclose([r["variance"] for r in found], shares) and found[-1]["cumulative"] == pytest.approx(1)
    kept = int((np.cumsum(shares) <= 0.95).sum()) + 1
    projected = np.array([r["components"] for r in spectra.components(train).orderBy("image_id").collect()])
    assert projected.shape == (180, kept)
    assert np.allclose(np.abs(projected), np.abs(centred @ vt[:kept].T), atol=1e-8)


def test_few_components_of_wide_vectors(spark):
    rng = np.random.default_rng(6)
    raw = (rng.normal(size=(300, 12)) * 2.0 ** -np.arange(12)) @ rng.normal(size=(12, 200)) + rng.normal(size=200) + 0.001 * rng.normal(size=(300, 200))
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(raw)], "image_id long, vector array<double>").repartition(4)
    centred = raw - raw.mean(0)
    _, s, vt = np.linalg.svd(centred, full_matrices=False)
    found = spectra.spectrum(df, "vector", 5)
    assert found.rows == 300 and found.trace == pytest.approx((s**2).sum() / 299)
    assert np.allclose(found.variances, s[:5] ** 2 / 299, rtol=1e-3)
    assert np.linalg.norm(found.directions @ vt[:5].T, 2) > 1 - 1e-4 and np.linalg.svd(found.directions @ vt[:5].T)[1].min() > 1 - 1e-4
    kept = spectra.components(df, keep=0.9).first()["components"]
    assert len(kept) == int((np.cumsum(s**2) / (s**2).sum() <= 0.9).sum()) + 1
    with pytest.raises(ValueError):
        spectra.spectrum(df.limit(0), "vector", 2)


def test_sums_are_merged_in_a_tree(spark, monkeypatch):
    monkeypatch.setattr(blocks, "DRIVER_BYTES", 0)
    monkeypatch.setattr(blocks, "FAN", 3)
    df = spark.range(0, 1000, numPartitions=11)

    def add(arrays, batch):
        x = batch.column(0).to_numpy()
        np.add.at(arrays["count"], x % 70_000, 1)
        arrays["total"][0, 1] += x.sum()
        arrays["min"][0], arrays["max"][0] = min(arrays["min"][0], x.min()), max(arrays["max"][0], x.max())

    found = blocks.sums(df, {"count": (70_000,), "total": (1, 2), "min": (1,), "max": (1,)}, add)
    assert found["count"].sum() == 1000 and found["count"][:1000].all() and found["total"].tolist() == [[0, 499_500]]
    assert (found["min"][0], found["max"][0]) == (0, 999)


def test_sums_send_little_more_than_the_result(spark, monkeypatch):
    frame, sent = type(spark.range(1)), []
    collect = frame.collect

    def measured(df):
        rows = collect(df)
        sent.extend(len(r["numbers"]) for r in rows if "numbers" in df.columns)
        return rows

    monkeypatch.setattr(frame, "collect", measured)
    df = spark.range(0, 1000, numPartitions=40)

    def add(arrays, batch):
        arrays["count"][batch.column(0).to_numpy()] += 1

    found = blocks.sums(df, {"count": (40_000,)}, add)
    assert found["count"].sum() == 1000 and found["count"][:1000].all()
    assert sum(sent) <= 2 * 8 * 40_000


def test_machines_send_only_columns_they_use(spark, monkeypatch):
    rng = np.random.default_rng(4)
    df = spark.createDataFrame([(rng.normal(size=8).tolist(), i % 3) for i in range(60)], "vector array<double>, class_id int")
    asked, gathered = [], blocks.gathered
    monkeypatch.setattr(machines, "gathered", lambda df, shapes, task, parts: asked.append(shapes) or gathered(df, shapes, task, parts))
    found = machines.fit_machines(df, lambda classes: machines.one_vs_one(classes, 0.1, columns=np.array([1, 5])) + machines.one_vs_one(classes, 0.1))
    assert asked[0] == {"loss": (6,), "pull": (3 * 2 + 3 * 8,), "shift": (6,)}
    assert (found.weights[:3, [0, 2, 3, 4, 6, 7]] == 0).all() and (found.weights[:3, [1, 5]] != 0).all()


def plain_objective(x, y, weights, shift, penalty):
    """Loss and slope of one machine on scaled columns."""
    short = 1 - y * (x @ weights + shift)
    slope = np.clip(short / machines.BEND, 0, 1)
    loss = np.where(short < machines.BEND, slope * short / 2, short - machines.BEND / 2)
    pull = -y * slope * penalty
    return penalty * loss.sum() + weights @ weights / 2, np.append(weights + pull @ x, pull.sum())


@pytest.mark.parametrize("penalty", [0.005, 0.5])
def test_machines_of_noisy_classes_stand_at_their_minimum(spark, penalty):
    rng = np.random.default_rng(9)
    labels = rng.integers(0, 4, 400)
    raw = rng.normal(size=(400, 6)) * [1, 5, 0.1, 1, 1, 0] + labels[:, None] * [0.7, 0, 0.05, -0.4, 0, 0] + 3
    folds = rng.integers(0, 3, 400)
    df = spark.createDataFrame([(v.tolist(), int(c), int(f)) for v, c, f in zip(raw, labels, folds)], "vector array<double>, class_id int, fold int").repartition(3).cache()

    def problems(classes):
        return machines.one_vs_one(classes, penalty) + machines.one_vs_rest(classes, penalty, fold=1) + machines.one_vs_one(classes, penalty, columns=np.array([0, 3]))

    every = problems([0, 1, 2, 3])
    found = machines.fit_machines(df, problems, fold="fold")
    assert len(found.weights) == 16 and found.passes < 100
    for i in range(16):
        rows = np.ones(400, bool) if every.fold[i] is None else folds != every.fold[i]
        mean, spread = raw[rows].mean(0), raw[rows].std(0)
        spread = np.where(spread > 1e-9, spread, np.inf)
        if every.negative[i] is not None:
            rows = np.isin(labels, [every.positive[i], every.negative[i]])
        x, y = ((raw - mean) / spread)[rows], np.where(labels[rows] == every.positive[i], 1.0, -1.0)
        used = np.arange(6) if every.columns[i] is None else every.columns[i]
        weights = np.where(np.isfinite(spread), found.weights[i] * np.where(np.isfinite(spread), spread, 0), 0)
        assert not found.weights[i][np.setdiff1d(np.arange(6), used)].any()
        value, slope = plain_objective(x, y, weights, found.shifts[i] + found.weights[i] @ mean, penalty)
        assert value == pytest.approx(found.losses[i], rel=1e-6)
        for _ in range(20):  # no point around is lower by more than a trifle
            step = np.append(np.where(np.isin(np.arange(6), used), rng.normal(size=6), 0), rng.normal()) * 0.02
            assert plain_objective(x, y, weights + step[:-1], found.shifts[i] + found.weights[i] @ mean + step[-1], penalty)[0] > value * (1 - 1e-4)


def test_machines_agree_with_mllib(spark, blobs):
    from pyspark.ml.classification import LinearSVC

    train, test = blobs
    scaled_train, scaled_test = models.scaled_pair(train, test)
    two = models.as_ml(scaled_train.where("class_id <> 1")).withColumn("label", (F.col("class_id") == 2).cast("double")).coalesce(1).cache()
    fitted = LinearSVC(regParam=1.0 / two.count(), maxIter=25, standardization=False).fit(two)
    theirs = {r["image_id"]: r["prediction"] == 1.0 for r in fitted.transform(models.as_ml(scaled_test.where("class_id <> 1"))).collect()}
    own = models.svc_one_vs_one(1.0)(train.where("class_id <> 1"))(test.where("class_id <> 1"))
    assert {r["image_id"]: r["prediction"] == 2 for r in own.collect()} == theirs


def test_jobs_do_not_grow_with_the_pairs(spark):
    rng = np.random.default_rng(2)
    sc = spark.sparkContext
    jobs = {}
    for k in (3, 12):
        rows = [((rng.normal(size=3) + 6 * np.array([i % k, (i % k) ** 2 / k, 0])).tolist(), i % k) for i in range(240)]
        df = spark.createDataFrame(rows, "vector array<double>, class_id int").coalesce(2).cache()
        sc.setJobGroup(f"machines-{k}", "fit")
        found = machines.fit_machines(df, lambda classes: machines.one_vs_one(classes, 0.1))
        jobs[k] = len(sc.statusTracker().getJobIdsForGroup(f"machines-{k}")), found.passes
    sc.setJobGroup("rest", "rest")
    assert all(n <= passes + 8 for n, passes in jobs.values())


def test_grid_of_machines(blobs):
    train, _ = blobs
    folded = train.withColumn("fold", cuts.fold_of(cuts.sample_key(F.col("image_id")), 3)).cache()
    lines = machines.grid_scores(folded, [1e-7, 1.0], "fold", 3).collect()
    found = {r["candidate"]: r["mean_accuracy"] for r in lines}
    assert len(lines) == 12 and found["ovo C=1.0"] > 0.9 and found["ovr C=1.0"] > 0.9 and found["ovo C=1.0"] >= found["ovo C=1e-07"]
    one = models.grid_search(folded, {"x": models.svc_one_vs_one(1.0)}, "fold", 3).orderBy("fold").collect()
    same = sorted((r["fold"], r["accuracy"]) for r in lines if r["candidate"] == "ovo C=1.0")
    assert [r["accuracy"] for r in one] == pytest.approx([a for _, a in same])


def test_least_squares_on_subsets_match_numpy(spark, blobs):
    train, test = blobs
    results, counts = gram.ablation(train, test, {"x": (0, 2), "y": (2, 4)})
    results, counts = results.collect(), counts.collect()
    assert {tuple(r["features"]) for r in results} == {("x",), ("y",), ("x", "y")} and all(r["train_time"] > 0 and r["predict_time"] > 0 for r in results)
    (xa, ya), (xb, yb) = ((np.array([r["vector"] for r in df.collect()]), np.array([r["class_id"] for r in df.collect()])) for df in (train, test))
    for name, own in (("x", [0, 1]), ("y", [2, 3]), ("x+y", [0, 1, 2, 3])):
        mean, spread = xa[:, own].mean(0), xa[:, own].std(0)
        a, b = (xa[:, own] - mean) / spread, (xb[:, own] - mean) / spread
        marks = np.eye(3)[ya]
        weights = np.linalg.solve(a.T @ a / len(a) + gram.RIDGE * np.eye(len(own)), a.T @ (marks - marks.mean(0)) / len(a))
        best = (b @ weights + marks.mean(0)).argmax(axis=1)
        want = {(int(i), int(j)): int(((yb == i) & (best == j)).sum()) for i in range(3) for j in range(3) if ((yb == i) & (best == j)).any()}
        assert {(r["actual"], r["predicted"]): r["n"] for r in counts if r["subset"] == name} == want
        assert next(r for r in results if "+".join(r["features"]) == name)["accuracy"] == pytest.approx((best == yb).mean())
    with pytest.raises(ValueError):
        gram.ablation(train.limit(0), test, {"x": (0, 2)})


def test_machines_on_all_subsets(blobs):
    found = {tuple(r["features"]): r["accuracy"] for r in machines.subset_scores(*blobs, {"x": (0, 2), "y": (2, 4)}, penalty=1.0).collect()}
    assert found["x",] > 0.9 and found["x", "y"] > 0.9 and found["y",] < 0.9


def test_median_vectors_by_narrowing(spark, monkeypatch):
    monkeypatch.setattr(middles, "ARRAY_BYTES", 24 * middles.STEPS * 3 * 2)  # two positions at a time
    rng = np.random.default_rng(8)
    rows = []
    for i in range(501):
        name = None if i % 5 == 4 else "hot" if i % 5 else "b"
        rows.append((name, [float(rng.integers(0, 4)), float(rng.normal()), 7.0, None if i % 3 else 1e300 * rng.normal(), None if name == "b" else -0.5]))
    df = spark.createDataFrame(rows, "name string, v array<double>").repartition(4)
    found = {(r["name"], r["pos"]): r["median"] for r in middles.median_vectors(df, "v", "name").collect()}
    want = {}
    for name in ("hot", "b", None):
        for pos in range(5):
            values = [v[pos] for n, v in rows if n == name and v[pos] is not None]
            if values:
                want[name, pos] = float(np.median(values))
    assert found == pytest.approx(want)
    assert middles.median_vectors(df.limit(0), "v", "name").count() == 0


def test_ablation_scores_every_subset(blobs):
    parts = [
        df.select("class_id", F.slice("vector", 1, 2).alias("hog"), F.slice("vector", 3, 2).alias("hue")) for df in blobs
    ]
    lines = {tuple(r["features"]): r for r in experiments.ablation(*parts, ["hog", "hue"], models.logistic(10)).collect()}
    assert set(lines) == {("hue",), ("hog",), ("hue", "hog")}
    assert lines["hue", "hog"]["num_features"] == 4 and lines["hog",]["accuracy"] > lines["hue",]["accuracy"]
    assert all(r["train_time"] > 0 and r["predict_time"] > 0 for r in lines.values())


def test_fitted_model_is_loaded_the_second_time(spark, blobs, tmp_path):
    from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel

    fits = []

    def fit():
        fits.append(1)
        return LogisticRegression(maxIter=5).fit(models.as_ml(blobs[0]))

    for _ in range(2):
        model = writers.load_or_fit(spark, str(tmp_path / "model"), fit, LogisticRegressionModel.load)
    assert len(fits) == 1 and model.numClasses == 3
