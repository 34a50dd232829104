"""Nets: gradients by differences, one epoch against plain NumPy, separable classes, the ledger of runs."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.operators import experiments, nets
from tessera.operators.nets import Net, fit_net, keep_mask, start_layers


@pytest.fixture(scope="module")
def blobs(spark):
    rng = np.random.default_rng(4)
    centres = np.array([[0, 0, 0, 0], [3, 0, 1, 0], [0, 3, 0, 1]])
    rows = [(i, 5 + i % 3, (centres[i % 3] + rng.normal(size=4) / 2).tolist()) for i in range(240)]
    return spark.createDataFrame(rows, "image_id long, class_id int, vector array<double>")


def test_gradients_by_differences():
    rng = np.random.default_rng(1)
    net = Net(np.arange(3), [(rng.normal(size=s), rng.normal(size=s[1])) for s in ((4, 6), (6, 5), (5, 3))], plain=1)
    x, label = rng.normal(size=(7, 4)), rng.integers(0, 3, 7)
    mask = keep_mask(np.arange(7), 5, 0.3, 2, 1)
    loss, _, slopes = net.slopes(x, label, mask)
    for (weights, shifts), (a, b) in zip(net.layers, slopes):
        for array, slope in ((weights, a), (shifts, b)):
            for at in list(np.ndindex(array.shape))[::3]:
                was = array[at]
                array[at] = was + 1e-6
                more = net.slopes(x, label, mask)[0]
                array[at] = was - 1e-6
                less = net.slopes(x, label, mask)[0]
                array[at] = was
                assert (more - less) / 2e-6 / 7 == pytest.approx(slope[at], abs=1e-6)


def test_masks_follow_the_rows():
    whole = keep_mask(np.arange(5000) * 977, 20, 0.25, 3, 9)
    assert set(np.unique(whole)) == {0.0, 1 / 0.75} and abs((whole == 0).mean() - 0.25) < 0.01
    assert (keep_mask(np.arange(5000)[100:] * 977, 20, 0.25, 3, 9) == whole[100:]).all()
    assert (keep_mask(np.arange(5000) * 977, 20, 0.25, 4, 9) != whole).any()


def test_one_epoch_is_that_of_numpy(spark, blobs):
    rows = blobs.coalesce(1).cache()
    lines = rows.collect()
    x, y = np.array([r["vector"] for r in lines]), np.array([r["class_id"] for r in lines]) - 5
    found = fit_net(rows, [], 2, 0.1, 50, ones=1)
    weights, shifts, losses = np.ones((4, 3)), np.ones(3), []
    for _ in range(2):
        total = 0.0
        for a in range(0, 240, 50):
            scores = x[a : a + 50] @ weights + shifts
            chance = np.exp(scores) / np.exp(scores).sum(axis=1, keepdims=True)
            total -= np.log(chance[np.arange(len(chance)), y[a : a + 50]]).sum()
            pull = chance - np.eye(3)[y[a : a + 50]]
            weights, shifts = weights - 0.1 * x[a : a + 50].T @ pull / len(pull), shifts - 0.1 * pull.mean(axis=0)
        losses.append(total / 240)
    assert np.allclose(found.layers[0][0], weights) and np.allclose(found.layers[0][1], shifts)
    assert [h[1] for h in found.history] == pytest.approx(losses)


def test_tasks_are_averaged_by_their_rows(spark, blobs):
    rows = blobs.repartition(4, "image_id").cache()
    parts = [np.array(p) for p in rows.select("vector", "class_id").rdd.glom().map(lambda p: [[*r[0], r[1]] for r in p]).collect() if p]
    one = fit_net(rows, [], 1, 0.1, 20, ones=1)
    layers = []
    for part in parts:
        net = Net(np.array([5, 6, 7]), start_layers([4, 3], 1, 0))
        layers.append(nets.train_epoch(net, iter([(part[:, :4], part[:, 4].astype(int) - 5, np.zeros(len(part)))]), 0.1, 20, 0, 0))
    weights = sum(n * l[0][0] for l, n, *_ in layers) / sum(n for _, n, *_ in layers)
    assert len(parts) > 1 and np.allclose(one.layers[0][0], weights)
    again = fit_net(rows, [], 1, 0.1, 20, ones=1)
    assert (again.layers[0][0] == one.layers[0][0]).all()


def test_classes_are_told_apart_and_loss_falls(spark, blobs):
    train, test = blobs.where("image_id < 180").repartition(3).cache(), blobs.where("image_id >= 180")
    for fit in (nets.softmax(30), nets.dense_net([16], 60, first=8, step=0.05)):
        predicted = fit(train)(test)
        assert predicted.agg(F.avg((F.col("prediction") == F.col("class_id")).cast("double"))).first()[0] > 0.95
        assert set(predicted.columns) == {"image_id", "class_id", "vector", "prediction", "probability"}
    losses = [h[1] for h in fit_net(train, [], 20, 0.1, 50, ones=1, identity="image_id").history]
    assert all(b < a for a, b in zip(losses, losses[1:]))
    with pytest.raises(ValueError):
        fit_net(train.limit(0), [], 1, 0.1, 50)


def test_only_missing_runs_are_made(spark, tmp_path):
    plan = experiments.run_grid(spark, {"epochs": [1, 2], "filters": [[6, 16], [12, 16]], "drop": [0.5, None]})
    made, ledger = [], str(tmp_path / "ledger")

    def execute(line):
        if len(made) == 3:
            made.append(None)
            raise RuntimeError("killed")
        made.append(tuple(line))
        return {"accuracy": line["epochs"] / 10, "note": None}

    names = ["epochs", "filters", "drop"]
    with pytest.raises(RuntimeError):
        experiments.run_missing(plan, ledger, names, execute, "accuracy double, note string")
    assert spark.read.parquet(ledger).count() == 3
    found = experiments.run_missing(plan, ledger, names, execute, "accuracy double, note string").collect()
    runs = [m for m in made if m]
    assert len(found) == 8 and len(runs) == 8 and len({repr(m) for m in runs}) == 8
    assert all(r["accuracy"] == r["epochs"] / 10 and r["seconds"] >= 0 for r in found)
    before = len(made)
    experiments.run_missing(plan.union(plan), ledger, names, execute, "accuracy double, note string").collect()
    assert len(made) == before
