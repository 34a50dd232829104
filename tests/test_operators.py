"""Relational operators on small frames with known answers, also with a very common key."""

import random
import statistics

import pytest
from pyspark.sql import functions as F

from tessera.functions import planes, scalars
from tessera.operators import columns, cuts, evaluate, experiments, groups, joins, stats


def ids(df, name="id"):
    return sorted(r[name] for r in df.select(name).collect())


@pytest.fixture(scope="module")
def skewed(spark):
    """Class 0 holds more than a third of the rows."""
    rows = [(i, 0 if i % 5 < 2 else i % 7) for i in range(3000)]
    return spark.createDataFrame(rows, "id long, class_id int").repartition(5)


def key():
    return cuts.sample_key(F.col("id"))


def brute_lowest(df, n):
    rows = [(r["class_id"], r["k"], r["id"]) for r in df.select("*", key().alias("k")).collect()]
    out = []
    for c in {r[0] for r in rows}:
        out += [i for _, _, i in sorted(r for r in rows if r[0] == c)[:n]]
    return sorted(out)


@pytest.mark.parametrize("bucket_rows", [100_000, 3])
def test_sample_per_class_matches_sort(skewed, monkeypatch, bucket_rows):
    monkeypatch.setattr(cuts, "BUCKET_ROWS", bucket_rows)
    monkeypatch.setattr(cuts, "DIGITS", 1 if bucket_rows == 3 else 3)
    for n in (1, 40, 500):
        assert ids(cuts.sample_per_class(skewed, n, ["class_id"], key())) == brute_lowest(skewed, n)


def test_balanced_sample_and_guard(skewed):
    taken = cuts.balanced_sample(skewed, 50, ["class_id"], key())
    assert {r["count"] for r in taken.groupBy("class_id").count().collect()} == {50}
    with pytest.raises(ValueError):
        cuts.balanced_sample(skewed, 2000, ["class_id"], key())


def test_samples_do_not_shuffle_the_rows(skewed):
    wide = skewed.withColumn("payload", F.repeat(F.lit("x"), 1000))
    for df in (cuts.sample_per_class(wide, 40, ["class_id"], key()), cuts.split_exact(wide, 0.8, key())):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" not in plan and "ShuffledHashJoin" not in plan
        moved = [line for line in plan.splitlines() if "Exchange" in line and "payload" in line]
        assert not moved


def test_samples_do_not_depend_on_partitions(skewed):
    first = ids(cuts.sample_rows(skewed, 123, key()))
    assert first == ids(cuts.sample_rows(skewed.repartition(13), 123, key())) and len(first) == 123
    assert len(ids(cuts.sample_rows(skewed, 9999, key()))) == 3000


def test_exact_split_sizes(spark):
    df = spark.range(43 * 210)
    parts = cuts.split_exact(df, 0.8, key()).groupBy("part").count().collect()
    assert {r["part"]: r["count"] for r in parts} == {"train": 7224, "validation": 1806}
    one = cuts.split_exact(spark.range(1), 0.8, key()).collect()
    assert [r["part"] for r in one] == ["validation"]


def test_narrow_buckets_and_tail_split(spark, monkeypatch):
    df = spark.range(1000).select((F.col("id") * 7 + 2**60).alias("id"))
    whole = ids(cuts.sample_rows(df, 300, key()))
    monkeypatch.setattr(cuts, "BUCKET_ROWS", 2)
    monkeypatch.setattr(cuts, "DIGITS", 1)
    monkeypatch.setattr(cuts, "RANGE_ROWS", 1)
    assert ids(cuts.sample_rows(df, 300, key())) == whole
    train = cuts.split_tail(df, 0.9, "id").where("part = 'train'")
    assert ids(train) == [i * 7 + 2**60 for i in range(900)]


def test_slices_tile_the_frame(spark):
    df = spark.range(250)
    parts = [ids(cuts.rows_between(df, key(), start, 100)) for start in (0, 100, 200, 300)]
    assert [len(p) for p in parts] == [100, 100, 50, 0]
    assert sorted(sum(parts, [])) == list(range(250))


def test_hash_split_and_folds(spark):
    df = spark.range(20_000).select("id", cuts.split_hashed(key(), 0.8).alias("s"), cuts.fold_of(key(), 5).alias("f"))
    assert abs(df.where("s = 'train'").count() - 16_000) < 300
    assert all(abs(r["count"] - 4000) < 300 for r in df.groupBy("f").count().collect())


@pytest.mark.parametrize("ranges,direct", [(1024, 10_000), (1024, 1), (2, 5)])
def test_medians_match(spark, monkeypatch, ranges, direct):
    monkeypatch.setattr(cuts, "RANGES", ranges)
    monkeypatch.setattr(cuts, "RANGE_ROWS", direct)
    rnd = random.Random(5)
    values = {0: [rnd.gauss(0, 1e6) for _ in range(501)], 1: [1.5] * 40, 2: [rnd.randrange(9) * 1.0 for _ in range(200)]}
    values[3], values[4] = [1e-300, 1e300, 5.0], [-4.0, 8.0]
    values[5] = [-1.7e308, 1.7e308, 3.0, 4.0, 5.0]
    values[6] = [float("-inf"), float("inf"), 1.0, 2.0, 2.5]
    df = spark.createDataFrame([(g, v) for g, vs in values.items() for v in vs], "g int, v double").repartition(4)
    found = {r["g"]: r["median"] for r in cuts.medians(df, "v", ["g"]).collect()}
    assert found == {g: pytest.approx(statistics.median(vs)) for g, vs in values.items()}


def test_median_of_wide_whole_numbers(spark, monkeypatch):
    monkeypatch.setattr(cuts, "RANGE_ROWS", 1)
    monkeypatch.setattr(cuts, "RANGES", 4)
    values = [-(2**63), 2**63 - 1, 2**62, 2**62 + 1, 2**62 + 2]
    df = spark.createDataFrame([(v,) for v in values], "v long")
    third = cuts.values_at(df, "v", [], lambda total: [F.floor((total + 1) / 2)])
    assert third.first()["value"] == 2**62 + 1


def test_duplicates(spark):
    paths = spark.createDataFrame([(i, p) for i, p in enumerate("aabccc")], "id int, path string")
    assert groups.duplicate_rows(paths, F.col("path")).first()[0] == 5
    for hot in (100_000, 3, 2):
        flagged = groups.flag_duplicates(paths, F.col("path"), hot_rows=hot)
        assert {r["id"]: r["is_duplicate"] for r in flagged.collect()} == {0: True, 1: True, 2: False, 3: True, 4: True, 5: True}
    assert ids(groups.distinct_by(paths, F.col("path"), "id")) == [0, 2, 3]
    none = paths.withColumn("path", F.when(F.col("id") > 3, F.lit(None)).otherwise(F.col("path")))
    assert groups.flag_duplicates(none, F.col("path")).count() == 6


def test_one_per_class(skewed):
    assert ids(groups.first_per_class(skewed, "class_id", "id")) == sorted(
        r[0] for r in skewed.groupBy("class_id").agg(F.min("id")).select("min(id)").collect()
    )
    assert ids(groups.random_per_class(skewed, "class_id", key())) == brute_lowest(skewed, 1)


@pytest.fixture(scope="module")
def five(spark):
    return spark.createDataFrame([(0, 0), (0, 1), (1, 1), (1, 1), (2, 0)], "actual int, predicted int")


def test_confusion_and_scores(five):
    counts = evaluate.confusion(five, 3)
    cells = {(r["actual"], r["predicted"]): r["n"] for r in counts.collect()}
    assert [[cells[a, p] for p in range(3)] for a in range(3)] == [[1, 1, 0], [0, 2, 0], [1, 0, 0]]
    assert evaluate.accuracy(five).first()[0] == pytest.approx(0.6)
    lines = {r["label"]: r for r in evaluate.class_report(counts).collect()}
    want = {"0": (0.5, 0.5, 0.5, 2), "1": (2 / 3, 1, 0.8, 2), "2": (0, 0, 0, 1), "accuracy": (0.6, 0.6, 0.6, 5)}
    want["macro avg"] = (7 / 18, 0.5, 1.3 / 3, 5)
    want["weighted avg"] = (7 / 15, 0.6, 0.52, 5)
    for label, numbers in want.items():
        line = lines[label]
        assert (line["precision"], line["recall"], line["f1"], line["support"]) == pytest.approx(numbers)
    assert len(lines) == 6
    top = evaluate.top_confused(counts, 2).collect()
    assert [(r["actual"], r["predicted"], r["percent"]) for r in top] == [(2, 0, 100.0), (0, 1, 50.0)]
    assert evaluate.misclassified(five, 0).count() == 1


def test_confusion_by_group(five):
    both = five.withColumn("m", F.lit("a")).unionByName(five.limit(2).withColumn("m", F.lit("b")))
    found = evaluate.confusion(both, 3, ["m"])
    assert found.count() == 18 and found.groupBy("m").agg(F.sum("n")).orderBy("m").collect()[0][1] == 5


def test_percent_of_an_empty_class_is_null(spark):
    one = spark.createDataFrame([(0, 0)], "actual int, predicted int")
    shares = {r["actual"]: r["percent"] for r in evaluate.confusion_percent(evaluate.confusion(one, 2)).collect()}
    assert shares == {0: 0.0, 1: None} or shares[1] is None


def test_mllib_agrees_on_weighted_scores(five):
    from pyspark.ml.evaluation import MulticlassClassificationEvaluator as Evaluator

    doubles = five.select(F.col("actual").cast("double").alias("label"), F.col("predicted").cast("double").alias("prediction"))
    ours = evaluate.weighted_scores(evaluate.confusion_counts(five)).first()
    for name, metric in (("precision", "weightedPrecision"), ("recall", "weightedRecall"), ("f1", "f1")):
        assert ours[name] == pytest.approx(Evaluator(metricName=metric).evaluate(doubles))


def test_scalars(spark):
    row = spark.range(1).select(
        scalars.duration(F.lit(3725.5)).alias("clock"),
        scalars.duration(F.lit(3725.5), mili=True).alias("tail"),
        scalars.duration(F.lit(200000.0), mili=True).alias("days"),
        scalars.capitalised(F.lit("hOG value")).alias("cap"),
        scalars.class_text(F.lit(7)).alias("cls"),
        scalars.percent_text(F.lit(0.98765)).alias("pct"),
        scalars.argmax(F.array(F.lit(0.2), F.lit(0.5), F.lit(0.5))).alias("best"),
        scalars.normalised(F.array(F.lit(1), F.lit(3))).alias("hist"),
        F.size(scalars.subsets(list("abcdefgh"))).alias("n8"),
        F.size(scalars.subsets(list("abcd"))).alias("n4"),
        scalars.interpolate(F.lit(5.0), F.lit(5.0), F.lit(5.0), 0, 255).alias("flat"),
        planes.stretch(F.array(F.lit(10), F.lit(20), F.lit(30))).alias("stretch"),
    ).first()
    assert (row["clock"], row["tail"], row["days"]) == ("1:02:05", "5.500000", "2 days, 7:33:20")
    assert (row["cap"], row["cls"], row["pct"], row["best"]) == ("Hog value", "Class 7", "98.77%", 2 - 1)
    assert row["hist"] == pytest.approx([1 / (4 + 1e-6), 3 / (4 + 1e-6)])
    assert (row["n8"], row["n4"], row["flat"], row["stretch"]) == (255, 15, 0.0, [0, 127, 255])


def test_feature_columns(spark):
    df = spark.createDataFrame([(1, [1.0], [2.0, 3.0])], "image_id int, hog array<double>, hue array<double>")
    assert df.select(columns.assemble(["hog", "hue"])).first()[0] == [2.0, 3.0, 1.0]
    with pytest.raises(ValueError):
        columns.assemble(["colour"])
    with pytest.raises(ValueError):
        columns.feature_base(df, "image")
    assert {r["feature"]: r["width"] for r in stats.feature_widths(df, ["hog", "hue"]).collect()} == {"hog": 1, "hue": 2}


def test_constant_columns_scale_to_zero(spark):
    df = spark.createDataFrame([(1, [1.0, 5.0]), (2, [3.0, 5.0])], "id int, v array<double>")
    found = {r["id"]: r["standardised"] for r in stats.standardise(df, "v").collect()}
    assert found == {1: [-1.0, 0.0], 2: [1.0, 0.0]}


def test_grid_and_subsets(spark):
    grid = experiments.run_grid(spark, {"epochs": [10], "filters": [[6, 16], [12, 16]], "dense": [[120, 84], [84, 64]], "dropout": [0.5, 0.3]})
    assert grid.count() == 8 and grid.columns == ["epochs", "filters", "dense", "dropout"]
    assert len(experiments.feature_subsets(["hog", "lbp", "hue", "sat", "value", "template", "vgg16", "resnet101"])) == 255


def test_meta_join_keeps_both_paths(spark):
    left = spark.createDataFrame([(1, "train/1.png")], "class_id int, path string")
    meta = spark.createDataFrame([(1, "meta/1.png")], "class_id int, path string")
    assert joins.join_meta(left, meta).first().asDict() == {"class_id": 1, "path": "train/1.png", "meta_path": "meta/1.png"}


def test_similarity_of_an_image_with_itself(spark):
    df = spark.createDataFrame([([10, 20, 30, 40, 50, 60, 70, 80, 90],)], "p array<int>")
    found = df.select(planes.similarity_map(F.col("p"), 3, 3, F.col("p"), 3, 3)).first()[0]
    assert found[4] == pytest.approx(9) and max(found) == found[4]


def test_reports_with_classes_that_are_missing_null_or_unforeseen(spark):
    pairs = [(0, 0), (0, 2), (1, 0), (11, 11), (None, 0)]
    df = spark.createDataFrame(pairs, "actual int, predicted int")
    cells = {(r.actual, r.predicted): r.n for r in evaluate.confusion(df, 3).collect()}
    assert len(cells) == 17 and sum(cells.values()) == 5 and cells[11, 11] == 1 and cells[None, 0] == 1
    assert evaluate.confusion_wide(evaluate.confusion(df, 3), 3).columns == ["actual", "0", "1", "2", "11"]
    lines = {r.label: r for r in evaluate.class_report(evaluate.confusion(df, 3)).collect()}
    assert sorted(lines) == sorted(["0", "1", "2", "11", "null", "accuracy", "macro avg", "weighted avg"])
    assert (lines["2"].support, lines["2"].recall, lines["1"].precision) == (0, 0.0, 0.0)
    assert lines["accuracy"].precision == 2 / 5
    assert lines["macro avg"].recall == (0.5 + 0 + 0 + 1 + 0) / 5  # class 9 of a wider grid would not count
    empty = evaluate.confusion(df.limit(0), 2)
    assert {r.label: r.precision for r in evaluate.class_report(empty).collect()}.get("accuracy", 0.0) == 0.0


def test_class_counts_keep_unforeseen_classes(spark):
    df = spark.createDataFrame([(0,), (12,), (12,), (None,)], "class_id int")
    got = {r.class_id: r.n for r in stats.class_counts(df, 3).collect()}
    assert got == {0: 1, 1: 0, 2: 0, 12: 2, None: 1}


def test_samples_refuse_ids_that_decide_nothing(spark):
    key = cuts.sample_key(F.col("id"))
    nulls = spark.createDataFrame([(i if i > 2 else None, 0) for i in range(20)], "id int, c int")
    for n in (2, 5, 10):
        with pytest.raises(Exception, match="not null"):
            cuts.balanced_sample(nulls, n, ["c"], key).collect()
        with pytest.raises(Exception, match="not null"):
            cuts.sample_rows(nulls, n, key).collect()
    with pytest.raises(Exception, match="not null"):
        cuts.split_exact(nulls, 0.8, key).collect()
    with pytest.raises(ValueError, match="unique"):
        cuts.split_tail(nulls, 0.8, "id")
    repeated = spark.createDataFrame([(i // 4, 0) for i in range(20)], "id int, c int")
    for n in (2, 5):
        with pytest.raises(Exception, match="unique"):
            cuts.balanced_sample(repeated, n, ["c"], key).collect()
    assert cuts.balanced_sample(repeated, 8, ["c"], key).count() == 8
    with pytest.raises(ValueError, match="unique"):
        cuts.split_tail(repeated, 0.75, "id")


def test_null_keys_are_duplicates_of_each_other(spark):
    df = spark.createDataFrame([(1, "a"), (2, "a"), (3, None), (4, None), (5, "b")], "id int, k string")
    assert groups.duplicate_rows(df, F.col("k")).first()[0] == 4
    for hot in (1, 100):
        assert sorted(r.id for r in groups.flag_duplicates(df, F.col("k"), hot).where("is_duplicate").collect()) == [1, 2, 3, 4]
