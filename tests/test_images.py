"""Readers, writers, the image and feature tables and the Arrow operators."""

import tracemalloc

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from conftest import write_png
from pyspark.sql import functions as F

from tessera.functions import kernels, planes
from tessera.operators import build, columns, images as ops, joins
from tessera.plans.registry import QUERIES
from tessera.sources import checks, readers, writers
from tessera.streaming import rowmaps

CLASSES = 3
PER_CLASS = 4


@pytest.fixture(scope="module")
def dataset(tmp_path_factory):
    """A few small pictures with an index, a class table and its templates."""
    root = tmp_path_factory.mktemp("dataset")
    lines = ["Width,Height,Roi.X1,Roi.Y1,Roi.X2,Roi.Y2,ClassId,Path"]
    meta = ["Path,ClassId,ShapeId,ColorId,SignId,Description"]
    (root / "Meta").mkdir()
    for c in range(CLASSES):
        rng = np.random.default_rng(c)
        write_png(root / "Meta" / f"{c}.png", rng.integers(0, 256, (70, 70, 3)).tolist())
        meta.append(f"Meta/{c}.png,{c},1,0,{'None' if c == 1 else '1.3.2'},Sign {c}")
        (root / "Train" / str(c)).mkdir(parents=True)
        for i in range(PER_CLASS):
            h, w = 30 + i, 40 + c
            name = f"Train/{c}/img {i}+{c}.png"
            write_png(root / name, rng.integers(0, 256, (h, w, 3)).tolist())
            lines.append(f"{w},{h},5,5,{w - 6},{h - 6},{c},{name}")
    (root / "Train.csv").write_text("\n".join(lines) + "\n")
    (root / "Meta_full.csv").write_text("\n".join(meta) + "\n")
    (root / "shapes.csv").write_text("Shape ID,Description,,,\n0,Triangle,,,\n1,Circle,,,\n")
    return root


def pixels_of(row):
    numbers = np.float32 if row["dtype"] == "f4" else np.uint8
    return np.frombuffer(row["data"], numbers).reshape(row["height"], row["width"], row["channels"])


def test_png_is_read_as_rgb(spark, tmp_path):
    write_png(tmp_path / "a.png", [[(40 * x, 40 * y, 7) for x in range(4)] for y in range(3)])
    row = readers.read_images(spark, str(tmp_path)).first()
    image = pixels_of(row["image"])
    assert row["path"] == "a.png" and image.shape == (3, 4, 3)
    assert image[0, :3].tolist() == [[0, 0, 7], [40, 0, 7], [80, 0, 7]]


def test_index_and_class_tables(spark, dataset):
    index = readers.read_index(spark, str(dataset / "Train.csv"))
    assert index.columns[1:] == ["width", "height", "roi_x1", "roi_y1", "roi_x2", "roi_y2", "class_id", "path", "resolution"]
    assert index.count() == CLASSES * PER_CLASS and index.select("image_id").distinct().count() == 12
    meta = {r["class_id"]: r["sign_id"] for r in readers.read_meta(spark, str(dataset / "Meta_full.csv")).collect()}
    assert meta == {0: "1.3.2", 1: None, 2: "1.3.2"}
    assert [tuple(r) for r in readers.read_lookup(spark, str(dataset / "shapes.csv")).orderBy("id").collect()] == [(0, "Triangle"), (1, "Circle")]


def test_a_wrong_header_is_refused(spark, tmp_path):
    (tmp_path / "x.csv").write_text("Height,Width,Roi.X1,Roi.Y1,Roi.X2,Roi.Y2,ClassId,Path\n1,2,3,4,5,6,7,a\n")
    with pytest.raises(Exception):
        readers.read_index(spark, str(tmp_path / "x.csv")).collect()


def test_completeness_check(spark, dataset):
    found = checks.names_of(readers.list_files(spark, str(dataset)), "Train")
    expected = checks.expected_names(["Meta_full.csv", "Train.csv", "Test.csv"], "Train", CLASSES + 1, spark)
    assert sorted(r["name"] for r in checks.missing(found, expected).collect()) == ["Test.csv", "Train/3"]


def test_counts_in_file_names(spark):
    names = spark.createDataFrame([("flowers00-230.tfrec",), ("flowers01-30.tfrec",), ("readme",)], "path string")
    assert checks.count_items(names).first()[0] == 260


@pytest.fixture(scope="module")
def table(spark, dataset, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("tables") / "images")
    built = build.image_table(spark, str(dataset / "Train.csv"), str(dataset), wide=True)
    writers.write_table(built, path)
    return path


def test_image_table(spark, table):
    df = readers.read_table(spark, table)
    assert df.count() == CLASSES * PER_CLASS
    for row in df.collect():
        w, h = row["roi_x2"] - row["roi_x1"] + 1, row["roi_y2"] - row["roi_y1"] + 1
        assert (row["cropped_width"], row["cropped_height"], row["cropped_resolution"]) == (w, h, w * h)
        whole = pixels_of(row["image"])
        assert (pixels_of(row["cropped_image"]) == whole[5 : 5 + h, 5 : 5 + w]).all()
        assert (row["scaled_width"], row["scaled_height"]) == (64, 64)
        assert (row["network_width"], row["network_height"]) == (224, 224)
        assert row["scaled_image"]["dtype"] == "f4"


def test_feature_table(spark, dataset, table):
    base = columns.feature_base(readers.read_table(spark, table))
    meta = build.meta_table(spark, str(dataset / "Meta_full.csv"), str(dataset))
    templates = meta.select("class_id", F.col("scaled_meta_image").alias("image"))
    features = build.feature_table(base, templates)
    row = features.first()
    widths = {n: len(row[n]) for n in ("hue_hist", "saturation_hist", "value_hist", "lbp_image", "lbp_hist", "hog_features", "template_pattern")}
    assert widths == {
        "hue_hist": 180,
        "saturation_hist": 256,
        "value_hist": 256,
        "lbp_image": 4096,
        "lbp_hist": 1024,
        "hog_features": 2916,
        "template_pattern": 81 * CLASSES,
    }
    assert all(sum(row[f"{n}_hist"]) == 4096 for n in ("hue", "saturation", "value", "lbp"))
    single = base.where(F.col("image_id") == row["image_id"])
    apart = ops.template_pattern(single, templates).select(
        ops.hsv_histograms("image").alias("h"), ops.lbp()("image").alias("l"), ops.hog()("image").alias("g"), "template_pattern"
    )
    again = apart.first()
    assert row["hue_hist"] == again["h"]["hue_hist"] and row["lbp_image"] == again["l"]["lbp_image"]
    assert row["hog_features"] == again["g"] and row["template_pattern"] == again["template_pattern"]
    plan = features._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Join" not in plan


def test_labelled_images(spark, dataset):
    index = readers.read_index(spark, str(dataset / "Train.csv"))
    loaded = readers.read_images(spark, str(dataset), "Train")
    loaded = loaded.withColumn("image", ops.centre_crop(20, 20)("image"))
    assert readers.labelled_images(index, loaded, 20).columns == ["image", "class_id"]
    assert readers.labelled_images(index, loaded, 20, labelled=False).count() == 12
    with pytest.raises(Exception, match="is not 21 x 21"):
        readers.labelled_images(index, loaded, 21).count()
    gone = index.first()["path"]
    with pytest.raises(FileNotFoundError):
        readers.labelled_images(index, loaded.where(F.col("path") != gone), 20)
    listed = readers.list_files(spark, str(dataset), folder="Train")
    assert readers.labelled_images(index, loaded, 20, listed=listed).count() == 12
    with pytest.raises(FileNotFoundError):
        readers.labelled_images(index, loaded, 20, listed=listed.where(F.col("path") != gone))


def tile_images(spark, n=6, side=8):
    rng = np.random.default_rng(11)
    rows = [(i, i % 3, *[rng.integers(0, 256, side * side).tolist() for _ in "rgb"]) for i in range(n)]
    df = spark.createDataFrame(rows, "image_id long, class_id int, r array<int>, g array<int>, b array<int>")
    return df.withColumn("image", ops.from_planes(F.col("r"), F.col("g"), F.col("b"), side, side))


def test_native_and_batch_operators_agree(spark):
    df = tile_images(spark)
    rgb = [F.col(c) for c in "rgb"]
    first = ops.vector_map(lambda s: np.rint(s[..., 0] * 255), "int")
    level = ops.vector_map(lambda s: s[..., 0], "int")
    pairs = {
        "grey": (planes.grey(*rgb), ops.grey_plane("image")),
        "hue": (planes.channel(planes.hsv(*rgb), "h"), level(ops.hsv_image("image"))),
        "crop": (planes.crop(F.col("r"), 8, 8, 2, 1, 9, 5)["plane"], level(ops.crop("image", F.lit(2), F.lit(1), F.lit(9), F.lit(5)))),
        "centre": (planes.centre_crop(F.col("r"), 8, 8, 4, 3)["plane"], level(ops.centre_crop(3, 4)("image"))),
        "stretch": (planes.stretch(planes.grey(*rgb)), ops.stretched_plane("image")),
        "resize": (F.transform(planes.resize_bilinear(F.col("r"), 8, 8, 5, 3), lambda x: F.rint(x)), first(ops.resize(3, 5)("image"))),
        "fit": (F.transform(planes.fit(F.col("r"), 8, 8, 11, 6), lambda x: F.rint(x)), first(ops.fit(6, 11)("image"))),
    }
    rows = df.select(*[c.cast("array<int>").alias(f"{n}_{i}") for n, p in pairs.items() for i, c in enumerate(p)]).collect()
    for name in pairs:
        for row in rows:
            a, b = np.array(row[f"{name}_0"]), np.array(row[f"{name}_1"])
            assert np.abs(a - b).max() <= (1 if name in ("resize", "fit") else 0), name


def test_histograms_sum_to_the_pixels(spark):
    for row in tile_images(spark).select(ops.hsv_histograms("image").alias("h")).collect():
        assert [sum(row["h"][n]) for n in ("hue_hist", "saturation_hist", "value_hist")] == [64] * 3


def test_mixed_sizes_nulls_and_partitions(spark):
    df = tile_images(spark).select("image_id", "image").unionByName(tile_images(spark, 3, 5).select((F.col("image_id") + 50).alias("image_id"), "image"))
    gone = df.limit(1).select(F.lit(99).cast("long").alias("image_id"), F.lit(None).cast(df.schema["image"].dataType).alias("image"))
    df = df.unionByName(gone)
    lbp = ops.lbp()
    found = [
        {r["image_id"]: r["l"] for r in df.repartition(n).select("image_id", lbp("image").alias("l")).collect()} for n in (1, 7)
    ]
    assert found[0] == found[1] and len(found[0]) == 10
    assert found[0][99]["lbp_image"] is None and len(found[0][51]["lbp_image"]) == 25


def test_legacy_codes(spark):
    legacy, full = ops.lbp(legacy_uint8=True), ops.lbp()
    row = tile_images(spark, 1).select(legacy("image").alias("a"), full("image").alias("b")).first()
    assert row["a"]["lbp_image"] == [c % 256 for c in row["b"]["lbp_image"]]


def test_template_blocks_give_the_same_scores(spark):
    df = tile_images(spark, 12).withColumn("plane", F.col("g"))
    templates = df.where("image_id < 3").select("class_id", "plane")
    whole = {r["image_id"]: r["scores"] for r in ops.plane_scores(df, templates).collect()}
    cut = {r["image_id"]: r["scores"] for r in ops.plane_scores(df, templates, max_bytes=600).collect()}
    assert whole == cut and len(whole) == 12 and all([s["class_id"] for s in v] == [0, 1, 2] for v in whole.values())
    assert all(v[i]["score"] == pytest.approx(1) for i, v in whole.items() if i < 3)
    native = df.alias("a").join(templates.select("class_id", F.col("plane").alias("t")), "class_id")
    for row in native.select("image_id", "class_id", planes.correlation(F.col("plane"), F.col("t")).alias("s")).collect():
        assert whole[row["image_id"]][row["class_id"]]["score"] == pytest.approx(row["s"], abs=1e-8)


def test_template_pattern_in_blocks(spark):
    df = tile_images(spark, 6)
    templates = df.where("image_id < 3").select("class_id", "image")
    one = {r["image_id"]: r["template_pattern"] for r in ops.template_pattern(df, templates, margin=2).collect()}
    many = {r["image_id"]: r["template_pattern"] for r in ops.template_pattern(df, templates, margin=2, max_bytes=512).collect()}
    assert one == many and all(len(v) == 75 for v in one.values())
    assert one[1][25 + 12] == pytest.approx(1, abs=1e-6)


def test_refusal_force_and_compression(spark, tmp_path):
    path = str(tmp_path / "t")
    writers.write_table(spark.range(5), path)
    with pytest.raises(Exception):
        writers.write_table(spark.range(7), path)
    writers.write_table(spark.range(7), path, level=6, force=True)
    assert spark.read.parquet(path).count() == 7
    files = [pq.ParquetFile(p).metadata for p in (tmp_path / "t").glob("*.parquet")]
    used = {f.row_group(0).column(0).compression for f in files if f.num_rows}
    assert used == {"ZSTD"}


def test_refresh_column(spark, tmp_path):
    path = str(tmp_path / "features")
    writers.write_table(spark.range(4).withColumn("embedding", F.lit(0)), path)
    writers.refresh_column(spark, path, "embedding", lambda df: F.col("id") * 2)
    writers.refresh_column(spark, path, "extra", lambda df: F.col("id") + 1)
    rows = spark.read.parquet(path).orderBy("id").collect()
    assert [tuple(r) for r in rows] == [(i, 2 * i, i + 1) for i in range(4)]
    assert sorted(p.name for p in tmp_path.iterdir()) == ["features"]
    (tmp_path / "features").rename(tmp_path / "features.old")  # as if the swap had been cut short
    writers.refresh_column(spark, path, "extra", lambda df: F.col("id") + 5)
    assert [r["extra"] for r in spark.read.parquet(path).orderBy("id").collect()] == [5, 6, 7, 8]
    assert sorted(p.name for p in tmp_path.iterdir()) == ["features"]


def test_csv_and_matrix(spark, tmp_path):
    df = spark.createDataFrame([(1, [0.5, 2.0]), (2, [1.5, 3.0])], "id int, v array<double>")
    writers.write_csv(df, str(tmp_path / "c"), {"v": 2})
    back = spark.read.option("header", True).option("inferSchema", True).csv(str(tmp_path / "c"))
    assert sorted(tuple(r) for r in back.collect()) == [(1, 0.5, 2.0), (2, 1.5, 3.0)]
    assert back.columns == ["id", "v_0", "v_1"]
    writers.write_matrix(df, "v", str(tmp_path / "m"))
    assert sorted(r["vector"] for r in readers.read_matrix(spark, str(tmp_path / "m")).collect()) == [[0.5, 2.0], [1.5, 3.0]]


def test_compute_or_load(spark, tmp_path):
    calls = []

    def compute():
        calls.append(1)
        return spark.range(3)

    for _ in range(2):
        assert writers.load_or_compute(spark, str(tmp_path / "x"), compute).count() == 3
    assert len(calls) == 1


def test_run_log_and_its_best_runs(spark, tmp_path):
    from tessera.operators import experiments

    header = "Model,Epochs,Filter_Size,Kernel_Size,Dense_Layer,Dropout,Train_Accuracy,Val_Accuracy,Test_Accuracy,Train_Time"
    lines = [header]
    for e, acc, sec in ((5, "94.9%", " 53.88 "), (5, "95.2%", " 45.61 "), (10, "96.3%", " 94.14 ")):
        lines.append(f'Model HOG,{e},"[6, 16]","[21, 5]","[120, 84]",0.5,99.0%,94.3%,{acc},{sec}')
    lines += [",,,,,,,,,", header, lines[2], lines[1], lines[3], "Model,Time,Accuracy,,,,,,,", "Model HOG,45.61,95.2%,,,,,,,"]
    (tmp_path / "log.csv").write_text("\n".join(lines) + "\n")
    runs = readers.read_run_log(spark, str(tmp_path / "log.csv"))
    assert runs.count() == 3 and runs.first()["filter_size"] == [6, 16]
    picked = {r["label"]: (r["train_time"], r["test_accuracy"]) for r in experiments.label_extremes(runs).collect()}
    assert picked == {"most efficient": (45.61, pytest.approx(0.952)), "most accurate": (94.14, pytest.approx(0.963))}


def test_embeddings(spark):
    def load():
        return lambda flat: flat.reshape(len(flat), -1, 3).mean(axis=1)

    rows = ops.embed_images(tile_images(spark), load, 192, batch=4).collect()
    for row in rows:
        assert row["embedding"] == pytest.approx([np.mean(row[c]) / 255 for c in "rgb"], abs=1e-5)
    again = tile_images(spark).select("r", ops.embedder(load, 192)("image").alias("embedding")).first()
    assert again["embedding"][0] == pytest.approx(np.mean(again["r"]) / 255, abs=1e-5)


def test_same_results_on_a_stream(spark, tmp_path):
    source, sink, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    writers.write_table(tile_images(spark).select("image_id", "image"), source)
    hog = ops.hog(9, 2, 2)
    step = lambda df: df.select("image_id", hog("image").alias("hog"), ops.grey_plane("image").alias("grey"))
    rowmaps.transform_arrivals(spark, source, sink, state, step)
    streamed = {r["image_id"]: r for r in spark.read.parquet(sink).collect()}
    batch = {r["image_id"]: r for r in step(spark.read.parquet(source)).collect()}
    assert streamed == batch
    rowmaps.transform_arrivals(spark, source, sink, state, step)
    assert spark.read.parquet(sink).count() == 6




def test_light_and_flips(spark):
    df = tile_images(spark, 8)
    coin = ops.random_flip("image", F.col("image_id"))
    rows = df.select(
        "image_id",
        "image",
        ops.flip_left_right("image").alias("flip"),
        ops.transpose("image").alias("turn"),
        ops.brighten(0.3)("image").alias("bright"),
        ops.contrast(3.0)("image").alias("contrast"),
        coin.alias("maybe"),
        planes.coin(F.col("image_id")).alias("heads"),
    ).collect()
    for row in rows:
        image = pixels_of(row["image"])
        unit = image / 255
        assert (pixels_of(row["flip"]) == image[:, ::-1]).all() and (pixels_of(row["turn"]) == image.transpose(1, 0, 2)).all()
        assert np.allclose(pixels_of(row["bright"]), unit + 0.3, atol=1e-6)
        assert np.allclose(pixels_of(row["contrast"]), (unit - unit.mean((0, 1))) * 3 + unit.mean((0, 1)), atol=1e-5)
        assert (pixels_of(row["maybe"]) == (image[:, ::-1] if row["heads"] else image)).all()
    assert 0 < sum(r["heads"] for r in rows) < 8


def test_similarity_maps_agree(spark):
    df = tile_images(spark, 4)
    template = np.random.default_rng(2).integers(0, 256, (3, 5))
    listed = F.array(*[F.lit(int(v)) for v in template.ravel()])
    for threshold in (-1, 100):
        row = df.select(
            planes.similarity_map(planes.grey(F.col("r"), F.col("g"), F.col("b")), 8, 8, listed, 5, 3, threshold).alias("a"),
            ops.similarity(template, threshold)("image").alias("b"),
        ).first()
        assert row["a"] == pytest.approx(row["b"], abs=1e-4)


def test_large_sides_are_not_broadcast(spark):
    from tessera.session import sized

    side = spark.range(50).select("id", F.array_repeat(F.lit(1.0), 100).alias("v"))
    hinted = lambda df: "ResolvedHint" in df._jdf.queryExecution().analyzed().toString()
    assert hinted(sized(side)) and not hinted(sized(side, rows=49)) and not hinted(sized(side, size=30_000))


def test_gradients_agree(spark):
    df = tile_images(spark, 3)
    native = planes.sobel(planes.grey(F.col("r"), F.col("g"), F.col("b")), 8, 8)
    for row in df.select(native.alias("a"), ops.sobel("image").alias("b")).collect():
        assert [e["strength"] for e in row["a"]] == pytest.approx(row["b"]["strength"])
        assert [e["angle"] for e in row["a"]] == pytest.approx(row["b"]["angle"])


def test_row_templates(spark):
    df = tile_images(spark, 5).withColumn("t", F.slice("b", 1, 6))
    similar = ops.plane_similarity(8, 8, 2, 3)
    native = planes.similarity_map(F.col("r"), 8, 8, F.col("t"), 3, 2)
    for row in df.select(native.alias("a"), similar(F.col("r"), F.col("t")).alias("b")).collect():
        assert row["a"] == pytest.approx(row["b"])


def test_bucketed_tables_join_without_a_shuffle(spark):
    names = ["bucketed_images", "bucketed_features"]
    try:
        for name, column in zip(names, ("image", "hog")):
            writers.write_bucketed(spark.range(100).select(F.col("id").alias("image_id"), F.lit(1).alias(column)), name, 4, force=True)
        left, right = (spark.table(n).hint("merge") for n in names)
        joined = joins.attach(left, right)
        assert joined.count() == 100
        assert "Exchange" not in joined._jdf.queryExecution().executedPlan().toString()
    finally:
        for name in names:
            spark.sql(f"DROP TABLE IF EXISTS {name}")


def test_no_image_is_lost_on_reading(spark, tmp_path):
    root = tmp_path / "a root" / "root"
    (root / "root").mkdir(parents=True)
    names = ["plain.png", "b%41.png", "c d.png", "e+f.png", "root/again.png"]
    for i, name in enumerate(names):
        write_png(root / name, [[(10 * i, 0, 0)] * 4] * 4)
    (root / "broken.png").write_bytes(b"not a picture")
    index = spark.createDataFrame([(n, i) for i, n in enumerate([*names, "broken.png", "absent.png"])], "path string, class_id int")
    listed = readers.list_files(spark, str(root))
    assert sorted(r["path"] for r in listed.collect()) == sorted([*names, "broken.png"])
    loaded = readers.read_images(spark, str(root))
    assert sorted(r["path"] for r in loaded.collect()) == sorted([*names, "broken.png"])
    assert {r["path"]: r["reason"] for r in readers.rejects(index, loaded).collect()} == {"broken.png": "broken", "absent.png": "absent"}
    good = index.where("path NOT IN ('broken.png', 'absent.png')")
    assert sorted(r["path"] for r in readers.with_images(good, loaded, listed).collect()) == sorted(names)
    with pytest.raises(FileNotFoundError, match="absent.png"):
        readers.with_images(index, loaded, listed)
    with pytest.raises(Exception, match="broken.png is not an image"):
        readers.with_images(index.where("path <> 'absent.png'"), loaded, listed).collect()


def test_half_written_tables_are_computed_again(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(5).write.parquet(path)
    (tmp_path / "t" / "_SUCCESS").unlink()
    assert writers.load_or_compute(spark, path, lambda: spark.range(50)).count() == 50


def test_partitions_are_refreshed_and_taken_up_again(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = spark.range(40).select("id", (F.col("id") % 5).alias("day"), F.concat(F.lit("a b"), F.col("id") % 2).alias("part"), F.lit(0).alias("v"))
    writers.write_table(rows, path, by=["day", "part"])
    before = {str(p.relative_to(path)) for p in (tmp_path / "t").rglob("*.parquet")}
    calls = []

    def value(df):
        calls.append(sorted({(r["day"], r["part"]) for r in df.select("day", "part").distinct().collect()}))
        return F.when(F.lit(len(calls)) == 3, F.raise_error(F.lit("killed")).cast("bigint")).otherwise(F.col("id") * 10)

    with pytest.raises(Exception, match="killed"):
        writers.refresh_partitions(spark, path, "v", value, ["day", "part"], "r1", at_a_time=3)
    done = spark.read.parquet(path).where("v = id * 10 AND id > 0").count()
    assert 20 < done < 40 and spark.read.parquet(path).count() == 40
    kept = {str(p.relative_to(path)): p.stat().st_mtime_ns for p in (tmp_path / "t").rglob("*.parquet")}
    written = writers.refresh_partitions(spark, path, "v", value, ["day", "part"], "r1", at_a_time=3)
    assert len(written) == 4 and sum(map(len, calls)) == 10 + 3  # the job that was killed is the only one that runs again
    after = {str(p.relative_to(path)): p.stat().st_mtime_ns for p in (tmp_path / "t").rglob("*.parquet")}
    assert len({f.rsplit("/", 1)[0] for f, t in kept.items() if after.get(f) == t}) == 6 and not before & set(after)
    assert sorted((r["id"], r["v"]) for r in spark.read.parquet(path).collect()) == [(i, 10 * i) for i in range(40)]
    assert sorted(p.name for p in tmp_path.iterdir()) == ["t"]
    assert writers.refresh_partitions(spark, path, "v", lambda df: F.lit(1), ["day", "part"], "r2", only=lambda f: f.startswith("day=3")) == ["day=3/part=a b0", "day=3/part=a b1"]
    assert {r["day"] for r in spark.read.parquet(path).where("v = 1").collect()} == {3}


@pytest.mark.parametrize("cut", ["before", "between", "after"])
def test_a_swap_cut_short_is_finished(spark, tmp_path, cut):
    path, work = tmp_path / "t", tmp_path / "t.refresh-x"
    writers.write_table(spark.range(6).select("id", (F.col("id") % 2).alias("day"), F.lit(0).alias("v")), str(path), by=["day"])
    fresh = spark.read.parquet(str(path)).withColumn("v", F.lit(7)).where("day = 0")
    fresh.write.partitionBy("day").parquet(str(work / "new"))
    (work / "new" / "_jobs").mkdir()
    (work / "new" / "_jobs" / "day=0").touch()
    (work / "old").mkdir()
    if cut != "before":
        (path / "day=0").rename(work / "old" / "day=0")
    if cut == "after":
        (work / "new" / "day=0").rename(path / "day=0")
    written = writers.refresh_partitions(spark, str(path), "v", lambda df: F.lit(9), ["day"], "x")
    assert written == ["day=1"]  # the other was written before the cut
    assert sorted((r["id"], r["v"]) for r in spark.read.parquet(str(path)).collect()) == [(i, 9 if i % 2 else 7) for i in range(6)]
    assert not work.exists()


def test_equal_runs_are_all_kept(spark, tmp_path):
    header = "Model,Epochs,Filter_Size,Kernel_Size,Dense_Layer,Dropout,Train_Accuracy,Val_Accuracy,Test_Accuracy,Train_Time"
    line = 'Model HOG,5,"[6, 16]","[21, 5]","[120, 84]",0.5,99.0%,94.3%,94.9%, 53.88 '
    (tmp_path / "log.csv").write_text("\n".join([header, line, line, ",,,,,,,,,", header, line]) + "\n")
    assert readers.read_run_log(spark, str(tmp_path / "log.csv")).count() == 2


def test_banks_of_templates_change_nothing(spark):
    rng = np.random.default_rng(8)
    plane = lambda: [int(v) for v in rng.integers(0, 256, 16)]
    templates = spark.createDataFrame([(c, plane()) for c in (2, 0, 1, 0, 2, 1)], "class_id int, plane array<int>")
    rows = [(i, plane()) for i in (1, 1, 2)] + [(3, None)]
    df = spark.createDataFrame(rows, "image_id int, plane array<int>")
    whole = [tuple(r) for r in ops.plane_scores(df, templates).collect()]
    for size in (1, 300, 600):
        cut = ops.plane_scores(df, templates, max_bytes=size)
        assert sorted(map(repr, map(tuple, cut.collect()))) == sorted(map(repr, whole)) and cut.columns == ["image_id", "plane", "scores"]
    assert [len(r[2]) if r[2] else None for r in whole] == [6, 6, 6, None]
    assert [x["class_id"] for x in whole[0][2]] == [0, 0, 1, 1, 2, 2]
    images = lambda df: df.withColumn("image", ops.from_planes(F.col("plane"), F.col("plane"), F.col("plane"), 4, 4)).drop("plane")
    pictures, shown = images(df.where("plane IS NOT NULL")), images(templates)
    pattern = [r["template_pattern"] for r in ops.template_pattern(pictures, shown, margin=1).collect()]
    assert all(len(p) == 54 for p in pattern)
    for size in (1, 300, 600):
        assert sorted(r["template_pattern"] for r in ops.template_pattern(pictures, shown, margin=1, max_bytes=size).collect()) == sorted(pattern)
    one_class = templates.withColumn("class_id", F.lit(4))  # larger than a bank by itself
    assert sorted(map(repr, ops.plane_scores(df, one_class, max_bytes=130).collect())) == sorted(map(repr, ops.plane_scores(df, one_class).collect()))


def test_an_image_of_another_size_is_not_embedded(spark):
    with pytest.raises(Exception, match="has not 100 but 192 values"):
        ops.embed_images(tile_images(spark), lambda: lambda flat: flat, 100).collect()


def _small_images(n=3000):
    rng = np.random.default_rng(0)
    return ops.pack(list(rng.integers(0, 256, (n, 4, 4, 3), dtype=np.uint8)))


def _peak(column, images):
    """MB that NumPy and Python hold at most while the column of a batch is computed."""
    tracemalloc.start()
    try:
        column.func(images)
        return tracemalloc.get_traced_memory()[1] / 1e6
    finally:
        tracemalloc.stop()


def test_level_tables_are_held_for_few_images_at_a_time():
    images = _small_images()
    assert max(_peak(c, images) for c in (ops.clahe_value, ops.clahe_lightness)) < 60  # the tables of all: 393 MB


def test_level_tables_of_grey_planes_are_held_for_few_images_at_a_time():
    assert _peak(ops.clahe_plane, _small_images()) < 60


def test_enlarged_images_are_held_as_doubles_for_few_at_a_time():
    images = _small_images()
    assert max(_peak(c, images) for c in (ops.rescale(16), ops.resize(16, 16), ops.fit(16, 16))) < 28  # 9 MB leave


@pytest.mark.parametrize("name", ["rescale_network", "rescale_image", "embed_images"])
def test_an_image_is_computed_once_where_its_values_become_rows(spark, name):
    plan = QUERIES[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1


def test_histograms_are_counted_for_few_images_at_a_time(monkeypatch):
    counted, histograms = [], kernels.histograms
    monkeypatch.setattr(kernels, "histograms", lambda plane, bins: counted.append((len(plane), bins)) or histograms(plane, bins))
    images = _small_images()
    found = ops.hsv_histograms.func(images)
    assert max(8 * n * bins for n, bins in counted) <= ops.STACK_BYTES
    assert sum(n for n, bins in counted if bins == 180) == 3000
    assert [sum(h) for h in found.field("hue_hist").to_pylist()] == [16] * 3000
    counted.clear()
    ops.lbp().func(images)
    assert max(8 * n * bins for n, bins in counted) <= ops.STACK_BYTES


def test_vectors_keep_missing_and_empty_rows():
    rows = [np.array([[1, 2], [3, 4]]), None, np.array([], int), np.array([5])]
    assert ops.vectors(rows, pa.int32()).to_pylist() == [[1, 2, 3, 4], None, [], [5]]
    assert ops.vectors([None], pa.float32()).to_pylist() == [None]
    assert ops.vectors([], pa.float32()).to_pylist() == []
