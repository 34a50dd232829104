"""Queries on whole tables: columns, filters, joins, counts, samples, sorts, sets, scalars."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.functions import scalars
from tessera.operators import columns, cuts, experiments, groups, joins, middles, numbering, stats
from tessera.plans.base import (
    FAMILIES,
    IMAGES_SQL,
    KEY_SQL,
    PER_CLASS,
    RGB_SQL,
    SIDE,
    PIXELS_SQL,
    TILES_SQL,
    families,
    images,
    key,
    query,
    rgb,
    table,
    text_of,
    tiles,
)
from tessera.sources import checks, readers

# ---- columns and filters ---------------------------------------------------------------


@query(
    "select_rename_drop",
    "SELECT c_custkey AS image_id, c_nationkey AS class_id, c_name AS path FROM customer",
)
def select_rename_drop(spark, d):
    renamed = table(spark, d, "customer").withColumnsRenamed(
        {"c_custkey": "image_id", "c_nationkey": "class_id", "c_name": "path"}
    )
    return renamed.drop("c_acctbal", "c_mktsegment", "no_such_column")


@query(
    "computed_columns",
    """SELECT l_orderkey, l_linenumber, l_quantity * l_linenumber AS resolution,
              round(l_extendedprice + l_tax, 6) AS total_time,
              CAST(floor(l_discount * 255) AS INTEGER) AS byte_level FROM lineitem""",
)
def computed_columns(spark, d):
    rows = table(spark, d, "lineitem")
    return rows.select(
        "l_orderkey",
        "l_linenumber",
        columns.resolution("l_quantity", "l_linenumber").alias("resolution"),
        F.round(columns.total_time("l_extendedprice", "l_tax"), 6).alias("total_time"),
        scalars.to_byte(F.col("l_discount")).alias("byte_level"),
    )


@query(
    "struct_unnest",
    "SELECT p_partkey AS image_id, p_size AS width, p_size + 1 AS height, p_size * (p_size + 1) AS resolution FROM part",
)
def struct_unnest(spark, d):
    size = F.struct(F.col("p_size").alias("width"), (F.col("p_size") + 1).alias("height"))
    nested = table(spark, d, "part").select(F.col("p_partkey").alias("image_id"), size.alias("size"))
    return columns.unnest(nested, "size").withColumn("resolution", columns.resolution())


@query(
    "list_length",
    "SELECT doc_id, CAST(len(string_split(text, ' ')) AS INTEGER) AS feature_count FROM documents",
)
def list_length(spark, d):
    return table(spark, d, "documents").select("doc_id", F.size(F.split("text", " ")).alias("feature_count"))


@query("filter_class", "SELECT vec_id AS image_id, label AS class_id FROM embeddings WHERE label = 3")
def filter_class(spark, d):
    return images(spark, d).where(F.col("class_id") == 3).select("image_id", "class_id")


@query(
    "filter_metric",
    """SELECT l_orderkey, l_linenumber AS num_features, round(1 - l_discount, 6) AS accuracy FROM lineitem
       WHERE round(1 - l_discount, 6) > 0.95 AND l_linenumber = 1""",
)
def filter_metric(spark, d):
    """Runs with a single feature that are accurate enough."""
    good = (F.col("accuracy") > 0.95) & (F.col("num_features") == 1)
    return _runs(spark, d).where(good).select("l_orderkey", "num_features", "accuracy")


@query(
    "assemble_features",
    f"""WITH {TILES_SQL}
    SELECT image_id, 48 AS num_features, array_to_string(list_concat(plane[1:16], plane[17:32], plane[49:64]), ',') AS features
    FROM tiles""",
)
def assemble_features(spark, d):
    side = columns.assemble(["hog", "hue", "lbp"])
    return families(spark, d).select(
        "image_id", F.size(side).alias("num_features"), text_of(side).alias("features")
    )


@query(
    "flatten_column",
    f"""WITH {PIXELS_SQL}
    SELECT image_id, 64 AS width, round(sum(CAST(v AS DOUBLE) / 255), 6) AS level FROM px GROUP BY image_id""",
)
def flatten_column(spark, d):
    lines = F.transform(
        F.sequence(F.lit(0), F.lit(SIDE - 1)), lambda y: F.slice("plane", y * SIDE + 1, SIDE)
    )
    nested = tiles(spark, d).select("image_id", lines.alias("lbp_image"))
    flat = columns.feature_matrix(nested, ["lbp_image"])
    unit = scalars.scaled_down(F.col("lbp_image"))
    return flat.select(
        "image_id", F.size("lbp_image").alias("width"), F.round(scalars.total(unit), 6).alias("level")
    )


@query("chunk_ids", "SELECT o_orderkey, CAST(o_orderkey // 1000 AS BIGINT) AS chunk FROM orders")
def chunk_ids(spark, d):
    return table(spark, d, "orders").select("o_orderkey", columns.chunk_of(F.col("o_orderkey"), 1000).alias("chunk"))


@query(
    "row_ids",
    """SELECT l_orderkey, l_linenumber, l_shipdate, row_id, row_id // 1000 AS chunk FROM (
         SELECT l_orderkey, l_linenumber, CAST(l_shipdate AS VARCHAR) AS l_shipdate,
                row_number() OVER (ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_shipdate) - 1 AS row_id FROM lineitem)""",
)
def row_ids(spark, d):
    """Lines numbered through, and the chunk of 1000 that each lies in."""
    lines = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", F.col("l_shipdate").cast("string"), "l_partkey", "l_suppkey", "l_extendedprice")
    order = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_shipdate"]
    return numbering.row_chunks(lines, 1000, order).drop("l_partkey", "l_suppkey", "l_extendedprice")


@query(
    "running_characters",
    """SELECT doc_id, CAST(sum(n_chars) OVER (ORDER BY doc_id) AS BIGINT) AS up_to, CAST(sum(n_chars) OVER (PARTITION BY source ORDER BY doc_id) AS BIGINT) AS in_source,
              row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1 AS place FROM documents""",
)
def running_characters(spark, d):
    """Characters up to each document, in all and in its source, and its place there."""
    docs = table(spark, d, "documents").select("doc_id", "source", F.col("n_chars").cast("bigint").alias("n_chars"))
    summed = numbering.running_sum(numbering.running_sum(docs, "n_chars", ["doc_id"], out="up_to"), "n_chars", ["doc_id"], ["source"], "in_source")
    return numbering.numbered(summed, ["doc_id"], ["source"], "place").drop("source", "n_chars")


@query(
    "positional_zip",
    """WITH a AS (SELECT doc_id, row_number() OVER (ORDER BY doc_id) AS place FROM documents),
            b AS (SELECT doc_id AS ranked_doc, n_chars, row_number() OVER (ORDER BY n_chars, doc_id) AS place FROM documents)
       SELECT doc_id, ranked_doc, n_chars FROM a JOIN b USING (place)""",
)
def positional_zip(spark, d):
    """Two frames side by side by place: documents by id, and by length."""
    docs = table(spark, d, "documents")
    ranked = docs.select(F.col("doc_id").alias("ranked_doc"), "n_chars")
    return numbering.zip_rows(docs.select("doc_id"), ranked, ["doc_id"], ["n_chars", "ranked_doc"])


# ---- joins -----------------------------------------------------------------------------


@query(
    "join_meta",
    """SELECT c_custkey AS image_id, n_nationkey AS class_id, c_name AS path, n_name AS meta_path
       FROM customer JOIN nation ON c_nationkey = n_nationkey""",
)
def join_meta(spark, d):
    left = table(spark, d, "customer").select(
        F.col("c_custkey").alias("image_id"), F.col("c_nationkey").alias("class_id"), F.col("c_name").alias("path")
    )
    meta = table(spark, d, "nation").select(F.col("n_nationkey").alias("class_id"), F.col("n_name").alias("path"))
    return joins.join_meta(left, meta).select("image_id", "class_id", "path", "meta_path")


@query(
    "join_lookups",
    """SELECT s_suppkey AS image_id, n_name AS shape, r_name AS color
       FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON r_regionkey = s_suppkey % 5""",
)
def join_lookups(spark, d):
    meta = table(spark, d, "supplier").select(
        F.col("s_suppkey").alias("image_id"),
        F.col("s_nationkey").alias("shape_id"),
        (F.col("s_suppkey") % 5).cast("int").alias("color_id"),
    )
    shapes = table(spark, d, "nation").select(F.col("n_nationkey").alias("id"), F.col("n_name").alias("description"))
    colors = table(spark, d, "region").select(F.col("r_regionkey").alias("id"), F.col("r_name").alias("description"))
    return joins.join_lookups(meta, shapes, colors).select("image_id", "shape", "color")


@query(
    "join_embeddings",
    "SELECT doc_id AS image_id, lang, n_chars, quality, toxic FROM documents JOIN labels USING (doc_id)",
)
def join_embeddings(spark, d):
    base = table(spark, d, "documents").select(F.col("doc_id").alias("image_id"), "lang", "n_chars")
    side = table(spark, d, "labels").select(F.col("doc_id").alias("image_id"), "quality", "toxic")
    return joins.attach(base, side)


# ---- counts and profiles -----------------------------------------------------------------

HASH_SPLIT_SQL = f"CASE WHEN substr({KEY_SQL}, 1, 8) < 'cccccccc' THEN 'train' ELSE 'test' END"


def _with_split(spark, d):
    return images(spark, d).withColumn("split", cuts.split_hashed(key(), 0.8))


@query(
    "class_counts",
    """WITH c AS (SELECT CAST(i AS INTEGER) AS class_id, CAST(count(vec_id) AS BIGINT) AS n
                  FROM (SELECT i FROM range(12) r(i) UNION SELECT label FROM embeddings) LEFT JOIN embeddings ON label = i GROUP BY 1)
       SELECT class_id, n, round(n / max(n) OVER (), 6) AS ratio FROM c""",
)
def class_counts(spark, d):
    return stats.class_counts(images(spark, d), 12).withColumn("ratio", F.round("ratio", 6))


@query(
    "split_distribution",
    f"""WITH {IMAGES_SQL}, s AS (SELECT class_id, {HASH_SPLIT_SQL} AS split FROM images)
    SELECT class_id, CAST(count(*) FILTER (split = 'train') AS BIGINT) AS train,
           CAST(count(*) FILTER (split = 'test') AS BIGINT) AS test FROM s GROUP BY class_id""",
)
def split_distribution(spark, d):
    return stats.split_distribution(_with_split(spark, d), ["train", "test"])


@query(
    "split_counts",
    f"""WITH {IMAGES_SQL} SELECT {HASH_SPLIT_SQL} AS split, CAST(count(*) AS BIGINT) AS n FROM images GROUP BY 1""",
)
def split_counts(spark, d):
    return _with_split(spark, d).groupBy("split").agg(F.count("*").alias("n"))


SIZES_SQL = """sizes AS (SELECT l_quantity AS width, CAST(l_linenumber AS DOUBLE) AS height,
  l_quantity * l_linenumber AS resolution FROM lineitem)"""


def _sizes(spark, d):
    rows = table(spark, d, "lineitem").select(
        F.col("l_quantity").alias("width"), F.col("l_linenumber").cast("double").alias("height")
    )
    return rows.withColumn("resolution", columns.resolution())


@query(
    "min_max",
    f"""WITH {SIZES_SQL} SELECT min(width) AS min_width, max(width) AS max_width, min(height) AS min_height,
    max(height) AS max_height, min(resolution) AS min_resolution, max(resolution) AS max_resolution,
    (SELECT height FROM sizes ORDER BY width, height LIMIT 1) AS height_of_smallest FROM sizes""",
)
def min_max(spark, d):
    smallest = F.min(F.struct("width", "height"))["height"].alias("height_of_smallest")
    names = ["width", "height", "resolution"]
    ends = [f(n).alias(f"{label}_{n}") for n in names for label, f in (("min", F.min), ("max", F.max))]
    return _sizes(spark, d).agg(*ends, smallest)


@query(
    "mean_median",
    f"""WITH {SIZES_SQL}, long AS (
      SELECT 'width' AS name, width AS v FROM sizes UNION ALL SELECT 'height', height FROM sizes
      UNION ALL SELECT 'resolution', resolution FROM sizes)
    SELECT name, round(avg(v), 6) AS mean, round(median(v), 6) AS median FROM long GROUP BY name""",
)
def mean_median(spark, d):
    found = stats.mean_median(_sizes(spark, d), ["width", "height", "resolution"])
    return found.select("name", F.round("mean", 6).alias("mean"), F.round("median", 6).alias("median"))


@query(
    "distinct_classes",
    """SELECT array_to_string(list_sort(list(DISTINCT label)), ',') AS classes, CAST(count(DISTINCT label) AS BIGINT) AS n_classes
       FROM embeddings""",
)
def distinct_classes(spark, d):
    return stats.distinct_classes(images(spark, d)).withColumn("classes", text_of(F.col("classes")))


@query(
    "duplicate_rows",
    "SELECT CAST(coalesce(sum(n), 0) AS BIGINT) AS duplicates FROM (SELECT count(*) AS n FROM documents GROUP BY text) WHERE n > 1",
)
def duplicate_rows(spark, d):
    return groups.duplicate_rows(table(spark, d, "documents"), groups.fingerprint(F.col("text")))


@query(
    "duplicate_flags",
    "SELECT doc_id, count(*) OVER (PARTITION BY text) > 1 AS is_duplicate FROM documents",
)
def duplicate_flags(spark, d):
    flagged = groups.flag_duplicates(
        table(spark, d, "documents").select("doc_id", groups.fingerprint(F.col("text")).alias("print")), F.col("print")
    )
    return flagged.select("doc_id", "is_duplicate")


@query(
    "pixel_histogram",
    f"WITH {PIXELS_SQL} SELECT class_id, v AS bin, CAST(count(*) AS BIGINT) AS n FROM px GROUP BY 1, 2",
)
def pixel_histogram(spark, d):
    return stats.value_histogram(tiles(spark, d), "plane", ["class_id"])


@query(
    "equal_width_histogram",
    """WITH v AS (SELECT CASE WHEN pos < 16 THEN 'red' WHEN pos < 32 THEN 'green' ELSE 'blue' END AS channel, CAST(x AS DOUBLE) AS x
      FROM (SELECT unnest(embedding) AS x, generate_subscripts(embedding, 1) - 1 AS pos FROM embeddings)),
    e AS (SELECT channel, min(x) AS lo, max(x) AS hi FROM v GROUP BY channel)
    SELECT channel, CAST(least(255, floor((x - lo) / (hi - lo) * 256)) AS INTEGER) AS bin, CAST(count(*) AS BIGINT) AS n
    FROM v JOIN e USING (channel) GROUP BY 1, 2""",
)
def equal_width_histogram(spark, d):
    """The vector in three parts of 16, 16 and 32 values."""
    parts = {n: F.slice("embedding", 1 + 16 * i, 16 if i < 2 else 32) for i, n in enumerate(("red", "green", "blue"))}
    return stats.equal_width_histogram(images(spark, d), parts)


@query(
    "intensity_cdf",
    f"""WITH {PIXELS_SQL}, h AS (SELECT class_id, v AS bin, CAST(count(*) AS BIGINT) AS n FROM px GROUP BY 1, 2)
    SELECT class_id, bin, n, CAST(sum(n) OVER (PARTITION BY class_id ORDER BY bin) AS DOUBLE)
      / CAST(sum(n) OVER (PARTITION BY class_id) AS DOUBLE) AS cdf FROM h""",
)
def intensity_cdf(spark, d):
    return stats.intensity_cdf(tiles(spark, d), "plane", ["class_id"])


@query(
    "mean_colour_image",
    f"""WITH {RGB_SQL} SELECT image_id, round(avg(r), 6) AS mean_r, round(avg(g), 6) AS mean_g, round(avg(b), 6) AS mean_b
    FROM rgbpx GROUP BY image_id""",
)
def mean_colour_image(spark, d):
    found = stats.mean_colour(rgb(spark, d), {n: F.col(n) for n in "rgb"}, "image_id")
    return found.select("image_id", *[F.round(f"mean_{n}", 6).alias(f"mean_{n}") for n in "rgb"])


@query(
    "mean_colour_class",
    f"""WITH {RGB_SQL} SELECT class_id, round(avg(r), 6) AS mean_r, round(avg(g), 6) AS mean_g, round(avg(b), 6) AS mean_b
    FROM rgbpx GROUP BY class_id""",
)
def mean_colour_class(spark, d):
    found = stats.mean_colour_by_class(rgb(spark, d), {n: F.col(n) for n in "rgb"})
    return found.select("class_id", *[F.round(f"mean_{n}", 6).alias(f"mean_{n}") for n in "rgb"])


@query(
    "median_vector_class",
    """SELECT label AS class_id, CAST(pos AS INTEGER) AS pos, round(median(CAST(x AS DOUBLE)), 6) AS median
    FROM (SELECT label, unnest(embedding) AS x, generate_subscripts(embedding, 1) - 1 AS pos FROM embeddings) GROUP BY 1, 2""",
)
def median_vector_class(spark, d):
    return middles.median_vectors(images(spark, d), "embedding").withColumn("median", F.round("median", 6))


@query(
    "matrix_min_max",
    """SELECT round(min(x), 6) AS smallest, round(max(x), 6) AS largest
    FROM (SELECT CAST(unnest(embedding) AS DOUBLE) AS x FROM embeddings)""",
)
def matrix_min_max(spark, d):
    found = stats.matrix_extremes(images(spark, d), "embedding")
    return found.select(*[F.round(F.col(c).cast("double"), 6).alias(c) for c in ("smallest", "largest")])


@query(
    "feature_widths",
    """SELECT unnest(['lbp', 'hue', 'template', 'hog']) AS feature, CAST(max(len(embedding)) // 4 AS INTEGER) AS width FROM embeddings""",
)
def feature_widths(spark, d):
    return stats.feature_widths(families(spark, d), FAMILIES)


@query(
    "standardise",
    """WITH v AS (SELECT vec_id, CAST(unnest(embedding) AS DOUBLE) AS x, generate_subscripts(embedding, 1) - 1 AS pos FROM embeddings),
    m AS (SELECT pos, avg(x) AS mean, stddev_pop(x) AS spread FROM v GROUP BY pos)
    SELECT vec_id AS image_id, CAST(pos AS INTEGER) AS pos, round(CASE WHEN spread > 0 THEN (x - mean) / spread ELSE 0 END, 6) AS z
    FROM v JOIN m USING (pos)""",
)
def standardise(spark, d):
    scaled = stats.standardise(images(spark, d), "embedding")
    return scaled.select("image_id", F.posexplode("standardised").alias("pos", "z")).withColumn("z", F.round("z", 6))


# ---- samples, splits, windows ---------------------------------------------------------------

RANKED_SQL = f"""{IMAGES_SQL}, ranked AS (
  SELECT image_id, class_id, row_number() OVER (PARTITION BY class_id ORDER BY {KEY_SQL}) AS rn FROM images)"""
ORDERED_SQL = f"""{IMAGES_SQL}, ordered AS (
  SELECT image_id, class_id, row_number() OVER (ORDER BY {KEY_SQL}) AS rn, count(*) OVER () AS total FROM images)"""


@query("rank_in_class", f"WITH {RANKED_SQL} SELECT image_id, class_id FROM ranked WHERE rn <= 50")
def rank_in_class(spark, d):
    return cuts.sample_per_class(images(spark, d), 50, ["class_id"], key()).select("image_id", "class_id")


@query("balanced_sample", f"WITH {RANKED_SQL} SELECT image_id, class_id FROM ranked WHERE rn <= {PER_CLASS}")
def balanced_sample(spark, d):
    return cuts.balanced_sample(images(spark, d), PER_CLASS, ["class_id"], key()).select("image_id", "class_id")


@query("first_per_class", "SELECT min(vec_id) AS image_id, label AS class_id FROM embeddings GROUP BY label")
def first_per_class(spark, d):
    return groups.first_per_class(images(spark, d), "class_id", "image_id").select("image_id", "class_id")


@query("random_per_class", f"WITH {RANKED_SQL} SELECT image_id, class_id FROM ranked WHERE rn = 1")
def random_per_class(spark, d):
    return groups.random_per_class(images(spark, d), "class_id", key()).select("image_id", "class_id")


@query("global_sample", f"WITH {ORDERED_SQL} SELECT image_id, class_id FROM ordered WHERE rn <= 200")
def global_sample(spark, d):
    return cuts.sample_rows(images(spark, d), 200, key()).select("image_id", "class_id")


@query(
    "exact_split",
    f"""WITH {ORDERED_SQL} SELECT image_id, class_id,
    CASE WHEN rn <= floor(total * 0.8) THEN 'train' ELSE 'validation' END AS part FROM ordered""",
)
def exact_split(spark, d):
    return cuts.split_exact(images(spark, d), 0.8, key()).select("image_id", "class_id", "part")


@query("hash_split", f"WITH {IMAGES_SQL} SELECT image_id, {HASH_SPLIT_SQL} AS split FROM images")
def hash_split(spark, d):
    return _with_split(spark, d).select("image_id", "split")


@query(
    "tail_split",
    """SELECT o_orderkey, CASE WHEN row_number() OVER (ORDER BY o_orderkey) <= floor(count(*) OVER () * 0.9)
    THEN 'train' ELSE 'validation' END AS part FROM orders""",
)
def tail_split(spark, d):
    return cuts.split_tail(table(spark, d, "orders").select("o_orderkey"), 0.9, "o_orderkey")


@query(
    "fold_ids",
    f"""WITH {IMAGES_SQL} SELECT image_id, CAST(CAST('0x' || substr({KEY_SQL}, 1, 8) AS BIGINT) % 5 AS INTEGER) AS fold FROM images""",
)
def fold_ids(spark, d):
    return images(spark, d).select("image_id", cuts.fold_of(key(), 5).alias("fold"))


# ---- sorts and sets ---------------------------------------------------------------------------


@query("sort_meta", "SELECT n_nationkey, n_name FROM nation ORDER BY n_nationkey")
def sort_meta(spark, d):
    return table(spark, d, "nation").select("n_nationkey", "n_name").orderBy("n_nationkey")


@query("full_shuffle", f"WITH {IMAGES_SQL} SELECT image_id, class_id FROM images ORDER BY {KEY_SQL}")
def full_shuffle(spark, d):
    return cuts.shuffle_rows(images(spark, d).select("image_id", "class_id"), key())


@query(
    "slice_rows",
    """WITH o AS (SELECT o_orderkey, row_number() OVER (ORDER BY md5(CAST(o_orderkey AS VARCHAR) || '-42')) AS rn FROM orders)
    SELECT o_orderkey FROM o WHERE rn BETWEEN 101 AND 150""",
)
def slice_rows(spark, d):
    rows = table(spark, d, "orders").select("o_orderkey")
    return cuts.rows_between(rows, cuts.sample_key(F.col("o_orderkey")), 100, 50)


RUNS_SQL = """runs AS (SELECT l_linenumber AS num_features, l_orderkey, l_extendedprice AS train_time,
  l_tax AS predict_time, round(1 - l_discount, 6) AS accuracy, round(l_extendedprice + l_tax, 6) AS total_time FROM lineitem)"""


def _runs(spark, d):
    rows = table(spark, d, "lineitem").select(
        F.col("l_linenumber").alias("num_features"),
        "l_orderkey",
        F.col("l_extendedprice").alias("train_time"),
        F.col("l_tax").alias("predict_time"),
        F.round(1 - F.col("l_discount"), 6).alias("accuracy"),
    )
    return rows.withColumn("total_time", F.round(columns.total_time(), 6))


@query(
    "most_accurate",
    f"""WITH {RUNS_SQL} SELECT num_features, train_time, predict_time, total_time, accuracy FROM runs
    ORDER BY accuracy DESC, total_time DESC, num_features, predict_time LIMIT 5""",
)
def most_accurate(spark, d):
    return experiments.most_accurate(_runs(spark, d), 5, ["num_features", "predict_time"]).drop("l_orderkey")


@query(
    "most_efficient",
    f"""WITH {RUNS_SQL} SELECT num_features, train_time, predict_time, total_time, accuracy FROM runs
    WHERE accuracy > 0.95 ORDER BY num_features, total_time, accuracy, predict_time LIMIT 5""",
)
def most_efficient(spark, d):
    return experiments.most_efficient(_runs(spark, d), 0.95, 5, ["accuracy", "predict_time"]).drop("l_orderkey")


@query(
    "best_last_epoch",
    """SELECT user_id AS model, round(max(value), 6) AS best_accuracy, round(arg_max(value, event_id), 6) AS last_accuracy
    FROM events GROUP BY user_id""",
)
def best_last_epoch(spark, d):
    history = table(spark, d, "events").select(
        F.col("user_id").alias("model"), F.col("event_id").alias("epoch"), F.col("value").alias("accuracy")
    )
    found = experiments.best_and_last(history, ["model"])
    return found.select(
        "model", *[F.round(c, 6).alias(c) for c in ("best_accuracy", "last_accuracy")]
    )


@query(
    "union_runs",
    """SELECT 'customer' AS source, c_custkey AS id, round(c_acctbal, 6) AS balance FROM customer
    UNION ALL SELECT 'supplier', s_suppkey, round(s_acctbal, 6) FROM supplier""",
)
def union_runs(spark, d):
    frames = [
        table(spark, d, name).select(
            F.lit(name).alias("source"),
            F.col(f"{p}_{k}").alias("id"),
            F.round(f"{p}_acctbal", 6).alias("balance"),
        )
        for name, p, k in (("customer", "c", "custkey"), ("supplier", "s", "suppkey"))
    ]
    return columns.union_all(frames)


@query("distinct_by_key", "SELECT min(doc_id) AS doc_id FROM documents GROUP BY text")
def distinct_by_key(spark, d):
    rows = table(spark, d, "documents").select("doc_id", groups.fingerprint(F.col("text")).alias("print"))
    return groups.distinct_by(rows, F.col("print"), "doc_id").select("doc_id")


# ---- scalar functions ---------------------------------------------------------------------------


@query(
    "text_functions",
    """SELECT p_partkey, array_to_string(string_split(p_name, ' '), '-') AS joined,
    upper(substr(p_name, 1, 1)) || lower(substr(p_name, 2)) AS capitalised, 'Class ' || p_size AS class_text,
    printf('%.2f%%', p_size / 50.0 * 100) AS percent,
    '/data/' || p_brand || '.png' AS path FROM part""",
)
def text_functions(spark, d):
    return table(spark, d, "part").select(
        "p_partkey",
        scalars.joined(F.split("p_name", " ")).alias("joined"),
        scalars.capitalised(F.col("p_name")).alias("capitalised"),
        scalars.class_text(F.col("p_size")).alias("class_text"),
        scalars.percent_text(F.col("p_size") / 50.0).alias("percent"),
        readers.absolute_path(F.concat("p_brand", F.lit(".png")), "/data").alias("path"),
    )


@query(
    "duration_text",
    """WITH s AS (SELECT c_custkey, CAST(round(abs(c_acctbal) * 1000000) AS BIGINT) AS micros FROM customer),
    p AS (SELECT *, micros // 1000000 AS whole, micros % 1000000 AS rest FROM s),
    q AS (SELECT *, (whole // 3600) || ':' || lpad(CAST(whole % 3600 // 60 AS VARCHAR), 2, '0') || ':' || lpad(CAST(whole % 60 AS VARCHAR), 2, '0') AS t FROM p)
    SELECT c_custkey, t AS elapsed, CASE WHEN rest > 0 THEN (whole % 10) || '.' || lpad(CAST(rest AS VARCHAR), 6, '0') ELSE t END AS short FROM q""",
)
def duration_text(spark, d):
    seconds = F.abs("c_acctbal")
    return table(spark, d, "customer").select(
        "c_custkey", scalars.duration(seconds).alias("elapsed"), scalars.duration(seconds, mili=True).alias("short")
    )


@query(
    "math_functions",
    """SELECT l_orderkey, l_linenumber, round(sqrt(l_quantity), 6) AS root, round(exp(-l_discount), 6) AS decay,
    round(sqrt(l_quantity * l_quantity + l_linenumber * l_linenumber), 6) AS reach,
    round(atan2(l_linenumber, l_quantity), 6) AS angle, round(abs(l_tax - l_discount), 6) AS gap,
    CAST(l_orderkey // 7 AS BIGINT) AS div7, CAST(l_orderkey % 7 AS BIGINT) AS mod7 FROM lineitem""",
)
def math_functions(spark, d):
    wide, high = F.col("l_quantity"), F.col("l_linenumber")
    six = lambda c, name: F.round(c, 6).alias(name)
    return table(spark, d, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        six(F.sqrt(wide), "root"),
        six(F.exp(-F.col("l_discount")), "decay"),
        six(F.hypot(wide, high), "reach"),
        six(F.atan2(high, wide), "angle"),
        six(F.abs(F.col("l_tax") - F.col("l_discount")), "gap"),
        F.floor(F.col("l_orderkey") / 7).alias("div7"),
        (F.col("l_orderkey") % 7).alias("mod7"),
    )


@query(
    "interpolate",
    """SELECT l_orderkey, l_linenumber, round(CASE WHEN l_quantity >= 40 THEN 255 WHEN l_quantity <= 10 THEN 0
    ELSE 255.0 / 30 * (l_quantity - 10) END, 6) AS level FROM lineitem""",
)
def interpolate(spark, d):
    level = scalars.interpolate(F.col("l_quantity"), F.lit(10.0), F.lit(40.0), 0, 255)
    return table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", F.round(level, 6).alias("level"))


@query(
    "index_unravel",
    f"WITH {PIXELS_SQL} SELECT image_id, y AS row, x AS col, v FROM grid",
)
def index_unravel(spark, d):
    pixels = tiles(spark, d).select("image_id", F.posexplode("plane").alias("pos", "v"))
    row, col = scalars.unravel(F.col("pos"), SIDE)
    return pixels.select("image_id", row.alias("row"), col.alias("col"), "v")


@query(
    "subsets",
    """WITH m AS (SELECT i AS mask FROM range(1, 16) r(i)),
    s AS (SELECT concat_ws('-', CASE WHEN mask & 1 > 0 THEN 'lbp' END, CASE WHEN mask & 2 > 0 THEN 'hue' END,
      CASE WHEN mask & 4 > 0 THEN 'template' END, CASE WHEN mask & 8 > 0 THEN 'hog' END) AS features,
      bit_count(mask) AS parts FROM m)
    SELECT features, CAST(max(parts * (len(embedding) // 4)) AS INTEGER) AS num_features, CAST(count(*) AS BIGINT) AS images
    FROM embeddings, s GROUP BY features""",
)
def subsets(spark, d):
    """Width of every feature subset and the number of images that have it."""
    wide = families(spark, d).select(*[F.size(n).alias(n) for n in FAMILIES])
    each = wide.select(*FAMILIES, F.explode(scalars.subsets(FAMILIES)).alias("chosen"))
    width = sum(F.when(F.array_contains("chosen", n), F.col(n)).otherwise(0) for n in FAMILIES)
    return each.groupBy(scalars.joined(F.col("chosen")).alias("features")).agg(
        F.max(width).alias("num_features"), F.count("*").alias("images")
    )


@query(
    "filename_counts",
    r"""SELECT CAST(sum(TRY_CAST(nullif(regexp_extract(url, '/([0-9]+)', 1), '') AS BIGINT)) AS BIGINT) AS items FROM pages""",
)
def filename_counts(spark, d):
    return checks.count_items(table(spark, d, "pages"), "url", r"/([0-9]+)")


@query(
    "missing_inputs",
    """SELECT 'train/' || CAST(i AS VARCHAR) AS name FROM range(43) r(i)
    WHERE 'train/' || CAST(i AS VARCHAR) NOT IN (SELECT 'train/' || CAST(label AS VARCHAR) FROM embeddings)""",
)
def missing_inputs(spark, d):
    found = images(spark, d).select(F.concat(F.lit("train/"), F.col("class_id").cast("string")).alias("name"))
    return checks.missing(found, checks.expected_names([], "train", 43, spark))
