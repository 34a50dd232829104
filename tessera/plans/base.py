"""Query registry, table loading and the frames and SQL fragments several queries share.

The embedding vectors stand in for images: 64 floats become an 8x8 grey tile, and
slices of 16 become 4x4 colour planes or feature families.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions import planes
from tessera.operators import cuts, groups, joins
from tessera.operators import images as image_ops
from tessera.session import settle

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

CLASSES = 10
SIDE = 8
PER_CLASS = 40
FAMILIES = ["lbp", "hue", "template", "hog"]


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def add(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql:
            ORACLES[name] = sql
        return fn

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def key() -> Column:
    return cuts.sample_key(F.col("image_id"))


def images(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("image_id"), F.col("label").alias("class_id"), "embedding"
    )


def tiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return images(spark, sf_dir).select(
        "image_id", "class_id", planes.from_unit(F.col("embedding")).alias("plane")
    )


def rgb(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four 4x4 colour images per vector, each from three quarters in turn, so that all values are read."""
    part = lambda i, n: F.slice("plane", 1 + 16 * (i % 4), 16).alias(n)
    quarters = [F.struct(F.lit(i).alias("i"), *[part(i + k, n) for k, n in enumerate("rgb")]) for i in range(4)]
    cut = tiles(spark, sf_dir).select("image_id", "class_id", F.explode(F.array(*quarters)).alias("q"))
    return cut.select((F.col("image_id") * 4 + F.col("q.i")).alias("image_id"), "class_id", "q.r", "q.g", "q.b")


def families(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = [F.slice("plane", 1 + 16 * i, 16).alias(n) for i, n in enumerate(FAMILIES)]
    return tiles(spark, sf_dir).select("image_id", "class_id", *parts)


def templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The tile with the lowest id of each class."""
    return groups.first_per_class(tiles(spark, sf_dir), "class_id", "image_id")


def predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Class of the best matching template for every image."""
    scored = image_ops.plane_scores(tiles(spark, sf_dir), templates(spark, sf_dir))
    return scored.select(
        "image_id", F.col("class_id").alias("actual"), joins.best_template(F.col("scores")).alias("predicted")
    )


def family_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same per feature family: one row per family and image."""
    wide = families(spark, sf_dir)
    chosen = settle(groups.first_per_class(wide, "class_id", "image_id"))
    scored = wide
    for name in FAMILIES:
        own = chosen.select("class_id", F.col(name).alias("plane"))
        scored = image_ops.plane_scores(scored, own, plane=name).withColumnRenamed("scores", f"by_{name}")
    cells = F.array(
        *[
            F.struct(F.lit(n).alias("family"), joins.best_template(F.col(f"by_{n}")).alias("predicted"))
            for n in FAMILIES
        ]
    )
    return scored.select("image_id", F.col("class_id").alias("actual"), F.explode(cells).alias("f")).select(
        "f.family", "image_id", "actual", "f.predicted"
    )


def text_of(values: Column) -> Column:
    """Whole numbers of an array as one comma-separated text, so that results compare as text."""
    return F.array_join(F.transform(values, lambda x: x.cast("bigint").cast("string")), ",")


def thousandths(values: Column) -> Column:
    """Floats in units of 0.0001, rounded, as text."""
    return text_of(F.transform(values, lambda x: F.floor(x.cast("double") * 10000 + 0.5)))


# ---- SQL fragments -------------------------------------------------------------------

KEY_SQL = "md5(CAST(image_id AS VARCHAR) || '-42')"

IMAGES_SQL = "images AS (SELECT vec_id AS image_id, label AS class_id, embedding FROM embeddings)"

TILES_SQL = """tiles AS (
  SELECT vec_id AS image_id, label AS class_id,
         list_transform(embedding, lambda x: CAST(least(255, greatest(0, floor((CAST(x AS DOUBLE) + 1) * 127.5))) AS INTEGER)) AS plane
  FROM embeddings)"""

PIXELS_SQL = (
    TILES_SQL
    + """, px AS (
  SELECT image_id, class_id, unnest(plane) AS v, CAST(generate_subscripts(plane, 1) - 1 AS INTEGER) AS pos FROM tiles),
grid AS (SELECT image_id, class_id, pos, CAST(pos // 8 AS INTEGER) AS y, CAST(pos % 8 AS INTEGER) AS x, v FROM px)"""
)

# 4x4 colour pixels: pos 0..15 with r, g, b side by side; four images per vector
RGB_SQL = (
    PIXELS_SQL
    + """, rgbpx AS (
  SELECT r.image_id * 4 + r.pos // 16 AS image_id, r.class_id, CAST(r.pos % 16 AS INTEGER) AS pos, r.v AS r, g.v AS g, b.v AS b
  FROM px r JOIN px g ON g.image_id = r.image_id AND g.pos = (r.pos + 16) % 64
            JOIN px b ON b.image_id = r.image_id AND b.pos = (r.pos + 32) % 64)"""
)

SCORE_SQL = """CASE WHEN sqrt(CAST(n * xx - x * x AS DOUBLE)) * sqrt(CAST(n * yy - y * y AS DOUBLE)) > 0
       THEN CAST(n * xy - x * y AS DOUBLE) / (sqrt(CAST(n * xx - x * x AS DOUBLE)) * sqrt(CAST(n * yy - y * y AS DOUBLE)))
       ELSE 0 END"""

PREDICTIONS_SQL = (
    PIXELS_SQL
    + f""", firsts AS (SELECT min(vec_id) AS image_id FROM embeddings GROUP BY label),
t AS (SELECT class_id AS template_class, pos, v AS tv FROM px WHERE image_id IN (SELECT image_id FROM firsts)),
sums AS (
  SELECT image_id, class_id AS actual, template_class, CAST(count(*) AS BIGINT) AS n, CAST(sum(v) AS BIGINT) AS x,
         CAST(sum(tv) AS BIGINT) AS y, CAST(sum(v * v) AS BIGINT) AS xx, CAST(sum(tv * tv) AS BIGINT) AS yy,
         CAST(sum(v * tv) AS BIGINT) AS xy
  FROM px JOIN t USING (pos) GROUP BY image_id, class_id, template_class),
scores AS (SELECT image_id, actual, template_class, round({SCORE_SQL}, 9) AS score FROM sums),
preds AS (
  SELECT image_id, actual, template_class AS predicted FROM scores
  QUALIFY row_number() OVER (PARTITION BY image_id ORDER BY score DESC, template_class) = 1)"""
)

FAMILY_SQL = (
    PIXELS_SQL
    + f""", fam AS (
  SELECT CASE pos // 16 WHEN 0 THEN 'lbp' WHEN 1 THEN 'hue' WHEN 2 THEN 'template' ELSE 'hog' END AS family,
         image_id, class_id, pos, v FROM px),
firsts AS (SELECT min(vec_id) AS image_id FROM embeddings GROUP BY label),
t AS (SELECT class_id AS template_class, pos, v AS tv FROM px WHERE image_id IN (SELECT image_id FROM firsts)),
sums AS (
  SELECT family, image_id, class_id AS actual, template_class, CAST(count(*) AS BIGINT) AS n, CAST(sum(v) AS BIGINT) AS x,
         CAST(sum(tv) AS BIGINT) AS y, CAST(sum(v * v) AS BIGINT) AS xx, CAST(sum(tv * tv) AS BIGINT) AS yy,
         CAST(sum(v * tv) AS BIGINT) AS xy
  FROM fam JOIN t USING (pos) GROUP BY family, image_id, class_id, template_class),
scores AS (SELECT family, image_id, actual, template_class, round({SCORE_SQL}, 9) AS score FROM sums),
fpreds AS (
  SELECT family, image_id, actual, template_class AS predicted FROM scores
  QUALIFY row_number() OVER (PARTITION BY family, image_id ORDER BY score DESC, template_class) = 1)"""
)

# Dense 10 x 10 confusion counts from a relation named preds
CONFUSION_SQL = """found AS (SELECT CAST(i AS INTEGER) AS label FROM range(10) r(i) UNION SELECT actual FROM preds UNION SELECT predicted FROM preds),
grid2 AS (SELECT a.label AS actual, p.label AS predicted FROM found a CROSS JOIN found p),
cm AS (
  SELECT g.actual, g.predicted, CAST(count(p.image_id) AS BIGINT) AS n
  FROM grid2 g LEFT JOIN preds p ON p.actual = g.actual AND p.predicted = g.predicted GROUP BY 1, 2)"""

PER_CLASS_SQL = """per_class AS (
  SELECT class_id, support, hits,
         CASE WHEN claimed = 0 THEN 0 ELSE hits / claimed END AS p,
         CASE WHEN support = 0 THEN 0 ELSE hits / support END AS r,
         CASE WHEN claimed + support = 0 THEN 0 ELSE 2 * hits / (claimed + support) END AS f
  FROM (SELECT c.class_id,
               (SELECT CAST(sum(n) AS DOUBLE) FROM cm WHERE actual = c.class_id) AS support,
               (SELECT CAST(sum(n) AS DOUBLE) FROM cm WHERE predicted = c.class_id) AS claimed,
               (SELECT CAST(sum(n) AS DOUBLE) FROM cm WHERE predicted = c.class_id AND actual = c.class_id) AS hits
        FROM (SELECT DISTINCT actual AS class_id FROM cm) c) WHERE support + claimed > 0)"""
