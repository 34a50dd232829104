"""Queries on pixel arrays, evaluated inside the JVM but for the similarity maps."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.functions import planes, scalars
from tessera.operators import cuts, stats
from tessera.operators import images as ops
from tessera.plans.base import KEY_SQL, PIXELS_SQL, RGB_SQL, SIDE, key, query, rgb, templates, text_of, thousandths, tiles
from tessera.session import sized

LINE = "string_agg(CAST(v AS VARCHAR), ',' ORDER BY pos)"
FINE = "string_agg(CAST(CAST(floor(({}) * 10000 + 0.5) AS BIGINT) AS VARCHAR), ',' ORDER BY pos)"


@query(
    "crop_roi",
    f"""WITH {PIXELS_SQL}, inside AS (
      SELECT image_id, pos, x, y, v FROM grid
      WHERE x BETWEEN image_id % 4 AND image_id % 4 + 2 + image_id % 3 AND y BETWEEN image_id // 4 % 4 AND image_id // 4 % 4 + 3 + image_id % 4)
    SELECT image_id, CAST(count(DISTINCT x) AS INTEGER) AS width, CAST(count(DISTINCT y) AS INTEGER) AS height,
      CAST(count(*) AS INTEGER) AS resolution, {LINE} AS plane FROM inside GROUP BY image_id""",
)
def crop_roi(spark, d):
    x1 = (F.col("image_id") % 4).cast("int")
    y1 = (F.floor(F.col("image_id") / 4) % 4).cast("int")
    x2 = (x1 + 2 + F.col("image_id") % 3).cast("int")
    y2 = (y1 + 3 + F.col("image_id") % 4).cast("int")
    part = planes.crop(F.col("plane"), SIDE, SIDE, x1, y1, x2, y2)
    return (
        tiles(spark, d)
        .select("image_id", part.alias("c"))
        .select("image_id", "c.*")
        .withColumn("resolution", F.col("width") * F.col("height"))
        .withColumn("plane", text_of(F.col("plane")))
    )


@query(
    "centre_crop",
    f"""WITH {PIXELS_SQL} SELECT image_id, {LINE} AS plane FROM grid WHERE x BETWEEN 1 AND 5 AND y BETWEEN 2 AND 4 GROUP BY image_id""",
)
def centre_crop(spark, d):
    part = planes.centre_crop(F.col("plane"), SIDE, SIDE, 5, 3)
    return tiles(spark, d).select("image_id", text_of(part["plane"]).alias("plane"))


@query(
    "brightness_contrast",
    f"""WITH {PIXELS_SQL}, m AS (SELECT *, sum(v) OVER (PARTITION BY image_id) / 64.0::DOUBLE AS mean FROM px)
    SELECT image_id, {FINE.format("CAST(v AS DOUBLE) / 255 + 0.3::DOUBLE")} AS bright, {FINE.format("(CAST(v AS DOUBLE) - mean) * 3 + mean")} AS contrast
    FROM m GROUP BY image_id""",
)
def brightness_contrast(spark, d):
    unit = scalars.scaled_down(F.col("plane"))
    return tiles(spark, d).select(
        "image_id",
        thousandths(planes.brighten(unit, 0.3)).alias("bright"),
        thousandths(planes.contrast(F.col("plane"), 3.0)).alias("contrast"),
    )


@query(
    "flip_transpose",
    f"""WITH {PIXELS_SQL} SELECT image_id, string_agg(CAST(v AS VARCHAR), ',' ORDER BY y, 7 - x) AS flipped,
    string_agg(CAST(v AS VARCHAR), ',' ORDER BY x, y) AS transposed FROM grid GROUP BY image_id""",
)
def flip_transpose(spark, d):
    return tiles(spark, d).select(
        "image_id",
        text_of(planes.flip_left_right(F.col("plane"), SIDE, SIDE)).alias("flipped"),
        text_of(planes.transpose(F.col("plane"), SIDE, SIDE)).alias("transposed"),
    )


@query(
    "random_flip",
    f"""WITH {PIXELS_SQL} SELECT image_id,
    string_agg(CAST(v AS VARCHAR), ',' ORDER BY y, CASE WHEN substr({KEY_SQL}, 1, 1) < '8' THEN 7 - x ELSE x END) AS plane
    FROM grid GROUP BY image_id""",
)
def random_flip(spark, d):
    flipped = planes.random_flip(F.col("plane"), SIDE, SIDE, F.col("image_id"))
    return tiles(spark, d).select("image_id", text_of(flipped).alias("plane"))


STRETCH_SQL = """stretched AS (
  SELECT image_id, class_id, pos, CASE WHEN hi = lo THEN 0 WHEN v = hi THEN 255
    ELSE CAST(floor((v - lo) * (255.0::DOUBLE / (hi - lo))) AS INTEGER) END AS v
  FROM (SELECT *, min(v) OVER (PARTITION BY image_id) AS lo, max(v) OVER (PARTITION BY image_id) AS hi FROM px))"""


@query("stretch_grey", f"WITH {PIXELS_SQL}, {STRETCH_SQL} SELECT image_id, {LINE} AS plane FROM stretched GROUP BY image_id")
def stretch_grey(spark, d):
    return tiles(spark, d).select("image_id", text_of(planes.stretch(F.col("plane"))).alias("plane"))


@query(
    "stretched_class_histogram",
    f"""WITH {PIXELS_SQL}, {STRETCH_SQL}, ranked AS (
      SELECT image_id FROM (SELECT DISTINCT image_id, class_id FROM px)
      QUALIFY row_number() OVER (PARTITION BY class_id ORDER BY {KEY_SQL}) <= 40)
    SELECT class_id, v AS bin, CAST(count(*) AS BIGINT) AS n FROM stretched WHERE image_id IN (SELECT image_id FROM ranked) GROUP BY 1, 2""",
)
def stretched_class_histogram(spark, d):
    """Balanced sample, stretched tiles, histogram per class."""
    chosen = cuts.balanced_sample(tiles(spark, d), 40, ["class_id"], key())
    stretched = chosen.withColumn("plane", planes.stretch(F.col("plane")))
    return stats.value_histogram(stretched, "plane", ["class_id"])


@query(
    "equalise",
    f"""WITH {PIXELS_SQL}, c AS (
      SELECT p.image_id, p.pos, p.v, (SELECT count(*) FROM px q WHERE q.image_id = p.image_id AND q.v <= p.v) AS below FROM px p),
    f AS (SELECT *, min(below) OVER (PARTITION BY image_id) AS first FROM c)
    SELECT image_id, string_agg(CAST(CASE WHEN first = 64 THEN v ELSE CAST(round_even(CAST(CAST(below - first AS FLOAT)
      * CAST(CAST(255 AS FLOAT) / CAST(64 - first AS FLOAT) AS FLOAT) AS DOUBLE), 0) AS INTEGER) END AS VARCHAR), ',' ORDER BY pos) AS plane
    FROM f GROUP BY image_id""",
)
def equalise(spark, d):
    return tiles(spark, d).select("image_id", text_of(planes.equalise(F.col("plane"))).alias("plane"))


@query(
    "to_grey",
    f"""WITH {RGB_SQL} SELECT image_id, string_agg(CAST(CAST(floor((9798 * r + 19235 * g + 3735 * b + 16384) / 32768) AS INTEGER) AS VARCHAR), ',' ORDER BY pos) AS luma,
    string_agg(CAST(CAST(floor((r + g + b) / 3) AS INTEGER) AS VARCHAR), ',' ORDER BY pos) AS mean,
    {FINE.format("CAST(r AS DOUBLE) / 255 * 0.2989::DOUBLE + CAST(g AS DOUBLE) / 255 * 0.587::DOUBLE + CAST(b AS DOUBLE) / 255 * 0.114::DOUBLE")} AS unit FROM rgbpx GROUP BY image_id""",
)
def to_grey(spark, d):
    channels = [F.col(c) for c in "rgb"]
    return rgb(spark, d).select(
        "image_id",
        text_of(planes.grey(*channels)).alias("luma"),
        text_of(planes.grey_mean(*channels)).alias("mean"),
        thousandths(planes.grey_unit(*[scalars.scaled_down(c) for c in channels])).alias("unit"),
    )


# hue, saturation, value of each 4x4 colour pixel
HSV_SQL = (
    RGB_SQL
    + """, span AS (SELECT *, greatest(r, g, b) AS v, greatest(r, g, b) - least(r, g, b) AS d FROM rgbpx),
turned AS (
  SELECT *, CASE WHEN v = r THEN g - b WHEN v = g THEN b - r + 2 * d ELSE r - g + 4 * d END AS turn,
    CASE WHEN v > 0 THEN round(1044480.0::DOUBLE / v) ELSE 0 END AS sstep, CASE WHEN d > 0 THEN round(737280.0::DOUBLE / (6 * d)) ELSE 0 END AS hstep FROM span),
hued AS (SELECT *, CAST(floor((turn * hstep + 2048) / 4096) AS INTEGER) AS h0, CAST(floor((d * sstep + 2048) / 4096) AS INTEGER) AS s FROM turned),
hsv AS (SELECT image_id, class_id, pos, CASE WHEN h0 < 0 THEN h0 + 180 ELSE h0 END AS h, s, v FROM hued)"""
)


@query(
    "to_hsv",
    f"""WITH {HSV_SQL} SELECT image_id, string_agg(CAST(h AS VARCHAR), ',' ORDER BY pos) AS hue,
    string_agg(CAST(s AS VARCHAR), ',' ORDER BY pos) AS saturation, string_agg(CAST(v AS VARCHAR), ',' ORDER BY pos) AS value
    FROM hsv GROUP BY image_id""",
)
def to_hsv(spark, d):
    converted = rgb(spark, d).select("image_id", planes.hsv(F.col("r"), F.col("g"), F.col("b")).alias("hsv"))
    names = {"h": "hue", "s": "saturation", "v": "value"}
    return converted.select(
        "image_id", *[text_of(planes.channel(F.col("hsv"), c)).alias(n) for c, n in names.items()]
    )


@query(
    "channel_plane",
    f"""WITH {RGB_SQL} SELECT image_id, string_agg(CAST(g AS VARCHAR), ',' ORDER BY pos) AS green,
    max(r) FILTER (pos = 6) AS red_at, max(b) FILTER (pos = 6) AS blue_at FROM rgbpx GROUP BY image_id""",
)
def channel_plane(spark, d):
    return rgb(spark, d).select(
        "image_id",
        text_of(F.col("g")).alias("green"),
        planes.at(F.col("r"), 4, 1, 2).alias("red_at"),
        planes.at(F.col("b"), 4, 1, 2).alias("blue_at"),
    )


@query(
    "normalise_histogram",
    f"""WITH {PIXELS_SQL} SELECT image_id, {FINE.format("100 * (CAST(v AS DOUBLE) / (total + 1e-6))")} AS hist
    FROM (SELECT *, CAST(sum(v) OVER (PARTITION BY image_id) AS DOUBLE) AS total FROM px) GROUP BY image_id""",
)
def normalise_histogram(spark, d):
    percent = F.transform(scalars.normalised(F.col("plane")), lambda x: 100 * x)
    return tiles(spark, d).select("image_id", thousandths(percent).alias("hist"))


def _with_own_template(spark, d):
    """Every image beside the template of its own class."""
    own = templates(spark, d).select("class_id", F.col("plane").alias("template"))
    return tiles(spark, d).join(sized(own), "class_id")


OWN_SQL = (
    PIXELS_SQL
    + """, firsts AS (SELECT min(vec_id) AS image_id FROM embeddings GROUP BY label),
t AS (SELECT class_id, pos, y AS ty, x AS tx, v AS tv FROM grid WHERE image_id IN (SELECT image_id FROM firsts))"""
)


@query(
    "template_score",
    f"""WITH {OWN_SQL} SELECT image_id, round(corr(CAST(v AS DOUBLE), CAST(tv AS DOUBLE)), 6) AS score
    FROM px JOIN t USING (class_id, pos) GROUP BY image_id""",
)
def template_score(spark, d):
    score = planes.correlation(F.col("plane"), F.col("template"))
    return _with_own_template(spark, d).select("image_id", F.round(score, 6).alias("score"))


@query(
    "template_similarity",
    f"""WITH {OWN_SQL}, cut AS (SELECT class_id, ty - 2 AS ty, tx - 2 AS tx, tv FROM t WHERE ty BETWEEN 2 AND 5 AND tx BETWEEN 2 AND 5 AND tv > 120),
    pairs AS (SELECT c.image_id, c.pos, (1 - abs(p.v - tv) / 255.0::DOUBLE) AS near
      FROM grid c JOIN cut ON cut.class_id = c.class_id JOIN grid p ON p.image_id = c.image_id AND p.y = c.y + ty - 1 AND p.x = c.x + tx - 1),
    s AS (SELECT image_id, pos, sum(near * near) AS score FROM pairs GROUP BY 1, 2)
    SELECT px.image_id, round(max(coalesce(score, 0)), 6) AS best, round(min(coalesce(score, 0)), 6) AS worst, round(sum(coalesce(score, 0)), 6) AS total
    FROM px LEFT JOIN s USING (image_id, pos) GROUP BY px.image_id""",
)
def template_similarity(spark, d):
    """The central 4x4 part of the class template moved over the image, template pixels above 120 only."""
    part = planes.crop(F.col("plane"), SIDE, SIDE, 2, 2, 5, 5)["plane"]
    own = templates(spark, d).select("class_id", part.alias("template"))
    similar = ops.plane_similarity(SIDE, SIDE, 4, 4, 120)
    scored = tiles(spark, d).join(sized(own), "class_id").select("image_id", similar("plane", "template").alias("map"))
    return scored.select(
        "image_id",
        F.round(F.array_max("map"), 6).alias("best"),
        F.round(F.array_min("map"), 6).alias("worst"),
        F.round(scalars.total(F.col("map")), 6).alias("total"),
    )


SOBEL_SQL = """nb AS (
  SELECT a.image_id, a.pos, a.y, a.x, dy, dx, CAST(b.v AS DOUBLE) AS v
  FROM grid a, (VALUES (-1), (0), (1)) ys(dy), (VALUES (-1), (0), (1)) xs(dx), grid b
  WHERE b.image_id = a.image_id AND b.y = least(7, greatest(0, a.y + dy)) AND b.x = least(7, greatest(0, a.x + dx))),
grad AS (
  SELECT image_id, pos, y, x, sum(v * CASE dx WHEN -1 THEN 1 WHEN 1 THEN -1 ELSE 0 END * CASE dy WHEN 0 THEN 2 ELSE 1 END) AS gx,
    sum(v * CASE dy WHEN 1 THEN 1 WHEN -1 THEN -1 ELSE 0 END * CASE dx WHEN 0 THEN 2 ELSE 1 END) AS gy
  FROM nb GROUP BY 1, 2, 3, 4),
strong AS (
  SELECT *, CASE WHEN max(sqrt(gx * gx + gy * gy)) OVER (PARTITION BY image_id) > 0
    THEN sqrt(gx * gx + gy * gy) / max(sqrt(gx * gx + gy * gy)) OVER (PARTITION BY image_id) * 255 ELSE 0 END AS strength,
    atan2(gy, gx) AS angle FROM grad)"""


@query(
    "sobel",
    f"""WITH {PIXELS_SQL}, {SOBEL_SQL} SELECT image_id, CAST(pos AS INTEGER) AS pos, round(strength, 6) AS strength,
    round(CASE WHEN gx = 0 AND gy = 0 THEN 0 WHEN gy = 0 AND gx < 0 THEN pi() ELSE angle END, 6) AS angle FROM strong""",
)
def sobel(spark, d):
    mapped = tiles(spark, d).select("image_id", F.posexplode(planes.sobel(F.col("plane"), SIDE, SIDE)).alias("pos", "e"))
    # the sign of a zero gradient must not decide between pi and -pi
    angle = F.when((F.abs(F.abs("e.angle") - F.pi()) < 1e-12), F.pi()).otherwise(F.col("e.angle") + 0.0)
    angle = F.when(F.col("e.strength") == 0, F.lit(0.0)).otherwise(angle)
    return mapped.select("image_id", "pos", F.round("e.strength", 6).alias("strength"), F.round(angle, 6).alias("angle"))


BILINEAR_SQL = """targets AS (SELECT i AS pos, (i // {w} + 0.5::DOUBLE) * (8.0::DOUBLE / {h}) - 0.5 AS sy, (i % {w} + 0.5::DOUBLE) * (8.0::DOUBLE / {w}) - 0.5 AS sx FROM range({n}) r(i)),
corners AS (SELECT pos, floor(sy) + dy AS cy, floor(sx) + dx AS cx,
   (CASE dy WHEN 0 THEN 1 - (sy - floor(sy)) ELSE sy - floor(sy) END) * (CASE dx WHEN 0 THEN 1 - (sx - floor(sx)) ELSE sx - floor(sx) END) AS weight
   FROM targets, (VALUES (0), (1)) ys(dy), (VALUES (0), (1)) xs(dx)),
resized AS (SELECT image_id, c.pos, sum(weight * v) AS v FROM corners c JOIN grid g ON g.y = least(7, greatest(0, cy)) AND g.x = least(7, greatest(0, cx)) GROUP BY 1, 2)"""


@query(
    "resize_bilinear",
    f"""WITH {PIXELS_SQL}, {BILINEAR_SQL.format(h=6, w=12, n=72)} SELECT image_id, CAST(pos AS INTEGER) AS pos, round(v, 6) AS v FROM resized""",
)
def resize_bilinear(spark, d):
    resized = planes.resize_bilinear(F.col("plane"), SIDE, SIDE, 12, 6)
    return tiles(spark, d).select("image_id", F.posexplode(resized).alias("pos", "v")).withColumn("v", F.round("v", 6))


@query(
    "fit_resize",
    f"""WITH {PIXELS_SQL}, {BILINEAR_SQL.format(h=5, w=5, n=25)}, cells AS (SELECT i AS pos, i // 8 AS y, i % 8 AS x FROM range(40) r(i)),
    ids AS (SELECT DISTINCT image_id FROM px)
    SELECT ids.image_id, CAST(c.pos AS INTEGER) AS pos, round(coalesce(v, 0), 6) AS v FROM ids, cells c
    LEFT JOIN resized r ON r.image_id = ids.image_id AND x BETWEEN 2 AND 6 AND r.pos = y * 5 + x - 2""",
)
def fit_resize(spark, d):
    """8x8 into 5 rows of 8: five columns of image, two zero columns left and one right."""
    fitted = planes.fit(F.col("plane"), SIDE, SIDE, 8, 5)
    return tiles(spark, d).select("image_id", F.posexplode(fitted).alias("pos", "v")).withColumn("v", F.round("v", 6))
