"""Queries on binary images: the Arrow operators, over tiles packed into image structs."""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import functions as F

from tessera.functions import kernels
from tessera.operators import images as ops
from tessera.plans.base import PIXELS_SQL, SIDE, query, rgb, templates, text_of, thousandths, tiles
from tessera.plans.pixels import BILINEAR_SQL, FINE, HSV_SQL, LINE, RGB_SQL, SOBEL_SQL, STRETCH_SQL


def grey_images(spark, d, source=tiles):
    """The 8x8 tiles as images with three equal channels."""
    plane = F.col("plane")
    return source(spark, d).select("image_id", "class_id", ops.from_planes(plane, plane, plane, SIDE, SIDE).alias("image"))


def colour_images(spark, d):
    """The 4x4 colour tiles as images."""
    pixels = ops.from_planes(F.col("r"), F.col("g"), F.col("b"), 4, 4)
    return rgb(spark, d).select("image_id", "class_id", pixels.alias("image"))


LEVELS = ops.vector_map(kernels.to_bytes, "smallint")


def _bytes(image):
    """Pixel levels of an image column as text."""
    return text_of(LEVELS(image))


def _long(df, name):
    # a plain posexplode has Spark look for empty arrays beforehand, which computes every image twice
    exploded = df.select("image_id", F.posexplode_outer(name).alias("pos", "v")).where("pos IS NOT NULL")
    return exploded.withColumn("v", F.round(F.col("v").cast("double"), 4))


@query(
    "hsv_histograms",
    f"""WITH {HSV_SQL} SELECT image_id, 'hue' AS channel, h AS bin, CAST(count(*) AS INTEGER) AS n FROM hsv GROUP BY ALL
    UNION ALL SELECT image_id, 'saturation', s, CAST(count(*) AS INTEGER) FROM hsv GROUP BY ALL
    UNION ALL SELECT image_id, 'value', v, CAST(count(*) AS INTEGER) FROM hsv GROUP BY ALL""",
)
def hsv_histograms(spark, d):
    counted = colour_images(spark, d).select("image_id", ops.hsv_histograms("image").alias("h")).select("image_id", "h.*")

    def cells_of(name):
        cell = lambda n, i: F.struct(F.lit(name).alias("channel"), i.alias("bin"), n.alias("n"))
        return F.transform(f"{name}_hist", cell)

    cells = F.concat(*[cells_of(n) for n in ("hue", "saturation", "value")])
    return (
        counted.select("image_id", F.explode(F.filter(cells, lambda c: c["n"] > 0)).alias("c")).select("image_id", "c.*")
    )


@query(
    "crop_image",
    f"""WITH {RGB_SQL}, inside AS (SELECT * FROM rgbpx WHERE pos % 4 BETWEEN image_id % 3 AND image_id % 3 + 2 AND pos // 4 BETWEEN 1 AND 2)
    SELECT image_id, CAST(count(*) // 2 AS INTEGER) AS width, 2 AS height, CAST(count(*) AS INTEGER) AS resolution,
    string_agg(r || ',' || g || ',' || b, ',' ORDER BY pos) AS pixels FROM inside GROUP BY image_id""",
)
def crop_image(spark, d):
    left = (F.col("image_id") % 3).cast("int")
    cropped = colour_images(spark, d).select("image_id", ops.crop("image", left, F.lit(1), left + 2, F.lit(2)).alias("image"))
    return cropped.select("image_id", *ops.image_size(), _bytes(F.col("image")).alias("pixels"))


@query(
    "centre_image",
    f"""WITH {RGB_SQL} SELECT image_id, string_agg(r || ',' || g || ',' || b, ',' ORDER BY pos) AS pixels
    FROM rgbpx WHERE pos % 4 IN (1, 2) AND pos // 4 IN (1, 2) GROUP BY image_id""",
)
def centre_image(spark, d):
    cut = ops.centre_crop(2, 2)
    return colour_images(spark, d).select("image_id", _bytes(cut("image")).alias("pixels"))


@query("stretch_image", f"WITH {PIXELS_SQL}, {STRETCH_SQL} SELECT image_id, {LINE} AS plane FROM stretched GROUP BY image_id")
def stretch_image(spark, d):
    return grey_images(spark, d).select("image_id", text_of(ops.stretched_plane("image")).alias("plane"))


def _from_hsv_sql(relation: str) -> str:
    """Pixel text of a relation (image_id, pos, h, s, nv) with the new value nv."""
    level = "CAST(CAST(round_even(u * (1 - t * greatest(0, least(k{c}, 4 - k{c}, 1))) * 255, 0) AS INTEGER) AS VARCHAR)"
    pixel = " || ',' || ".join(level.format(c=c) for c in "rgb")
    return f"""turnback AS (SELECT image_id, pos, nv / 255.0::DOUBLE AS u, s / 255.0::DOUBLE AS t, (5 + h / 30.0::DOUBLE) % 6 AS kr,
      (3 + h / 30.0::DOUBLE) % 6 AS kg, (1 + h / 30.0::DOUBLE) % 6 AS kb FROM {relation}),
    hsvback AS (SELECT image_id, string_agg({pixel}, ',' ORDER BY pos) AS pixels FROM turnback GROUP BY image_id)"""


@query(
    "stretch_value",
    f"""WITH {HSV_SQL}, lim AS (SELECT *, min(v) OVER (PARTITION BY image_id) AS lo, max(v) OVER (PARTITION BY image_id) AS hi FROM hsv),
    st AS (SELECT *, CASE WHEN hi = lo THEN 0 WHEN v = hi THEN 255 ELSE floor((v - lo) * (255.0::DOUBLE / (hi - lo))) END AS nv FROM lim),
    {_from_hsv_sql('st')} SELECT image_id, pixels FROM hsvback""",
)
def stretch_value(spark, d):
    return colour_images(spark, d).select("image_id", _bytes(ops.stretch_value("image")).alias("pixels"))


@query(
    "equalise_value",
    f"""WITH {HSV_SQL}, c AS (SELECT *, (SELECT count(*) FROM hsv q WHERE q.image_id = p.image_id AND q.v <= p.v) AS below FROM hsv p),
    f AS (SELECT *, min(below) OVER (PARTITION BY image_id) AS first FROM c),
    eq AS (SELECT *, CASE WHEN first = 16 THEN v ELSE round_even(CAST(CAST(below - first AS FLOAT)
      * CAST(CAST(255 AS FLOAT) / CAST(16 - first AS FLOAT) AS FLOAT) AS DOUBLE), 0) END AS nv FROM f),
    {_from_hsv_sql('eq')} SELECT image_id, pixels FROM hsvback""",
)
def equalise_value(spark, d):
    return colour_images(spark, d).select("image_id", _bytes(ops.equalise_value("image")).alias("pixels"))


def _linear(c: str) -> str:
    unit = f"({c} / 255.0::DOUBLE)"
    return f"CASE WHEN {unit} > 0.04045 THEN pow(({unit} + 0.055::DOUBLE) / 1.055::DOUBLE, 2.4::DOUBLE) ELSE {unit} / 12.92::DOUBLE END"


def _curve(t: str) -> str:
    return f"CASE WHEN {t} > 0.008856 THEN cbrt({t}) ELSE 7.787::DOUBLE * {t} + 16.0::DOUBLE / 116 END"


_M = [[f"{x}::DOUBLE" for x in row] for row in kernels.RGB_TO_XYZ.tolist()]
LAB_SQL = (
    RGB_SQL
    + f""", lin AS (SELECT image_id, pos, {_linear('r')} AS lr, {_linear('g')} AS lg, {_linear('b')} AS lb FROM rgbpx),
xyz AS (SELECT image_id, pos, (lr * {_M[0][0]} + lg * {_M[0][1]} + lb * {_M[0][2]}) / 0.950456::DOUBLE AS x,
  lr * {_M[1][0]} + lg * {_M[1][1]} + lb * {_M[1][2]} AS y, (lr * {_M[2][0]} + lg * {_M[2][1]} + lb * {_M[2][2]}) / 1.088754::DOUBLE AS z FROM lin),
f AS (SELECT *, {_curve('x')} AS fx, {_curve('y')} AS fy, {_curve('z')} AS fz FROM xyz),
lab AS (SELECT image_id, pos, CAST(round_even((CASE WHEN y > 0.008856 THEN 116 * fy - 16 ELSE 903.3::DOUBLE * y END) * 2.55::DOUBLE, 0) AS INTEGER) AS l,
  CAST(round_even(500 * (fx - fy) + 128, 0) AS INTEGER) AS a, CAST(round_even(200 * (fy - fz) + 128, 0) AS INTEGER) AS b FROM f)"""
)


@query(
    "to_lab",
    f"WITH {LAB_SQL} SELECT image_id, string_agg(l || ',' || a || ',' || b, ',' ORDER BY pos) AS pixels FROM lab GROUP BY image_id",
)
def to_lab(spark, d):
    return colour_images(spark, d).select("image_id", _bytes(ops.lab_image("image")).alias("pixels"))


_BACK = [[f"({x!r}::DOUBLE)" for x in row] for row in np.linalg.inv(kernels.RGB_TO_XYZ).tolist()]


def _from_lab_sql(relation: str) -> str:
    """Pixel text of a relation (image_id, pos, nl, a, b) with the new lightness nl."""
    cube = lambda f: f"(CASE WHEN {f} > 6.0::DOUBLE / 29 THEN {f} * {f} * {f} ELSE ({f} - 16.0::DOUBLE / 116) / 7.787::DOUBLE END)"
    linear = ", ".join(
        f"least(1, greatest(0, x * {m[0]} + y * {m[1]} + z * {m[2]})) AS l{c}" for c, m in zip("rgb", _BACK)
    )
    level = "CAST(CAST(round_even((CASE WHEN l{c} > 0.0031308 THEN 1.055::DOUBLE * pow(l{c}, 1.0::DOUBLE / 2.4::DOUBLE) - 0.055::DOUBLE ELSE 12.92::DOUBLE * l{c} END) * 255, 0) AS INTEGER) AS VARCHAR)"
    pixel = " || ',' || ".join(level.format(c=c) for c in "rgb")
    return f"""curved AS (SELECT image_id, pos, (nl / 2.55::DOUBLE + 16) / 116 AS fy, (a - 128) / 500.0::DOUBLE AS da, (b - 128) / 200.0::DOUBLE AS db FROM {relation}),
    space AS (SELECT image_id, pos, {cube('(fy + da)')} * 0.950456::DOUBLE AS x, {cube('fy')} AS y, {cube('(fy - db)')} * 1.088754::DOUBLE AS z FROM curved),
    lights AS (SELECT image_id, pos, {linear} FROM space),
    labback AS (SELECT image_id, string_agg({pixel}, ',' ORDER BY pos) AS pixels FROM lights GROUP BY image_id)"""


@query(
    "stretch_lightness",
    f"""WITH {LAB_SQL}, lim AS (SELECT *, min(l) OVER (PARTITION BY image_id) AS lo, max(l) OVER (PARTITION BY image_id) AS hi FROM lab),
    st AS (SELECT *, CASE WHEN hi = lo THEN 0 WHEN l = hi THEN 100 ELSE floor((l - lo) * (100.0::DOUBLE / (hi - lo))) END AS nl FROM lim),
    {_from_lab_sql('st')} SELECT image_id, pixels FROM labback""",
)
def stretch_lightness(spark, d):
    return colour_images(spark, d).select("image_id", _bytes(ops.stretch_lightness("image")).alias("pixels"))


# one pixel per tile: the table of a tile is 255 from its own level upward
@query(
    "clahe",
    f"""WITH {PIXELS_SQL}, k AS (
      SELECT a.image_id, a.pos, a.v, dy, dx, CASE WHEN a.v >= t.v THEN 255 ELSE 0 END AS level
      FROM grid a, (VALUES (-1), (0)) ys(dy), (VALUES (-1), (0)) xs(dx), grid t
      WHERE t.image_id = a.image_id AND t.y = greatest(0, a.y + dy) AND t.x = greatest(0, a.x + dx)),
    m AS (SELECT image_id, pos, CAST(round_even(sum(level) / 4.0::DOUBLE, 0) AS INTEGER) AS v FROM k GROUP BY 1, 2)
    SELECT image_id, {LINE} AS plane FROM m GROUP BY image_id""",
)
def clahe(spark, d):
    return grey_images(spark, d).select("image_id", text_of(ops.clahe_plane("image")).alias("plane"))


def _tile_blend_sql(relation: str, level: str, name: str) -> str:
    """The same on 4x4 pixels, keeping the other columns."""
    return f"""{name} AS (
      SELECT p.*, (SELECT round_even(sum(CASE WHEN p.{level} >= t.{level} THEN 255 ELSE 0 END) / 4.0::DOUBLE, 0)
        FROM (VALUES (-1), (0)) ys(dy), (VALUES (-1), (0)) xs(dx), {relation} t
        WHERE t.image_id = p.image_id AND t.pos = greatest(0, p.pos // 4 + dy) * 4 + greatest(0, p.pos % 4 + dx)) AS n{level}
      FROM {relation} p)"""


@query(
    "clahe_images",
    f"""WITH {HSV_SQL}, {LAB_SQL.removeprefix(RGB_SQL).lstrip(', ')}, {_tile_blend_sql('hsv', 'v', 'cv')}, {_tile_blend_sql('lab', 'l', 'cl')},
    {_from_hsv_sql('cv')}, {_from_lab_sql('cl')}
    SELECT image_id, v.pixels AS by_value, l.pixels AS by_lightness FROM hsvback v JOIN labback l USING (image_id)""",
)
def clahe_images(spark, d):
    return colour_images(spark, d).select(
        "image_id",
        _bytes(ops.clahe_value("image")).alias("by_value"),
        _bytes(ops.clahe_lightness("image")).alias("by_lightness"),
    )


def _circle_sql(points: int, relation: str, total: str) -> str:
    """Bits of the circle points around each pixel of an 8x8 relation (image_id, pos, v)."""
    rows = []
    for i in range(points):
        dy, dx = round(-math.sin(2 * math.pi * i / points), 5), round(math.cos(2 * math.pi * i / points), 5)
        y0, x0 = math.floor(dy), math.floor(dx)
        for oy, wy in ((0, 1 - (dy - y0)), (1, dy - y0)):
            for ox, wx in ((0, 1 - (dx - x0)), (1, dx - x0)):
                if wy * wx:
                    rows.append(f"({i}, {y0 + oy}, {x0 + ox}, {wy!r}::DOUBLE, {wx!r}::DOUBLE)")
    return f"""pix AS (SELECT image_id, pos, pos // 8 AS y, pos % 8 AS x, CAST(v AS DOUBLE) AS v FROM {relation}),
    circle(i, dy, dx, wy, wx) AS (VALUES {", ".join(rows)}),
    around AS (
      SELECT a.image_id, a.pos, c.i, a.v, c.dy, c.wy, sum(c.wx * coalesce(b.v, 0) ORDER BY c.dx) AS side
      FROM pix a CROSS JOIN circle c LEFT JOIN pix b ON b.image_id = a.image_id AND b.y = a.y + c.dy AND b.x = a.x + c.dx
      GROUP BY ALL),
    bits AS (SELECT image_id, pos, i, CASE WHEN sum(wy * side ORDER BY dy) - v >= 0 THEN 1 ELSE 0 END AS bit FROM around GROUP BY image_id, pos, i, v),
    codes AS (SELECT image_id, pos, {total} AS v FROM bits GROUP BY image_id, pos)"""


LBP_SQL = f"{PIXELS_SQL}, {STRETCH_SQL}, " + _circle_sql(10, "stretched", "CAST(sum(bit << i) AS INTEGER)")


@query("lbp_image", f"WITH {LBP_SQL} SELECT image_id, {LINE} AS codes FROM codes GROUP BY image_id")
def lbp_image(spark, d):
    lbp = ops.lbp()
    coded = grey_images(spark, d).select("image_id", lbp("image").alias("l"))
    return coded.select("image_id", text_of(F.col("l.lbp_image")).alias("codes"))


@query("lbp_histogram", f"WITH {LBP_SQL} SELECT image_id, v AS bin, CAST(count(*) AS INTEGER) AS n FROM codes GROUP BY 1, 2")
def lbp_histogram(spark, d):
    lbp = ops.lbp()
    coded = grey_images(spark, d).select("image_id", lbp("image").alias("l"))
    return coded.select("image_id", F.posexplode_outer("l.lbp_hist").alias("bin", "n")).where("n > 0")


GREY_LAB_SQL = f"""{PIXELS_SQL}, lin AS (SELECT image_id, pos, {_linear('v')} AS y FROM px),
  light AS (SELECT image_id, pos, CAST(round_even((CASE WHEN y > 0.008856 THEN 116 * cbrt(y) - 16 ELSE 903.3::DOUBLE * y END) * 2.55::DOUBLE, 0) AS INTEGER) AS v FROM lin)"""


@query(
    "lbp_uniform",
    f"WITH {GREY_LAB_SQL}, "
    + _circle_sql(
        8,
        "light",
        "CASE WHEN "
        + " + ".join(f"abs(max(bit) FILTER (i = {i}) - max(bit) FILTER (i = {i + 1}))" for i in range(7))
        + " <= 2 THEN CAST(sum(bit) AS INTEGER) ELSE 9 END",
    )
    + f" SELECT image_id, {LINE} AS codes FROM codes GROUP BY image_id",
)
def lbp_uniform(spark, d):
    return grey_images(spark, d).select("image_id", text_of(ops.lbp_uniform("image")).alias("codes"))


def _hog_sql(orientations: int, cell: int, block: int) -> str:
    n = SIDE // cell
    per_block = block * block * orientations
    return f"""WITH {PIXELS_SQL}, u AS (SELECT image_id, y, x, CAST(v AS DOUBLE) AS v FROM grid),
    g AS (SELECT c.image_id, c.y, c.x, CASE WHEN c.x IN (0, 7) THEN 0 ELSE r.v - l.v END AS gx, CASE WHEN c.y IN (0, 7) THEN 0 ELSE b.v - t.v END AS gy
      FROM u c LEFT JOIN u l ON l.image_id = c.image_id AND l.y = c.y AND l.x = c.x - 1 LEFT JOIN u r ON r.image_id = c.image_id AND r.y = c.y AND r.x = c.x + 1
        LEFT JOIN u t ON t.image_id = c.image_id AND t.y = c.y - 1 AND t.x = c.x LEFT JOIN u b ON b.image_id = c.image_id AND b.y = c.y + 1 AND b.x = c.x),
    o AS (SELECT image_id, y // {cell} AS cy, x // {cell} AS cx, sqrt(gx * gx + gy * gy) / 255 AS m, degrees(atan2(gy, gx)) AS a FROM g),
    q AS (SELECT image_id, cy, cx, m, CAST(floor((a - 180 * floor(a / 180)) / (180.0::DOUBLE / {orientations}) + 1e-9) AS INTEGER) % {orientations} AS k FROM o),
    h AS (SELECT image_id, cy, cx, k, sum(m) / {cell * cell} AS v FROM q GROUP BY ALL),
    slots AS (SELECT b1.i AS bly, b2.i AS blx, c1.i AS oy, c2.i AS ox, k.i AS k FROM range({n - block + 1}) b1(i), range({n - block + 1}) b2(i),
      range({block}) c1(i), range({block}) c2(i), range({orientations}) k(i)),
    ids AS (SELECT DISTINCT image_id FROM px),
    f AS (SELECT ids.image_id, (bly * {n - block + 1} + blx) AS blk, (oy * {block} + ox) * {orientations} + s.k AS slot, coalesce(h.v, 0) AS v
      FROM ids, slots s LEFT JOIN h ON h.image_id = ids.image_id AND h.cy = bly + oy AND h.cx = blx + ox AND h.k = s.k),
    n1 AS (SELECT *, least(0.2, v / sqrt(sum(v * v) OVER (PARTITION BY image_id, blk) + 1e-10)) AS w FROM f)
    SELECT image_id, CAST(blk * {per_block} + slot AS INTEGER) AS pos,
      round(CAST(CAST(w / sqrt(sum(w * w) OVER (PARTITION BY image_id, blk) + 1e-10) AS FLOAT) AS DOUBLE), 4) AS v FROM n1"""


@query("hog", _hog_sql(9, 2, 2))
def hog(spark, d):
    features = ops.hog(9, 2, 2)
    return _long(grey_images(spark, d).select("image_id", features("image").alias("hog")), "hog")


@query("hog_coarse", _hog_sql(8, 4, 1))
def hog_coarse(spark, d):
    features = ops.hog(8, 4, 1)
    return _long(grey_images(spark, d).select("image_id", features("image").alias("hog")), "hog")


@query(
    "template_pattern",
    f"""WITH {PIXELS_SQL}, firsts AS (SELECT min(vec_id) AS image_id FROM embeddings GROUP BY label),
    t AS (SELECT class_id AS template_class, y, x, v AS tv FROM grid WHERE image_id IN (SELECT image_id FROM firsts)),
    offs AS (SELECT i AS off, i // 3 - 1 AS oy, i % 3 - 1 AS ox FROM range(9) r(i)),
    w AS (SELECT ids.image_id, off, t.template_class, CAST(coalesce(g.v, 0) AS DOUBLE) AS v, CAST(tv AS DOUBLE) AS tv
      FROM (SELECT DISTINCT image_id FROM px) ids CROSS JOIN offs CROSS JOIN t
      LEFT JOIN grid g ON g.image_id = ids.image_id AND g.y = t.y + oy AND g.x = t.x + ox)
    SELECT image_id, CAST(template_class * 9 + off AS INTEGER) AS pos, round(CAST(CAST(corr(v, tv) AS FLOAT) AS DOUBLE), 4) AS v FROM w GROUP BY image_id, template_class, off""",
)
def template_pattern(spark, d):
    matched = ops.template_pattern(grey_images(spark, d), grey_images(spark, d, templates), margin=1)
    return _long(matched, "template_pattern")


def _blur_sql(sigma: float, radius: int, unit: float, border: str, source: str = "grid") -> str:
    weights = [math.exp(-0.5 * (i / sigma) ** 2) for i in range(-radius, radius + 1)]
    rows = ", ".join(f"({i - radius}, {w / sum(weights)!r}::DOUBLE)" for i, w in enumerate(weights))
    at = {
        "edge": "least(7, greatest(0, {0}))",
        "symmetric": "least((({0}) % 16 + 16) % 16, 15 - (({0}) % 16 + 16) % 16)",
    }[border]
    return f"""tap(o, w) AS (VALUES {rows}),
    down AS (SELECT a.image_id, a.y, a.x, sum(w * (b.v / {unit}::DOUBLE)) AS v FROM {source} a CROSS JOIN tap JOIN {source} b
      ON b.image_id = a.image_id AND b.x = a.x AND b.y = {at.format('a.y + o')} GROUP BY 1, 2, 3),
    blurred AS (SELECT a.image_id, a.y * 8 + a.x AS pos, a.y, a.x, sum(w * b.v) AS v FROM down a CROSS JOIN tap JOIN down b
      ON b.image_id = a.image_id AND b.y = a.y AND b.x = {at.format('a.x + o')} GROUP BY 1, 2, 3, 4)"""


@query(
    "blur",
    f"""WITH {PIXELS_SQL}, {_blur_sql(2.0, 8, 255.0, 'edge')}
    SELECT image_id, CAST(pos AS INTEGER) AS pos, round(CAST(CAST(v AS FLOAT) AS DOUBLE), 4) AS v FROM blurred""",
)
def blur(spark, d):
    plane = ops.vector_map(lambda s: kernels.blur(kernels.to_unit(s), 2.0)[..., 0], "float")
    return _long(grey_images(spark, d).select("image_id", plane("image").alias("p")), "p")


def _thin_sql(source: str, sigma: float, radius: int) -> str:
    gradient = SOBEL_SQL.replace("FROM grid a,", "FROM blurred a,").replace(", grid b\n", ", blurred b\n")
    ahead_y = "CASE k WHEN 0 THEN 0 WHEN 1 THEN 1 WHEN 2 THEN 1 ELSE -1 END"
    ahead_x = "CASE k WHEN 0 THEN 1 WHEN 1 THEN -1 WHEN 2 THEN 0 ELSE -1 END"
    return f"""{_blur_sql(sigma, radius, 1.0, 'symmetric', source)}, {gradient},
    sector AS (SELECT *, CAST(floor((CASE WHEN degrees(angle) < 0 THEN degrees(angle) + 180 ELSE degrees(angle) END + 22.5) / 45) AS INTEGER) % 4 AS k FROM strong),
    thin AS (SELECT s.image_id, s.pos, CASE WHEN s.y BETWEEN 1 AND 6 AND s.x BETWEEN 1 AND 6 AND s.strength >= p.strength AND s.strength >= q.strength
        THEN CAST(trunc(s.strength) AS INTEGER) ELSE 0 END AS v
      FROM sector s LEFT JOIN strong p ON p.image_id = s.image_id AND p.y = s.y + {ahead_y} AND p.x = s.x + {ahead_x}
        LEFT JOIN strong q ON q.image_id = s.image_id AND q.y = s.y - {ahead_y} AND q.x = s.x - {ahead_x})"""


def _hysteresis_sql(sources: str, thin: str) -> str:
    """Thresholds and one pass in reading order over the inner 6x6 pixels, one pixel per step."""
    return f"""WITH RECURSIVE {sources}, {thin},
    lim AS (SELECT *, max(v) OVER (PARTITION BY image_id) * 0.15::DOUBLE AS hi FROM thin),
    marks AS (SELECT image_id, max(hi) AS hi, list(CASE WHEN v <= hi AND v >= hi * 0.05::DOUBLE THEN 75 WHEN v >= hi THEN 255 ELSE 0 END ORDER BY pos) AS state
      FROM lim GROUP BY image_id),
    walk AS (SELECT image_id, 0 AS k, hi, state FROM marks
      UNION ALL SELECT image_id, k + 1, hi, list_transform(state, lambda v, i: CASE WHEN i <> (k // 6 + 1) * 8 + k % 6 + 2 OR v <> 75 THEN v
        WHEN list_contains(list_concat(state[i - 9:i - 7], state[i - 1:i + 1], state[i + 7:i + 9]), 255) THEN 255 ELSE 0 END) FROM walk WHERE k < 36)
    SELECT image_id, array_to_string(CASE WHEN hi > 0 THEN state ELSE list_transform(state, lambda v: 0) END, ',') AS edges FROM walk WHERE k = 36"""


THIN_SQL = f"{PIXELS_SQL}, {_thin_sql('grid', 1.0, 2)}"


@query("thin_edges", f"WITH {THIN_SQL} SELECT image_id, {LINE} AS plane FROM thin GROUP BY image_id")
def thin_edges(spark, d):
    """Blurred, Sobel, thinned; strengths cut off to whole numbers."""

    def thin(stack):
        return kernels.thin_edges(*kernels.sobel(kernels.blur(kernels.grey(stack), 1.0, 2, "symmetric")))

    plane = ops.vector_map(thin, "smallint")
    return grey_images(spark, d).select("image_id", text_of(plane("image")).alias("plane"))


@query("edge_map", _hysteresis_sql(PIXELS_SQL, _thin_sql("grid", 1.0, 2)))
def edge_map(spark, d):
    edges = ops.edges()
    return grey_images(spark, d).select("image_id", text_of(edges("image")).alias("edges"))


LIGHT_GRID_SQL = f"{GREY_LAB_SQL}, lgrid AS (SELECT image_id, pos, pos // 8 AS y, pos % 8 AS x, v FROM light)"


@query("lightness_edges", _hysteresis_sql(LIGHT_GRID_SQL, _thin_sql("lgrid", 3.0, 12)))
def lightness_edges(spark, d):
    edges = ops.lightness_edges(3.0)
    return grey_images(spark, d).select("image_id", text_of(edges("image")).alias("edges"))


@query(
    "shrink_image",
    f"""WITH {PIXELS_SQL}, {BILINEAR_SQL.format(h=4, w=4, n=16)}
    SELECT image_id, CAST(pos AS INTEGER) AS pos, round(CAST(CAST(v / 255 AS FLOAT) AS DOUBLE), 4) AS v FROM resized""",
)
def shrink_image(spark, d):
    half = ops.shrink(50)
    first = ops.vector_map(lambda s: s[..., 0], "float")
    return _long(grey_images(spark, d).select("image_id", first(half("image")).alias("p")), "p")


@query(
    "fit_image",
    f"""WITH {PIXELS_SQL}, {BILINEAR_SQL.format(h=5, w=5, n=25)}, cells AS (SELECT i AS pos, i // 8 AS y, i % 8 AS x FROM range(40) r(i)),
    ids AS (SELECT DISTINCT image_id FROM px)
    SELECT ids.image_id, CAST(c.pos AS INTEGER) AS pos, round(CAST(CAST(coalesce(v, 0) / 255 AS FLOAT) AS DOUBLE), 4) AS v FROM ids, cells c
    LEFT JOIN resized r ON r.image_id = ids.image_id AND x BETWEEN 2 AND 6 AND r.pos = y * 5 + x - 2""",
)
def fit_image(spark, d):
    fitted = ops.fit(5, 8)
    first = ops.vector_map(lambda s: s[..., 0], "float")
    return _long(grey_images(spark, d).select("image_id", first(fitted("image")).alias("p")), "p")


def _spline(x: float, degree: int = 5) -> float:
    """Centred B-spline by recursion over the degree."""
    if degree == 0:
        return 1.0 if -0.5 <= x < 0.5 else 0.0
    half = (degree + 1) / 2
    return ((half + x) * _spline(x + 0.5, degree - 1) + (half - x) * _spline(x - 0.5, degree - 1)) / degree


def _upscale_sql(n: int, m: int) -> str:
    """Colour tiles of side n enlarged to side m, cut to the range of the image (image_id, y, x, c, v)."""
    mirror = lambda i: (n - 1) - abs((n - 1) - abs(i) % (2 * n - 2))
    knots, sample = np.zeros((n, n)), np.zeros((m, n))
    for i in range(n):
        for j in range(i - 2, i + 3):
            knots[i, mirror(j)] += _spline(float(i - j))
    for o in range(m):
        at = (o + 0.5) * n / m - 0.5
        for j in range(math.floor(at) - 2, math.floor(at) + 4):
            sample[o, mirror(j)] += _spline(at - j)
    weights = sample @ np.linalg.inv(knots)
    rows = ", ".join(f"({o}, {i}, {weights[o, i].item()!r}::DOUBLE)" for o in range(m) for i in range(n))
    return f"""{RGB_SQL}, chan AS (
      SELECT image_id, pos // {n} AS y, pos % {n} AS x, unnest([0, 1, 2]) AS c, unnest([r, g, b]) / 255.0::DOUBLE AS v FROM rgbpx),
    wt(o, i, w) AS (VALUES {rows}),
    tall AS (SELECT image_id, c, o AS y, x, sum(w * v) AS v FROM chan JOIN wt ON i = y GROUP BY image_id, c, o, x),
    free AS (SELECT image_id, c, y, o AS x, sum(w * v) AS v FROM tall JOIN wt ON i = x GROUP BY image_id, c, y, o),
    ends AS (SELECT image_id, min(v) AS lo, max(v) AS hi FROM chan GROUP BY image_id),
    big AS (SELECT image_id, c, y, x, CAST(CAST(least(hi, greatest(lo, v)) AS FLOAT) AS DOUBLE) AS v FROM free JOIN ends USING (image_id))"""


UNITS = ops.vector_map(lambda s: s, "float")


@query(
    "rescale_image",
    f"WITH {_upscale_sql(4, 16)} SELECT image_id, CAST((y * 16 + x) * 3 + c AS INTEGER) AS pos, round(v, 4) AS v FROM big",
)
def rescale_image(spark, d):
    """Degree-5 rescale of the 4x4 colour tiles to 16x16."""
    scaled = ops.rescale(16)
    return _long(colour_images(spark, d).select("image_id", UNITS(scaled("image")).alias("p")), "p")


@query(
    "rescale_network",
    f"""WITH {_upscale_sql(4, 16)} SELECT image_id, CAST(((y - 1) * 14 + x - 1) * 3 + c AS INTEGER) AS pos, round(v, 4) AS v
    FROM big WHERE y BETWEEN 1 AND 14 AND x BETWEEN 1 AND 14""",
)
def rescale_network(spark, d):
    """The same, then the central 14x14."""
    wide = ops.rescale_wide(16, 14)
    return _long(colour_images(spark, d).select("image_id", UNITS(wide("image")).alias("p")), "p")


def channel_means():
    """Stand-in for a network: average pooling over the pixels."""

    def predict(flat: np.ndarray) -> np.ndarray:
        return flat.reshape(len(flat), -1, 3).mean(axis=1)

    return predict


@query(
    "embed_images",
    f"""WITH {RGB_SQL}, m AS (SELECT image_id, unnest([avg(r), avg(g), avg(b)]) AS v, unnest([0, 1, 2]) AS pos FROM rgbpx GROUP BY image_id)
    SELECT image_id, pos, round(v / 255, 4) AS v FROM m""",
)
def embed_images(spark, d):
    return _long(ops.embed_images(colour_images(spark, d), channel_means, 48), "embedding")
