"""Pixel operators as array expressions.

A plane is one channel of an image as a flat row-major array. Everything here is a
row map inside the JVM: no shuffle, no explode, no Python worker. The same operators
for binary images of real size are in operators/images.py.

Several of these nest one lambda in another. Spark cannot hand such an expression
straight to a Python function (the inner lambda hides the input from it): store or
checkpoint the column, or join in between, before it goes into operators/images.py.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from tessera.functions.kernels import LUMA_15
from tessera.functions.scalars import let

Size = int | Column

# Luma weights of float channels.
LUMA = (0.2989, 0.587, 0.114)


def _int(value: Size) -> Column:
    return F.lit(value) if isinstance(value, int) else value



def from_unit(values: Column) -> Column:
    """Floats in -1..1 to grey levels 0..255."""
    return F.transform(
        values,
        lambda x: F.least(
            F.lit(255), F.greatest(F.lit(0), F.floor((x.cast("double") + 1) * 127.5).cast("int"))
        ),
    )


def crop(plane: Column, width: Size, height: Size, x1: Size, y1: Size, x2: Size, y2: Size) -> Column:
    """Region with both ends included, cut at the image border; struct of width, height, plane."""
    bounds = F.struct(
        plane.alias("plane"),
        _int(width).alias("w"),
        _int(x1).alias("x1"),
        _int(y1).alias("y1"),
        F.least(_int(x2), _int(width) - 1).alias("x2"),
        F.least(_int(y2), _int(height) - 1).alias("y2"),
    )

    def cut(b: Column) -> Column:
        wide = F.greatest(F.lit(0), b["x2"] - b["x1"] + 1)
        high = F.greatest(F.lit(0), b["y2"] - b["y1"] + 1)
        lines = F.transform(
            F.sequence(b["y1"], F.greatest(b["y1"], b["y2"])),
            lambda y: F.slice(b["plane"], y * b["w"] + b["x1"] + 1, wide),
        )
        return F.struct(
            wide.alias("width"),
            high.alias("height"),
            F.slice(F.flatten(lines), F.lit(1), wide * high).alias("plane"),
        )

    return let(bounds, cut)


def centre_crop(plane: Column, width: Size, height: Size, to_width: int, to_height: int) -> Column:
    left = F.greatest(F.lit(0), F.floor((_int(width) - to_width) / 2).cast("int"))
    top = F.greatest(F.lit(0), F.floor((_int(height) - to_height) / 2).cast("int"))
    return crop(plane, width, height, left, top, left + to_width - 1, top + to_height - 1)


def flip_left_right(plane: Column, width: int, height: int) -> Column:
    return let(
        plane,
        lambda p: F.flatten(
            F.transform(
                F.sequence(F.lit(0), F.lit(height - 1)),
                lambda y: F.reverse(F.slice(p, y * width + 1, F.lit(width))),
            )
        ),
    )


def transpose(plane: Column, width: int, height: int) -> Column:
    return let(
        plane,
        lambda p: F.transform(
            F.sequence(F.lit(0), F.lit(width * height - 1)),
            lambda i: F.get(p, (i % height) * width + F.floor(i / height).cast("int")),
        ),
    )


def coin(key: Column, seed: int = 42) -> Column:
    """Repeatable fair coin from a key: true for half of all keys."""
    return F.substring(F.md5(F.concat(key.cast("string"), F.lit(f"-{seed}"))), 1, 1) < "8"


def random_flip(plane: Column, width: int, height: int, key: Column, seed: int = 42) -> Column:
    return F.when(coin(key, seed), flip_left_right(plane, width, height)).otherwise(plane)


def brighten(plane: Column, delta: float = 0.3) -> Column:
    return F.transform(plane, lambda x: x.cast("double") + delta)


def mean(plane: Column) -> Column:
    return let(
        plane,
        lambda p: F.aggregate(p, F.lit(0.0), lambda acc, x: acc + x.cast("double")) / F.size(p),
    )


def contrast(plane: Column, factor: float = 3.0) -> Column:
    """Spread the values about the mean of the channel."""
    return let(
        F.struct(plane.alias("p"), mean(plane).alias("m")),
        lambda s: F.transform(s["p"], lambda x: (x.cast("double") - s["m"]) * factor + s["m"]),
    )


def stretch(plane: Column, top: int = 255) -> Column:
    """Spread min..max over 0..top, cut off to whole numbers; a flat plane becomes 0."""

    def spread(s: Column) -> Column:
        slope = F.lit(float(top)) / F.nullif(s["hi"] - s["lo"], F.lit(0)).cast("double")
        return F.transform(
            s["p"],
            lambda x: F.when(s["hi"] == s["lo"], F.lit(0))
            .when(x == s["hi"], F.lit(top))
            .otherwise(F.floor((x - s["lo"]) * slope).cast("int")),
        )

    return let(
        F.struct(
            plane.alias("p"), F.array_min(plane).alias("lo"), F.array_max(plane).alias("hi")
        ),
        spread,
    )


def equalise(plane: Column) -> Column:
    """Map each grey level through the plane's own cumulative distribution.

    A level's new value is found once; pixels look it up, so the work is that of pixels times levels.
    """

    def remap(s: Column) -> Column:
        # rank of x = pixels at or below x, read off the sorted plane from its far end
        at_or_below = lambda x: s["n"] - F.array_position(s["down"], x) + 1
        scale = (F.lit(255).cast("float") / F.nullif(s["n"] - s["first"], F.lit(0)).cast("float")).cast("float")
        levels = F.transform(
            s["levels"],
            lambda x: F.when(s["n"] == s["first"], x).otherwise(
                F.rint(
                    ((at_or_below(x) - s["first"]).cast("float") * scale).cast("float").cast("double")
                ).cast("int")
            ),
        )
        return let(F.map_from_arrays(s["levels"], levels), lambda m: F.transform(s["p"], lambda x: m[x]))

    low = F.array_min(plane)
    return let(
        F.struct(
            plane.alias("p"),
            F.sort_array(plane, asc=False).alias("down"),
            F.array_distinct(plane).alias("levels"),
            F.size(plane).cast("bigint").alias("n"),
            F.size(F.filter(plane, lambda x: x == low)).cast("bigint").alias("first"),
        ),
        remap,
    )


def _zip3(r: Column, g: Column, b: Column, body: Callable[[Column, Column, Column], Column]) -> Column:
    return F.transform(
        F.arrays_zip(r.alias("r"), g.alias("g"), b.alias("b")),
        lambda px: body(px["r"], px["g"], px["b"]),
    )


def grey(r: Column, g: Column, b: Column) -> Column:
    """Weighted luma in 15-bit fixed point, rounded."""
    wr, wg, wb = LUMA_15
    return _zip3(r, g, b, lambda x, y, z: F.floor((x * wr + y * wg + z * wb + 16384) / 32768).cast("int"))


def grey_mean(r: Column, g: Column, b: Column) -> Column:
    """Equal weights, cut off."""
    return _zip3(r, g, b, lambda x, y, z: F.floor((x + y + z) / 3).cast("int"))


def grey_unit(r: Column, g: Column, b: Column) -> Column:
    """Weighted luma of float channels, not rounded."""
    wr, wg, wb = LUMA
    return _zip3(r, g, b, lambda x, y, z: x * wr + y * wg + z * wb)


def _hsv_pixel(r: Column, g: Column, b: Column) -> Column:
    def shade(m: Column) -> Column:
        v, d = m["v"], m["d"]
        s_step = F.rint(F.lit(255 * 4096) / F.nullif(v, F.lit(0)))
        h_step = F.rint(F.lit(180 * 4096) / (F.nullif(d, F.lit(0)) * 6))
        turn = (
            F.when(v == m["r"], m["g"] - m["b"])
            .when(v == m["g"], m["b"] - m["r"] + d * 2)
            .otherwise(m["r"] - m["g"] + d * 4)
        )
        hue = F.floor((turn * F.coalesce(h_step, F.lit(0.0)) + 2048) / 4096).cast("int")
        return F.struct(
            F.when(hue < 0, hue + 180).otherwise(hue).alias("h"),
            F.floor((d * F.coalesce(s_step, F.lit(0.0)) + 2048) / 4096).cast("int").alias("s"),
            v.alias("v"),
        )

    return let(
        F.struct(
            r.alias("r"),
            g.alias("g"),
            b.alias("b"),
            F.greatest(r, g, b).alias("v"),
            (F.greatest(r, g, b) - F.least(r, g, b)).alias("d"),
        ),
        shade,
    )


def hsv(r: Column, g: Column, b: Column) -> Column:
    """8-bit HSV with hue in 0..179, as an array of structs h, s, v."""
    return _zip3(r, g, b, _hsv_pixel)


def channel(pixels: Column, name: str) -> Column:
    return F.transform(pixels, lambda px: px[name])


def at(plane: Column, width: int, row: Size, col: Size) -> Column:
    """One pixel; null outside the image."""
    inside = (_int(col) >= 0) & (_int(col) < width) & (_int(row) >= 0)
    return F.when(inside, F.get(plane, _int(row) * width + _int(col)))


def correlation(a: Column, b: Column) -> Column:
    """Correlation of two integer planes from exact integer sums; 0 when either is flat."""
    zero = F.struct(*[F.lit(0).cast("bigint").alias(n) for n in ("x", "y", "xx", "yy", "xy")])

    def add(acc: Column, pair: Column) -> Column:
        x, y = pair["x"].cast("bigint"), pair["y"].cast("bigint")
        return F.struct(
            (acc["x"] + x).alias("x"),
            (acc["y"] + y).alias("y"),
            (acc["xx"] + x * x).alias("xx"),
            (acc["yy"] + y * y).alias("yy"),
            (acc["xy"] + x * y).alias("xy"),
        )

    def finish(s: Column) -> Column:
        n, t = s["n"], s["t"]
        spread = F.sqrt((n * t["xx"] - t["x"] * t["x"]).cast("double")) * F.sqrt(
            (n * t["yy"] - t["y"] * t["y"]).cast("double")
        )
        return F.when(spread > 0, (n * t["xy"] - t["x"] * t["y"]).cast("double") / F.nullif(spread, F.lit(0.0))).otherwise(
            F.lit(0.0)
        )

    sums = F.aggregate(F.arrays_zip(a.alias("x"), b.alias("y")), zero, add)
    return let(F.struct(F.size(a).cast("bigint").alias("n"), sums.alias("t")), finish)


def similarity_map(
    plane: Column,
    width: int,
    height: int,
    template: Column,
    t_width: int,
    t_height: int,
    threshold: int = -1,
) -> Column:
    """Per pixel, sum of (1 - |difference| / 255) squared over the centred template.

    Template pixels at or below the threshold and positions outside the image are left out.
    """
    cx, cy = (t_width - 1) // 2, (t_height - 1) // 2

    def score(s: Column, i: Column) -> Column:
        y, x = F.floor(i / width).cast("int"), i % width

        def add(acc: Column, pair: Column) -> Column:
            py = y + F.floor(pair["k"] / t_width).cast("int") - cy
            px = x + pair["k"] % t_width - cx
            inside = (py >= 0) & (py < height) & (px >= 0) & (px < width)
            near = 1.0 - F.abs(F.get(s["p"], py * width + px) - pair["t"]).cast("double") / 255.0
            return acc + F.when(inside & (pair["t"] > threshold), near * near).otherwise(F.lit(0.0))

        return F.aggregate(s["cells"], F.lit(0.0), add)

    cells = F.transform(template, lambda t, k: F.struct(t.alias("t"), k.alias("k")))
    return let(
        F.struct(plane.alias("p"), cells.alias("cells")),
        lambda s: F.transform(F.sequence(F.lit(0), F.lit(width * height - 1)), lambda i: score(s, i)),
    )


def sobel(plane: Column, width: int, height: int) -> Column:
    """Gradient strength (largest = 255) and angle per pixel; the border repeats its own pixels."""

    def edge(p: Column) -> Column:
        def gradient(i: Column) -> Column:
            y, x = F.floor(i / width).cast("int"), i % width
            up, down = F.greatest(F.lit(0), y - 1) * width, F.least(F.lit(height - 1), y + 1) * width
            left, right = F.greatest(F.lit(0), x - 1), F.least(F.lit(width - 1), x + 1)
            mid = y * width
            px = lambda row, col: F.get(p, row + col).cast("double")
            gx = (px(up, left) + px(mid, left) * 2 + px(down, left)) - (
                px(up, right) + px(mid, right) * 2 + px(down, right)
            )
            gy = (px(down, left) + px(down, x) * 2 + px(down, right)) - (
                px(up, left) + px(up, x) * 2 + px(up, right)
            )
            return let(
                F.struct(gx.alias("gx"), gy.alias("gy")),
                lambda g: F.struct(
                    F.sqrt(g["gx"] * g["gx"] + g["gy"] * g["gy"]).alias("strength"),
                    F.atan2(g["gy"], g["gx"]).alias("angle"),
                ),
            )

        return F.transform(F.sequence(F.lit(0), F.lit(width * height - 1)), gradient)

    def rescale(s: Column) -> Column:
        return F.transform(
            s["g"],
            lambda g: F.struct(
                F.when(s["top"] > 0, g["strength"] / F.nullif(s["top"], F.lit(0.0)) * 255)
                .otherwise(F.lit(0.0))
                .alias("strength"),
                g["angle"].alias("angle"),
            ),
        )

    return let(
        let(plane, edge),
        lambda g: let(
            F.struct(
                g.alias("g"), F.array_max(F.transform(g, lambda e: e["strength"])).alias("top")
            ),
            rescale,
        ),
    )


def resize_bilinear(plane: Column, width: int, height: int, to_width: int, to_height: int) -> Column:
    """Bilinear resize with half-pixel centres and no smoothing."""

    def sample(p: Column) -> Column:
        def pixel(i: Column) -> Column:
            sy = (F.floor(i / to_width) + 0.5) * (height / to_height) - 0.5
            sx = (i % to_width + 0.5) * (width / to_width) - 0.5

            def blend(s: Column) -> Column:
                y0 = F.floor(s["sy"]).cast("int")
                x0 = F.floor(s["sx"]).cast("int")
                clamp_y = lambda y: F.least(F.lit(height - 1), F.greatest(F.lit(0), y))
                clamp_x = lambda x: F.least(F.lit(width - 1), F.greatest(F.lit(0), x))
                px = lambda y, x: F.get(p, clamp_y(y) * width + clamp_x(x)).cast("double")
                fy, fx = s["sy"] - F.floor(s["sy"]), s["sx"] - F.floor(s["sx"])
                upper = px(y0, x0) * (1 - fx) + px(y0, x0 + 1) * fx
                lower = px(y0 + 1, x0) * (1 - fx) + px(y0 + 1, x0 + 1) * fx
                return upper * (1 - fy) + lower * fy

            return let(F.struct(sy.alias("sy"), sx.alias("sx")), blend)

        return F.transform(F.sequence(F.lit(0), F.lit(to_width * to_height - 1)), pixel)

    return let(plane, sample)


def pad(plane: Column, width: int, height: int, to_width: int, to_height: int) -> Column:
    """Zeros on all sides; an odd pixel goes to the top and to the left."""
    left = to_width - width - (to_width - width) // 2
    top = to_height - height - (to_height - height) // 2

    def place(p: Column) -> Column:
        def pixel(i: Column) -> Column:
            y, x = F.floor(i / to_width).cast("int") - top, i % to_width - left
            inside = (y >= 0) & (y < height) & (x >= 0) & (x < width)
            return F.when(inside, F.get(p, y * width + x)).otherwise(F.lit(0).cast("double"))

        return F.transform(F.sequence(F.lit(0), F.lit(to_width * to_height - 1)), pixel)

    return let(plane, place)


def fit_size(width: int, height: int, to_width: int, to_height: int) -> tuple[int, int]:
    """Largest size with the same shape that fits the target, rounded."""
    scale = min(to_width / width, to_height / height)
    return max(1, round(width * scale)), max(1, round(height * scale))


def fit(plane: Column, width: int, height: int, to_width: int, to_height: int) -> Column:
    """Keep the shape, resize to fit, pad with zeros to the target."""
    w, h = fit_size(width, height, to_width, to_height)
    return pad(resize_bilinear(plane, width, height, w, h), w, h, to_width, to_height)
