"""Scalar and array expressions (all evaluated inside the JVM)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Bind a value once, then use it inside body.

    A lambda body is evaluated per element, so a per-image mean written inside it
    would be recomputed for every pixel; binding it first keeps the work linear.
    """
    return F.transform(F.array(value), body)[0]


def total(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda acc, x: acc + x.cast("double"))


def int_total(values: Column) -> Column:
    return F.aggregate(values, F.lit(0).cast("bigint"), lambda acc, x: acc + x.cast("bigint"))


def to_byte(unit: Column) -> Column:
    """0..1 to 0..255, cut off and not rounded."""
    return F.floor(unit.cast("double") * 255).cast("int")


def joined(values: Column, sep: str = "-") -> Column:
    return F.array_join(values, sep)


def capitalised(text: Column) -> Column:
    """First letter upper, all others lower (initcap would touch every word)."""
    return F.concat(F.upper(F.substring(text, 1, 1)), F.lower(F.substr(text, F.lit(2))))


def class_text(class_id: Column) -> Column:
    return F.concat(F.lit("Class "), class_id.cast("string"))


def percent_text(share: Column, digits: int = 2) -> Column:
    return F.format_string(f"%.{digits}f%%", share.cast("double") * 100)


def duration(seconds: Column, mili: bool = False) -> Column:
    """H:MM:SS with days in front when there are any.

    With mili, a time that has a fraction is cut to its last second digit and the
    six fraction digits; a whole number of seconds keeps the full text.
    """

    def render(micros: Column) -> Column:
        whole = F.floor(micros / 1_000_000)
        days = F.floor(whole / 86_400)
        rest = whole - days * 86_400
        day_text = (
            F.when(days == 0, F.lit(""))
            .when(days == 1, F.lit("1 day, "))
            .otherwise(F.format_string("%d days, ", days))
        )
        clock = F.format_string(
            "%d:%02d:%02d", F.floor(rest / 3600), F.floor(rest % 3600 / 60), rest % 60
        )
        text = F.concat(day_text, clock)
        if not mili:
            return text
        tail = F.format_string("%d.%06d", rest % 10, micros % 1_000_000)
        return F.when(micros % 1_000_000 > 0, tail).otherwise(text)

    return let(F.rint(seconds.cast("double") * 1_000_000).cast("bigint"), render)


def interpolate(x: Column, x0: Column, x1: Column, y0: float, y1: float) -> Column:
    """Straight line through two points, held constant outside them; y0 where x0 = x1."""
    slope = F.try_divide(F.lit(float(y1 - y0)), (x1 - x0).cast("double"))
    return (
        F.when(x >= x1, F.when(x1 > x0, F.lit(float(y1))).otherwise(F.lit(float(y0))))
        .when(x <= x0, F.lit(float(y0)))
        .otherwise(slope * (x - x0) + float(y0))
    )


def unravel(position: Column, width: int | Column) -> tuple[Column, Column]:
    """Flat row-major index to (row, col)."""
    return F.floor(position / width).cast("int"), (position % width).cast("int")


def argmax(values: Column) -> Column:
    """0-based position of the first largest value."""
    return (F.array_position(values, F.array_max(values)) - 1).cast("int")


def normalised(hist: Column) -> Column:
    """Histogram divided by its sum plus 1e-6."""
    return let(
        F.struct(hist.alias("h"), (total(hist) + 1e-6).alias("t")),
        lambda s: F.transform(s["h"], lambda x: x.cast("double") / s["t"]),
    )


def scaled_down(values: Column, by: float = 255.0) -> Column:
    return F.transform(values, lambda x: x.cast("double") / by)


def subsets(names: list[str]) -> Column:
    """All non-empty subsets of a list, as one array column of arrays."""
    every = F.array(*[F.lit(n) for n in names])
    return F.transform(
        F.sequence(F.lit(1), F.lit(2 ** len(names) - 1)),
        lambda mask: F.filter(every, lambda _, i: F.getbit(mask, i) == 1),
    )
