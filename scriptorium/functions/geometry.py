"""Rectangles as four columns x0, y0, x1, y1."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

Box = tuple[Column, Column, Column, Column]


def box(c: Column) -> Box:
    return c[0], c[1], c[2], c[3]


def area(b: Box) -> Column:
    return F.greatest(b[2] - b[0], F.lit(0.0)) * F.greatest(b[3] - b[1], F.lit(0.0))


def overlap(a: Box, b: Box) -> Column:
    return F.greatest(F.least(a[2], b[2]) - F.greatest(a[0], b[0]), F.lit(0.0)) * F.greatest(F.least(a[3], b[3]) - F.greatest(a[1], b[1]), F.lit(0.0))


def iou(a: Box, b: Box) -> Column:
    both = overlap(a, b)
    union = area(a) + area(b) - both
    return F.when(union > 0, both / union).otherwise(0.0)


def covered(a: Box, b: Box) -> Column:
    """Part of a that b covers."""
    return F.when(area(a) > 0, overlap(a, b) / area(a)).otherwise(0.0)


def contains(a: Box, b: Box, slack: float = 3.0) -> Column:
    return (a[0] - slack <= b[0]) & (a[1] - slack <= b[1]) & (a[2] + slack >= b[2]) & (a[3] + slack >= b[3])


def centre(b: Box) -> tuple[Column, Column]:
    return (b[0] + b[2]) / 2, (b[1] + b[3]) / 2


def x_overlap(a: Box, b: Box) -> Column:
    return F.greatest(F.least(a[2], b[2]) - F.greatest(a[0], b[0]), F.lit(0.0))


def third(b: Box, width: Column) -> Column:
    """left, centre or right by the thirds of the page."""
    x = (b[0] + b[2]) / 2
    return F.when(x < width / 3, "left").when(x > width * 2 / 3, "right").otherwise("centre")


def per_mille(b: Box, height: Column) -> Column:
    return (b[3] - b[1]) * 1000 / height


def rescaled(b: Box, fx: Column, fy: Column) -> Box:
    return b[0] * fx, b[1] * fy, b[2] * fx, b[3] * fy


def in_network(ip: Column, network: str) -> Column:
    """IPv4 membership in a CIDR block."""
    base, _, bits = network.partition("/")
    size = 1 << (32 - int(bits or 32))
    start = sum(int(p) << (24 - 8 * i) for i, p in enumerate(base.split("."))) // size * size
    parts = F.split(ip, r"\.")
    value = sum((parts[i].try_cast("long") * (1 << (24 - 8 * i)) for i in range(4)), F.lit(0))
    return value.between(start, start + size - 1)


def rgb_distance(packed: Column, other: Column) -> Column:
    """Distance of two colours packed as 0xRRGGBB."""
    def part(c: Column, shift: int) -> Column:
        return F.shiftright(c, shift).bitwiseAND(255).cast("double")

    return F.sqrt(sum(((part(packed, s) - part(other, s)) * (part(packed, s) - part(other, s)) for s in (16, 8, 0)), F.lit(0.0)))
