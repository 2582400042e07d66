"""Boxes and intervals as Column arithmetic."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

Box = tuple[Column, Column, Column, Column]  # x0, x1, y0, y1


def area(b: Box) -> Column:
    return (b[1] - b[0]) * (b[3] - b[2])


def overlap(lo: Column, hi: Column, lo2: Column, hi2: Column) -> Column:
    """Length two intervals share; negative: the gap between them."""
    return F.least(hi, hi2) - F.greatest(lo, lo2)


def gap(lo: Column, hi: Column, lo2: Column, hi2: Column) -> Column:
    """Distance between two intervals; 0 where they touch or overlap."""
    return F.greatest(-overlap(lo, hi, lo2, hi2), F.lit(0.0))


def gap2(a: Box, b: Box) -> Column:
    """Distance between two boxes."""
    return F.sqrt(F.pow(gap(a[0], a[1], b[0], b[1]), 2) + F.pow(gap(a[2], a[3], b[2], b[3]), 2))


def shared_area(a: Box, b: Box) -> Column:
    x, y = overlap(a[0], a[1], b[0], b[1]), overlap(a[2], a[3], b[2], b[3])
    return F.greatest(x, F.lit(0.0)) * F.greatest(y, F.lit(0.0))


def iou(a: Box, b: Box) -> Column:
    """Shared area over joint area; 0 for two empty boxes."""
    both = shared_area(a, b)
    joint = area(a) + area(b) - both
    return F.when(joint > 0, both / joint).otherwise(F.lit(0.0))


def contains(a: Box, b: Box) -> Column:
    return (a[0] <= b[0]) & (a[1] >= b[1]) & (a[2] <= b[2]) & (a[3] >= b[3])


def affine(x: Column, scale: float, shift: float) -> Column:
    return x * scale + shift


def affine_inverse(x: Column, scale: float, shift: float) -> Column:
    return (x - shift) / scale


def transform(b: Box, sx: float, tx: float, sy: float, ty: float) -> Box:
    """A box under an affine map; a negative scale swaps its corners."""
    x, y = (affine(b[0], sx, tx), affine(b[1], sx, tx)), (affine(b[2], sy, ty), affine(b[3], sy, ty))
    return F.least(*x), F.greatest(*x), F.least(*y), F.greatest(*y)
