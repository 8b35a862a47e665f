"""Columns over boxes [x0, y0, x1, y1]. A null or short box has area 0 and overlaps nothing."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def side(box: Column, i: int) -> Column:
    return F.get(box, i)


def area(box: Column) -> Column:
    width, height = side(box, 2) - side(box, 0), side(box, 3) - side(box, 1)
    return F.coalesce(F.greatest(F.lit(0.0), width) * F.greatest(F.lit(0.0), height), F.lit(0.0))


def shared_area(a: Column, b: Column) -> Column:
    width = F.least(side(a, 2), side(b, 2)) - F.greatest(side(a, 0), side(b, 0))
    height = F.least(side(a, 3), side(b, 3)) - F.greatest(side(a, 1), side(b, 1))
    whole = F.size(F.array_compact(a)) + F.size(F.array_compact(b)) == 8
    return F.coalesce(F.when(whole, F.greatest(F.lit(0.0), width) * F.greatest(F.lit(0.0), height)), F.lit(0.0))


def overlap(a: Column, b: Column) -> Column:
    """The shared area over that of the smaller box."""
    least = F.least(area(a), area(b))
    return F.when(least > 0, shared_area(a, b) / least).otherwise(F.lit(0.0))


def contained(container: Column, child: Column) -> Column:
    """The share of ``child`` that lies in ``container``."""
    return F.when(area(child) > 0, shared_area(container, child) / area(child)).otherwise(F.lit(0.0))


def union(boxes: list[Column]) -> Column:
    x0, y0, x1, y1 = (F.array(*(side(b, i) for b in boxes)) for i in range(4))
    return F.array(F.array_min(x0), F.array_min(y0), F.array_max(x1), F.array_max(y1))


def clip(box: Column, page: Column) -> Column:
    return F.array(*(F.greatest(side(box, i), side(page, i)) for i in (0, 1)), *(F.least(side(box, i), side(page, i)) for i in (2, 3)))


def expand(box: Column, page: Column, sides: float, up: float, down: float) -> Column:
    grown = F.array(side(box, 0) - sides, side(box, 1) - up, side(box, 2) + sides, side(box, 3) + down)
    return clip(grown, page)


def usable(box: Column, page: Column, least_area: float = 0.01, most_area: float = 0.95, most_aspect: float = 12.0) -> Column:
    """Whether a box is neither a speck, the whole page nor a line."""
    share = area(box) / F.nullif(area(page), F.lit(0.0))
    width, height = side(box, 2) - side(box, 0), side(box, 3) - side(box, 1)
    aspect = F.greatest(width, height) / F.nullif(F.least(width, height), F.lit(0.0))
    return F.coalesce((share >= least_area) & (share <= most_area) & (aspect <= most_aspect), F.lit(False))
