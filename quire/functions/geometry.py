"""Box expressions. A box is four columns x, y, w, h in page points; overlap works on whole points, as the data model has it."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Box:
    x: Column
    y: Column
    w: Column
    h: Column

    @classmethod
    def of(cls, prefix: str = "") -> Box:
        return cls(*[F.col(f"{prefix}{c}") for c in "xywh"])

    def whole(self) -> Box:
        return Box(*[c.cast("int") for c in (self.x, self.y, self.w, self.h)])

    @property
    def right(self) -> Column:
        return self.x + self.w

    @property
    def bottom(self) -> Column:
        return self.y + self.h

    @property
    def area(self) -> Column:
        return self.w * self.h


def overlap_1d(a0: Column, a1: Column, b0: Column, b1: Column) -> Column:
    return F.greatest(F.lit(0), F.least(a1, b1) - F.greatest(a0, b0))


def gap_1d(a0: Column, a1: Column, b0: Column, b1: Column) -> Column:
    return F.greatest(F.lit(0), F.greatest(a0, b0) - F.least(a1, b1))


def intersection(a: Box, b: Box) -> Column:
    a, b = a.whole(), b.whole()
    return (overlap_1d(a.x, a.right, b.x, b.right) * overlap_1d(a.y, a.bottom, b.y, b.bottom)).cast("long")


def overlap_ratio(inner: Box, outer: Box) -> Column:
    """Part of the inner box's own area that the outer one covers."""
    return intersection(inner, outer) / F.greatest(F.lit(1), inner.whole().area)


def iou(a: Box, b: Box) -> Column:
    inter = intersection(a, b).cast("double")
    union = (a.area + b.area).cast("double") - inter
    return F.when(union > 0, inter / union).otherwise(0.0)


def inside(inner: Box, outer: Box, margin: float = 6) -> Column:
    return (inner.x >= outer.x - margin) & (inner.y >= outer.y - margin) & (inner.right <= outer.right + margin) & (inner.bottom <= outer.bottom + margin)


def center_inside(inner: Box, outer: Box, least: float = 0.65) -> Column:
    cx, cy = inner.x + inner.w / 2.0, inner.y + inner.h / 2.0
    return (outer.w > 0) & (outer.h > 0) & cx.between(outer.x, outer.right) & cy.between(outer.y, outer.bottom) & (overlap_ratio(inner, outer) >= least)


def center_distance(a: Box, b: Box) -> Column:
    dx, dy = (a.x + a.w / 2.0) - (b.x + b.w / 2.0), (a.y + a.h / 2.0) - (b.y + b.h / 2.0)
    return F.sqrt(dx * dx + dy * dy)


def clip_to_page(b: Box, page_w: Column, page_h: Column) -> Box:
    """The box within the page, of one point at least."""
    zero, one = F.lit(0), F.lit(1)
    x = F.greatest(zero, F.least(b.x, F.greatest(zero, page_w - 1)))
    y = F.greatest(zero, F.least(b.y, F.greatest(zero, page_h - 1)))
    w = F.greatest(one, F.least(b.w, F.greatest(one, page_w - x)))
    h = F.greatest(one, F.least(b.h, F.greatest(one, page_h - y)))
    return Box(x, y, w, h)


def from_edges(left: Column, top: Column, right: Column, bottom: Column) -> Box:
    """Edges as x, y, w, h, rounded half to even."""
    left, top, right, bottom = (F.bround(c).cast("int") for c in (left, top, right, bottom))
    return Box(left, top, F.greatest(F.lit(1), right - left), F.greatest(F.lit(1), bottom - top))


def within_figure(x0: Column, y0: Column, x1: Column, y1: Column, figure: Box) -> Box:
    """SF63: a box in shares of a figure (0 to 1) as one on the page; a side that has no length is that of the bottom band."""
    share = lambda c: F.greatest(F.lit(0.0), F.least(F.lit(1.0), c.cast("double")))
    a0, a1, b0, b1 = share(x0), share(x1), share(y0), share(y1)
    left, right = F.when(a1 > a0, a0).otherwise(0.0), F.when(a1 > a0, a1).otherwise(1.0)
    top, bottom = F.when(b1 > b0, b0).otherwise(0.7), F.when(b1 > b0, b1).otherwise(1.0)
    return Box(figure.x + left * figure.w, figure.y + top * figure.h, F.greatest(F.lit(1.0), (right - left) * figure.w), F.greatest(F.lit(1.0), (bottom - top) * figure.h))


def points_of_pixels(box: Box, dpi: float = 144.0) -> Box:
    """SF63: a box in pixels of a page rendered at dpi, in points."""
    return Box(*[c * (72.0 / dpi) for c in (box.x, box.y, box.w, box.h)])
