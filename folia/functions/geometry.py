"""Geometry over rectangles and segments, as column expressions.

A rectangle is a struct of doubles ``x0, y0, x1, y1``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .fixed import OVERLAP, SLOPE


def rect(x0: Column, y0: Column, x1: Column, y1: Column) -> Column:
    return F.struct(x0.cast("double").alias("x0"), y0.cast("double").alias("y0"), x1.cast("double").alias("x1"), y1.cast("double").alias("y1"))


def from_array(bbox: Column) -> Column:
    """A rectangle of an array of four numbers, else null."""
    return F.when(F.size(bbox) == 4, rect(*(F.get(bbox, F.lit(i)) for i in range(4))))


def rescaled(bbox: Column, image_w: Column, image_h: Column, pdf_w: Column, pdf_h: Column) -> Column:
    """A box from pixels to points, two decimals; the empty array unless it has four numbers and all sizes are positive."""
    ok = (F.size(bbox) == 4) & (image_w > 0) & (image_h > 0) & (pdf_w > 0) & (pdf_h > 0)
    scaled = [F.bround(F.get(bbox, F.lit(i)) * ((pdf_w / image_w) if i % 2 == 0 else (pdf_h / image_h)), 2) for i in range(4)]
    return F.when(F.coalesce(ok, F.lit(False)), F.array(*scaled)).otherwise(F.array().cast("array<double>"))


def area(r: Column) -> Column:
    return (r["x1"] - r["x0"]) * (r["y1"] - r["y0"])


def overlap(a: Column, b: Column) -> tuple[Column, Column]:
    """Width and height that two rectangles share; not positive if they do not meet."""
    return F.least(a["x1"], b["x1"]) - F.greatest(a["x0"], b["x0"]), F.least(a["y1"], b["y1"]) - F.greatest(a["y0"], b["y0"])


def iou(a: Column, b: Column) -> Column:
    w, h = overlap(a, b)
    total = area(a) + area(b) - w * h
    return F.when((w > 0) & (h > 0) & (total != 0), w * h / total).otherwise(0.0)


def distance(x0: Column, y0: Column, x1: Column, y1: Column) -> Column:
    return F.hypot(x0 - x1, y0 - y1)


def is_horizontal(x0: Column, y0: Column, x1: Column, y1: Column) -> Column:
    dx, dy = F.abs(x1 - x0), F.abs(y1 - y0)
    return F.coalesce((dx != 0) & (dy / F.nullif(dx, F.lit(0.0)) < SLOPE), F.lit(False))


def is_vertical(x0: Column, y0: Column, x1: Column, y1: Column) -> Column:
    return is_horizontal(y0, x0, y1, x1)


def mostly_inside(text: Column, box: Column, margin: float) -> Column:
    """Nine tenths of the text's area, width and height lie in the box, and it stays within the margin."""
    w, h = overlap(text, box)
    tw, th = text["x1"] - text["x0"], text["y1"] - text["y0"]
    share = (w * h / F.nullif(tw * th, F.lit(0.0)) >= OVERLAP) & (w / F.nullif(tw, F.lit(0.0)) >= OVERLAP) & (h / F.nullif(th, F.lit(0.0)) >= OVERLAP) & (tw > 0) & (th > 0)
    near = (text["y0"] >= box["y0"] - margin) & (text["y1"] <= box["y1"] + margin) & (text["x0"] >= box["x0"] - margin) & (text["x1"] <= box["x1"] + margin)
    return F.coalesce((w > 0) & (h > 0) & share & near, F.lit(False))


def fit_score(text: Column, box: Column) -> Column:
    """Smaller is better: the box's area, weighed by the overlap if the text sticks out."""
    w, h = overlap(text, box)
    inside = (box["x0"] <= text["x0"]) & (text["x1"] <= box["x1"]) & (box["y0"] <= text["y0"]) & (text["y1"] <= box["y1"])
    ratio = F.when(area(text) > 0, w * h / area(text)).otherwise(0.0)
    return F.when(inside, area(box)).otherwise(area(box) / (ratio + 0.1))


def corner_inside(text: Column, box: Column, margin: float = 2.0) -> Column:
    """Only the top left corner counts."""
    return text["x0"].between(box["x0"] - margin, box["x1"] + margin) & text["y0"].between(box["y0"] - margin, box["y1"] + margin)


def nearly_equal(a: Column, b: Column, threshold: float = 5.0) -> Column:
    out = F.lit(True)
    for side in ("x0", "y0", "x1", "y1"):
        out = out & (F.abs(a[side] - b[side]) < threshold)
    return out
