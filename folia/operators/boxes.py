"""Boxes drawn on pages, and the text inside them."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.arrays import components, near_points, whole_groups
from ..functions.fixed import BOX_HEIGHT, BOX_MARGIN, BOX_WIDTH, ENDPOINT_GAP, IOU_LIMIT
from ..functions.geometry import corner_inside, fit_score, from_array, iou, is_horizontal, is_vertical, mostly_inside, nearly_equal

PAGE = ["doc_id", "page_index"]
#: Fixed sizes of the older rules for boxes.
OLD_WIDTH, OLD_HEIGHT, LEAST_SPAN = 50.0, 30.0, 10.0


def line_segments(segments: DataFrame) -> DataFrame:
    """Only straight lines; rectangles and other shapes do not take part."""
    return segments.where("kind = 'l'")


SIDES = ["x0", "y0", "x1", "y1"]


def segment_components(segments: DataFrame, gap: float = ENDPOINT_GAP, sides: bool = False) -> DataFrame:
    """``component`` (smallest ``seg_idx``) of segments that hang together by ends less than ``gap`` apart.

    Pages are dealt by hash and sorted, and a task takes many of them at once.
    Ends are put into a grid of cells, only neighbouring cells are compared,
    and the few links between cells are joined into components, so the work
    grows with the segments of a page and not with their pairs.  A page is in
    memory as a whole, at about a hundred bytes a segment.  An end with a null
    coordinate is near to nothing.  With ``sides`` the coordinates come along.
    """
    carried = SIDES if sides else []
    kinds = {f.name: f.dataType.simpleString() for f in segments.schema}
    names = [*PAGE, "seg_idx"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, page in whole_groups(batches, PAGE):
            n = batch.num_rows
            x0, y0, x1, y1 = (batch.column(c).cast(pa.float64()).to_numpy(zero_copy_only=False) for c in SIDES)
            u, v = near_points(np.tile(page, 2), np.concatenate([x0, x1]), np.concatenate([y0, y1]), gap)
            label = components(n, u % n, v % n)
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names + carried), batch.column("seg_idx").take(pa.array(label))], [*names, *carried, "component"])

    dealt = segments.select(*names, *SIDES).repartition(*PAGE).sortWithinPartitions(*names)
    return dealt.mapInArrow(run, ", ".join(f"`{c}` {kinds[c]}" for c in names + carried) + f", component {kinds['seg_idx']}")


def candidate_boxes(segments: DataFrame, parts: DataFrame, min_width: float = BOX_WIDTH, min_height: float = BOX_HEIGHT) -> DataFrame:
    """Components of four lines or more, two of them level and two upright, that span the least size.

    ``parts`` are the components; where they have the coordinates along,
    nothing is joined.
    """
    side = [F.col(c) for c in SIDES]
    whole = set(SIDES) <= set(parts.columns)
    met = parts.where(" and ".join(f"{c} is not null" for c in [*PAGE, "seg_idx"])) if whole else segments.join(parts, [*PAGE, "seg_idx"])
    got = met.groupBy(*PAGE, "component").agg(
        F.count(F.lit(1)).cast("int").alias("line_count"),
        F.count_if(is_horizontal(*side)).alias("level"),
        F.count_if(is_vertical(*side)).alias("upright"),
        F.min(F.least("x0", "x1")).alias("x0"),
        F.min(F.least("y0", "y1")).alias("y0"),
        F.max(F.greatest("x0", "x1")).alias("x1"),
        F.max(F.greatest("y0", "y1")).alias("y1"),
    )
    ok = (F.col("line_count") >= 4) & (F.col("level") >= 2) & (F.col("upright") >= 2) & (F.col("x1") - F.col("x0") >= min_width) & (F.col("y1") - F.col("y0") >= min_height)
    return got.where(ok).select(*PAGE, F.col("component").alias("box_idx"), F.struct("x0", "y0", "x1", "y1").alias("rect"), "line_count")


def suppress(boxes: DataFrame, limit: float = IOU_LIMIT) -> DataFrame:
    """Keeps boxes from the largest down whose overlap with every kept one is below ``limit``.

    Columns: page, ``id`` in order of keeping, ``rect``, ``width``, ``height``,
    ``type``, ``line_count``.  Each choice rests on the ones before it, so a page
    is one group.
    """
    kinds = {f.name: f.dataType.simpleString() for f in boxes.schema}
    flat = boxes.select(*PAGE, "box_idx", "rect.x0", "rect.y0", "rect.x1", "rect.y1", "line_count")

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.assign(width=pdf.x1 - pdf.x0, height=pdf.y1 - pdf.y0)
        pdf = pdf.assign(size=pdf.width * pdf.height).sort_values(["size", "box_idx"], ascending=[False, True], ignore_index=True)
        r = pdf[["x0", "y0", "x1", "y1"]].to_numpy(float)
        alive, kept = np.ones(len(r), bool), []
        for i in range(len(r)):
            if not alive[i]:
                continue
            kept.append(i)
            w = np.minimum(r[i, 2], r[:, 2]) - np.maximum(r[i, 0], r[:, 0])
            h = np.minimum(r[i, 3], r[:, 3]) - np.maximum(r[i, 1], r[:, 1])
            both = np.where((w > 0) & (h > 0), w * h, 0)
            total = pdf["size"].to_numpy() + pdf["size"].to_numpy()[i] - both
            alive &= np.divide(both, total, out=np.zeros(len(r)), where=total != 0) < limit
        out = pdf.iloc[kept].copy()
        out["id"] = range(len(out))
        return out[[*PAGE, "id", "x0", "y0", "x1", "y1", "width", "height", "line_count"]]

    got = flat.groupBy(*PAGE).applyInPandas(run, f"doc_id {kinds['doc_id']}, page_index {kinds['page_index']}, id int, x0 double, y0 double, x1 double, y1 double, width double, height double, line_count int")
    return got.select(*PAGE, "id", F.struct("x0", "y0", "x1", "y1").alias("rect"), "width", "height", F.lit("connected_component").alias("type"), "line_count")


def detect_boxes(segments: DataFrame, min_width: float = BOX_WIDTH, min_height: float = BOX_HEIGHT) -> DataFrame:
    lines = line_segments(segments)
    return suppress(candidate_boxes(lines, segment_components(lines, sides=True), min_width, min_height))


def overlapping_pairs(boxes: DataFrame, limit: float = IOU_LIMIT) -> DataFrame:
    """Pairs of boxes of a page whose overlap reaches ``limit``."""
    a = boxes.select(*PAGE, F.col("id").alias("a"), F.col("rect").alias("ra"))
    b = boxes.select(*PAGE, F.col("id").alias("b"), F.col("rect").alias("rb"))
    return a.join(b, PAGE).where("a < b").withColumn("iou", iou(F.col("ra"), F.col("rb"))).where(F.col("iou") >= limit).select(*PAGE, "a", "b", "iou")


def assign_boxes(blocks: DataFrame, boxes: DataFrame, margin: float = BOX_MARGIN, keys: list[str] = PAGE) -> DataFrame:
    """``inside_box`` and ``box_id``: the box that holds nine tenths of a block and fits it best.

    An equi join by page with the rest as a condition; the smallest score wins,
    and of equal ones the first box.
    """
    made = boxes.select(*keys, F.col("id").alias("__box"), F.col("rect").alias("__rect"))
    text = blocks.withColumn("__text", from_array(F.col("pdf_bbox")))
    hit = text.select(*keys, "block_idx", "__text").join(made, keys).where(mostly_inside(F.col("__text"), F.col("__rect"), margin))
    best = hit.groupBy(*keys, "block_idx").agg(F.min(F.struct(fit_score(F.col("__text"), F.col("__rect")).alias("score"), F.col("__box").alias("box"))).alias("best"))
    met = text.join(best, [*keys, "block_idx"], "left")
    return met.withColumns({"inside_box": F.col("best").isNotNull(), "box_id": F.col("best.box")}).drop("__text", "best")


def assign_boxes_by_corner(blocks: DataFrame, boxes: DataFrame, margin: float = 2.0) -> DataFrame:
    """The older rule: the first box that holds the top left corner."""
    made = boxes.select(*PAGE, F.col("id").alias("__box"), F.col("rect").alias("__rect"))
    text = blocks.withColumn("__text", from_array(F.col("pdf_bbox")))
    hit = text.select(*PAGE, "block_idx", "__text").join(made, PAGE).where(corner_inside(F.col("__text"), F.col("__rect"), margin))
    return text.drop("__text").join(hit.groupBy(*PAGE, "block_idx").agg(F.min("__box").alias("box_id")), [*PAGE, "block_idx"], "left")


def distinct_boxes(boxes: DataFrame, threshold: float = 5.0) -> DataFrame:
    """The older rule against duplicates: a box goes if an earlier one of the page is nearly equal."""
    a = boxes.select(*PAGE, F.col("id").alias("earlier"), F.col("rect").alias("ra"))
    b = boxes.select(*PAGE, "id", F.col("rect").alias("rb"))
    gone = a.join(b, PAGE).where((F.col("earlier") < F.col("id")) & nearly_equal(F.col("ra"), F.col("rb"), threshold)).select(*PAGE, "id").distinct()
    return boxes.join(gone, [*PAGE, "id"], "left_anti")


def legacy_boxes(drawings: DataFrame, segments: DataFrame, annotations: DataFrame | None = None, min_width: float = OLD_WIDTH, min_height: float = OLD_HEIGHT, threshold: float = 5.0) -> DataFrame:
    """Boxes by the older rules: ``id``, ``rect``, ``width``, ``height`` and ``type`` on each page.

    Candidates of a page come in this order: each drawing's own rectangle
    (``rect``; ``drawings`` has ``drawing_idx`` and a rectangle or nulls), then
    what its four or more lines span (``lines``; ``segments`` with
    ``drawing_idx``); what all lines of the page span, if there are four
    (``lines_combined``); rectangles of annotations (``annotation``, by
    ``annotation_idx``).  A drawing's own rectangle always counts, any other
    only if no box before it is nearly equal.

    Candidates of a page are folded in one row, as each rests on those kept
    before it; their number is that of the page's drawings and annotations.
    """
    side = ("x0", "y0", "x1", "y1")

    def candidates(df: DataFrame, kind: str, rank: int, idx: Column, x0: Column, y0: Column, x1: Column, y1: Column) -> DataFrame:
        place = F.struct(F.lit(rank).alias("rank"), idx.cast("long").alias("idx"), F.lit(int(kind != "rect")).alias("step"))
        fields = {"x0": x0, "y0": y0, "x1": x1, "y1": y1, "width": x1 - x0, "height": y1 - y0}
        row = F.struct(place.alias("place"), *(v.cast("double").alias(k) for k, v in fields.items()), F.lit(kind).alias("type"))
        return df.select(*PAGE, row.alias("c")).where((F.col("c.width") >= min_width) & (F.col("c.height") >= min_height))

    def spanned(keys: list[str]) -> DataFrame:
        low = [F.min(F.least(f"{c}0", f"{c}1")).alias(f"{c}0") for c in "xy"]
        high = [F.max(F.greatest(f"{c}0", f"{c}1")).alias(f"{c}1") for c in "xy"]
        got = line_segments(segments).groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), *low, *high).where("n >= 4")
        return got.where((F.col("x1") - F.col("x0") >= LEAST_SPAN) & (F.col("y1") - F.col("y0") >= LEAST_SPAN))

    at = [F.col(c) for c in side]
    zero = F.lit(0)
    both = [F.least("x0", "x1"), F.least("y0", "y1"), F.greatest("x0", "x1"), F.greatest("y0", "y1")]
    found = candidates(drawings.where("x0 is not null and y0 is not null and x1 is not null and y1 is not null"), "rect", 0, F.col("drawing_idx"), *both)
    found = found.union(candidates(spanned([*PAGE, "drawing_idx"]), "lines", 0, F.col("drawing_idx"), *at))
    found = found.union(candidates(spanned(PAGE), "lines_combined", 1, zero, *at))
    if annotations is not None:
        found = found.union(candidates(annotations, "annotation", 2, F.col("annotation_idx"), *at))
    listed = found.groupBy(*PAGE).agg(F.sort_array(F.collect_list("c")).alias("cs"))
    none = F.array().cast(listed.schema["cs"].dataType)

    def keep(kept: Column, c: Column) -> Column:
        again = F.exists(kept, lambda k: nearly_equal(k, c, threshold))
        return F.when((c["type"] == "rect") | ~again, F.array_append(kept, c)).otherwise(kept)

    out = listed.select(*PAGE, F.posexplode(F.aggregate("cs", none, keep)).alias("id", "c"))
    return out.select(*PAGE, "id", F.struct(*(F.col(f"c.{k}").alias(k) for k in side)).alias("rect"), "c.width", "c.height", "c.type")


def box_statistics(blocks: DataFrame) -> DataFrame:
    return blocks.groupBy(*PAGE).agg(F.count(F.lit(1)).alias("blocks"), F.count_if("inside_box").alias("boxed"))
