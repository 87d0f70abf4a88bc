"""Block-level operators: labels, order, text and image selection."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.fixed import IMAGE_LABELS, TEXT_LABELS
from ..functions.text import has_private_glyphs

PAGE = ["doc_id", "page_index"]


def is_text_block() -> Column:
    return F.col("block_label").isin(TEXT_LABELS) & (F.size("pdf_bbox") == 4)


def is_image_block() -> Column:
    return F.col("block_label").isin(IMAGE_LABELS) & (F.size("pdf_bbox") == 4)


def relabel_formulas(blocks: DataFrame) -> DataFrame:
    """Text blocks with private-use glyphs become formulas."""
    formula = F.col("block_label").isin(TEXT_LABELS) & has_private_glyphs(F.col("block_content"))
    return blocks.withColumn("block_label", F.when(formula, "formula").otherwise(F.col("block_label")))


def fill_block_order(blocks: DataFrame, keys: list[str] = PAGE) -> DataFrame:
    """Gives blocks without ``block_order`` one from their height on the page.

    Blocks stand in order of ``y`` (null: at the end) and ``block_idx``.  Between
    two ordered neighbours, a run of blocks strictly between their heights is
    spread evenly; above the first and below the last ordered block, orders
    step by a tenth.  What ties in height with an ordered block follows the
    largest order by ``block_id``; if nothing is ordered, blocks count from 1 by
    ``block_id``.

    One sort a page serves all windows.
    """
    null_y = F.coalesce(F.col("y"), F.lit(999999.0))
    down = Window.partitionBy(*keys).orderBy(null_y, "block_idx")
    before, after = down.rowsBetween(Window.unboundedPreceding, -1), down.rowsBetween(1, Window.unboundedFollowing)
    page = Window.partitionBy(*keys)
    known = F.col("block_order").isNotNull()
    y = F.coalesce(F.col("y"), F.lit(0.0))
    at = F.when(known, F.struct(F.col("block_order").alias("o"), y.alias("y")))
    df = blocks.withColumns({"__prev": F.last(at, ignorenulls=True).over(before), "__next": F.first(at, ignorenulls=True).over(after), "__y": y})
    above = ~known & F.col("__prev").isNull() & F.col("__next").isNotNull() & (F.col("__y") < F.col("__next.y"))
    below = ~known & F.col("__next").isNull() & F.col("__prev").isNotNull() & (F.col("__y") > F.col("__prev.y"))
    between = ~known & F.col("__prev").isNotNull() & F.col("__next").isNotNull() & (F.col("__y") > F.col("__prev.y")) & (F.col("__y") < F.col("__next.y"))
    df = df.withColumns(
        {
            "__zone": F.when(above, "above").when(below, "below").when(between, "between"),
            "__gap": F.coalesce(F.sum(known.cast("int")).over(before), F.lit(0)),
            "__any": F.max(known.cast("int")).over(page),
        }
    )
    run = Window.partitionBy(*keys, "__gap", "__zone")
    df = df.withColumns({"__i": F.row_number().over(run.orderBy(null_y, "block_idx")), "__n": F.count(F.lit(1)).over(run)})
    step = (F.col("__next.o") - F.col("__prev.o")) / (F.col("__n") + 1)
    # the highest block stands next to the first order: steps are counted upwards from there
    order = (
        F.when(known, F.col("block_order").cast("double"))
        .when(F.col("__zone") == "between", F.col("__prev.o") + step * F.col("__i"))
        .when(F.col("__zone") == "above", F.col("__next.o") - 0.1 * (F.col("__n") - F.col("__i") + 1))
        .when(F.col("__zone") == "below", F.col("__prev.o") + 0.1 * F.col("__i"))
    )
    df = df.withColumn("__order", order)
    left = F.col("__order").isNull()
    top = F.coalesce(F.max("__order").over(page), F.lit(0.0))
    rest = F.row_number().over(Window.partitionBy(*keys, left).orderBy("block_id", null_y, "block_idx"))
    df = df.withColumns({"__top": top, "__rest": rest})
    filled = F.when(F.col("__any") == 0, F.col("__rest").cast("double")).when(left, F.col("__top") + F.col("__rest")).otherwise(F.col("__order"))
    return df.withColumn("block_order", filled).drop("__prev", "__next", "__y", "__zone", "__gap", "__any", "__i", "__n", "__order", "__top", "__rest")


def reading_rank(blocks: DataFrame, keys: list[str] = PAGE) -> DataFrame:
    """``rank`` from 1: ordered blocks first, then the others by ``block_id``."""
    w = Window.partitionBy(*keys).orderBy(F.col("block_order").isNull(), F.coalesce("block_order", F.col("block_id").cast("double")), "block_idx")
    return blocks.withColumn("rank", F.row_number().over(w))


def join_pages(blocks: DataFrame, pages: DataFrame) -> DataFrame:
    """Blocks with their page's sizes; blocks of pages that are missing stay, with nulls."""
    return blocks.join(pages, PAGE, "left")
